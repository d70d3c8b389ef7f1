"""Average linkage of a group in memory against one merge at a time."""

import math
import random

import numpy as np
import pytest

from pressloom.operators import agglomeration, linkage
from pressloom.session import StepTables


def plain(n, vectors, threshold):
    dot = lambda p, q: sum(x * q.get(t, 0.0) for t, x in p.items())
    size, vectors, into = dict(enumerate(n)), dict(enumerate(vectors)), {i: i for i in range(len(n))}
    while True:
        pairs = ((round(1 - dot(vectors[a], vectors[b]) / (size[a] * size[b]), 12), a, b) for a in vectors for b in vectors if a < b)
        d, a, b = min(pairs, default=(9, 0, 0))
        if d >= threshold:
            return into, size
        gone = vectors.pop(b)
        vectors[a] = {t: vectors[a].get(t, 0.0) + gone.get(t, 0.0) for t in vectors[a].keys() | gone.keys()}
        size[a] += size.pop(b)
        into = {i: a if r == b else r for i, r in into.items()}


def group(n, vectors, threshold):
    """The arguments of nearest_merges for unit vectors that stand for n documents each."""
    entries = [(i, t, x * n[i]) for i, v in enumerate(vectors) for t, x in v.items()]
    pairs = []
    for i, p in enumerate(vectors):
        for j in range(i + 1, len(vectors)):
            s = sum(x * vectors[j].get(t, 0.0) for t, x in p.items()) * n[i] * n[j]
            if round(1 - s / (n[i] * n[j]), 12) < threshold:
                pairs.append((i, j, s))
    return entries, pairs


@pytest.mark.parametrize("seed", range(8))
def test_nearest_merges(seed, monkeypatch):
    monkeypatch.setattr(agglomeration, "_AT_ONCE", 7)
    rng = random.Random(seed)
    threshold = rng.choice([0.5, 0.7, 0.83, 1.0])
    # Few terms and few weights make many ties.
    vectors = [{t: rng.choice([1.0, 1.0, 2.0]) for t in rng.sample(range(9 + 2 * seed), rng.randint(1, 4))} for _ in range(40)]
    vectors = [{t: x / math.sqrt(sum(y * y for y in v.values())) for t, x in v.items()} for v in vectors]
    n = [rng.choice([1, 1, 3]) for _ in vectors]
    entries, pairs = group(n, vectors, threshold)
    columns = [np.array(c) for c in zip(*pairs)] + [np.array(c) for c in zip(*entries)]
    root, size = agglomeration.nearest_merges(np.array(n, float), *columns, threshold)
    want, sizes = plain(n, [{t: x * n[i] for t, x in v.items()} for i, v in enumerate(vectors)], threshold)
    assert dict(enumerate(root.tolist())) == want
    assert size.tolist() == [sizes[want[i]] for i in range(len(n))]


def test_vectors_stay_in_order_when_others_are_forgotten():
    rng = np.random.default_rng(1)
    vectors = agglomeration._Vectors(np.repeat(np.arange(400), 500), np.tile(np.arange(500), 400), rng.random(200_000), 500, 801)
    left, right = np.arange(0, 400, 2), np.arange(1, 400, 2)
    before = vectors.products(left, right)
    vectors.merge(left, right, np.arange(400, 600))
    live = np.arange(400, 600)[::-1]
    assert np.allclose(vectors.products(left, right), before)
    vectors.keep(live)
    vectors.merge(np.arange(400, 500), np.arange(500, 600), np.arange(600, 700))
    vectors.keep(np.arange(600, 700)[::-1])
    assert vectors.end == 50_000 and (np.diff(vectors.keys[: vectors.end]) > 0).all()


class Counted(StepTables):
    def __init__(self, *args):
        super().__init__(*args)
        self.names = []

    def save(self, df, name):
        self.names.append(name)
        return super().save(df, name)


def chain(spark, n):
    """Each link is weaker than the one before it."""
    link = lambda i: 0.45 - 0.00005 * i
    entries = []
    for i in range(n):
        sides = [(10_000 + i - 1, link(i - 1))] * (i > 0) + [(10_000 + i, link(i))]
        entries += [(i, tid, math.sqrt(x)) for tid, x in sides] + [(i, 100_000 + i, math.sqrt(1 - sum(x for _, x in sides)))]
    sums = spark.createDataFrame(entries, "c long, tid long, s double")
    return spark.createDataFrame([(i, i + 1, 1, 1, link(i)) for i in range(n - 1)], "a long, b long, na long, nb long, s double"), sums


def test_a_component_of_thousands_takes_no_levels(spark):
    steps = Counted(spark, "test")
    edges, sums = (steps.save(x, "input") for x in chain(spark, 3000))
    got = linkage._merge_rounds(edges, sums, 0.83, steps, linkage.COMPONENT).collect()
    assert {(r.old, r.new) for r in got} == {(i + 1, i) for i in range(0, 3000, 2)}
    assert "sums" not in steps.names and "components" not in steps.names
    steps.close()


@pytest.mark.parametrize("limit,most", [("ENTRIES", 120), ("EDGES", 30)])
def test_more_than_a_task_holds_goes_by_levels(spark, monkeypatch, limit, most):
    monkeypatch.setattr(linkage, limit, most)
    monkeypatch.setattr(linkage, "TASKS", 3)
    steps = Counted(spark, "test")
    edges, sums = (steps.save(x, "input") for x in chain(spark, 60))
    got = linkage._merge_rounds(edges, sums, 0.83, steps, linkage.COMPONENT).collect()
    assert {(r.old, r.new) for r in got} == {(i + 1, i) for i in range(0, 60, 2)}
    assert "components" in steps.names
    steps.close()
