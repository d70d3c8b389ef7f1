import hashlib
import math
import random

import numpy as np
import pytest

from pressloom.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def test_nearest_is_exact_with_ties():
    rng = np.random.default_rng(3)
    for entries, width, spread in ((64, 4, 40), (64, 1, 5), (1, 3, 9), (7, 4, 2), (64, 8, 300)):
        books = rng.integers(-spread, spread, (entries, width))
        points = rng.integers(-2 * spread, 2 * spread, (500, width))
        every = ((points[:, None] - books) ** 2).sum(axis=2)
        found, far = vc.nearest(points, books)
        assert (found == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()


def test_candidates_hold_few_entries():
    rng = np.random.default_rng(4)
    books, points = rng.normal(0, 60, (64, 4)).astype(int), rng.normal(0, 60, (1000, 4)).astype(int)
    masks = vc.candidates(points, books, vc.prefix_masks(books))
    assert np.bitwise_count(masks).mean() < 12


def plain(rows):
    """Contract as written, in loops."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [[math.floor(256 * float(np.float32(x))) for x in r[1]] for r in good]
    width = max(map(len, ints)) // 16
    cut = lambda v, k: v[k * width : (k + 1) * width]
    first = {}
    for r, v in zip(good, ints):
        if r[0] is not None:
            first[r[0]] = min(first.get(r[0], (list(r[1]), v)), (list(r[1]), v))
    starts = [first[n][1] for n in sorted(first)[:64]]
    books = [[cut(v, k) for v in starts] for k in range(16)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    pick = lambda v, k: min((far(cut(v, k), e), n) for n, e in enumerate(books[k]))
    for _ in range(2):
        chosen = [[pick(v, k)[1] for k in range(16)] for v in ints]
        new = []
        for k in range(16):
            own = [[cut(v, k) for v, c in zip(ints, chosen) if c[k] == n] for n in range(len(starts))]
            new.append([[sum(x) // len(o) for x in zip(*o)] if o else books[k][n] for n, o in enumerate(own)])
        books = new
    last = [[pick(v, k) for k in range(16)] for v in ints]
    errors = [sum(d for d, _ in p) for p in last]
    by = {}
    for r, e in zip(good, errors):
        by[r[2]] = by.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{n:02x}" for _, n in p), e, by[r[2]], digest) for r, p, e in zip(good, last, errors)]


@pytest.mark.parametrize("count,size", [(150, 64), (20, 16), (90, 32)])
def test_report_equals_loops(spark, count, size):
    rng = random.Random(count)
    rows = [(rng.randrange(10_000), [rng.gauss(0, 0.2) for _ in range(size)], rng.choice([1, 2, 2, 2, None]), "x") for _ in range(count)]
    rows += [rows[0], (rows[1][0], rows[2][1], 5, "x"), (None, rows[3][1], 1, None)]
    rows += [(1, None, 1, None), (2, [float("nan")] + [0.0] * (size - 1), 1, None), (3, [None] + [0.0] * (size - 1), 1, None), (4, [float("-inf")] * size, 1, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r) for r in vc.report(docs).collect()), key=key) == sorted(plain([r[:3] for r in rows]), key=key)


def test_edges(spark):
    assert vc.report(spark.createDataFrame([], SCHEMA)).collect() == []
    only = vc.report(spark.createDataFrame([(None, [0.5] * 16, None, None)], SCHEMA)).collect()
    assert [r[:4] for r in only] == [(None, None, None, None)]
    odd = vc.report(spark.createDataFrame([(1, [0.5] * 3, 7, None), (2, [], 7, None), (3, [1e30] * 17, 7, None)], SCHEMA)).collect()
    assert {(r["vec_id"], len(r["code"]), r["error"]) for r in odd} == {(1, 32, 0), (2, 32, 0), (3, 32, 0)}


def test_decode(spark):
    rows = [(k, [k / 16 + j / 256 for j in range(16)], 0, None) for k in range(8)]
    whole = vc.kept(spark.createDataFrame(rows, SCHEMA))
    books = vc.fit(whole)
    for r in vc.encode(whole, books).collect():
        assert vc.decode(r["code"], books).tolist() == rows[r["vec_id"]][1]
