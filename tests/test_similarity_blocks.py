"""Pairs of blocks of all rows: the same pairs as all products, and no copies of rows on the way."""

import math
import random

import pytest

from pressloom.operators import features, linkage, similarity
from pressloom.session import StepTables


def unit_vectors(rng, n, terms, size):
    vectors = [{t: rng.random() ** 3 for t in rng.sample(range(terms), size)} for _ in range(n)]
    return [{t: x / math.sqrt(sum(y * y for y in v.values())) for t, x in v.items()} for v in vectors]


@pytest.mark.parametrize("min_sim,blocks,dense", [(0.3, 7, 4), (0.6, 4, 12), (0.0, 2, 0)])
def test_blocks_meet_without_copies_of_rows(spark, monkeypatch, min_sim, blocks, dense):
    monkeypatch.setattr(similarity, "_WIDER", 1)
    monkeypatch.setattr(similarity, "_DENSE", dense)
    monkeypatch.setattr(similarity, "_DENSE_FROM", 1)
    vectors = unit_vectors(random.Random(blocks), 90, 30, 9)
    steps = StepTables(spark, "test")
    df = spark.createDataFrame([(i, i % 4 + 1, sorted(v.items())) for i, v in enumerate(vectors)], "doc long, n long, v array<struct<tid: long, w: double>>")
    indexed = steps.save(similarity.index_vectors(df, min_sim), "vectors")
    pairs = similarity.similar_pairs(indexed, "doc", min_sim, steps, block_rows=-(-90 // blocks), copies="n")
    want = {}
    for i, p in enumerate(vectors):
        for j in range(i + 1, len(vectors)):
            s = sum(x * vectors[j].get(t, 0.0) for t, x in p.items())
            if s > min_sim:
                want[(i, j)] = (round(s, 9), i % 4 + 1, j % 4 + 1)
    got = pairs.collect()
    assert len(got) == len(want) and {(r.a, r.b): (round(r.sim, 9), r.copies_a, r.copies_b) for r in got} == want
    # A row would be copied by an explode before a shuffle; here a shuffle moves a packed block once.
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "packed" not in plan and "Join Inner" in plan
    steps.close()


def test_pairs_by_words_and_characters_meet_without_copies_of_rows(spark, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(25)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=5))) for i in range(60)], "doc_id long, text_for_cluster string")
    found = lambda pairs: {(r.a, r.b): (round(r.sim, 9), r.copies_a, r.copies_b) for r in pairs.collect()}
    want = found(linkage.cosine_pairs(docs, chars=features.CharGrams()))  # one block
    monkeypatch.setattr(similarity, "_WIDER", 1)
    pairs = linkage.cosine_pairs(docs, chars=features.CharGrams(), block_rows=16)
    assert want and found(pairs) == want
    assert "Generate" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_read_steps_are_removed(spark):
    steps = StepTables(spark, "test")
    first, second = (steps.save(spark.range(3), name) for name in ("first", "second"))
    steps.drop_all_but(second)
    assert second.count() == 3
    with pytest.raises(Exception, match="(?i)not.*(exist|found)"):
        first.count()
    third = steps.save(second, "third")
    steps.drop_all_but(third)
    assert third.count() == 3
    steps.close()
