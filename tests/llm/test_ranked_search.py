import math
import random
import re

import pytest

from pressloom.llm import ranked_search as rs

DOCS, ITEMS = "doc_id long, text string, score double", "item_id long, text string, item string"


def terms(text):
    return [re.sub("[A-Z]", lambda c: c.group().lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain(docs, items):
    """Contract as written, every item against every document."""
    words = [terms(t) for _, t in docs]
    some = [w for w in words if w]
    n_docs, total = len(some), sum(map(len, some))
    out = []
    for item, text in items:
        found = []
        for (number, _), w in zip(docs, words):
            score = 0
            for t in terms(text):
                df, tf = sum(t in o for o in map(set, some)), w.count(t)
                if tf:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += weight * (1000000000 * tf // (1000 * tf + 8 * (100 - 75 + 75 * len(w) * n_docs // total)))
            if score > 0:
                found.append((-score, number is None, number or 0))
        out += [(item, k + 1, None if null else number, -score) for k, (score, null, number) in enumerate(sorted(found)[:10])]
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("ka", "Ro", "ñu", "b", "7", "שלום") for b in ("", "n", "st", "ß", "9")]
    sentence = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "-", "  ", "\n", "_"]) for _ in range(n))
    docs = [(rng.randrange(1000), sentence(rng.randrange(1, 40))) for _ in range(90)]
    docs += [docs[0], docs[1], (7, docs[2][1]), (None, docs[3][1]), (None, docs[3][1]), (8, None), (9, ""), (10, " .,; "), (11, "kan " * 9000)]
    items = [(k, sentence(rng.randrange(1, 12))) for k in range(12)]
    return docs, items + [items[0], (3, "unknown kan"), (None, "kan kan kan ro"), (50, None), (51, "!"), (52, "zzz")]


def _key(row):
    return tuple((v is None, v) for v in row)


@pytest.mark.parametrize("limit", [rs.BLOCK_CHARS, 60])
def test_ranks_equal_brute_force(spark, tables, limit):
    docs, items = tables
    d = spark.createDataFrame([(*r, 0.5) for r in docs], DOCS).repartition(6)
    i = spark.createDataFrame([(*r, "x") for r in items], ITEMS)
    assert limit > 60 or len(list(rs.blocks(i, limit))) > 2
    got = rs.search(d, i, limit=limit)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(plain(docs, items), key=_key)


def test_terms_are_whole():
    block = rs.Block([(1, {"a": 1, "ab": 1, "é": 1})])
    n, found, times = block.counts("A ab,abc a-AB é éa xa_a")
    assert n == 9 and {block.terms[k]: t for k, t in zip(found, times)} == {"a": 3, "ab": 2, "é": 1}


def test_empty_tables(spark):
    none_d, none_i = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some_d, some_i = spark.createDataFrame([(1, "a", 0.0)], DOCS), spark.createDataFrame([(1, "a", "x")], ITEMS)
    assert rs.report(none_d, some_i).collect() == rs.report(some_d, none_i).collect() == rs.report(none_d, none_i).collect() == []
    assert [tuple(r) for r in rs.report(some_d, some_i).collect()] == plain([(1, "a")], [(1, "a")])
