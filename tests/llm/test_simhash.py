import random

import numpy as np
import pytest
import xxhash

from pressloom.llm import simhash


def plain_fingerprint(text):
    words = [w for w in (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=4):
    """component id by position, rows being (doc_id, fingerprint)."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(rows))]


def near_texts(seed, count):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 60, 400]))] for _ in range(max(count // 6, 1))]
    texts = [None, "", " \n\t ", "One", "one", "A b c", "ÄÖ é ß"]
    while len(texts) < count:
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(rng.choice([" ", "\n"]).join(words))
    return texts


def test_fingerprint_is_the_majority_of_shingle_bits():
    for text in near_texts(1, 60):
        assert simhash.fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)
    assert simhash.fingerprint("x " * 70_000) == simhash.fingerprint("x x x x")


@pytest.mark.parametrize("limit", [4, 4096])
def test_groups_match_all_pairs(spark, limit):
    rng = random.Random(limit)
    texts = near_texts(limit, 150)
    ids = [None if i % 17 == 5 else i // 2 if i % 11 == 0 else i for i in range(len(texts))]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in zip(ids, texts)], "doc_id long, text string, fp string, root int").repartition(5)
    prints, named = simhash.groups(docs, limit=limit)
    got = prints.join(named, "fp").select("doc_id", "fp", "component_id").collect()
    want = [(d, plain_fingerprint(t)) for d, t in zip(ids, texts)]
    expected = sorted(repr((d, f, c)) for (d, f), c in zip(want, plain_groups(want)))
    assert sorted(repr((r[0], r[1] & (2**64 - 1), r[2])) for r in got) == expected


def test_shards_find_every_close_pair(spark):
    """Dense balls of fingerprints, larger than a shard, so that both kinds of splitting run."""
    rng = random.Random(3)
    values = set()
    for center in (0, (1 << 64) - 1, rng.getrandbits(64)):
        for _ in range(60):
            value = center
            for _ in range(rng.randrange(9)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    units = simhash.shards(spark.createDataFrame([(v,) for v in signed], "fp long"), limit=8)
    edges = simhash.links(units).collect()
    parent = {v: v for v in signed}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for e in edges:
        parent[find(e["a"])] = find(e["b"])
    want = plain_groups(list(enumerate(values)))
    assert [find(a) == find(b) for a in signed for b in signed] == [x == y for x in want for y in want]


def test_tree_search_equals_comparison_with_all():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 6)).astype(np.uint64)
    values = np.unique(np.concatenate([base, *(base ^ flips[:, k] for k in range(6)), base ^ flips[:, 0] ^ flips[:, 1]]))
    root = np.zeros(len(values), np.int64)
    keys, children = simhash.build(values, root)
    found = {(int(q), int(n)) for a, b in simhash.search(values, root, keys, children, 4, 50) for q, n in zip(a, b)}
    everything = {(i, j) for i in range(len(values)) for j in range(i) if int(values[i] ^ values[j]).bit_count() <= 4}
    assert found == everything


def test_one_of_each_and_empty_input(spark):
    rows = [(3, "a b c d e f", "p"), (1, "a b c d e f", "q"), (1, "a b c d e f", "q"), (9, "z y x w v u t", "r"), (None, None, None), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["kept"] or "") for r in kept.collect()) == [(-1, ""), (1, "q"), (9, "r")]
    empty = docs.where("false")
    assert simhash.report(empty).collect() == [] and simhash.one_of_each(empty).collect() == []
