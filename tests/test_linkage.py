"""TF-IDF, the similarity join and average linkage against brute force on small inputs."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressloom.operators import features, linkage, similarity
from pressloom.session import StepTables


def plain_vectors(texts, ngram_range=(1, 2), min_df=2, max_df=0.8, stopwords=()):
    counts = []
    for t in texts:
        words = [w for w in re.findall(r"\w{2,}", t.lower()) if w not in stopwords]
        terms = []
        for n in range(ngram_range[0], ngram_range[1] + 1):
            terms += [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        counts.append(Counter(terms))
    df = Counter(t for c in counts for t in c)
    kept = {t for t, f in df.items() if min_df <= f <= max_df * len(texts)}
    out = []
    for c in counts:
        v = {t: f * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, f in c.items() if t in kept}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({t: x / norm for t, x in v.items()})
    return out


def plain_clusters(vectors, threshold):
    """One merge at a time over the full matrix of mean distances; nearest pair first, ties by smaller ids."""
    dot = lambda p, q: sum(x * q.get(t, 0.0) for t, x in p.items())
    members = {i: [i] for i in range(len(vectors))}
    sim = {(i, j): dot(vectors[i], vectors[j]) for i in members for j in members if i < j}
    while True:
        best = min(
            ((round(1 - s / (len(members[a]) * len(members[b])), 12), a, b) for (a, b), s in sim.items()), default=None
        )
        if best is None or best[0] >= threshold:
            break
        _, a, b = best
        members[a] += members.pop(b)
        for c in members:
            if c != a:
                key = (min(a, c), max(a, c))
                sim[key] += sim[(min(b, c), max(b, c))]
        sim = {k: s for k, s in sim.items() if b not in k}
    return {m: min(ms) for ms in members.values() for m in ms}


def random_titles(rng, n, words, copies=0.2):
    vocab = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    out = []
    for _ in range(n):
        if out and rng.random() < copies:
            t = rng.choice(out)
            out.append(t if rng.random() < 0.5 else f"{t} only{rng.random()}")
        else:
            out.append(" ".join(rng.choices(vocab, weights, k=rng.randint(1, 7))))
    return out


def spark_docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text_for_cluster string")


@pytest.mark.parametrize("seed", range(3))
def test_tfidf(spark, seed):
    rng = random.Random(seed)
    texts = random_titles(rng, 30, 15) + ["zz"]
    got = features.tfidf(spark_docs(spark, texts), stopwords=["w3"], ngram_range=(1, 3), max_df=0.6).collect()
    want = plain_vectors(texts, (1, 3), 2, 0.6, {"w3"})
    assert {(r.doc_id, r.term): round(r.w, 9) for r in got} == {
        (i, t): round(x, 9) for i, v in enumerate(want) for t, x in v.items()
    }


@pytest.mark.parametrize("seed,min_sim,block", [(0, 0.17, 256), (1, 0.17, 3), (2, 0.5, 2), (3, 0.0, 4), (4, 0.9, 5)])
def test_similar_pairs(spark, seed, min_sim, block):
    texts = random_titles(random.Random(seed), 60, 12)
    vectors = plain_vectors(texts, max_df=1.0)
    df = Counter(t for v in vectors for t in v)
    rank = {t: i for i, t in enumerate(sorted(df, key=lambda t: (df[t], t)))}
    rows = [(i, sorted((rank[t], x) for t, x in v.items())) for i, v in enumerate(vectors)]
    steps = StepTables(spark, "test")
    df = spark.createDataFrame(rows, "doc long, v array<struct<tid: long, w: double>>")
    indexed = steps.save(similarity.index_vectors(df, min_sim), "vectors")
    got = similarity.similar_pairs(indexed, "doc", min_sim, steps, block_rows=block).collect()
    want = {}
    for i, p in enumerate(vectors):
        for j in range(i + 1, len(vectors)):
            s = sum(x * vectors[j].get(t, 0.0) for t, x in p.items())
            if s > min_sim:
                want[(i, j)] = round(s, 9)
    assert len(got) == len({(r.a, r.b) for r in got})
    assert {(r.a, r.b): round(r.sim, 9) for r in got} == want


@pytest.mark.parametrize("seed", range(6))
def test_average_linkage(spark, seed):
    rng = random.Random(100 + seed)
    texts = random_titles(rng, rng.randint(25, 60), rng.choice([8, 20, 40])) + ["solo", "solo", ""]
    rng.shuffle(texts)
    threshold = rng.choice([0.5, 0.7, 0.83, 0.85, 1.0])
    docs = spark_docs(spark, texts)
    # Large components go through rounds: none, all down to pairs, or those of more than a few clusters.
    limit = (1000, 1, 4)[seed % 3]
    out = linkage.average_linkage(docs, threshold=threshold, max_df=0.75, block_rows=7, component=limit).collect()
    got = {r.doc_id: r.cluster for r in out}
    assert got == plain_clusters(plain_vectors(texts, max_df=0.75), threshold)


def test_average_linkage_edge_inputs(spark):
    empty = spark.createDataFrame([], "doc_id long, text_for_cluster string")
    assert linkage.average_linkage(empty).collect() == []
    lonely = spark_docs(spark, ["a lonely headline"])
    assert [(r.doc_id, r.cluster) for r in linkage.average_linkage(lonely).collect()] == [(0, 0)]
    for threshold in (0, -1, 1.2):
        with pytest.raises(ValueError):
            linkage.average_linkage(lonely, threshold=threshold)


def test_hot_term_is_split_and_complete(spark):
    """A third of the rows share one term and little else; every pair above the cut is still found once."""
    texts = [f"breaking x{i} x{i % 7} y{i % 11}" for i in range(90)] + [f"q{i} r{i % 13} s{i % 17}" for i in range(180)]
    vectors = plain_vectors(texts, max_df=1.0)
    want = plain_clusters(vectors, 0.83)
    out = linkage.average_linkage(spark_docs(spark, texts), threshold=0.83, max_df=1.0, block_rows=8).collect()
    assert {r.doc_id: r.cluster for r in out} == want


def test_words_and_ngrams(spark):
    df = spark.createDataFrame([("The <NUM> big, b Cat",), ("one",), ("",)], "t string")
    rows = df.select(
        features.ngrams(features.words(F.col("t")), 1, 2).alias("g"),
        features.ngrams(features.words(F.col("t"), ["big"]), 2, 3).alias("h"),
    ).collect()
    assert [list(r.g) for r in rows] == [["the", "num", "big", "cat", "the num", "num big", "big cat"], ["one"], []]
    assert [list(r.h) for r in rows] == [["the num", "num cat", "the num cat"], [], []]


@pytest.mark.parametrize("wider,dense_from", [(1, 1), (2, 5), (10**6, 4000)])
def test_similar_pairs_by_blocks_of_all_rows(spark, monkeypatch, wider, dense_from):
    """Vectors with many shared leading terms: blocks of rows give the pairs of the comparison with all, copies beside them."""
    monkeypatch.setattr(similarity, "_WIDER", wider)
    monkeypatch.setattr(similarity, "_DENSE_FROM", dense_from)
    monkeypatch.setattr(similarity, "_DENSE", 6)
    monkeypatch.setattr(similarity, "_PRODUCTS_AT_ONCE", 300)
    taken, blocks = [], similarity._pairs_of_blocks
    monkeypatch.setattr(similarity, "_pairs_of_blocks", lambda *a: taken.append(a[1]) or blocks(*a))
    rng = random.Random(wider)
    vectors = [{t: rng.random() for t in rng.sample(range(25), 8)} for _ in range(70)] + [{}]
    vectors = [{t: x / math.sqrt(sum(y * y for y in v.values())) for t, x in v.items()} for v in vectors]
    rows = [(1000 - i, i + 1, sorted(v.items())) for i, v in enumerate(vectors)]
    steps = StepTables(spark, "test")
    df = spark.createDataFrame(rows, "doc long, n long, v array<struct<tid: long, w: double>>")
    got = similarity.similar_pairs(steps.save(similarity.index_vectors(df, 0.4), "vectors"), "doc", 0.4, steps, block_rows=6, copies="n").collect()
    want = {}
    for i, p in enumerate(vectors):
        for j in range(i):
            s = sum(x * vectors[j].get(t, 0.0) for t, x in p.items())
            if s > 0.4:
                want[(1000 - i, 1000 - j)] = (round(s, 9), i + 1, j + 1)
    assert len(got) == len(want) and {(r.a, r.b): (round(r.sim, 9), r.copies_a, r.copies_b) for r in got} == want
    assert taken and (taken[0] > 1) == (wider < 10**6)
    steps.close()


def test_a_long_chain_takes_few_levels(spark):
    """Each link of a chain is weaker than the one before it, so only two of its clusters are each other's nearest at a time."""
    n, link = 40, lambda i: 0.45 - 0.006 * i
    entries = []
    for i in range(n):
        sides = [(100 + i - 1, link(i - 1))] * (i > 0) + [(100 + i, link(i))]
        entries += [(i, tid, math.sqrt(x)) for tid, x in sides] + [(i, 1000 + i, math.sqrt(1 - sum(x for _, x in sides)))]
    sums = spark.createDataFrame(entries, "c long, tid long, s double")
    edges = spark.createDataFrame([(i, i + 1, 1, 1, link(i)) for i in range(n - 1)], "a long, b long, na long, nb long, s double")

    class Counted(StepTables):
        names = []

        def save(self, df, name):
            self.names.append(name)
            return super().save(df, name)

    got = linkage._merge_rounds(edges, sums, 0.83, Counted(spark, "test"), 20).collect()
    assert {(r.old, r.new) for r in got} == {(i + 1, i) for i in range(0, n, 2)}
    assert Counted.names.count("sums") < 6
