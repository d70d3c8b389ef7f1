import random

import pytest
from pyspark.sql import functions as F

from pressloom.llm import quality_rules


def test_best_cut():
    assert quality_rules.best_cut([0.0, 0.2], [-0.4, -0.2]) == pytest.approx(-0.1)
    assert quality_rules.best_cut([], [1.0]) == quality_rules.best_cut([1.0], []) == quality_rules.DEFAULT


@pytest.mark.parametrize("count", [300, 1500, 4000])
def test_kept_by_label(spark, count):
    """Good and bad texts over words that overlap in part: few of the bad pass at any size."""
    rng = random.Random(count)
    shared, own = [f"s{k}" for k in range(3000)], {q: [f"{q}w{k}" for k in range(600)] for q in (0, 1)}
    text = lambda q: " ".join(rng.choice(own[q] if rng.random() < 0.2 else shared) for _ in range(120))
    docs = spark.createDataFrame([(k, text(k % 2)) for k in range(count)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(0, count // 2)], "doc_id long, quality int, toxic int")
    got = quality_rules.report(docs, labels).collect()
    kept = {q: sum(r["kept"] for r in got if r["doc_id"] % 2 == q) / (count / 2) for q in (0, 1)}
    assert kept[0] < 0.1 and kept[1] > 0.9


def test_left_out_counts(spark):
    """A document's own words are not in the counts that it is scored with."""
    docs = spark.createDataFrame([(k, f"only{k} " * 60) for k in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(12)], "doc_id long, quality int, toxic int")
    counts = quality_rules.bucket_counts(docs, labels)
    assert all(r["trusted"] == sum(r[f"fold_{k}"] for k in range(quality_rules.FOLDS)) == r["corpus"] for r in counts.collect())
    models = quality_rules.model(counts)
    scored = quality_rules.measures(docs, F.get(models.select("without").scalar(), quality_rules.fold(F.col("doc_id")))).collect()
    assert all(r["mean_llr"] < -1 for r in scored)
    assert all(r["mean_llr"] > -0.1 for r in quality_rules.measures(docs, models.select("llr").scalar()).collect())


def test_repeats_behind_windows_of_the_same_bits(spark):
    """Equal windows with another one of equal hash bits between them are still found."""
    w = ["a", "b", "c", "x", "y", "z", "a", "b", "c"]
    bits = 1 << 10
    packed = [bits + 0, bits + 3, bits + 6, 2 * bits + 1]
    row = spark.createDataFrame([(w, packed, 15)], "w array<string>, packed array<long>, mask long")
    assert row.select(quality_rules.repeated_words(F.col("w"), F.col("packed"), F.col("mask"))).first()[0] == 6


def test_threshold_and_trusted_side_from_all_labels(spark, tmp_path):
    """The cut over a table is that of the plain lists, with no limit on the labels, which are found with and without a broadcast."""
    from pressloom.session import StepTables

    rng = random.Random(8)
    rows = [(q, round(rng.gauss(0.3 * q, 0.4), 3)) for q in (0, 1) for _ in range(3000 + 2500 * q)] + [(0, 9.5)]
    steps = StepTables(spark, "cuts")
    for some in (rows, rows[:1], rows[:50] + rows[-50:], [(1, 0.0), (0, 1.0), (1, 2.0)], [(1, 5.0), (0, 5.0)], []):
        want = quality_rules.best_cut([x for q, x in some if q], [x for q, x in some if not q])
        table = spark.createDataFrame(some, "q int, mean_llr double").repartition(3)
        assert quality_rules.counted_cut(table, steps) == pytest.approx(want, abs=1e-12)
    labels = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    docs = labels.select("doc_id", F.lit("a b").alias("text"))
    for limit in (10, 10**6):
        counts = quality_rules.bucket_counts(docs, labels, limit=limit).collect()
        assert sum(r["trusted"] for r in counts) == sum(r["corpus"] for r in counts) == 90_000
    steps.close()
