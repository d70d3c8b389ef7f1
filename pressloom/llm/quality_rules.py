"""Quality rules with a hashed n-gram log-likelihood ratio, with DataFrame operations only.

Rules on the text itself: characters in words, symbols, repeated lines, words inside repeated three-word windows.  The
verdict adds a ratio of two multinomials over hashed unigrams and bigrams: one of trusted documents, one of the whole
corpus.  A document's score is the mean of log(p_trusted / p_corpus) over its grams, so length cancels out.

The ratios shrink as a growing corpus fills the buckets, so the threshold follows from the scores of labelled documents, by
cross-fitting: the trusted counts are kept by fold, a document's fold being a hash of its number, and every document, labelled
or not, is scored with the counts of all folds but its own, so that none helps its own score.  The threshold comes from all
labelled documents: the cut with the smallest sum of the share of good ones below it and the share of bad ones not below it, in
the middle between two neighbouring scores, and of equally good cuts the one in the widest gap.  The scores are put in order by
ranges and their counts added up range by range.  Only documents that pass the base rules count.  Where either label is
missing, it is `DEFAULT`.

The corpus counts come from all documents: a sum per bucket with partial sums in each task, so what is shuffled is at most
`BUCKETS` rows per task.  The trusted side is fitted on all documents labelled 1; their numbers are broadcast up to
`MAX_BROADCAST` of them, and beyond that a shuffle brings them to the documents' hashes.  Each word is
hashed once per row, and words, pairs and windows are hashes of those.  Scoring is one pass over the documents without a
shuffle; the measures are written down, as both the threshold and the verdicts read them.

Edge cases: NULL and empty texts have no words, zero counts, base_failed true and kept false; an empty corpus or no trusted
label gives a model of zeros, so the base rules decide alone; repeated rows give a result row each; NULL doc_id is carried
through and is never trusted; a document labelled more than once is trusted if its smallest label is 1; other columns are
never looked at.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm import common
from pressloom.session import StepTables

BUCKETS = 1 << 16
#: Numbers of trusted documents that are broadcast, 8 bytes each.
MAX_BROADCAST = 2_000_000
SMOOTHING = 0.5
DEFAULT = -0.35
FOLDS = 8
#: Windows with equal hash bits but other words that may stand between two equal ones.
BETWEEN = 3
SYMBOLS = r"[#*$%&|<>]"


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id, q: the smallest label of each document."""
    return labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"))


def trusted_numbers(labels: DataFrame, limit: int = MAX_BROADCAST) -> DataFrame:
    """All numbers of documents labelled 1, marked for broadcast if there are at most `limit`."""
    good = known_labels(labels).where("q = 1").select("doc_id")
    return F.broadcast(good) if good.count() <= limit else good


def bucket(array: Column, at: Column, size: int, buckets: int = BUCKETS) -> Column:
    return F.pmod(common.gram_hash(array, at, size), F.lit(buckets)).cast("int")


def hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def fold(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("held out")), F.lit(FOLDS)).cast("int")


def bucket_counts(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, limit: int = MAX_BROADCAST) -> DataFrame:
    """bucket, corpus (grams of all documents), trusted (grams of trusted ones), fold_0, ... (those of each fold)."""
    good = trusted_numbers(labels, limit).withColumn("good", fold(F.col("doc_id")))
    marked = docs.select("doc_id", common.tokens("text").alias("w")).select("doc_id", hashes(F.col("w")).alias("h")).join(good, "doc_id", "left")
    step, word, n = F.col("step"), F.shiftright("step", 1), F.size("h")
    walk = marked.where(n > 0).select("h", "good", F.explode(F.sequence(F.lit(0), 2 * n - 2)).alias("step"))  # n words, n - 1 pairs
    b = F.when(step % 2 == 0, bucket(F.col("h"), word, 1, buckets)).otherwise(bucket(F.col("h"), word, 2, buckets))
    by_fold = walk.select(b.alias("bucket"), "good").groupBy("bucket", "good").agg(F.count("*").alias("n"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0).cast("long"))
    folds = [total(F.col("good") == k).alias(f"fold_{k}") for k in range(FOLDS)]
    return by_fold.groupBy("bucket").agg(F.sum("n").alias("corpus"), total(F.col("good").isNotNull()).alias("trusted"), *folds)


def model(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row: llr, the array of log ratios by bucket, and without, such an array for each fold that is left out, which is
    what documents of that fold are scored with; zeros where nothing is trusted."""
    every = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    known = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    sides = {"trusted": F.col("trusted")} | {f"without_{k}": F.col("trusted") - F.col(f"fold_{k}") for k in range(FOLDS)}
    entry = F.struct("bucket", known(F.col("corpus")).alias("corpus"), *[known(c).alias(k) for k, c in sides.items()])
    sums = every.agg(known(F.sum("corpus")).alias("all"), *[known(F.sum(c)).alias(k) for k, c in sides.items()], F.array_sort(F.collect_list(entry)).alias("by"))
    share = lambda c, total: (c + smoothing) / (F.col(total) + smoothing * buckets)
    values = lambda k: F.transform("by", lambda e: F.log(share(e[k], k) / share(e["corpus"], "all")).cast("float"))
    ratios = lambda k: F.when(F.col(k) > 0, values(k)).otherwise(F.array_repeat(F.lit(0.0).cast("float"), buckets))
    return sums.select(ratios("trusted").alias("llr"), F.array(*[ratios(f"without_{k}") for k in range(FOLDS)]).alias("without"))


def packed_windows(w: Column, mask: Column) -> Column:
    """Hash (high bits) and place (low bits, as many as the length needs) of each three-word window in one long, sorted; `w`
    are the words' hashes."""
    window = lambda i: common.gram_hash(w, i, 3).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))
    places = F.when(F.size(w) > 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.transform(places, window))


def repeated_words(w: Column, packed: Column, mask: Column) -> Column:
    """Words that lie in a three-word window which the text holds twice or more.

    Sorting has put windows of equal hash bits side by side; up to `BETWEEN` others of the same bits between two equal ones
    are looked past, and equality is that of the words.  All three arguments must be plain columns, as they are read once per
    element.
    """
    place = lambda x: x.bitwiseAND(mask).cast("int")
    near = lambda x, y: F.coalesce(x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(mask)) == 0, F.lit(False))
    equal = lambda x, y: (F.get(w, place(x)) == F.get(w, place(y))) & (F.get(w, place(x) + 1) == F.get(w, place(y) + 1)) & (F.get(w, place(x) + 2) == F.get(w, place(y) + 2))

    def same(x: Column, k: Column, step: int, far: int = 1) -> Column:
        y = F.get(packed, k + step * far)
        further = [same(x, k, step, far + 1)] if far <= BETWEEN else []
        found = equal(x, y)
        for more in further:
            found = found | more
        return near(x, y) & found

    twice = F.filter(packed, lambda x, k: same(x, k, 1) | same(x, k, -1))
    return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(place(x), place(x) + 1, place(x) + 2)))))


def best_cut(good: list[float], bad: list[float], default: float = DEFAULT) -> float:
    """The cut with the smallest sum of both shares on the wrong side; of equal ones that in the widest gap."""
    if not good or not bad:
        return default
    scores = sorted({*good, *bad})
    n_good, n_bad = Counter(good), Counter(bad)
    best, below_good, below_bad = ((1.0, 0.0), scores[0]), 0, 0
    for low, high in zip(scores, scores[1:]):
        below_good, below_bad = below_good + n_good[low], below_bad + n_bad[low]
        wrong = below_good / len(good) + (len(bad) - below_bad) / len(bad)
        best = min(best, ((wrong, low - high), (low + high) / 2))
    return best[1]


def counted_cut(scores: DataFrame, steps: StepTables, default: float = DEFAULT) -> float:
    """What `best_cut` gives, for a table (q, mean_llr) of any size.

    Distinct scores are range-partitioned, sorted and written down; what the earlier ranges hold and the first score of the next
    one are added to each range, by windows over one row per range.
    """
    n = lambda q: F.sum((F.col("q") == q).cast("long"))
    per_score = scores.groupBy("mean_llr").agg(n(1).alias("good"), n(0).alias("bad"))
    ranged = per_score.repartitionByRange("mean_llr").sortWithinPartitions("mean_llr").withColumn("range", F.spark_partition_id())
    ranged = steps.save(ranged, "scores")
    heads = ranged.groupBy("range").agg(F.min("mean_llr").alias("first"), F.sum("good").alias("range_good"), F.sum("bad").alias("range_bad"))
    order = Window.orderBy("range")  # one row per range
    before = lambda c: F.coalesce(F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = [F.sum(f"range_{c}").over(every).alias(f"n_{c}") for c in ("good", "bad")]
    heads = heads.select("range", F.lead("first").over(order).alias("next"), F.min("first").over(every).alias("least"), *[before(f"range_{c}").alias(f"before_{c}") for c in ("good", "bad")], *totals)
    inside = Window.partitionBy("range").orderBy("mean_llr")  # a range
    below = lambda c: F.col(f"before_{c}") + F.sum(c).over(inside)
    cuts = ranged.join(F.broadcast(heads), "range").select("n_good", "n_bad", "least", below("good").alias("below_good"), below("bad").alias("below_bad"), F.col("mean_llr").alias("low"), F.coalesce(F.lead("mean_llr").over(inside), "next").alias("high"))
    wrong = F.col("below_good") / F.col("n_good") + (F.col("n_bad") - F.col("below_bad")) / F.col("n_bad")
    cuts = cuts.where("n_good > 0 AND n_bad > 0")
    # The last score has no cut above it; its row stands for keeping all.
    cut = F.struct(F.when(F.col("high").isNull(), 1.0).otherwise(wrong).alias("wrong"), F.coalesce(F.col("low") - F.col("high"), F.lit(0.0)).alias("gap"), F.coalesce((F.col("low") + F.col("high")) / 2, "least").alias("at"))
    found = cuts.agg(F.min(cut)["at"]).first()[0]
    return default if found is None else found


def fitted_threshold(measured: DataFrame, labels: DataFrame, steps: StepTables) -> float:
    """The best cut through the scores of all labelled documents, each counted once; `measured` is written down."""
    one = measured.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.struct("base_failed", "mean_llr")).alias("one"))
    known = known_labels(labels).where("q IN (0, 1)")
    return counted_cut(one.join(known, "doc_id").where("NOT one.base_failed").select("q", "one.mean_llr"), steps)


def report(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The measures of every document row and `kept`.

    The measures are written down: a filter on them that Spark pushes below would compute a text's windows anew for each of
    its words.
    """
    steps = StepTables(docs.sparkSession, "quality-rules")
    models = steps.save(model(bucket_counts(docs, labels)), "models")
    measured = steps.save(measures(docs, F.get(models.select("without").scalar(), fold(F.col("doc_id")))), "measures")
    least = fitted_threshold(measured, labels, steps) if threshold is None else threshold
    return measured.withColumn("kept", ~F.col("base_failed") & (F.col("mean_llr") >= least))


def measures(docs: DataFrame, fitted: Column) -> DataFrame:
    text, w, n = common.whole("text"), F.col("w"), F.size("w")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    read = docs.select("doc_id", text.alias("text"), common.tokens("text").alias("w"), lines.alias("lines"))
    bits = F.ceil(F.log2(n + F.lit(1))).cast("int")
    read = read.withColumn("mask", F.pow(F.lit(2.0), bits).cast("long") - 1).withColumn("h", hashes(w))
    read = read.withColumn("packed", packed_windows(F.col("h"), F.col("mask")))
    one = lambda i: F.get(F.col("llr"), bucket(F.col("h"), i, 1))
    two = lambda i: F.when(i < n - 1, F.get(F.col("llr"), bucket(F.col("h"), i, 2))).otherwise(F.lit(0.0))
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda acc, i: acc + one(i) + two(i))
    measured = read.withColumn("llr", fitted).select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(w, F.col("packed"), F.col("mask")).cast("long").alias("n_repeat_words"),
        F.when(n == 0, F.lit(0.0)).otherwise(total / F.greatest(2 * n - 1, F.lit(1))).alias("mean_llr"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)
