"""Token counts as an exact length histogram.

Documents are aggregated by encoded length; nothing larger than the histogram is kept afterwards.  Suffix sums over it give,
for every context limit, the documents and tokens at or above it, hence totals, quantiles and what is left of the corpus
when each document is truncated to the limit.

Each document is encoded where it is read.  The histogram is a partial sum per length, so a task shuffles at most one row
per length it has seen.  Suffix sums run in two levels, within blocks of `BLOCK` lengths and over the block sums, so no task
sorts the whole histogram.

Edge cases: NULL and empty texts have length 0; repeated rows count each; an empty table gives an empty histogram, and
`truncated_total` and `quantiles` of it give NULL; other columns are not looked at.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pressloom.llm import common, tokenizer_files
from pressloom.session import StepTables

BLOCK = 1024


def encoded_lengths(docs: DataFrame, vocabulary: str = tokenizer_files.BPE_RANKS) -> DataFrame:
    """docs with the column `length`."""
    common.small_batches(docs.sparkSession)

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(tokenizer_files.encode(t, vocabulary)) for t in texts], dtype="int64")

    return docs.withColumn("length", count(common.whole("text")))


def histogram(lengths: DataFrame) -> DataFrame:
    """length, n_docs, n_tokens; and n_docs_up, n_tokens_up over all documents of this length or more."""
    counts = lengths.groupBy("length").agg(F.count("*").alias("n_docs"))
    counted = StepTables(lengths.sparkSession, "lengths").save(counts, "counts")  # so that texts are encoded once
    counted = counted.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.expr(f"length div {BLOCK}"))
    blocks = counted.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens"))
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)  # one row per BLOCK lengths
    offsets = blocks.select("block", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("docs", "tokens")])
    inside = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return counted.join(offsets, "block").select(
        "length",
        "n_docs",
        "n_tokens",
        (F.sum("n_docs").over(inside) + F.col("docs_above")).alias("n_docs_up"),
        (F.sum("n_tokens").over(inside) + F.col("tokens_above")).alias("n_tokens_up"),
    )


def at_limits(hist: DataFrame) -> DataFrame:
    """The histogram, and with each length as the context limit: truncated_tokens kept, cut_docs and cut_tokens lost, and
    rank_low, rank_high: the documents of this length stand at these places (from 1) in the order of length."""
    every = F.col("n_docs_all")
    totals = hist.agg(F.sum("n_docs").alias("n_docs_all"), F.sum("n_tokens").alias("n_tokens_all"))
    longer_docs, longer_tokens = F.col("n_docs_up") - F.col("n_docs"), F.col("n_tokens_up") - F.col("n_tokens")
    cut = longer_tokens - F.col("length") * longer_docs
    both = hist.withColumn("n_docs_all", totals.select("n_docs_all").scalar()).withColumn("n_tokens_all", totals.select("n_tokens_all").scalar())
    return both.select(
        *hist.columns,
        (F.col("n_tokens_all") - cut).alias("truncated_tokens"),
        longer_docs.alias("cut_docs"),
        cut.alias("cut_tokens"),
        (every - F.col("n_docs_up") + 1).alias("rank_low"),
        (every - longer_docs).alias("rank_high"),
    )


def truncated_total(hist: DataFrame, limit: int) -> DataFrame:
    """One row: tokens left if every document is cut to `limit` tokens, for any limit, also one that no document has."""
    n = F.col("n_docs")
    return hist.agg(F.sum(F.least(F.col("length"), F.lit(limit)) * n).alias("n_tokens"), F.sum(F.when(F.col("length") > limit, n).otherwise(0)).alias("cut_docs"))


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of the documents does not exceed."""
    ranked = at_limits(hist)
    asked = [F.min(F.when(F.col("rank_high") >= F.ceil(F.lit(q) * (F.col("n_docs_up") + F.col("rank_low") - 1)), F.col("length"))).alias(str(k)) for k, q in enumerate(shares)]
    row = ranked.agg(*asked)
    return row.select(F.explode(F.array(*[F.struct(F.lit(q).alias("share"), F.col(str(k)).alias("length")) for k, q in enumerate(shares)])).alias("r")).select("r.*")


def report(docs: DataFrame) -> DataFrame:
    return at_limits(histogram(encoded_lengths(docs.select("text"))))
