"""How outlets cover the same events: overlap, volume, lag, headline lengths, and coverage by day.

Every operator starts with partial sums or minima per (event, outlet), (outlet, day) or (outlet, length), so an outlet or an
event that holds a third of all articles costs a row per task.  Windows and lists come after that; they run over the outlets
of one event, the days of one outlet or the lengths of one outlet.  An article without an outlet counts under "", one without
an event number belongs to no event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions.text import blank_if_null
from pressloom.functions.timestamps import utc_iso
from pressloom.operators.features import words
from pressloom.session import StepTables

PERCENTS = (10, 25, 50, 75, 90)
TEXTS = ("title", "summary")


def _outlet() -> Column:
    return blank_if_null(F.col("source")).alias("source")


def _words(fields: Sequence[str]) -> Column:
    return words(F.concat_ws(" ", *[blank_if_null(F.col(f)) for f in fields]))


def _zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0).cast("long"))


def outlet_overlap(articles: DataFrame, cluster: str = "cluster", fields: Sequence[str] = TEXTS) -> DataFrame:
    """(cluster, a, b, words_a, words_b, shared, jaccard, cosine) of every two outlets a < b of an event.

    Words are lower-case runs of two or more word characters.  `jaccard` compares the outlets' sets of words, `cosine` their
    counts, summed over the outlet's articles; both are 0 where an outlet has no words.  A word of an event is a list of the
    outlets that use it, and each two of them share it, so articles are never paired.
    """
    steps = StepTables(articles.sparkSession, "overlap")
    rows = articles.where(F.col(cluster).isNotNull())
    cut = rows.select(F.col(cluster).alias("cluster"), _outlet(), F.explode(_words(fields)).alias("word"))
    counts = steps.save(cut.groupBy("cluster", "source", "word").agg(F.count("*").alias("tf")), "counts")
    # At most one entry per outlet in a list.
    lists = counts.groupBy("cluster", "word").agg(F.array_sort(F.collect_list(F.struct("source", "tf"))).alias("held"))
    both = _pairs(lists, "held").groupBy("cluster", F.col("x.source").alias("a"), F.col("y.source").alias("b"))
    sums = both.agg(F.count("*").alias("shared"), F.sum(F.col("x.tf") * F.col("y.tf")).alias("dot"))
    own = counts.groupBy("cluster", "source").agg(F.count("*").alias("words"), F.sum(F.col("tf") * F.col("tf")).alias("square"))
    outlets = rows.select(F.col(cluster).alias("cluster"), _outlet()).groupBy("cluster").agg(F.array_sort(F.collect_set("source")).alias("held"))
    found = _pairs(outlets, "held").select("cluster", F.col("x").alias("a"), F.col("y").alias("b")).join(sums, ["cluster", "a", "b"], "left")
    for side in "ab":
        found = found.join(own.toDF("cluster", side, f"words_{side}", f"square_{side}"), ["cluster", side], "left")
    union = _zero("words_a") + _zero("words_b") - _zero("shared")
    length = F.sqrt(F.col("square_a").cast("double")) * F.sqrt(F.col("square_b").cast("double"))
    return found.select(
        *("cluster", "a", "b"),
        *[_zero(c).alias(c) for c in ("words_a", "words_b", "shared")],
        F.when(union > 0, _zero("shared") / union).otherwise(0.0).alias("jaccard"),
        F.coalesce(_zero("dot") / length, F.lit(0.0)).alias("cosine"),
    )


def _pairs(lists: DataFrame, column: str) -> DataFrame:
    """(cluster, x, y) for every two elements of the lists, the earlier one first."""
    first = lists.select("cluster", column, F.posexplode(column).alias("at", "x"))
    return first.select("cluster", "x", F.explode(F.slice(column, F.col("at") + 2, F.size(column))).alias("y"))


def event_volume(articles: DataFrame, cluster: str = "cluster", fields: Sequence[str] = TEXTS) -> DataFrame:
    """(level, cluster, source, articles, words, article_share, word_share): what each outlet gives to each event.

    Level "outlet" is an outlet of an event, with its shares of the event; "event" the whole event, with its shares of all;
    "all" everything.  One rollup makes the three levels, and each takes the total above from it by a window, without a join.
    """
    rows = articles.where(F.col(cluster).isNotNull())
    cut = rows.select(F.col(cluster).alias("cluster"), _outlet(), F.size(_words(fields)).alias("words"))
    per = cut.groupBy("cluster", "source").agg(F.count("*").alias("articles"), F.sum("words").alias("words"))
    rolled = per.rollup("cluster", "source").agg(F.grouping_id().alias("g"), F.sum("articles").alias("articles"), F.sum("words").alias("words"))
    named = rolled.withColumn("level", F.element_at(F.create_map(F.lit(0), F.lit("outlet"), F.lit(1), F.lit("event"), F.lit(3), F.lit("all")), F.col("g").cast("int")))
    everything = rolled.where("g = 3").select(F.struct("articles", "words").alias("whole")).scalar()
    over = Window.partitionBy("cluster")  # the outlets of one event
    event = lambda c: F.max(F.when(F.col("g") == 1, F.col(c))).over(over)
    whole = lambda c: F.when(F.col("g") == 0, event(c)).otherwise(F.col("_all")[c])
    shared = named.withColumn("_all", everything).withColumns({f"_{c}": whole(c) for c in ("articles", "words")})
    share = lambda c, name: F.when(F.col(f"_{c}") > 0, F.col(c) / F.col(f"_{c}")).otherwise(0.0).alias(name)
    return shared.select("level", "cluster", "source", "articles", "words", share("articles", "article_share"), share("words", "word_share"))


def first_publisher_lag(articles: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, source, first_at, place, lag_first, lag_previous): the order in which outlets took up an event.

    `_dt` is the time of an article.  Lags are whole seconds to the event's first outlet and to the one before; an outlet
    without a dated article has no place and no lags; outlets of the same time stand by name.
    """
    firsts = articles.where(F.col(cluster).isNotNull()).groupBy(F.col(cluster).alias("cluster"), _outlet()).agg(F.min("_dt").alias("first"))
    order = Window.partitionBy("cluster").orderBy(F.asc_nulls_last("first"), "source")  # the outlets of one event
    at = F.unix_micros("first")
    lag = lambda before: F.floor((at - before) / 1_000_000)
    return firsts.select(
        "cluster",
        "source",
        utc_iso(F.col("first")).alias("first_at"),
        F.when(F.col("first").isNotNull(), F.row_number().over(order)).alias("place"),
        lag(F.first(at).over(order)).alias("lag_first"),
        lag(F.lag(at).over(order)).alias("lag_previous"),
    )


def headline_lengths(articles: DataFrame, percents: Sequence[int] = PERCENTS) -> DataFrame:
    """(source, articles, shortest, longest, mean, p10, ...): lengths of titles in characters, per outlet.

    A quantile is the smallest length that at least this percentage of the outlet's titles does not exceed.  The articles are
    first counted by outlet and length, so what is ordered is the lengths of an outlet, not its articles.  A NULL title has
    length 0.
    """
    lengths = articles.select(_outlet(), F.char_length(blank_if_null(F.col("title"))).alias("length"))
    counts = lengths.groupBy("source", "length").agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("source").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("source", "length", "n", F.sum("n").over(up_to).alias("below"), F.sum("n").over(Window.partitionBy("source")).alias("all"))
    reached = lambda p: F.min(F.when(F.col("below") * 100 >= F.col("all") * p, F.col("length"))).alias(f"p{p}")
    return ranked.groupBy("source").agg(
        F.sum("n").alias("articles"),
        F.min("length").alias("shortest"),
        F.max("length").alias("longest"),
        (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean"),
        *[reached(p) for p in percents],
    )


def coverage_grid(articles: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(level, source, day, articles, events, running_articles, running_share): coverage by outlet and day.

    Level "cell" is an outlet on a day, for every outlet and every day from the first to the last, with zeros; "day" all
    outlets on a day; "outlet" an outlet on all days; "all" everything.  `events` counts distinct event numbers.  Running
    numbers go from the first day on: articles so far, and the outlet's share of all articles so far.  Undated articles have
    the day NULL on the levels "cell" and "day", where there are any, and no running numbers.
    """
    steps = StepTables(articles.sparkSession, "coverage")
    rows = articles.select(_outlet(), F.to_date("_dt").alias("day"), F.col(cluster).alias("cluster"))
    per = rows.groupBy("source", "day", "cluster").agg(F.count("*").alias("n"))
    cube = per.cube("source", "day").agg(F.grouping_id().alias("g"), F.sum("n").alias("articles"), F.count_distinct("cluster").alias("events"))
    cube = steps.save(cube, "cube")  # outlets times days
    names = ("cell", "outlet", "day", "all")
    level = F.element_at(F.array(*map(F.lit, names)), F.col("g").cast("int") + 1).alias("level")
    ends = cube.where("g = 2 AND day IS NOT NULL").select(F.struct(F.min("day").alias("low"), F.max("day").alias("high")).alias("ends")).scalar()
    # Each outlet, and all of them together, with every day.
    outlets = cube.where("g IN (1, 3)").select("source", (F.col("g") - 1).alias("g")).withColumn("_ends", ends).where("_ends.low IS NOT NULL")
    grid = outlets.select("source", "g", F.explode(F.sequence("_ends.low", "_ends.high")).alias("day"))
    counted = cube.where("g IN (0, 2)").select(F.col("source").alias("_s"), F.col("g").alias("_g"), F.col("day").alias("_d"), "articles", "events")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("g") == F.col("_g")) & (F.col("day") == F.col("_d"))
    dense = grid.join(counted, same, "left").select("source", "g", "day", _zero("articles").alias("articles"), _zero("events").alias("events"))
    so_far = F.sum("articles").over(Window.partitionBy("source", "g").orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    running = dense.withColumn("running_articles", so_far)
    on_day = F.max(F.when(F.col("g") == 2, F.col("running_articles"))).over(Window.partitionBy("day"))  # the outlets of a day
    shared = running.select(level, "source", "day", "articles", "events", "running_articles", (F.col("running_articles") / on_day).alias("running_share"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("running_articles", "long"), ("running_share", "double"))]
    rest = cube.where("g IN (1, 3) OR day IS NULL").select(level, "source", "day", "articles", "events", *none)
    return shared.unionByName(rest)
