"""Benchmark decontamination: a broadcast set of normalised test n-grams against every window of the training texts.

Benchmark items and documents go through the same word rule.  Every window of ten consecutive item words (the whole item
where it is shorter) is one row of the window table: a number, its hash, its words.  A scan of the documents hashes each word
once, makes the window hash at each word of the hashes of its words, and probes the table; the words themselves are then
compared, so a hash collision is never a hit.  Only hits, and one anchor row per document where a row for each is asked for,
are shuffled; hit words are the length of the union of the hit intervals.  The items of a window are rows of another table,
joined to the hits.  Removal works by text: the hashes of the texts with hits, or their hit spans, are joined to the documents.

The window table is broadcast while it has at most `MAX_BROADCAST_WINDOWS` rows and `MAX_BROADCAST_BYTES` bytes of words,
which is checked on the written table; beyond that the same join runs as a shuffled one.

Edge cases: a NULL or empty text has no words and no hits; an item without words has no window; equal windows of several
items are one row; a NULL item_id marks words as hit but names no item; an item_id that occurs more than once counts once;
repeated document rows give a result row each; a NULL doc_id is carried through; columns other than those named are never
looked at.  An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm import common
from pressloom.session import StepTables

WINDOW_WORDS = 10
MAX_BROADCAST_WINDOWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20


def word_hashes(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(benchmark: DataFrame, steps: StepTables, size: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """One row per distinct window: win (a number), len, gram (its words), h (its hash); and the items (win, item) of each."""
    n, at = F.size("w"), F.col("at")
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), common.words("text").alias("w"))
    each = words.where(n > 0).select("item", "w", F.explode(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))).alias("at"))
    cut = steps.save(each.select("item", F.slice("w", at + 1, F.least(n, F.lit(size))).alias("g")).distinct(), "item-windows")
    hashed = cut.select("g").distinct().withColumn("hashes", word_hashes("g"))
    table = hashed.select(
        F.monotonically_increasing_id().alias("win"),
        F.size("g").alias("len"),
        F.array_join("g", " ").alias("gram"),
        common.gram_hash("hashes", F.lit(0), size).alias("h"),
    )
    table = steps.save(table, "windows")
    named = cut.where(F.col("item").isNotNull()).select(F.array_join("g", " ").alias("gram"), "item")
    return table, steps.save(named.join(table, "gram").select("win", "item"), "window-items")


def hits(docs: DataFrame, table: DataFrame, row: Column, keep: dict[str, Column] | None, size: int = WINDOW_WORDS) -> DataFrame:
    """A line (row, at, len, win) per hit window; with `keep`, also an anchor line per document row, at NULL, that has the
    kept columns and n_words."""
    seen = table.groupBy("len").agg(F.count("*").alias("n"), F.sum(F.octet_length("gram")).alias("bytes")).collect()  # at most `size` rows
    lengths = sorted(r["len"] for r in seen)
    if sum(r["n"] for r in seen) <= MAX_BROADCAST_WINDOWS and sum(r["bytes"] for r in seen) <= MAX_BROADCAST_BYTES:
        table = F.broadcast(table)
    count = max(len(lengths), 1)
    step, n = F.col("step"), F.col("n_words")
    kept = F.struct(*[c.alias(k) for k, c in (keep or {"nothing": F.lit(None).cast("int")}).items()])
    base = docs.select(row.alias("row"), common.words("text").alias("w"), kept.alias("kept"))
    base = base.select("row", "w", "kept", word_hashes("w").alias("hashes"), F.size("w").alias("n_words"))
    # One element per word and window length, and a last one as the anchor.
    last = n * count if keep else n * count - 1
    base = base if keep else base.where("n_words > 0")
    walk = base.select("row", "w", "hashes", "kept", "n_words", F.explode(F.sequence(F.lit(0), last)).alias("step"))
    place = (step / count).cast("int") if count > 1 else step
    hashed = F.lit(None).cast("bigint")
    length = F.lit(None).cast("int")
    for k, words in reversed(list(enumerate(lengths))):
        here = (step % count == k) & (place <= n - words) if count > 1 else place <= n - words
        hashed = F.when(here, common.gram_hash("hashes", place, words)).otherwise(hashed)
        length = F.when(here, F.lit(words)).otherwise(length)
    anchor = step == n * count if keep else F.lit(False)
    probed = walk.select("row", "w", "kept", "n_words", "step", F.when(~anchor, hashed).alias("h"), F.when(~anchor, length).alias("size"), place.alias("at"))
    same = F.col("len").isNotNull() & (F.col("len") == F.col("size")) & (F.col("gram") == F.array_join(F.slice("w", F.col("at") + 1, F.col("len")), " "))
    found = probed.join(table, "h", "left" if keep else "inner").where(anchor | same)
    plain = found.select("row", *[F.when(~anchor, F.col(c)).alias(c) for c in ("at", "len", "win")])
    if not keep:
        return plain
    return found.select("row", F.when(anchor, F.col("kept")).alias("kept"), F.when(anchor, n).alias("n_words"), *[F.when(~anchor, F.col(c)).alias(c) for c in ("at", "len", "win")])


def _fresh(marked: DataFrame) -> DataFrame:
    """With `fresh`, the words of a hit window that no window before it in its row covers."""
    order = Window.partitionBy("row").orderBy(F.col("at").asc_nulls_first(), "len", "win")
    end = F.col("at") + F.col("len")
    before = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return marked.withColumn("fresh", F.greatest(end - F.greatest(F.col("at"), before), F.lit(0)))


def scan(docs: DataFrame, benchmark: DataFrame, keep: dict[str, Column], size: int = WINDOW_WORDS) -> DataFrame:
    """A row per document row: the `keep` columns, n_words, n_hit, items (sorted)."""
    steps = StepTables(docs.sparkSession, "decontaminate")
    table, items = windows(benchmark, steps, size)
    marked = steps.save(hits(docs, table, F.monotonically_increasing_id(), keep, size), "hits")
    total = _fresh(marked).groupBy("row").agg(
        F.max_by("kept", F.col("n_words")).alias("kept"),
        F.max("n_words").cast("long").alias("n_words"),
        F.coalesce(F.sum(F.when(F.col("at").isNotNull(), F.col("fresh"))), F.lit(0)).cast("long").alias("n_hit"),
    )
    named = marked.where(F.col("win").isNotNull()).select("row", "win").distinct().join(items, "win")
    listed = named.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return total.join(listed, "row", "left").select(*[F.col("kept")[k].alias(k) for k in keep], "n_words", "n_hit", F.coalesce("items", none).alias("items"))


def _mark() -> tuple[Column, Column]:
    """What stands for a text when hits are brought back to the documents: its hash and its length."""
    return F.xxhash64(common.whole("text")).alias("mark"), F.octet_length(common.whole("text")).alias("bytes")


def marked_hits(docs: DataFrame, benchmark: DataFrame, steps: StepTables, size: int = WINDOW_WORDS) -> DataFrame:
    """The distinct hits of each distinct text: row (its mark), at, len."""
    table, _ = windows(benchmark, steps, size)
    return hits(docs, table, F.struct(*_mark()), None, size).select("row", "at", "len", "win").distinct()


def _beside(found: DataFrame) -> DataFrame:
    """A written table by mark, marked for broadcast if it is small."""
    return F.broadcast(found) if found.count() <= MAX_BROADCAST_WINDOWS else found


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = scan(docs, benchmark, {"doc_id": F.col("doc_id")})
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, with all their columns."""
    steps = StepTables(docs.sparkSession, "decontaminate")
    found = steps.save(marked_hits(docs, benchmark, steps).select("row.*").distinct(), "marks")
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), *_mark())
    return nested.join(_beside(found), ["mark", "bytes"], "left_anti").select(*[F.col("kept")[c].alias(c) for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents with `text` freed from every hit word; separators stay as they are."""
    cased = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    steps = StepTables(docs.sparkSession, "decontaminate")
    end = F.col("at") + F.col("len")
    fresh = _fresh(marked_hits(docs, benchmark, steps)).where("fresh > 0")
    spans = fresh.groupBy("row").agg(F.array_sort(F.collect_list(F.struct((end - F.col("fresh")).alias("start"), end.alias("end")))).alias("spans"))
    found = steps.save(spans.select("row.*", "spans"), "spans")
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), *_mark()).join(_beside(found), ["mark", "bytes"], "left")
    text = F.col("kept")["text"]
    parts = F.split(text, cased, -1)
    inside = lambda i: F.exists("spans", lambda s: (s["start"] <= i) & (i < s["end"]))
    left = F.transform(F.regexp_extract_all(text, F.lit(cased), F.lit(0)), lambda w, i: F.when(inside(i), F.lit("")).otherwise(w))
    joined = F.concat(F.array_join(F.zip_with(F.slice(parts, 1, F.size(left)), left, lambda a, b: F.concat(a, b)), ""), F.element_at(parts, -1))
    clean = F.when(F.col("spans").isNotNull(), joined).otherwise(text)
    return nested.select(*[(clean if c == "text" else F.col("kept")[c]).alias(c) for c in docs.columns])


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bi AS (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS gram FROM bi),
ln AS (SELECT DISTINCT n FROM bw),
di AS (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, ln WHERE len(w) >= n),
dw AS (SELECT r, n, i, array_to_string(w[i + 1 : i + n], ' ') AS gram FROM di),
h AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.gram = bw.gram),
p AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT r, i, n, unnest(range(i, i + n)) AS j FROM h) GROUP BY r),
t AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""
