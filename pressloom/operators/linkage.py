"""Average-linkage clustering of headlines, cut at a cosine distance, as rounds of joins.

The mean similarity of two clusters is the product of their summed vectors over the product of their sizes, so neither a
distance matrix nor the pairs below the cut are kept.  A merged cluster can only be close enough to another one if one
of its two parts was: the mean of two numbers is not above both.  The pairs that matter in the next round are therefore
those of this round with merged ids, and only their sums have to be found.

Each round merges all pairs of clusters that are each other's nearest (ties by smaller ids).  Average linkage is
reducible: no merge brings a cluster nearer to a third one than its parts were, so these merges do not disturb each other
and end in the same clusters as one merge at a time.

Clusters in different connected components of the close pairs never meet.  What has at most `COMPONENT` clusters, `EDGES` close
pairs and `ENTRIES` vector entries is therefore finished on its own in the memory of one task, whatever else is left: all that
there is, if it is no more than that, or else the components of that size, side by side.  Larger components go on by levels.  A
level is a lower distance, under which only a share of the clusters have a partner; the components of the pairs below it are small
and are merged up to that distance in the same way.  Nothing is lost by that: what lies in different ones is at the level or beyond,
and by reducibility stays there whatever is merged.  Where a level still leaves larger components the next share is half of it, and
where it has no small ones, the pairs of clusters that are each other's nearest are merged as above.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.operators.agglomeration import nearest_merges
from pressloom.operators.components import components
from pressloom.operators.features import CHAR_MARK, CharGrams, char_counts, term_counts, vocabulary
from pressloom.operators.similarity import BLOCK_ROWS, index_vectors, rank_terms, similar_pairs
from pressloom.session import StepTables

#: Clusters, vector entries and close pairs that one task holds, some 0.1 kB each with what it works out.
COMPONENT = 1_000_000
ENTRIES = 4_000_000
EDGES = 8_000_000
#: The share of the clusters that have a partner below the first level.
SHARE = 0.5
#: Tasks that finish components side by side.
TASKS = 64


_DISTANCE = "round(1.0D - s / (na * nb), 12)"


def distinct_texts(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(text, doc, copies): the smallest document number and the count of each text."""
    keyed = docs.select(F.col(doc).cast("long").alias("_doc"), F.col(text).alias("text"))
    return keyed.groupBy("text").agg(F.min("_doc").alias("doc"), F.count("*").alias("copies"))


def cosine_pairs(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text_for_cluster",
    threshold: float = 0.83,
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int = 2,
    max_df: float = 0.75,
    stopwords: Sequence[str] | DataFrame = (),
    block_rows: int = BLOCK_ROWS,
    chars: CharGrams | None = None,
) -> DataFrame:
    """(a, b, sim, copies_a, copies_b): headlines at a cosine distance below `threshold`.

    A pair is given once per two distinct texts, by their smallest document numbers, with the number of documents that
    carry each text: copies_a times copies_b document pairs have this similarity.  `chars` adds character n-grams.
    """
    steps = StepTables(docs.sparkSession, "pairs")
    texts = steps.save(distinct_texts(docs, doc, text), "texts")
    n_docs = texts.agg(F.sum("copies")).scalar()
    vectors = text_vectors(texts, n_docs, steps, ngram_range, min_df, max_df, stopwords, chars)
    min_sim = 1.0 - threshold
    vectors = steps.save(index_vectors(vectors.drop("signature"), min_sim), "vectors")
    steps.drop_all_but(vectors)
    pairs = similar_pairs(vectors, "doc", min_sim - 1e-9, steps, block_rows, copies="copies")
    return pairs.where(F.round(1.0 - F.col("sim"), 12) < threshold)


def text_vectors(
    texts: DataFrame,
    n_docs: Column,
    steps: StepTables,
    ngram_range: tuple[int, int],
    min_df: int,
    max_df: float,
    stopwords: Sequence[str] | DataFrame,
    chars: CharGrams | None = None,
) -> DataFrame:
    """(doc, copies, signature, v) of distinct texts (doc, text, copies): TF-IDF vectors of length one.

    `v` holds (tid, w) in rank order and `signature` the terms and counts it comes from.  With `chars` a vector is the one of
    words beside the one of character n-grams, each of length one, the second times its weight, and the whole scaled to
    length one; both kinds of terms stand in one vocabulary.
    """
    counts = steps.save(term_counts(texts, "doc", F.col("text"), ngram_range, stopwords), "term-counts")
    counts = counts.join(texts.select("doc", "copies"), "doc")
    kept = vocabulary(counts, n_docs, min_df, max_df, copies="copies")
    if chars:
        grams = steps.save(char_counts(texts, "doc", F.col("text"), chars.ngram_range), "char-counts")
        grams = grams.withColumn("term", F.concat(F.lit(CHAR_MARK), "term")).join(texts.select("doc", "copies"), "doc")
        kept = kept.unionByName(vocabulary(grams, n_docs, chars.min_df, chars.max_df, copies="copies"))
        counts = counts.unionByName(grams)
    terms = rank_terms(kept, steps)
    found = counts.join(terms.select("term", "tid", "idf"), "term")
    entry = F.struct("tid", "tf", (F.col("tf") * F.col("idf")).alias("w"), F.startswith("term", F.lit(CHAR_MARK)).alias("char"))
    # One row per text: the list is bounded by the length of one headline.
    packed = found.groupBy("doc", "copies").agg(F.array_sort(F.collect_list(entry)).alias("_raw"))
    square = lambda char: F.aggregate("_raw", F.lit(0.0), lambda acc, x: acc + F.when(x["char"] == char, x["w"] * x["w"]).otherwise(0.0))
    packed = packed.select("*", F.sqrt(square(False)).alias("_words"), *([F.sqrt(square(True)).alias("_chars")] if chars else []))
    scale = lambda x: F.col("_words")
    if chars:
        whole = F.sqrt((F.col("_words") > 0).cast("double") + F.when(F.col("_chars") > 0, chars.weight**2).otherwise(0.0))
        packed = packed.select("*", (F.col("_words") * whole).alias("_by_word"), (F.col("_chars") * whole / chars.weight).alias("_by_char"))
        scale = lambda x: F.when(x["char"], F.col("_by_char")).otherwise(F.col("_by_word"))
    unit = F.transform("_raw", lambda x: F.struct(x["tid"].alias("tid"), (x["w"] / scale(x)).alias("w")))
    signature = F.transform("_raw", lambda x: F.struct(x["tid"].alias("tid"), x["tf"].alias("tf")))
    return packed.select("doc", "copies", signature.alias("signature"), unit.alias("v"))


def average_linkage(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text_for_cluster",
    threshold: float = 0.85,
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int = 2,
    max_df: float = 0.8,
    stopwords: Sequence[str] | DataFrame = (),
    block_rows: int = BLOCK_ROWS,
    component: int = COMPONENT,
    chars: CharGrams | None = None,
) -> DataFrame:
    """Adds `cluster` to `docs`: the smallest `doc` of the cluster.  `doc` must be a unique integer column.

    `chars` adds character n-grams to the words that headlines are compared by.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the distance threshold must be in (0, 1]")
    spark = docs.sparkSession
    steps = StepTables(spark, "linkage")

    # Equal texts have equal vectors, hence distance 0: they stand as one row with a count from here on.
    texts = steps.save(distinct_texts(docs, doc, text), "texts")
    n_docs = texts.agg(F.sum("copies")).scalar()
    per_text = text_vectors(texts, n_docs, steps, ngram_range, min_df, max_df, stopwords, chars)
    per_text = steps.save(per_text, "text-vectors")

    # Texts that differ only in dropped terms have equal vectors too: one vector stands for all.
    alike = per_text.groupBy("signature").agg(
        F.min("doc").alias("vec"), F.sum("copies").alias("n"), F.any_value("v").alias("v")
    )
    min_sim = 1.0 - threshold
    vectors = steps.save(index_vectors(alike, min_sim), "vectors")
    pairs = similar_pairs(vectors, "vec", min_sim - 1e-9, steps, block_rows, copies="n")
    edges = pairs.select("a", "b", F.col("copies_a").alias("na"), F.col("copies_b").alias("nb"), (F.col("sim") * F.col("copies_a") * F.col("copies_b")).alias("s"))
    edges = steps.save(_close(edges, threshold), "edges")
    steps.drop_all_but(texts, per_text, vectors, edges)
    entries = vectors.select("vec", "n", F.explode("v").alias("e"))
    sums = entries.select(F.col("vec").alias("c"), F.col("e.tid").alias("tid"), (F.col("e.w") * F.col("n")).alias("s"))

    roots = _merge_rounds(edges, sums, threshold, steps, component)
    label = per_text.join(vectors.select("signature", "vec"), "signature")
    label = label.select(F.col("doc").alias("_text"), F.col("vec").alias("_vec"))
    if roots is not None:
        label = label.join(roots, F.col("_vec") == F.col("old"), "left").select(
            "_text", F.coalesce("new", "_vec").alias("_label")
        )
    else:
        label = label.select("_text", F.col("_vec").alias("_label"))
    label = label.join(texts, F.col("_text") == F.col("doc")).select(F.col("text").alias(text), "_label")
    # A text without a known term is at distance 1 from everything, its own copies included.
    out = docs.join(label, text, "left")
    return out.withColumn("cluster", F.coalesce("_label", F.col(doc).cast("long"))).select(*docs.columns, "cluster")


def _close(edges: DataFrame, threshold: float) -> DataFrame:
    return edges.where(f"{_DISTANCE} < {threshold!r}D")


def _nearest_to_each_other(edges: DataFrame) -> DataFrame:
    """(old, new, n, parts) of the pairs in which both clusters have each other as their nearest, a row per cluster."""
    sides = edges.selectExpr("explode(array(a, b)) AS c", f"struct({_DISTANCE} AS d, a, b, na + nb AS n) AS e")
    nearest = sides.groupBy("c").agg(F.min("e").alias("e")).select("e.a", "e.b", "e.n")
    found = nearest.groupBy("a", "b", "n").agg(F.count("*").alias("votes")).where("votes = 2")
    return found.selectExpr("explode(array(a, b)) AS old", "a AS new", "n", "2L AS parts")


def _merge_rounds(
    edges: DataFrame, sums: DataFrame, threshold: float, steps: StepTables, component: int
) -> DataFrame | None:
    """(old, new) for every vector that ended in the cluster of another one."""
    merges: list[DataFrame] = []
    share, level = SHARE, threshold
    while not edges.isEmpty():
        moved, larger = _finish_small(edges, sums, level, steps, component)
        done = moved
        if moved is None:
            moved = steps.save(_nearest_to_each_other(edges), "merges")
        merges.append(moved.where("old <> new").select("old", "new"))
        previous = edges, sums, larger
        if level == threshold and done is not None:
            if larger is None:
                break
            # The finished components have no pair below the threshold any more.
            edges = steps.save(edges.join(larger.select(F.col("node").alias("a")), "a", "left_semi").select(*edges.columns), "edges")
        else:
            sums = steps.save(_add_up(sums, edges, moved), "sums")
            edges = steps.save(_close(_renamed(edges, sums, moved), threshold), "edges")
            if level < threshold:
                share = min(share * 1.5, SHARE) if larger is None else share / 2
        steps.drop(*[t for t in previous if t is not sums and t is not edges])
        # A component may be too large by its entries alone; then only a lower level cuts it.
        level = _level(edges, share, threshold, component if larger is None else 0)
    return _roots(merges, steps) if merges else None


def _level(edges: DataFrame, share: float, threshold: float, limit: int) -> float:
    """A distance below which this share of the clusters have a partner; the threshold if no component can be larger than the limit."""
    nearest = edges.selectExpr("explode(array(a, b)) AS c", f"{_DISTANCE} AS d").groupBy("c").agg(F.min("d").alias("d"))
    clusters, found = nearest.agg(F.count("*"), F.percentile_approx("d", max(share, 1e-6))).first()
    return threshold if clusters <= limit else min(math.nextafter(found, math.inf), threshold)


def _finish_small(
    edges: DataFrame, sums: DataFrame, level: float, steps: StepTables, limit: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """(old, new, n, parts) of all merges below the level inside components of at most `limit` clusters, and (node, root) of the
    larger components; None where there are none.

    Components are those of the pairs below the level.  What lies in different ones is at the level or beyond, and so is all that
    they are merged into, so every merge below the level happens inside one of them.
    """
    sides = edges.selectExpr("explode(array(struct(a AS c, na AS n), struct(b AS c, nb AS n))) AS x").select("x.*").distinct()
    sides = steps.save(sides, "sides")
    if sides.count() <= limit and edges.count() <= EDGES and sums.count() <= ENTRIES:
        placed = sides.select("c", "n", F.lit(0).alias("bin"))
        merged = steps.save(_finish(placed, edges.withColumn("bin", F.lit(0)), sums.withColumn("bin", F.lit(0)), level, 1), "finished")
        return None if merged.isEmpty() else merged, None
    near = steps.save(_close(edges, level), "near")
    found = steps.save(components(near, steps), "components")
    held = sums.groupBy("c").agg(F.count("*").alias("entries")).withColumn("edges", F.lit(0))
    held = held.unionByName(near.groupBy(F.col("a").alias("c")).agg(F.lit(0).alias("entries"), F.count("*").alias("edges")))
    sizes = found.join(held, F.col("node") == F.col("c")).groupBy("root")
    counts = [F.count_if(F.col("entries") > 0).alias("size"), F.sum("entries").alias("entries"), F.sum("edges").alias("edges")]
    sizes = steps.save(sizes.agg(*counts), "sizes")
    is_small = (F.col("size") <= limit) & (F.col("entries") <= ENTRIES) & (F.col("edges") <= EDGES)
    larger = steps.save(found.join(sizes.where(~is_small), "root").select("node", "root"), "larger")
    several, entries, pairs = sizes.where(is_small).agg(F.count("*"), F.sum("entries"), F.sum("edges")).first()
    if not several:
        return None, larger
    # A number of tasks, as the work in a component is far more than its bytes tell.
    bins = max(min(several, TASKS), math.ceil(entries / ENTRIES), math.ceil(pairs / EDGES))
    small = found.join(sizes.where(is_small), "root").select(F.col("node").alias("c"), F.pmod(F.xxhash64("root"), F.lit(bins)).cast("int").alias("bin"))
    small = steps.save(small, "bins")
    near = near.join(small.withColumnRenamed("c", "a"), "a")
    merged = steps.save(_finish(sides.join(small, "c"), near, sums.join(small, "c"), level, bins), "finished")
    return None if merged.isEmpty() else merged, None if larger.isEmpty() else larger


def _finish(sides: DataFrame, edges: DataFrame, sums: DataFrame, threshold: float, bins: int) -> DataFrame:
    """(old, new, n, parts) of the merges inside each bin, with a row of the cluster that stays; a bin holds whole components of
    bounded size, or all that is left."""
    rows = edges.select("bin", F.col("a").alias("x"), F.col("b").alias("y"), F.col("s").alias("v"))
    rows = rows.unionByName(sides.select("bin", F.col("c").alias("x"), F.col("c").alias("y"), F.col("n").cast("double").alias("v")))
    rows = rows.unionByName(sums.select("bin", F.col("c").alias("x"), (-1 - F.col("tid")).alias("y"), F.col("s").alias("v")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[np.ndarray]] = {"x": [], "y": [], "v": []}
        for batch in batches:
            for name, parts in found.items():
                parts.append(batch.column(name).to_numpy().copy())
        if not found["x"]:
            return
        x, y, v = (np.concatenate(found.pop(name)) for name in ("x", "y", "v"))
        is_size, is_entry = x == y, y < 0
        order = np.argsort(x[is_size])
        ids, n = x[is_size][order], v[is_size][order]
        is_edge = ~(is_size | is_entry)
        a, b, s = np.searchsorted(ids, x[is_edge]).astype(np.int32), np.searchsorted(ids, y[is_edge]).astype(np.int32), v[is_edge]
        x, y, v = x[is_entry], y[is_entry], v[is_entry]
        number = np.minimum(np.searchsorted(ids, x), len(ids) - 1)
        has = ids[number] == x
        number, term, v = number[has], np.unique(y[has], return_inverse=True)[1], v[has]
        del x, y, has, is_size, is_entry, is_edge
        root, size = nearest_merges(n, a, b, s, number, term, v, threshold)
        parts = np.bincount(root, minlength=len(ids))
        moved = parts[root] > 1
        columns = [ids[moved], ids[root[moved]], size[moved].astype(np.int64), parts[root[moved]]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["old", "new", "n", "parts"])

    return rows.repartitionById(bins, "bin").select("x", "y", "v").mapInArrow(run, "old long, new long, n long, parts long")


def _add_up(sums: DataFrame, edges: DataFrame, moved: DataFrame) -> DataFrame:
    """Summed vectors of the clusters that still have a close partner, under their new ids."""
    active = edges.selectExpr("explode(array(a, b)) AS c").distinct()
    named = sums.join(active, "c", "left_semi").join(moved.selectExpr("old AS c", "new"), "c", "left")
    return named.selectExpr("coalesce(new, c) AS c", "tid", "s").groupBy("c", "tid").agg(F.sum("s").alias("s"))


def _renamed(edges: DataFrame, sums: DataFrame, moved: DataFrame) -> DataFrame:
    """Edges between the new clusters with their new sums."""
    named = edges.join(moved.selectExpr("old AS a", "new AS a2", "n AS na2", "parts AS pa"), "a", "left")
    named = named.join(moved.selectExpr("old AS b", "new AS b2", "n AS nb2", "parts AS pb"), "b", "left")
    ends = "struct(coalesce(a2, a) AS c, coalesce(na2, na) AS n)", "struct(coalesce(b2, b) AS c, coalesce(nb2, nb) AS n)"
    named = named.selectExpr(
        f"array_sort(array({ends[0]}, {ends[1]})) AS ends", "s", "coalesce(pa, 1L) * coalesce(pb, 1L) AS parts"
    )
    named = named.selectExpr("ends[0].c AS a", "ends[1].c AS b", "ends[0].n AS na", "ends[1].n AS nb", "s", "parts")
    grouped = (
        named.where("a <> b")
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("s").alias("s"), F.count("*").alias("known"), F.max("parts").alias("parts"))
    )
    # When all part pairs were edges their sums add up; otherwise the sum comes from the vectors.
    whole = grouped.where("known = parts").select("a", "b", "na", "nb", "s")
    return whole.unionByName(_products(grouped.where("known < parts").select("a", "b", "na", "nb"), sums))


def _products(pairs: DataFrame, sums: DataFrame) -> DataFrame:
    """Products of summed vectors: the terms of the smaller cluster are looked up in the larger one."""
    sides = pairs.selectExpr("*", "if(na <= nb, a, b) AS small", "if(na <= nb, b, a) AS large")
    met = sides.join(sums.selectExpr("c AS small", "tid", "s AS s1"), "small")
    met = met.join(sums.selectExpr("c AS large", "tid", "s AS s2"), ["large", "tid"])
    return met.groupBy("a", "b", "na", "nb").agg(F.expr("sum(s1 * s2)").alias("s"))


def _roots(merges: list[DataFrame], steps: StepTables) -> DataFrame:
    """Follow the merges of all rounds to the final cluster, doubling the reach of each link per step."""
    links = steps.save(reduce(DataFrame.unionByName, merges), "links")
    for _ in range(math.ceil(math.log2(len(merges) + 1))):
        onward = links.select(F.col("old").alias("new"), F.col("new").alias("far"))
        links = links.join(onward, "new", "left").select("old", F.coalesce("far", "new").alias("new"))
        links = steps.save(links, "links")
    return links
