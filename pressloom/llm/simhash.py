"""SimHash near-duplicates with BK-trees.

Every text gets a 64-bit fingerprint of its word shingles.  Fingerprints link at `RADIUS` or fewer differing bits, and a
document's group is everything reachable over links.

Search.  One BK-tree over all fingerprints, or a broadcast of the trees, would grow with the corpus, so the trees are
sharded by value: 64 bits are cut into RADIUS + 1 bands, and two linked fingerprints agree in at least one of them.  A
shard is all distinct fingerprints with one value of one band.  It travels to one task by a shuffle in place of a
broadcast, becomes a BK-tree there (children keyed by their Hamming distance to the parent), and each of its members
follows only the edges within the radius.  A shard of more than `SHARD` fingerprints is cut again by RADIUS + 1 bands of
its remaining bits; one that is still larger is dealt into blocks of at most about `SHARD`, and each pair of blocks is one
tree.  All of this is exact: no candidate is dropped, and no pair is ever a row.  A tree returns at most one link per
member, to the smallest member of its part of the tree.

Groups.  Copies have one fingerprint, so a group of thousands of copies is one vertex.  The links are contracted round by
round (each vertex joins the neighbour that comes first in an order that changes with the round), every round is written
below spark.checkpoint.dir, and the maps of the rounds are joined at the end.

Edge cases: a text without words, empty or NULL, has fingerprint zero and is linked like any other; a text of fewer words
than a shingle is one shingle; repeated rows get a row each; a NULL doc_id is never the smallest number, and the
component_id is NULL where no member has a number; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pressloom.llm import common
from pressloom.operators.components import components
from pressloom.session import StepTables

SHINGLE = 4
RADIUS = 4
SHARD = 4096
SEED = 42
FRONTIER = 2_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed value of the 64 majority bits over the XXH64 of all shingles, repeats included."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    last = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[:last].tolist(), ends[size - 1 :].tolist())], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for k in range(0, last, 1 << 14):
        counts += np.unpackbits(hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > last, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _bands(value: Column, bits: int, low: int, count: int) -> list[Column]:
    """The `bits` bits above `low`, cut into `count` bands."""
    edges = [low + bits * k // count for k in range(count + 1)]
    return [F.shiftrightunsigned(value, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]


def shards(prints: DataFrame, radius: int = RADIUS, limit: int = SHARD, steps: StepTables | None = None) -> DataFrame:
    """Rows (fp, shard, left, right): a tree is all rows with equal shard, left and right."""
    fp, count = F.col("fp"), radius + 1
    banded = prints.select("fp", F.posexplode(F.array(*_bands(fp, 64, 0, count))).alias("band", "value"))
    first = banded.select("fp", "band", F.xxhash64("band", "value").alias("shard"))
    sizes = first.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    sizes = steps.save(sizes, "large-shards") if steps else sizes
    small = first.join(sizes, "shard", "left_anti").select("fp", "shard", F.lit(0).alias("left"), F.lit(0).alias("right"))
    # The remaining bits of a large shard: rotate its band away, then cut what is left.
    edges = [64 * k // count for k in range(count + 1)]
    rotated, width = F.lit(None).cast("bigint"), F.lit(None).cast("int")
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        up = F.shiftleft(fp, 64 - b) if b < 64 else F.lit(0).cast("bigint")
        rotated = F.when(F.col("band") == k, F.shiftrightunsigned(fp, b).bitwiseOR(up) if b < 64 else fp).otherwise(rotated)
        width = F.when(F.col("band") == k, F.lit(64 - (b - a))).otherwise(width)
    large = first.join(sizes, "shard", "left_semi").select("fp", "shard", rotated.alias("rest"), width.alias("width"))
    cut = lambda k: F.expr(f"shiftrightunsigned(rest, cast(width * {k} div {count} as int)) & (shiftleft(1L, cast(width * {k + 1} div {count} - width * {k} div {count} as int)) - 1)")
    second = large.select("fp", "shard", F.posexplode(F.array(*[cut(k) for k in range(count)])).alias("band", "value"))
    second = second.select("fp", F.xxhash64("shard", "band", "value").alias("shard"))
    still = second.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    sized = second.join(still, "shard", "left")
    blocks = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / F.lit(limit)).cast("int")
    dealt = sized.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = dealt.select("fp", "shard", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return small.unionByName(other.select("fp", "shard", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")))


def _expand(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [first, stop): which range, and which element, one entry per element."""
    sizes = np.maximum(stop - first, 0)
    which = np.repeat(np.arange(len(first)), sizes)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return which, first[which] + inside


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def build(values: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees over `values`, one per distinct root: sorted edge keys (parent * 65 + distance) and the child of each.

    All values that reach a node arrive in the same round; the first with each distance becomes the child for that
    distance, the others go on to it.
    """
    waiting = np.flatnonzero(root != np.arange(len(values)))
    at = root[waiting]
    keys, children = [], []
    while len(waiting):
        key = at * 65 + _distance(values[waiting], values[at])
        edge, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        child = waiting[first]
        keys.append(edge)
        children.append(child)
        rest = np.ones(len(waiting), bool)
        rest[first] = False
        at, waiting = child[inverse][rest], waiting[rest]
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key, kind="stable")
    return key[order], child[order]


def search(values: np.ndarray, root: np.ndarray, keys: np.ndarray, children: np.ndarray, radius: int, largest: int) -> Iterator[tuple]:
    """Pairs (query, node) within the radius, chunk by chunk; only edges within the radius of a distance are followed."""
    chunk = max(32, FRONTIER // max(largest, 1))
    for k in range(0, len(values), chunk):
        query = np.arange(k, min(k + chunk, len(values)))
        node = root[query]
        while len(query):
            d = _distance(values[query], values[node])
            near = (d <= radius) & (query > node)
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(keys, node * 65 + np.maximum(d - radius, 1))
            high = np.searchsorted(keys, node * 65 + np.minimum(d + radius, 64), side="right")
            which, edge = _expand(low, high)
            query, node = query[which], children[edge]


def parts(values: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each value the smallest index in its connected part of its group; groups are runs of equal numbers."""
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((start, [len(values)])))
    root = np.repeat(start, sizes)
    label = np.arange(len(values))
    keys, children = build(values, root)
    for a, b in search(values, root, keys, children, radius, int(sizes.max())):
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (label[label] != label).any():
                label = label[label]
    return label


def links(units: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows (a, b) that connect the same fingerprints as all pairs within the radius do."""

    def run(batches):
        import pyarrow as pa

        held: list[np.ndarray] = []

        def solve(rows: np.ndarray):
            rows = rows[:, np.lexsort((rows[0].astype(np.int64), *rows[:0:-1]))]
            change = np.any(rows[1:, 1:] != rows[1:, :-1], axis=0)
            group = np.concatenate(([0], np.cumsum(change)))
            label = parts(rows[0].view(np.uint64), group, radius)
            linked = np.flatnonzero(label != np.arange(len(label)))
            return pa.RecordBatch.from_pydict({"a": rows[0][linked], "b": rows[0][label[linked]]})

        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("fp", "shard", "left", "right")]))
            rows = np.concatenate(held, axis=1)
            end = np.flatnonzero(np.any(rows[1:] != rows[1:, -1:], axis=0))  # rows before the last, perhaps unfinished, tree
            cut = end[-1] + 1 if len(end) else 0
            held = [rows[:, cut:]]
            if cut:
                yield solve(np.ascontiguousarray(rows[:, :cut]))
        if held and held[0].shape[1]:
            yield solve(np.ascontiguousarray(np.concatenate(held, axis=1)))

    keys = ("shard", "left", "right")
    return units.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def groups(docs: DataFrame, radius: int = RADIUS, limit: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every document row, and (fp, root, component_id) of every distinct fingerprint."""
    spark = docs.sparkSession
    common.small_batches(spark)
    steps = StepTables(spark, "simhash")
    prints = steps.save(docs.select("doc_id", fingerprint_of(common.whole("text")).alias("fp")), "prints")
    distinct = steps.save(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(links(shards(distinct.select("fp"), radius, limit, steps), radius), steps)
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints, rooted.join(named, "root").select("fp", "root", "component_id")


def report(docs: DataFrame) -> DataFrame:
    prints, named = groups(docs)
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, grouped: Callable = groups, mark: Callable = fingerprint_of) -> DataFrame:
    """One document of each group, that with the smallest number, with all its columns.

    Where no member has a number, one member stays; of rows with the same number and fingerprint one stays.
    `grouped` gives what `groups` does, with the `mark` of a text as its fingerprint.
    """
    prints, named = grouped(docs)
    none, number = F.col("doc_id").isNull(), F.col("doc_id")
    first = prints.join(named, "fp").groupBy("root").agg(F.min(F.struct(none.alias("none"), number.alias("id"), F.col("fp"))).alias("m"))
    key = lambda none, number: (none.alias("none"), F.coalesce(number.cast("long"), F.lit(0)).alias("id"))
    stays = first.select(F.col("m")["fp"].alias("fp"), *key(F.col("m")["none"], F.col("m")["id"]))
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), mark(common.whole("text")).alias("fp"), *key(none, number))
    # Rows with one number and fingerprint meet by the keys of the join, so the texts are dealt out once.
    chosen = nested.join(stays, ["fp", "none", "id"]).groupBy("fp", "none", "id").agg(F.min(F.struct(F.xxhash64(F.col("kept")["text"]), F.col("kept"))).alias("one"))
    return chosen.select(*[F.col("one")["kept"][c].alias(c) for c in docs.columns])
