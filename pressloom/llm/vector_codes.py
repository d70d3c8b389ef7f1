"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, found by slice and intersect.

Vectors become integers, floor(256 * x) per component, and are cut into 16 equal parts.  A part position has a codebook of at
most 64 entries, so a set of entries is one uint64.

Search.  Per dimension the entries' coordinates are sorted, and the sorted list carries prefix masks: the k-th one holds the
entries of the first k coordinates.  The entry next to the point in each single dimension gives a first distance, and its
root a radius beyond which no nearest entry can lie in any dimension.  Two binary searches per dimension cut the range within
the radius out of the sorted list; the difference of its two prefix masks is the set of entries in it, and the masks of all
dimensions ANDed are the candidates.  They hold every entry at or below the first distance, so the nearest of them, lowest
number first, is the exact answer.  All of it runs on whole Arrow batches, one candidate per point at a time.

Plan.  The table is read once per round and once for the codes.  A round sends one sum per entry, dimension and task, at most
16 * 64 * (width + 1) numbers, and the codebooks, as large as 64 vectors, travel back with the job.  Codes, errors and labels
are written down; the sums per label are joined to them by label, equal NULLs together.

Edge cases: a vector that is NULL or holds a NULL or non-finite component is dropped; of repeated vec_ids the smallest vector
starts the codebook, and every row gets a code; a NULL vec_id starts nothing and is encoded like any other; fewer than 64
numbers give as many entries, none at all gives NULL codes and errors; shorter vectors are filled with zeros up to the longest
one, and that up to a multiple of 16; integers beyond 2^24 either way stand at that bound, so that sums of squares stay exact;
an empty table gives no rows; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm import common
from pressloom.session import StepTables

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BOUND = 1 << 24


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding, label of the rows whose vector is whole and finite."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vectors.select("vec_id", "embedding", "label").where(F.col("embedding").isNotNull() & finite)


def integers(column, width: int) -> np.ndarray:
    """The scaled vectors of an Arrow list column, as rows of `width` integers."""
    flat = np.floor(np.asarray(column.flatten(), np.float64) * SCALE)
    flat = np.clip(flat, -BOUND, BOUND).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    starts = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
    return out


def prefix_masks(entries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per dimension: sorted coordinates, the entries in that order, and the mask of the first 0, 1, ... of them."""
    out = []
    for coordinates in entries.T:
        order = np.argsort(coordinates, kind="stable")
        bits = np.left_shift(np.uint64(1), order.astype(np.uint64))
        out.append((coordinates[order], order, np.concatenate((np.zeros(1, np.uint64), np.bitwise_or.accumulate(bits)))))
    return out


def distances(points: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return ((points - chosen) ** 2).sum(axis=1)


def candidates(points: np.ndarray, entries: np.ndarray, sliced: list) -> np.ndarray:
    """The uint64 mask of the entries that can be nearest to each point."""
    first = np.full(len(points), np.iinfo(np.int64).max)
    for x, (coordinates, order, _) in zip(points.T, sliced):
        right = np.minimum(np.searchsorted(coordinates, x), len(order) - 1)
        left = np.maximum(right - 1, 0)
        for side in (left, right):
            first = np.minimum(first, distances(points, entries[order[side]]))
    radius = np.sqrt(first.astype(np.float64)).astype(np.int64) + 1  # the root may be rounded down
    masks = np.full(len(points), ~np.uint64(0))
    for x, (coordinates, _, prefix) in zip(points.T, sliced):
        low = np.searchsorted(coordinates, x - radius, "left")
        high = np.searchsorted(coordinates, x + radius, "right")
        masks &= prefix[high] & ~prefix[low]
    return masks


def nearest(points: np.ndarray, entries: np.ndarray, sliced: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest entry to each point; of equal distances the lowest number."""
    masks = candidates(points, entries, sliced or prefix_masks(entries))
    best, found = np.full(len(points), np.iinfo(np.int64).max), np.zeros(len(points), np.int64)
    rows = np.arange(len(points))
    while len(rows):
        lowest = masks & (~masks + np.uint64(1))
        number = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
        far = distances(points[rows], entries[number])
        nearer = far < best[rows]
        best[rows[nearer]], found[rows[nearer]] = far[nearer], number[nearer]
        masks ^= lowest
        rows, masks = rows[masks != 0], masks[masks != 0]
    return found, best


def first_vectors(vectors: DataFrame, limit: int = ENTRIES) -> list[list[float]]:
    """The vectors of the `limit` smallest numbers, ascending; every task sends at most `limit` rows."""

    def run(batches):
        import pyarrow as pa

        least: dict = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field("embedding").type
            numbers = batch.column("vec_id").to_numpy(zero_copy_only=False)
            last = max(least) if len(least) == limit else None
            some = np.flatnonzero(numbers <= last) if last is not None else np.arange(len(numbers))
            for k in some.tolist():
                number, vector = numbers[k].item(), batch.column("embedding")[k].as_py()
                least[number] = min(least.get(number, vector), vector)
                if len(least) > 4 * limit:
                    least = {n: least[n] for n in heapq.nsmallest(limit, least)}
            least = {n: least[n] for n in heapq.nsmallest(limit, least)}
        if least:
            yield pa.RecordBatch.from_arrays([pa.array(least, pa.int64()), pa.array(least.values(), kind)], ["vec_id", "embedding"])

    rows = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    some = rows.mapInArrow(run, rows.schema)
    one = some.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return [r["embedding"] for r in one.orderBy("vec_id").limit(limit).collect()]


def _parted(column, codebooks: np.ndarray):
    """Per part position the integers of all vectors in it, with number and distance of their nearest entries."""
    parts, _, width = codebooks.shape
    whole = integers(column, parts * width)
    for part in range(parts):
        points = np.ascontiguousarray(whole[:, part * width : (part + 1) * width])
        yield part, points, *nearest(points, codebooks[part])


def improved(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry at the floor of the mean of its parts."""
    parts, entries, width = codebooks.shape

    def run(batches):
        import pyarrow as pa

        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for part, points, found, _ in _parted(batch.column(0), codebooks):
                np.add.at(sums[part, :, :width], found, points)
                sums[part, :, width] += np.bincount(found, minlength=entries)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"cell": cells.astype(np.int32), "total": sums.reshape(-1)[cells]})

    rows = vectors.select("embedding").mapInArrow(run, "cell int, total long").groupBy("cell").agg(F.sum("total").alias("total"))
    table = rows.toArrow()  # at most a number per codebook component and entry
    sums = np.zeros((parts, entries, width + 1), np.int64)
    sums.reshape(-1)[table.column("cell").to_numpy()] = table.column("total").to_numpy()
    count = sums[:, :, width:]
    return np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), codebooks)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, component) of the vectors that `kept` keeps; None without a numbered vector."""
    if not 0 < entries <= 64:
        raise ValueError("a set of entries is one uint64: 1 to 64 entries")
    import pyarrow as pa

    first = first_vectors(vectors, entries)
    if not first:
        return None
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0]
    width = max(1, -(-longest // parts))
    start = integers(pa.array(first, pa.list_(pa.float64())), parts * width)
    books = np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2))
    for _ in range(rounds):
        books = improved(vectors, books)
    return books


def encode(vectors: DataFrame, codebooks: np.ndarray | None) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distances, summed over the parts) of every row."""
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    if codebooks is None:
        return vectors.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    parts = len(codebooks)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            codes, error = np.empty((batch.num_rows, parts), np.uint8), np.zeros(batch.num_rows, np.int64)
            for part, _, found, far in _parted(batch.column("embedding"), codebooks):
                codes[:, part] = found
                error += far
            digits, n = codes.tobytes().hex(), 2 * parts
            texts = pa.array([digits[k : k + n] for k in range(0, len(digits), n)], pa.string())
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "label": batch.column("label"), "code": texts, "error": error})

    rows = vectors.select("vec_id", "label", "embedding")
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decode(code: str, codebooks: np.ndarray) -> np.ndarray:
    """The vector that a code stands for."""
    numbers = np.frombuffer(bytes.fromhex(code), np.uint8)
    return codebooks[np.arange(len(codebooks)), numbers].reshape(-1) / SCALE


def report(vectors: DataFrame) -> DataFrame:
    spark = vectors.sparkSession
    common.small_batches(spark, 10_000)
    whole = kept(vectors)
    books = fit(whole)
    digest = hashlib.sha256(",".join(map(str, (books if books is not None else np.empty(0, int)).reshape(-1).tolist())).encode()).hexdigest()
    coded = StepTables(spark, "vector-codes").save(encode(whole, books), "coded")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    both = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _rounds() -> str:
    """The SQL of the three assignments, each over the codebook of the one before."""
    out = []
    for k in range(ROUNDS + 1):
        out.append(
            f"""d{k} AS (SELECT p.r, p.part, c.entry, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far
  FROM p JOIN c{k} c USING (part)),
a{k} AS (SELECT r, part, arg_min(entry, far * 64 + entry) AS entry, min(far) AS far FROM d{k} GROUP BY r, part),"""
        )
        if k < ROUNDS:
            out.append(
                f"""s{k} AS (SELECT part, entry, j, sum(v[j]) AS total, count(*) AS n
  FROM (SELECT a.part, a.entry, p.v, unnest(range(1, len(p.v) + 1)) AS j FROM a{k} a JOIN p USING (r, part)) GROUP BY part, entry, j),
m{k} AS (SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM s{k} GROUP BY part, entry),
c{k + 1} AS (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m USING (part, entry)),"""
            )
    return "\n".join(out)


SQL = f"""
WITH k AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT max(len(v)) // {PARTS} AS width FROM k),
p AS (SELECT r, part, v[part * width + 1 : part * width + width] AS v FROM k, w, (SELECT unnest(range({PARTS})) AS part)),
f AS (SELECT vec_id, arg_min(r, embedding) AS r FROM k WHERE vec_id IS NOT NULL GROUP BY vec_id ORDER BY vec_id LIMIT {ENTRIES}),
c0 AS (SELECT p.part, n.entry, p.v FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM f) n USING (r)),
{_rounds()}
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS digest FROM c{ROUNDS}),
e AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)
SELECT k.vec_id, e.code, e.error, CAST(sum(e.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, h.digest AS codebooks_sha256
FROM k JOIN e USING (r), h
"""
