"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

A text is a sparse vector: words, word pairs, word shapes and shape pairs (letters, digits and punctuation of a word as
classes, and a mark for a word that repeats its neighbour) hashed into `BITS` bits.  The four groups have unit length each,
so the length of a text does not matter.  The score is the logistic function of a sparse dot product.

Training runs FTRL-proximal over at most `MAX_TRAIN` labelled documents, those first in the order of a hash of their
number.  Their numbers are broadcast, their vectors are built on the executors, written down, and read by the driver: once if
all have at most `MAX_BYTES`, else in parts in every epoch, since a very long text has a long vector.  The weights, 2^BITS numbers, are broadcast, and every document is scored where it is read.

Edge cases: NULL and empty texts have no features and get the score of the bias; labels without a document, with a NULL
number or a NULL label are not learnt from; without any label the score is 0.5; a document labelled twice is learnt with
its smallest label; of rows that repeat a number one is learnt, that with the smallest vector, and each is scored; a NULL
doc_id is scored and is not held out; other columns are kept by `accepted` and never read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pressloom.llm import common
from pressloom.session import StepTables

BITS = 18
MAX_TRAIN = 4000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.05
THRESHOLD = 0.7
HELD_OUT_OF, HELD_OUT = 4, 2
CACHE = 200_000
#: Bytes of training vectors that the driver keeps, and in how many parts more than that are read.
MAX_BYTES, PARTS = 256 << 20, 64
_ORDER = ("part", "doc_id")

_SHAPES = ((re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1+"), r"\1"))
_known: dict[str, tuple[int, int]] = {}


def _word(word: str) -> tuple[int, int]:
    """Hash of a word and of its shape; the worker remembers the frequent ones."""
    got = _known.get(word)
    if got is None:
        shape = word
        for pattern, by in _SHAPES:
            shape = pattern.sub(by, shape)
        got = zlib.crc32(word.encode("utf-8", "surrogatepass")), zlib.crc32(shape.encode("utf-8", "surrogatepass"), 7)
        if len(word) <= 64:  # longer ones are worked out each time
            if len(_known) >= CACHE:
                _known.clear()
            _known[word] = got
    return got


def _pairs(ids: np.ndarray, salt: int) -> np.ndarray:
    a, b = ids[:-1], ids[1:]
    mixed = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F)) ^ np.uint64(salt)
    return np.where(a == b, np.uint64(salt), mixed ^ (mixed >> np.uint64(29)))


def vector(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers and their values."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    table = np.array([_word(w) for w in words], dtype=np.uint64)
    groups = (table[:, 0], _pairs(table[:, 0], 11), table[:, 1], _pairs(table[:, 1], 13))
    found, values = [], []
    for number, ids in enumerate(groups):
        if len(ids):
            mixed = (ids + np.uint64(number)) * np.uint64(0xD6E8FEB86659FD93)
            slots, counts = np.unique((mixed >> np.uint64(64 - bits)).astype(np.int32), return_counts=True)
            found.append(slots)
            values.append(np.sqrt(counts / len(ids)).astype(np.float32))
    slots, at = np.unique(np.concatenate(found), return_inverse=True)
    return slots, np.bincount(at, np.concatenate(values)).astype(np.float32)


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -30 else math.exp(x)


def fit(rows: Iterable[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal weights, the bias last; rows are taken in the given order in every epoch, and may be read anew in each."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for slots, values, label in rows:
            i, x = np.append(slots, size - 1), np.append(values, 1.0)
            w = weights(i)
            g = (logistic(float(w @ x)) - label) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(np.arange(size)).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", limit: int = MAX_TRAIN, bits: int = BITS) -> np.ndarray:
    common.small_batches(docs.sparkSession)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.min(target).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def vectors(batches):
        import pyarrow as pa

        for batch in batches:
            got = [vector(t, bits) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "label": batch.column("label"),
                    "slots": pa.array([s.astype(np.int32).tobytes() for s, _ in got], pa.binary()),
                    "parts": pa.array([v.tobytes() for _, v in got], pa.binary()),
                }
            )

    built = sample.mapInArrow(vectors, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, slots binary, parts binary")
    one = built.groupBy("doc_id").agg(F.min(F.struct("slots", "parts", "label")).alias("one")).select("doc_id", "one.*")  # `documents` may repeat a number
    saved = StepTables(docs.sparkSession, "classifier").save(one.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))), "vectors")
    return fit(_Rows(saved), bits)


class _Rows:
    """At most `limit` training rows, in one order.  They are kept if they have at most `MAX_BYTES`; otherwise every epoch
    reads them again, one of `PARTS` parts at a time."""

    def __init__(self, saved: DataFrame):
        size = saved.agg(F.sum(F.octet_length("slots") + F.octet_length("parts"))).first()[0] or 0
        self.saved, self.kept = saved, None
        if size <= MAX_BYTES:
            self.kept = [self._row(r) for r in saved.orderBy(*_ORDER).collect()]

    @staticmethod
    def _row(r) -> tuple[np.ndarray, np.ndarray, int]:
        return np.frombuffer(r["slots"], np.int32), np.frombuffer(r["parts"], np.float32), r["label"]

    def __iter__(self):
        if self.kept is not None:
            yield from self.kept
            return
        for part in range(PARTS):
            yield from map(self._row, self.saved.where(F.col("part") == part).orderBy(*_ORDER).collect())


def scorer(spark, weights: np.ndarray, bits: int = BITS) -> Callable[[Column], Column]:
    shared = spark.sparkContext.broadcast(weights)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        w = shared.value
        dots = ((vector(t, bits)) for t in texts)
        return pd.Series([logistic(float(w[-1]) + float(w[s] @ v)) for s, v in dots], dtype="float64")

    return score


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    score = scorer(docs.sparkSession, train(docs, labels))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(common.whole("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier takes, with all their columns."""
    score = scorer(docs.sparkSession, train(docs, labels))
    return docs.where(score(common.whole("text")) >= THRESHOLD)
