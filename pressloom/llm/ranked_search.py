"""Ranked lexical search by a document scan: one automaton of all item terms counts them straight from the text.

Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case.  In the scan every other character
becomes a space, and the Aho-Corasick automaton holds each term with a space on both sides, so that an occurrence is always
a whole term; neighbouring terms share a space, which overlapping matches allow.  An output is a term number, and the term's
row of a sparse table says which items hold it and how often.  There is no document index: a first scan counts N, L and, per
item term, the documents that hold it; a second one scores each document where it is read.

Score, in 64-bit integers but for w: w = floor(1000 * ln((2 N + 2) / (2 df + 1))), m = 25 + 75 n N div L, and an item's score
is the sum of w * (10^9 tf div (1000 tf + 8 m)) over its terms, repeats included.

Plan.  A task keeps the best `PLACES` documents of each item and sends no more, so the shuffle has that many rows per task
and item; ranks follow from row numbers, first within slices of each item's rows, then over what is left of them.  Items are
read one after the other into blocks of at most `BLOCK_CHARS` characters of terms, the bound of what is broadcast; one item
alone may be larger, by its own text.  Each block is searched against all documents.

Edge cases: a NULL or empty text has no terms, as a document or as an item; a document without terms counts neither in N nor
in L; every item row is ranked by itself, also with a repeated or NULL item_id; every document row is a document, also a
copy; equal scores go by ascending doc_id, NULL last; an item without matches has no rows; an empty table on either side
gives no rows; other columns are never looked at.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm import common
from pressloom.session import StepTables

PLACES = 10
BLOCK_CHARS = 2_000_000
SLICES = 64
#: Bytes of UTF-8: ASCII letters in lower case, digits and non-ASCII bytes as they are, everything else a space.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Where the counts over all documents stand among those by term.
DOCUMENTS, TERMS = -1, -2


def spaced(text: str | None) -> tuple[str, int]:
    """The text with nothing but terms and spaces, a space at either end, and the number of terms."""
    plain = (text or "").encode("utf-8", "surrogatepass").translate(PLAIN)
    return f" {plain.decode('utf-8', 'surrogatepass')} ", len(plain.split())


class Block:
    """The terms of some items: the automaton, and per term the items that hold it and how often."""

    def __init__(self, items: list[tuple[object, Counter]]):
        import ahocorasick

        self.ids = [number for number, _ in items]
        self.terms = sorted({t for _, terms in items for t in terms})
        self.automaton = ahocorasick.Automaton()
        place = {t: k for k, t in enumerate(self.terms)}
        for term, k in place.items():
            self.automaton.add_word(f" {term} ", k)
        if self.terms:
            self.automaton.make_automaton()
        cells = sorted((place[t], item, n) for item, (_, terms) in enumerate(items) for t, n in terms.items())
        table = np.array(cells, np.int64).reshape(-1, 3)
        self.start = np.searchsorted(table[:, 0], np.arange(len(self.terms) + 1))
        self.item, self.times = table[:, 1].copy(), table[:, 2].copy()

    def counts(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of terms of the text, the block's terms in it, ascending, and how often each occurs."""
        plain, n = spaced(text)
        found = Counter(k for _, k in self.automaton.iter(plain)) if n else {}
        terms = np.fromiter(found, np.int64, len(found))
        times = np.fromiter(found.values(), np.int64, len(found))
        order = np.argsort(terms)
        return n, terms[order], times[order]

    def scores(self, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The sum of the terms' values for each item, repeats included."""
        first, size = self.start[terms], self.start[terms + 1] - self.start[terms]
        cell = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out = np.zeros(len(self.ids), np.int64)
        np.add.at(out, self.item[cell], np.repeat(values, size) * self.times[cell])
        return out


def blocks(items: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[Block]:
    """The item rows in blocks; only one block is in memory at a time."""
    held, chars, seen = [], 0, set()
    for row in items.select("item_id", common.words("text").alias("w")).toLocalIterator():
        terms = Counter(row["w"])
        new = set(terms) - seen
        more = sum(len(t) + 2 for t in new)
        if held and chars + more > limit:
            yield Block(held)
            held, seen, new = [], set(), set(terms)
            chars, more = 0, sum(len(t) + 2 for t in new)
        held.append((row["item_id"], terms))
        seen |= new
        chars += more
    if seen:
        yield Block(held)


def _texts(docs: DataFrame) -> DataFrame:
    common.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text")


def statistics(docs: DataFrame, shared, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the documents that hold each term of the block."""

    def run(batches):
        import pyarrow as pa

        block = pickle.loads(shared.value)
        held, documents, total = np.zeros(len(block.terms), np.int64), 0, 0
        for batch in batches:
            for text in batch.column("text"):
                n, terms, _ = block.counts(text.as_py())
                held[terms] += 1
                documents, total = documents + (n > 0), total + n
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": np.append(some, [DOCUMENTS, TERMS]), "n": np.append(held[some], [documents, total])})

    summed = _texts(docs).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    by_term = {r["term"]: r["n"] for r in summed.toLocalIterator()}  # a row per term of the block at most
    return by_term.pop(DOCUMENTS, 0), by_term.pop(TERMS, 0), np.array([by_term.get(k, 0) for k in range(n_terms)], np.int64)


def weights(documents: int, held: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


def best(docs: DataFrame, shared, documents: int, total: int, weight: np.ndarray, places: int = PLACES) -> DataFrame:
    """(item, doc_id, score): what may stand among the first places of each item; a task sends `places` rows per item."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        block = pickle.loads(shared.value)
        heaps: list[list] = [[] for _ in block.ids]
        least = np.ones(len(heaps), np.int64)
        for batch in batches:
            for number, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, terms, tf = block.counts(text.as_py())
                if not len(terms):
                    continue
                m = 25 + 75 * n * documents // total
                scores = block.scores(terms, weight[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m)))
                for item in np.flatnonzero(scores >= least).tolist():
                    heap, entry = heaps[item], (int(scores[item]), number is not None, -(number or 0))
                    if len(heap) < places:
                        heapq.heappush(heap, entry)
                    else:
                        heapq.heappushpop(heap, entry)
                    if len(heap) == places:
                        least[item] = heap[0][0]
        rows = [(item, -minus if known else None, score) for item, heap in enumerate(heaps) for score, known, minus in heap]
        for k in range(0, len(rows), 10_000):
            item, number, score = zip(*rows[k : k + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(number, pa.int64()), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    found = _texts(docs).mapInArrow(run, "item int, doc_id long, score long")
    return found.select("item", F.col("doc_id").cast(kind).alias("doc_id"), "score")


def ranked(found: DataFrame, places: int = PLACES) -> DataFrame:
    """The first places of each item, with their rank."""
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    sliced = found.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    some = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("item", "slice").orderBy(*order))).where(F.col("rank") <= places)
    placed = some.drop("rank", "slice").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return placed.where(F.col("rank") <= places)


def search(docs: DataFrame, items: DataFrame, places: int = PLACES, limit: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score) for each row of `items`, against all of `docs`."""
    spark, steps = docs.sparkSession, StepTables(docs.sparkSession, "ranked-search")
    id_kind, doc_kind = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    out = None
    for block in blocks(items, limit):
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {id_kind}")
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(block))  # with its class, so executors need no package
        documents, total, held = statistics(docs, shared, len(block.terms))
        found = ranked(best(docs, shared, documents, total, weights(documents, held), places), places)
        saved = steps.save(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "block")
        shared.destroy()
        out = saved if out is None else out.unionByName(saved)
    return out if out is not None else spark.createDataFrame([], f"item_id {id_kind}, rank int, doc_id {doc_kind}, score long")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS documents, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
q AS (
  SELECT i, item_id, term, count(*) AS times
  FROM (SELECT i, item_id, unnest(w) AS term
    FROM (SELECT row_number() OVER () AS i, item_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark WHERE text IS NOT NULL))
  GROUP BY i, item_id, term),
u AS (SELECT term, count(*) AS df FROM t WHERE term IN (SELECT term FROM q) GROUP BY term),
v AS (
  SELECT t.r, t.term,
    CAST(floor(1000 * ln((2 * s.documents + 2) / (2 * u.df + 1))) AS BIGINT)
      * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * len(d.w) * s.documents) // s.total))) AS value
  FROM t JOIN u USING (term) JOIN d USING (r), s),
p AS (SELECT q.i, q.item_id, v.r, CAST(sum(q.times * v.value) AS BIGINT) AS score FROM q JOIN v USING (term) GROUP BY q.i, q.item_id, v.r),
o AS (SELECT i, item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM p JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""
