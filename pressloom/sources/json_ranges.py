"""JSON array files of any size, read by byte ranges.

Spark's text reader cuts the files into ranges and each range into pieces that end at a "}", by its own file systems.  A
piece can begin anywhere: inside a string or at any depth.  So a first pass walks each range twice, once as if it began
outside a string and once as if inside, and gives one row for it: where either walk ends, and how many records close at which
depth.  The ranges of a file, a row each, are then put in order and added up, which tells the true state and the number of
records before each range.  A second pass starts from there and cuts out the records; those that cross ranges leave as
fragments and are joined by file and position.  No task holds more than a record and a piece.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.schemas import ARTICLE_FIELDS

MAX_BROADCAST_RANGES = 200_000
_TOKEN = re.compile(r'\\.|["{}\[\]]', re.S)
_RANGE = ("path", "start")


def _pieces(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    reader = spark.read.option("lineSep", "}").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    meta = F.col("_metadata")
    return reader.text(folder).select("value", meta["file_path"].alias("path"), meta["file_name"].alias("name"), meta["file_block_start"].alias("start"))


def _ranges(batches, names: Sequence[str]) -> Iterator[tuple[dict, Iterator[str]]]:
    """The ranges of a task, one after the other, as the columns of their first piece and their texts with each "}"."""
    rows = (dict(zip(names, row)) for batch in batches for row in zip(*(batch.column(n).to_pylist() for n in names)))
    held = [next(rows, None)]

    def texts(first: dict) -> Iterator[str]:
        row = first
        while row is not None and (row["path"], row["start"]) == (first["path"], first["start"]):
            # The "}" before a piece is not part of it, and only the first piece of a file has none.
            yield row["value"] if row is first and not row["start"] else "}" + row["value"]
            held[0] = row = next(rows, None)

    while held[0] is not None:
        first = held[0]
        inside = texts(first)
        yield first, inside
        for _ in inside:
            pass


class Walk:
    """String and depth state over a text, from a start that may be relative."""

    def __init__(self, in_string: bool, depth: int = 0):
        self.in_string, self.depth = in_string, depth
        self.opened: Counter[int] = Counter()

    def feed(self, text: str) -> None:
        for token in _TOKEN.finditer(text):
            self.step(token.group())

    def step(self, token: str) -> None:
        if token == '"':
            self.in_string = not self.in_string
        elif not self.in_string:
            if token == "{":
                self.opened[self.depth] += 1
            self.depth += {"{": 1, "[": 1, "}": -1, "]": -1}.get(token, 0)


def _summaries(batches):
    import pyarrow as pa

    out = []
    for first, texts in _ranges(batches, ("path", "name", "start", "value")):
        walks, opens = [Walk(False), Walk(True)], None
        for text in texts:
            if opens is None and text.strip("\ufeff \t\r\n"):
                opens = text.lstrip("\ufeff \t\r\n")[0]
            for walk in walks:
                walk.feed(text)
        for walk, began in zip(walks, (False, True)):
            out.append((first["path"], first["start"], began, opens, walk.in_string, walk.depth, list(walk.opened.items())))
    if out:
        names = ("path", "start", "began", "opens", "in_string", "depth", "opened")
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.bool_(), pa.int64(), pa.map_(pa.int64(), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], list(names))


def _states(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state at the start of each range of a file; none for a file that is not one whole array."""
    by = {(r.start, r.began): r for r in ranges.itertuples()}
    in_string, depth, before, out = False, 0, 0, []
    starts = sorted(set(ranges["start"]))
    for start in starts:
        out.append((ranges["path"].iloc[0], start, in_string, depth, before))
        found = by[start, in_string]
        # Records open at depth 1, which is 1 - depth as the range sees it.
        before += dict(found.opened).get(1 - depth, 0)
        in_string, depth = found.in_string, depth + found.depth
    opens = next((by[s, False].opens for s in starts if by[s, False].opens), None)
    whole = opens == "[" and not in_string and depth == 0
    return pd.DataFrame(out if whole else [], columns=["path", "start", "in_string", "depth", "before"])


def _records(batches):
    """Records with their position, and fragments of those that cross ranges."""
    import pyarrow as pa

    names = ("path", "name", "start", "value", "in_string", "depth", "before")
    schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("pos", pa.int64()), ("start", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())])
    out: list[tuple] = []
    size = 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    for first, texts in _ranges(batches, names):
        walk, pos, parts = Walk(first["in_string"], first["depth"]), first["before"], []
        begun, crossed = walk.depth > 1, walk.depth > 1
        pos -= begun
        for text in texts:
            at = 0
            for token in _TOKEN.finditer(text):
                before = walk.depth
                walk.step(token.group())
                if walk.depth > before == 1 and token.group() == "{":
                    begun, at = True, token.start()
                elif begun and walk.depth < before == 2:
                    parts.append(text[at : token.end()])
                    out.append((first["path"], first["name"], pos, first["start"], not crossed, "".join(parts)))
                    size += len(out[-1][-1])
                    begun, crossed, parts, pos = False, False, [], pos + 1
                    if size > 1 << 22:
                        yield batch()
                        out, size = [], 0
            if begun:
                parts.append(text[at:])
        if begun:
            out.append((first["path"], first["name"], pos, first["start"], False, "".join(parts)))
    if out:
        yield batch()


def read_arrays(spark: SparkSession, folder: str, pattern: str = "*.json", fields: Sequence[str] = ARTICLE_FIELDS) -> DataFrame:
    """Rows of all array files below `folder`: the fields, the unknown ones in `extra`, `_file` and `_pos`.

    A file that is not one whole JSON array gives no rows.  Elements that are not objects are left out and have no position;
    an object that is not valid JSON is left out alone.  Ranges follow `spark.sql.files.maxPartitionBytes`; rows and
    positions are the same for any.
    """
    cut = _pieces(spark, folder, pattern)
    summary = "path string, start long, began boolean, opens string, in_string boolean, depth long, opened map<long,long>"
    ranges = cut.mapInArrow(_summaries, summary).groupBy("path").applyInPandas(_states, "path string, start long, in_string boolean, depth long, before long")
    found = _joined(cut, ranges).mapInArrow(_records, "path string, name string, pos long, start long, whole boolean, text string")
    return _rows(found, fields)


def _joined(cut: DataFrame, ranges: DataFrame) -> DataFrame:
    """The pieces with the state at the start of their range, in the order of the file.

    A few ranges are broadcast, which leaves the pieces in place; with more, the pieces are dealt out by range.
    """
    from pressloom.session import StepTables

    saved = StepTables(cut.sparkSession, "json-ranges").save(ranges, "ranges")
    if saved.count() <= MAX_BROADCAST_RANGES:
        return cut.join(F.broadcast(saved), list(_RANGE))
    numbered = cut.withColumn("at", F.monotonically_increasing_id())
    return numbered.join(saved, list(_RANGE)).repartition(*_RANGE).sortWithinPartitions(*_RANGE, "at").drop("at")


def _rows(found: DataFrame, fields: Sequence[str]) -> DataFrame:
    key = ["path", "name", "pos"]
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))  # the ranges that a record crosses
    crossing = found.where("NOT whole").groupBy(*key).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    texts = found.where("whole").select(*key, "text").unionByName(crossing)
    records = texts.select("name", "pos", F.from_json("text", "map<string,string>").alias("_rec")).where(F.col("_rec").isNotNull())
    extra = F.map_filter("_rec", lambda k, v: ~k.isin(*fields))
    return records.select(
        *[F.col("_rec").getItem(f).alias(f) for f in fields],
        F.when(F.size(extra) > 0, extra).alias("extra"),
        F.col("name").alias("_file"),
        F.col("pos").alias("_pos"),
    )
