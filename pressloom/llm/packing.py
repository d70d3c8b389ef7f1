"""Best-fit packing: pieces of encoded documents into sequences of at most 4096 tokens, online and in bounded space.

A document is its token ids and an end id.  Only documents beyond the capacity are cut, into pieces of the capacity and a
rest.  Each piece goes into the open sequence with the least free space that holds it; where none does, a new one opens, and
if `OPEN` are open already, the fullest closes first.  A bitset with one bit per free space finds both: the lowest bit at or
above a length is the best fit, the lowest bit of all is the fullest.

Plan.  Every task packs the pieces that it reads, where they are encoded.  What its open sequences hold at its end, at most
`OPEN` times the capacity in pieces, is packed again with that of `FAN_IN` - 1 other tasks, and so on until one group is left,
so no task gets more than `FAN_IN` leftovers.  Those groups take their pieces in the order of a hash, since in bounded space
large pieces in a row fill the open sequences before the small ones come.  The last group may have `FAN_IN` times as many
sequences open, which is room for all that it gets, and takes the longest pieces first.
Rows carry lengths and digests, no tokens.  Each level is a written table, so a lost task is run again alone.

Encoding.  The tokenizer cuts at white space before anything else, so each run between ASCII spaces, tabs and line ends is
encoded by itself, and a worker keeps the ids of short runs it has seen.  It also cuts between letters and symbols, so full
stops and commas behind letters become runs of their own, and a run of letters with other symbols around it is put together
of those.  A-Z become lower case first, as the tokenizer does, in texts where nothing can compose with them.  The new runs of
letters of a batch are encoded in one call, one to a line, and each ends at the first id that ends a word.  Any other new run
is encoded alone.

Edge cases: NULL and empty texts are the end id alone; repeated rows and doc_ids are packed row by row, pieces counted from 0
in each; a NULL doc_id is carried through; an empty table gives no rows; other columns are never looked at.  Sequence numbers
are unique, but neither dense nor the same from run to run.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pressloom.llm import common, tokenizer_files
from pressloom.session import StepTables

CAPACITY = 4096
END = 1
OPEN = 256
FAN_IN = 16
VOCABULARY = "word_bpe_49k.json"
#: Texts of up to so many bytes are kept with their ids, in two generations of up to so many of them.
SHORT, KEPT = 64, 300_000
#: Symbols that stand apart from letters in the tokenizer's cut, whatever is beside them.
SYMBOLS = ".,;:!?#$%&*()[]{}-_+=/@~^\""
_STOP = re.compile(rb"[.,](?<=[a-z][.,])(?=[ \n])")
_BEYOND = re.compile("[\u0250-\U0010ffff]")


class Recent(dict):
    """A table that forgets: between batches, when it has grown beyond its limit, it becomes the older generation."""

    def __init__(self, limit: int = KEPT):
        super().__init__()
        self.limit, self.older = limit, {}

    def unknown(self, keys: set) -> set:
        """The keys that neither generation has; those of the older one return."""
        away = keys.difference(self)
        back = away.intersection(self.older)
        self.update((k, self.older[k]) for k in back)
        return away - back

    def turn(self, long: set) -> None:
        for key in long:
            del self[key]
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Ids of texts, as little-endian 32-bit numbers."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_files.place(vocabulary))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[k for name, k in names.items() if name.endswith("</w>")]] = True
        self.runs, self.long = Recent(), []

    def alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of letters, which are one piece each to the tokenizer."""
        lines = b"\n".join(words).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([lines], add_special_tokens=False)[0].ids, "<u4") if words else np.empty(0, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            return [self.alone(w.decode()) for w in words]
        flat, stops = ids.tobytes(), (4 * stops).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def _learn(self, runs: set[bytes]) -> None:
        words, cut = [], {}
        for run in runs:
            if run.isalpha():  # ASCII letters only
                words.append(run)
                continue
            text = run.decode("utf-8", "replace")
            word = text.strip(SYMBOLS)
            # Letters below U+0250 are composed already, and letters in lower case as well but for one.
            if not word or not word.isalpha() or not (word.isascii() or max(word) < "\u0250" and word.lower().isalpha()):
                self.runs[run] = self.alone(text)
            elif word == text:
                words.append(run)
            else:
                head, _, tail = text.partition(word)
                cut[run] = (head.encode(), word.encode(), tail.encode())
        # What a run is put together of is known, or is encoded with the others.
        parts = self.runs.unknown({part for parts in cut.values() for part in parts}.difference(words))
        words += [part for part in parts if part[:1].isalpha() or part[:1] > b"\x7f"]
        self.runs.update((part, self.alone(part.decode())) for part in parts.difference(words))
        self.runs.update(zip(words, self._letters(words)))
        ids = self.runs.__getitem__
        self.runs.update([(run, b"".join(map(ids, parts))) for run, parts in cut.items()])
        self.long = [run for run in (*words, *parts, *runs) if len(run) > SHORT]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        split = [_plain(t or b"").split() for t in texts]
        self._learn(self.runs.unknown(set(chain.from_iterable(split))))
        ids = self.runs.__getitem__
        out = [b"".join(map(ids, runs)) for runs in split]
        self.runs.turn({*self.long})
        return out


def _plain(text: bytes) -> bytes:
    """The text in lower case and with its stops apart, where that changes no id."""
    if b"<|" in text or not (text.isascii() or not _BEYOND.search(text.decode("utf-8", "replace"))):
        return text
    return _STOP.sub(rb" \g<0>", text.lower())


def encoded(texts: list[bytes | None], vocabulary: str = VOCABULARY) -> list[bytes]:
    """The ids of the documents, their end ids included, as little-endian 32-bit numbers."""
    encoder = tokenizer_files.kept(f"runs {vocabulary}", lambda: Encoder(vocabulary))
    return [ids + END.to_bytes(4, "little") for ids in encoder.encode(texts)]


def pieces(docs: DataFrame, with_ids: bool = False, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; with_ids adds `ids`, little-endian 32-bit numbers."""
    common.small_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            numbers, texts = batch.column("doc_id"), batch.column("text").cast(pa.binary())
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, whole in enumerate(encoded(texts.to_pylist(), vocabulary)):
                for number, at in enumerate(range(0, len(whole), 4 * capacity)):
                    cut = whole[at : at + 4 * capacity]
                    row.append(k)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
                    if with_ids:
                        ids.append(cut)
            columns = {"doc_id": numbers.take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32())}
            columns |= {name: pa.array(values, pa.int64()) for name, values in (("start", start), ("length", length), ("ids_crc32", crc))}
            if with_ids:
                columns["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class Bins:
    """The open sequences of one packer."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.count, self.opened = 0, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        numbers = self.by_free[free]
        number = numbers.pop()
        if not numbers:
            self.bits ^= 1 << free
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The sequence of a piece and its offset there."""
        fitting = self.bits >> length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + length
            number = self._take(free)
        else:
            if self.count == self.limit and length < self.capacity:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.opened
            self.opened += 1
        if free > length:
            self.by_free.setdefault(free - length, []).append(number)
            self.bits |= 1 << (free - length)
            self.count += 1
        return number, self.capacity - free

    def still_open(self) -> list[int]:
        return [n for numbers in self.by_free.values() for n in numbers]


def packed(batches, capacity: int, limit: int, last: bool):
    """The rows with sequence (a number in this task), offset and open; rows leave when their sequence closes."""
    import pyarrow as pa

    bins, left = Bins(capacity, limit), None
    for batch in batches:
        placed = [bins.place(n) for n in batch.column("length").to_pylist()]
        for place, name in enumerate(("sequence", "offset")):
            batch = batch.append_column(name, pa.array([p[place] for p in placed], pa.int64()))
        rows = pa.Table.from_batches([batch])
        rows = rows if left is None else pa.concat_tables([left, rows])
        waiting = np.isin(rows.column("sequence").to_numpy(), bins.still_open())
        done, left = rows.filter(pa.array(~waiting)), rows.filter(pa.array(waiting)).combine_chunks()
        yield from done.append_column("open", pa.array(np.zeros(len(done), bool))).to_batches()
    if left is not None:
        yield from left.append_column("open", pa.array(np.full(len(left), not last))).to_batches()


def pack(rows: DataFrame, capacity: int = CAPACITY, limit: int = OPEN, fan_in: int = FAN_IN) -> DataFrame:
    """`rows`, whose column `length` is 1 to `capacity`, with sequence_id and offset.

    They must not have columns sequence, sequence_id, offset, open, task or group.
    """
    steps, columns = StepTables(rows.sparkSession, "packing"), rows.columns
    schema = StructType([*rows.schema.fields]).add("sequence", "long").add("offset", "long").add("open", "boolean")
    out, level, groups = None, 0, 0
    while True:

        def run(batches, last=groups == 1):
            return packed(batches, capacity, limit * fan_in if last else limit, last)

        saved = steps.save(rows.mapInArrow(run, schema).withColumn("task", F.spark_partition_id()), f"level-{level}")
        # A task numbers fewer than 2^32 sequences, a level has fewer than 2^24 tasks.
        number = F.lit(level << 56) + F.shiftleft(F.col("task").cast("long"), 32) + F.col("sequence")
        closed = saved.where("NOT open").select(*columns, number.alias("sequence_id"), "offset")
        out = closed if out is None else out.unionByName(closed)
        tasks = saved.where("open").agg(F.max("task")).first()[0]
        if tasks is None:
            return out
        # Fewer groups at each level, whatever number of partitions they lie in.
        level, groups = level + 1, -(-(groups or tasks + 1) // fan_in)
        rest = saved.where("open").select(*columns, F.pmod("task", F.lit(groups)).alias("group"))
        order = F.col("length").desc() if groups == 1 else F.xxhash64(*columns)
        rows = rest.repartitionById(groups, F.col("group")).sortWithinPartitions(order).select(*columns)


def sequences(docs: DataFrame, capacity: int = CAPACITY, limit: int = OPEN, vocabulary: str = VOCABULARY) -> DataFrame:
    """sequence_id, n_tokens and ids (little-endian 32-bit numbers) of the packed sequences."""
    placed = pack(pieces(docs, True, capacity, vocabulary), capacity, limit)
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # `capacity` pieces at most
    joined = F.aggregate("parts", F.lit(b""), lambda before, p: F.concat(before, p["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), inside.alias("parts")).select("sequence_id", "n_tokens", joined.alias("ids"))


def report(docs: DataFrame) -> DataFrame:
    return pack(pieces(docs))
