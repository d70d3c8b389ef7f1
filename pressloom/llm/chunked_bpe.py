"""BPE encoding with content-defined chunk reuse.

A rolling hash over the last 16 bytes cuts every text into chunks, so a passage that several documents share is cut alike in
all of them.  A chunk that occurs more than once in the corpus is encoded once and its tokens are joined back; everything
between such chunks is encoded where the document is read.  Tokens at a chunk's ends may differ from those of the whole
text, so each join is repaired: the stretch between the last safe place before the join and the first one after it is
encoded anew, and the stretch is widened by one safe place on each side until the wider encoding agrees with the narrower
one.  A safe place is white space (space or newline) after a printable ASCII character: the pattern of the vocabulary
always starts a piece there, whatever stands around it, so tokens on both sides do not depend on each other.

Plan.  (1) Hashes of all chunks, counted (with a partial count in each task).  (2) The repeated ones go into a bit set of
bounded size, which is broadcast.  It can only err by calling a chunk repeated that is not; that chunk then takes the longer
way, with the same result, so a full bit set at any size costs traffic and nothing else.  (3) A document without a repeated
chunk is finished where it is read.  Of the others, the tokens of the stretches between go to the document's key, and each
repeated chunk goes to its digest as a reference, with its text once per task.  (4) There it is encoded once, and its tokens
go on to the documents that refer to it.  A chunk of more than `HOT` occurrences would be a hot key; such chunks are in a
second bit set, and each is encoded once per task that refers to it instead.  (5) Each distinct text is put together once, and
documents join the result by the digest of their text.

Edge cases: NULL and empty texts have no tokens; copies share one result and get a row each; a NULL doc_id is carried
through; a text that spells a special token holds that token, also where a chunk ends inside it; a text without any safe
place is encoded as a whole; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm import common, tokenizer_files
from pressloom.session import StepTables

MEAN_BITS, LEAST, MOST = 9, 128, 4096  # chunks of 2^9 bytes above the least size, on average
WINDOW_STEPS = (1, 2, 4, 8)
KEY_BITS = 16  # bits of the set per repeated chunk
MAX_SET_BITS = 1 << 28
SEGMENTS = 64
HOT = 1000
REMEMBER = 200_000


def _gear() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)


def cut(data: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text, each between two characters."""
    size = len(data)
    if size <= LEAST:
        return [size] if size else []
    rolled = _GEAR[np.frombuffer(data, np.uint8)]
    for step in WINDOW_STEPS:
        wider = rolled.copy()
        wider[step:] += rolled[:-step] << np.uint64(step)
        rolled = wider
    places = np.flatnonzero((rolled >> np.uint64(64 - MEAN_BITS)) == 0) + 1
    ends, last = [], 0
    for place in [*places.tolist(), size]:
        while place - last > MOST:
            forced = last + MOST
            while data[forced] & 0xC0 == 0x80:
                forced -= 1
            ends.append(forced)
            last = forced
        if place - last < LEAST and place < size:
            continue
        while place < size and data[place] & 0xC0 == 0x80:
            place += 1
        if place > last:
            ends.append(place)
            last = place
    return ends


_GEAR = _gear()


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def in_set(bits: np.ndarray | None, numbers: np.ndarray) -> np.ndarray:
    """Whether each number may be in the set; two bits per number, in the number's segment."""
    if bits is None or not len(bits):
        return np.zeros(len(numbers), bool)
    found = np.ones(len(numbers), bool)
    for place in _places(numbers, len(bits) * 8 // SEGMENTS):
        found &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return found


def _places(numbers: np.ndarray, width: int) -> list[np.ndarray]:
    n = numbers.astype(np.uint64)
    base = (n % np.uint64(SEGMENTS)).astype(np.int64) * width
    return [base + ((n >> np.uint64(shift)) % np.uint64(width)).astype(np.int64) for shift in (8, 33)]


def repeated_sets(docs: DataFrame, steps: StepTables) -> tuple[np.ndarray, np.ndarray]:
    """The bit sets of all chunks that occur more than once in the corpus, and of those with more than HOT occurrences."""

    def chunks(batches):
        import pyarrow as pa

        seen: dict[int, int] = {}

        def flush():
            keys = np.fromiter(seen, np.int64, len(seen))
            counts = np.fromiter(seen.values(), np.int64, len(seen))
            seen.clear()
            return pa.RecordBatch.from_pydict({"h": keys, "n": counts})

        for batch in batches:
            for text in batch.column(0).to_pylist():
                data, last = (text or "").encode("utf-8", "surrogatepass"), 0
                for end in cut(data):
                    h = int.from_bytes(digest(data[last:end])[:8], "little", signed=True)
                    seen[h] = seen.get(h, 0) + 1
                    last = end
            if len(seen) >= REMEMBER:
                yield flush()
        if seen:
            yield flush()

    counted = docs.select("text").mapInArrow(chunks, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    shared = steps.save(counted.where("n > 1"), "repeated")
    sets = _bit_set(shared.select("h")), _bit_set(shared.where(F.col("n") > HOT).select("h"))
    steps.drop(shared)
    return sets


def _bit_set(numbers: DataFrame) -> np.ndarray:
    wanted = max(numbers.count() * KEY_BITS, 1 << 13)
    width = min(1 << int(wanted - 1).bit_length(), MAX_SET_BITS) // SEGMENTS

    def segment(batches):
        import pyarrow as pa

        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            which = (values % np.uint64(SEGMENTS)).astype(np.int64)
            for s in np.unique(which):
                bits = parts.setdefault(int(s), np.zeros(width, bool))
                for place in _places(values[which == s], width):
                    bits[place - s * width] = True
        for s, bits in parts.items():
            yield pa.RecordBatch.from_pydict({"s": [s], "bits": [np.packbits(bits, bitorder="little").tobytes()]}, schema=pa.schema([("s", pa.int32()), ("bits", pa.binary())]))

    merged = np.zeros((SEGMENTS, width // 8), np.uint8)
    keyed = numbers.repartition(F.pmod(F.col("h"), F.lit(SEGMENTS)))
    for row in keyed.mapInArrow(segment, "s int, bits binary").collect():  # at most MAX_SET_BITS in all
        merged[row["s"]] |= np.frombuffer(row["bits"], np.uint8)
    return merged.reshape(-1)


# --- joins


def _safe_before(ids: list[int], stop: int, table: list[bytes]) -> int:
    """The last safe token number below `stop`, 0 at the start of the text."""
    for k in range(stop - 1, 0, -1):
        first = table[ids[k]][:1]
        if (first == b" " or first == b"\n") and 0x20 < table[ids[k - 1]][-1] < 0x7F:
            return k
    return 0


def _safe_after(ids: list[int], start: int, table: list[bytes]) -> int:
    """The first safe token number above `start`, the number of tokens if there is none."""
    for k in range(start + 1, len(ids)):
        first = table[ids[k]][:1]
        if (first == b" " or first == b"\n") and 0x20 < table[ids[k - 1]][-1] < 0x7F:
            return k
    return len(ids)


def join(left: list[int], right: list[int], encode: Callable[[str], list[int]], table: list[bytes]) -> None:
    """Append the tokens of the text after `left` to it, repairing the join until a wider encoding agrees."""

    def between(a: int, b: int) -> list[int]:
        data = b"".join([table[i] for i in left[a:]] + [table[i] for i in right[:b]])
        return encode(data.decode("utf-8"))

    if not left or not right:
        left.extend(right)
        return
    a, b = _safe_before(left, len(left), table), _safe_after(right, 0, table)
    narrow = between(a, b)
    while a > 0 or b < len(right):
        wider_a, wider_b = _safe_before(left, a, table) if a else 0, _safe_after(right, b, table) if b < len(right) else b
        wide = between(wider_a, wider_b)
        agreed = wide == left[wider_a:a] + narrow + right[b:wider_b]
        if agreed:
            break
        a, b, narrow = wider_a, wider_b, wide
    del left[a:]
    left.extend(narrow)
    left.extend(right[b:])


def assemble(parts: list[list[int]], encode: Callable[[str], list[int]], table: list[bytes]) -> list[int]:
    out: list[int] = []
    for part in parts:
        join(out, part, encode, table)
    return out


_NUMBERS: list[str] = []


def finished(ids: list[int], table: list[bytes]) -> bytes:
    """n_tokens and the two digests of a document in one value."""
    if not _NUMBERS:
        _NUMBERS.extend(map(str, range(len(table))))
    text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
    listed = ",".join([_NUMBERS[i] for i in ids])
    return len(ids).to_bytes(8, "big") + hashlib.sha256(listed.encode()).digest() + hashlib.sha256(text.encode()).digest()


# --- the plan

ROW = "key binary, place int, chunk binary, deal int, data binary"


def _rows(rows: list[tuple]):
    import pyarrow as pa

    names, kinds = ("key", "place", "chunk", "deal", "data"), (pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=list(names))


def pack(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").astype("<u2" if not ids or max(ids) < 1 << 16 else "<u4").tobytes()


def unpack(data: bytes, wide: bool) -> list[int]:
    return np.frombuffer(data, "<u4" if wide else "<u2").tolist()


def _reader(shared, vocabulary: str, references: bool):
    """Rows of each distinct text: with references, a row per repeated chunk; else its own stretches, or the finished text (place -1)."""

    def run(batches) -> Iterator:
        from pyspark import TaskContext

        bits, hot_bits = shared.value
        task = TaskContext.get().partitionId() + 1
        table = tokenizer_files.token_bytes(vocabulary)
        done: set[bytes] = set()
        sent: set[bytes] = set()
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                data = (text or "").encode("utf-8", "surrogatepass")
                key = hashlib.md5(data).digest()
                if key in done:
                    continue
                if len(done) >= REMEMBER:
                    done.clear()
                done.add(key)
                ends = cut(data)
                starts = [0, *ends[:-1]]
                digests = [digest(data[s:e]) for s, e in zip(starts, ends)]
                numbers = np.frombuffer(b"".join(d[:8] for d in digests), "<u8")
                repeated = in_set(bits, numbers)
                if references:
                    hot = in_set(hot_bits, numbers)
                    for k in np.flatnonzero(repeated).tolist():
                        if len(sent) >= REMEMBER:
                            sent.clear()
                        known = digests[k] in sent
                        sent.add(digests[k])
                        rows.append((key, k, digests[k], task if hot[k] else 0, None if known else data[starts[k] : ends[k]]))
                elif not repeated.any():
                    rows.append((key, -1, None, 0, finished(tokenizer_files.encode(data.decode(), vocabulary), table)))
                else:
                    k = 0
                    while k < len(ends):
                        stop = k
                        while stop < len(ends) and not repeated[stop]:
                            stop += 1
                        if stop > k:
                            ids = tokenizer_files.encode(data[starts[k] : ends[stop - 1]].decode(), vocabulary)
                            rows.append((key, k, None, 0, pack(ids)))
                        k = stop + 1
            if rows:
                yield _rows(rows)

    return run


def _encoder(vocabulary: str):
    """Each chunk is encoded once, a hot one once per deal; rows come sorted by chunk and deal, its text first."""

    def run(batches) -> Iterator:
        last, tokens = None, b""
        for batch in batches:
            rows = []
            for key, place, chunk, deal, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (chunk, deal) != last:
                    last, tokens = (chunk, deal), pack(tokenizer_files.encode(data.decode(), vocabulary))
                rows.append((key, place, None, 0, tokens))
            if rows:
                yield _rows(rows)

    return run


def _assembler(vocabulary: str):
    """One row per text from its rows in order of place; a place that came from several copies counts once."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        table = tokenizer_files.token_bytes(vocabulary)
        wide = len(table) > 1 << 16
        encode = lambda text: tokenizer_files.encode(text, vocabulary)
        current, seen, parts, whole = None, None, [], None

        def close():
            return current, whole or finished(assemble(parts, encode, table), table)

        for batch in batches:
            out = []
            for key, place, data in zip(*(batch.column(n).to_pylist() for n in ("key", "place", "data"))):
                if key != current:
                    if current is not None:
                        out.append(close())
                    current, seen, parts, whole = key, None, [], None
                if place == -1:
                    whole = data
                elif place != seen:
                    parts.append(unpack(data, wide))
                    seen = place
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["key", "made"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in close()], names=["key", "made"])

    return run


def texts_encoded(docs: DataFrame, vocabulary: str = tokenizer_files.BPE_RANKS) -> DataFrame:
    """key (MD5 of the text), n_tokens, ids_sha256, decoded_sha256 of every distinct text."""
    spark = docs.sparkSession
    common.small_batches(spark)
    texts = docs.select(common.whole("text").alias("text"))
    shared = spark.sparkContext.broadcast(repeated_sets(texts, StepTables(spark, "chunks")))
    own = texts.mapInArrow(_reader(shared, vocabulary, False), ROW)
    asked = texts.mapInArrow(_reader(shared, vocabulary, True), ROW)
    asked = asked.repartition("chunk", "deal").sortWithinPartitions("chunk", "deal", F.col("data").isNull())
    every = own.unionByName(asked.mapInArrow(_encoder(vocabulary), ROW)).select("key", "place", "data")
    made = every.repartition("key").sortWithinPartitions("key", "place").mapInArrow(_assembler(vocabulary), "key binary, made binary")
    part = lambda start, size: F.substring("made", start, size)
    return made.select(
        "key",
        F.conv(F.hex(part(1, 8)), 16, 10).cast("long").alias("n_tokens"),
        F.lower(F.hex(part(9, 32))).alias("ids_sha256"),
        F.lower(F.hex(part(41, 32))).alias("decoded_sha256"),
    )


def report(docs: DataFrame, vocabulary: str = tokenizer_files.BPE_RANKS) -> DataFrame:
    made = texts_encoded(docs, vocabulary)
    keyed = docs.select("doc_id", F.unhex(F.md5(common.whole("text").cast("binary"))).alias("key"))
    return keyed.join(made, "key").drop("key")
