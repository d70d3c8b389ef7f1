"""Near-duplicates by the Jaccard similarity of their sets of five-word shingles, exact at 0.8 or more.

Fingerprints.  Every set has a SimHash of 64 bits, and the BK-trees of `simhash` find the fingerprints that link; copies of one
fingerprint are held against the first vertex that has it.  Each such pair is checked on both sets.  Two texts at 0.8 differ in
some ten bits, often more, and pigeonhole bands for so wide a radius are three or four bits each, which cut nothing.  So what
lies beyond the radius is found by an exact search besides, which the groups that the fingerprints gave make smaller.

Candidates.  A set at 0.8 or more to another has at least 0.8 of its shingles in common with it, so a set of which fewer occur
elsewhere is near no other.  The shingles of some thousands of texts, by their high 40 bits, travel as sorted runs of
differences, with the text of each, to the tasks that see each slot whole; these tell the groups of texts which entries another
group has too.  A slot that several texts of a group share travels once.  Only sets with enough repeated shingles go on.

Search.  Prefix filtering, which loses no pair: shingles are put in one order for the whole corpus, and of two sets of n
and m shingles at 0.8 or more, each holds a common one among its first n - ceil(0.8 n) + 1 in that order.  The order is that of
the number of candidates that hold a shingle, exactly counted; those of one set alone are first and are no rows.

Pairs.  Copies have one set and are one vertex.  First each vertex is held against one other: that which comes first in most
of the vertex's shingles.  So a group of thousands of near copies costs a pair per vertex, not one per two of them.  The
pairs that are at 0.8 or more, these and those of the fingerprints, are contracted; then every two vertices that share a first
shingle and are not yet in one group are compared inside the task.  Their sizes, places of a shared shingle and sketches (the
parities of 2048 classes of shingles; they differ in no more bits than the sets in shingles) tell which can be at 0.8.  No pair
becomes a row for that: from a shingle only a forest leaves the task that connects its possible pairs, less than a row per vertex.
What is so connected is a family.  Each vertex's set travels to its family, where the possible pairs of different groups are
checked on both whole sets and contracted at once, so that again less than a row per vertex leaves the task, a link each.
The comparison in the tasks, not the rows, grows with the square of the vertices in different groups that share a first shingle
or a family.

Plan.  Texts are shingled twice, for their numbers and for the candidates; the candidates' sets are then kept in a step table.
Their texts are found by the 64-bit hash of the text: by a broadcast of at most `MAX_BROADCAST` hashes, beyond that by a
shuffle.  A shingle that more than `LONG` vertices share is cut into blocks, the groups of more than `LONG` by vertex and the
rest by group, and each pair of blocks that can hold different groups is one unit of work.  What no later step reads is dropped.

Edge cases: as in simhash, words are split and put in lower case as ASCII; a text of fewer words than a shingle is one
shingle; texts without words, empty or NULL, are copies of each other; a group is everything reachable over links, and its
component_id the smallest number in it, NULL where no member has one; other columns are not looked at.  Shingles, sets and
texts are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm import common, simhash
from pressloom.operators.components import components
from pressloom.session import StepTables

SHINGLE = 5
#: The least similarity as a fraction, so that no rounding decides.
SHARED, OF = 4, 5
SEED = 42
#: Slots that are ordered by their counts, 12 bytes each; how many shingles are sorted together; the parts that slots lie in.
FREQUENT, LOOK, PARTS = 1 << 20, 1 << 18, 1 << 10
#: High bits of a shingle that are counted; shingles and texts of a group of texts; about how many are counted in one part.
SLOT_BITS, GROUP, SEVERAL, PART = 40, 1 << 19, (1 << 16) - 1, 1 << 21
#: Bits of a set's sketch; shingles of a set from which on the checks in a task have one of 16 times as many.
SKETCH, WIDE = 2048, 2048
CACHE = 50_000
#: Vertices of a shingle, or of a group in it, in one unit of work.
LONG = 4096
#: Shingles that count as one vertex where whole sets are held in a unit.
WEIGHT = 256
#: Hashes of texts that are broadcast, 16 bytes each.
MAX_BROADCAST = 2_000_000

_words: dict[bytes, int] = {}


def _word(word: bytes) -> int:
    import xxhash

    if len(_words) >= CACHE:
        _words.clear()
    got = _words[word] = xxhash.xxh64_intdigest(word, SEED)
    return got


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of all shingles, sorted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    known = _words.get
    hashes = np.array([known(w) or _word(w) for w in words], np.uint64)
    size = min(size, len(words))
    last = len(words) - size + 1
    mixed = np.full(last, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k : k + last]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def set_number(found: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def print_of(found: np.ndarray) -> int:
    """The SimHash of a set: the signed value of the bits that more than half of its shingles have."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(found), 1 << 14):
        counts += np.unpackbits(found[k : k + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(found), bitorder="little").view("<i8")[0])


def slots_of(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(32)).astype(np.uint32)


def _runs_of_slots(batches):
    """(part, first, run): the sorted slots of some texts in one part, as the first one and the differences, byte by byte."""
    import pyarrow as pa

    def cut(waiting: list[np.ndarray]):
        slots = np.sort(slots_of(np.concatenate(waiting)))
        parts = slots >> np.uint32(32 - PARTS.bit_length() + 1)
        start = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
        steps = np.diff(slots, prepend=slots[:1])
        runs = [np.append(np.uint32(0), x[1:]).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in np.split(steps, start[1:])]
        return pa.RecordBatch.from_arrays([pa.array(parts[start], pa.int32()), pa.array(slots[start], pa.int64()), pa.array(runs, pa.binary())], ["part", "first", "run"])

    waiting, size = [], 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            waiting.append(shingles(text))
            size += len(waiting[-1])
            if size > LOOK:
                yield cut(waiting)
                waiting, size = [], 0
    if size:
        yield cut(waiting)


def _counted_slots(limit: int):
    """The counts of one part after the other, of which only the largest can matter."""

    def run(batches):
        import pyarrow as pa

        width = (1 << 32) // PARTS
        part, counts = None, np.zeros(width, np.int32)

        def out():
            held = np.flatnonzero(counts > 1)
            if len(held) > limit:
                held = held[np.argpartition(counts[held], -limit)[-limit:]]
            return pa.RecordBatch.from_pydict({"slot": held + part * width, "n": counts[held].astype(np.int64)})

        for batch in batches:
            for number, first, packed in zip(*(batch.column(c).to_pylist() for c in ("part", "first", "run"))):
                if part != number:
                    if part is not None:
                        yield out()
                    part = number
                    counts[:] = 0
                steps = np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]
                np.add.at(counts, np.cumsum(steps, dtype=np.int64) + (first - part * width), 1)
        if part is not None:
            yield out()

    return run


def frequent_slots(docs: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit slots with the largest counts over one, ascending, and their counts.  `groups` counts exactly and needs none."""
    runs = docs.select(common.whole("text").alias("text")).mapInArrow(_runs_of_slots, "part int, first long, run binary")
    counted = runs.repartition("part").sortWithinPartitions("part").mapInArrow(_counted_slots(limit), "slot long, n long")
    table = counted.orderBy(F.desc("n"), "slot").limit(limit).toArrow()
    slots, counts = table.column("slot").to_numpy().astype(np.uint32), table.column("n").to_numpy()
    order = np.argsort(slots)
    return slots[order], counts[order]


def first_length(n: int) -> int:
    """How many of a set's n shingles must be looked at."""
    return n - (SHARED * n + OF - 1) // OF + 1


def vertices(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp, print, size) of every document row: the hash of its text, the number of its set, its SimHash and its size."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            columns = {
                "doc_id": batch.column("doc_id"),
                "mark": batch.column("mark"),
                "fp": pa.array([set_number(s) for s in sets], pa.int64()),
                "print": pa.array([print_of(s) for s in sets], pa.int64()),
                "size": pa.array([len(s) for s in sets], pa.int32()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", mark_of("text").alias("mark"), common.whole("text").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, mark long, fp long, print long, size int")


def _runs_of_texts(parts: int):
    """(part, group, first, run, docs): the slots of a group of texts in one part, ascending, each once, as the first one and the
    differences, byte by byte, and which text of the group has each, or `SEVERAL`.  One row more per group, with first NULL,
    tells the numbers of its sets and how many repeated shingles each lacks besides those repeated in the group."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        def cut(waiting: list[np.ndarray], group: int):
            sizes = np.array([len(s) for s in waiting])
            slots, owner = np.concatenate(waiting) >> np.uint64(64 - SLOT_BITS), np.repeat(np.arange(len(waiting)), sizes)
            order = np.argsort(slots, kind="stable")
            slots, owner = slots[order], owner[order]
            start = np.flatnonzero(np.append(True, slots[1:] != slots[:-1])) if len(slots) else np.empty(0, np.int64)
            several = np.diff(np.append(start, len(slots))) > 1
            inside = np.bincount(owner[np.repeat(several, np.diff(np.append(start, len(slots))))], minlength=len(waiting))
            lacks = (SHARED * sizes + OF - 1) // OF - inside
            slots, owner = slots[start], np.where(several, SEVERAL, owner[start]).astype("<u2")
            part = (slots * np.uint64(parts) >> np.uint64(SLOT_BITS)).astype(np.int32)
            ends = np.flatnonzero(part[1:] != part[:-1]) + 1
            begin = np.append(0, ends)[: len(slots)]
            steps = np.diff(slots, prepend=slots[:1])
            steps[begin] = 0
            runs = [x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : SLOT_BITS // 8].T.tobytes() for x in np.split(steps, ends)][: len(begin)]
            docs = [x.view(np.uint8).reshape(-1, 2).T.tobytes() for x in np.split(owner, ends)][: len(begin)]
            told = np.array([set_number(s) for s in waiting], "<i8").tobytes()
            columns = {
                "part": pa.array(np.append(part[begin], group % parts), pa.int32()),
                "group": pa.array(np.full(len(begin) + 1, group), pa.int64()),
                "first": pa.array([*slots[begin].tolist(), None], pa.int64()),
                "run": pa.array([*runs, told], pa.binary()),
                "docs": pa.array([*docs, lacks.astype("<i8").tobytes()], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(columns)

        group = TaskContext.get().partitionId() << 32
        waiting, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                waiting.append(shingles(text))
                size += len(waiting[-1])
                if size > GROUP or len(waiting) == SEVERAL:
                    yield cut(waiting, group)
                    waiting, size, group = [], 0, group + 1
        if waiting:
            yield cut(waiting, group)

    return run


def _repeated_slots(batches):
    """(group, fps, docs): of each group the texts, one entry per slot that another group has too; the rows that tell of a group pass."""
    import pyarrow as pa

    names = ("group", "fps", "docs")

    def out(runs: list[tuple]):
        slots, owner = np.concatenate([r[1] for r in runs]), np.concatenate([r[2] for r in runs])
        order = np.argsort(slots, kind="stable")
        same = slots[order][1:] == slots[order][:-1]
        repeated = np.zeros(len(slots), bool)
        repeated[order] = np.append(same, False) | np.append(False, same)
        repeated &= owner != SEVERAL
        ends = np.cumsum([len(r[1]) for r in runs])[:-1]
        told = [(r[0], o[m].astype("<u2").tobytes()) for r, o, m in zip(runs, np.split(owner, ends), np.split(repeated, ends)) if m.any()]
        return pa.RecordBatch.from_arrays([pa.array([g for g, _ in told], pa.int64()), pa.nulls(len(told), pa.binary()), pa.array([d for _, d in told], pa.binary())], names)

    part, runs = None, []
    for batch in batches:
        for number, group, first, packed, docs in zip(*(batch.column(c).to_pylist() for c in ("part", "group", "first", "run", "docs"))):
            if part != number:
                if runs:
                    yield out(runs)
                part, runs = number, []
            if first is None:
                yield pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([packed], pa.binary()), pa.array([docs], pa.binary())], names)
                continue
            planes = np.frombuffer(packed, np.uint8).reshape(SLOT_BITS // 8, -1)
            steps = np.zeros((planes.shape[1], 8), np.uint8)
            steps[:, : SLOT_BITS // 8] = planes.T
            owner = np.ascontiguousarray(np.frombuffer(docs, np.uint8).reshape(2, -1).T).view("<u2")[:, 0]
            runs.append((group, np.cumsum(steps.view("<i8")[:, 0]) + first, owner))
    if runs:
        yield out(runs)


def _sets_with_enough(batches):
    """The numbers of the sets of a group that lack no repeated shingle."""
    import pyarrow as pa

    group, fps, lacks, found = None, None, None, np.zeros(SEVERAL, np.int64)

    def out():
        return pa.RecordBatch.from_pydict({"fp": fps[found[: len(fps)] >= lacks]})

    for batch in batches:
        for number, told, docs in zip(*(batch.column(c).to_pylist() for c in ("group", "fps", "docs"))):
            if group != number:
                if group is not None:
                    yield out()
                group = number
                found[:] = 0
            if told is None:
                counts = np.bincount(np.frombuffer(docs, "<u2"))
                found[: len(counts)] += counts
            else:
                fps, lacks = np.frombuffer(told, "<i8"), np.frombuffer(docs, "<i8")
    if group is not None:
        yield out()


def candidates(docs: DataFrame, total: int) -> DataFrame:
    """(fp) of the sets whose shingles occur once more in the corpus, up to a fifth of them; the others are at the least
    similarity to no other set.  `total` is the number of all shingles, which are counted in parts of bounded size."""
    parts = min(max(total // PART, 64), 1 << 20)
    runs = docs.select(common.whole("text").alias("text")).mapInArrow(_runs_of_texts(parts), "part int, group long, first long, run binary, docs binary")
    told = runs.repartition("part").sortWithinPartitions("part").mapInArrow(_repeated_slots, "group long, fps binary, docs binary")
    return told.repartition("group").sortWithinPartitions("group").mapInArrow(_sets_with_enough, "fp long").distinct()


def sketch_of(found: np.ndarray, bits: int = SKETCH) -> bytes:
    """For each of `bits` classes of shingles, whether the set has an odd number.  Two sets differ in at least as many shingles as
    their sketches in bits."""
    return np.packbits(np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, set, sketch) of the texts that `wanted` (fp, mark) names."""
    texts = docs.select(mark_of("text").alias("mark"), common.whole("text").alias("text")).join(_few(wanted), "mark")
    one = texts.groupBy("fp").agg(F.min("text").alias("text"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"fp": batch.column("fp"), "set": pa.array([s.tobytes() for s in sets], pa.binary()), "sketch": pa.array(map(sketch_of, sets), pa.binary())})

    return one.mapInArrow(run, "fp long, set binary, sketch binary")


def first_rows(sets: DataFrame) -> DataFrame:
    """(key, fp, size, place) of the first shingles that two or more sets have, from rare to common; those of one set alone come before."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for fp, held in zip(batch.column("fp").to_pylist(), batch.column("set").to_pylist()):
                keys = np.frombuffer(held, np.int64) if held else np.empty(0, np.int64)
                for k in range(0, len(keys), 1 << 14):
                    piece = keys[k : k + (1 << 14)]
                    yield pa.RecordBatch.from_pydict({"key": piece, "fp": np.full(len(piece), fp, np.int64)})

    entries = sets.select("fp", "set").mapInArrow(run, "key long, fp long")
    shared = entries.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1")
    ranked = shared.groupBy("fp").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("shared"))
    sized = ranked.join(sets.select("fp", (F.length("set") / 8).cast("int").alias("size")), "fp").withColumn("alone", F.col("size") - F.size("shared"))
    some = sized.withColumn("take", F.expr(f"size - ({SHARED} * size + {OF - 1}) div {OF} + 1 - alone").cast("int")).where("take > 0")
    rows = some.select("fp", "size", "alone", F.posexplode(F.slice("shared", F.lit(1), F.col("take"))).alias("at", "one"))
    return rows.select(F.col("one.key").alias("key"), "fp", "size", (F.col("alone") + F.col("at")).alias("place"))


def mark_of(text: str | Column) -> Column:
    return F.xxhash64(common.whole(text))


def linked_prints(distinct: DataFrame, steps: StepTables) -> DataFrame:
    """Pairs (a, b) of vertices (fp, print, size) that the BK-trees of SimHash link, through the first vertex of each print."""
    prints = steps.save(distinct.groupBy("print").agg(F.min(F.struct("fp", "size")).alias("first")), "simhash-prints")
    linked = simhash.links(simhash.shards(prints.select(F.col("print").alias("fp")), steps=steps)).distinct()
    ends = prints.select("print", "first.fp", "first.size")
    across = linked.join(ends.toDF("a", "fp_a", "size_a"), "a").join(ends.toDF("b", "fp_b", "size_b"), "b").select("fp_a", "size_a", "fp_b", "size_b")
    same = distinct.join(ends.toDF("print", "fp_b", "size_b"), "print").select(F.col("fp").alias("fp_a"), F.col("size").alias("size_a"), "fp_b", "size_b")
    near = across.unionByName(same).where(f"fp_a <> fp_b AND {OF} * least(size_a, size_b) >= {SHARED} * greatest(size_a, size_b)")
    return near.select(F.least("fp_a", "fp_b").alias("a"), F.greatest("fp_a", "fp_b").alias("b"))


def possible(size, place, other_size, other_place):
    """Whether sets that share a shingle at these places of their orders can reach the least similarity: they have in common
    at most what stands before it, itself, and what is left in the shorter rest."""
    most = np.minimum(place, other_place) + 1 + np.minimum(size - place, other_size - other_place) - 1
    return (SHARED + OF) * most >= SHARED * (size + other_size)


def shared_firsts(rows: DataFrame) -> DataFrame:
    """Rows (key, fp, size, place, lead) of the first shingles (key, fp, size, place) that two or more vertices have; lead is the
    key's first vertex where it can reach the least similarity, else NULL."""
    names = ("key", "fp", "size", "place")

    def run(batches):
        import pyarrow as pa

        def out(data: np.ndarray, lead: np.ndarray):
            mask = possible(data[2], data[3], lead[2], lead[3]) & (data[1] != lead[1])
            columns = [pa.array(data[0]), pa.array(data[1]), pa.array(data[2].astype(np.int32)), pa.array(data[3].astype(np.int32))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(lead[1], mask=~mask)], [*names, "lead"])

        first, told = None, True  # the first vertex of the last key, and whether its row has left
        for batch in batches:
            if batch.num_rows == 0:
                continue
            data = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
            if first is not None and first[0] == data[0, 0]:
                data, told_first = np.concatenate([first[:, None], data], axis=1), told
            else:
                told_first = False
            start = np.flatnonzero(np.concatenate(([True], data[0, 1:] != data[0, :-1])))
            sizes = np.diff(np.append(start, data.shape[1]))
            lead = np.repeat(data[:, start], sizes, axis=1)
            many = np.repeat(sizes > 1, sizes)
            if told_first:
                many[0] = False
            if many.any():
                yield out(data[:, many], lead[:, many])
            first, told = data[:, start[-1]].copy(), bool(sizes[-1] > 1)

    return rows.repartition("key").sortWithinPartitions(*names).mapInArrow(run, "key long, fp long, size int, place int, lead long")


def units(rows: DataFrame, limit: int = LONG, weight: str = "1") -> DataFrame:
    """(unit, side, root, fp, size, place): what is compared with each other; in a unit with two sides, across them only.

    A key of at most `limit` rows is a unit.  Of a longer one, each group of more than `limit` rows is dealt into blocks by
    vertex, the others by group; a unit is a block of the others, or two blocks that can hold different groups.  A row counts
    as `weight` rows.
    """
    per = rows.groupBy("key", "root").agg(F.sum(F.expr(weight).cast("long")).alias("n"))
    long_keys = per.groupBy("key").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(F.col("n") <= limit, F.col("n"))), F.lit(0)).alias("others"),
        F.collect_list(F.when(F.col("n") > limit, F.struct("root", F.ceil(F.col("n") / limit).alias("parts")))).alias("large"),  # total / limit at most
    ).where(F.col("total") > limit)
    kept = ("root", "fp", "size", "place")
    short = rows.join(long_keys.select("key"), "key", "left_anti").select(F.col("key").alias("unit"), F.lit(0).alias("side"), *kept)
    part = lambda of, n: F.pmod(F.xxhash64(of), n).cast("long")
    block = lambda root, number: F.struct(root.isNotNull().alias("is_large"), F.coalesce(root, F.lit(0).cast("long")).alias("of"), number.cast("long").alias("number"))
    n_rest = F.ceil(F.col("others") / limit).cast("long")
    rest_blocks = F.transform(F.when(n_rest > 0, F.sequence(F.lit(0).cast("long"), n_rest - 1)).otherwise(F.array().cast("array<long>")), lambda k: block(F.lit(None).cast("long"), k))
    large_blocks = F.flatten(F.transform("large", lambda g: F.transform(F.sequence(F.lit(0).cast("long"), g["parts"] - 1), lambda k: block(g["root"], k))))
    every = long_keys.select("key", "large", n_rest.alias("n_rest"), F.concat(rest_blocks, large_blocks).alias("blocks"))
    found = F.get(F.filter("large", lambda g: g["root"] == F.col("root")), F.lit(0))
    mine = F.when(found.isNull(), block(F.lit(None).cast("long"), part("root", F.greatest("n_rest", F.lit(1))))).otherwise(block(F.col("root"), part("fp", found["parts"])))
    dealt = rows.join(every, "key").withColumn("mine", mine)
    others = F.filter("blocks", lambda o: F.when(o["is_large"] & F.col("mine.is_large"), o["of"] != F.col("mine.of")).otherwise(F.lit(True)))
    pairs = dealt.select("key", "mine", *kept, F.explode(others).alias("other"))
    pairs = pairs.where("NOT (mine = other AND mine.is_large)")
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    return short.unionByName(pairs.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"), side.alias("side"), *kept))


def by_unit(batches, names: tuple, carried: tuple):
    """Each unit of rows sorted by unit: an array with the numbers `names`, the unit first, and a list for each column `carried`."""
    left, more = np.empty((len(names), 0), np.int64), [[] for _ in carried]  # the last unit, which may go on; two blocks at most
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data = np.concatenate([left, np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])], axis=1)
        for column, name in zip(more, carried):
            column += batch.column(name).to_pylist()
        start = np.flatnonzero(np.concatenate(([True], data[0, 1:] != data[0, :-1]))).tolist()
        for begin, end in zip(start, start[1:]):
            yield data[:, begin:end], *(column[begin:end] for column in more)
        left, more = data[:, start[-1] :], [column[start[-1] :] for column in more]
    if left.shape[1]:
        yield left, *more


def sketch_rows(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)


def gaps(sketch: np.ndarray, k: int, others: np.ndarray) -> np.ndarray:
    """The number of bits in which row k differs from others."""
    return np.bitwise_count(sketch[others] ^ sketch[k]).sum(axis=1, dtype=np.int64)


def most_gap(size, other_size):
    """The most shingles in which two sets at the least similarity differ."""
    both = size + other_size
    return both - 2 * ((SHARED * both + SHARED + OF - 1) // (SHARED + OF))


def families(index: DataFrame, found: DataFrame, sets: DataFrame, limit: int = LONG) -> DataFrame:
    """Rows (a, b) that connect every two vertices which share a first shingle, lie in different groups of `found` and can reach the
    least similarity by their sizes, places and sketches.

    Of each unit only a forest leaves the task, from each vertex to the smallest that it is connected with, so a shingle of n vertices
    makes less than n rows however many of their pairs are possible.
    """
    rooted = index.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rows = rooted.select("key", F.coalesce("root", "fp").alias("root"), "fp", "size", "place")
    # Keys of a single group are gone before the rows travel in full.
    mixed = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    names = ("unit", "side", "root", "fp", "size", "place")

    def forest(data: np.ndarray, sketch: np.ndarray) -> np.ndarray | None:
        _, side, root, fp, size, place = data
        family = np.arange(len(fp))
        for k in range(len(fp) - 1):
            near = possible(size[k], place[k], size[k + 1 :], place[k + 1 :]) & (root[k + 1 :] != root[k]) & (family[k + 1 :] != family[k])
            if side[k]:
                near &= side[k + 1 :] != side[k]
            near = np.flatnonzero(near) + k + 1
            if len(near):
                near = near[gaps(sketch, k, near) <= most_gap(size[k], size[near])]
                if len(near):
                    family[np.isin(family, family[near])] = family[k]
        order = np.lexsort((fp, family))
        start = np.flatnonzero(np.append(True, family[order][1:] != family[order][:-1]))
        if len(start) == len(fp):
            return None
        least = np.repeat(fp[order][start], np.diff(np.append(start, len(fp))))
        pairs = np.stack([least, fp[order]])
        return pairs[:, pairs[0] != pairs[1]]

    def run(batches):
        import pyarrow as pa

        def out(held: list[np.ndarray]):
            return pa.RecordBatch.from_arrays(list(map(pa.array, np.unique(np.concatenate(held, axis=1), axis=1))), ["a", "b"])

        held, count = [], 0
        for data, sketches in by_unit(batches, names, ("sketch",)):
            pairs = forest(data, sketch_rows(sketches))
            if pairs is not None:
                held.append(pairs)
                count += pairs.shape[1]
            if count > 1 << 16:
                yield out(held)
                held, count = [], 0
        if held:
            yield out(held)

    dealt = units(rows.join(mixed, "key", "left_semi"), limit).join(sets.select("fp", "sketch"), "fp").select(*names, "sketch")
    return dealt.repartition("unit").sortWithinPartitions(*names).mapInArrow(run, "a long, b long").distinct()


def links_within(family: DataFrame, found: DataFrame, sets: DataFrame, limit: int = LONG) -> DataFrame:
    """Pairs (a, b) of vertices (node) of one family (root) at the least similarity that join all groups of `found` which any pair joins.

    The sets travel to their family, once for each block that theirs is held against.  There each two that the sketches leave are checked
    on both sets, the nearest first, unless they have been joined; so a unit of n vertices makes less than n rows.
    """
    members = family.select(F.col("node").alias("fp"), F.col("root").alias("key")).join(found.select(F.col("node").alias("fp"), "root"), "fp", "left")
    sized = members.join(sets.select("fp", (F.length("set") / 8).cast("int").alias("size")), "fp")
    rows = sized.select("key", F.coalesce("root", "fp").alias("root"), "fp", "size", F.lit(0).alias("place"))
    names = ("unit", "side", "root", "fp", "size")

    def run(batches):
        import pyarrow as pa

        for data, sketches, held in by_unit(batches, names, ("sketch", "set")):
            _, side, root, fp, size = data
            root, sketch, made = root.copy(), sketch_rows(sketches), []
            whole = [np.frombuffer(v, np.uint64) for v in held]
            wide = np.flatnonzero(size >= WIDE)  # their sketches fill up, so they have longer ones here
            at = np.full(len(fp), -1)
            at[wide] = np.arange(len(wide))
            longer = sketch_rows([sketch_of(whole[k], 16 * SKETCH) for k in wide]) if len(wide) > 1 else None
            for k in range(len(fp) - 1):
                near = root[k + 1 :] != root[k]
                if side[k]:
                    near &= side[k + 1 :] != side[k]
                near = np.flatnonzero(near) + k + 1
                near = near[OF * np.minimum(size[near], size[k]) >= SHARED * np.maximum(size[near], size[k])]
                gap = gaps(sketch, k, near)
                if longer is not None and at[k] >= 0:
                    gap[at[near] >= 0] = gaps(longer, at[k], at[near][at[near] >= 0])
                close = gap <= most_gap(size[k], size[near])
                for other in near[close][np.argsort(gap[close], kind="stable")].tolist():
                    if root[other] != root[k] and are_similar(whole[k], whole[other]):
                        made.append((int(fp[k]), int(fp[other])))
                        root[root == root[other]] = root[k]
            if made:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, np.array(made, np.int64).T)), ["a", "b"])

    dealt = units(rows, limit, f"ceil(size / {WEIGHT})").join(sets, "fp").select(*names, "sketch", "set")
    return dealt.repartition("unit").sortWithinPartitions(*names).mapInArrow(run, "a long, b long")


def _few(rows: DataFrame) -> DataFrame:
    """A written table of hashes, marked for broadcast if it is small."""
    return F.broadcast(rows) if rows.count() <= MAX_BROADCAST else rows


def are_similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets are at the least similarity."""
    common_ones = len(np.intersect1d(x, y, assume_unique=True))
    return OF * common_ones >= SHARED * (len(x) + len(y) - common_ones)


def similar(pairs: DataFrame, sets: DataFrame, steps: StepTables) -> DataFrame:
    """Those of the pairs (a, b) whose sets, of `sets` (fp, set), are at the least similarity."""
    both = pairs.select("a", "b").join(sets.select(F.col("fp").alias("a"), F.col("set").alias("one")), "a")
    both = both.join(sets.select(F.col("fp").alias("b"), F.col("set").alias("other")), "b")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            near = []
            for one, other in zip(batch.column("one"), batch.column("other")):
                near.append(are_similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (one, other))))
            mask = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)})

    return steps.save(both.mapInArrow(run, "a long, b long"), "close")


def groups(docs: DataFrame, limit: int = LONG) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark) of every document row, and (mark, root, component_id) of every distinct text."""
    spark = docs.sparkSession
    common.small_batches(spark)
    steps = StepTables(spark, "near-duplicates")
    names = steps.save(vertices(docs), "names")
    by_print = steps.save(linked_prints(names.select("fp", "print", "size").distinct(), steps), "simhash-links")
    total = names.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    wanted = steps.save(names.join(candidates(docs, total), "fp", "left_semi").groupBy("fp").agg(F.min("mark").alias("mark")), "ends")
    sets = steps.save(sets_of(docs, wanted), "sets")
    index = steps.save(shared_firsts(first_rows(sets)), "index")
    often = index.where("lead IS NOT NULL").groupBy("fp", "lead").agg(F.count("*").alias("n"))
    leads = often.groupBy(F.col("fp").alias("a")).agg(F.max(F.struct("n", "lead"))["lead"].alias("b"))
    ordered = leads.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    close = similar(by_print.unionByName(ordered).distinct(), sets, steps)
    found = components(close, steps)
    # What can be near is brought together first, each vertex once, and checked there: no pair of them is a row but those that join groups.
    family = components(steps.save(families(index, found, sets, limit), "families"), steps)
    steps.drop(index, by_print, wanted)
    found = components(close.unionByName(steps.save(links_within(family, found, sets, limit), "links")), steps)
    steps.drop(sets)
    least = names.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    texts = names.select("mark", "fp").distinct()
    return names.select("doc_id", "mark"), texts.join(rooted.join(named, "root"), "fp").select("mark", "root", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, that with the smallest number, with all its columns.

    Where no member has a number, one member stays; of rows with the same number and text one stays, the smallest.
    """
    steps = StepTables(docs.sparkSession, "near-duplicates")
    names, named = groups(docs)
    key = lambda number: (number.isNull().alias("none"), F.coalesce(number.cast("long"), F.lit(0)).alias("id"))
    rows = names.select("mark", *key(F.col("doc_id"))).groupBy("mark", "none", "id").agg((F.count("*") > 1).alias("repeated"))
    first = rows.join(named, "mark").groupBy("root").agg(F.min(F.struct("none", "id", "mark", "repeated")).alias("m"))
    stays = steps.save(first.select("m.*"), "stays")
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), mark_of("text").alias("mark"), *key(F.col("doc_id")))
    found = nested.join(_few(stays), ["mark", "none", "id"])
    once = found.where("NOT repeated").select("kept")
    many = found.where("repeated").groupBy("mark", "none", "id").agg(F.min("kept").alias("kept")).select("kept")
    return once.unionByName(many).select(*[F.col("kept")[c].alias(c) for c in docs.columns])
