"""Exact cosine similarity join of sparse unit vectors.

Only pairs above a similarity are wanted, so only the rare end of each vector is indexed: with the terms of a vector in
one fixed order, rare ones first, the terms after position i can add at most the length of that tail to any product.
Once the tail is shorter than the wanted similarity it cannot carry a pair alone, so two vectors that are similar enough
share a term among the leading terms of both.  Their rarest common term is such a term, and a pair is only reported
there, hence once.

The index list of a common term can hold a large share of all rows.  Such a list is cut into blocks and every pair of
blocks is a unit of work of bounded size; inside it the products are summed in arrays and only the pairs above the
similarity leave the task.

Where the lists would carry each vector more than a few times, the rows themselves are cut into blocks.  A block is packed into
one row and written down once; pairs of blocks are read from there and meet without a shuffle, so nothing moves more often than
there are copies of a list to save.  Inside a unit the terms are cut in two.  The products of the rarer ones are summed by
lists.  The common ones can add no more than the product of the lengths that they have in both vectors, so they are only
multiplied where that product reaches the similarity alone, or together with the sum of the rarer ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.session import StepTables

BLOCK_ROWS = 512
_SLACK = 1e-9
_PRODUCTS_AT_ONCE, _VALUES_AT_ONCE = 4_000_000, 30_000
#: Times that the lists may carry a vector, on average; beyond that, pairs of blocks of all rows are compared.
_CARRIED = 4
#: Blocks of all rows are so many times larger than those of a list, unless they have too many entries; rows of a block that are
#: multiplied at once.
_WIDER, _ENTRIES, _ROWS_AT_ONCE = 32, 1_500_000, 32
#: Terms of a pair of blocks that are multiplied as dense columns at most, and the products from which one can be.
_DENSE, _DENSE_FROM = 1024, 4000
#: What a product by lists and one in a dense column cost, in the same unit, and what any pair costs that is multiplied densely.
_LISTED_COST, _DENSE_COST, _PAIR_COST = 17.0, 0.08, 3.0
_PAIRS = "a long, b long, sim double, copies_a long, copies_b long"


def rank_terms(vocabulary: DataFrame, steps: StepTables) -> DataFrame:
    """Adds `tid`, a number that orders the terms from rare to common.

    The numbers come from a range-partitioned sort and are written down once, so a repeated task cannot change them.
    """
    ranked = vocabulary.orderBy("df", "term").withColumn("tid", F.monotonically_increasing_id())
    return steps.save(ranked, "vocabulary")


def index_vectors(vectors: DataFrame, min_sim: float) -> DataFrame:
    """Adds `lead`, how many terms must be indexed, to rows with `v`: array of (tid, w) in rank order, of length one."""
    floor = max(min_sim - _SLACK, 0.0)
    start = F.struct(F.lit(0.0).alias("tail"), F.lit(0).alias("lead"))

    def add(acc, entry):
        tail = acc["tail"] + entry["w"] * entry["w"]
        return F.struct(tail.alias("tail"), (acc["lead"] + (F.sqrt(tail) >= floor).cast("int")).alias("lead"))

    return vectors.withColumn("lead", F.aggregate(F.reverse("v"), start, add, lambda acc: acc["lead"]))


def similar_pairs(
    vectors: DataFrame, doc: str, min_sim: float, steps: StepTables, block_rows: int = BLOCK_ROWS, copies: str | None = None
) -> DataFrame:
    """(a, b, sim, copies_a, copies_b) with a < b and sim > min_sim, for saved vectors as `index_vectors` gives them.

    `copies` names a column of the vectors that pairs carry along; without it both are 1.
    """
    carried = F.col(copies) if copies else F.lit(1)
    vectors = vectors.select(F.col(doc).alias("doc"), carried.cast("long").alias("copies"), F.col("v.tid").alias("tids"), F.col("v.w").alias("ws"), "lead")
    keys = vectors.select(F.explode(F.slice("tids", 1, F.col("lead"))).alias("key"))
    lists = steps.save(keys.groupBy("key").agg(F.count("*").alias("n")), "lists")
    moved = lists.agg(F.sum(F.col("n") * F.ceil(F.col("n") / block_rows))).first()[0] or 0
    rows, entries = vectors.where("lead > 0").agg(F.count("*"), F.sum(F.size("tids"))).first()
    if moved > _CARRIED * rows:
        blocks = max(-(-rows // (_WIDER * block_rows)), -(-entries // _ENTRIES))
        return _pairs_of_blocks(vectors.where("lead > 0"), blocks, min_sim, steps)
    leads = vectors.select("doc", "copies", "tids", "ws", F.explode(F.slice("tids", 1, F.col("lead"))).alias("key"))
    # At most (indexed terms / block_rows) rows; written down so that the planner sees their true size.
    long_lists = lists.where(F.col("n") > block_rows).select("key", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    long_lists = steps.save(long_lists, "long-lists")
    placed = leads.join(long_lists, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("doc", "key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = ["key", "lo", "hi"]
    spread = placed.select("doc", "copies", "tids", "ws", "key", "own", other)
    work = spread.select("doc", "copies", "tids", "ws", "key", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    return work.repartition(*units).sortWithinPartitions(*units).mapInArrow(_pairs_of_units(min_sim), _PAIRS)


def _pairs_of_blocks(vectors: DataFrame, blocks: int, min_sim: float, steps: StepTables) -> DataFrame:
    """The same by pairs of blocks of all rows; a task holds two blocks and the products of some rows with one."""
    min_sim = max(min_sim, 0.0)  # as by lists, where a pair shares a term
    own = vectors.select("doc", "copies", "tids", "ws", F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int").alias("block"))
    packed = steps.save(own.groupBy("block").applyInArrow(_packed, f"block int, {', '.join(f'{n} binary' for n in _PACKED)}"), "blocks")
    # A block is a partition, so a task gets one pair of them; of (a, b) and (b, a) one is a unit, for about half of the others of each.
    sides = [packed.repartitionById(blocks, "block").toDF(*(f"{side}_{n}" for n in packed.columns)) for side in "ab"]
    is_unit = "a_block = b_block OR (pmod(a_block + b_block, 2) = 1) = (a_block < b_block)"
    units = sides[0].hint("shuffle_replicate_nl").join(sides[1], F.expr(is_unit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                a, b = ({n: row.column(f"{side}_{n}")[0] for n in ("block", *_PACKED)} for side in "ab")
                yield from _block_products(_unpacked(a), _unpacked(b), a["block"] == b["block"], min_sim)

    return units.mapInArrow(run, _PAIRS)


#: A block of rows: per row its document, copies and number of entries, the distinct terms, per entry the place of its term among
#: them and its weight, by rows, and the order of the entries by terms.
_PACKED = {"docs": np.int64, "copies": np.int64, "sizes": np.int32, "terms": np.int64, "at": np.int32, "weights": np.float64, "by_term": np.int32}


def _packed(group: pa.Table) -> pa.Table:
    group = group.sort_by("doc")
    tids, ws = group.column("tids").combine_chunks(), group.column("ws").combine_chunks()
    terms, at = np.unique(tids.flatten().to_numpy(), return_inverse=True)
    found = [_column(group, "doc"), _column(group, "copies"), tids.value_lengths().to_numpy(), terms, at, ws.flatten().to_numpy(), np.argsort(at, kind="stable")]
    columns = {n: pa.array([x.astype(kind).tobytes()], pa.binary()) for (n, kind), x in zip(_PACKED.items(), found)}
    return pa.table({"block": pa.array([group.column("block")[0].as_py()], pa.int32()), **columns})


def _unpacked(row: dict[str, pa.Scalar]) -> dict[str, np.ndarray]:
    block = {n: np.frombuffer(row[n].as_buffer(), kind) for n, kind in _PACKED.items()}
    return block | {"row": np.repeat(np.arange(len(block["docs"])), block["sizes"]), "df": np.bincount(block["at"], minlength=len(block["terms"]))}


def _ordered(doc_a: np.ndarray, doc_b: np.ndarray, copies_a: np.ndarray, copies_b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    turn = doc_a > doc_b
    pick = lambda x, y: pa.array(np.where(turn, y, x))
    columns = [pick(doc_a, doc_b), pick(doc_b, doc_a), pa.array(sim), pick(copies_a, copies_b), pick(copies_b, copies_a)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "sim", "copies_a", "copies_b"])


def _common_terms(a: dict[str, np.ndarray], b: dict[str, np.ndarray], load: np.ndarray, in_b: np.ndarray, min_sim: float) -> np.ndarray:
    """The terms of the first block that are multiplied as dense columns: as many of those with the most products as cost least."""
    by_load = np.argsort(-load, kind="stable")[:_DENSE]
    by_load = by_load[load[by_load] >= _DENSE_FROM]
    listed = load.sum() - np.concatenate(([0], np.cumsum(load[by_load])))
    least, best = np.inf, 0
    place = {"a": np.full(len(a["terms"]), _DENSE), "b": np.full(len(b["terms"]), _DENSE)}
    place["a"][by_load] = place["b"][in_b[by_load]] = np.arange(len(by_load))
    # The lengths in a few rows tell the share of the pairs that must be multiplied.
    sample = []
    for side, block in (("a", a), ("b", b)):
        at = block["row"] < 256
        sample.append((block["row"][at], place[side][block["at"][at]], block["weights"][at] ** 2))
    for n in sorted({0, len(by_load), *(min(2**k, len(by_load)) for k in range(4, 11))}):
        p, q = (np.sqrt(np.bincount(row, np.where(at < n, w, 0.0), minlength=1)) for row, at, w in sample)
        share = (np.outer(p, q) > min_sim).mean()
        cost = _LISTED_COST * listed[n] + share * len(a["docs"]) * len(b["docs"]) * (_DENSE_COST * n + _PAIR_COST)
        if cost < least:
            least, best = cost, n
    return by_load[:best]


def _block_products(a: dict[str, np.ndarray], b: dict[str, np.ndarray], same: bool, min_sim: float) -> Iterator[pa.RecordBatch]:
    """Similar pairs between two blocks, or inside one."""
    where = np.minimum(np.searchsorted(b["terms"], a["terms"]), len(b["terms"]) - 1)
    in_b = np.where(b["terms"][where] == a["terms"], where, -1)
    load = np.where(in_b >= 0, a["df"] * b["df"][where], 0)
    common = _common_terms(a, b, load, in_b, min_sim)
    column_a, column_b = np.full(len(a["terms"]), -1), np.full(len(b["terms"]), -1)
    column_a[common] = column_b[in_b[common]] = np.arange(len(common))
    starts = np.concatenate(([0], np.cumsum(a["sizes"])))

    def lengths(block: dict[str, np.ndarray], column: np.ndarray) -> np.ndarray:
        return np.sqrt(np.bincount(block["row"], np.where(column[block["at"]] >= 0, block["weights"] ** 2, 0.0), minlength=len(block["docs"])))

    length_a, length_b = lengths(a, column_a), lengths(b, column_b)
    order_a, order_b = np.argsort(-length_a, kind="stable"), np.argsort(-length_b, kind="stable")
    length_b = length_b[order_b]
    width = len(order_b)
    place_b = np.empty(width, np.int64)
    place_b[order_b] = np.arange(width)
    whole = np.zeros((width, len(common)))
    at = np.flatnonzero(column_b[b["at"]] >= 0)
    whole[place_b[b["row"][at]], column_b[b["at"][at]]] = b["weights"][at]
    # The rarer terms meet by lists: the rows of the second block by term.
    listed, listed_weight = place_b[b["row"][b["by_term"]]], b["weights"][b["by_term"]]
    ends = np.concatenate(([0], np.cumsum(b["df"])))
    for first in range(0, len(order_a), _ROWS_AT_ONCE):
        rows = order_a[first : first + _ROWS_AT_ONCE]
        sizes = a["sizes"][rows]
        r = np.repeat(np.arange(len(rows)), sizes)
        entry = np.repeat(starts[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(r))
        t, w = a["at"][entry], a["weights"][entry]
        part, inside = np.zeros((len(rows), len(common))), column_a[t] >= 0
        part[r[inside], column_a[t[inside]]] = w[inside]
        met = ~inside & (in_b[t] >= 0)
        r, t, w = r[met], in_b[t[met]], w[met]
        sizes = ends[t + 1] - ends[t]
        done = np.concatenate(([0], np.cumsum(sizes)))
        sums, cut = np.zeros(len(rows) * width), 0
        while cut < len(t):
            upto = max(cut + 1, int(np.searchsorted(done, done[cut] + _PRODUCTS_AT_ONCE, side="right")) - 1)
            n = sizes[cut:upto]
            where = np.repeat(ends[t[cut:upto]] - (done[cut:upto] - done[cut]), n) + np.arange(n.sum())
            place = np.repeat(r[cut:upto] * width, n) + listed[where]
            found = np.bincount(place, np.repeat(w[cut:upto], n) * listed_weight[where], minlength=len(sums))
            sums, cut = sums + found if cut else found, upto
        sums = sums.reshape(len(rows), width)
        # Rows and columns are in the order of their lengths in common terms, so what can be similar by these alone is a first part.
        most = length_a[rows[0]] * length_b
        alone = int(np.searchsorted(-most, -(min_sim - _SLACK), side="left"))
        sums[:, :alone] += part @ whole[:alone].T
        i, j = np.divmod(np.flatnonzero(sums[:, :alone] > min_sim), max(alone, 1))
        sim = sums[i, j]
        k, l = np.divmod(np.flatnonzero(sums[:, alone:] > min_sim - _SLACK - most[alone:]), max(width - alone, 1))
        l += alone
        near = sums[k, l] + length_a[rows[k]] * length_b[l] > min_sim - _SLACK
        k, l = k[near], l[near]
        some = max(_VALUES_AT_ONCE // max(len(common), 1), 1)
        exact = [np.einsum("ij,ij->i", part[k[cut : cut + some]], whole[l[cut : cut + some]]) for cut in range(0, len(k), some)]
        exact = sums[k, l] + np.concatenate([np.empty(0), *exact])
        wanted = exact > min_sim
        i, j, sim = np.append(i, k[wanted]), np.append(j, l[wanted]), np.append(sim, exact[wanted])
        i, j = rows[i], order_b[j]
        if same:
            after = j > i
            i, j, sim = i[after], j[after], sim[after]
        if len(i):
            yield _ordered(a["docs"][i], b["docs"][j], a["copies"][i], b["copies"][j], sim)


def _pairs_of_units(min_sim: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            starts = _unit_starts(held)
            # The last unit may go on in the next batch.
            yield from _compare(held.slice(0, starts[-1]), starts[:-1], min_sim)
            held = held.slice(starts[-1])
        if held is not None:
            yield from _compare(held, _unit_starts(held), min_sim)

    return run


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _unit_starts(table: pa.Table, names: tuple[str, ...] = ("key", "lo", "hi")) -> np.ndarray:
    if table.num_rows == 0:
        return np.zeros(1, dtype=np.int64)
    change = np.zeros(table.num_rows - 1, dtype=bool)
    for name in names:
        values = _column(table, name)
        change |= values[1:] != values[:-1]
    return np.concatenate(([0], np.flatnonzero(change) + 1))


def _compare(table: pa.Table, starts: np.ndarray, min_sim: float) -> Iterator[pa.RecordBatch]:
    """Similar pairs of the complete units of `table`, a bounded number of row pairs at a time."""
    if table.num_rows < 2:
        return
    ends = np.append(starts[1:], table.num_rows)
    load = np.cumsum((ends - starts) ** 2)
    first = 0
    while first < len(starts):
        before = load[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(load, before + _PRODUCTS_AT_ONCE, side="right")))
        part = table.slice(starts[first], ends[last - 1] - starts[first])
        i, j, sim = _similar(part, starts[first:last] - starts[first], min_sim)
        if len(i):
            doc, copies = _column(part, "doc"), _column(part, "copies")
            yield _ordered(doc[i], doc[j], copies[i], copies[j], sim)
        first = last


def _similar(table: pa.Table, starts: np.ndarray, min_sim: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Similar pairs as rows of the table."""
    rows = table.num_rows
    unit = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows)))
    key, own = _column(table, "key"), _column(table, "own")
    split = _column(table, "lo") != _column(table, "hi")
    tids, ws = table.column("tids").combine_chunks(), table.column("ws").combine_chunks()
    row = np.repeat(np.arange(rows), tids.value_lengths().to_numpy())
    term, weight = tids.flatten().to_numpy(), ws.flatten().to_numpy()

    # Entries that share a unit and a term stand together; each meets the later ones of its run.
    order = np.lexsort((row, term, unit[row]))
    row, term, weight = row[order], term[order], weight[order]
    new_run = np.append(True, (term[1:] != term[:-1]) | (unit[row[1:]] != unit[row[:-1]]))
    run_end = np.append(np.flatnonzero(new_run)[1:], len(row))[np.cumsum(new_run) - 1]
    partners = run_end - np.arange(len(row)) - 1
    left = np.repeat(np.arange(len(row)), partners)
    right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners)
    if not len(left):
        return row[:0], row[:0], weight[:0]
    crossing = ~split[row[left]] | (own[row[left]] != own[row[right]])
    left, right = left[crossing], right[crossing]
    if not len(left):
        return row[:0], row[:0], weight[:0]

    # Sum the products of each row pair; the first one belongs to the pair's rarest common term.
    pair = row[left].astype(np.int64) * rows + row[right]
    by_pair = np.argsort(pair, kind="stable")
    pair = pair[by_pair]
    heads = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    sim = np.add.reduceat((weight[left] * weight[right])[by_pair], heads)
    i, j = pair[heads] // rows, pair[heads] % rows
    wanted = (term[left][by_pair][heads] == key[i]) & (sim > min_sim)
    return i[wanted], j[wanted], sim[wanted]
