"""The pipeline's near-duplicate stage against all pairs of exact similarities."""

import random
from collections import Counter

import corpus_pipeline
from pressloom.llm import near_duplicates, simhash


def plain_set(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def plain_firsts(rows):
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return sorted(min(rows[i][0] for i, g in enumerate(group) if g == one) for one in set(group))


def edited(rng, words, count):
    words = list(words)
    for k in rng.sample(range(len(words)), count):
        words[k] = f"new{rng.randrange(10**6)}"
    return words


def texts(seed=3):
    """Chains of edited texts on both sides of 0.8, a group of many near copies, a shared passage, copies and short texts."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    made = []
    for _ in range(40):
        words = fresh(rng.randrange(60, 260))
        made.append(words)
        for _ in range(rng.randrange(4)):
            words = edited(rng, words, rng.randrange(1, max(2, len(words) // 28)))
            made.append(words)
    base, passage = fresh(120), fresh(40)
    made += [edited(rng, base, rng.randrange(3)) for _ in range(40)] + [passage + fresh(rng.randrange(1, 30)) for _ in range(30)]
    made += [["a"], ["a"], ["A", "b"], ["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e", "f"], base, base]
    rows = list(enumerate([" ".join(w) for w in made] + [None, "", " \n"]))
    rng.shuffle(rows)
    return rows


def test_groups_equal_comparison_with_all(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.STAGES[1][1](spark, docs, "").collect())
    assert kept == plain_firsts(rows)
    # Within the radius of op3 alone the edited texts stay.
    assert set(kept) < {r["doc_id"] for r in simhash.one_of_each(docs).collect()} | set(kept)


def test_long_shingles_are_cut_into_blocks(spark):
    """A shingle that many share, in one group of near copies and in many unlike texts, at any block size."""
    rng = random.Random(6)
    fresh = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    base, passage = fresh(60), fresh(30)
    made = [edited(rng, base, rng.randrange(2)) for _ in range(50)] + [passage + fresh(3 + k % 12) for k in range(40)]
    made += [passage + ["end"] * k for k in range(20)] + [base[:52], base[:45], base[4:]]
    rows = list(enumerate(" ".join(w) for w in made))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain_firsts(rows)
    for limit in (2, 7, 4096):
        _, named = near_duplicates.groups(docs, limit)
        assert sorted({r["component_id"] for r in named.collect()}) == want


def test_units_hold_every_pair_of_groups_once(spark):
    rng = random.Random(1)
    rows = [(1, 5, k, 9, 0) for k in range(23)] + [(1, 100 + k // 2, 100 + k, 9, 0) for k in range(21)] + [(1, 6, 300 + k, 9, 0) for k in range(9)] + [(2, k, k, 9, 0) for k in range(4)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "key long, root long, fp long, size int, place int")
    by = {}
    for r in near_duplicates.units(table, 4).collect():
        by.setdefault(r["unit"], []).append(r)
    assert max(map(len, by.values())) < 30
    seen = [
        (min(x["fp"], y["fp"]), max(x["fp"], y["fp"]))
        for unit in by.values()
        for k, x in enumerate(unit)
        for y in unit[:k]
        if x["root"] != y["root"] and (not x["side"] or x["side"] != y["side"])
    ]
    want = {(min(x[2], y[2]), max(x[2], y[2])) for x in rows for y in rows if x[0] == y[0] and x[1] != y[1]}
    assert len(seen) == len(set(seen)) and set(seen) == want


def test_very_long_text_and_repeated_rows(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(300)}" for _ in range(150_000)]
    rows = [(1, " ".join(words), "a"), (2, " ".join(edited(rng, words, 300)), "b"), (2, "x", "z"), (2, "x", "y"), (2, "x", "y"), (5, "X", None)]
    kept = near_duplicates.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, mark string").repartition(3))
    assert sorted((r["doc_id"], r["mark"]) for r in kept.collect()) == [(1, "a"), (2, "y")]


def test_edges(spark):
    rows = [(3, "a b c d e f", "p"), (1, "A b c d e f", "q"), (1, "A b c d e f", "q"), (9, "z y x w v u t", "r"), (None, None, None), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["kept"] or "") for r in kept.collect()) == [(-1, ""), (1, "q"), (9, "r")]
    assert near_duplicates.one_of_each(docs.where("false")).collect() == []


def test_first_shingles_hold_a_common_one():
    for n in range(1, 200):
        for m in range(n, 200):
            shared = -(-4 * (n + m) // 9)  # least number in common at 0.8
            if shared <= n:
                assert near_duplicates.first_length(n) >= n - shared + 1 and near_duplicates.first_length(m) >= m - shared + 1


def test_frequent_slots_are_exact_counts(spark, monkeypatch):
    """Whatever number of texts is sorted together, and with a bound on what is told."""
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice(["a", "b", "c", "d"]) for _ in range(rng.randrange(40)))) for k in range(200)] + [(900, None), (901, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = Counter(int(x) >> 32 for _, t in rows for x in near_duplicates.shingles(t))
    want = {k: n for k, n in want.items() if n > 1}
    for look in (1, 500, 1 << 21):
        monkeypatch.setattr(near_duplicates, "LOOK", look)
        slots, counts = near_duplicates.frequent_slots(docs)
        assert dict(zip(slots.tolist(), counts.tolist())) == want and sorted(slots) == list(slots)
    slots, counts = near_duplicates.frequent_slots(docs, 7)
    assert sorted(counts) == sorted(want.values())[-7:]
    assert len(near_duplicates.frequent_slots(docs.where("false"))[0]) == 0


def test_simhash_links_are_part_of_the_search(spark, monkeypatch):
    """The stage searches its sets' fingerprints by the BK-trees, and finds what a comparison of all fingerprints does."""
    from pressloom.session import StepTables

    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(900)]
    made = [" ".join(edited(rng, base, k % 3)) for k in range(12)] + [" ".join(f"v{rng.randrange(5000)}" for _ in range(50)) for _ in range(30)] + [""]
    sets = [near_duplicates.shingles(t) for t in made]
    prints = [near_duplicates.print_of(s) for s in sets]
    rows = [(k, p, len(s)) for k, (p, s) in enumerate(zip(prints, sets))] + [(99, prints[0], len(sets[0]))]
    steps = StepTables(spark, "prints")
    got = {(r["a"], r["b"]) for r in near_duplicates.linked_prints(spark.createDataFrame(rows, "fp long, print long, size int"), steps).collect()}
    near = lambda x, y: ((x ^ y) & 0xFFFFFFFFFFFFFFFF).bit_count()
    assert (0, 99) in got
    linked = {x for x, p in enumerate(prints) for y, q in enumerate(prints) if x != y and near(p, q) <= simhash.RADIUS and 5 * min(len(sets[x]), len(sets[y])) >= 4 * max(len(sets[x]), len(sets[y]))}
    assert {x for pair in got for x in pair} - {99} == linked | {0}
    called, search = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda *a, **k: called.append(1) or search(*a, **k))
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.single(spark, docs, "").collect())
    assert called and kept == plain_firsts(list(enumerate(made)))
    steps.close()


def test_near_copies_below_the_similarity_are_not_checked_pair_by_pair(spark, monkeypatch):
    """Texts that share most of one text, at about 0.66 of each other: before, each two of them were held against each other."""
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    base = fresh(150)
    made = [edited(rng, base, 3) for _ in range(90)] + [fresh(60) for _ in range(20)]
    rows = list(enumerate(" ".join(w) for w in made))
    checked, similar = [], near_duplicates.similar
    monkeypatch.setattr(near_duplicates, "similar", lambda pairs, *rest: checked.append(pairs.count()) or similar(pairs, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _, named = near_duplicates.groups(docs)
    assert sorted({r["component_id"] for r in named.collect()}) == plain_firsts(rows)
    assert sum(checked) < 4 * len(rows)


def test_candidates_are_the_sets_whose_shingles_repeat(spark, monkeypatch):
    """Whatever texts are counted together; copies, texts without words and slots in several parts included."""
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choice("abc") for _ in range(rng.randrange(14)))) for k in range(60)]
    rows += [(100 + k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))) for k in range(30)] + [(200, None), (201, rows[-1][1])]
    sets = {k: near_duplicates.shingles(t) for k, t in rows}
    held = Counter(int(x) for s in sets.values() for x in s)
    want = {near_duplicates.set_number(s) for s in sets.values() if 5 * sum(held[int(x)] > 1 for x in s) >= 4 * len(s)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for group in (1, 200, 1 << 19):
        monkeypatch.setattr(near_duplicates, "GROUP", group)
        assert {r["fp"] for r in near_duplicates.candidates(docs, 1000).collect()} == want
    assert near_duplicates.candidates(docs.where("false"), 0).collect() == []


def test_rows_of_pairs_are_fewer_than_the_first_shingles(spark, monkeypatch):
    """Texts at about 0.75 of each other, too long for their sketches to tell, and a group about 0.8: before, each two of them made a
    row for each first shingle that they share."""
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(50000)}" for _ in range(n)]
    long, base = fresh(3000), fresh(300)
    made = [edited(rng, long, 43) for _ in range(30)] + [edited(rng, base, 3 + k % 2) for k in range(60)]
    rows = list(enumerate(" ".join(w) for w in made))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counted, kind = spark.sparkContext.accumulator(0), type(docs)

    def counting(frame, run, schema, *rest, each=kind.mapInArrow, **more):
        def count(batches):
            for batch in run(batches):
                counted.add(batch.num_rows)
                yield batch

        return each(frame, count if schema.startswith("a long, b long") else run, schema, *rest, **more)

    monkeypatch.setattr(kind, "mapInArrow", counting)
    _, named = near_duplicates.groups(docs)
    assert sorted({r["component_id"] for r in named.collect()}) == plain_firsts(rows)
    firsts = sum(near_duplicates.first_length(len(plain_set(t))) for _, t in rows)
    assert 0 < counted.value < firsts


def test_checks_in_a_family_join_what_any_pair_joins(spark):
    """Sets with short and long sketches, in groups already, in one unit and in blocks."""
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(50000)}" for _ in range(n)]
    made = []
    for n, count in ((60, 12), (300, 12), (2300, 8)):
        words = fresh(n)
        for _ in range(count):
            words = edited(rng, words, rng.randrange(1, n // 30 + 2))
            made.append(words)
    texts = [" ".join(w) for w in made]
    found = [near_duplicates.shingles(t) for t in texts]
    sets = spark.createDataFrame([(k, s.tobytes(), near_duplicates.sketch_of(s)) for k, s in enumerate(found)], "fp long, set binary, sketch binary")
    family = spark.createDataFrame([(k, 0) for k in range(len(found))], "node long, root long")
    before = spark.createDataFrame([(0, 0), (5, 0)], "node long, root long")
    plain = lambda x, y: 5 * len(set(x) & set(y)) >= 4 * len(set(x) | set(y))
    every = [(i, j) for i in range(len(found)) for j in range(i) if plain(found[i].tolist(), found[j].tolist())]

    def joined(pairs):
        group = list(range(len(found)))
        for a, b in [(0, 5), *pairs]:
            group = [group[b] if g == group[a] else g for g in group]
        return {frozenset(k for k, g in enumerate(group) if g == one) for one in set(group)}

    for limit in (4, 60, 4096):
        links = [(r["a"], r["b"]) for r in near_duplicates.links_within(family, before, sets, limit).collect()]
        assert joined(links) == joined(every) and all((max(p), min(p)) in set(every) for p in links)
    assert len(links) < len(found)
