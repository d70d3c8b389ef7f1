import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pressloom.llm import catalog, personal_data, quality_classifier, simhash, tokenizer_files

os.environ["TOKENIZERS_PARALLELISM"] = "false"


def plain_words(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in lower).split(" ")


def plain_set(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Good and bad texts with labels, copies, near copies, benchmark passages and personal data."""
    rng = random.Random(8)
    word = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "r", "st", "")]
    good = lambda n: ". ".join(" ".join(rng.choice(word) for _ in range(9)).capitalize() for _ in range(n)) + "."
    bad = lambda: " ".join(f"{rng.choice(word)}###" for _ in range(60))
    items = [good(2) for _ in range(6)]
    rows, labels = [], []
    for k in range(160):
        text = bad() if k % 4 == 1 else good(rng.randrange(6, 20))
        if k % 10 == 4:
            text += " " + rng.choice(items)
        if k % 10 == 6:
            text += " write to ab.c@mail1.example.org or +1 (212) 555-0100"
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
        labels.append((k, int(k % 4 != 1), 0))
    rows += [(300 + k, rows[10 * k][1], "en", "s", None) for k in range(5)] + [(400, rows[0][1] + " end", None, None, 3), rows[0]]
    for k in (0, 2, 8):
        words = (rows[k][1] + " " + good(20)).split()
        rows.append((600 + k, " ".join(words), "en", "s", None))
        for at in (20, 60, 100):
            words[at] = "other" + str(at)
        rows.append((700 + k, " ".join(words), "en", "s", None))
    rows += [(500, None, None, None, None), (501, "", "en", "s", 0)]
    place = tmp_path_factory.mktemp("tables")
    write = lambda data, schema, name: spark.createDataFrame(data, schema).coalesce(2).write.parquet(f"{place}/{name}.parquet")
    write(rows, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    write(labels, "doc_id long, quality int, toxic int", "labels")
    write([(f"i{k}", t) for k, t in enumerate(items)] + [(None, None)], "item_id string, text string", "benchmark")
    return str(place), rows, items


def test_stages_do_what_plain_versions_do(spark, tables):
    sf_dir, rows, items = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    states, docs_schema = [], docs.schema
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        states.append([r.asDict() for r in docs.collect()])
    accepted, single, clean, masked, encoded = states

    weights = quality_classifier.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

    def score(text):
        slots, values = quality_classifier.vector(text)
        return quality_classifier.logistic(float(weights[-1]) + float(weights[slots] @ values))

    want = [r for r in rows if score(r[1]) >= quality_classifier.THRESHOLD]
    assert sorted(map(repr, ([r[c] for c in columns] for r in accepted))) == sorted(map(repr, map(list, want)))
    assert {k for k in range(160) if k % 4 == 1}.isdisjoint(r["doc_id"] for r in accepted)
    assert {k for k in range(160) if k % 4 != 1} <= {r["doc_id"] for r in accepted}

    sets = [(r["doc_id"], plain_set(r["text"])) for r in accepted]
    group = list(range(len(sets)))
    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    firsts = {min(m[0] for m, g in zip(sets, group) if g == one) for one in set(group)}
    assert sorted(r["doc_id"] for r in single) == sorted(firsts)
    # The texts tell this rule from that of four SimHash bits.
    assert sorted(firsts) != sorted(r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(accepted, docs_schema)).collect())

    windows = {tuple(w[k : k + 10]) for w in ([x for x in plain_words(t) if x] for t in items) for k in range(max(len(w) - 9, 1))}
    hit = lambda text: any(tuple(w[k : k + 10]) in windows for w in [[x for x in plain_words(text) if x]] for k in range(len(w)))
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r in single if not hit(r["text"]))
    assert any(hit(r["text"]) for r in single)

    by = {r["doc_id"]: r for r in clean}
    for r in masked:
        base = personal_data.base_spans(by[r["doc_id"]]["text"] or "")
        assert not personal_data.base_spans(r["text"] or "")
        assert r["text"] == by[r["doc_id"]]["text"] or base
        assert r["n_chars"] == (None if by[r["doc_id"]]["n_chars"] is None else len(r["text"]))
    assert any("[EMAIL]" in (r["text"] or "") and "[PHONE]" in r["text"] for r in masked)

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_files.place(tokenizer_files.BPE_JSON))
    texts = {r["doc_id"]: r["text"] or "" for r in masked}
    assert sorted(r["doc_id"] for r in encoded) == sorted(texts)
    for r in encoded:
        ids = plain.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())

    assert sorted(map(repr, (r.asDict() for r in corpus_pipeline.run(spark, sf_dir).collect()))) == sorted(map(repr, encoded))


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and set(catalog.SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, tables, tmp_path, empty):
    """Without labels every document has the score of a half, so none is accepted; without a benchmark all are clean."""
    sf_dir, rows, _ = tables
    for name in ("documents", "labels", "benchmark"):
        source = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        source.where("false" if name == empty else "true").write.parquet(str(tmp_path / f"{name}.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert bool(got) == (empty == "benchmark")
    if got:
        whole = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
        assert whole < {r["doc_id"] for r in got}


def test_columns_with_the_stages_own_names(spark, tables):
    """Every column goes through all stages, whatever it is called."""
    sf_dir, _, _ = tables
    names = ["score", "mark", "kept", "fp", "row", "root", "none", "id", "bytes", "length", "label", "at"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert set(names) <= set(docs.columns)
    assert all(r[n] == f"{n} of {r['doc_id']}" for r in docs.where("doc_id IS NOT NULL").collect() for n in names)
    assert docs.count()
