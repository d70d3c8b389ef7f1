"""License scan, quality rules and decontamination against plain versions."""

import hashlib
import math
import random
import re

import pytest

from pressloom.llm import decontaminate, licenses, quality_rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def texts(seed, count=60):
    rng = random.Random(seed)
    pieces = ["MIT License", "mit-license", "Apache", "apache  LICENSE", "General Public", "license", "general\npublic license", "é", "É Ö", "a", "b c", "... ", "of the", "in the",
              "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."]
    made = [" ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 30))) for _ in range(count)]
    whole = licenses.TEMPLATES[1].text.split()
    del whole[9]
    return [None, "", "...", *made, "x " + " ".join(whole) + " y", "mit license " * 2000, made[0]]


def frame(spark, values):
    rows = [(None if k == 4 else k % 50, t, k, "z") for k, t in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, text string, row int, gram string").repartition(3), rows


def test_license_places(spark):
    docs, rows = frame(spark, texts(1))
    got = sorted((repr(r["doc_id"]), r["n_words"], r["n_base"], repr(r["first_word"]), repr(r["last_word"]), r["base_labels"]) for r in licenses.report(docs).collect())
    want = []
    for doc, text, *_ in rows:
        w = plain_words(text)
        places = [(k, t.label) for t in licenses.PHRASES for k in range(len(w)) if w[k : k + len(t.text.split())] == t.text.split()]
        at = [k for k, _ in places]
        want.append((repr(doc), len(w), len(at), repr(min(at, default=None)), repr(max(at, default=None)), ",".join(sorted({label for _, label in places}))))
    assert got == sorted(want)
    for r in licenses.report(docs).collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1


def test_license_templates_on_neighbouring_diagonals(spark):
    whole = licenses.TEMPLATES[1].text.split()
    broken = [*whole[:6], "very", *whole[6:12], *whole[13:]]
    far = [*whole[:6], *(["filler"] * 40), *whole[6:8]]
    docs = spark.createDataFrame([(1, "start " + " ".join(broken)), (2, " ".join(whole[:7])), (3, " ".join(far)), (4, " ".join(whole) + " and " + " ".join(whole))], "doc_id long, text string")
    spans = {r["doc_id"]: (r["labels"], r["n_template_spans"], round(r["score"], 3)) for r in licenses.report(docs).collect()}
    assert spans[1] == ("mit", 1, round(10 / 17, 3))
    assert spans[2] == spans[3] == ("", 0, 0.0) and spans[4] == ("mit", 2, 1.0)
    assert licenses.report(docs.where("false")).collect() == []


def test_no_python_on_the_executors(spark):
    docs = spark.range(9).selectExpr("id AS doc_id", "repeat('a mit license, ', 1 + cast(id AS int)) AS text")
    labels = spark.range(5).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    for made in (licenses.report(docs), quality_rules.report(docs, labels)):
        assert not re.search("Python|Pandas|Arrow|ExistingRDD", made._jdf.queryExecution().executedPlan().toString())


def plain_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for k in range(len(w) - 2):
        at.setdefault(tuple(w[k : k + 3]), []).append(k)
    repeated = {p + j for places in at.values() if len(places) > 1 for p in places for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_rules(spark):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(30)] + ["#", "a|b", "ü<", "\n", "\n\n", "\t", "\x0b", "\x1f", " ", "the same line\nthe same line\n"]
    values = [None, "", " \n ", "one", "a b", "a b c", "a a a a a", *(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(400))) for _ in range(60)), "x y " * 5000, "###$ %%% " * 30]
    docs, rows = frame(spark, values)
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(7, 40)] + [(None, 1, 0), (8, None, None)], "doc_id long, quality int, toxic int")
    got = quality_rules.report(docs, labels).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(repr((r["doc_id"], *(r[c] for c in columns))) for r in got) == sorted(repr((d, *plain_rules(t))) for d, t, *_ in rows)
    passed = [r for r in got if not r["base_failed"]]
    kept = [r["mean_llr"] for r in passed if r["kept"]]
    assert not any(r["kept"] for r in got if r["base_failed"]) and all(r["mean_llr"] < min(kept) for r in passed if not r["kept"])

    # The ratio, from exact counts of the same buckets.
    counts = {r["bucket"]: (r["corpus"], r["trusted"]) for r in quality_rules.bucket_counts(docs, labels).collect()}
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    assert sum(c for c, _ in counts.values()) == sum(max(2 * len(split(t)) - 1, 0) for _, t, *_ in rows)
    good = {k for k in range(7, 40) if k % 3 > 0}
    assert sum(t for _, t in counts.values()) == sum(max(2 * len(split(t)) - 1, 0) for d, t, *_ in rows if d in good)
    model = quality_rules.model(quality_rules.bucket_counts(docs, labels)).collect()[0]["llr"]
    everything, trusted = (sum(c[k] for c in counts.values()) for k in (0, 1))
    share = lambda c, total: (c + 0.5) / (total + 0.5 * quality_rules.BUCKETS)
    for bucket, (c, t) in list(counts.items())[:50]:
        assert model[bucket] == pytest.approx(math.log(share(t, trusted) / share(c, everything)), rel=1e-5)
    assert len(model) == quality_rules.BUCKETS


def test_quality_rules_without_labels_or_rows(spark):
    docs, rows = frame(spark, [None, "a " * 30, " ".join(f"w{k}" for k in range(60))])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted((r["n_words"], r["kept"], r["mean_llr"]) for r in quality_rules.report(docs, none).collect()) == [(0, False, 0.0), (30, False, 0.0), (60, True, 0.0)]
    assert quality_rules.report(docs.where("false"), none).collect() == []


def plain_hits(text, items):
    w, hit, names = plain_words(text), set(), set()
    for item, content in items:
        v = plain_words(content)
        size = min(len(v), 10)
        for k in range(len(v) - size + 1 if size else 0):
            for at in range(len(w) - size + 1):
                if w[at : at + size] == v[k : k + size]:
                    hit |= set(range(at, at + size))
                    names |= {item} if item is not None else set()
    listed = ",".join(sorted(map(str, names)))
    return len(w), len(hit), len(names), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_decontamination(spark, monkeypatch, bound):
    """With the window table broadcast and, beyond the bound, with a shuffled join."""
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", bound)
    rng = random.Random(9)
    word = ["ab", "É", "é", "c", "d1", "Xy"]
    items = [(f"i{k}", " ".join(rng.choice(word) for _ in range(rng.choice([2, 5, 9, 10, 11, 30])))) for k in range(12)]
    items += [("i0", items[0][1].upper()), (None, items[5][1]), ("j", None), ("k", "..."), ("same", items[3][1])]
    values = [None, "", *(" ".join(rng.choice(word) for _ in range(rng.randrange(60))) for _ in range(30))]
    values += [f"{rng.choice(word)}, {rng.choice(items)[1]} - {rng.choice(items)[1]}" for _ in range(30)] + [(items[3][1] + " ") * 300]
    docs, rows = frame(spark, values)
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id string, text string, len int")
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = decontaminate.report(docs, bench).collect()
    assert sorted(repr((r["doc_id"], *(r[c] for c in columns))) for r in got) == sorted(repr((d, *plain_hits(t, items))) for d, t, *_ in rows)
    kept = decontaminate.remove_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(repr(tuple(r)) for r in kept.collect()) == sorted(repr(r) for r in rows if not plain_hits(r[1], items)[4])
    assert decontaminate.report(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.report(docs.where("false"), bench).collect() == []


def test_spans_are_removed(spark):
    docs = spark.createDataFrame([(1, "Keep, ONE two; three four! Keep."), (2, "nothing here"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "one Two three")], "item_id string, text string")
    assert {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, bench).collect()} == {1: "Keep,  ;  four! Keep.", 2: "nothing here", 3: None}
