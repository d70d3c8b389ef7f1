"""Array files by byte ranges: the same rows and positions for any ranges."""

import json
import random

import pytest

from pressloom.sources import json_files, json_ranges


def records(count, seed=1):
    rng = random.Random(seed)
    odd = ['}', '{', '"', '\\', '\\"', '[]', '}}{{"', "שלום", "😀", "a\nb", "\\\\", ",", "]", "é" * 30, "x" * 2000]
    value = lambda: "".join(rng.choice(odd + ["abc "] * 9) for _ in range(rng.randrange(12)))
    made = []
    for k in range(count):
        record = {"title": value(), "url": None if k % 7 == 0 else value(), "ref": str(k)}
        if k % 5 == 0:
            record["more"] = {"a": [value(), {"b": value()}], "c": {}}
        made.append(record)
    return made


@pytest.fixture
def ranged(spark):
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}

    def read(folder, size, **more):
        for key, value in keys.items():
            spark.conf.set(key, value or str(size))
        try:
            return sorted((r["_file"], r["_pos"], r["title"], r["url"], r["extra"]["ref"], (r["extra"] or {}).get("more")) for r in json_ranges.read_arrays(spark, folder, **more).collect())
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)

    return read


@pytest.mark.parametrize("indent", [None, 1])
def test_same_rows_at_any_ranges(spark, ranged, tmp_path, indent, monkeypatch):
    all_records = {f"n12_rss_2025-08-1{k}.json": records(150, k) for k in range(3)}
    for name, rows in all_records.items():
        text = json.dumps(rows, ensure_ascii=name.endswith("0.json"), indent=indent)
        (tmp_path / name).write_text(("\ufeff" if name.endswith("1.json") else "") + text + "\n", encoding="utf-8")
    size = max(p.stat().st_size for p in tmp_path.iterdir())
    whole = ranged(str(tmp_path), 10 * size)
    want = [(name, k, r["title"], r["url"], r["ref"]) for name, rows in all_records.items() for k, r in enumerate(rows)]
    assert [w[:5] for w in whole] == sorted(want)
    mores = {(name, k): r.get("more") for name, rows in all_records.items() for k, r in enumerate(rows)}
    assert all(mores[w[:2]] == (json.loads(w[5]) if w[5] else None) for w in whole)
    for cuts in (7, 64):
        assert ranged(str(tmp_path), size // cuts) == whole
    monkeypatch.setattr(json_ranges, "MAX_BROADCAST_RANGES", 0)
    assert ranged(str(tmp_path), size // 7) == whole


def test_a_record_over_many_ranges(ranged, tmp_path):
    rows = [{"title": "a", "ref": "0"}, {"title": '}{"\\' * 4000, "ref": "1"}, {"title": "b", "ref": "2"}]
    (tmp_path / "one.json").write_text(json.dumps(rows))
    got = ranged(str(tmp_path), 997)
    assert [(r[1], r[2], r[4]) for r in got] == [(k, r["title"], r["ref"]) for k, r in enumerate(rows)]


def test_files_that_are_not_arrays(ranged, tmp_path):
    good = [{"title": "a", "ref": "0"}]
    for name, text in {
        "empty": "", "blank": " \n", "none": "[]", "object": json.dumps({"records": good}), "open": json.dumps(good)[:-1], "string": '"[{}]"',
        "torn": '[{"title": "x', "mixed": json.dumps([1, "{", None, [good[0]], *good]), "good": json.dumps(good),
    }.items():
        (tmp_path / f"{name}.json").write_text(text)
    assert [(r[0], r[1]) for r in ranged(str(tmp_path), 10)] == [("good.json", 0), ("mixed.json", 0)]


def test_feed_files_read_by_ranges(spark, tmp_path):
    (tmp_path / "c14_adapted_2025-08-11.json").write_text(json.dumps(records(9)))
    (tmp_path / "c14_adapted_late.json").write_text(json.dumps(records(9)))
    rows = json_files.read_feed_files(spark, str(tmp_path), "c14_adapted_*.json", rank=3).collect()
    assert sorted(r["_pos"] for r in rows) == list(range(9)) and {(str(r["dt"]), r["_file_rank"]) for r in rows} == {("2025-08-11", 3)}
