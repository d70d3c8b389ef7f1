import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from pressloom.llm import packing, tokenizer_files

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SCHEMA = "doc_id long, text string, length string, piece int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_files.place(packing.VOCABULARY))


def texts():
    rng = random.Random(2)
    words = ["the", "Ünal", "été", "1250", "don't", "אָב", "x" * 300, "<|endoftext|>", "a<|startoftext|>b", " ", "İΣ", "日本語", "\x1c", "…!?", "́", "ﬁ", "a\x0bb"]
    mixed = lambda n: "".join(rng.choice(words) + rng.choice([" ", "\n", "\t ", "  ", " ", "\x0c", "́ "]) for _ in range(n))
    return [mixed(rng.choice([1, 5, 60, 700])) for _ in range(60)] + ["word " * 9000, "w" * 20_000, "", None, " \n", "́ ́"]


@pytest.mark.parametrize("kept", [packing.KEPT, 3])
def test_ids_equal_the_library(tokenizer, kept, monkeypatch):
    """Whether runs are kept or fall out of the tables again and again."""
    encoder = packing.Encoder(packing.VOCABULARY)
    encoder.runs = packing.Recent(kept)
    some = texts()
    for k in range(0, len(some), 7):
        batch = some[k : k + 7]
        got = encoder.encode([None if t is None else t.encode() for t in batch])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in batch]


def test_runs_put_together_equal_the_library(tokenizer):
    """Letters with symbols around them, each in a text of its own, and against neighbours that a cut might miss."""
    rng = random.Random(7)
    letters = ["resh", "It", "ñaÑó", "straße", "ÀÉ", "İx", "aº", "x́y", "Ĳ", "ΑΣ", "ab1", "ﬁn", "שלום", "ÿ", "ŉa", "s", "t", "re"]
    around = ["", ".", ",", "...", "$$$", "(", ")", "'", "'s", "’", "<|endoftext|>", "-", "_", "#", "́", "1", "²", "—", "<", "|>"]
    made = ["".join(rng.choice(around) + rng.choice(letters) + rng.choice(around) for _ in range(rng.choice([1, 1, 2]))) for _ in range(4000)]
    made += ["It. The, RESH.\nÑA, a.b, x.. y.,", "J\u030c It.", "<|STARTOFTEXT|> It. a,", "It.\x0b The, a.\t", ". , .a ,b"]
    got = packing.Encoder(packing.VOCABULARY).encode([t.encode() for t in made])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in tokenizer.encode_batch(made, add_special_tokens=False)]


def best_fit(lengths, capacity, limit):
    """Plain online best fit: how many sequences, and the place of each piece."""
    free, out, count = {}, [], 0
    for n in lengths:
        fits = [(f, -k) for k, f in free.items() if f >= n]
        if fits:
            k = -min(fits)[1]
        else:
            if len(free) == limit and n < capacity:
                free.pop(-min((f, -k) for k, f in free.items())[1])
            k, count = count, count + 1
            free[k] = capacity
        out.append((k, capacity - free[k]))
        free[k] -= n
        if not free[k]:
            del free[k]
    return out


@pytest.mark.parametrize("limit", [1, 3, 20])
def test_bins_are_best_fit(limit):
    rng = random.Random(limit)
    lengths = [min(100, int(rng.paretovariate(0.7))) for _ in range(3000)]
    bins = packing.Bins(100, limit)
    got = [bins.place(n) for n in lengths]
    want = best_fit(lengths, 100, limit)
    assert [o for _, o in got] == [o for _, o in want] and bins.opened == max(k for k, _ in want) + 1


def check_places(rows, capacity):
    """Every sequence is gapless from 0 and within the capacity; their number."""
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def test_report(spark, tokenizer):
    some = texts()
    rows = [(k, t, "x", 9) for k, t in enumerate(some)] + [(0, some[0], None, None), (None, "lost", None, None)]
    got = packing.report(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = got.collect()
    want = []
    for number, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            cut = ids[at : at + 4096]
            want.append((number, piece, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert check_places(got, 4096) <= -(-sum(w[3] for w in want) // 4096) + 1
    assert packing.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_many_tasks_pack_as_well_as_one(spark):
    rng = random.Random(9)
    rows = [(k, min(4096, int(30 * rng.paretovariate(0.8)))) for k in range(20_000)]
    got = packing.pack(spark.createDataFrame(rows, "k long, length long").repartition(60), limit=32, fan_in=4).collect()
    assert sorted((r["k"], r["length"]) for r in got) == rows
    assert check_places(got, 4096) <= sum(n for _, n in rows) / 4096 * 1.007 + 1


def test_sequences(spark, tokenizer):
    rows = [(k, f"text number {k} " * (k + 1), None, None) for k in range(40)]
    out = packing.sequences(spark.createDataFrame(rows, SCHEMA), 500, 8).collect()
    found = sorted(x for r in out for x in np.split(np.frombuffer(r["ids"], "<u4"), 1 + np.flatnonzero(np.frombuffer(r["ids"], "<u4") == 1)) if len(x) for x in [x.tolist()])
    assert found == sorted(tokenizer.encode(r[1], add_special_tokens=False).ids + [1] for r in rows)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 2000 for r in out)
