import hashlib
import os
import random

import pytest

from pressloom.llm import chunked_bpe, tokenizer_files

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_files.place(tokenizer_files.BPE_JSON))


def odd_texts(seed, count):
    rng = random.Random(seed)
    pieces = ["the", " cat", "  ", "\n", "\n\n ", "'ll", "'", "l", " été", "漢字", "🙂", "<|endoftext|>", "<|endof", "text|>", "123", " 4", "...", "\t", " ", "　", "é ", "ß", "!", "'s", "x" * 40]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))) for _ in range(count)]


def test_chunks_are_whole_characters_and_follow_the_content():
    rng = random.Random(2)
    for text in [*odd_texts(1, 50), "é" * 9000, "a" * 9000, "".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(20_000))]:
        data = text.encode()
        ends = chunked_bpe.cut(data)
        assert ends[-1] == len(data) and ends == sorted(set(ends))
        for a, b in zip([0, *ends], ends):
            data[a:b].decode()
            assert b - a <= chunked_bpe.MOST + 3
    passage = "".join(rng.choice("abcdefgh \n") for _ in range(20_000)).encode()
    cuts = [{d[a:b] for a, b in zip([0, *e], e)} for d in (passage, b"other words first " * 9 + passage) for e in [chunked_bpe.cut(d)]]
    assert len(cuts[0] & cuts[1]) > 0.9 * len(cuts[0])


def test_joins_agree_with_the_whole_text(plain):
    """Any place of cutting, also inside words, white space and special tokens."""
    table = tokenizer_files.token_bytes()
    rng = random.Random(7)
    for text in odd_texts(3, 400):
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(rng.randrange(6)))
        parts = [tokenizer_files.encode(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)])]
        got = chunked_bpe.assemble(parts, tokenizer_files.encode, table)
        assert got == plain.encode(text, add_special_tokens=False).ids, repr(text)


def expected(plain, text):
    ids = plain.encode(text or "", add_special_tokens=False).ids
    back = plain.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(back)


def test_report_equals_the_library(spark, plain, monkeypatch):
    rng = random.Random(11)
    passages = ["".join(rng.choice(["alpha ", "beta", " gamma,", "\n", "ü", "delta. "]) for _ in range(600)) for _ in range(4)]
    texts = [None, "", " ", "x" * 30_000, *odd_texts(5, 40)]
    texts += ["".join(rng.choice(passages)[rng.randrange(50) :] for _ in range(3)) + str(i) for i in range(60)]
    texts += [texts[-1]] * 5 + [passages[0]] * 30
    monkeypatch.setattr(chunked_bpe, "HOT", 20)
    ids = [None if i == 3 else i % 100 for i in range(len(texts))]
    docs = spark.createDataFrame([(d, t, "k", b"m") for d, t in zip(ids, texts)], "doc_id long, text string, key string, made binary").repartition(6)
    got = [tuple(r) for r in chunked_bpe.report(docs).collect()]
    assert sorted(map(repr, got)) == sorted(repr((d, *expected(plain, t))) for d, t in zip(ids, texts))


def test_empty_table(spark):
    assert chunked_bpe.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
