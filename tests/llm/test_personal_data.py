import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from pressloom.llm import personal_data as pd_


def plain_base(text):
    """The contract's patterns as they are written."""
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        total = sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            spans.append(("phone", *m.span()))
    order = ("email", "ip", "card", "phone")
    return sorted(spans, key=lambda s: (order.index(s[0]), s[1]))


def odd_texts(seed, count):
    rng = random.Random(seed)
    pieces = ["a.b", "@", "x@y.z", ".", "1.2.3.4", "256.1.1.1", "+1 ", "(23) ", "4-5", " ", "4111111111111111", "4111 1111 1111 1111", "é", "9", "-", "%", "\n", "name", "007.1.2.3"]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(count)]
    return made + [t for t, _ in pd_.sentences(100, seed)] + ["a" * 50_000, "1" * 50_000 + "@", "1." * 20_000, "+1" * 20_000, "a@" * 5_000]


def test_base_patterns_match_their_definition():
    for text in odd_texts(1, 3000):
        if len(text) < 2000 or "@" in text or "." in text:
            base = sorted(pd_.base_spans(text), key=lambda s: (pd_.KINDS.index(s[0]), s[1]))
            assert base == plain_base(text), text[:100]


def labellings(count, segments, kinds):
    """All sets of labelled segments that do not overlap."""
    chosen = [(i, j, n, k) for n, (i, j) in enumerate(segments) for k in range(kinds)]

    def extend(at):
        yield ()
        for i, j, n, k in chosen:
            if i >= at:
                for rest in extend(j + 1):
                    yield ((n, k), *rest)

    return extend(0)


def test_programme_and_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    for text in ("ab 1 c", "x 12-3", "a@b 7"):
        tokens, segments, features = pd_.candidates(text)
        weights = rng.normal(size=(len(pd_.KINDS), (1 << pd_.BITS) + 1))
        table = pd_.scores(weights, features)
        every = list(labellings(len(tokens), segments, len(pd_.KINDS)))
        values = [sum(table[k, n] for n, k in labels) for labels in every]
        best = every[int(np.argmax(values))]
        want = sorted((pd_.KINDS[k], tokens[segments[n][0]][0], tokens[segments[n][1]][1]) for n, k in best)
        assert sorted(pd_.decode(weights, text)) == want
        total = sum(map(math.exp, values))
        marginal = pd_._marginals(len(tokens), segments, table)
        for n, k in itertools.product(range(len(segments)), range(len(pd_.KINDS))):
            share = sum(math.exp(v) for v, labels in zip(values, every) if (n, k) in labels) / total
            assert marginal[k, n] == pytest.approx(share, rel=1e-6)


def test_held_out_sentences():
    weights = pd_.default_weights()
    made = pd_.sentences(300, 77)
    right = sum(sorted(pd_.decode(weights, text)) == sorted(spans) for text, spans in made)
    assert right >= 0.93 * len(made)


LONG = "eyJhbGciOiJIUzI1NiJ9." + "eyJzdWIiOiIxMjM0NTY3ODkwIiwibmFtZSI6IkpvaG4-_x" * 3 + ".SflKxwRJSMeKKF2QT4fwpMeJf36POk6yJV_adQssw5c"


@pytest.mark.parametrize(
    "text,secret",
    [
        (f"use token={LONG} now", LONG),
        (f"use {LONG}, now", LONG),
        ("set api_key=ABCDEFGHIJKLMNOP here", "ABCDEFGHIJKLMNOP"),
        ("the password=hunter2abc works", "hunter2abc"),
        ("then sk-abcdefghijklmnop0123456789QRSTUV9 is it", "sk-abcdefghijklmnop0123456789QRSTUV9"),
        ("secret = \"" + "aB3+/x9" * 40 + "z1\" end", "aB3+/x9" * 40 + "z1"),
    ],
)
def test_whole_secrets(text, secret):
    """Beyond twelve tokens and 120 characters, without digits, and short: one span, whole."""
    _, spans = pd_.all_spans(text, pd_.default_weights(), {})
    assert [text[a:b] for kind, a, b in spans if kind == "secret"] == [secret]


def test_windows_give_what_the_whole_text_gives():
    """Cutting a text into windows changes no span."""
    weights, rng = pd_.default_weights(), random.Random(4)
    made = pd_.sentences(60, 31)
    for _ in range(25):
        text = (" " + "filler words of no interest, " * rng.randrange(9)).join(rng.choice(made)[0] for _ in range(6))
        cut = [(k, a + x, a + y) for a, b in pd_.windows(text) for k, x, y in pd_.decode(weights, text[a:b])]
        assert cut == pd_.decode(weights, text)


def test_plain_long_stretches_stay():
    for text in ("see https://abc.example/path/of/many-parts-and-words/in_a_row/index now", "a-b-c-d-e-f-g-h-i-j-k-l-m-n-o-p-q-r", "key words: one two", "x" * 300):
        assert pd_.all_spans(text, pd_.default_weights(), {})[1] == []


def test_report_and_redaction(spark):
    rows = [
        (1, "mail a.b@mail9.example.com now, ip 10.0.0.1.", "x"),
        (2, "set password=f899a7b3c99c99ee99 and call +1 (706) 555-3138", "y"),
        (2, "set password=f899a7b3c99c99ee99 and call +1 (706) 555-3138", "y"),
        (None, None, None),
        (4, "", "z"),
        (5, "nothing here, version 3. " * 2000, "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {(r["doc_id"], r["spans"]): r for r in pd_.report(docs).collect()}
    assert (1, "email:5:26,ip:35:43") in got
    second = got[2, "phone:41:58,secret:13:31"]
    assert (second["n_email"], second["n_ip"], second["n_card"], second["n_phone"]) == (0, 0, 0, 1)
    assert second["base_sha256"] == hashlib.sha256(b"phone:41:58").hexdigest()
    assert got[None, ""]["base_sha256"] == hashlib.sha256(b"").hexdigest() and (4, "") in got and (5, "") in got
    assert pd_.report(docs).count() == 6 and pd_.report(docs.where("false")).count() == 0
    clean = {r["doc_id"]: r for r in pd_.redact(docs).collect()}
    assert clean[1]["text"] == "mail [EMAIL] now, ip [IP]." and clean[1]["spans"] == "x"
    assert clean[2]["text"] == "set password=[SECRET] and call [PHONE]" and clean[None]["text"] is None
