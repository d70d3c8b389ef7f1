"""Personal data by a semi-Markov conditional random field, on top of four exact base patterns.

Base spans are what the patterns of the contract match.  The field adds spans: secrets (keys, passwords, tokens) and spans
of the base kinds in forms that the patterns do not know.  A candidate segment is a run of up to `MOST_TOKENS` tokens that
holds a digit or an @, or that a credential's name and an equals sign or colon stand before; and, whatever its length, all
that is left of a stretch without white space, from its start or from behind its first equals sign or colon.  Its features
look at the whole span (shape, length, digits, checksums, letters) and at its neighbours.  The score of a labelling is the
sum over its segments, so one dynamic programme picks boundaries and kinds together.  A token outside all candidates is plain
text under every labelling; so only windows go through the programme, which reach as far around a digit, an @ or a
credential's name as a candidate and its neighbours can; this gives the result of a run over the whole text.

The weights are trained by maximum likelihood (forward-backward over segments) on sentences made by a rule: invented words
around entities of each kind, and numbers that are none (dates, versions, prices, times, counts).  Training takes a fixed
number of sentences and does not depend on the corpus.  Texts are read where they lie; nothing is shuffled.

Added spans never overlap base spans or each other; base spans of different kinds may overlap, as the contract has them.

Edge cases: NULL and empty texts have no spans and the digest of the empty string; places are code points; repeated rows
get a row each; a NULL doc_id is carried through; `redact` keeps all other columns.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from pressloom.llm import common

# The base kinds in the order of the contract; the field adds the last one.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
MOST_TOKENS = 12
AROUND = 4
BITS = 15
SENTENCES, EPOCHS, RATE, DECAY, SEED = 1500, 5, 0.5, 1e-4, 5
CACHE = 20_000

Span = tuple[str, int, int]

# --- base patterns; each reads a text in linear time

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterable[tuple[int, int]]:
    """At each @ the local part is the whole run before it, as a leftmost match takes it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                spans.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c.isascii() and c.isdigit() for c in m.group()) <= 15:
                    spans.append(("phone", *m.span()))
    return spans


# --- windows and candidate segments

_TOKEN = re.compile(r"[^\W_]+|[^\s]")
_NAMED = re.compile(r"(?:pass(?:word|wd|phrase)?|secret|token|key)[\"']?\s?[=:]\s?[\"']?\Z", re.I)
_TRIGGER = re.compile(r"[0-9@]|(?i:pass(?:word|wd|phrase)?|secret|token|key)[\"']?\s?[=:]\s?[\"']?(?=\S)")
_PIECE = re.compile(r"\S+")


def windows(text: str) -> list[tuple[int, int]]:
    """Character ranges around everything that may be in a candidate, joined where they meet.

    They hold whole stretches without white space: of those before, so many that they have `MOST_TOKENS` tokens and the
    `AROUND` that features look at, and of those behind `MOST_TOKENS`; a stretch has one token at least.
    """
    out: list[tuple[int, int]] = []
    pieces: list[tuple[int, int]] | None = None
    at, place = 0, 0
    while m := _TRIGGER.search(text, at):
        if pieces is None:
            pieces = [p.span() for p in _PIECE.finditer(text)]
        start = m.start() if text[m.start()] in "0123456789@" else m.end()
        place = bisect_right(pieces, (start, len(text)), lo=place) - 1
        low, high = max(place - MOST_TOKENS - AROUND, 0), min(place + MOST_TOKENS, len(pieces) - 1)
        a, b = pieces[low][0], pieces[high][1]
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
        at = max(pieces[place][1], m.end())  # the rest of the stretch is in the same window
    return out


_SHAPE = ((re.compile(r"[0-9]"), "0"), (re.compile(r"[A-Z]"), "A"), (re.compile(r"[^\W\d_A-Z]"), "a"))
_RUNS = re.compile(r"(.)\1+")


def _shape(text: str) -> str:
    for pattern, by in _SHAPE:
        text = pattern.sub(by, text)
    return text


def _features(text: str, start: int, end: int, before: str, left: str, right: str, count: int) -> list[str]:
    span = text[start:end]
    shape = _shape(span)
    digits = shape.count("0")
    letters = shape.count("a") + shape.count("A")
    short = _RUNS.sub(r"\1", shape)
    size = min(len(span), 40) // 2
    mixed = "both" if digits and letters else "digits" if digits else "letters"
    plain = span.isalnum()
    hexadecimal = plain and all(c in "0123456789abcdef" for c in span)
    number = "".join(c for c in span if "0" <= c <= "9")
    checked = digits == len(shape.replace(" ", "").replace("-", "")) and 15 < digits < 20 and luhn(number)
    parts = span.split(".")
    octets = len(parts) == 4 and all(p.isdigit() and p.isascii() and len(p) < 4 and int(p) < 256 for p in parts)
    return [
        f"short {short[:24]}",
        f"shape {shape}" if len(shape) < 24 else f"long {short[:24]} {size}",
        f"size {size} {mixed}",
        f"digits {min(digits, 20)} {mixed}",
        f"tokens {count} {mixed}",
        f"before {before}",
        f"before {before} {mixed} {size}",
        f"left {left} {shape[0]}",
        f"right {right} {shape[-1]}",
        f"left {left} right {right}",
        f"edges {shape[0]}{shape[-1]} {mixed}",
        f"luhn {checked}",
        f"octets {octets}",
        f"at {span.count('@')} dots {min(span.count('.'), 4)}",
        f"spaces {min(span.count(' ') + span.count(chr(10)), 4)} at {span.count('@')}",
        f"hex {hexadecimal} {size}",
        f"plain {plain} {mixed} {size}",
    ]


def candidates(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]], np.ndarray]:
    """Token ranges of a window, candidate segments (first and last token) and the feature numbers of each."""
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    marked = [any("0" <= c <= "9" or c == "@" for c in text[a:b]) for a, b in tokens]
    # The last token of each stretch that a segment may end with, and where the value in the stretch starts.
    last, value = [0] * len(tokens), [False] * len(tokens)
    first = 0
    for k, (_, end) in enumerate(tokens):
        if k + 1 == len(tokens) or tokens[k + 1][0] > end:
            stop = next((j for j in range(k, first - 1, -1) if text[tokens[j][1] - 1].isalnum()), first)
            last[first : k + 1] = [stop] * (k + 1 - first)
            opens = [j for j in range(first, k + 1) if text[tokens[j][0]].isalnum()]
            behind = next((j for j in range(first, k) if text[tokens[j][0]] in "=:"), k)
            for j in (*opens[:1], *[j for j in opens if j > behind][:1]):
                value[j] = True
            first = k + 1
    segments, features = [], []
    for i, (start, _) in enumerate(tokens):
        if not (text[start].isalnum() or text[start] in "+("):
            continue
        glued = i > 0 and tokens[i - 1][1] == start
        left = _shape(text[start - 1]) if glued else " "
        words = [text[a:b].lower() for a, b in tokens[max(i - 4, 0) : i] if text[a].isalpha()]
        assigned = [text[a:b] for a, b in tokens[max(i - 3, 0) : i] if text[a:b] in "=:"]
        before = f"{words[-1]}{assigned[-1]}" if words and assigned else ""
        named = bool(assigned) and bool(_NAMED.search(text, max(start - 40, 0), start))
        ends = list(range(i, min(i + MOST_TOKENS, len(tokens))))
        if value[i] and last[i] > ends[-1]:
            ends.append(last[i])
        seen = False
        for j in ends:
            seen = seen or marked[j] or named or j - i >= MOST_TOKENS and any(marked[i : j + 1])
            end = tokens[j][1]
            if not seen or not text[end - 1].isalnum():
                continue
            right = _shape(text[end]) if end < len(text) and not text[end].isspace() else " "
            segments.append((i, j))
            names = _features(text, start, end, before, left, right, min(j - i, MOST_TOKENS) + 1)
            names += [f"whole {value[i] and j == last[i]} {before}", f"named {named} {j == last[i]}"]
            features.append([zlib.crc32(f"{k} {n}".encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1) for k, n in enumerate(names)])
    return tokens, segments, np.array(features, dtype=np.int64)


# --- the field


def scores(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """(kinds, segments); `weights` is (kinds, features), the last column being the kind's own weight."""
    if not len(features):
        return np.zeros((len(KINDS), 0))
    return weights[:, features].sum(axis=2) + weights[:, -1:]


def decode(weights: np.ndarray, text: str) -> list[Span]:
    """The best labelling of a window; a plain token scores 0."""
    tokens, segments, features = candidates(text)
    if not segments:
        return []
    table = scores(weights, features)
    kind, best = table.argmax(axis=0), table.max(axis=0)
    ending: dict[int, list[int]] = {}
    for n, (_, j) in enumerate(segments):
        if best[n] > 0:
            ending.setdefault(j, []).append(n)
    value, back = [0.0] * (len(tokens) + 1), [-1] * (len(tokens) + 1)
    for j in range(len(tokens)):
        value[j + 1] = value[j]
        for n in ending.get(j, ()):
            total = value[segments[n][0]] + best[n]
            if total > value[j + 1]:
                value[j + 1], back[j + 1] = total, n
    spans, j = [], len(tokens)
    while j > 0:
        n = back[j]
        if n < 0:
            j -= 1
        else:
            i, last = segments[n]
            spans.append((KINDS[kind[n]], tokens[i][0], tokens[last][1]))
            j = i
    return spans[::-1]


def _marginals(count: int, segments: list[tuple[int, int]], table: np.ndarray) -> np.ndarray:
    """Probability of each (kind, segment) under the field, in log space."""
    top = table.max(axis=0)
    mass = top + np.log(np.exp(table - top).sum(axis=0))  # of a segment under all kinds
    ending: list[list[int]] = [[] for _ in range(count)]
    starting: list[list[int]] = [[] for _ in range(count)]
    for n, (i, j) in enumerate(segments):
        ending[j].append(n)
        starting[i].append(n)
    forward, backward = [0.0] * (count + 1), [0.0] * (count + 1)

    def total(values: list[float]) -> float:
        high = max(values)
        return high + math.log(sum(math.exp(v - high) for v in values))

    for j in range(count):
        forward[j + 1] = total([forward[j], *(forward[segments[n][0]] + mass[n] for n in ending[j])])
    for i in range(count - 1, -1, -1):
        backward[i] = total([backward[i + 1], *(backward[segments[n][1] + 1] + mass[n] for n in starting[i])])
    around = np.array([forward[i] + backward[j + 1] for i, j in segments]) - forward[count]
    return np.exp(table + around)


def train(sentences: list[tuple[str, list[Span]]]) -> np.ndarray:
    """Maximum likelihood by AdaGrad, one sentence at a time."""
    weights = np.zeros((len(KINDS), (1 << BITS) + 1))
    squares = np.full_like(weights, 1e-6)
    weights[:, -1] = -1.0
    prepared = []
    for text, spans in sentences:
        tokens, segments, features = candidates(text)
        if not segments:
            continue
        truth = np.zeros((len(KINDS), len(segments)))
        place = {(tokens[i][0], tokens[j][1]): n for n, (i, j) in enumerate(segments)}
        for kind, a, b in spans:
            if (a, b) in place:
                truth[KINDS.index(kind), place[a, b]] = 1
        prepared.append((len(tokens), segments, features, truth))
    order = random.Random(SEED)
    for _ in range(EPOCHS):
        order.shuffle(prepared)
        for count, segments, features, truth in prepared:
            wrong = truth - _marginals(count, segments, scores(weights, features))
            kinds, rows = np.nonzero(np.abs(wrong) > 1e-4)
            if not len(kinds):
                continue
            error = wrong[kinds, rows]
            slots = np.concatenate([features[rows], np.full((len(rows), 1), 1 << BITS)], axis=1)
            flat = (kinds[:, None] * weights.shape[1] + slots).ravel()
            unique, at = np.unique(flat, return_inverse=True)
            gradient = np.bincount(at, np.repeat(error, slots.shape[1]))
            w, s = weights.ravel(), squares.ravel()
            gradient -= DECAY * w[unique]
            s[unique] += gradient**2
            w[unique] += RATE * gradient / np.sqrt(s[unique])
    return weights


def sentences(count: int = SENTENCES, seed: int = SEED) -> list[tuple[str, list[Span]]]:
    """Training sentences: invented words around entities and around numbers that are none."""
    rng = random.Random(seed)
    letters, hexa = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 9)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    some = lambda alphabet, a, b: "".join(rng.choice(alphabet) for _ in range(rng.randrange(a, b)))

    def card() -> str:
        body = digits(rng.choice((15, 15, 15, 18)))
        body += next(c for c in "0123456789" if luhn(body + c))
        return rng.choice((body, body, " ".join(re.findall("..?.?.?", body)), "-".join(re.findall("..?.?.?", body))))

    def email() -> str:
        host = ".".join([word() + rng.choice(("", digits(1))) for _ in range(rng.randrange(1, 3))] + [rng.choice(("com", "org", "net", "de", "example"))])
        return word() + rng.choice(("", ".", "_", "+", "-")).join(("", rng.choice((word(), digits(2))))) + "@" + host

    def phone() -> str:
        country = "+" + digits(rng.randrange(1, 3)).replace("0", "4")
        forms = (f"{country} ({digits(3)}) {digits(3)}-{digits(4)}", f"{country} {digits(3)} {digits(7)}", f"{country}-{digits(3)}-{digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}")
        return rng.choice(forms)

    base64, upper = hexa + letters + letters.upper() + "0123456789", letters.upper()

    def secret() -> tuple[str, str]:
        if rng.random() < 0.45:
            name = rng.choice(("password", "token", "secret", "api_key", "apikey", "passwd", "key", "access_token"))
            lead = rng.choice((f"{name}=", f"{name}: ", f"{name} = ", f"{name}='", f"{name} = \""))
            form = rng.randrange(5)
            if form == 0:  # signed tokens, also without a name
                return ".".join(some(base64 + "-_", 12, 70) + digits(1) for _ in range(3)), rng.choice((lead, "Bearer ", ""))
            if form == 1:
                return some(base64 + "+/", 20, 70) + digits(1), lead
            if form == 2:
                return some(upper, 10, 30), lead
            if form == 3:
                return word() + some(letters, 2, 5) + digits(rng.randrange(0, 4)) + some(letters, 1, 4), f"{rng.choice(('password', 'passwd', 'secret'))}{rng.choice(('=', ': ', ':'))}"
            return f"{rng.choice(('sk', 'pk', 'rk'))}{rng.choice('-_')}" + some(base64, 20, 44) + digits(1), rng.choice((lead, ""))
        value = some(hexa, 16, 44)
        while not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
            value = some(hexa, 16, 44)
        name = rng.choice(("password", "token", "secret", "api_key", "apikey", "passwd", "key", "access_token"))
        if rng.random() < 0.3:
            prefix, size = rng.choice((("AKIA", 16), ("AKIA", 16), ("ASIA", 16), ("ghp", 36)))
            return prefix + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(size - 2)) + digits(2), ""
        return value, rng.choice((f"{name}=", f"{name} = \"", f"{name}: ", f"{name}:", f"{name}='", f"{name} = "))

    def plain() -> str:
        forms = (
            f"version {digits(1)}", f"Version {digits(1)}.{digits(1)}", f"{digits(1)}.{digits(1)}", f"v{digits(1)}.{digits(2)}.{digits(1)}",
            f"20{digits(2)}-{digits(2)}-{digits(2)}", f"{digits(2)}.{digits(2)}.20{digits(2)}", f"{digits(2)}:{digits(2)}", f"{digits(1)},{digits(3)},{digits(3)}",
            f"${digits(2)}.{digits(2)}", digits(rng.randrange(1, 7)), f"{digits(4)} {digits(2)}", f"{digits(3)}%", f"no. {digits(rng.randrange(3, 11))}", f"{word()}{digits(2)}", f"{digits(2)}x{digits(2)}", f"@{word()}",
            f"{digits(4)}-{digits(4)}", f"{digits(3)}.{digits(3)}", f"{rng.randrange(256, 999)}.{digits(3)}.{digits(1)}.{digits(1)}", f"{word()}={digits(3)}", f"{word()} = \"{word()}\"", f"{word()}: {digits(2)}",
            f"https://{word()}.{word()}/{word()}/{digits(3)}?{word()}={word()}", f"/{word()}/{word()}_{word()}-{digits(2)}.{word()}", f"{word()}-{word()}-{word()}-{digits(2)}", f"{word()}:{word()}", f"{word()}={word()}",
        )
        return rng.choice(forms)

    out = []
    for _ in range(count):
        text, spans = " ".join(word() for _ in range(rng.randrange(0, 5))), []
        for _ in range(rng.randrange(1, 3)):
            text += rng.choice((" ", " ", " ", "\n", ". ", " (", ", ")) if text else ""
            kind = rng.choice((*KINDS, "secret", "plain", "plain", "plain"))
            if kind == "plain":
                text += plain()
            elif kind == "secret":
                value, lead = secret()
                text += lead
                spans.append((kind, len(text), len(text) + len(value)))
                text += value + (lead[-1] if lead and lead[-1] in "\"'" else "")
            else:
                value = {"card": card, "email": email, "phone": phone}.get(kind, lambda: ".".join(str(rng.randrange(256)) for _ in range(4)))()
                spans.append((kind, len(text), len(text) + len(value)))
                text += value
            text += rng.choice(("", "", "", ".", ",", ")", ";")) + " " + " ".join(word() for _ in range(rng.randrange(1, 5)))
        out.append((text, spans))
    return out


@lru_cache(maxsize=1)
def default_weights() -> np.ndarray:
    return train(sentences()).astype(np.float32)


# --- documents


def all_spans(text: str, weights: np.ndarray, known: dict[str, list[Span]]) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans, both by kind and start."""
    if not _TRIGGER.search(text):
        return [], []
    order = lambda s: (KINDS.index(s[0]), s[1])
    base = sorted(base_spans(text), key=order)
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for start, stop in windows(text):
        window = text[start:stop]
        found = known.get(window)
        if found is None:
            found = decode(weights, window)
            if len(known) >= CACHE:
                known.clear()
            known[window] = found
        for kind, a, b in found:
            if not any(x < start + b and start + a < y for x, y in taken):
                added.append((kind, start + a, start + b))
    return base, sorted(base + added, key=order)


SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("base", IntegerType())]))


def finder(spark, weights: np.ndarray | None = None) -> Callable[[Column], Column]:
    """text -> array of (kind, start, end, base 0 or 1), by kind and start."""
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast(default_weights() if weights is None else weights)

    @F.pandas_udf(SPANS)
    def find(texts: pd.Series) -> pd.Series:
        known: dict[str, list[Span]] = {}
        out = []
        for text in texts:
            base, every = all_spans(text, shared.value, known)
            marks = set(base)
            out.append([{"kind": k, "start": a, "end": b, "base": int((k, a, b) in marks)} for k, a, b in every])
        return pd.Series(out)

    return find


def report(docs: DataFrame) -> DataFrame:
    found = docs.select("doc_id", finder(docs.sparkSession)(common.whole("text")).alias("spans"))
    base = F.filter("spans", lambda s: s["base"] == 1)
    of = lambda kind: lambda s: s["kind"] == kind
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[F.size(F.filter(base, of(kind))).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of `text` replaced by its kind in brackets; overlapping spans become one."""
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(default_weights())

    @F.pandas_udf(StringType())
    def masked(texts: pd.Series) -> pd.Series:
        known: dict[str, list[Span]] = {}

        def one(text):
            if text is None:
                return None
            pieces, last = [], 0
            for kind, a, b in sorted(all_spans(text, shared.value, known)[1], key=lambda s: (s[1], -s[2])):
                if a >= last:
                    pieces += [text[last:a], f"[{kind.upper()}]"]
                last = max(last, b)
            return "".join([*pieces, text[last:]])

        return pd.Series([one(t) for t in texts], dtype=object)

    return docs.withColumn("text", masked("text"))
