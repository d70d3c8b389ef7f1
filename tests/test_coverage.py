"""Outlet comparisons and character n-grams against plain loops."""

import math
import random
import re
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pressloom.operators import coverage, features, linkage

SCHEMA = "doc_id long, cluster long, source string, title string, summary string, _dt timestamp"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    words = ["Alpha", "beta", "בית", "ח", "x1", "été", "a_b"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n)) if n else None
    start = datetime(2025, 8, 10, tzinfo=timezone.utc)
    made = []
    for k in range(160):
        when = None if k % 9 == 0 else start + timedelta(minutes=rng.randrange(6000), microseconds=rng.randrange(10**6))
        source = rng.choice(["n12", "n12", "n12", "c14", "kan", None, ""])
        made.append((k, rng.choice([1, 1, 1, 2, 3, 4, None]), source, text(rng.randrange(4)), rng.choice([text(3), "", "- !"]), when))
    return made + [made[1], made[2], (900, 7, "n12", None, None, None), (901, 7, "kan", "", " ", None)]


@pytest.fixture(scope="module")
def articles(spark, rows):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def words_of(r):
    return re.findall(r"\w{2,}", f"{r[3] or ''} {r[4] or ''}".lower())


def test_outlet_overlap(articles, rows):
    counts = defaultdict(Counter)
    for r in rows:
        if r[1] is not None:
            counts[r[1], r[2] or ""].update(words_of(r))
    want = []
    for c, a in counts:
        for d, b in counts:
            if c == d and a < b:
                x, y = counts[c, a], counts[c, b]
                shared, dot = len(x.keys() & y.keys()), sum(x[w] * y[w] for w in x)
                length = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
                want.append((c, a, b, len(x), len(y), shared, shared / (len(x) + len(y) - shared) if x or y else 0.0, dot / length if length else 0.0))
    got = coverage.outlet_overlap(articles)
    assert [pytest.approx(tuple(r)) for r in sorted(got.collect())] == sorted(want)
    # No join brings articles, or rows of one word, together with each other.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_event_volume(articles, rows):
    n, w = Counter(), Counter()
    for r in rows:
        if r[1] is not None:
            for key in ((r[1], r[2] or ""), (r[1], None), (None, None)):
                n[key] += 1
                w[key] += len(words_of(r))
    want = {}
    for c, s in n:
        level = "all" if c is None else "event" if s is None else "outlet"
        above = (None, None) if s is None else (c, None)
        want[level, c, s] = (n[c, s], w[c, s], n[c, s] / n[above], w[c, s] / w[above] if w[above] else 0.0)
    got = {(r["level"], r["cluster"], r["source"]): tuple(r)[3:] for r in coverage.event_volume(articles).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_first_publisher_lag(articles, rows):
    first = {}
    for r in rows:
        if r[1] is not None:
            key = (r[1], r[2] or "")
            first[key] = min(filter(None, (first.get(key), r[5])), default=None)
    want = []
    for c in {c for c, _ in first}:
        known = sorted((t, s) for (d, s), t in first.items() if d == c and t)
        for place, (t, s) in enumerate(known):
            before = (t - known[place - 1][0]) // timedelta(seconds=1) if place else None
            want.append((c, s, place + 1, (t - known[0][0]) // timedelta(seconds=1), before))
        want += [(c, s, None, None, None) for (d, s), t in first.items() if d == c and t is None]
    got = coverage.first_publisher_lag(articles).collect()
    assert sorted(map(repr, ((r["cluster"], r["source"], r["place"], r["lag_first"], r["lag_previous"]) for r in got))) == sorted(map(repr, want))


def test_headline_lengths(articles, rows):
    by = defaultdict(list)
    for r in rows:
        by[r[2] or ""].append(len(r[3] or ""))
    for r in coverage.headline_lengths(articles, (1, 50, 100)).collect():
        x = sorted(by.pop(r["source"]))
        at = lambda p: x[-(-len(x) * p // 100) - 1]  # noqa: B023, E731
        assert tuple(r)[1:] == (len(x), x[0], x[-1], pytest.approx(sum(x) / len(x)), at(1), at(50), at(100))
    assert not by


def test_coverage_grid(articles, rows):
    cells = [(r[2] or "", r[5].date() if r[5] else None, r[1]) for r in rows]
    days = sorted({d for _, d, _ in cells if d})
    days = [days[0] + timedelta(days=k) for k in range((days[-1] - days[0]).days + 1)]
    outlets = sorted({s for s, _, _ in cells})

    def count(some):
        return len(some), len({c for *_, c in some if c is not None})

    want = {}
    for d in days:
        so_far = [x for x in cells if x[1] and x[1] <= d]
        for s in outlets:
            running = sum(x[0] == s for x in so_far)
            want["cell", s, d] = (*count([x for x in cells if x[:2] == (s, d)]), running, running / len(so_far))
        want["day", None, d] = (*count([x for x in cells if x[1] == d]), len(so_far), 1.0)
    for s in outlets:
        want["outlet", s, None] = (*count([x for x in cells if x[0] == s]), None, None)
        if undated := [x for x in cells if x[:2] == (s, None)]:
            want["cell", s, None] = (*count(undated), None, None)
    want["day", None, None] = (*count([x for x in cells if x[1] is None]), None, None)
    want["all", None, None] = (*count(cells), None, None)
    found = coverage.coverage_grid(articles).collect()
    got = {(r["level"], r["source"], r["day"]): tuple(r)[3:] for r in found}
    assert len(found) == len(got) and got.keys() == want.keys()
    assert all(got[k] == (pytest.approx(want[k]) if want[k][2] is not None else want[k]) for k in want)
    assert any(v[0] == 0 for v in got.values()) and isinstance(days[0], date)


def test_no_rows(articles):
    none = articles.where("false")
    for made in (coverage.outlet_overlap, coverage.first_publisher_lag, coverage.headline_lengths):
        assert made(none).collect() == []
    assert all(r["articles"] is None for r in coverage.event_volume(none).collect())
    assert {r["level"] for r in coverage.coverage_grid(none).collect()} <= {"all"}


def plain_grams(text):
    t = re.sub(r"\s\s+", " ", text.lower())
    return Counter(t[i : i + n] for n in (3, 4, 5) for i in range(len(t) - n + 1))


TEXTS = ["Storm hits the coast", "storm  hits \n the coast!", "the", "no", "", "שלום עולם שלום", "😀😀😀 ok", "storms hit coasts", "coast of storms", "x" * 7]


def test_character_ngrams(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = defaultdict(Counter)
    for r in features.char_counts(docs, "doc_id", F.col("text")).collect():
        got[r["doc_id"]][r["term"]] = r["tf"]
    assert [got[k] for k in range(len(TEXTS))] == [plain_grams(t) for t in TEXTS]


def plain_vectors(counts, min_df, max_df):
    df = Counter(t for c in counts for t in c)
    keep = {t: math.log((1 + len(counts)) / (1 + n)) + 1 for t, n in df.items() if min_df <= n <= max_df * len(counts)}
    raw = [{t: n * keep[t] for t, n in c.items() if t in keep} for c in counts]
    return [{t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()} for v in raw]


def test_stacked_pairs_and_clusters(spark):
    texts = [t for t in TEXTS if t] + ["Storm hits the coast"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text_for_cluster string")
    word = plain_vectors([Counter(w := re.findall(r"\w{2,}", t.lower())) + Counter(map(" ".join, zip(w, w[1:]))) for t in texts], 2, 0.75)
    char = plain_vectors([plain_grams(t) for t in texts], 2, 0.8)
    both = [{(0, t): w for t, w in x.items()} | {(1, t): 0.5 * w for t, w in y.items()} for x, y in zip(word, char)]
    length = [math.sqrt(sum(w * w for w in v.values())) for v in both]
    first = [k for k, t in enumerate(texts) if texts.index(t) == k]
    want = {}
    for i in first:
        for j in first:
            if i < j and length[i] and length[j]:
                sim = sum(w * both[j].get(t, 0) for t, w in both[i].items()) / length[i] / length[j]
                if round(1 - sim, 12) < 0.83:
                    want[i, j] = sim
    got = {(r["a"], r["b"]): r["sim"] for r in linkage.cosine_pairs(docs, chars=features.CharGrams()).collect()}
    assert got == pytest.approx(want) and len(want) > 3
    grouped = {r["doc_id"]: r["cluster"] for r in linkage.average_linkage(docs, threshold=0.6, chars=features.CharGrams()).collect()}
    assert grouped[0] == grouped[len(texts) - 1] == grouped[1] == 0 and len(set(grouped.values())) > 3


def test_cluster_terms_in_groups_and_spread(spark):
    """Clusters ranked in one group each, spread over the tasks, and some of both: the same terms."""
    rng = random.Random(3)
    word = ["alpha", "beta", "gamma", "delta", "x", "été", "בית"]
    rows = [(k, [1, 1, 1, 2, 3, None][k % 6], " ".join(rng.choice(word) for _ in range(rng.randrange(9))) if k % 7 else None, "alpha beta" if k % 3 else "") for k in range(90)]
    rows += [(90, 4, "only", ""), (91, 5, "", None)]
    articles = spark.createDataFrame(rows, "doc_id long, cluster int, title string, summary string").repartition(4)

    def ranked(chars):
        got = features.cluster_top_terms(articles, k=4, word=r"\A[\p{L}]{2,}\z", chars=chars).collect()
        return sorted((r["cluster"], r["rank"], r["term"], round(r["weight"], 8)) for r in got)

    want = []
    for c in (1, 2, 3, 4, 5):
        texts = [[w for w in re.findall(r"\w{2,}", f"{t or ''} {s or ''}".lower()) if w.isalpha()] for _, d, t, s in rows if d == c]
        counts = [Counter(t) + Counter(map(" ".join, zip(t, t[1:]))) for t in texts]
        df = Counter(t for x in counts for t in x)
        idf = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in df.items() if n <= 0.95 * len(texts)}
        total = Counter()
        for x in counts:
            raw = {t: n * idf[t] for t, n in x.items() if t in idf}
            for t, w in raw.items():
                total[t] += w / math.sqrt(sum(v * v for v in raw.values()))
        best = sorted((-round(w / len(texts), 9), t) for t, w in total.items())[:4]
        want += [(c, k + 1, t, round(-w, 8)) for k, (w, t) in enumerate(best)]
    sizes = 900
    assert ranked(10**6) == ranked(0) == ranked(sizes) == want and len(want) >= 12


def test_spread_cluster_terms_write_no_row_per_term(spark, monkeypatch):
    """What is written down on the way has at most a row per article, whatever the terms are."""
    from pressloom.session import StepTables

    rows = [(k, 1, " ".join(f"w{k}{chr(97 + j)}x" for j in range(20)), "same text") for k in range(40)]
    articles = spark.createDataFrame(rows, "doc_id long, cluster int, title string, summary string").repartition(4)
    saved, save = [], StepTables.save
    monkeypatch.setattr(StepTables, "save", lambda self, df, name: saved.append(save(self, df, name)) or saved[-1])
    got = features.cluster_top_terms(articles, k=3, word=r"\A\w{2,}\z", max_df=1.0, chars=1500).collect()
    assert [r["term"] for r in got] == ["same", "same text", "text"]
    assert saved and max(s.count() for s in saved) <= len(rows)
