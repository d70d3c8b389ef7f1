"""Literal cases and properties of the column functions."""

import datetime as dt
import hashlib
import re
import unicodedata
from functools import partial
from urllib.parse import urlsplit, urlunsplit

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressloom.functions import text, timelabels, timestamps, urls

NOW = "2025-08-24T15:41:39+03:00"

LABELS = [
    ("לפני דקה", True, "2025-08-24T15:40:39+03:00"),
    ("לפני שעה", True, "2025-08-24T14:41:39+03:00"),
    ("לפני 3 שעות", True, "2025-08-24T12:41:39+03:00"),
    ("לפני יום", True, "2025-08-23T15:41:39+03:00"),
    ("לפני 2 ימים", True, ""),
    ("לפני יומיים", True, ""),
    ("לפני כשעה", True, "2025-08-24T14:41:39+03:00"),
    ("לפני שעתיים", True, "2025-08-24T14:41:39+03:00"),
    ("לפני 55 דקות", True, "2025-08-24T14:46:39+03:00"),
    ("לפני 4 דק'", True, "2025-08-24T15:37:39+03:00"),
    ("לפני  3   שעות ", True, "2025-08-24T12:41:39+03:00"),
    ("לפני 99999999999 דקות", True, ""),
    ("לפני 9999999 ימים", True, ""),
    ("לפני 9999999 יום", True, ""),
    ("אתמול 20:25", True, "2025-08-23T20:25:00+03:00"),
    ("אתמול 20:25 עדכון", True, "2025-08-23T20:25:00+03:00"),
    ("אתמול 25:25", True, ""),
    ("אתמול", True, ""),
    ("05:58", True, "2025-08-24T05:58:00+03:00"),
    ("23:10", True, "2025-08-23T23:10:00+03:00"),
    ("1:2", True, "2025-08-24T01:02:00+03:00"),
    ("10.22", True, ""),
    ("21.08.25", True, ""),
    ("12:30:45", True, ""),
    ("25:00", True, ""),
    ("5 minutes ago", True, ""),
    ("YESTERDAY", True, ""),
    ("12 Hours", False, ""),
    ("3 days", True, ""),
    ("long ago", False, ""),
    ("כותרת כתבה", False, ""),
    ("טקסט רגיל", False, ""),
    ("", False, ""),
    (None, False, ""),
]


def test_time_label_flags(evaluate):
    got = evaluate(timelabels.is_time_label, [c[0] for c in LABELS])
    assert got == [c[1] for c in LABELS]


def test_time_label_parse(evaluate):
    got = evaluate(timelabels.with_parsed_label, [(c[0], NOW) for c in LABELS], adds_column=True)
    assert dict(zip([c[0] for c in LABELS], got)) == {c[0]: c[2] for c in LABELS}


def test_time_label_parse_dual_forms(evaluate):
    rows = [("לפני 2 ימים", NOW), ("לפני שעתיים", NOW), ("לפני יומיים", NOW), ("לפני 3 שעות", NOW)]
    got = evaluate(partial(timelabels.with_parsed_label, dual_forms=True), rows, adds_column=True)
    assert got == [
        "2025-08-22T15:41:39+03:00",
        "2025-08-24T13:41:39+03:00",
        "2025-08-22T15:41:39+03:00",
        "2025-08-24T12:41:39+03:00",
    ]


def test_time_label_needs_a_readable_now(evaluate):
    rows = [("לפני שעה", None), ("לפני שעה", "soon"), ("לפני שעה", "2025-08-24"), ("05:58", "2025-08-24T15:41:39.5Z")]
    assert evaluate(timelabels.with_parsed_label, rows, adds_column=True) == ["", "", "2025-08-23T23:00:00", "2025-08-24T05:58:00+00:00"]


def test_time_label_loose(evaluate):
    now = "2025-08-24T15:41:39.250000+03:00"
    cases = {
        "23:10": "2025-08-24T23:10:00+03:00",
        "10.22": "2025-08-24T10:22:00+03:00",
        "25:00": None,
        "אתמול": "2025-08-23T15:41:39.250000+03:00",
        "Yesterday at 20:25": "2025-08-23T20:25:00+03:00",
        "yesterday 29:25": None,
        "5 minutes ago": "2025-08-24T15:36:39.250000+03:00",
        "5 minutes": None,
        "5 דקות": "2025-08-24T15:36:39.250000+03:00",
        "לפני שעתיים": "2025-08-24T13:41:39.250000+03:00",
        "לפני יומיים": "2025-08-22T15:41:39.250000+03:00",
        "לפני 2 ימים": "2025-08-22T15:41:39.250000+03:00",
        "2 hrs ago": "2025-08-24T13:41:39.250000+03:00",
        "a day ago": "2025-08-23T15:41:39.250000+03:00",
        "כותרת": None,
        "": None,
    }
    got = evaluate(timelabels.with_loosely_parsed_label, [(k, now) for k in cases], adds_column=True)
    assert dict(zip(cases, got)) == cases


def test_guess_locale(evaluate):
    assert evaluate(timelabels.guess_locale, ["abc", "abc ש", ""]) == ["en", "he", "en"]


URLS = {
    "https://C14.co.il/article/128?utm_source=x#frag": "https://c14.co.il/article/128",
    "https://ex.com/a": "https://ex.com/a",
    "http://ex.com/b/": "https://ex.com/b",
    "https://ex.com/a?utm=1": "https://ex.com/a?utm=1",
    "": "https://",
    "u1": "https:u1",
    "/foo/": "https:///foo",
    "//h.com/a/": "https://h.com/a",
    "http://x.com/a?": "https://x.com/a",
    "mailto:a@b": "https:a@b",
    "http://x.com/a//?q=1": "https://x.com/a?q=1",
    "HTTP://WWW.C14.co.il/section/": "https://www.c14.co.il/section",
    "http://[bad": "http://[bad",
    "http://[::1]:80/a/": "https://[::1]:80/a",
    "  http://X.com/\ta\n/b#": "https://x.com/a/b",
    "http://User:P@Ho.St:80/x?a#b": "https://user:p@ho.st:80/x?a#b",
    "http:////x//": "https:////x",
}


def canonical_by_stdlib(url, hosts=urls.TRACKING_HOSTS):
    try:
        u = urlsplit(url)
    except ValueError:
        return url
    keep = not any(h in u.netloc.lower() for h in hosts)
    return urlunsplit(("https", u.netloc.lower(), u.path.rstrip("/"), u.query if keep else "", u.fragment if keep else ""))


def test_canonicalize_url(evaluate):
    got = dict(zip(URLS, evaluate(urls.canonicalize_url, list(URLS))))
    assert got == URLS
    assert got == {u: canonical_by_stdlib(u) for u in URLS}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="htps:/?#.@mako.co.ilC14 ab\t\n", max_size=30), min_size=20, max_size=60))
def test_canonicalize_url_agrees_and_is_idempotent(evaluate, samples):
    once = evaluate(urls.canonicalize_url, samples)
    assert once == [canonical_by_stdlib(u) for u in samples]
    twice = evaluate(urls.canonicalize_url, once)
    assert twice == [canonical_by_stdlib(u) for u in once]


def test_url_ids_and_keys(evaluate):
    mako = "https://www.mako.co.il/news-israel/2025_q3/Article-a5b1eb157cba891026.htm"
    rows = [
        ("https://c14.co.il/article/128", "c14"),
        (mako, "n12"),
        ("https://c14.co.il/section", "mako"),
        ("https://ex.com/article/5", "c14"),
        ("https://ex.com/a", "x"),
    ]
    ids = evaluate(urls.extract_url_id, rows)
    assert ids == ["128", "a5b1eb157cba891026", None, "5", None]

    def key(u, s):
        canon = urls.canonicalize_url(u)
        return urls.build_record_key(s, canon, urls.extract_url_id(canon, s))

    rows += [("http://ex.com/b/", "X "), ("https://ex.com/a?utm=1", "x"), ("", "x")]
    assert evaluate(key, rows) == [
        "c14:128",
        "n12:a5b1eb157cba891026",
        "mako:" + hashlib.sha1(b"https://c14.co.il/section").hexdigest()[:12],
        "c14:5",
        "x:2c656e144ca8",
        "x:ba05161820aa",
        "x:95f4f2289306",
        "x:a9a13761cc52",
    ]
    assert evaluate(urls.short_hash, ["abc", None]) == ["a9993e3647", "da39a3ee5e"]


NORM_MIN = {
    "צפו: תל-אביב | N12": "תל אביב",
    "דעה מה קורה - MAKO": "מה קורה",
    "צפו:בלי רווח": "צפו בלי רווח",
    "  צפו: רווח מוביל": "צפו רווח מוביל",
    "ב-12:30 נהרגו 1,250 איש": "ב <time> נהרגו <NUM> איש",
    "12,345,678": "<NUM> <NUM>",
    'ש"ס': "ש ס",
    "ש״ס": "ש ס",
    "für Ünal": "f r nal",
    "ערוץ 14 | ערוץ 14": "ערוץ <NUM>",
    "• אחת • שתיים": "אחת שתיים",
    "112:30 a12:30 7:05": "<NUM> <NUM> a <NUM> <NUM> <time>",
    "ＡＢＣ １２": "abc <NUM>",
    "": "",
    None: "",
}


def test_norm_min(evaluate):
    assert dict(zip(NORM_MIN, evaluate(text.norm_min, list(NORM_MIN)))) == NORM_MIN


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=40), min_size=30, max_size=60))
def test_norm_min_alphabet(evaluate, samples):
    samples = [s.encode("utf-8", "ignore").decode() for s in samples]
    for out in evaluate(text.norm_min, samples):
        assert re.fullmatch(r"[0-9A-Za-z\u0590-\u05ff<> ]*", out)
        assert out == out.strip() and "  " not in out


def test_normalize_text(evaluate):
    cases = {
        "  a\t\tb\n c ": "a b c",
        "wait.....now..": "wait…now..",
        "e\u0301": "é",
        "a\u3000b\x1cc": "a b c",
        "": "",
        None: "",
    }
    assert dict(zip(cases, evaluate(text.normalize_text, list(cases)))) == cases


def test_characters_that_skip_python_are_stable():
    stable = re.compile(f"[\\x00-\\x7F{text._STABLE_BEYOND_ASCII}]")
    for code in range(0x3000):
        if stable.match(chr(code)):
            assert unicodedata.normalize("NFKC", chr(code)) == chr(code) == unicodedata.normalize("NFC", chr(code))
            assert unicodedata.combining(chr(code)) == 0


def test_strip_niqqud(evaluate):
    assert evaluate(text.strip_niqqud, ["ש\u05b8\u05c1לו\u05b9ם־עו\u05b9ל\u05b8ם׀"]) == ["שלום־עולם׀"]


def test_clean_title_and_summary(evaluate):
    cases = {
        "  שלום, עולם!!  ": "שלום עולם",
        "חדשות היום 📰🔥  ": "חדשות היום",
        "כותרת\x00  עם  NUL": "כותרת עם nul",
        "זה   טקסט \tעם   רווחים\nמרובים ": "זה טקסט עם רווחים מרובים",
        '"הצהרה" – בדיקה': "הצהרה בדיקה",
        "Breaking: חדשות-חמות!!": "breaking חדשותחמות",
    }
    assert dict(zip(cases, evaluate(text.clean_title, list(cases)))) == cases
    summaries = {None: "", "": "", "  זה סיכום   קצר  ": "זה סיכום קצר", "\nשורה א\nשורה ב\t": "שורה א שורה ב"}
    assert dict(zip(summaries, evaluate(text.normalize_summary, list(summaries)))) == summaries


def test_parse_instant(evaluate):
    cases = {
        "2025-08-10T10:00:00": "2025-08-10T10:00:00+00:00",
        "2025-08-25T18:57:06+03:00": "2025-08-25T15:57:06+00:00",
        "2025-08-06T20:37:24.319230+00:00": "2025-08-06T20:37:24.319230+00:00",
        "2025-08-10": "2025-08-10T00:00:00+00:00",
        "Sun, 24 Aug 2025 15:41:39 +0300": "2025-08-24T12:41:39+00:00",
        "Sun, 24 Aug 2025 15:41:39 GMT": "2025-08-24T15:41:39+00:00",
        "05:58": "",
        "לפני שעה": "",
        "2025-13-10": "",
        "": "",
        None: "",
    }
    got = evaluate(lambda c: timestamps.utc_iso(timestamps.parse_instant(c)), list(cases))
    assert dict(zip(cases, got)) == cases


def test_mail_dates(evaluate):
    rows = ["Sun, 24 Aug 2025 15:41:39 +0300", "Sun, 24 Aug 2025 15:41:39 GMT", "nonsense", None]
    assert evaluate(timestamps.mail_date_to_iso, rows) == ["2025-08-24T15:41:39+03:00", "", "", ""]
    assert evaluate(timestamps.mail_date_to_utc_iso, rows) == ["2025-08-24T12:41:39", "2025-08-24T15:41:39", None, None]
    want = dt.datetime.strptime(rows[0], "%a, %d %b %Y %H:%M:%S %z").isoformat()
    assert want == "2025-08-24T15:41:39+03:00"


def test_legacy_key(evaluate):
    def key(title, iso):
        return timestamps.legacy_key(text.clean_title(title), timestamps.parse_instant(iso))

    rows = [("כתבה א", "2025-08-10T10:00:00"), ("B", "bad-date"), ("C", None)]
    assert evaluate(key, rows) == ["כתבה א_2025-08-10", "b_no-date", "c_no-date"]


@pytest.mark.parametrize("fn", [text.normalize_text, text.norm_min, text.clean_title, text.normalize_summary])
def test_nulls_become_blank(evaluate, fn):
    assert evaluate(fn, [None, ""]) == ["", ""]
