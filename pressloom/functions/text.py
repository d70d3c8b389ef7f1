"""Text clean-up as Column expressions.

The patterns spell out Unicode classes by hand because Java's shorthand classes are ASCII only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as white space, a word character and a digit.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_ODD_SPACE = SPACE.replace(" ", "", 1)
# A run of white space that is not yet one plain blank; text with single blanks has no match and is not rebuilt.
_SPACE_RUN = f" *{_ODD_SPACE}{SPACE}*| {{2,}}"
WORD = r"[\p{L}\p{N}_]"
# All but digits, Latin letters, the Hebrew block without geresh and gershayim, angle brackets and the blank.  Plain
# ranges match several times faster than their negation.
_DROPPED = r"[\x00-\x1F!-/:;=?@\[-`{-\u058f\u05f3\u05f4\u0600-\x{10FFFF}]+"
DIGIT = r"\p{Nd}"

# Editorial labels that may open a headline.
LEAD_LABELS = (
    "צפו",
    "וידאו",
    "פרשנות",
    "דעה",
    "חשיפה",
    "מיוחד",
    "תיעוד",
    "ראיון",
    "ריאיון",
    "מדריך",
    "הסבר",
)
# Site names that may close a headline after a pipe or dash; the space in a name is optional.
SITE_NAMES = (
    "N12",
    "חדשות 12",
    "mako",
    "כאן 11",
    "Kan 11",
    "ערוץ 14",
    "ynet",
    "גלובס",
    "וואלה",
    "israelhayom",
)
# Section names that are not headlines.
SECTION_TITLES = ("אוכל", "תרבות", "חדשות", "דעה", "ספורט", "בעולם")

# Characters that both normal forms leave alone in any sequence: ASCII, Latin-1 letters, Hebrew letters, maqaf, geresh,
# gershayim, and the usual dashes and quotes.  Texts made of these never go to Python.
_STABLE_BEYOND_ASCII = r"À-ÿ־א-ת׳״–—‘’“”"
_UNSTABLE = rf"[[^\x00-\x7F]&&[^{_STABLE_BEYOND_ASCII}]]"


@F.pandas_udf(T.StringType())
def _to_nfc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFC")


@F.pandas_udf(T.StringType())
def _to_nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def _normal_form(c: Column, udf) -> Column:
    needs_python = c.rlike(_UNSTABLE)
    return F.coalesce(udf(F.when(needs_python, c)), c)


def nfc(c: Column) -> Column:
    return _normal_form(c, _to_nfc)


def nfkc(c: Column) -> Column:
    return _normal_form(c, _to_nfkc)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _SPACE_RUN, " "))


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def normalize_text(c: Column) -> Column:
    """Composed form, single spaces, runs of three or more dots as one ellipsis, trimmed; NULL gives ''."""
    s = F.regexp_replace(nfc(blank_if_null(c)), _SPACE_RUN, " ")
    return F.trim(F.regexp_replace(s, r"\.{3,}", "…"))


def strip_niqqud(c: Column) -> Column:
    return F.regexp_replace(c, r"[\u0591-\u05bd\u05bf\u05c1-\u05c7]", "")


def _cut_site_suffix(c: Column) -> Column:
    """Drop a site name after a pipe or dash at the end.  Reversed, the pattern is anchored and fails at once."""
    names = "|".join(n[::-1].replace(" ", f"{SPACE}?") for n in SITE_NAMES)
    pattern = rf"(?iu)\A{SPACE}*(?:{names}){SPACE}*[|\-–—]{SPACE}*"
    return F.reverse(F.regexp_replace(F.reverse(c), pattern, ""))


def norm_min(c: Column) -> Column:
    """Aggressive normal form used for comparing headlines.  The order of the steps matters."""
    labels = "|".join(LEAD_LABELS)
    clock = rf"(?:[01]?{DIGIT}|2[0-3]):[0-5]{DIGIT}"
    # Direction marks, joiners and bullets; an ellipsis has become three dots in the compatibility form.
    s = F.regexp_replace(nfkc(blank_if_null(c)), r"[\u200d-\u200f•·▪◦●○∙]", " ")
    s = F.regexp_replace(s, rf"(?iu)\A(?:{labels}){SPACE}*:?{SPACE}+", "")
    s = _cut_site_suffix(s)
    s = F.regexp_replace(s, rf"(?<!{WORD}){clock}(?!{WORD})", " <TIME> ")
    s = F.regexp_replace(F.lower(s), rf"{DIGIT}+(?:[.,]{DIGIT}+)?", " <NUM> ")
    s = strip_niqqud(s)
    return F.trim(F.regexp_replace(F.regexp_replace(s, _DROPPED, " "), " {2,}", " "))


def clean_title(c: Column) -> Column:
    """Letters, digits and single spaces only, lower case; control characters part words, punctuation does not."""
    s = F.regexp_replace(blank_if_null(c), rf"\p{{Cc}}|{_ODD_SPACE}", " ")
    s = F.regexp_replace(s, r"[^\p{L}\p{M}\p{N} ]+", "")
    return F.lower(F.trim(F.regexp_replace(s, " {2,}", " ")))


def normalize_summary(c: Column) -> Column:
    return collapse_spaces(blank_if_null(c))
