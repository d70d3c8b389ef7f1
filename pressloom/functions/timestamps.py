"""Timestamps in and out: ISO and mail-style dates, offsets kept as text, UTC instants.  Needs a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"(Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)"
_ISO = rf"\A\d{{4}}-\d{{2}}-\d{{2}}(?:[T ]\d{{2}}:\d{{2}}(?::\d{{2}}(?:[.,]\d{{1,9}})?)?\s*{_OFFSET}?)?\z"
_MAIL_CLOCK = (
    r"(\d{1,2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) \d{4} \d{2}:\d{2}:\d{2})"
)
_WEEKDAY = r"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun), "
_MAIL = rf"\A(?:{_WEEKDAY})?{_MAIL_CLOCK} (?:([+-]\d{{2}}):?(\d{{2}})|Z|GMT|UTC|UT)\z"
_MAIL_NUMERIC = rf"\A{_WEEKDAY}{_MAIL_CLOCK} ([+-]\d{{2}}):?(\d{{2}})\z"


def _clock_text(iso: Column) -> Column:
    """ISO text without its offset, with a dot before the fraction."""
    return F.regexp_replace(F.regexp_replace(iso, rf"(?<=:\d\d|[.,]\d{{1,9}})\s*{_OFFSET}\z", ""), ",", ".")


def iso_wall(c: Column) -> Column:
    """Wall clock of an ISO string, with its fraction; NULL when unreadable."""
    c = F.trim(c)
    return F.when(c.rlike(_ISO), _clock_text(c).try_cast("timestamp_ntz"))


def iso_offset(c: Column) -> Column:
    """Offset of an ISO string as '+03:00', or '' when it has none."""
    raw = F.regexp_extract(F.trim(c), _ISO, 1)
    return F.when(raw == "Z", "+00:00").otherwise(F.regexp_replace(raw, r"\A([+-]\d{2}):?(\d{2})", "$1:$2"))


def _mail_instant(c: Column) -> Column:
    text = F.regexp_replace(F.regexp_replace(c, r" (?:Z|GMT|UTC|UT)\z", " +0000"), _MAIL, "$1 $2$3")
    return F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss Z"))


def parse_instant(c: Column) -> Column:
    """UTC instant of an ISO or mail-style date string; anything else is NULL."""
    c = F.trim(c)
    iso = F.regexp_replace(F.regexp_replace(c, r"([+-]\d{2})(\d{2})\z", "$1:$2"), ",", ".")
    has_clock = c.rlike(r"\A.{10}[T ]")
    iso = F.when(has_clock, iso).otherwise(c).try_cast("timestamp")
    return F.when(c.rlike(_ISO), iso).when(c.rlike(_MAIL), _mail_instant(c))


def mail_date_to_iso(c: Column) -> Column:
    """Mail-style date with a numeric offset as ISO text that keeps the offset; '' when absent or unreadable."""
    wall = F.try_to_timestamp(F.regexp_replace(c, _MAIL_NUMERIC, "$1"), F.lit("d MMM yyyy HH:mm:ss"))
    text = F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), F.regexp_replace(c, _MAIL_NUMERIC, "$2:$3"))
    return F.coalesce(F.when(c.rlike(_MAIL_NUMERIC), text), F.lit(""))


def mail_date_to_utc_iso(c: Column) -> Column:
    """Mail-style date as zone-less ISO text in UTC; NULL when absent or unreadable."""
    return F.when(c.rlike(_MAIL), F.date_format(_mail_instant(c), "yyyy-MM-dd'T'HH:mm:ss"))


def iso_text(ts: Column, offset: Column) -> Column:
    """ISO text of a moment, with the fraction only when there is one, and an offset suffix."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.000000\z", ""), offset)


def utc_iso(ts: Column) -> Column:
    """ISO text in UTC; NULL gives ''."""
    return F.coalesce(iso_text(ts, F.lit("+00:00")), F.lit(""))


def legacy_key(clean_title: Column, published_dt: Column) -> Column:
    day = F.coalesce(F.date_format(published_dt, "yyyy-MM-dd"), F.lit("no-date"))
    return F.concat(clean_title, F.lit("_"), day)
