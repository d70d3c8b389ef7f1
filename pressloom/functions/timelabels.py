"""Relative time labels such as 'לפני 3 שעות', 'אתמול 20:25' or '5 minutes ago'.

The "now" of a label is always a column (the time the record was scraped), never the clock of the machine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.text import DIGIT, SPACE, strip
from pressloom.functions.timestamps import iso_offset, iso_text, iso_wall

# The words of the two label languages.
WORDS = {
    "he": {
        "yesterday": ("אתמול",),
        "ago": ("לפני",),
        "minute": ("דקה", "דקות"),
        "hour": ("שעה", "שעות", "כשעה", "שעתיים"),
        "day": ("יום", "ימים", "יומיים"),
    },
    "en": {
        "yesterday": ("yesterday",),
        "ago": ("ago",),
        "minute": ("minute", "minutes", "min", "mins"),
        "hour": ("hour", "hours", "hr", "hrs"),
        "day": ("day", "days"),
    },
}
_HEBREW = r"[\u0590-\u05ff]"
_SHORT_CLOCK = rf"({DIGIT}{{1,2}})[:.]({DIGIT}{{2}})"
_CLOCK = r"\A(2[0-3]|[01]\d|\d):([0-5]\d|\d)\z"
_MAX_UNITS = {"days": 4_000_000, "hours": 999_999_999, "mins": 999_999_999}
_ODD_DIGITS = r"²³¹⁰-₉①-⑨"
_FIRST_DAY = "0001-01-01 00:00:00"


def _has(c: Column, *kinds: str) -> Column:
    """Does the label contain a word of one of these kinds, in its own language?"""

    def rx(lang: str) -> str:
        return "|".join(w for k in kinds for w in WORDS[lang][k])

    return F.when(c.rlike(_HEBREW), c.rlike(rx("he"))).otherwise(c.rlike(rx("en")))


def guess_locale(c: Column) -> Column:
    return F.when(c.rlike(_HEBREW), "he").otherwise("en")


def is_time_label(c: Column) -> Column:
    """Does the text look like a 'posted at' label rather than content?"""
    s = strip(F.coalesce(c, F.lit("")))
    clock = s.rlike(rf"\A{DIGIT}{{1,2}}[:.]{DIGIT}{{2}}\z")
    short = (F.char_length(s) <= 10) & s.rlike(rf"\A(?:{SPACE}|[{DIGIT}:.\-/])+\z")
    yesterday = _has(F.lower(s), "yesterday")
    number, unit, ago = s.rlike(DIGIT), _has(s, "minute", "hour", "day"), _has(s, "ago")
    relative = (ago & (number | unit)) | (number & unit)
    return (s != "") & (clock | short | yesterday | relative)


def _back(amount: Column | int, unit: str) -> Column:
    """The wall clock minus whole units; NULL when that leaves the calendar."""
    n = F.lit(amount) if isinstance(amount, int) else F.when(amount <= _MAX_UNITS[unit], amount.cast("int"))
    return F.col("_wall") - F.make_dt_interval(**{unit: n})


def _at(days_back: Column | int) -> Column:
    """The clock time of the label on the day of the wall clock, or some days before."""
    day = F.date_format(F.date_sub(F.col("_wall").cast("date"), days_back), "yyyy-MM-dd")
    clock = F.concat(F.lpad("_hour", 2, "0"), F.lit(":"), F.lpad("_minute", 2, "0"))
    return F.concat(day, F.lit(" "), clock, F.lit(":00")).try_cast("timestamp_ntz")


def _number(c: Column) -> Column:
    return c.try_cast("decimal(38,0)")


def _with_parts(df: DataFrame, label: Column, scraped_at: Column, clock: str, in_word: Column | None) -> DataFrame:
    """Working columns, in steps: a label is taken apart once and every rule reads the pieces."""
    df = df.withColumns(
        {"_s": strip(F.coalesce(label, F.lit(""))), "_wall": iso_wall(scraped_at), "_offset": iso_offset(scraped_at)}
    )
    df = df.withColumn("_words", F.split("_s", f"{SPACE}+"))
    df = df.withColumns({"_second": F.try_element_at("_words", F.lit(2)), "_last": F.try_element_at("_words", F.lit(-1))})
    place = in_word if in_word is not None else F.col("_s")
    return df.withColumns(
        {"_hour": F.regexp_extract(place, clock, 1), "_minute": F.regexp_extract(place, clock, 2)}
    )


_WORKING = ("_s", "_wall", "_offset", "_words", "_second", "_last", "_hour", "_minute", "_n", "_moment")


def _in_calendar(moment: Column) -> Column:
    return F.when(moment >= F.lit(_FIRST_DAY).cast("timestamp_ntz"), moment)


def with_parsed_label(
    df: DataFrame, label: Column, scraped_at: Column, into: str = "published_iso", dual_forms: bool = False
) -> DataFrame:
    """Adds ISO text, to the second and with the offset of `scraped_at`; '' when the label cannot be resolved.

    `dual_forms` also reads the Hebrew dual as two and the plural word for days.
    """
    relative, yesterday = F.col("_s").startswith("לפני "), F.col("_s").startswith("אתמול ")
    df = _with_parts(df, label, scraped_at, _CLOCK, F.when(yesterday, F.col("_second")).otherwise(F.col("_s")))
    second, last, n = F.col("_second"), F.col("_last"), F.col("_n")
    # Digits that are no decimal digits count as a number that cannot be read.
    digits, odd = second.rlike(rf"\A{DIGIT}+\z"), second.rlike(rf"\A[{DIGIT}{_ODD_DIGITS}]+\z")
    df = df.withColumn("_n", F.when(digits | odd, _number(second)).otherwise(F.lit(1)))
    ago = F.when(n.isNull(), None)
    if dual_forms:
        ago = ago.when(last == "שעתיים", _back(2, "hours")).when(last == "יומיים", _back(2, "days"))
        ago = ago.when(last.startswith("ימים"), _back(n, "days"))
    ago = (
        ago.when(last.startswith("דק"), _back(n, "mins"))
        .when(last.startswith("שע"), _back(n, "hours"))
        .when(last.startswith("כשע"), _back(1, "hours"))
        .when(last.startswith("יום"), _back(n, "days"))
    )
    on_clock = F.col("_hour") != ""
    time_of_day = F.concat(F.lpad("_hour", 2, "0"), F.lpad("_minute", 2, "0"), F.lit("00"))
    not_yet = time_of_day > F.date_format("_wall", "HHmmss.SSSSSS")
    day_back = F.when(yesterday | not_yet, 1).otherwise(0)
    df = df.withColumn("_moment", F.when(relative, ago).when(on_clock, _at(day_back)))
    text = F.date_format(_in_calendar(F.col("_moment")), "yyyy-MM-dd'T'HH:mm:ss")
    return df.withColumn(into, F.coalesce(F.concat(text, F.col("_offset")), F.lit(""))).drop(*_WORKING)


def with_loosely_parsed_label(df: DataFrame, label: Column, scraped_at: Column, into: str = "published_iso") -> DataFrame:
    """Adds the wider Hebrew and English reading: no roll-back of clock times, fractions kept; NULL when unsure."""
    df = _with_parts(df, label, scraped_at, _SHORT_CLOCK, None)
    s, n = F.col("_s"), F.col("_n")
    found = F.nullif(F.regexp_extract("_s", rf"{DIGIT}+", 0), F.lit(""))
    df = df.withColumn("_n", F.when(found.isNull(), F.lit(1)).otherwise(_number(found)))
    hebrew = s.rlike(_HEBREW)
    told = hebrew | _has(s, "ago")
    clock, no_clock, on_day_before = s.rlike(rf"\A{_SHORT_CLOCK}\z"), F.col("_hour") == "", _has(F.lower(s), "yesterday")
    moment = (
        F.when(~clock & on_day_before & no_clock, _back(1, "days"))
        .when(clock | on_day_before, _at(F.when(clock, 0).otherwise(1)))
        .when(hebrew & s.contains("שעתיים"), _back(2, "hours"))
        .when(hebrew & s.contains("יומיים"), _back(2, "days"))
        .when(_has(s, "minute") & told, _back(n, "mins"))
        .when(_has(s, "hour") & told, _back(n, "hours"))
        .when(_has(s, "day") & told, _back(n, "days"))
    )
    df = df.withColumn("_moment", moment)
    return df.withColumn(into, iso_text(_in_calendar(F.col("_moment")), F.col("_offset"))).drop(*_WORKING)
