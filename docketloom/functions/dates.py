"""Dates in text, with their precision kept, inside a plausible window. All native.

A hit is struct(iso, precision, raw, start). ``as_of`` is a date column or literal; nothing reads the clock.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, col, let, spans, squash, strip

EARLIEST_YEAR = 1935
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth")
#: Every day of a month in words, 1 to 31.
DAY_WORDS = (*ORDINALS, "twentieth", *(f"twenty {w}" for w in ORDINALS[:9]), "thirtieth", "thirty first")
HIT = "array<struct<iso:string,precision:string,raw:string,start:int>>"

_MONTH = "(?:" + "|".join(MONTHS) + ")"
_WORDS = "(?:(?:twenty|thirty)[\\s-]+(?:" + "|".join(ORDINALS[:9]) + ")|" + "|".join(sorted((*ORDINALS, "twentieth", "thirtieth"), key=len, reverse=True)) + ")"
MONTH_DAY_YEAR = rf"\b({_MONTH})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})\b"
DAY_OF_MONTH = rf"\b(\d{{1,2}}(?:st|nd|rd|th)?|{_WORDS})\s+day\s+of\s+({_MONTH}),?\s+(?:A\.?\s*D\.?\s+)?(\d{{4}})\b"
NUMERIC = r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b"
ANY_DATE = f"(?i)(?:{MONTH_DAY_YEAR}|{DAY_OF_MONTH}|{NUMERIC})"


def as_date(as_of: Column | date | str) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def bounded(year: Column, as_of: Column | date | str, horizon: int = 1) -> Column:
    """Is the year between 1935 and ``horizon`` years past ``as_of``?"""
    return year.between(F.lit(EARLIEST_YEAR), F.year(as_date(as_of)) + horizon)


def month_number(name: Column) -> Column:
    return F.array_position(F.array(*(F.lit(m[:3]) for m in MONTHS)), F.lower(F.substring(name, 1, 3))).cast("int")


def day_number(token: Column) -> Column:
    """1 to 31 from digits with or without an ending, or from words."""
    digits = F.regexp_extract(token, r"^(\d{1,2})", 1)
    words = F.array_position(F.array(*map(F.lit, DAY_WORDS)), F.regexp_replace(F.lower(token), r"[\s-]+", " "))
    return F.when(digits != "", digits.try_cast("int")).otherwise(F.nullif(words, F.lit(0)).cast("int"))


def date_of(year: Column, month: Column, day: Column) -> Column:
    """A date, or null where there is no such day."""
    return F.try_to_date(F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")


def read_date(raw: Column) -> Column:
    """The day that one match of ANY_DATE names, or null."""
    part = lambda pattern, group: F.regexp_extract(raw, "(?i)" + pattern, group)
    number = lambda c: c.try_cast("int")
    named = date_of(part(MONTH_DAY_YEAR, 3), month_number(part(MONTH_DAY_YEAR, 1)), part(MONTH_DAY_YEAR, 2))
    spelled = date_of(part(DAY_OF_MONTH, 3), month_number(part(DAY_OF_MONTH, 2)), day_number(part(DAY_OF_MONTH, 1)))
    numeric = date_of(part(NUMERIC, 3), number(part(NUMERIC, 1)), number(part(NUMERIC, 2)))
    return F.when(raw.rlike("(?i)day\\s+of"), spelled).when(raw.rlike("^\\d"), numeric).otherwise(named)


def find_dates(text: Column | str, as_of: Column | date | str, horizon: int = 1) -> Column:
    """Every day-precision date inside the window, in the text's order."""
    found = F.transform(spans(text, ANY_DATE), lambda s: F.struct(read_date(s["raw"]).alias("day"), s["raw"].alias("raw"), s["start"].alias("start")))
    kept = F.filter(found, lambda h: h["day"].isNotNull() & bounded(F.year(h["day"]), as_of, horizon))
    return F.transform(kept, lambda h: F.struct(F.date_format(h["day"], "yyyy-MM-dd").alias("iso"), F.lit("day").alias("precision"), F.substring(squash(h["raw"]), 1, 80).alias("raw"), h["start"].alias("start")))


def date_after(text: Column | str, anchors: tuple[str, ...], as_of: Column | date | str, window: int = 400) -> Column:
    """The first date in ``window`` characters behind the last match of an anchor (or, failing that, from its own start); of
    several anchors the hit with the greatest place. A place counts from the anchor's end either way."""
    t = blank(col(text))
    best = F.lit(None).cast("struct<iso:string,precision:string,raw:string,start:int>")
    for anchor in anchors:
        pattern = f"(?i){anchor}"
        parts = F.struct(F.try_element_at(F.split(t, pattern, -1), F.lit(-1)).alias("rest"), F.try_element_at(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.lit(-1)).alias("matched"))

        def near(p: Column) -> Column:
            ahead = F.substring(p["rest"], 1, window)
            behind = F.get(find_dates(ahead, as_of), F.lit(0))
            return F.struct(F.coalesce(behind, F.get(find_dates(F.concat(p["matched"], ahead), as_of), F.lit(0))).alias("hit"), F.length(p["rest"]).alias("left"))

        found = F.when(t.rlike(pattern), let(parts, near))
        moved = let(found, lambda n: F.when(n["hit"].isNotNull(), F.struct(n["hit"]["iso"].alias("iso"), n["hit"]["precision"].alias("precision"), n["hit"]["raw"].alias("raw"), (F.length(t) - n["left"] + n["hit"]["start"]).alias("start"))))
        best = F.when(best.isNull() | (moved["start"] > best["start"]), F.coalesce(moved, best)).otherwise(best)
    return best


def year_only(text: Column | str, as_of: Column | date | str) -> Column:
    """A bare year as a hit of precision year, never a first of January."""
    t = blank(col(text))
    year = F.regexp_extract(t, r"(?U)^\s*(\d{4})\s*$", 1)
    return F.when((year != "") & bounded(year.try_cast("int"), as_of), F.struct(year.alias("iso"), F.lit("year").alias("precision"), strip(t).alias("raw"), F.lit(0).alias("start")))


def month_stamp(text: Column | str) -> Column:
    """"Jul 25 2025" as a date, or null."""
    pattern = r"\b([A-Z][a-z]{2})[a-z]*\.?\s+(\d{1,2}),?\s+(\d{4})\b"
    t = blank(col(text))
    return date_of(F.nullif(F.regexp_extract(t, pattern, 3), F.lit("")), F.nullif(month_number(F.regexp_extract(t, pattern, 1)), F.lit(0)), F.regexp_extract(t, pattern, 2))


def slash_date(text: Column | str, pivot: int) -> Column:
    """M/D/YY or M/D/YYYY as a date; two digits below ``pivot`` are 20yy."""
    pattern = r"(\d{1,2})\s*[/-]\s*(\d{1,2})\s*[/-]\s*(\d{4}|\d{2})(?!\d)"
    t = blank(col(text))
    part = lambda k: F.regexp_extract(t, pattern, k)
    year = part(3).try_cast("int")
    full = F.when(F.length(part(3)) == 2, year + F.when(year < pivot, 2000).otherwise(1900)).otherwise(year)
    return F.when(part(1) != "", date_of(full, part(1), part(2)))


def iso(day: Column) -> Column:
    """A date as text; empty where it is null."""
    return blank(F.date_format(day, "yyyy-MM-dd"))


def compact_date(text: Column | str) -> Column:
    """20240131… or 2024-01-31… as ISO text; empty otherwise."""
    t = blank(col(text))
    digits = F.regexp_extract(t, r"^\s*(\d{4})-?(\d{2})-?(\d{2})", 0)
    return iso(F.try_to_date(F.replace(F.trim(digits), F.lit("-")), "yyyyMMdd"))


def month_as_of(text: Column | str) -> Column:
    """"as of March 2024" as 2024-03-01; empty if there is no such month."""
    pattern = rf"(?i)\b({_MONTH})\s+(?:\d{{1,2}},?\s+)?(\d{{4}})\b"
    t = blank(col(text))
    return iso(date_of(F.nullif(F.regexp_extract(t, pattern, 2), F.lit("")), month_number(F.regexp_extract(t, pattern, 1)), F.lit("1")))


def fiscal_year(text: Column | str) -> Column:
    """FY14, FY 2014 or fy-14 as FY14; empty otherwise."""
    found = F.regexp_extract(blank(col(text)), r"(?i)\bfy[\s_-]*(?:20)?(\d{2})(?!\d)", 1)
    return F.when(found != "", F.concat(F.lit("FY"), found)).otherwise(F.lit(""))
