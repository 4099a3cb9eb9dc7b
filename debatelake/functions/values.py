"""Ids, dates, intervals and numbers as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _or_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def pa_ids(x: Column) -> Column:
    """Sorted distinct ids PA… in a text."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"PA\d+"), F.lit(0))))


def id_from_url(x: Column) -> Column:
    """The id in a deputy's address, as a path segment or after ``OMC_``; null if there is none."""
    return F.coalesce(_or_null(F.regexp_extract(x, r"/deputes?/(?:fiche/)?(?:OMC_)?(PA\d+)", 1)), _or_null(F.regexp_extract(x, r"OMC_(PA\d+)", 1)))


def id_at_end(x: Column) -> Column:
    return _or_null(F.regexp_extract(x, r"(PA\d+)/?(?:\?.*)?$", 1))


def first_id(links: Column) -> Column:
    """The first id that a list of links yields."""
    return F.get(F.filter(F.transform(links, id_from_url), lambda v: v.isNotNull()), 0)


def fallback_id(number: Column, seed: Column) -> Column:
    """``PA9`` and six digits, from a number or else from the SHA-1 of a seed."""
    hashed = F.conv(F.substring(F.sha1(seed.cast("binary")), 1, 12), 16, 10).cast("long") % 1_000_000
    digits = F.coalesce(_or_null(F.regexp_replace(number.cast("string"), r"\D", "")).try_cast("long"), hashed)
    return F.format_string("PA9%06d", digits)


def iso_date(x: Column) -> Column:
    """A date in full ISO form; null for anything else."""
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(x, "yyyy-MM-dd"))


def mixed_date(x: Column) -> Column:
    """ISO first, then day-month-year with dashes or slashes, one digit or two."""
    t = F.trim(x)
    iso = F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.try_to_date(F.regexp_extract(t, r"^(\d{4}-\d{1,2}-\d{1,2})", 1), "yyyy-M-d"))
    dmy = F.when(t.rlike(r"^\d{1,2}[-/]\d{1,2}[-/]\d{4}"), F.try_to_date(F.translate(F.regexp_extract(t, r"^(\d{1,2}[-/]\d{1,2}[-/]\d{4})", 1), "/", "-"), "d-M-yyyy"))
    return F.coalesce(iso, dmy)


def french_date(x: Column) -> Column:
    """A date like ``1er août 1951``; null if there is none."""
    month = F.create_map(*[F.lit(v) for pair in C.MONTHS.items() for v in pair])
    pattern = r"(?iu)(\d{1,2})(?:er)?\s+([\p{L}]+)\s+(\d{4})"
    m = F.try_element_at(month, F.lower(F.regexp_extract(x, pattern, 2)))
    return F.try_to_date(F.concat_ws("-", F.regexp_extract(x, pattern, 3), m.cast("string"), F.regexp_extract(x, pattern, 1)), "yyyy-M-d")


def period(x: Column) -> Column:
    """Struct (start, end) of ``du … au …`` or ``depuis le …``."""
    closed = r"(?iu)du\s+(.+?)\s+au\s+(.+)$"
    return F.struct(
        F.coalesce(french_date(F.regexp_extract(x, closed, 1)), french_date(F.regexp_extract(x, r"(?iu)depuis\s+le\s+(.+)$", 1))).alias("start"),
        french_date(F.regexp_extract(x, closed, 2)).alias("end"),
    )


def term_number(x: Column) -> Column:
    """The term before ``législature``, in Roman or Arabic numerals."""
    found = F.upper(F.regexp_extract(x, r"(?iu)\b([XVI]+|\d{1,2})\s*(?:e|ème|eme)?\s+l[ée]gislature", 1))
    roman = F.create_map(*[F.lit(v) for pair in C.ROMAN_TERMS.items() for v in pair])
    return F.coalesce(found.try_cast("int"), F.try_element_at(roman, found))


def day_month_year(x: Column) -> Column:
    """ISO text as day-month-year; what has not three parts stays."""
    return F.regexp_replace(x, r"^([^-]*)-([^-]*)-([^-]*)$", "$3-$2-$1")


def date_in_name(x: Column) -> Column:
    """The eight digits of a name that no digit touches, as a date."""
    return F.try_to_date(_or_null(F.regexp_extract(x, r"(?<!\d)(\d{8})(?!\d)", 1)), "yyyyMMdd")


def contains(start: Column, end: Column, day: Column) -> Column:
    """Whether a day lies in an interval, ends included, with a null end open."""
    return (start <= day) & (F.coalesce(end, F.to_date(F.lit("9999-12-31"))) >= day)


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Whether two intervals, ends included, share a day; null starts and ends are open."""
    low, high = F.to_date(F.lit("0001-01-01")), F.to_date(F.lit("9999-12-31"))
    return (F.coalesce(s1, low) <= F.coalesce(e2, high)) & (F.coalesce(s2, low) <= F.coalesce(e1, high))


def safe_ratio(a: Column, b: Column, digits: int | None = None) -> Column:
    out = F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return out if digits is None else F.round(out, digits)


def birth_place(*parts: Column) -> Column:
    return F.concat_ws(", ", *[_or_null(F.trim(p)) for p in parts])


def constituency(department: Column, number: Column) -> Column:
    """``department (number)``, or what there is of it."""
    return F.when(department.isNotNull() & number.isNotNull(), F.concat(department, F.lit(" ("), number, F.lit(")"))).otherwise(F.coalesce(department, number, F.lit("")))


def profile_url(mp_id: Column, base: str) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), mp_id)


def years(spec: Column) -> Column:
    """Sorted years of a list such as ``2011-2013,2020``; a reversed range is an error."""
    part = lambda p: F.struct(F.element_at(F.split(F.trim(p), "-"), 1).cast("int").alias("lo"), F.element_at(F.split(F.trim(p), "-"), -1).cast("int").alias("hi"))
    span = lambda r: F.when(r["lo"] <= r["hi"], F.sequence(r["lo"], r["hi"], F.lit(1))).otherwise(F.raise_error(F.lit("reversed year range")).cast("array<int>"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.transform(F.split(spec, ","), part), span))))
