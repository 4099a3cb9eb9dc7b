"""Aggregations: counts, collapses, rates, profiles and conservation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import safe_ratio


def value_counts(df: DataFrame, column: str, nulls: bool = True, top: int | None = None) -> DataFrame:
    """Values by how often they occur, the value itself breaking ties."""
    out = (df if nulls else df.where(F.col(column).isNotNull())).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(column))
    return out.limit(top) if top else out


def collapse_periods(df: DataFrame, key: Sequence[str], start: str, end: str, order: str, firsts: Sequence[str] = (), lists: Sequence[str] = ()) -> DataFrame:
    """One row a key: least start, greatest end (null if any is open), first-row fields, distinct lists."""
    open_end = F.bool_or(F.col(end).isNull())
    distinct = lambda c: F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(order, c)))), lambda s: s[c])), ";")
    return df.groupBy(*key).agg(
        F.min(start).alias(start),
        F.when(open_end, None).otherwise(F.max(end)).alias(end),
        *[F.min_by(c, order).alias(c) for c in firsts],
        *[distinct(c).alias(c) for c in lists],
    )


def seniority(df: DataFrame, key: Sequence[str], start: str, end: str, as_of: str) -> DataFrame:
    """Years in office, overlaps counted twice, open ends up to a given day; null if there are no days."""
    days = F.datediff(F.coalesce(F.col(end), F.to_date(F.lit(as_of))), F.col(start))
    return df.groupBy(*key).agg(F.round(F.nullif(F.sum(F.greatest(days, F.lit(0))), F.lit(0)) / 365.25, 2).alias("seniority"))


def priority_pick(values: Column, ranked: Sequence[str], sep: str = ";") -> Column:
    """Aggregate: the value of the highest priority that occurs, else all distinct ones joined."""
    seen = F.collect_set(values)
    first = F.get(F.filter(F.array(*[F.lit(r) for r in ranked]), lambda r: F.array_contains(seen, r)), 0)
    return F.coalesce(first, F.array_join(F.array_sort(seen), sep))


def match_rates(df: DataFrame, matched: Column, eligible: Column) -> DataFrame:
    """Rows, eligible rows, matched and unmatched ones among them, and rates."""
    n, ok = F.count_if(eligible), F.count_if(eligible & matched)
    return df.agg(F.count("*").alias("rows"), n.alias("eligible"), ok.alias("matched"), (n - ok).alias("unmatched"), safe_ratio(ok, n, 6).alias("match_rate"), safe_ratio(n, F.count("*"), 6).alias("eligible_rate"))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls of each column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls")


#: Numbers that one row is spread into at a time.
GAP_STEP = 1_000_000


def missing_numbers(df: DataFrame, part: Sequence[str], number: str) -> DataFrame:
    """Numbers between the least and the greatest of a part that do not occur; work and rows grow with the gaps alone."""
    known = df.select(*part, number).where(F.col(number).isNotNull()).distinct()
    gaps = known.withColumn("_next", F.lead(number).over(Window.partitionBy(*part).orderBy(number))).where(F.col("_next") > F.col(number) + 1)
    lo, hi = F.col(number) + 1, F.col("_next") - 1
    kind = df.schema[number].dataType
    # a long gap in steps, so that no array is long
    steps = gaps.select(*part, hi.alias("_hi"), F.explode(F.sequence(lo, hi, F.lit(GAP_STEP).cast(kind))).alias("_lo"))
    return steps.select(*part, F.explode(F.sequence("_lo", F.least(F.col("_hi"), F.col("_lo") + F.lit(GAP_STEP - 1).cast(kind)))).alias(number))


def conservation(before: DataFrame, after: DataFrame, text: str, absorbed: str, sep_chars: int) -> DataFrame:
    """Rows and characters before and after absorption, separators counted apart."""
    size = F.sum(F.length(F.coalesce(F.col(text), F.lit(""))))
    a = before.agg(F.count("*").alias("rows_before"), size.alias("chars_before"))
    b = after.agg(F.count("*").alias("rows_after"), size.alias("chars_after"), (F.sum(F.col(absorbed)) * sep_chars).alias("separator_chars"))
    return a.join(b).withColumn("conserved", F.col("chars_before") + F.col("separator_chars") == F.col("chars_after"))


def quality_report(df: DataFrame, key: str, day: str, text: str) -> DataFrame:
    """Rows, distinct keys, nulls of key, day and text, and the span of days, in one pass."""
    return df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys"), F.count_if(F.col(key).isNull()).alias("null_keys"), F.count_if(F.col(day).isNull()).alias("null_days"), F.count_if(F.col(text).isNull()).alias("null_texts"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
