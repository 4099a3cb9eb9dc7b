"""Ordered operators: numbering, filling, islands, annotation, absorption.

Each takes an explicit order; none relies on the order of files or partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..checkpoints import checkpointed


def _running(part: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def ordered_list(order: Column, value: Column) -> Column:
    """Aggregate: non-null values as an array in the order of a key."""
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))))
    return F.transform(pairs, lambda p: p["v"])


def by_ranges(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The frame in ordered ranges, written once: ``_p`` numbers the range and ``_n`` the row in it, from 0.

    Rows move once. Both numbers come with the written rows, so whatever is
    derived from them fits, however the ranges were drawn.
    """
    written = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    return written.withColumns({"_p": F.shiftright("_at", 33), "_n": F.col("_at").bitwiseAND(F.lit(2**33 - 1))}).drop("_at")


def number_rows(df: DataFrame, order: Sequence[str | Column], part: Sequence[str] = (), name: str = "row_order") -> DataFrame:
    """Number rows from 1 in each partition; over the whole frame by ranges, not in one task."""
    if part:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    ranged = by_ranges(df, order)
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_c"))
    # a row for each range
    before = sizes.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_before"))
    return ranged.join(F.broadcast(before), "_p").withColumn(name, F.col("_before") + F.col("_n") + 1).drop("_p", "_n", "_before")


def forward_fill(df: DataFrame, value: Column, part: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """The last non-null value up to each row."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(_running(part, order)))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> tuple[DataFrame, DataFrame]:
    """The first row of each key, and the rest as a report of duplicates."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank"), ranked.where("_rank > 1").drop("_rank")


def best_candidate(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return keep_first(df, key, order)[0]


def flag_duplicates(df: DataFrame, key: Sequence[str], name: str = "is_duplicate") -> DataFrame:
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*key)) > 1)


def group_islands(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    key: Column,
    is_break: Column,
    is_reaction: Column,
    name: str = "speech_order",
) -> DataFrame:
    """Number the islands of each partition.

    A break row stands alone and ends a segment. Other rows start an island if
    they open a segment or if their key is distinct from the last one in the
    segment. Reactions join the island that is open, whatever their key; one
    that opens a segment lends it its key. A null key never equals another.
    """
    run = _running(part, order)
    df = df.withColumns({"_break": F.coalesce(is_break, F.lit(False)), "_key": key}).withColumn("_react", F.coalesce(is_reaction, F.lit(False)) & ~F.col("_break"))
    df = df.withColumn("_seg", F.sum(F.col("_break").cast("int")).over(run))
    inside = [*part, "_seg", "_break"]
    df = df.withColumn("_pos", F.row_number().over(Window.partitionBy(*inside).orderBy(*order)))
    df = df.withColumn("_eff", F.when(~F.col("_react") | (F.col("_pos") == 1), F.struct(F.col("_key").alias("k"), F.when(F.col("_key").isNull(), F.col("_pos")).alias("own"))))
    prior = Window.partitionBy(*inside).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_prev", F.last("_eff", ignorenulls=True).over(prior))
    start = F.col("_break") | (F.col("_pos") == 1) | (~F.col("_react") & ~F.col("_eff").eqNullSafe(F.col("_prev")))
    return df.withColumn(name, F.sum(start.cast("int")).over(run)).drop("_break", "_key", "_react", "_seg", "_pos", "_eff", "_prev")


def annotate_structure(df: DataFrame, part: Sequence[str], order: Sequence[str], major: Column, continues: Column, subtopic: Column, text: Column) -> DataFrame:
    """Carry topics down: adds level, order, number, title and subtopic columns.

    ``major`` is a struct (number, title) or null. Continuations right after a
    major row extend its title, which the major row and what follows show in
    full and each continuation up to itself. A major row resets the subtopic.
    """
    run = _running(part, order)
    df = df.withColumns({"_m": major, "_c": F.coalesce(continues, F.lit(False)), "_s": subtopic, "_t": text})
    df = df.withColumn("_mseq", F.sum(F.col("_m").isNotNull().cast("int")).over(run))
    inside = _running([*part, "_mseq"], order)
    df = df.withColumn("_brk", F.sum((F.col("_m").isNull() & ~F.col("_c")).cast("int")).over(inside))
    df = df.withColumn("_cont", (F.col("_mseq") > 0) & F.col("_m").isNull() & F.col("_c") & (F.col("_brk") == 0))
    piece = F.when(F.col("_m").isNotNull(), F.col("_m.title")).when(F.col("_cont"), F.col("_t"))
    df = df.withColumn("_piece", piece)
    whole = Window.partitionBy(*part, "_mseq")
    sofar = F.array_join(F.collect_list("_piece").over(inside), " ")
    df = df.withColumn("_sofar", sofar).withColumn("_full", F.max_by("_sofar", F.length("_sofar")).over(whole))
    started = F.col("_mseq") > 0
    return df.withColumns(
        {
            "structure_level": F.when(F.col("_m").isNotNull(), "major_topic").when(F.col("_cont"), "speech").when(F.col("_s").isNotNull(), "subtopic").otherwise("speech"),
            "major_topic_order": F.when(started, F.col("_mseq")).cast("int"),
            "major_topic_number": F.last(F.col("_m.number"), ignorenulls=True).over(inside),
            "major_topic": F.when(started, F.when(F.col("_cont"), F.col("_sofar")).otherwise(F.col("_full"))),
            "subtopic": F.last(F.when(F.col("_m").isNull() & ~F.col("_cont"), F.col("_s")), ignorenulls=True).over(inside),
        }
    ).drop("_m", "_c", "_s", "_t", "_mseq", "_brk", "_cont", "_piece", "_sofar", "_full")


def _last_before(df: DataFrame, value: str, order: str, name: str) -> DataFrame:
    """The last non-null value before each row of the whole frame, carried from range to range."""
    ranged = by_ranges(df, [order])
    own = F.last(value, ignorenulls=True).over(Window.partitionBy("_p").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1))
    ends = ranged.groupBy("_p").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_n"))).alias("_end"))
    # a row for each range
    carried = ends.select("_p", F.last("_end", ignorenulls=True).over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    return ranged.withColumn("_own", own).join(F.broadcast(carried), "_p").withColumn(name, F.coalesce("_own", "_carried")).drop("_p", "_n", "_own", "_carried")


def absorption_status(df: DataFrame, part: Sequence[str], order: str, is_missing: Column, speaker: Column, boundary: Sequence[str], has_marker: Column) -> DataFrame:
    """Target and status of each row without a speaker.

    The target is the nearest earlier row that has one, in the row's part or,
    without parts, in the whole frame. Rows of another boundary or with a
    speaker's marker are blocked, and do not keep later rows from the same
    target.
    """
    df = df.withColumn("_missing", F.coalesce(is_missing, F.lit(False)))
    anchor = ~F.col("_missing") & speaker.isNotNull() & (F.trim(speaker) != "")
    held = F.when(anchor, F.struct(F.col(order).alias("pos"), *[F.col(b).alias(f"b{i}") for i, b in enumerate(boundary)]))
    if part:
        df = df.withColumn("_anchor", F.last(held, ignorenulls=True).over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)))
    else:
        df = _last_before(df.withColumn("_held", held), "_held", order, "_anchor").drop("_held")
    same = F.lit(True)
    for i, b in enumerate(boundary):
        same = same & F.col(b).eqNullSafe(F.col(f"_anchor.b{i}"))
    status = F.when(F.col("_anchor").isNull(), "blocked_no_previous_speaker").when(~same, "blocked_boundary_mismatch").when(F.coalesce(has_marker, F.lit(False)), "blocked_text_starts_with_speaker_marker").otherwise("merged")
    return df.withColumns({"absorb_status": F.when(F.col("_missing"), status), "absorb_target": F.when(F.col("_missing"), F.col("_anchor.pos"))}).drop("_missing", "_anchor")


def absorb(marked: DataFrame, part: Sequence[str], order: str, text: str, row_id: str, sep: str = C.SEPARATOR) -> DataFrame:
    """Move the texts of merged rows to their targets, in order; the rows go."""
    merged = marked.where("absorb_status = 'merged'")
    pieces = merged.groupBy(*part, F.col("absorb_target").alias(order)).agg(
        ordered_list(F.col(order), F.nullif(F.col(text), F.lit(""))).alias("_pieces"),
        F.count("*").alias("absorbed_count"),
        F.array_join(ordered_list(F.col(order), F.nullif(F.col(row_id).cast("string"), F.lit(""))), ";").alias("absorbed_ids"),
    )
    kept = marked.where("absorb_status is null or absorb_status <> 'merged'").join(pieces, [*part, order], "left")
    whole = F.array_join(F.concat(F.filter(F.array(F.col(text)), lambda t: t.isNotNull() & (t != "")), F.coalesce("_pieces", F.array().cast("array<string>"))), sep)
    return kept.withColumns({text: F.when(F.col("_pieces").isNotNull(), whole).otherwise(F.col(text)), "absorbed_count": F.coalesce("absorbed_count", F.lit(0))}).drop("_pieces")


def audit_sample(marked: DataFrame, order: str, limit: int) -> DataFrame:
    """Up to so many rows of the audit, blocked ones first, back in their order."""
    rows = marked.where("absorb_status is not null").orderBy(F.col("absorb_status") == "merged", order).limit(limit)
    return rows.orderBy(order)


def zone(df: DataFrame, part: Sequence[str], order: str, is_start: Column, is_topic: Column, is_end: Column) -> DataFrame:
    """Rows after the first start marker up to the first end marker that follows a topic."""
    before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_started", F.coalesce(F.max(is_start.cast("int")).over(before), F.lit(0)) == 1)
    run = _running(part, [order])
    df = df.withColumn("_topics", F.max((F.col("_started") & is_topic).cast("int")).over(run))
    df = df.withColumn("_ended", F.max((F.col("_started") & is_end & (F.col("_topics") == 1)).cast("int")).over(run))
    return df.where("_started and _ended = 0").drop("_started", "_topics", "_ended")


def look_back(df: DataFrame, part: Sequence[str], order: str, text: str, lines: int, name: str = "context") -> DataFrame:
    """The text of so many lines before each row, and its own."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(-lines, 0)
    return df.withColumn(name, F.array_join(F.collect_list(text).over(w), " "))


def order_violations(df: DataFrame, part: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows whose value is under the one before."""
    return df.withColumn("_before", F.lag(value).over(Window.partitionBy(*part).orderBy(*order))).where(F.col(value) < F.col("_before")).drop("_before")
