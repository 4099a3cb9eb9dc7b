"""Debates: XML to documents, documents to paragraphs, speeches, the final table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as X
from ..functions import values as V
from ..operators import joins as J
from ..operators import windows as W
from ..sources.debate_xml import parse_debates


def documents(files: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """One document a readable XML file, with its sources: the file itself, after its companion if the listing of paths has one."""
    docs = parse_debates(files).where("not failed").drop("failed")
    name = lambda path: F.element_at(F.split(path, "/"), -1)
    if listing is None:
        return docs.withColumn("source_files", F.array(name("path")))
    there = listing.select(F.col("path").alias("_companion")).distinct()
    docs = docs.withColumn("_asked", F.regexp_replace("path", r"CRI_([^/]*)$", "AAA_$1")).join(J.small(there), F.col("_asked") == F.col("_companion"), "left")
    known = F.col("_companion").isNotNull() & (F.col("_companion") != F.col("path"))
    return docs.withColumn("source_files", F.when(known, F.array(name("_companion"), name("path"))).otherwise(F.array(name("path")))).drop("_asked", "_companion")


def conversion_counts(files: DataFrame) -> DataFrame:
    return parse_debates(files).groupBy(F.when(F.col("failed"), "failed").otherwise("processed").alias("status")).agg(F.count("*").alias("n"))


def flatten(docs: DataFrame) -> DataFrame:
    """One row a paragraph, fifteen text columns, several speakers joined."""
    p = docs.select("source_files", "dateSeance", "numSeance", F.posexplode("Para").alias("pos", "p"))
    of = lambda field: X.join_values(F.transform("p.Orateur", lambda o: o[field]))
    attribute = lambda name: X.join_values(F.transform("p.Orateur", lambda o: F.try_element_at(o["attributes"], F.lit(name))))
    cells = {
        "source_files": X.join_values(F.col("source_files")), "id": F.col("p.Ident"), "date": V.day_month_year(F.col("dateSeance")),
        "text_speech_brut": F.col("p.Para"), "text_speech_clean": F.col("p.Para_clean"), "topic": F.col("p.section"),
        "subtopic1": F.col("p.sous_section_1"), "subtopic2": F.col("p.sous_section_2"), "speaker": of("Nom"), "link_speaker": attribute("href"),
        "role": of("role"), "gender": of("gender"), "speech_interjection": F.lit(""), "quote": F.lit(""), "numSeance": F.col("numSeance"),
    }
    return p.select(*[F.coalesce(cells[c], F.lit("")).alias(c) for c in C.FLAT_COLUMNS], "pos")


def build_speeches(rows: DataFrame, procedure_levels: tuple[str, ...] = ("major_topic", "subtopic")) -> DataFrame:
    """Grouped speeches of scanned rows, by sitting: annotated, then gathered into islands.

    Expects date, session, row_order, id, speaker, role, interjection and text.
    """
    part, order = ["date", "session"], ["row_order"]
    rows = W.annotate_structure(rows, part, order, X.match_major_topic(F.col("text")), X.is_continuation(F.col("text")), X.match_subtopic(F.col("text")), X.strip_wrappers(F.col("text")))
    speaker = F.nullif(F.trim("speaker"), F.lit(""))
    proc = F.col("structure_level").isin(*procedure_levels)
    react = F.coalesce(F.col("interjection"), F.lit(False)) & X.is_reaction(F.col("text")) & ~proc
    key = F.when(speaker.isNotNull(), F.struct(speaker.alias("s"), F.col("role").alias("r")))
    rows = W.group_islands(rows.withColumns({"_procedure": proc, "_reaction": react}), part, order, key, F.col("_procedure"), F.col("_reaction"))
    clean = F.nullif(X.strip_wrappers(F.col("text")), F.lit(""))
    ordered = lambda value: W.ordered_list(F.col("row_order"), value)
    title = F.when(F.col("structure_level") == "major_topic", F.col("major_topic")).otherwise(clean)
    spoken = F.when(F.col("_procedure"), title).when(~F.col("_reaction"), clean)
    first = [F.min_by(c, "row_order").alias(c) for c in rows.columns if c not in (*part, "speech_order", "row_order", "id", "text", "interjection", "_procedure", "_reaction", "major_topic_order", "major_topic_number", "major_topic", "subtopic")]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("row_order"))).alias(c) for c in ("major_topic_order", "major_topic_number", "major_topic", "subtopic")]
    return rows.groupBy(*part, "speech_order").agg(
        F.when(F.bool_or("_procedure"), "procedure").otherwise("speech").alias("row_type"),
        F.min("row_order").alias("first_row_order"),
        F.max("row_order").alias("last_row_order"),
        ordered(F.col("row_order")).alias("source_row_orders"),
        ordered(F.col("id")).alias("source_ids"),
        F.array_join(ordered(spoken), " ").alias("speech_text"),
        ordered(F.when(F.col("_reaction"), clean)).alias("interjections"),
        *first,
        *last,
    )


def structure_listing(annotated: DataFrame, part: list[str], order: str) -> DataFrame:
    """Distinct topics of a sitting in order of appearance."""
    rows = annotated.where(F.col("structure_level").isin("major_topic", "subtopic"))
    return W.best_candidate(rows, [*part, "structure_level", "major_topic_order", "subtopic"], [F.col(order)]).orderBy(*part, order)


def final_table(recent: DataFrame, historical: DataFrame, presidency: DataFrame, terms=C.TERMS, country_id: int = 3) -> DataFrame:
    """Both sources as one numbered table of seven columns.

    Each has speech_text, speech_interjection, speech_date, speaker, speaker_id,
    row_order; the recent one also source_files, the historical one row_type.
    """
    chair = X.is_chair(F.col("speaker"))
    known = X.non_empty(F.col("speaker_id"))
    day = F.coalesce("speech_date", V.date_in_name(F.col("source_files")))
    recent = recent.withColumn("speech_date", day).where(F.col("speech_date").isNotNull() & X.non_empty(F.col("speaker")) & (known | chair))
    historical = historical.where((F.col("row_type") == "speech") & F.year("speech_date").between(1998, 2010))
    names = ["speech_text", "speech_interjection", "speech_date", "speaker", "speaker_id", "row_order"]
    both = historical.select(*names, F.lit(0).alias("dataset")).unionByName(recent.select(*names, F.lit(1).alias("dataset")))
    both = both.withColumn("speaker_id", F.nullif(F.trim("speaker_id"), F.lit("")))
    offices = presidency.select(F.col("mp_id").alias("office_id"), "start_date", "end_date")
    both = J.fill_from_intervals(both, offices, "speaker_id", "speech_date", "office_id", "start_date", "end_date", chair)
    both = both.withColumn("term", term_of(terms)).where("speaker_id is not null and speech_text is not null")
    numbered = W.number_rows(both, ["speech_date", "dataset", "row_order"], name="speech_id")
    return numbered.select("speech_id", "speech_text", "speech_interjection", "speech_date", "speaker_id", F.lit(country_id).alias("country_id"), "term")


def term_of(terms):
    return J.interval_label(F.col("speech_date"), terms, last=True).cast("int")


def gate(final: DataFrame, block: int = 1_000_000) -> DataFrame:
    """What keeps the final table from passing: one row of counts, all 0 in a good one.

    Order is checked in blocks of ids side by side, and then from each block to the next.
    """
    blocks = final.withColumn("_block", F.floor(F.col("speech_id") / block))
    checked = blocks.withColumn("_before", F.lag("speech_date").over(Window.partitionBy("_block").orderBy("speech_id")))
    sums = checked.groupBy("_block").agg(
        (F.count("*") - F.countDistinct("speech_id")).alias("repeated"), F.count_if(F.col("speaker_id").isNull()).alias("speakers"), F.count_if(F.col("term").isNull()).alias("terms"),
        F.count_if(F.col("speech_date") < F.col("_before")).alias("faults"), F.min_by("speech_date", "speech_id").alias("first"), F.max_by("speech_date", "speech_id").alias("last"),
    )
    sums = sums.withColumn("across", (F.col("first") < F.lag("last").over(Window.orderBy("_block"))).cast("long"))
    total = lambda *names: sum((F.coalesce(F.sum(n), F.lit(0)) for n in names), F.lit(0)).cast("long")
    return sums.agg(total("repeated").alias("repeated_ids"), total("speakers").alias("null_speakers"), total("terms").alias("null_terms"), total("faults", "across").alias("out_of_order"))
