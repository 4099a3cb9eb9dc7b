"""Binding of speakers to politicians in time, and absorption of rows without one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as X
from ..functions import values as V
from ..functions.folding import name_ratio, unicode_key
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as W


def people(politician: DataFrame, mandate: DataFrame) -> DataFrame:
    """Mandates with their holder's key and last token."""
    key = X.person_key(unicode_key(F.concat_ws(" ", "first_name", "last_name")))
    named = politician.select("mp_id", key.alias("person_key"))
    spans = mandate.where("mandate_start is not null").select("mp_id", "mandate_start", "mandate_end")
    return spans.join(J.small(named), "mp_id").distinct().withColumn("block", X.last_token(F.col("person_key")))


def bind(speeches: DataFrame, politician: DataFrame, mandate: DataFrame, aliases: dict[str, str] | None = None, row_id: str = "row_id", fallbacks: bool = True, fuzzy_least: float = C.FUZZY_LEAST, link_least: float = C.LINK_LEAST) -> DataFrame:
    """Add mp_id, bind_status, bind_method and bind_score by a cascade of seven stages.

    Distinct (speaker, link, day) triples are bound once and joined back, so
    the fuzzy stage sees each name and day once however often they occur.
    Ties go to the greater score, the later start, the later end, the lesser id.
    Without a column of links, or of source files, that stage or date is left out.
    """
    text = lambda *names: next((F.col(c).cast("string") for c in names if c in speeches.columns), F.lit(None).cast("string"))
    named = V.date_in_name(text("source_files"))
    day = F.coalesce(V.mixed_date(text("date")), named)
    source = F.when(V.mixed_date(text("date")).isNotNull(), "date").when(named.isNotNull(), "source_file").otherwise("missing")
    rows = speeches.withColumns({"bind_date": day, "bind_date_source": source, "_key": X.person_key(unicode_key(F.col("speaker"))), "_link": F.coalesce(text("link_speaker", "speaker_link"), F.lit(""))})
    chair = F.col("_key").isin(*C.CHAIR_KEYS)
    status = F.when(chair, "president").when(F.col("bind_date").isNull(), "missing_date").when(F.col("_key") == "", "missing_speaker").otherwise("unmatched")
    rows = rows.withColumn("_initial", status)
    asks = rows.where("_initial = 'unmatched'").select("_key", "_link", "bind_date").distinct()
    asks = asks.withColumn("ask", F.xxhash64("_key", "_link", "bind_date")).withColumns({"block": X.last_token(F.col("_key")), "_ids": V.pa_ids(F.col("_link"))})
    held = people(politician, mandate)
    active = V.contains(F.col("mandate_start"), F.col("mandate_end"), F.col("bind_date"))
    keep = ["ask", "mp_id", "mandate_start", "mandate_end", "score"]
    linked = asks.select("ask", "_key", "bind_date", F.explode("_ids").alias("mp_id")).join(J.small(held), "mp_id").withColumn("score", name_ratio("_key", "person_key")).where(F.col("score") >= link_least)
    spark = speeches.sparkSession
    table = spark.createDataFrame([(k, v) for k, v in (aliases or {}).items()] or [("", "")], "alias string, mp_id string").select(X.person_key(unicode_key(F.col("alias"))).alias("_key"), "mp_id").where("_key <> ''").dropDuplicates(["_key"])
    aliased = asks.select("ask", "_key", "bind_date").join(F.broadcast(table), "_key").join(J.small(held), "mp_id").withColumn("score", F.lit(1.0))
    exact = asks.select("ask", "_key", "bind_date").join(J.small(held), F.col("_key") == F.col("person_key")).withColumn("score", F.lit(1.0))
    fuzzy = J.blocked_fuzzy(asks.select("ask", "_key", "bind_date", "block"), held, "block", "_key", "person_key", fuzzy_least, V.contains(F.col("b.mandate_start"), F.col("b.mandate_end"), F.col("a.bind_date")))
    unique = held.groupBy("person_key").agg(F.min("mp_id").alias("mp_id"), F.countDistinct("mp_id").alias("n"), F.max("mandate_start").alias("mandate_start"), F.max("mandate_end").alias("mandate_end")).where("n = 1")
    alone = asks.select("ask", "_key").join(J.small(unique), F.col("_key") == F.col("person_key")).withColumn("score", F.lit(1.0))
    stages = [("link_name_mandate", linked.where(active).select(*keep)), ("manual_alias_mandate", aliased.where(active).select(*keep)), ("name_exact_mandate", exact.where(active).select(*keep)), ("name_fuzzy_mandate", fuzzy.select(*keep))]
    if fallbacks:
        stages += [("link_name_no_active_mandate", linked.select(*keep)), ("manual_alias_no_active_mandate", aliased.select(*keep)), ("name_exact_no_active_mandate", alone.select(*keep))]
    best = J.cascade(asks.select("ask", "_key", "_link", "bind_date"), "ask", stages, [F.desc("score"), F.desc_nulls_last("mandate_start"), F.desc_nulls_first("mandate_end"), F.asc("mp_id")])
    out = rows.join(best.select("_key", "_link", "bind_date", "mp_id", "method", "score"), ["_key", "_link", "bind_date"], "left")
    hit = (F.col("_initial") == "unmatched") & F.col("mp_id").isNotNull()
    state = F.when(~hit, F.col("_initial")).when(F.col("method").endswith("no_active_mandate"), "matched_no_active_mandate").otherwise("matched")
    return out.withColumns({"bind_status": state, "mp_id": F.when(hit, F.col("mp_id")), "bind_method": F.when(hit, F.col("method")), "bind_score": F.when(hit, F.col("score"))}).drop("_key", "_link", "_initial", "method", "score")


def party_lookup(party: DataFrame, order: str = "party_id", legacy: dict[str, str] | None = None) -> DataFrame:
    """Rows (label_key, party_id, acronym, name): every label of each party by its key.

    Labels are the id, the acronym, the name, the listed groups and the
    aliases in interjections. Of parties that share a key the first by
    ``order`` wins, and a legacy label goes to the party of its target.
    """
    legacy = C.SPEECH_PARTY_ALIASES if legacy is None else legacy
    known = party.where(X.non_empty(F.col("party_id")))
    text = lambda c: F.col(c) if c in party.columns else F.lit(None).cast("string")
    labels = F.concat(F.array("party_id", text("acronym"), text("name")), X.parse_list(text("source_political_groups")), X.parse_list(text("interjection_aliases")))
    record = F.struct(F.col(order).alias("_o"), "party_id", text("acronym").alias("acronym"), text("name").alias("name"))
    keyed = known.select(F.explode(labels).alias("_label"), record.alias("r")).select(unicode_key(F.col("_label")).alias("label_key"), "r").where("label_key <> ''")
    first = keyed.groupBy("label_key").agg(F.min("r").alias("r")).select("label_key", "r.party_id", "r.acronym", "r.name")
    if not legacy:
        return first
    pairs = party.sparkSession.createDataFrame(list(legacy.items()), "old string, target string").select(unicode_key(F.col("old")).alias("old"), unicode_key(F.col("target")).alias("label_key"))
    moved = first.join(F.broadcast(pairs), "label_key").select(F.col("old").alias("label_key"), "party_id", "acronym", "name")
    return moved.unionByName(first.join(F.broadcast(pairs.join(first, "label_key").select(F.col("old").alias("label_key"))), "label_key", "left_anti"))


def bind_parties(rows: DataFrame, party: DataFrame, group: str = "parliamentary_group", label: str = "party", order: str = "party_id", legacy: dict[str, str] | None = None) -> DataFrame:
    """Add the party by the group's label, or without one by the party's, and how it was found."""
    text = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    by_group, by_party = X.non_empty(text(group)), X.non_empty(text(label))
    source = F.when(by_group, F.lit(group)).when(by_party, F.lit(label))
    asked = rows.withColumns({"party_source_label": F.when(by_group, text(group)).when(by_party, text(label)), "party_source_column": source})
    found = party_lookup(party, order, legacy).select("label_key", F.col("party_id").alias("_id"), F.col("acronym").alias("party_acronym"), F.col("name").alias("party_name"))
    out = asked.withColumn("label_key", unicode_key(F.col("party_source_label"))).join(J.small(found), "label_key", "left").drop("label_key")
    status = F.when(F.col("_id").isNotNull(), "matched").when(F.col("party_source_label").isNull(), "missing_source").otherwise("unmatched")
    return out.withColumns({"party_bind_status": status, "party_id": F.col("_id")}).drop("_id")


def bind_simple(rows: DataFrame, party: DataFrame, politician: DataFrame, order: str = "mp_id") -> DataFrame:
    """Party by group and then party label, politician by full name alone; the first of a key wins."""
    named = politician.select(unicode_key(F.concat_ws(" ", "first_name", "last_name")).alias("_k"), F.col(order).alias("_o"), F.col("mp_id").alias("_mp"))
    named = named.where("_k <> ''").groupBy("_k").agg(F.min_by("_mp", F.struct("_o", "_mp")).alias("mp_id"))
    rows = bind_parties(rows, party)
    return rows.withColumn("_k", X.person_key(unicode_key(F.col("speaker")))).join(J.small(named), "_k", "left").drop("_k")


def of_sittings(rows: DataFrame, sittings: DataFrame, key: list[str]) -> DataFrame:
    """The rows of the named sittings, such as dates and session numbers."""
    return rows.join(J.small(sittings.select(*key).distinct()), key, "left_semi")


def unresolved(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose id no reference has; a missing id is one of them."""
    return J.orphans(rows, known, key, key)


def bind_report(rows: DataFrame, status: str, label: str, top: int = 20) -> tuple[DataFrame, DataFrame]:
    """Counts by status, and the most frequent unmatched labels."""
    return A.value_counts(rows, status), A.value_counts(rows.where(F.col(status) == "unmatched"), label, top=top)


def absorb_missing(rows: DataFrame, order: str, boundary: list[str], text: str, part: list[str] | None = None, sample: int = 1000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Absorbed rows, their audit and the conservation report; without parts the whole frame is one, in ranges."""
    part = part or []
    marked = W.absorption_status(rows, part, order, F.col("bind_status") == "missing_speaker", F.col("speaker"), boundary, X.has_speaker_marker(F.col(text)))
    after = W.absorb(marked, part, order, text, "id")
    return after, W.audit_sample(marked, order, sample), A.conservation(rows, after, text, "absorbed_count", len(C.SEPARATOR))
