"""Deputies and mandates: from actor documents, directory pages and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .. import schemas
from ..functions import text as X
from ..functions import values as V
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as W
from ..sources.html_pages import directory_id
from ..sources.readers import as_list, scalar


def actors(docs: DataFrame) -> DataFrame:
    """Politicians from actor documents (a variant column ``doc``)."""
    d = F.col("doc")
    return docs.select(
        scalar(d, "$.uid").alias("mp_id"),
        scalar(d, "$.etatCivil.ident.prenom").alias("first_name"),
        scalar(d, "$.etatCivil.ident.nom").alias("last_name"),
        V.iso_date(scalar(d, "$.etatCivil.infoNaissance.dateNais")).alias("birth_date"),
        V.birth_place(scalar(d, "$.etatCivil.infoNaissance.villeNais"), scalar(d, "$.etatCivil.infoNaissance.depNais"), scalar(d, "$.etatCivil.infoNaissance.paysNais")).alias("birth_place"),
        scalar(d, "$.profession.libelleCourant").alias("profession"),
    )


def actor_mandates(docs: DataFrame) -> DataFrame:
    """One row a mandate of any kind."""
    m = docs.select(scalar(F.col("doc"), "$.uid").alias("mp_id"), F.explode(as_list(F.col("doc"), "$.mandats.mandat")).alias("m"))
    c = F.col("m")
    return m.select(
        "mp_id", scalar(c, "$.uid").alias("uid"), scalar(c, "$.typeOrgane").alias("kind"), scalar(c, "$.legislature").alias("term"),
        F.coalesce(V.iso_date(scalar(c, "$.mandature.datePriseFonction")), V.iso_date(scalar(c, "$.dateDebut"))).alias("mandate_start"), V.iso_date(scalar(c, "$.dateFin")).alias("mandate_end"), V.iso_date(scalar(c, "$.dateDebut")).alias("election_date"),
        F.get(as_list(c, "$.organes.organeRef", "string"), 0).alias("organ"),
        V.constituency(scalar(c, "$.election.lieu.departement"), scalar(c, "$.election.lieu.numCirco")).alias("constituency"),
    )


def politicians(docs: DataFrame, as_of: str, country_id: int = 3) -> DataFrame:
    """The politician table of actor documents: persons with years in office and status; what no document has is null."""
    m = actor_mandates(docs)
    took = A.seniority(m.where("kind = 'ASSEMBLEE' and mandate_start is not null"), ["mp_id"], "mandate_start", "mandate_end", as_of)
    status = m.where(X.non_empty(F.col("kind"))).groupBy("mp_id").agg(A.priority_pick(F.col("kind"), C.STATUS_KINDS).alias("status"))
    rows = actors(docs).join(took, "mp_id", "left").join(status, "mp_id", "left").withColumn("country_id", F.lit(country_id))
    return schemas.project(rows, schemas.POLITICIAN)


def organ_labels(organs: DataFrame) -> DataFrame:
    """Label of an organ, by the first of four fields that has one, else its id."""
    d = F.col("doc")
    names = [F.nullif(scalar(d, f"$.{n}"), F.lit("")) for n in ("libelle", "libelleEdition", "libelleAbrege", "libelleAbrev")]
    return organs.select(scalar(d, "$.uid").alias("organ"), F.coalesce(*names, scalar(d, "$.uid")).alias("label"))


def term_mandates(mandates: DataFrame, organs: DataFrame) -> DataFrame:
    """Seats by person and term, with the clubs and committees that overlap them in the same term."""
    named = mandates.join(J.small(organs), "organ", "left")
    seats = A.collapse_periods(named.where("kind = 'ASSEMBLEE'"), ["mp_id", "term"], "mandate_start", "mandate_end", "uid", lists=["constituency"])
    for kind, name in (("GP", "club"), ("COMPER", "committees")):
        other = named.where(F.col("kind") == kind).select("mp_id", F.col("term").alias("_t"), F.col("mandate_start").alias("_s"), F.col("mandate_end").alias("_e"), "label")
        near = (seats["mp_id"] == other["mp_id"]) & (F.col("_t").isNull() | (F.col("_t") == seats["term"])) & V.overlap(seats["mandate_start"], seats["mandate_end"], F.col("_s"), F.col("_e"))
        found = seats.join(other, near).groupBy(seats["mp_id"], seats["term"]).agg(F.array_join(F.array_distinct(W.ordered_list(F.col("_s"), F.col("label"))), ";").alias(name))
        seats = seats.join(found, ["mp_id", "term"], "left")
    return seats.orderBy("mp_id", "term", "mandate_start")


def party_ids(club: Column, labels: dict[str, str]) -> Column:
    """Party ids of a ``;`` list of clubs, the weak one dropped; unknown if no club is known."""
    table = F.create_map(*[F.lit(v) for pair in labels.items() for v in pair])
    found = F.array_distinct(F.filter(F.transform(F.split(club, ";"), lambda c: F.try_element_at(table, X.label_key(c))), lambda v: v.isNotNull()))
    return F.when(~X.non_empty(club), "").when(F.size(found) == 0, C.UNKNOWN_PARTY).otherwise(F.array_join(X.drop_weak(found), ";"))


def final_clubs(club: Column) -> Column:
    """A ``;`` list of distinct clubs, without those that stand for none if there is another."""
    all_ = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(club, F.lit("")), ";"), F.trim), lambda c: c != ""))
    strong = F.filter(all_, lambda c: ~X.label_key(c).isin(*C.WEAK_CLUBS))
    return F.array_join(F.when(F.size(strong) > 0, strong).otherwise(all_), ";")


def relabel(mandate: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Final clubs, and the party of a club where a mandate has none or an unknown one."""
    party, mapped = F.coalesce("party_id", F.lit("")), party_ids(F.col("club"), labels)
    asks = party.isin("", C.UNKNOWN_PARTY) & (mapped != "")
    return mandate.withColumn("club", final_clubs(F.col("club"))).withColumn("party_id", F.when(asks, mapped).otherwise(F.col("party_id")))


def mandate_rows(docs: DataFrame, organs: DataFrame, labels: dict[str, str], profile: str, country_id: int = 3) -> DataFrame:
    """The mandate table of actor documents: a row a person and term, with party, clubs, committees and source."""
    m = actor_mandates(docs)
    dates = m.where("kind = 'ASSEMBLEE'").groupBy("mp_id", "term").agg(F.min("election_date").alias("election_date"))
    rows = term_mandates(m, organs).join(dates, ["mp_id", "term"], "left").withColumn("club", final_clubs(F.col("club")))
    party = party_ids(F.col("club"), labels)
    rows = rows.withColumns({"party_id": F.when(party == "", C.UNKNOWN_PARTY).otherwise(party), "source_url": V.profile_url(F.col("mp_id"), profile), "country_id": F.lit(country_id)})
    return schemas.project(rows, schemas.MANDATE)


def birth_line(lines: Column) -> Column:
    """Struct (birth_date, birth_place) of the first line like ``Né le 3 mai 1951 à Lyon``."""
    said = r"\bN[ée]e?\s+le\s+(.+?)(?:\s+à\s+(.+))?$"
    line = F.get(F.filter(lines, lambda x: x.rlike(said)), 0)
    return F.struct(V.french_date(F.regexp_extract(line, said, 1)).alias("birth_date"), F.nullif(F.trim(F.regexp_extract(line, said, 2)), F.lit("")).alias("birth_place"))


def directory_links(pages: DataFrame, page: str, links: str, base: str) -> DataFrame:
    """Distinct (sycomore_id, url, name) of the deputies that listing pages link to, the first link of each id."""
    found = pages.select(F.col(page).alias("_page"), F.posexplode(links).alias("_pos", "l")).where(F.col("l.href").contains(C.DIRECTORY_PATH) & X.non_empty(F.col("l.label")))
    href = F.col("l.href")
    url = F.when(href.rlike("^https?://"), href).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(href, "^/+", "")))
    rows = found.select("_page", "_pos", url.alias("url"), F.trim("l.label").alias("name")).withColumn("sycomore_id", directory_id(F.col("url"))).where("sycomore_id is not null")
    return W.keep_first(rows, ["sycomore_id"], ["_page", "_pos"])[0].select("sycomore_id", "url", "name")


def distinct_ids(people: DataFrame, known: DataFrame, generated: str = "_generated", order: str = "url") -> DataFrame:
    """The generated ids, with three more digits where an id is taken: by a known person or by one earlier in order."""
    taken = known.select(F.regexp_extract("mp_id", r"^(PA9\d{6})(\d{3})?$", 1).alias(generated), F.regexp_extract("mp_id", r"^PA9\d{6}(\d{3})?$", 1).alias("_end")).where(F.col(generated) != "")
    taken = taken.groupBy(generated).agg(F.max(F.when(F.col("_end") == "", 0).otherwise(F.col("_end").cast("int"))).alias("_last"))
    rank = F.row_number().over(Window.partitionBy(generated).orderBy(order))
    numbered = people.join(J.small(taken), generated, "left").withColumn("_nth", F.coalesce(F.col("_last"), F.lit(-1)) + rank)
    return numbered.withColumn(generated, F.when(F.col("_nth") == 0, F.col(generated)).otherwise(F.concat(generated, F.format_string("%03d", "_nth")))).drop("_last", "_nth")


def match_people(scraped: DataFrame, known: DataFrame, order: str = "mp_id") -> DataFrame:
    """``matched_id`` by name and birth date, the first in order, else by a name that only one id has."""
    keyed = known.select(X.name_key(F.concat_ws(" ", "first_name", "last_name")).alias("_k"), "birth_date", "mp_id", F.col(order).alias("_o")).where("_k <> ''")
    dated = keyed.where("birth_date is not null").groupBy("_k", "birth_date").agg(F.min_by("mp_id", F.struct("_o", "mp_id")).alias("_by_date"))
    unique = keyed.groupBy("_k").agg(F.countDistinct("mp_id").alias("_n"), F.min("mp_id").alias("_by_name")).where("_n = 1").drop("_n")
    rows = scraped.withColumn("_k", X.name_key(F.col("full_name")))
    return rows.join(J.small(dated), ["_k", "birth_date"], "left").join(J.small(unique), "_k", "left").withColumn("matched_id", F.coalesce("_by_date", "_by_name")).drop("_k", "_by_date", "_by_name")


def augment(politician: DataFrame, mandate: DataFrame, scraped: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Both tables with a directory's people and mandates, and reports of what is new.

    An id is the page's own, else the matched one if it has the shape, else
    generated. A matched id that differs from the page's moves to it in both tables.
    """
    people = match_people(scraped, politician)
    shaped = F.when(F.col("matched_id").rlike(r"^PA\d+$"), F.col("matched_id"))
    people = people.withColumn("_given", F.coalesce(F.nullif("pa_id", F.lit("")), shaped)).withColumn("_generated", F.when(F.col("_given").isNull(), V.fallback_id(F.col("sycomore_id"), F.col("sycomore_id"))))
    alone = distinct_ids(people.where("_given is null"), politician)
    people = people.where("_given is not null").unionByName(alone).withColumn("mp_id", F.coalesce("_given", "_generated"))
    moves = people.where("matched_id is not null and matched_id <> mp_id").select(F.col("matched_id").alias("old"), F.col("mp_id").alias("new")).dropDuplicates(["old"])

    def migrate(df):
        return df.join(J.small(moves), F.col("mp_id") == F.col("old"), "left").withColumn("mp_id", F.coalesce("new", "mp_id")).drop("old", "new")

    politician, mandate = migrate(politician), migrate(mandate)
    name = X.split_name(F.col("full_name"))
    persons = people.select("mp_id", name["first_name"].alias("first_name"), name["last_name"].alias("last_name"), "birth_date", "birth_place", "url")
    new_people = W.keep_first(persons.join(politician.select("mp_id"), "mp_id", "left_anti"), ["mp_id"], ["url"])[0]
    offered = people.select("mp_id", "url", F.explode("mandates").alias("m")).select("mp_id", "m.term", F.col("m.start").alias("mandate_start"), F.col("m.end").alias("mandate_end"), "m.constituency", "m.club", F.col("url").alias("source_url"))
    new_mandates = W.keep_first(offered.join(mandate.select("mp_id", "term"), ["mp_id", "term"], "left_anti"), ["mp_id", "term"], ["mandate_start", "source_url"])[0]
    reports = {"new_people": new_people, "new_mandates": new_mandates, "fallback_ids": people.where("matched_id is null and mp_id = _generated").select("mp_id", "sycomore_id", F.col("full_name").alias("name"), F.col("url").alias("source_url"))}
    return politician.unionByName(new_people.drop("url"), allowMissingColumns=True), mandate.unionByName(new_mandates, allowMissingColumns=True), reports


def without_duplicates(politician: DataFrame, mandate: DataFrame, order: str) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """The first row of each key in order, and reports of the rest."""
    people, again = W.keep_first(politician, ["mp_id"], [order])
    seats, twice = W.keep_first(mandate, ["mp_id", "term"], [order])
    kept = seats.select("mp_id", "term", F.col("source_url").alias("kept_source"))
    source = F.col("source_url") if "source_url" in politician.columns else F.lit(None).cast("string")
    reports = {
        "duplicate_politicians": again.select("mp_id", F.lit("local-first").alias("kept_source"), source.alias("discarded_source")),
        "duplicate_mandates": twice.select("mp_id", "term", F.col("source_url").alias("discarded_source")).join(kept, ["mp_id", "term"], "left"),
    }
    return people, seats, reports


def unresolved_parties(mandate: DataFrame) -> DataFrame:
    """Mandates without a known party."""
    return mandate.where(F.coalesce("party_id", F.lit("")).isin("", C.UNKNOWN_PARTY))


def validate(politician: DataFrame, mandate: DataFrame) -> DataFrame:
    """Violated rules and how many rows violate them; empty if all hold."""
    dup = lambda df, key: df.groupBy(*key).count().where("count > 1")
    ids = politician.select("mp_id").unionAll(mandate.select("mp_id"))
    rules = [
        ("empty_id", ids.where(~X.non_empty(F.col("mp_id")))), ("foreign_id", ids.where(F.col("mp_id").startswith("SYC"))),
        ("duplicate_politician", dup(politician, ["mp_id"])), ("duplicate_mandate", dup(mandate, ["mp_id", "term"])),
        ("mandate_without_politician", J.orphans(mandate, politician, "mp_id", "mp_id")), ("mandate_without_start", mandate.where("mandate_start is null")),
    ]
    out = None
    for name, rows in rules:
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n")
        out = one if out is None else out.unionAll(one)
    return out.where("n > 0")


def augment_reference(base: DataFrame, archive: DataFrame, urls: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The base with the archive's rows for the asked profile addresses, and the ids that the archive lacks."""
    ids = urls.select(V.id_from_url(F.col("url")).alias("mp_id")).where("mp_id is not null").distinct()
    asked = archive.join(J.small(ids), "mp_id", "left_semi")
    return J.merge_new(base, asked, key, [F.col(k) for k in key]), J.missing_keys(ids, archive, ["mp_id"])
