import datetime
import json

from pyspark.sql import functions as F

from debatelake.plans import deputies as D
from debatelake.sources import readers, sinks

day = datetime.date.fromisoformat


def actor(uid, first, last, *mandates):
    return {"acteur": {"uid": {"#text": uid}, "etatCivil": {"ident": {"prenom": first, "nom": last}, "infoNaissance": {"dateNais": "1950-02-03", "villeNais": "Lyon", "paysNais": "France"}}, "profession": {"libelleCourant": "Avocat"}, "mandats": {"mandat": list(mandates) if len(mandates) != 1 else mandates[0]}}}


def mandate(kind, start, end=None, term="14", organ=None, **more):
    return {"uid": f"{kind}{start}", "typeOrgane": kind, "legislature": term, "dateDebut": start, "dateFin": end, "organes": {"organeRef": organ}} | more


def docs(spark, folder, *objects):
    for i, x in enumerate(objects):
        (folder / f"{i}.json").write_text(json.dumps(x))
    (folder / "broken.json").write_text("{")
    return readers.read_json_files(spark, str(folder), "acteur").where("doc is not null")


def test_persons_and_mandates_of_documents(spark, tmp_path):
    place = {"election": {"lieu": {"departement": "Ain", "numCirco": "2"}}}
    rows = docs(spark, tmp_path, actor("PA1", "Jean", "Dupont", mandate("ASSEMBLEE", "2012-06-20", "2013-01-01", **place), mandate("ASSEMBLEE", "2014-01-01", None, **place), mandate("GP", "2012-07-01", None, organ="PO1"), mandate("GP", "2013-01-01", None, organ="PO2"), mandate("COMPER", "2012-07-01", "2012-08-01", organ="PO3")), actor("PA2", "Anne", "Martin", mandate("SENAT", "2001-01-01")))
    people = {r.mp_id: r for r in D.politicians(rows, "2015-01-01").collect()}
    assert (people["PA1"].status, people["PA2"].status, people["PA2"].seniority) == ("ASSEMBLEE", "SENAT", None)
    assert float(people["PA1"].seniority) == round((195 + 365) / 365.25, 2) and people["PA1"].birth_place == "Lyon, France"
    organs = spark.createDataFrame([("PO1", "Groupe socialiste"), ("PO2", "Non inscrit"), ("PO3", "Lois")], "organ string, label string")
    seat = D.mandate_rows(rows, organs, {"groupe socialiste": "P008"}, "https://x.fr/dyn").collect()
    assert [(r.mp_id, r.term, r.party_id, r.club, r.committees, r.constituency, r.mandate_end, r.election_date) for r in seat] == [("PA1", "14", "P008", "Groupe socialiste", "Lois", "Ain (2)", None, day("2012-06-20"))]


def test_pages_of_the_directory(spark):
    lines = spark.createDataFrame([(1, ["Mme X", "Née le 1er mai 1951 à Lyon (Rhône)"]), (2, ["Né le 2 juin 1949"]), (3, ["rien"])], "i int, lines array<string>")
    got = [(r.b.birth_date, r.b.birth_place) for r in lines.select("i", D.birth_line(F.col("lines")).alias("b")).orderBy("i").collect()]
    assert got == [(day("1951-05-01"), "Lyon (Rhône)"), (day("1949-06-02"), None), (None, None)]
    pages = spark.createDataFrame([(1, [("A", "/sycomore/fiche/12"), ("", "/sycomore/fiche/13"), ("B", "/autre/14"), ("A2", "https://x.fr/sycomore/fiche/12")])], "p int, links array<struct<label:string,href:string>>")
    assert [tuple(r) for r in D.directory_links(pages, "p", "links", "https://x.fr").collect()] == [("12", "https://x.fr/sycomore/fiche/12", "A")]


def scraped(spark, rows):
    kind = "array<struct<term:string,start:date,end:date,constituency:string,club:string>>"
    return spark.createDataFrame(rows, f"sycomore_id string, url string, pa_id string, full_name string, birth_date date, birth_place string, mandates {kind}")


def test_augmentation_with_taken_ids_and_reports(spark):
    pol = spark.createDataFrame([("PA1", "Jean", "Dupont", day("1950-01-01")), ("PA9000007", "Old", "Taken", None), ("PA5", "Marc", "Oral", None)], "mp_id string, first_name string, last_name string, birth_date date")
    man = spark.createDataFrame([("PA1", "11", day("1998-01-01"), None, "", "", "u0"), ("PA5", "11", day("1998-01-01"), None, "", "", "u1")], "mp_id string, term string, mandate_start date, mandate_end date, constituency string, club string, source_url string")
    seat = lambda term: [(term, day("1999-01-01"), None, "Ain", "Club")]
    new = scraped(spark, [("1", "u/1", None, "Jean Dupont", day("1950-01-01"), None, seat("11") + seat("12")), ("7", "u/7", "", "Eve Neuve", None, None, seat("11")), ("007", "u/8", None, "Zoé Autre", None, None, seat("11")), ("9", "u/9", "PA77", "Marc Oral", None, None, seat("12"))])
    people, seats, reports = D.augment(pol, man, new)
    assert {r.mp_id for r in people.collect()} == {"PA1", "PA9000007", "PA9000007001", "PA9000007002", "PA77"}
    assert {(r.mp_id, r.term) for r in seats.collect()} == {("PA1", "11"), ("PA1", "12"), ("PA77", "11"), ("PA77", "12"), ("PA9000007001", "11"), ("PA9000007002", "11")}
    assert {r.mp_id for r in reports["fallback_ids"].collect()} == {"PA9000007001", "PA9000007002"} and reports["new_people"].count() == 2
    assert D.validate(people, seats).count() == 0


def test_relabelling_duplicates_and_validation(spark):
    man = spark.createDataFrame([("PA1", "11", "", "Non inscrit;Groupe A", "u1"), ("PA1", "11", "P002", "x", "u2"), ("SYC3", "12", "P000", "?", "u3"), ("", "12", None, None, "u4")], "mp_id string, term string, party_id string, club string, source_url string").withColumn("mandate_start", F.lit(day("1998-01-01")))
    rows = {(r.mp_id, r.source_url): (r.party_id, r.club) for r in D.relabel(man, {"groupe a": "P008"}).collect()}
    assert rows["PA1", "u1"] == ("P008", "Groupe A") and rows["PA1", "u2"][0] == "P002" and rows["SYC3", "u3"][0] == "P000"
    pol = spark.createDataFrame([("PA1", "a"), ("PA1", "b"), ("SYC3", "c")], "mp_id string, source_url string")
    assert {r.rule for r in D.validate(pol, man).collect()} == {"empty_id", "foreign_id", "duplicate_politician", "duplicate_mandate", "mandate_without_politician"}
    people, seats, reports = D.without_duplicates(pol, man, "source_url")
    assert (people.count(), seats.count()) == (2, 3)
    assert [tuple(r) for r in reports["duplicate_mandates"].collect()] == [("PA1", "11", "u2", "u1")]
    assert D.unresolved_parties(man).count() == 3


def test_sinks_and_readers_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted"\ntext', None), (2, "", "ü;")], "id int, t string, u string")
    assert sinks.write_csv(df, str(tmp_path / "out"), ["id", "u", "t", "more"]) == 2
    back = readers.read_csv_strings(spark, str(tmp_path / "out"), ["id", "u", "t", "more"]).orderBy("id").collect()
    assert [tuple(r) for r in back] == [("1", "", 'a "quoted"\ntext', ""), ("2", "ü;", "", "")]
    assert sinks.write_csv(df, str(tmp_path / "dry"), ["id"], dry_run=True) == 2 and not (tmp_path / "dry").exists()
    sinks.write_reports({"r": df.where("false")}, str(tmp_path / "reports"))
    assert (tmp_path / "reports" / "r").exists()
    years = readers.read_years(spark, {2012: str(tmp_path / "out"), 2011: str(tmp_path / "out")}, "id int, u string, t string, more string")
    assert {r.source_year for r in years.collect()} == {2011, 2012} and years.count() == 4
