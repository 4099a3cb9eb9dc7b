import io
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from debatelake.operators import joins as J
from debatelake.operators import windows as W
from debatelake.plans import binding, debates, summary
from debatelake.schemas import require_columns
from debatelake.sources import archives, debate_xml, html_pages



def fold_islands(rows):
    """The same grouping as a sequential fold: (key, kind) rows of one sitting."""
    out, gid, last, first = [], 0, None, True
    for n, (key, kind) in enumerate(rows):
        own = ("own", n) if key is None else key
        if kind == "proc":
            gid, last, first = gid + 1, None, True
        elif first:
            gid, last, first = gid + 1, own, False
        elif kind == "plain" and own != last:
            gid, last = gid + 1, own
        out.append(gid)
    return out


def test_islands_like_a_fold(spark):
    r = random.Random(3)
    sittings = [[(r.choice(["a", "b", None]), r.choice(["plain", "plain", "react", "proc"])) for _ in range(r.randint(1, 12))] for _ in range(150)]
    rows = [(s, i, k, kind) for s, x in enumerate(sittings) for i, (k, kind) in enumerate(x)]
    df = spark.createDataFrame(rows, "s int, i int, k string, kind string").repartition(7)
    got = {(x.s, x.i): x.g for x in W.group_islands(df, ["s"], ["i"], F.col("k"), F.col("kind") == "proc", F.col("kind") == "react", "g").collect()}
    assert got == {(s, i): g for s, x in enumerate(sittings) for i, g in enumerate(fold_islands(x))}


def test_absorption(spark):
    rows = [(1, "d1", "A", "un", "matched"), (2, "d1", None, "deux", "missing_speaker"), (3, "d1", None, "M. Paul Martin. trois", "missing_speaker"), (4, "d2", None, "quatre", "missing_speaker"), (5, "d2", "B", "cinq", "matched"), (6, "d2", None, "six", "missing_speaker")]
    df = spark.createDataFrame(rows, "id int, date string, speaker string, text string, bind_status string").withColumn("g", F.lit(0))
    after, audit, report = binding.absorb_missing(df, "id", ["date"], "text", ["g"])
    assert {r.id: (r.text, r.absorbed_count) for r in after.collect()} == {1: ("un\n\ndeux", 1), 3: ("M. Paul Martin. trois", 0), 4: ("quatre", 0), 5: ("cinq\n\nsix", 1)}
    assert [r.absorb_status for r in audit.collect()] == ["merged", "blocked_text_starts_with_speaker_marker", "blocked_boundary_mismatch", "merged"]
    assert report.first().conserved


def test_binding_cascade(spark):
    pol = spark.createDataFrame([("PA1", "Jean", "Dupont"), ("PA2", "Anne", "Le Gall"), ("PA3", "Marc", "Oral")], "mp_id string, first_name string, last_name string")
    man = spark.createDataFrame([("PA1", "2010-01-01", "2012-01-01"), ("PA2", "2010-01-01", None), ("PA3", "2000-01-01", "2001-01-01")], "mp_id string, s string, e string").select("mp_id", F.to_date("s").alias("mandate_start"), F.to_date("e").alias("mandate_end"))
    rows = [(1, "M. Jean Dupont.", "", "05-06-2011", ""), (2, "Mme Anne Le Gal", "", None, "CRI_20110606.xml"), (3, "Jean Dupont", "", "05-06-2015", ""), (4, "Marc Oral", "/PA3", "05-06-2011", ""), (5, "M. le président", "", "05-06-2011", ""), (6, None, "", "05-06-2011", ""), (7, "Nobody", "", None, ""), (8, "Tonton", "", "05-06-2011", "")]
    sp = spark.createDataFrame(rows, "row_id int, speaker string, link_speaker string, date string, source_files string")
    got = {r.row_id: (r.mp_id, r.bind_status, r.bind_method) for r in binding.bind(sp, pol, man, {"Tonton": "PA1"}).collect()}
    assert got[1] == ("PA1", "matched", "name_exact_mandate")
    assert got[2] == ("PA2", "matched", "name_fuzzy_mandate") or got[2][1] == "unmatched"
    assert got[3] == ("PA1", "matched_no_active_mandate", "name_exact_no_active_mandate")
    assert got[4] == ("PA3", "matched_no_active_mandate", "link_name_no_active_mandate")
    assert [got[i][1] for i in (5, 6, 7)] == ["president", "missing_speaker", "missing_date"]
    assert got[8] == ("PA1", "matched", "manual_alias_mandate")


XML = b"""<c xmlns="urn:x"><Metadonnees><DateSeance>2011-01-12</DateSeance><NumSeance>97</NumSeance></Metadonnees><Sommaire><Para>toc</Para></Sommaire>
<Section><TitreStruct>A</TitreStruct><Para Ident="1"><Orateur><Nom href="/PA1">M. X</Nom></Orateur> Bonjour</Para><SousSection1><TitreStruct>B</TitreStruct><Para Ident="2">Texte</Para></SousSection1><Para Ident="3">Fin</Para></Section></c>"""


def test_xml_to_rows(spark):
    files = spark.createDataFrame([("/a/CRI_1.xml", bytearray(XML)), ("/a/CRI_2.xml", bytearray(b"<broken"))], "path string, content binary")
    rows = debates.flatten(debates.documents(files)).orderBy("pos").collect()
    assert [(r.id, r.topic, r.subtopic1, r.speaker) for r in rows] == [("1", "A", "", "M. X"), ("2", "A", "B", ""), ("3", "A", "", "")]
    assert rows[0].link_speaker == "/PA1" and rows[0].date == "12-01-2011" and rows[0].numSeance == "97"
    assert {r.status: r.n for r in debates.conversion_counts(files).collect()} == {"processed": 1, "failed": 1}
    assert debate_xml.sitting_numbers(files.where("path like '%1.xml'")).first().numSeance == "97"


def test_archives_stay_inside(spark):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
        for name in ("2011/a.xml", "../evil.xml", "note.txt"):
            info = tarfile.TarInfo(name)
            info.size = 2
            tar.addfile(info, io.BytesIO(b"<a"))
    rows = archives.extract(spark.createDataFrame([("x.tgz", bytearray(buffer.getvalue())), ("bad", bytearray(b"no"))], "path string, content binary")).collect()
    assert [r.path for r in rows] == ["a.xml"]


def test_summary(spark):
    text = ["entête", "SOMMAIRE", "1. QUESTIONS AU GOUVERNEMENT (p. 12)", "AVENIR DE LA POSTE", "2. LOI RELATIVE AUX", "DROITS DES MALADES ... 45", "PRÉSIDENCE DE M. X", "reste"]
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(text)], "doc_id int, line_no int, line string")
    rows = summary.extract_summary(lines).orderBy("major_topic_order", "structure_level").collect()
    assert [r.structure_level for r in rows].count("major_topic") == 2
    assert any(r.subtopic == "AVENIR DE LA POSTE" for r in rows)


def test_pages_and_guards(spark):
    lines, links = html_pages.page("<p>a&amp;b</p><script>x</script><a href='/1'>l <b>m</b></a>")
    assert lines == ["a&b", "l m"] and links == [{"label": "l m", "href": "/1"}]
    with pytest.raises(KeyError):
        require_columns(spark.range(1), ["nope"])


def test_numbering_is_the_same_for_any_partitioning(spark):
    df = spark.range(100).select((F.col("id") * 37 % 101).alias("x"))
    for n in (1, 7):
        got = W.number_rows(df.repartition(n), ["x"], name="r").orderBy("x").collect()
        assert [r.r for r in got] == list(range(1, 101))


def test_no_python_in_native_joins(spark):
    e = spark.createDataFrame([(1, "2020-01-01")], "k int, d string").select("k", F.to_date("d").alias("day"))
    s = spark.createDataFrame([(1, "2019-01-01", None)], "k int, s string, e string").select("k", F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    joined = J.containment_join(e, s, ["k"], "day", "s", "e")
    assert joined.count() == 1
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
