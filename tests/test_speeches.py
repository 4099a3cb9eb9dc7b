import datetime

from pyspark.sql import functions as F

from debatelake.plans import debates
from debatelake.streaming import events

XML = b"<c><Metadonnees><DateSeance>2011-01-12</DateSeance></Metadonnees><Section><TitreStruct>A</TitreStruct><Para Ident='1'>Bonjour</Para></Section></c>"


def test_consecutive_rows_become_speeches_with_their_interjections(spark):
    texts = [("A", "mp", False, '\\"" Première phrase. \\""'), ("A", "mp", False, '\\"" Deuxième phrase. \\""'), ("A", "mp", True, '\\"" ( Applaudissements. ) \\""'), ("A", "mp", False, '\\"" Troisième phrase. \\""'), ("B", "gov", False, '\\"" Réponse. \\""'), ("B", "gov", False, "2 LOI DE FINANCES"), ("B", "gov", False, "Suite.")]
    rows = [("2001-02-03", "1", i + 1, f"r{i + 1}", *t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "date string, session string, row_order int, id string, speaker string, role string, interjection boolean, text string").repartition(4)
    got = debates.build_speeches(df).orderBy("speech_order").collect()
    assert [r.speech_text for r in got] == ["Première phrase. Deuxième phrase. Troisième phrase.", "Réponse.", "LOI DE FINANCES", "Suite."]
    assert got[0].interjections == ["( Applaudissements. )"] and got[0].source_row_orders == [1, 2, 3, 4] and got[0].source_ids == ["r1", "r2", "r3", "r4"]
    assert [r.row_type for r in got] == ["speech", "speech", "procedure", "speech"] and got[3].major_topic == "LOI DE FINANCES" and got[1].major_topic is None


def test_companion_files_come_first(spark):
    files = spark.createDataFrame([("/x/CRI_1.xml", bytearray(XML)), ("/x/CRI_2.xml", bytearray(XML))], "path string, content binary")
    listing = spark.createDataFrame([("/x/AAA_1.xml",), ("/x/CRI_1.xml",), ("/y/AAA_2.xml",)], "path string")
    got = {r.path: r.source_files for r in debates.documents(files, listing).collect()}
    assert got == {"/x/CRI_1.xml": ["AAA_1.xml", "CRI_1.xml"], "/x/CRI_2.xml": ["CRI_2.xml"]}
    assert debates.documents(files).first().source_files == ["CRI_1.xml"]


def test_streams_of_files(spark, tmp_path):
    at = lambda m: datetime.datetime(2020, 1, 1, 10, m)
    rows = [("a", at(0)), ("a", at(1)), ("a", at(30)), ("b", at(2)), ("b", at(2))]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))

    def run(make, name):
        stream = events.read_files(spark, str(tmp_path / "in"), df.schema)
        make(stream).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).outputMode("complete" if name != "once" else "append").trigger(availableNow=True).start().awaitTermination(60)
        return spark.table(name).collect()

    assert sorted((r.k, r.n) for r in run(lambda s: events.sessions(s, ["k"], "ts", "5 minutes", "1 hour"), "sessions")) == [("a", 1), ("a", 2), ("b", 2)]
    assert sorted((r.k, r.n) for r in run(lambda s: events.windows(s, ["k"], "ts", "10 minutes", "1 hour"), "windows")) == [("a", 1), ("a", 2), ("b", 2)]
    assert sorted(r.k for r in run(lambda s: events.first_of_key(s, ["k"], "ts", "1 hour"), "once")) == ["a", "b"]


def test_summary_listing_orders_topics(spark):
    df = spark.createDataFrame([(1, "speech", 1, None), (2, "major_topic", 1, None), (3, "subtopic", 1, "S"), (4, "subtopic", 1, "S"), (5, "major_topic", 2, None)], "o int, structure_level string, major_topic_order int, subtopic string").withColumn("d", F.lit(1))
    assert [r.o for r in debates.structure_listing(df, ["d"], "o").collect()] == [2, 3, 5]
