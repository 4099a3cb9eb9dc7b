"""Operators over more rows than one partition holds."""

import datetime

from pyspark.sql import functions as F

from debatelake.operators import aggregates as A
from debatelake.operators import joins as J
from debatelake.operators import windows as W
from debatelake.plans import binding, debates

DAY = datetime.date(2010, 1, 1)


def test_numbers_of_a_million_wide_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("x"), F.sha2(F.col("id").cast("string"), 512).alias("a"), F.sha2((F.col("id") + 1).cast("string"), 512).alias("b"))
        got = W.number_rows(df, ["x"], name="r")
        rank = F.col("r") - 1 - F.lag("r", 1, 0).over(W.Window.partitionBy(F.floor(F.col("r") / 50_000)).orderBy("x"))
        row = got.agg(F.count("*").alias("n"), F.countDistinct("r").alias("d"), F.min("r").alias("lo"), F.max("r").alias("hi")).first()
        assert (row.n, row.d, row.lo, row.hi) == (1_000_000, 1_000_000, 1, 1_000_000)
        steps = got.select(F.col("r"), rank.alias("step"), F.row_number().over(W.Window.partitionBy(F.floor(F.col("r") / 50_000)).orderBy("x")).alias("k"))
        assert steps.where("k > 1 and step <> 0").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_absorption_over_the_whole_frame_by_ranges(spark):
    rows = [(i, None if i % 7 else f"s{i}", f"t{i}", "matched" if i % 7 == 0 else "missing_speaker", "d") for i in range(500)]
    df = spark.createDataFrame(rows, "id int, speaker string, text string, bind_status string, date string").repartition(9)
    after, _, report = binding.absorb_missing(df, "id", ["date"], "text")
    got = {r.id: r.text for r in after.collect()}
    assert got == {i: "\n\n".join(f"t{j}" for j in range(i, min(i + 7, 500))) for i in range(0, 500, 7)}
    assert report.first().conserved


def test_gate_sees_faults_between_blocks(spark):
    final = lambda days: spark.createDataFrame([(i + 1, DAY + datetime.timedelta(d), "PA1", 13) for i, d in enumerate(days)], "speech_id long, speech_date date, speaker_id string, term int")
    assert debates.gate(final([0, 1, 1, 2, 3, 4]), block=3).first() == (0, 0, 0, 0)
    assert debates.gate(final([0, 5, 1, 2, 3, 4]), block=3).first().out_of_order == 1
    assert debates.gate(final([0, 5, 6, 2, 3, 4]), block=4).first().out_of_order == 1
    assert debates.gate(final([0, 1, 6, 2, 3, 4]), block=3).first().out_of_order == 1


def test_final_table(spark):
    day = lambda y: datetime.date(y, 3, 1)
    schema = "speech_text string, speech_interjection string, speech_date date, speaker string, speaker_id string, row_order long, {} string"
    old = spark.createDataFrame([("a", None, day(1999), "X", "PA1", 1, "speech"), ("b", None, day(1999), "M. le président", None, 2, "speech"), ("c", None, day(1999), "X", "PA1", 3, "procedure"), ("d", None, day(2012), "X", "PA1", 4, "speech")], schema.format("row_type"))
    new = spark.createDataFrame([("e", None, None, "Y", "PA2", 1, "CRI_20120105.xml"), ("f", None, day(2012), "", "PA2", 2, ""), ("g", None, day(2012), "Z", None, 3, "")], schema.format("source_files"))
    office = spark.createDataFrame([("PA9", day(1998), day(2001)), ("PA8", day(1997), None)], "mp_id string, start_date date, end_date date")
    got = debates.final_table(new, old, office).orderBy("speech_id").collect()
    assert [(r.speech_id, r.speech_text, r.speaker_id, r.term) for r in got] == [(1, "a", "PA1", 11), (2, "b", "PA8", 11), (3, "e", "PA2", 13)]


def test_gaps_are_spread_in_steps(spark, monkeypatch):
    monkeypatch.setattr(A, "GAP_STEP", 4)
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 15), ("b", 7), ("b", None), ("b", 9)], "k string, n long")
    got = sorted((r.k, r.n) for r in A.missing_numbers(df, ["k"], "n").collect())
    assert got == [("a", i) for i in range(3, 15)] + [("b", 8)]


def test_intervals_by_month_like_broadcast(spark):
    rows = [(i, DAY + datetime.timedelta(i * 11), None if i % 3 else "own") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, day date, v string")
    spans = spark.createDataFrame([(f"s{i}", DAY + datetime.timedelta(i * 40), None if i == 20 else DAY + datetime.timedelta(i * 40 + 55)) for i in range(21)], "w string, s date, e date")
    few, many = (J.fill_from_intervals(df, spans, "v", "day", "w", "s", "e", F.lit(True), most=m).orderBy("id").collect() for m in (1000, 3))
    assert few == many and few[1].v == "s0" and few[0].v == "own"


def test_parties_by_every_label(spark):
    party = spark.createDataFrame([("P008", "SOC", "Socialistes et apparentés", "['Socialistes et apparentés', 'Groupe socialiste']", "['SOC']"), ("P038", "R-UMP", "Rassemblement - Union pour un Mouvement Populaire", "[]", "['R-UMP']"), ("P040", "SOC", "Autre", None, None)], "party_id string, acronym string, name string, source_political_groups string, interjection_aliases string")
    rows = spark.createDataFrame([(0, "SOC", "IGNORED"), (1, None, "PS"), (2, "RPR", None), (3, "DL", None), (4, " ", ""), (5, "groupe SOCIALISTE", None), (6, "p038", None), (7, None, "Socialistes et Apparentes")], "i int, parliamentary_group string, party string")
    got = {r.i: (r.party_id, r.party_source_column, r.party_bind_status) for r in binding.bind_parties(rows, party).collect()}
    assert got == {0: ("P008", "parliamentary_group", "matched"), 1: ("P008", "party", "matched"), 2: ("P038", "parliamentary_group", "matched"), 3: (None, "parliamentary_group", "unmatched"), 4: (None, None, "missing_source"), 5: ("P008", "parliamentary_group", "matched"), 6: ("P038", "parliamentary_group", "matched"), 7: ("P008", "party", "matched")}


def test_binding_without_links_or_files(spark):
    pol = spark.createDataFrame([("PA1", "Jean", "Dupont")], "mp_id string, first_name string, last_name string")
    man = spark.createDataFrame([("PA1", DAY, None)], "mp_id string, mandate_start date, mandate_end date")
    rows = spark.createDataFrame([(1, "M. Jean Dupont", "05-06-2011"), (2, "Jean Dupont", None)], "row_id int, speaker string, date string")
    got = {r.row_id: (r.mp_id, r.bind_status) for r in binding.bind(rows, pol, man).collect()}
    assert got == {1: ("PA1", "matched"), 2: (None, "missing_date")}
