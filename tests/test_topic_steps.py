"""Matching of topics computes each step once, and its early exits lose no title."""

import pytest
from pyspark.sql import functions as F

from debatelake.functions import text as X


@pytest.mark.parametrize("step", [X.match_major_topic, X.match_subtopic, X.clean_title])
def test_a_step_is_named_once(spark, step):
    """Before, each use of a step held all the steps under it: 3,221,990 characters of plan for a subtopic."""
    plan = spark.createDataFrame([("x",)], "t string").select(step(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert len(plan) < 16_000


def test_early_exits(spark):
    texts = [
        "3 LOI DE FINANCES Discussion d'un projet de loi.",
        "3 LOI DE FINANCES Discussion d un projet de loi. »",
        "3 LOI DE FINANCES.",
        "3 LOI DE FINANCES Suite \t de la\ndiscussion.",
        "3 LOI DE FINANCES ? »",
        "3 " + "DE LE " * 88 + "X",
        "3 " + "DE LE " * 89 + "X",
        "3 " + " " * 3000 + "LOI \"  ",
        "3 " + "LOI DE FINANCES " * 50 + "Explications de vote.",
        None,
        "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", X.match_major_topic(F.col("t"))["title"].alias("m")).orderBy("i").collect()
    law = "LOI DE FINANCES"
    assert [r.m for r in rows] == [law, law, None, law, None, None, None, "LOI", None, None, None]
    short = df.select(X.match_major_topic(F.lit("3 " + "DE LE " * 59 + "X"))["title"].alias("m")).first()
    assert short.m == "DU " * 59 + "X"
    subs = ["RAPPEL DES FAITS. »", "Bien sûr, nous allons voir cela. RAPPEL DES FAITS »", "Nous passons maintenant à la suite RAPPEL DES FAITS", "RAPPEL DES FAITS ! ", "« RAPPEL DES FAITS »", None]
    rows = spark.createDataFrame(list(enumerate(subs)), "i int, t string").select("i", X.match_subtopic(F.col("t")).alias("m")).orderBy("i").collect()
    assert [r.m for r in rows] == [None, "RAPPEL DES FAITS", "RAPPEL DES FAITS", None, "RAPPEL DES FAITS", None]
