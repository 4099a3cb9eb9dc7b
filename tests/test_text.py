import pytest
from pyspark.sql import functions as F

from debatelake.functions import text as X
from debatelake.functions import values as V
from debatelake.functions.folding import fold_key, name_ratio, ocr_text, unicode_key


def ask(spark, f, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", f(F.col("t")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def test_cleaning_and_wrappers(spark):
    assert ask(spark, X.clean_text, "a\u0080\u0082b  c ", None) == ["a b c", None]
    assert ask(spark, X.strip_wrappers, '\\" « Rires  et  bruits » "', None) == ["Rires et bruits", ""]


@pytest.mark.parametrize("good", ["Applaudissements sur les bancs", "(Rires.)", "Très bien !", "TRÈS BIEN", "huées"])
def test_reactions(spark, good):
    assert ask(spark, X.is_reaction, good, "Rapport no 12", "", None, "horizon") == [True, False, False, False, False]


def test_titles(spark):
    titles = ["QUESTIONS À LE GOUVERNEMENT", "le prix de le pain", "L' AIR", "à les urnes", "modèle espagnol"]
    once = ask(spark, X.clean_title, *titles)
    assert once == ["QUESTIONS AU GOUVERNEMENT", "le prix du pain", "L'AIR", "aux urnes", "modèle espagnol"]
    assert ask(spark, X.clean_title, *once) == once
    assert [r and (r.number, r.title) for r in ask(spark, X.match_major_topic, "3 LOI DE FINANCES", "fin. 12 PACTE CIVIL", "3 petits chats", None)] == [(3, "LOI DE FINANCES"), (12, "PACTE CIVIL"), None, None]
    assert ask(spark, X.match_subtopic, "RAPPEL DES FAITS", "Bien sûr, nous allons voir cela. RAPPEL DES FAITS", "seul", "1 LOI DE FINANCES") == ["RAPPEL DES FAITS", "RAPPEL DES FAITS", None, None]


def test_keys_and_markers(spark):
    assert ask(spark, X.simple_key, "Hervé  Gaymard-Œuf") == ["herve gaymard uf"]
    assert ask(spark, unicode_key, "Élie ŞAHİN", None)[0] == fold_key("Élie ŞAHİN")
    assert ask(spark, lambda c: X.person_key(X.simple_key(c)), "M. le président", "Mme Anne Le Gall") == ["le president", "anne le gall"]
    assert ask(spark, X.has_speaker_marker, "M. Jean Dupont. Bonjour", "la suite", None) == [True, False, False]
    assert ask(spark, X.is_chair, "M. le président", "M. le président de la commission", "M. Martin") == [True, False, False]


def test_ratio_and_ocr(spark):
    r = spark.createDataFrame([("jean dupont", "jean dupond"), ("", "a"), ("a", "a")], "a string, b string").select(name_ratio("a", "b").alias("r")).collect()
    assert r[0].r > 0.9 and r[1].r == 0 and r[2].r == 1
    assert ask(spark, ocr_text, "R­EGLEMENT – I er", None) == ["RÈGLEMENT - Ier", ""]


def test_values(spark):
    assert [str(x) for x in ask(spark, V.mixed_date, "2020-01-05", "05/01/2020", "5-1-2020", "soon", None)] == ["2020-01-05"] * 3 + ["None"] * 2
    assert [str(x) for x in ask(spark, V.iso_date, "2020-1-5", "2020-02-30", "2020-02-29")] == ["None", "None", "2020-02-29"]
    assert [str(x) for x in ask(spark, V.french_date, "né le 1er août 1951 à Lyon", "31 février 2000")] == ["1951-08-01", "None"]
    assert ask(spark, V.term_number, "XIVe législature", "15e législature", "rien") == [14, 15, None]
    assert ask(spark, V.pa_ids, "PA20 x PA1 PA20", None) == [["PA1", "PA20"], []]
    assert ask(spark, X.parse_list, "['a', 'b']", "seul", "", None) == [["a", "b"], ["seul"], [], []]
    assert ask(spark, V.years, "2011-2013,2020,2012") == [[2011, 2012, 2013, 2020]]
    ids = ask(spark, lambda c: V.fallback_id(c, F.lit("seed")), "1234567", None, "12")
    assert ids[0] == "PA91234567" and ids[2] == "PA9000012" and len(ids[1]) == 9
