import random

from pyspark.sql import functions as F

from debatelake.llm import language_id

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def test_every_language_has_a_model_and_copies_count_once(spark):
    r = random.Random(4)
    chars = [chr(0x4E00 + 40 * i + j) for i in range(70) for j in range(12)]
    rows = []
    for i in range(70):
        own = chars[12 * i : 12 * i + 12]
        rows += [(" ".join("".join(r.choice(own) for _ in range(4)) for _ in range(20)), f"l{i:02}") for _ in range(4 if i == 69 else 5)]
    docs = spark.createDataFrame([(i, t, y, "s", 0) for i, (t, y) in enumerate(rows)], DOCS)
    model = language_id.train_text_model(docs)
    assert model.languages == [f"l{i:02}" for i in range(70)]
    none = F.lit(None).cast("string")
    got = language_id.identify_language(docs, model, F.col("text"), F.col("lang"), none, none).collect()
    assert all(x.lang_found == x.lang and x.lang_accepted for x in got) and len(got) == len(rows)
    once = language_id.train_text_model(docs_of(spark, [(0, "some words here"), (1, "other text")]))
    often = language_id.train_text_model(docs_of(spark, [(0, "some words here"), (1, "other text")] + [(2, "other text")] * 500).repartition(6))
    assert (once.table == often.table).all()
