import random

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def words(r, n):
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


def test_one_row_stays_of_each_group_with_null_and_repeated_ids(spark):
    r = random.Random(3)
    a, b, c, d, e, f = (words(r, 60) for _ in range(6))
    rows = [
        (None, a),  # alone
        (None, b), (None, b + " end"),  # a pair without ids
        (None, c), (7, c),  # the id stays
        (1, d), (1, d), (1, d + " end"),  # copies under one id
        (2, d), (2, e),  # a copy of a lesser id's text, and another text
        (3, f), (3, f),
        (None, "!"), (None, None), (None, None), (4, ""), (4, ""),
    ]
    got = [(x.doc_id, x.text) for x in corpus_pipeline.near_duplicate_stage(spark, docs_of(spark, rows), "").collect()]
    by = lambda *starts: [x for x in got if x[1] and x[1].startswith(starts)]
    assert by(a) == [(None, a)] and len(by(b)) == 1 and by(c) == [(7, c)]
    assert [x[0] for x in by(d)] == [1] and by(e) == [(2, e)] and by(f) == [(3, f)]
    assert got.count((None, None)) == 2 and got.count((4, "")) == 2 and (None, "!") in got
    assert len(got) == 11
