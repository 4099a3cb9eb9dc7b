import random

import pytest

from debatelake.llm import secrets as S

ORDINARY = "abcdefghij 12345678901234567890 aaaaaaaaaaaaaaaaaaaaaaaa".split()


def ordinary_token(r, n):
    """Long unbroken tokens that people write: names joined up, paths, counters, repeats."""
    words = "get set user name value index table column file path list item north south river stone Light Paper Window".split()
    kind = r.randrange(4)
    if kind == 0:
        token = "_".join(r.choice(words) + r.choice(["", "2", "10"]) for _ in range(n))
    elif kind == 1:
        token = "/".join(r.choice(words) for _ in range(n))
    elif kind == 2:
        token = "".join(w.capitalize() for w in r.choices(words, k=n)) + str(r.randrange(100))
    else:
        token = r.choice(["00000001", "deadbeef", "12345678", "abcabc12"]) * n
    return token[: max(n, S.RANDOM_LEAST)]


@pytest.mark.parametrize("length", [24, 40, 64, 200])
def test_planted_random_strings_of_each_encoding_are_found(spark, length):
    r = random.Random(length)
    planted, texts = {}, []
    for name, alphabet, classes in S.ENCODINGS:
        for i in range(30):
            token = "".join(r.choice(alphabet) for _ in range(length))
            found = S.infer(token)
            if found and found[0] == name and not S.base_spans(f"see {token} there".encode()):
                planted[len(texts)] = name
                texts.append(f"see {token} there")
    others = [f"see {ordinary_token(r, length)} there" for _ in range(600)]
    copied = ["see " + ordinary_token(r, length) + " again"] * 400
    docs = spark.createDataFrame(list(enumerate(texts + others + copied)), "doc_id long, text string")
    rows = {x.doc_id: [s for s in x.secret_spans if s.kind == "random"] for x in S.scan_secrets(docs).collect()}
    for name in set(planted.values()):
        mine = [i for i, kind in planted.items() if kind == name]
        assert sum(bool(rows[i]) for i in mine) >= 0.8 * len(mine), name
    hits = sum(bool(rows[i]) for i in planted)
    false = len({texts_ for i, texts_ in enumerate(texts + others + copied) if i >= len(texts) and rows[i]})
    assert hits >= 0.88 * len(planted) and false <= 0.1 * (hits + false)


def test_one_secret_alone_and_one_copied_often(spark):
    r = random.Random(7)
    made = ("".join(r.choice(S.ENCODINGS[k][1]) for _ in range(48)) for k in (5, 6) * 20)
    # one random string in twenty is under the level and passes for an ordinary one
    alone, often = [x for x in made if S.randomness(x) and S.randomness(x)[1] > 0.06][:2]
    docs = spark.createDataFrame([(0, f"key {alone} end")] + [(i, f"key {often} end") for i in range(1, 900)], "doc_id long, text string")
    got = S.scan_secrets(docs.withColumn("secret_spans", docs.doc_id)).collect()
    assert all([tuple(s) for s in x.secret_spans] == [(4, 52, "random")] for x in got)


def test_odd_texts(spark):
    texts = [None, "", "A" * 300_000, "password: " + "x" * 100_000, "é" * 30 + " AKIA" + "Z" * 20, "ab12" * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in S.secret_report(S.scan_secrets(docs)).collect()}
    assert got[0].spans == got[1].spans == got[2].spans == "" and got[3].n_assign == 1 and got[4].spans == "access:31:55"
    assert got[5].spans == f"hex:0:{200_000}"
    assert S.scan_secrets(docs.where("false")).count() == 0
