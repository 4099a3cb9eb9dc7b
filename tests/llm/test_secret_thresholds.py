import random

from debatelake.llm import secrets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def random_token(r, n):
    return "Aa0" + "".join(r.choice(secrets.ENCODINGS[5][1]) for _ in range(n - 3))


def token_of(r, n, low, high):
    while True:
        t = random_token(r, n)
        if low <= secrets.randomness(t)[1] < high:
            return t


def test_a_class_with_one_secret_finds_it():
    for p in (8, 20, 49, 90):
        assert secrets.thresholds({("hex", 32): {p: 1}}, 0.05)["hex", 32] * secrets.STEPS <= p
    even = {b: 10 for b in range(secrets.STEPS)}
    limits = secrets.thresholds({("base62", 32): even, ("base62", 48): {20: 1}}, 0.05)
    assert limits["base62", 48] == limits["base62", 32] <= 0.05
    # ordinary tokens keep a stricter threshold
    heap = even | {b: 1000 for b in range(20)}
    assert secrets.thresholds({("base62", 32): heap}, 0.05)["base62", 32] >= 0.2


def test_copies_of_a_token_do_not_raise_the_threshold(spark):
    r = random.Random(2)
    keys = [random_token(r, 40) for _ in range(250)]
    plain = secrets.learn_thresholds(docs_of(spark, list(enumerate(keys))))
    copied = [token_of(r, 40, 0.2, 0.21)] * 2000 + [token_of(r, 40, 0.48, 0.49)] * 2000
    limits = secrets.learn_thresholds(docs_of(spark, list(enumerate(keys + copied))))
    assert abs(limits["base62", 32] - plain["base62", 32]) <= 0.02
    found = secrets.scan_secrets(docs_of(spark, list(enumerate(keys + copied)))).where("size(secret_spans) = 1")
    assert found.where("doc_id >= 250").count() == 4000 and found.where("doc_id < 250").count() >= 0.85 * 250
