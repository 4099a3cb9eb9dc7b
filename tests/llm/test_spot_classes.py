import random

from debatelake.llm import spotsigs as P
from debatelake.llm.common import WordHash


def text_of(r, n):
    return " ".join(r.choice("the a of in and is stone river light house green paper window garden night cloud tower".split()) + r.choice(["", "", str(r.randrange(30))]) for _ in range(n))


def test_classes_like_brute_force(spark):
    r = random.Random(3)
    texts = []
    for _ in range(12):
        base = text_of(r, r.randint(20, 200)).split()
        for _ in range(8):
            copy = list(base)
            for _ in range(r.randrange(1 + len(base) // 25)):
                copy[r.randrange(len(copy))] = "other"
            texts.append(" ".join(copy))
    texts += ["", None, "!", "stone", "stone", "Stone."]
    memo = WordHash(P.ANCHORS)
    sets = [set(P.signatures(t, memo).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 10 * len(x & sets[j]) >= 8 * len(x | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string").repartition(5)
    got = {x.doc_id: x.class_id for x in P.near_duplicates(docs).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    assert len(set(got.values())) < 60 and P.near_duplicates(docs.where("false")).count() == 0


def test_the_next_document_whatever_the_ranges(spark):
    r = random.Random(5)
    rows = [(r.randrange(60), text_of(r, r.randint(0, 30))) for _ in range(40)] + [(None, "the stone"), (None, None), (3, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    keys = ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"]
    every = [sorted((tuple(x) for x in P.compare_with_next(docs, partitions=n).select(*keys).collect()), key=str) for n in (1, 3, 25)]
    assert every[0] == every[1] == every[2] and len(every[0]) == len(rows)
    assert P.compare_with_next(docs.where("false")).count() == 0
