import math
import random
from collections import Counter

import numpy as np
import pytest

from debatelake.llm import toxicity as T

ALPHABET = "abé"


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(ALPHABET) for _ in range(r.randint(1, 6)))
    return [" ".join(word() for _ in range(12)) for _ in range(25)]


class ByBruteForce:
    """The same models as tables of strings."""

    def __init__(self, classes, every):
        self.n = []
        for texts in classes:
            count = Counter()
            for t in texts:
                for w in T.words_of(t):
                    count.update(T.expressions(w))
            self.n.append(count)
        known = {g[i:] for c in self.n for g in c for i in range(len(g))}
        opens, left = Counter(), {}
        for t in every:
            for b in T.words_of(t):
                w = T.OPEN + b.decode() + T.SHUT
                for i in range(1, len(w)):
                    for k in range(min(T.ORDER - 1, i + 1)):
                        g = w[i - k : i + 1]
                        if i == k:
                            opens[g] += 1
                        else:
                            left.setdefault(g, set()).add(w[i - k - 1])
        self.a = {g: opens[g] + len(left.get(g, ())) for g in known if len(g) < T.ORDER}

    @staticmethod
    def parts(counts, h):
        mine = [n for g, n in counts.items() if len(g) == len(h) + 1 and g.startswith(h) and n > 0]
        return sum(mine), (T.DISCOUNT * len(mine) / sum(mine) if mine else 1.0)

    def shared(self, h, w):
        if not h:
            single = [n for g, n in self.a.items() if len(g) == 1]
            return (self.a.get(w, 0) + 1) / (sum(single) + len(single) + 1)
        total, rest = self.parts(self.a, h)
        return (max(self.a.get(h + w, 0) - T.DISCOUNT, 0) / total if total else 0) + rest * self.shared(h[1:], w)

    def of_class(self, y, h, w):
        total, rest = self.parts(self.n[y], h)
        return (max(self.n[y][h + w] - T.DISCOUNT, 0) / total if total else 0) + rest * self.shared(h[1:], w)


@pytest.fixture(scope="module")
def both(spark):
    classes = corpus(1), corpus(2)[:10]
    every = classes[0] + classes[1] + corpus(3)
    sample = spark.createDataFrame([(y, 1 + i % 4, t) for y, texts in enumerate(classes) for i, t in enumerate(texts)], "y int, part int, text string")
    found = T.class_counts(sample).to_pydict()
    grams = sorted(set(found["g"]))
    of = T.Expressions(grams)
    docs = spark.createDataFrame([(t,) for t in every], "text string").repartition(3)
    shared = T.shared_probabilities(of, T.shared_counts(docs, "text", of.keys[: T.ORDER - 1]))
    n = np.zeros((len(grams), 2))
    for g, y, count in zip(found["g"], found["y"], found["n"]):
        n[grams.index(g), y] += count
    return T.class_model(of, shared, n), ByBruteForce(classes, every), classes


def test_each_context_sums_to_one(both):
    _, force, _ = both
    symbols = [g for g in force.a if len(g) == 1]
    unseen = force.shared("", "\x04")
    assert math.isclose(sum(force.shared("", w) for w in symbols) + unseen, 1)
    for h in ["a", T.OPEN, T.OPEN + "b", "ab", "ba" + ALPHABET[2], "aba", T.OPEN + "zz"]:
        assert math.isclose(sum(force.shared(h[-3:], w) for w in [*symbols, "\x04"]), 1)
        for y in (0, 1):
            assert math.isclose(sum(force.of_class(y, h, w) for w in [*symbols, "\x04"]), 1)


def test_ratios_like_brute_force(both):
    model, force, classes = both
    for word in [*T.words_of(classes[0][0]), *T.words_of(classes[1][0]), b"zz", b"abababab", "ébé".encode()]:
        w = T.OPEN + word.decode() + T.SHUT
        want = [0.0]
        for i in range(1, len(w)):
            h = w[max(0, i + 1 - T.ORDER) : i]
            want.append(math.log(force.of_class(1, h, w[i])) - math.log(force.of_class(0, h, w[i])))
        got, _ = model.places([word])
        assert np.allclose(got, want, atol=1e-5)


def test_odd_texts_and_repeats(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (1, "you idiot"), (None, None), (2, ""), (3, "x" * 200_000), (4, "\x02\x03 \x00"), (5, "!?")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (9, 1), (None, 1), (4, None), (5, 7)], "doc_id long, toxic int")
    got = T.score_toxicity(docs.withColumn("score", docs.doc_id), labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert T.score_toxicity(docs.where("false"), labels).count() == 0
    assert T.score_toxicity(docs, labels.where("false")).count() == 7


def test_long_words_are_judged_by_stretches():
    model = T.ToxicityModel(np.empty(0, np.uint64), np.empty(0), np.empty(0, np.uint64), np.empty(0))
    x = "ab" * 40
    keys = np.unique(T.hashes(T._joined([x.encode()])[0])[4])
    model = T.ToxicityModel(keys, np.full(len(keys), 0.5), np.empty(0, np.uint64), np.empty(0))
    features = model.features([x, "cd", None])
    assert math.isclose(features[0][1], 0.5 * T.STRETCH) and not features[1][1] and not features[2].any()
