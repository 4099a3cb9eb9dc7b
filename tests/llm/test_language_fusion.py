import math
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from debatelake.llm import language_id as L

WORDS = {"en": "the house and river of stone", "fr": "la maison et une rivière de pierre", "de": "das haus und der fluss aus stein"}


def by_brute_force(rows, model):
    """The fusion of all evidence, row by row, each without its own part in the priors."""
    m = len(model.languages)
    soft = []
    for text, *_ in rows:
        logs, n, fit = model.score(text)
        e = np.exp(np.array(logs) - max(logs))
        soft.append((np.array(logs), n, fit, e / e.sum() if n else np.zeros(m)))
    host, domain, whole = defaultdict(lambda: np.zeros(m)), defaultdict(lambda: np.zeros(m)), np.zeros(m)
    name = lambda h: (h or "").lower()
    of = lambda h: ".".join(h.split(".")[-2:]) if "." in h else ""
    for (_, _, _, h), (_, n, _, p) in zip(rows, soft):
        if n and name(h):
            host[name(h)] += p
            domain[of(name(h))] += p
            whole += p
    out = []
    for (_, declared, suffix, h), (logs, n, fit, p) in zip(rows, soft):
        total = np.array(logs)
        if name(h) in host:
            base = (whole - p + 1) / (whole.sum() - p.sum() + m)
            d = domain[of(name(h))] - p
            d = (d + L.DOMAIN_WEIGHT * base) / (d.sum() + L.DOMAIN_WEIGHT)
            c = host[name(h)] - p
            total = total + np.log((c + L.HOST_WEIGHT * d) / (c.sum() + L.HOST_WEIGHT))
        else:
            total = total - math.log(m)
        for claim, right in ((declared and declared.lower(), L.DECLARED_RIGHT), (suffix, L.SUFFIX_RIGHT)):
            if claim in model.languages:
                total = total + np.log([right if y == claim else (1 - right) / (m - 1) for y in model.languages])
        e = np.exp(total - total.max())
        e /= e.sum()
        best = int(e.argmax())
        out.append((model.languages[best], e[best], bool(n > 0 and fit > model.floor and e[best] >= 0.5)))
    return out


def test_fusion_like_brute_force(spark):
    r = random.Random(8)
    say = lambda y, n: " ".join(r.choice(WORDS[y].split()) for _ in range(n))
    docs = spark.createDataFrame([(say(y, 30), y) for y in WORDS for _ in range(20)], "text string, lang string")
    model = L.train_text_model(docs)
    hosts = ["A.x.fr", "a.x.fr", "b.x.fr", "c.y.de", "localhost", "", None]
    rows = [(r.choice([say(r.choice(list(WORDS)), r.randint(1, 6)), "", None, "123", "a" * 50_000]), r.choice(["FR", "de", "xx", None]), r.choice(["fr", "it", None]), r.choice(hosts)) for _ in range(120)]
    rows += rows[:10]
    table = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, text string, declared string, suffix string, lang_found string")
    table = table.withColumn("host", F.col("lang_found"))
    found = L.identify_language(table, model, F.col("text"), F.col("declared"), F.col("suffix"), F.col("host")).orderBy("i").collect()
    for got, (language, posterior, accepted) in zip(found, by_brute_force(rows, model), strict=True):
        assert math.isclose(got.lang_posterior, posterior, abs_tol=1e-5)
        if posterior > 0.51:
            assert (got.lang_found, got.lang_accepted) == (language, accepted)
    assert L.identify_language(table.where("false"), model, F.col("text"), F.col("declared"), F.col("suffix"), F.col("host")).count() == 0
