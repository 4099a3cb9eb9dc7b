import random
from collections import Counter

from debatelake.llm import license_scan as L
from debatelake.llm.decontaminate import words

GPL = """This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version."""


def prose(r, n):
    return " ".join(r.choice("rule stone river paper light night garden window the of and to in".split()) for _ in range(n))


def test_best_passage_like_brute_force():
    r = random.Random(4)
    templates = L.TEMPLATES[:8]
    vocabulary = {w: r.randrange(1, 900) for w in L.vocabulary(templates)}
    matcher = L.Matcher(templates, vocabulary, 1000)
    texts = [prose(r, 50) + " " + t + " " + prose(r, 30) for _, t in templates] + [prose(r, 200), "", "license", GPL]
    for text in texts:
        ws = words(text)
        every = []
        for name, template in templates:
            v, norm = matcher.vector(words(template))
            k = len(words(template))
            for i in range(max(1, len(ws))):
                x, other = matcher.vector(ws[i : i + k])
                every.append((sum(x[w] * v.get(w, 0) for w in x) / norm / other, name))
        want = max(every, key=lambda e: e[0])
        got = matcher.best(ws)
        # the passage taken may be a few words off the best one
        assert (got[1] is not None) == (want[0] >= 0.75) or abs(want[0] - 0.75) < 0.05
        if got[1]:
            assert got[0] <= want[0] + 1e-9 and got[0] >= want[0] - 0.05


def test_notices_over_lines_in_paragraphs_and_in_long_files(spark):
    r = random.Random(1)
    apache = "Licensed under the Apache License, Version 2.0"
    files = [
        ("a/COPYING", GPL + "\n" + prose(r, 3000)), ("a/x.c", prose(r, 40)), ("a/b/y.c", f"{prose(r, 30)} {apache} {prose(r, 30)}"),
        ("c/notes.txt", GPL), ("c/z.c", prose(r, 20)), ("d/LICENSE", prose(r, 90)), ("d/w.c", "x"), ("long/q.c", prose(r, 100_000) + " " + apache), ("a/x.c", prose(r, 40)), ("a/e.c", ""), (None, None),
    ]
    table = spark.createDataFrame(files, "path string, text string").selectExpr("*", "'old' as license", "1 as license_dir")
    got = [(x.path, x.license, x.license_from, x.license_dir) for x in L.scan_licenses(table).collect()]
    assert Counter(x[0] for x in got) == Counter(p for p, _ in files)
    found = {x[0]: x[1:] for x in got}
    assert found["a/COPYING"] == ("GPL-2.0", "file", "a") and found["a/x.c"] == ("GPL-2.0", "inherited", "a") == found["a/e.c"]
    assert found["a/b/y.c"][:2] == ("Apache-2.0", "header") and found["c/notes.txt"][:2] == ("GPL-2.0", "header")
    assert found["c/z.c"] == found["d/LICENSE"] == found["d/w.c"] == found[None] == (None, None, None)
    assert found["long/q.c"][:2] == ("Apache-2.0", "header")
    assert L.scan_licenses(table.where("false")).count() == 0
