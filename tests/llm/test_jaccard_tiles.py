import random

from debatelake.llm import jaccard_join as J
from debatelake.llm.common import WordHash


def group_of_copies(n, words=120, seed=5):
    """Texts of few edits of one text, pairs of which are near the threshold."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(r.randrange(6)):
            text[r.randrange(words)] = f"e{r.randrange(10_000)}"
        out.append(" ".join(text))
    return out


def by_brute_force(texts, width, num, den):
    memo = WordHash()
    sets = [set(J.shingles(t, width, memo).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and den * len(x & sets[j]) >= num * len(x | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(x), find(i)) for i, x in enumerate(sets)}


def test_large_group_in_tiles_like_brute_force(spark):
    texts = group_of_copies(150) + group_of_copies(40, seed=6) + ["", "a", "a b", "A b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5, "doc_id").sortWithinPartitions("doc_id")
    want = by_brute_force(texts, 3, 90, 100)
    assert 20 < len({c for _, c in want.values()}) < 150
    for tile in (8, 40, 1024):
        found = J.ngram_jaccard_join(docs, width=3, threshold=(90, 100), tile=tile).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want


def test_shingles_met_often_in_a_chunk(spark):
    r = random.Random(2)
    shared = " ".join(f"c{i}" for i in range(30))
    texts = [f"{shared} x{i} {' '.join(f'u{r.randrange(10**6)}' for _ in range(i % 3))}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = J.ngram_jaccard_join(docs, width=2, threshold=(8, 10)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in found} == by_brute_force(texts, 2, 8, 10)


def test_parities_bound_the_difference():
    r = random.Random(1)
    memo = WordHash()
    for n in (5, 300, 1500, 6000):
        words = [f"w{r.randrange(10**6)}" for _ in range(n)]
        other = list(words)
        for _ in range(n // 20):
            other[r.randrange(n)] = "x"
        x, y = J.shingles(" ".join(words), 3, memo), J.shingles(" ".join(other[: n - n // 8]), 3, memo)
        assert J.parity_gap(J.parities(x), J.parities(y)) <= len(set(x.tolist()) ^ set(y.tolist()))
