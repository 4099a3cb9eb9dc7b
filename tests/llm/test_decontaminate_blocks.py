import random

import pytest

from debatelake.llm import decontaminate

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def words(r, n):
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


@pytest.mark.parametrize("block", [200, 10**6])
def test_an_item_with_texts_in_several_blocks_is_one_item(spark, block):
    r = random.Random(1)
    texts = [words(r, 30) for _ in range(8)]
    items = spark.createDataFrame([(5 if i < 6 else i, t) for i, t in enumerate(texts)], "item_id long, text string")
    found = decontaminate.contamination(decontaminate.find_benchmark(docs_of(spark, [(1, " ".join(texts))]), items, block_chars=block))
    row = found.first()
    assert (row.n_items, row.items_sha256) == (3, decontaminate.items_digest([5, 6, 7]))
