import random
import zlib

from debatelake.llm import kd_shards as K


def test_laws_of_shards_over_odd_rows(spark):
    r = random.Random(6)
    texts = ["x" * r.randrange(400) for _ in range(300)] + ["same text"] * 60 + [None, "", "é" * 100_000]
    rows = [(None if i % 50 == 0 else i // 2, t, "old", 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, size int").repartition(5)
    got = K.shard_documents(docs, 4).collect()
    assert sorted((str(x.doc_id), x.size, x.text_crc32) for x in got) == sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert {x.shard for x in got} <= set(range(4)) and {x.law for x in got} == {"bytes"}
    for s in range(4):
        assert sorted(x.slot for x in got if x.shard == s) == list(range(sum(x.shard == s for x in got)))
    assert len({x.shard for x in got if x.text_crc32 == zlib.crc32(b"same text")}) == 1
    assert K.shard_documents(docs.where("false"), 4).count() == 0


def test_shards_of_near_equal_weight(spark):
    r = random.Random(2)
    docs = spark.createDataFrame([(i, "w" * r.randrange(1, 900)) for i in range(4000)], "doc_id long, text string")
    got = K.shard_documents(docs, 16).groupBy("shard").sum("size").collect()
    sizes = [x[1] for x in got]
    assert len(sizes) == 16 and max(sizes) <= 1.05 * min(sizes)
