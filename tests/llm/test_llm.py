import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from debatelake.llm import decontaminate, jaccard_join, kd_shards, language_id, license_scan, piece_codec, secrets, spotsigs, toxicity, url_filter
from debatelake.llm.queries import URL_RULES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def sentence(r, n):
    return " ".join(r.choice("red blue green old new tall small house river stone cloud light night paper glass the of and to".split()) for _ in range(n))


def test_urls(spark):
    urls = ["https://A.com/x?y", "http://example.com/en/1", "http://www.example.com/en/1", "http://x.net/es/2#t", None, "no scheme", "http://m.casino-win.example.org/de/1", "http://library.example.org/de/1", "http://b.com"]
    rows = url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string"), URL_RULES).orderBy("page_id").collect()
    assert [(r.host, r.path) for r in rows] == [url_filter.split_url(u) for u in urls]
    assert [r.rule for r in rows] == ["com/", "example.com/en/", "www.example.com/en/", "net/es/", None, None, None, None, None]
    assert [r.verdict for r in rows] == ["allow", "block", "allow", "block", "allow", "allow", "block", "allow", "allow"]


def test_licenses(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [("a/LICENSE", mit), ("a/b/x.py", "plain words"), ("a/b/c/y.py", f"code of a file that does more\n{apache}\nand then some other things"), ("z/q.py", None), (None, "text"), ("a/b/c/z.py", "")]
    got = {r.path: (r.license, r.license_from, r.license_dir) for r in license_scan.scan_licenses(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["a/LICENSE"] == ("MIT", "file", "a") and got["a/b/x.py"] == ("MIT", "inherited", "a")
    assert got["a/b/c/y.py"][:2] == ("Apache-2.0", "header") and got["a/b/c/z.py"] == ("MIT", "inherited", "a")
    assert got["z/q.py"] == (None, None, None) and got[None] == (None, None, None)


@pytest.mark.parametrize("block", [200, 10**6])
def test_decontamination_by_brute_force(spark, block):
    r = random.Random(1)
    items = [(i, sentence(r, r.choice([3, 13, 20, 40]))) for i in range(6)] + [(6, None), (7, "!!")]
    texts = [sentence(r, 30) + " " + items[i % 6][1].upper() + ". " + sentence(r, r.choice([0, 300])) for i in range(12)] + [None, "", "zzz"]
    found = decontaminate.contamination(decontaminate.find_benchmark(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string"), block_chars=block))
    for row in found.collect():
        w, hit, ids = decontaminate.words(texts[row.doc_id]), set(), set()
        for i, t in items:
            x = decontaminate.words(t)
            k = min(13, len(x))
            wins = {tuple(x[j : j + k]) for j in range(len(x) - k + 1)} if x else set()
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in wins:
                    hit.update(range(p, p + k))
                    ids.add(i)
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (len(w), len(hit), len(ids), decontaminate.items_digest(ids))
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert decontaminate.find_benchmark(docs_of(spark, texts), spark.createDataFrame([], "item_id long, text string")).where("size(items) > 0").count() == 0


def test_secrets(spark):
    r = random.Random(2)
    alphabet = secrets.ENCODINGS[5][1]
    keys = ["".join(r.choice(alphabet) for _ in range(40)) for _ in range(60)]
    texts = [f"é word {k} end" for k in keys] + ["é API_KEY = 'abc123xyz' AKIA" + "A1" * 9, "token: abc", "0123456789abcdef01234567", None, "", "aB1" * 12]
    found = {x.doc_id: x for x in secrets.secret_report(secrets.scan_secrets(docs_of(spark, texts), mask="#")).collect()}
    assert sum(found[i].spans == "random:7:47" for i in range(60)) >= 55
    n = 60
    assert found[n].spans.startswith("assign:2:22,access:") and (found[n].n_assign, found[n].n_access) == (1, 1) and found[n].redacted == "é #' #"
    assert found[n + 1].spans == "" and found[n + 2].spans == "hex:0:24" and found[n + 3].redacted is None
    assert found[n + 5].spans == "" and found[n + 4].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_toxicity(spark):
    r = random.Random(3)
    rows = [(i, sentence(r, r.randint(5, 80)) + (" you vile rotworm " + sentence(r, 5) if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame([*rows, (400, None), (401, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    held = [x for x in got if x.held_out and x.doc_id < 400]
    assert len(got) == 402 and all(0 <= x.score <= 1 for x in got)
    assert np.mean([x.predicted == (x.doc_id % 4 == 0) for x in held]) >= 0.95
    assert toxicity.score_toxicity(docs, labels.where("false")).count() == 402


def test_piece_codec_is_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, codec = sentencepiece.SentencePieceProcessor(model_file=str(path)), piece_codec.PieceCodec(open(path, "rb").read())
    r = random.Random(4)
    pieces = list(codec.id_of)
    texts = ["", " ", "a▁b", "\x00x", "é€😀\n\t x", " " * 40 + "a", "<0x41></s>", "x" * 6000, "m².²"]
    texts += ["".join(r.choice(" ▁abcdeéßtheonr\n\t$%ñ0123ABC日本😀_-/.,²") for _ in range(r.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(r.choice(pieces) for _ in range(r.randint(0, 8))) for _ in range(3000)]
    for t in texts:
        ids = codec.encode(t)
        want = sp.encode(t, add_bos=True, add_eos=True)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want and codec.decode(ids) == sp.decode(want)
    bad = struct.pack("<5I", 1, codec.bytes_ids[0xE2], codec.bytes_ids[0x82], codec.bytes_ids[0x41], 2)
    assert codec.decode(bad) == sp.decode(list(struct.unpack("<5I", bad)))
    row = piece_codec.encode_pieces(docs_of(spark, ["ab c", None]), str(path)).orderBy("doc_id").collect()
    assert row[0].decoded == "ab c" and row[1].ids == [1, 2]


def test_spotsigs(spark):
    r = random.Random(5)
    texts = [sentence(r, 60), sentence(r, 60), None, "", "x", sentence(r, 61)] + [sentence(r, r.randint(1, 50)) for _ in range(30)]
    texts[1] = texts[0]
    got = {x.doc_id: x for x in spotsigs.compare_with_next(docs_of(spark, texts), partitions=5).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        nxt = texts[(i + 1) % len(texts)] or ""
        new = spotsigs.edited(t or "", nxt)
        assert got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and got[i].n_chars == len(t or "")
        memo = spotsigs.WordHash(spotsigs.ANCHORS)
        a, b, c = (spotsigs.signatures(x, memo) for x in (t, new, nxt))
        assert got[i].fingerprint == spotsigs.to_text(a) and got[i].near_edited == spotsigs.jaccard(a, b) and got[i].near_next == spotsigs.jaccard(a, c)
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1
    classes = {x.doc_id: x.class_id for x in spotsigs.near_duplicates(docs_of(spark, texts)).collect()}
    assert classes[0] == classes[1] == 0 and classes[2] == 2
    assert spotsigs.compare_with_next(docs_of(spark, ["solo text here"])).first().near_next == 1


def test_languages(spark):
    words = {"en": "the of house and river was", "de": "der und haus fluß war nicht", "fr": "le et maison rivière était pas"}
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(words[y].split()) for _ in range(20)), y, f"h{i % 3}.a.org", 0) for i, y in enumerate(["en", "de", "fr"] * 40)]
    docs = spark.createDataFrame(rows + [(500, None, None, None, 0), (501, "12 $$", "en", "h", 0)], DOCS)
    model = language_id.train_text_model(docs)
    got = {x.doc_id: x for x in language_id.identify_language(docs, model, F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.col("source")).collect()}
    assert all(got[i].lang_found == y and got[i].lang_accepted for i, _, y, _, _ in rows)
    assert not got[500].lang_accepted and not got[501].lang_accepted
    html = spark.createDataFrame([("<html lang='fr-CA'><p>x</p>", "https://a.DE:80/x")], "h string, u string")
    x = html.select(language_id.declared_language(F.col("h")).alias("d"), language_id.url_host(F.col("u")).alias("o")).first()
    assert x.d == "fr" and x.o == "a.de:80"


def groups_by_force(texts, width, num, den):
    memo = jaccard_join.WordHash()
    sets = [set(jaccard_join.shingles(t, width, memo).tolist()) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            m = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * m >= num * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: (len(sets[i]), root(i)) for i in range(len(texts))}


@pytest.mark.parametrize(("width", "num", "den"), [(3, 90, 100), (5, 8, 10), (1, 5, 10)])
def test_jaccard_join_by_brute_force(spark, width, num, den):
    r = random.Random(7)
    base = [" ".join(f"w{r.randrange(400)}" for _ in range(r.choice([2, 30, 120, 400]))) for _ in range(25)]
    texts = list(base)
    for _ in range(90):
        w = r.choice(base).split()
        for _ in range(r.choice([0, 1, 1, 2, 4, 8])):
            w[r.randrange(len(w))] = f"n{r.randrange(999)}"
        texts.append(" ".join(w))
    texts += [None, "", "  ", "A b", "a B"]
    docs = docs_of(spark, texts).withColumn("v", F.lit(1)).withColumn("text2", F.lit("x"))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.ngram_jaccard_join(docs.repartition(5), width=width, threshold=(num, den)).collect()}
    assert got == groups_by_force(texts, width, num, den)
    assert jaccard_join.ngram_jaccard_join(docs.where("false"), width=width).count() == 0


def test_kd_shards(spark):
    r = random.Random(8)
    texts = [sentence(r, r.randint(1, 60)) for _ in range(1500)] + ["copy of one"] * 60 + [None, ""]
    rows = kd_shards.shard_documents(docs_of(spark, texts), 16).collect()
    size, slots, place = {}, {}, {}
    for x in rows:
        size[x.shard] = size.get(x.shard, 0) + x.size
        slots.setdefault(x.shard, []).append(x.slot)
        assert place.setdefault(texts[x.doc_id] or "", x.shard) == x.shard and x.size == len((texts[x.doc_id] or "").encode()) + 1
    assert set(size) == set(range(16)) and max(size.values()) < 1.1 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert kd_shards.shard_documents(docs_of(spark, texts).where("false")).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(9)
    item = sentence(r, 30)
    texts = [sentence(r, 80) for _ in range(30)]
    texts += [texts[0], texts[1] + " end", "intro " + item, texts[5] + " token = 'abcdef123456'", "$$ 12", None]
    docs_of(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {x.doc_id for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(range(30)) <= got and not got & {30, 31, 32, 34, 35}
