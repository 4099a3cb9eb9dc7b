"""A cleaning pipeline over ``documents`` from the corpus operators.

Each stage gets what the one before it kept. All but the last return the
columns of documents; the last returns the documents' tokens as digests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debatelake.llm.common import checkpointed, shared_folder
from debatelake.llm.decontaminate import WINDOW, contamination, find_benchmark
from debatelake.llm.jaccard_join import ngram_jaccard_join
from debatelake.llm.language_id import identify_language, train_text_model
from debatelake.llm.piece_codec import encode_digests
from debatelake.llm.queries import piece_model_path, table
from debatelake.llm.secrets import scan_secrets

#: What stands in a text for a secret.
SECRET_MASK = "[SECRET]"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; ``lang`` counts as declared, ``source`` as the host.

    Null, empty and letterless texts go, as do texts whose language stays
    doubtful. A null ``lang`` or ``source`` is no evidence, and without any
    label every text stays that has letters. Each of repeated rows is judged
    alike; an empty table gives none.
    """
    model = train_text_model(docs)
    none = F.lit(None).cast("string")
    found = identify_language(docs, model, F.col("text"), F.col("lang"), none, F.col("source"))
    return found.where("lang_accepted").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least id of each group linked by five-word shingles at 0.8.

    Rows are told apart by id and text: rows that repeat an id are judged each
    by its own text, and a null id comes after all others. Of one id's rows in
    a group the one with the least hash stays, and of equal rows any one. Each
    row without words or links is a group of its own.
    """
    keyed = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    groups = ngram_jaccard_join(keyed, "row_key", width=5, threshold=(8, 10))
    groups = groups.groupBy("row_key").agg(F.first("component_id").alias("component_id"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("copies"))
    ids = keyed.groupBy("row_key").agg(F.min("doc_id").alias("doc_id"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    least = groups.where("n_shingles > 0").join(ids, "row_key").groupBy("component_id").agg(F.min_by(F.struct("row_key", "copies"), order).alias("kept"))
    # rows without words all stay, so their copies do not count
    kept = checkpointed(least.select("kept.*").union(groups.where("n_shingles = 0").select("row_key", F.lit(1).cast("long"))))
    single = keyed.join(kept.where("copies = 1").select("row_key"), "row_key", "left_semi").select(*docs.columns)
    equal = keyed.join(kept.where("copies > 1").select("row_key"), "row_key", "left_semi").select(*docs.columns)
    return single.union(equal.dropDuplicates(["doc_id", "text"]))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage: a whole window of an item in a row, or shorter items that make up a twentieth.

    Null and empty texts hold no passage and stay. Each of repeated rows is
    judged alike; an empty benchmark keeps every row, an empty table gives none.
    """
    found = contamination(find_benchmark(docs, table(spark, sf_dir, "benchmark")))
    whole = F.exists("hit_spans", lambda s: s["end"] - s["start"] >= WINDOW)
    return found.where(~(F.col("contaminated") | whole)).select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask for each secret and ``n_chars`` of the new text.

    Null texts stay null, and a text without secrets keeps its ``n_chars``,
    null ones too. Repeated rows stay; an empty table gives none.
    """
    found = scan_secrets(docs, mask=SECRET_MASK)
    changed = F.size("secret_spans") > 0
    found = found.withColumn("n_chars", F.when(changed, F.length("redacted").cast("long")).otherwise(F.col("n_chars"))).withColumn("text", F.col("redacted"))
    return found.select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the text that they decode to.

    A null text counts as empty and has the begin and end ids alone. Repeated
    rows and null ids stay; an empty table gives none.
    """
    return encode_digests(docs, piece_model_path())


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("tokens", token_stage),
]

#: SQL cannot express the models of the first and the encoder of the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared checkpoint folder and gone once the next is."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        before = f"{folder}/{name}"
    return docs
