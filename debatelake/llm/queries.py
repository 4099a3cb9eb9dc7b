"""One query for each corpus operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import contamination, find_benchmark
from .jaccard_join import ngram_jaccard_join
from .kd_shards import shard_documents
from .language_id import declared_language, identify_language, page_text, suffix_language, train_text_model, url_host
from .license_scan import scan_licenses
from .piece_codec import encode_digests
from .secrets import scan_secrets, secret_report
from .spotsigs import compare_with_next
from .toxicity import score_toxicity
from .url_filter import filter_urls

#: The rules of the URL query.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: The model file of the encoding query.
PIECE_MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(PIECE_MODEL))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, keep=["page_id"]).select("page_id", "host", "path", "rule", "verdict", "block_probability")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``number/source/lang/doc_id.txt``, ten to a number; the first of them is ``number/LICENSE``."""
    project, own = F.floor(F.col("doc_id") / 10), F.concat("doc_id", F.lit(".txt"))
    path = F.when(F.col("doc_id") % 10 == 0, F.concat_ws("/", project, F.lit("LICENSE"))).otherwise(F.concat_ws("/", project, "source", "lang", own))
    docs = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return scan_licenses(docs, keep=["doc_id", "path"])


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_report(scan_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"]))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), piece_model_path())


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, by models of text learned from the documents' languages."""
    pages = table(spark, sf_dir, "pages")
    model = train_text_model(table(spark, sf_dir, "documents"))
    html, host = F.col("html"), url_host(F.col("url"))
    return identify_language(pages, model, page_text(html), declared_language(html), suffix_language(host), host, keep=["page_id"])


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"), width=3, threshold=(90, 100))


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 16)


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the URL query that rules alone decide."""
    return op1_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict"))


def secret_base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the secret query without the method's spans."""
    return op4_secret_scan(spark, sf_dir).drop("spans")


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the fingerprint query that depend on the texts alone."""
    return op7_spotsigs(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def shard_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's size in the shard query; whether its shard's slots are gapless and its size is near the others."""
    out = op10_kd_shards(spark, sf_dir)
    shards = out.groupBy("shard").agg(F.count("*").alias("rows"), F.min("slot").alias("least"), F.max("slot").alias("most"), F.countDistinct("slot").alias("slots"))
    good = shards.where("least = 0 and most = rows - 1 and slots = rows").select("shard", F.lit(True).alias("gapless"))
    return out.join(F.broadcast(good), "shard", "left").select("doc_id", "size", "law", F.coalesce("gapless", F.lit(False)).alias("gapless"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_filter, op2_license_scan, op3_decontaminate, op4_secret_scan, op5_toxicity, op6_piece_codec, op7_spotsigs, op8_language_id, op9_jaccard_join, op10_kd_shards, url_rules, secret_base_columns, edited_texts, shard_slots)
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all(coalesce({_LOWER}, ''), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

_RULES = " ".join(
    f"when (host = '{rule.partition('/')[0]}' or ends_with(host, '.{rule.partition('/')[0]}')) and starts_with(path, '/{rule.partition('/')[2]}') then '{{{i}}}'"
    for i, (_, rule) in sorted(enumerate(URL_RULES), key=lambda r: -len(r[1][1]))
)
#: Patterns of the base kinds with the least length of what they must hold, and of which group.
_BASE = (("assign", r"(?i:password|passwd|secret|token|api_?key)[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 1, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))
_FOUND = " union all ".join(f"select doc_id, {i} as k, '{kind}' as kind, {least} as least, regexp_extract_all(t, '{p}') as whole, regexp_extract_all(t, '{p}', {group}) as held, regexp_split_to_array(t, '{p}') as rest from d" for i, (kind, p, group, least) in enumerate(_BASE))

ORACLES: dict[str, str] = {
    "op3_decontaminate": f"""
with items as (select item_id, {_WORDS} as w from benchmark),
wins as (
  select distinct item_id, least(len(w), 13) as k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as g
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from items where len(w) > 0)),
docs as (select doc_id, {_WORDS} as w from documents),
grams as (
  select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from docs, (select distinct k from wins) where len(w) >= k)),
hits as (select doc_id, item_id, i, wins.k as k from grams join wins on grams.k = wins.k and grams.g = wins.g),
n_hits as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + k)) as p from hits) group by 1),
found as (select doc_id, count(*) as n, string_agg(s, ',' order by s) as s from (select distinct doc_id, cast(item_id as varchar) as s from hits where item_id is not null) group by 1)
select docs.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hits.n, 0) as n_hit, coalesce(found.n, 0) as n_items,
  sha256(coalesce(found.s, '')) as items_sha256, coalesce(n_hits.n, 0) > 0 and 20 * coalesce(n_hits.n, 0) >= len(w) as contaminated
from docs left join n_hits using (doc_id) left join found using (doc_id)
""",
    "op9_jaccard_join": f"""
with recursive docs as (select doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
grams as (
  select distinct doc_id, hash(array_to_string(w[i:i + least(len(w), 3) - 1], ' ')) as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from docs where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by 1),
links as (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as m from grams x join grams y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2)
  join sizes s on s.doc_id = a join sizes t on t.doc_id = b where 100 * m >= 90 * (s.n + t.n - m)),
reach as (select doc_id, doc_id as root from docs union select b, root from reach join links on a = doc_id)
select docs.doc_id, coalesce(any_value(sizes.n), 0) as n_shingles, min(root) as component_id
from docs left join sizes using (doc_id) join reach using (doc_id) group by 1
""",
    "url_rules": f"""
with u as (select page_id, case when url like '%://%' then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
s as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path from u)
select page_id, host, path, case {_RULES.format(*(rule for _, rule in URL_RULES))} end as rule, case {_RULES.format(*(verdict for verdict, _ in URL_RULES))} end as rule_verdict from s
""",
    "secret_base_columns": f"""
with d as (select doc_id, coalesce(text, '') as t from documents), f as ({_FOUND}),
x as (select doc_id, k, kind, least, unnest(range(1, len(whole) + 1)) as i, whole, held, rest from f),
y as (select doc_id, k, kind, length(whole[i]) as n, length(held[i]) >= least as ok, list_sum(list_transform(rest[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda s: length(s))), 0) as a from x),
z as (select doc_id, kind, k, cast(a as bigint) as a, cast(a + n as bigint) as b from y where ok)
select d.doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
  sha256(coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, k), '')) as base_sha256 from d left join z using (doc_id) group by 1
""",
    "edited_texts": """
with d as (select doc_id, coalesce(text, '') as t, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id), '') as f, lead(doc_id) over (order by doc_id) is not null as later, lead(text) over (order by doc_id) as l from documents),
e as (select doc_id, t, case when later then coalesce(l, '') else f end as f, cast(floor(length(t) / 2) as bigint) as h from d)
select doc_id, cast(length(t) as bigint) as n_chars, sha256(substr(t, 1, length(t) - h) || substr(f, 1, h)) as edited_sha256 from e
""",
    "shard_slots": "select doc_id, cast(octet_length(encode(coalesce(text, ''))) + 1 as bigint) as size, 'bytes' as law, true as gapless from documents",
}
