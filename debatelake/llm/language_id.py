"""Language identification by Bayesian evidence fusion.

The posterior of a language combines four pieces of evidence: the likelihood
of the text under byte-trigram models, the language that the markup declares,
the language that the address suffix stands for, and the prior of the host.
Host priors are counted by grouped aggregation of the text posteriors and
smoothed through three levels: host, registered domain, all hosts. A row's own
posterior is taken out of all three, so that its text does not count twice.
Texts are scored once for the priors and once for the result, which takes less
than to write them in between.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, checkpointed, col, ship

#: Buckets of hashed trigrams.
BITS = 16
#: Distinct labelled texts taken of each language, the least by hash, to train the text models.
MAX_ROWS_A_LANGUAGE = 2_000
#: Languages whose trigram counts a task or the driver holds at a time.
LANGUAGE_BLOCK = 64
#: Trigrams beyond which a text gives no further evidence; they are far from independent.
TEXT_EVIDENCE = 60.0
#: Reliability of a declaration and of a suffix: the probability that it is right.
DECLARED_RIGHT, SUFFIX_RIGHT = 0.8, 0.7
#: Pseudo-documents that a domain lends its hosts, and all hosts lend a domain.
HOST_WEIGHT, DOMAIN_WEIGHT = 10.0, 10.0
#: Languages of address suffixes.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "ie": "en", "au": "en"}
#: Broadcast limit of the table of host priors, in bytes; beyond it the join shuffles.
BROADCAST_LIMIT = 32_000_000


def _trigrams(text: str | None) -> np.ndarray:
    """Hashed trigrams of the letters' bytes; other ASCII characters are one space."""
    data = np.frombuffer((" " + (text or "").lower() + " ").encode().translate(_LETTERS), np.uint8)
    data = data[np.concatenate(([True], (data[1:] != 32) | (data[:-1] != 32)))]
    if len(data) < 4:
        return np.empty(0, np.int64)
    x = data.astype(np.uint32)
    return ((((x[:-2] << 16) | (x[1:-1] << 8) | x[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class TextModel:
    """Smoothed trigram log-probabilities, a column for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.table = np.empty(counts.shape, np.float32)
        for i in range(0, counts.shape[1], LANGUAGE_BLOCK):
            p = counts[:, i : i + LANGUAGE_BLOCK] + 0.5
            self.table[:, i : i + LANGUAGE_BLOCK] = np.log(p / p.sum(0))
        #: least mean log-probability of a text in a language: that of evenly spread trigrams
        self.floor = float(-BITS * np.log(2))

    def score(self, text: str | None) -> tuple[list[float], int, float]:
        """Log-likelihoods with bounded weight, trigrams, and the best mean log-probability."""
        g = _trigrams(text)
        if not len(g):
            return [0.0] * len(self.languages), 0, self.floor
        total = np.zeros(len(self.languages))
        for i in range(0, len(g), 1 << 18):
            total += self.table[g[i : i + (1 << 18)]].sum(0, dtype=np.float64)
        mean = total / len(g)
        return (mean * min(len(g), TEXT_EVIDENCE)).tolist(), len(g), float(mean.max())


def train_text_model(docs: DataFrame, text_col: str = "text", label_col: str = "lang", max_rows: int = MAX_ROWS_A_LANGUAGE) -> TextModel:
    """Trigram models of every label from a sample of about max_rows of its distinct texts, the least by hash.

    The models take 256 KB a label; copies of a text count once.
    """
    ship(docs.sparkSession)
    rows = docs.select(col(text_col).alias("text"), col(label_col).alias("y")).where("text is not null and y is not null and y != ''")
    rows = rows.withColumn("h", F.xxhash64("text"))
    counts = rows.select("y", "h").distinct().groupBy("y").count().collect()
    if not counts:
        return TextModel(["und"], np.zeros((1 << BITS, 1)))
    languages = sorted(r.y for r in counts)
    at = {y: i for i, y in enumerate(languages)}
    # a threshold on the hash takes about max_rows texts of each label without a sort of the texts
    share = F.element_at(F.create_map(*[x for r in counts for x in (F.lit(r.y), F.lit(min(1.0, max_rows / r["count"])))]), F.col("y"))
    sample = rows.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))

    def first(batches):
        # a task's copies of a text go here, those of other tasks in the grouping
        seen = set()
        for batch in batches:
            new = []
            for key in zip(batch.column("y").to_pylist(), batch.column("h").to_pylist()):
                new.append(key not in seen)
                seen.add(key)
            if len(seen) >= 200_000:
                seen.clear()
            yield batch.filter(pa.array(new, pa.bool_()))

    once = sample.mapInArrow(first, sample.schema).groupBy("y", "h").agg(F.first("text").alias("text"))

    def run(batches):
        sums: dict[int, np.ndarray] = {}

        def out():
            for y, s in sums.items():
                b = np.nonzero(s)[0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), y, np.int32)), pa.array(b.astype(np.int32)), pa.array(s[b])], names=["y", "b", "n"])
            sums.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                y = at[batch.column("y")[i].as_py()]
                if y not in sums and len(sums) >= LANGUAGE_BLOCK:
                    yield from out()
                g = np.bincount(_trigrams(batch.column("text")[i].as_py()), minlength=1 << BITS)
                sums[y] = sums[y] + g if y in sums else g
        yield from out()

    found = once.mapInArrow(run, "y int, b int, n long").groupBy("y", "b").agg(F.sum("n").alias("n"))
    found = checkpointed(found) if len(languages) > LANGUAGE_BLOCK else found
    table = np.zeros((1 << BITS, len(languages)), np.float32)
    for i in range(0, len(languages), LANGUAGE_BLOCK):
        rows = found.where(F.col("y").between(i, i + LANGUAGE_BLOCK - 1)).toArrow()
        table[rows.column("b").to_numpy(), rows.column("y").to_numpy()] = rows.column("n").to_numpy()
    return TextModel(languages, table)


def _evidence(name: Column, languages: list[str], right: float) -> Column:
    """Log-likelihood of a claim by language; none if it is missing or names no known language."""
    wrong = (1 - right) / max(1, len(languages) - 1)
    known = F.coalesce(name.isin(languages), F.lit(False))
    names = F.array(*[F.lit(y) for y in languages])
    return F.transform(names, lambda y: F.when(~known, 0.0).when(name == y, float(np.log(right))).otherwise(float(np.log(max(wrong, 1e-9)))))


def _posterior(logs: Column) -> Column:
    """Shares by their logarithms; the total is passed in, as a lambda would take it anew for each element."""
    e = F.transform(logs, lambda x: F.exp(x))
    whole = F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda a, x: a + x).alias("total"))
    return F.flatten(F.transform(F.array(whole), lambda w: F.transform(w["e"], lambda x: x / w["total"])))


def _levelled(logs: Column) -> Column:
    """Logarithms with 0 as the greatest."""
    return F.flatten(F.transform(F.array(F.struct(logs.alias("l"), F.array_max(logs).alias("top"))), lambda w: F.transform(w["l"], lambda x: x - w["top"])))


def _add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _sums(group: DataFrame, keys: list[str], m: int) -> DataFrame:
    return group.groupBy(*keys).agg(F.array(*[F.sum(F.col("p")[i]) for i in range(m)]).alias("counts"))


def host_counts(soft: DataFrame, m: int) -> tuple[DataFrame, list[float]]:
    """Rows (host, hc, hs, dc, ds): soft counts of languages of a host and of its domain, and their sums; and counts of all hosts."""
    total = lambda c: sum((F.col(c)[i] for i in range(1, m)), F.col(c)[0])
    hosts = checkpointed(_sums(soft.where("host is not null and host != ''"), ["host", "domain"], m).withColumnRenamed("counts", "hc"))
    domains = hosts.groupBy("domain").agg(F.array(*[F.sum(F.col("hc")[i]) for i in range(m)]).alias("dc"))
    whole = hosts.agg(*[F.coalesce(F.sum(F.col("hc")[i]), F.lit(0.0)).alias(f"n{i}") for i in range(m)]).first()
    return hosts.join(domains, "domain").select("host", "hc", total("hc").alias("hs"), "dc", total("dc").alias("ds")), list(whole)


def _with_prior(rows: DataFrame, whole: list[float]) -> DataFrame:
    """Add ``prior``: a host's shares of languages without a row's own part, smoothed to its domain's and those to all hosts'.

    A row's own part is its posterior ``own``, which sums to ``one``.
    """
    every, size = F.array(*[F.lit(float(x)) for x in whole]), float(sum(whole) + len(whole))
    less = lambda n, p: F.greatest(n - p, F.lit(0.0))
    share = lambda weight, sums: lambda n, p: less(n, p) / (F.col(sums) - F.col("one") + weight)
    smooth = lambda weight, sums: lambda x, q: x + weight * q / (F.col(sums) - F.col("one") + weight)
    rows = rows.withColumn("base", F.zip_with(every, "own", lambda n, p: (less(n, p) + 1) / (F.lit(size) - F.col("one"))))
    for counts, sums, weight, lower, name in (("dc", "ds", DOMAIN_WEIGHT, "base", "dp"), ("hc", "hs", HOST_WEIGHT, "dp", "prior")):
        rows = rows.withColumn("_own", F.zip_with(counts, "own", share(weight, sums)))
        rows = rows.withColumn(name, F.zip_with("_own", lower, smooth(weight, sums)))
    return rows.drop("_own")


def identify_language(
    rows: DataFrame,
    model: TextModel,
    text: Column,
    declared: Column,
    suffix: Column,
    host: Column,
    keep: Iterable[str] | None = None,
    least_posterior: float = 0.5,
) -> DataFrame:
    """Add ``lang_found``, ``lang_posterior``, ``lang_text`` and ``lang_accepted``.

    ``declared``, ``suffix`` and ``host`` may be null, which is no evidence;
    hosts in any case are one. ``lang_text`` is what the text alone says. A
    row is rejected if its text has no letters, if its trigrams are likelier
    evenly spread than in any language, or if the posterior is under the
    least. Ties fall to the first language by name. ``keep`` names the columns
    to carry, all by default; columns named like the new ones are replaced.
    """
    ship(rows.sparkSession)
    new = ("lang_found", "lang_posterior", "lang_text", "lang_accepted")
    carry = [c for c in (rows.columns if keep is None else keep) if c not in new]
    held = rows.select(*[col(c).alias(f"k{i}") for i, c in enumerate(carry)], text.alias("t"), F.lower(declared).alias("declared"), suffix.alias("suffix"), F.lower(host).alias("host"))
    shared = rows.sparkSession.sparkContext.broadcast(model)
    languages, m = model.languages, len(model.languages)

    def factory():
        model = shared.value

        def work(rows):
            out = [model.score(t) for t in rows["t"]]
            return {"logs": [x[0] for x in out], "n": [x[1] for x in out], "fit": [x[2] for x in out]}

        return work

    scored = attach(held, {"t": "t"}, factory, {"logs": pa.list_(pa.float64()), "n": pa.int64(), "fit": pa.float64()}, [c for c in held.columns if c != "t"])
    return _fused(scored, languages, m, carry, model.floor, least_posterior)


def _fused(scored: DataFrame, languages: list[str], m: int, carry: list[str], floor: float, least: float) -> DataFrame:
    scored = scored.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1))
    flat, nothing = F.array(*[F.lit(float(-np.log(m)))] * m), F.array(*[F.lit(0.0)] * m)
    counts, whole = host_counts(scored.where("n > 0").select("host", "domain", _posterior(_levelled(F.col("logs"))).alias("p")), m)
    counts = checkpointed(counts)
    if counts.count() * (16 * m + 272) <= BROADCAST_LIMIT:
        counts = F.broadcast(counts)
    # a hot host's rows are split by adaptive execution if the counts are too many to broadcast
    joined = scored.join(counts, "host", "left")
    joined = joined.withColumns({"own": F.when(F.col("n") > 0, _posterior(_levelled(F.col("logs")))).otherwise(nothing), "one": (F.col("n") > 0).cast("double")})
    joined = _with_prior(joined, whole)
    prior = F.coalesce(F.transform("prior", lambda p: F.log(p)), flat)
    logs = _add(_add(F.col("logs"), prior), _add(_evidence(F.col("declared"), languages, DECLARED_RIGHT), _evidence(F.col("suffix"), languages, SUFFIX_RIGHT)))
    joined = joined.withColumn("post", _posterior(_levelled(logs))).withColumn("top", F.array_max("post"))
    names = F.array(*[F.lit(y) for y in languages])
    found = F.element_at(names, F.array_position("post", F.col("top")).cast("int"))
    alone = F.element_at(names, F.array_position("logs", F.array_max("logs")).cast("int"))
    return joined.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(carry)],
        found.alias("lang_found"),
        F.col("top").alias("lang_posterior"),
        F.when(F.col("n") > 0, alone).alias("lang_text"),
        ((F.col("n") > 0) & (F.col("fit") > floor) & (F.col("top") >= least)).alias("lang_accepted"),
    )


def declared_language(html: Column) -> Column:
    """The primary tag of the html element's lang attribute; null without one."""
    found = F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return F.when(found != "", F.lower(found))


def url_host(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)
    return F.when(found != "", F.lower(found))


def suffix_language(host: Column) -> Column:
    """The language of the last label of a host."""
    table = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    return F.try_element_at(table, F.regexp_extract(host, r"\.([a-z]+)$", 1))


def page_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags become spaces, entities too."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#a-zA-Z0-9]+;", " ")
    return F.coalesce(bare, F.lit(""))
