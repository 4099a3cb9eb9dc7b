"""URL filters: longest-rule verdicts, and logistic regression for the rest.

The model sees hashed character n-grams of the host and of the path and is
trained on the driver from a small labelled table of URLs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, col
from .url_table import ALLOW, BLOCK

_MULT = np.uint64(0x9E3779B97F4A7C15)

BITS = 16
#: Lengths of n-grams.
GRAMS = (3, 4, 5)
#: The share of URLs that are to be blocked, where the n-grams say nothing.
PRIOR = 0.1
#: URLs whose n-grams are taken at a time.
BATCH = 2_000


def training_urls() -> list[tuple[str, int]]:
    """The default labelled table (url, 1 for block)."""
    return [(u, 1) for u in BLOCK.split()] + [(u, 0) for u in ALLOW.split()]


def split_url(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path of a URL; both empty without ``://``."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[stop:]
    end = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return rest[:stop].encode().lower().decode(), path[:end]


def features(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashed n-grams of the marked hosts and paths, each n-gram once a row."""
    out = []
    for tag, texts in ((1, hosts), (2, paths)):
        marked = [f"^{t}$".encode() if t else b"" for t in texts]
        data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
        row = np.repeat(np.arange(len(marked), dtype=np.uint64), list(map(len, marked)))
        h = np.full(len(data), tag, np.uint64)
        for k in range(1, max(GRAMS) + 1):
            h = (h[: len(data) - k + 1] ^ data[k - 1 :]) * _MULT
            h ^= h >> np.uint64(29)
            if k in GRAMS:
                whole = row[: len(h)] == row[k - 1 :]
                out.append(row[: len(h)][whole] << np.uint64(BITS) | (h[whole] * _MULT) >> np.uint64(64 - BITS))
    found = np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)
    return (found >> np.uint64(BITS)).astype(np.int64), (found & np.uint64((1 << BITS) - 1)).astype(np.int64)


class UrlModel:
    """Logistic regression with weights in a table of 2**BITS, and a scale and offset of its margin."""

    def __init__(self, weights: np.ndarray, scale: float, bias: float):
        self.weights, self.scale, self.bias = weights, scale, bias

    def margins(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """The sum of the weights over the root of the number of n-grams that the training has seen."""
        row, gram = features(hosts, paths)
        known = self.weights[gram] != 0
        row, gram = row[known], gram[known]
        return np.bincount(row, weights=self.weights[gram], minlength=len(hosts)) / np.sqrt(np.maximum(np.bincount(row, minlength=len(hosts)), 1))

    def block_probabilities(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """A URL without n-grams that the training has seen is left to the prior."""
        parts = [self.margins(hosts[i : i + BATCH], paths[i : i + BATCH]) for i in range(0, len(hosts), BATCH)]
        return 1 / (1 + np.exp(-np.clip(self.scale * np.concatenate(parts) + self.bias, -30, 30))) if parts else np.empty(0)


def _weights(split: Sequence[tuple[str, str]], y: np.ndarray, steps: int, rate: float, ridge: float) -> np.ndarray:
    """Accelerated gradient descent on the logistic loss, in which both classes weigh the same."""
    w = np.zeros(1 << BITS)
    if not len(y) or y.min() == y.max():
        return w.astype(np.float32)
    row, gram = features(*zip(*split))
    scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(y)), 1))
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    v = w
    for step in range(steps):
        z = np.bincount(row, weights=v[gram], minlength=len(y)) * scale
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share * scale
        new = v - rate * (np.bincount(gram, weights=g[row], minlength=len(w)) + ridge * v)
        v, w = new + step / (step + 3) * (new - w), new
    return w.astype(np.float32)


def train_urls(labelled: Iterable[tuple[str, int]], steps: int = 300, rate: float = 4.0, ridge: float = 1e-5, prior: float = PRIOR, folds: int = 5) -> UrlModel:
    """Fit a model on (url, label) pairs; a table for the driver.

    The margin's scale and offset are fitted on margins of models that have
    not seen the URL's host, and the offset is then moved from even classes to
    the prior. Null labels are left out; without both classes the prior alone
    decides.
    """
    rows = [(split_url(u), y) for u, y in labelled if y is not None]
    split, y = [x for x, _ in rows], np.array([y for _, y in rows], float)
    at_prior = float(np.log(prior / (1 - prior)))
    weights = _weights(split, y, steps, rate, ridge)
    if not weights.any():
        return UrlModel(weights, 1.0, at_prior)
    fold = np.array([zlib.crc32(host.encode()) % folds for host, _ in split])
    margin = np.zeros(len(y))
    for f in range(folds):
        mine = np.nonzero(fold == f)[0]
        if len(mine):
            model = UrlModel(_weights([split[i] for i in np.nonzero(fold != f)[0]], y[fold != f], steps, rate, ridge), 1.0, 0.0)
            margin[mine] = model.margins(*zip(*(split[i] for i in mine)))
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    a, w = np.stack((margin, np.ones(len(y))), 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.clip(np.linalg.solve((a * (share * p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag([1e-5, 1e-9]), a.T @ (share * (p - y)) + np.array([1e-5, 0]) * w), -1, 1)
    return UrlModel(weights, max(float(w[0]), 0.0), float(w[1]) + at_prior)


def held_out_quality(labelled: Sequence[tuple[str, int]], folds: int = 4) -> tuple[float, float]:
    """Precision and recall at one half of models that have not seen the URL's host; folds are by hash of the host."""
    fold = [zlib.crc32(split_url(u)[0].encode(), 1) % folds for u, _ in labelled]
    found = np.zeros(len(labelled), bool)
    for f in range(folds):
        model = train_urls([x for x, g in zip(labelled, fold) if g != f])
        mine = [i for i, g in enumerate(fold) if g == f]
        split = [split_url(labelled[i][0]) for i in mine]
        found[mine] = model.block_probabilities([h for h, _ in split], [p for _, p in split]) >= 0.5
    y = np.array([y for _, y in labelled], bool)
    return float((found & y).sum() / max(found.sum(), 1)), float((found & y).sum() / max(y.sum(), 1))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """As ``split_url``, natively."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does.

    A rule is a host and a path joined, such as ``net/fr/``. It fits its host
    and all subdomains where the path starts with its own. Rules of the same
    length are tried in their order.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(enumerate(rules), key=lambda r: (len(r[1][1]), -r[0])):
        verdict, rule = rule
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], model: UrlModel | None = None, url_col: str = "url", keep: Iterable[str] | None = None) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``block_probability`` and ``verdict`` (allow or block).

    The rule decides if one fits, else the model does at one half. Null URLs
    and those without ``://`` have an empty host and path and go to the model,
    which allows them, as it has nothing but its prior to judge them by. Rows are independent;
    ``keep`` names the columns to carry, all by default, and columns named
    like the new ones are replaced.
    """
    model = model or train_urls(training_urls())
    shared = pages.sparkSession.sparkContext.broadcast((model.weights, model.scale, model.bias))
    new = ("host", "path", "rule", "block_probability", "verdict")
    carry = [c for c in (pages.columns if keep is None else keep) if c not in new]
    host, path = host_and_path(col(url_col))
    split = pages.select(*[col(c).alias(f"k{i}") for i, c in enumerate(carry)], host.alias("host"), path.alias("path"))

    def factory():
        model = UrlModel(*shared.value)
        return lambda rows: {"p": model.block_probabilities(rows["host"], rows["path"]).tolist()}

    scored = attach(split, {"host": "host", "path": "path"}, factory, {"p": pa.float64()}, split.columns)
    scored = scored.withColumn("r", rule_column(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("p") >= 0.5, "block").otherwise("allow"))
    return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(carry)], "host", "path", F.col("r.rule").alias("rule"), F.col("p").alias("block_probability"), verdict.alias("verdict"))
