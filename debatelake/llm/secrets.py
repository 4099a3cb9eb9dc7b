"""Secret scans: fixed patterns, and strings that pass for random ones.

A long unbroken token is held against the alphabet that its characters infer.
Under the hypothesis that it is a uniform random string, chi-squared tests of
its symbols and of its character classes, a runs test about the median and a
lag-1 serial correlation test give p-values, which Sidak's rule combines.
Ordinary tokens pile up near 0 and random ones spread evenly over 0 to 1.
For each class of length and encoding, counts of the corpus's distinct tokens
estimate how many of those above a p-value are false finds; the least p-value
that keeps their share within the level is that class's threshold. Classes
with few tokens borrow the counts of the nearest lengths.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterable

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, col, ship

KINDS = ("assign", "access", "hex", "random")
#: The patterns of the three base kinds.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST, RANDOM_LEAST = 6, 20, 24, 20

_HEX_MAP = bytes(104 if c in b"0123456789abcdef" else 32 for c in range(256))
_TOKEN_CHARS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_TOKEN_MAP = bytes(120 if c in _TOKEN_CHARS else 32 for c in range(256))
_TOKEN = re.compile(rb"[A-Za-z0-9+/_-]{%d,}" % RANDOM_LEAST)

#: Encodings: name, alphabet, and the classes that a token must all show.
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = (
    ("hex", _DIGIT + "abcdef", (_DIGIT, "abcdef")),
    ("HEX", _DIGIT + "ABCDEF", (_DIGIT, "ABCDEF")),
    ("base32", _UPPER + "234567", (_UPPER, "234567")),
    ("base36", _DIGIT + _LOWER, (_DIGIT, _LOWER)),
    ("BASE36", _DIGIT + _UPPER, (_DIGIT, _UPPER)),
    ("base62", _DIGIT + _UPPER + _LOWER, (_DIGIT, _UPPER, _LOWER)),
    ("base64", _UPPER + _LOWER + _DIGIT + "+/", (_DIGIT, _UPPER, _LOWER)),
    ("base64url", _UPPER + _LOWER + _DIGIT + "-_", (_DIGIT, _UPPER, _LOWER)),
)
LENGTHS = (20, 24, 32, 48, 64, 128, 1024)
STEPS = 100
#: Tokens in the upper half of the p-values below which a class borrows those of other lengths.
POOL_LEAST = 100


def infer(token: str) -> tuple[str, str, tuple[str, ...]] | None:
    """The first encoding whose alphabet holds the token and whose classes it shows."""
    chars = set(token)
    return next(((name, alphabet, classes) for name, alphabet, classes in ENCODINGS if chars <= set(alphabet) and all(chars & set(c) for c in classes)), None)


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared, by the Wilson-Hilferty approximation."""
    z = ((max(x, 0) / df) ** (1 / 3) - 1 + 2 / (9 * df)) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str, alphabet: str, classes: tuple[str, ...]) -> dict[str, float]:
    """p-values of the tests that a token is uniform over the alphabet."""
    n, size = len(token), len(alphabet)
    x = [alphabet.index(c) for c in token]
    counts = [0] * size
    for i in x:
        counts[i] += 1
    out = {"uniform": chi2_tail(sum(c * c for c in counts) * size / n - n, size - 1)}
    rest = size - sum(map(len, classes))
    sizes = [len(c) for c in classes] + [rest] * (rest > 0)
    seen = [sum(ch in c for ch in token) for c in classes]
    seen += [n - sum(seen)] * (rest > 0)
    out["classes"] = chi2_tail(sum((o - n * s / size) ** 2 / (n * s / size) for o, s in zip(seen, sizes)), len(sizes) - 1)
    high = [i >= size / 2 for i in x]
    up = sum(high)
    if 0 < up < n:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
        mean = 2 * up * (n - up) / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        out["runs"] = _two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        out["runs"] = 2.0 ** (1 - n)
    mid, var = (size - 1) / 2, (size * size - 1) / 12
    lagged = sum((a - mid) * (b - mid) for a, b in zip(x, x[1:])) / var
    out["serial"] = _two_sided(lagged / math.sqrt(n - 1))
    return out


def randomness(token: str) -> tuple[str, float] | None:
    """The inferred encoding and the combined p-value of randomness."""
    found = infer(token)
    if not found:
        return None
    ps = battery(token, *found[1:]).values()
    return found[0], -math.expm1(len(ps) * math.log1p(-min(max(min(ps), 0.0), 1 - 1e-12)))


def length_class(n: int) -> int:
    return LENGTHS[bisect_right(LENGTHS, n) - 1]


def thresholds(counts: dict[tuple[str, int], dict[int, int]], level: float) -> dict[tuple[str, int], float]:
    """Least p-value of each class that keeps the share of false finds within the level.

    ``counts`` has, per class, the number of distinct tokens in each of STEPS
    bins of p-values. Random tokens are even over the bins; their number a bin
    is taken from the upper half. Short tokens have weak tests, so their
    classes need a stricter threshold than those of long ones get. A class
    with less than POOL_LEAST tokens in the upper half is pooled with the
    nearest lengths of its encoding, then with the other encodings. If even
    that is too few, an excess of false finds counts only beyond two standard
    errors, and the threshold is the level at least.
    """
    out = {}
    for key in counts:
        bins = _pooled(counts, key)
        upper = sum(bins[STEPS // 2 :])
        sparse = upper < POOL_LEAST
        out[key] = 0.5
        for b in range(max(1, math.ceil(level * STEPS)) if sparse else 1, STEPS // 2):
            all_ = sum(bins[b:])
            share = (STEPS // 2 - b) / (STEPS - STEPS // 2)
            low = all_ - upper
            excess = low - upper * share
            error = 2 * math.sqrt(low + upper * share * share) if sparse else 0.0
            if all_ and excess - error <= level * all_:
                out[key] = b / STEPS
                break
    return out


def _pooled(counts: dict[tuple[str, int], dict[int, int]], key: tuple[str, int]) -> list[int]:
    """Counts by bin of a class and, while its upper half has too few, of the classes nearest to it."""
    far = lambda other: (other[0] != key[0], abs(LENGTHS.index(other[1]) - LENGTHS.index(key[1])))
    bins, reached = [0] * STEPS, None
    for other in sorted(counts, key=lambda k: (far(k), k)):
        # classes equally far come in together
        if far(other) != reached and sum(bins[STEPS // 2 :]) >= POOL_LEAST:
            break
        reached = far(other)
        for b, n in counts[other].items():
            bins[b] += n
    return bins


def base_spans(data: bytes) -> list[tuple[int, int, str]]:
    """Byte spans of the base kinds."""
    found = []
    low = data.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if b"AKIA" in data:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(data) if m.end() - m.start() >= ACCESS_LEAST]
    if b"h" * HEX_LEAST in data.translate(_HEX_MAP):
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(data)]
    return found


def tokens(data: bytes) -> list[tuple[int, int, str, float]]:
    """Byte span, encoding and p-value of the tokens that infer an encoding."""
    if b"x" * RANDOM_LEAST not in data.translate(_TOKEN_MAP):
        return []
    return [(m.start(), m.end(), *r) for m in _TOKEN.finditer(data) if (r := randomness(m[0].decode()))]


def spans(data: bytes, limits: dict[tuple[str, int], float]) -> list[tuple[int, int, str]]:
    """All spans in code points, by start and then kind; random ones overlap no base span."""
    base = base_spans(data)
    extra = [(a, b, "random") for a, b, name, p in tokens(data) if p >= limits.get((name, length_class(b - a)), 1.0) and not any(a < y and x < b for x, y, _ in base)]
    found = base + extra
    if found and not data.isascii():
        cuts = sorted({x for s in found for x in s[:2]})
        place, at, chars = {}, 0, 0
        for x in cuts:
            chars += len(data[at:x].decode())
            place[x] = chars
            at = x
        found = [(place[a], place[b], k) for a, b, k in found]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def digest_text(found: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def redact(text: str, found: list[tuple[int, int, str]], mask: str) -> str:
    """Replace the merged spans by the mask."""
    parts, at = [], 0
    for a, b, _ in found:
        if a >= at:
            parts += [text[at:a], mask]
        at = max(at, b)
    return "".join(parts) + text[at:]


def learn_thresholds(docs: DataFrame, text_col: str = "text", level: float = 0.05) -> dict[tuple[str, int], float]:
    """Thresholds from the p-values of every distinct token in the corpus.

    At most len(ENCODINGS) * len(LENGTHS) * STEPS counts reach the driver.
    Tokens are told apart by a hash of 64 bits.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found: dict[int, tuple[str, int, int]] = {}
            for i in range(0, batch.num_rows, 256):
                for text in batch.column("text").slice(i, 256).to_pylist():
                    data = (text or "").encode()
                    for a, b, name, p in tokens(data):
                        found[xxhash.xxh64_intdigest(data[a:b]) - 2**63] = name, length_class(b - a), min(int(p * STEPS), STEPS - 1)
            names, lengths, bins = zip(*found.values()) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lengths, pa.int32()), pa.array(bins, pa.int32()), pa.array(list(found), pa.int64())], names=["encoding", "length", "bin", "token"])

    found = docs.select(col(text_col).alias("text")).mapInArrow(run, "encoding string, length int, bin int, token long").distinct()
    rows = found.groupBy("encoding", "length", "bin").agg(F.count("*").alias("n")).collect()
    counts: dict[tuple[str, int], dict[int, int]] = {}
    for r in rows:
        counts.setdefault((r.encoding, r.length), {})[r.bin] = r.n
    return thresholds(counts, level)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def scan_secrets(docs: DataFrame, text_col: str = "text", level: float = 0.05, mask: str | None = None, keep: Iterable[str] | None = None) -> DataFrame:
    """Add ``secret_spans`` (start, end, kind in code points) to each document.

    With ``mask``, ``redacted`` holds the text with each span replaced. A null
    text counts as empty for spans and stays null when redacted. Every row is
    judged on its own, so repeated rows get the same spans. ``keep`` names the
    columns to carry, all by default; those named like new ones are replaced.
    """
    limits = learn_thresholds(docs, text_col, level)
    fields = {"secret_spans": SPANS} | ({"redacted": pa.string()} if mask is not None else {})

    def factory():
        def work(rows):
            found = [spans((t or "").encode(), limits) for t in rows["text"]]
            out = {"secret_spans": [[{"start": a, "end": b, "kind": k} for a, b, k in s] for s in found]}
            if mask is not None:
                out["redacted"] = [redact(t, s, mask) if t and s else t for t, s in zip(rows["text"], found)]
            return out

        return work

    return attach(docs, {"text": text_col}, factory, fields, docs.columns if keep is None else keep)


def secret_report(found: DataFrame) -> DataFrame:
    """Add the counts of base kinds, ``base_sha256`` and ``spans`` as text."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda xs: F.array_join(F.transform(xs, line), ",")
    of = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    found = found.withColumns({f"n_{kind}": of(kind) for kind in KINDS[:3]})
    base = F.filter("secret_spans", lambda s: s["kind"] != KINDS[3])
    return found.withColumn("base_sha256", F.sha2(joined(base), 256)).withColumn("spans", joined(F.col("secret_spans")))


def digest_of(found: Iterable[tuple[int, int, str]]) -> str:
    return hashlib.sha256(digest_text(found).encode()).hexdigest()


