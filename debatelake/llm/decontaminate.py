"""Benchmark decontamination by a prefix-filtered set join.

Each benchmark window is a set of word shingles that a document must contain
in full. For containment the necessary prefix is the window's single rarest
shingle, by counts over all documents. A document position with that shingle
is a candidate; the shingle's offset and the window's length bound where the
window can lie, and its words are then compared one by one.

The benchmark is taken in blocks of bounded size. Each block's prefix tokens
are broadcast, in flat sorted arrays, and joined with every document's shingles
in a map without shuffle; a larger benchmark takes more blocks, each map adding
to the spans that the last one found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, attach, checkpointed, col, ship

#: Word bytes stay, A-Z are lower-cased, other ASCII bytes part words.
WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Words in a window.
WINDOW = 13
#: Characters of benchmark text in one broadcast block, which takes about 10 bytes for each.
BLOCK_CHARS = 8_000_000
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_TABLE).split()


def hashed(text: str | None, memo: WordHash) -> np.ndarray:
    """The 64-bit hashes of a text's words; equal words are known by them."""
    w = words(text)
    return np.fromiter(map(memo.__getitem__, w), np.uint64, len(w))


def _roll(ids: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` hashed words."""
    n = max(len(ids) - width + 1, 0)
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = (h ^ ids[i : i + n]) * _MULT
        h ^= h >> np.uint64(31)
    return h


#: Bits of a hash that a sieve looks at.
SIEVE = 20


def _sieve(tokens: np.ndarray) -> np.ndarray:
    """By the first bits of a hash, whether a token begins so."""
    out = np.zeros(1 << SIEVE, bool)
    out[(tokens >> np.uint64(64 - SIEVE)).astype(np.int64)] = True
    return out


def _among(h: np.ndarray, tokens: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of hashes that are among sorted tokens, and which these are."""
    at = np.nonzero(sieve[(h >> np.uint64(64 - SIEVE)).astype(np.int64)])[0]
    t = np.minimum(np.searchsorted(tokens, h[at]), len(tokens) - 1)
    hit = tokens[t] == h[at]
    return at[hit], t[hit]


class Windows:
    """Distinct windows of a block of items, indexed by one shingle each; all of it in flat arrays."""

    def __init__(self, items: Iterable[tuple[object, str | None]], window: int, shingle: int):
        memo, parts, start, length, item = WordHash(), [], [], [], []
        self.names: list[str | None] = []
        total = 0
        for name, text in items:
            h = hashed(text, memo)
            if not len(h):
                continue
            k = min(window, len(h))
            parts.append(h)
            start.append(total + np.arange(len(h) - k + 1))
            length.append(np.full(len(h) - k + 1, k))
            item.append(np.full(len(h) - k + 1, len(self.names)))
            self.names.append(None if name is None else str(name))
            total += len(h)
        join = lambda xs, kind: np.concatenate(xs).astype(kind) if xs else np.empty(0, kind)
        self.words, start, length, item = join(parts, np.uint64), join(start, np.int64), join(length, np.int64), join(item, np.int64)
        self.shingle = shingle
        # equal windows become one, which keeps the items of all
        keys = np.zeros(len(start), np.uint64)
        for k in np.unique(length).tolist():
            mine = length == k
            keys[mine] = _roll(self.words, k)[start[mine]] ^ np.uint64(k)
        _, first, number = np.unique(keys, return_index=True, return_inverse=True)
        self.start, self.length = start[first], length[first]
        pairs = np.unique(np.stack((number, item), 1), axis=0) if len(start) else np.empty((0, 2), np.int64)
        self.items, self.of = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))
        #: by shingle width, as windows shorter than a shingle are their own one
        self.widths = sorted({min(shingle, k) for k in np.unique(self.length).tolist()})
        self.grams = {k: _roll(self.words, k) for k in self.widths}
        inside = {k: np.unique(np.concatenate([(self.start[self.length == w][:, None] + np.arange(w - k + 1)).ravel() for w in np.unique(self.length).tolist() if min(shingle, w) == k])) for k in self.widths}
        self.keys = {k: np.unique(self.grams[k][inside[k]]) for k in self.widths}

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Index each window by its rarest shingle under ``counts`` (by width, in the order of the keys)."""
        index: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for w in np.unique(self.length).tolist():
            k = min(self.shingle, w)
            mine = np.nonzero(self.length == w)[0]
            places = self.start[mine][:, None] + np.arange(w - k + 1)
            offset = counts[k][np.searchsorted(self.keys[k], self.grams[k][places])].argmin(1)
            index.setdefault(k, []).append((self.grams[k][self.start[mine] + offset], mine, offset))
        self.index = {}
        for k, parts in index.items():
            token, window, offset = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(token, kind="stable")
            tokens, first = np.unique(token[order], return_index=True)
            self.index[k] = tokens, _sieve(tokens), np.append(first, len(order)), window[order], offset[order]
        self.keys, self.grams = {}, {}

    def spans(self, words: np.ndarray) -> tuple[list[tuple[int, int]], set]:
        """Word spans of the windows in a document of hashed words, and the names of their items, None among them."""
        spans, items = [], set()
        for k, (tokens, sieve, first, window, offset) in self.index.items():
            if len(words) < k:
                continue
            at, t = _among(_roll(words, k), tokens, sieve)
            if not len(at):
                continue
            many = first[t + 1] - first[t]
            entry = np.repeat(first[t] - np.cumsum(many) + many, many) + np.arange(many.sum())
            begin = np.repeat(at, many) - offset[entry]
            found = window[entry]
            size = self.length[found]
            # the shingle's place and the window's length say where it would lie
            fits = (begin >= 0) & (begin + size <= len(words))
            for w in np.unique(size[fits]).tolist():
                mine = np.nonzero(fits & (size == w))[0]
                steps = np.arange(w)
                same = (words[begin[mine][:, None] + steps] == self.words[self.start[found[mine]][:, None] + steps]).all(1)
                for b, n in zip(begin[mine][same].tolist(), found[mine][same].tolist()):
                    spans.append((b, b + w))
                    items.update(self.names[i] for i in self.items[self.of[n] : self.of[n + 1]].tolist())
        return spans, items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int):
    """The items in blocks of about so many characters, one at a time on the driver."""
    items = benchmark.select(col(id_col).alias("id"), col(text_col).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block_chars)
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == k).collect() if count > 1 else items.collect()
        yield [(r.id, r.text) for r in part]


def _counts(docs: DataFrame, text_col: str, shared, block: Windows) -> dict[int, np.ndarray]:
    """Occurrences in all documents of the block's shingles; no more rows than the block has."""

    def run(batches):
        keys, memo = shared.value, WordHash()
        sums, sieves = {k: np.zeros(len(x), np.int64) for k, x in keys.items()}, {k: _sieve(x) for k, x in keys.items()}
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                for text in batch.column("text").slice(i, 256).to_pylist():
                    words = hashed(text, memo)
                    for k, known in keys.items():
                        if len(words) >= k:
                            at = _among(_roll(words, k), known, sieves[k])[1]
                            if len(at):
                                np.add.at(sums[k], at, 1)
        for k, n in sums.items():
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(n[at])], names=["k", "at", "n"])

    found = docs.select(col(text_col).alias("text")).mapInArrow(run, "k int, at long, n long").groupBy("k", "at").agg(F.sum("n").alias("n")).toArrow()
    k, at, n = (found.column(c).to_numpy() for c in ("k", "at", "n"))
    out = {w: np.zeros(len(x), np.int64) for w, x in block.keys.items()}
    for w in out:
        out[w][at[k == w]] = n[k == w]
    return out


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = 5,
    block_chars: int = BLOCK_CHARS,
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """Add to each document the benchmark passages it holds.

    New columns: ``n_words``, ``hit_spans`` (merged word spans covered by
    benchmark windows) and ``items`` (ids of items with such windows, sorted as
    strings). Null and empty texts have no words; items without words have no
    windows; items with a null id give hits but no id, so ``items`` lacks them. Repeated documents and
    items are each counted on their own. ``keep`` names the columns to carry,
    all by default; columns named like the new ones are replaced. An empty
    benchmark leaves every document without hits.
    """
    ship(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    carry = list(docs.columns if keep is None else keep)
    fields = {"n_words": pa.int64(), "hit_spans": SPANS, "items": pa.list_(pa.string())}
    source, needs, done = docs, {"text": text_col}, 0
    for part in _blocks(benchmark, item_col, item_text_col, block_chars):
        block = Windows(part, window, shingle)
        if not len(block.start):
            continue
        counting = sc.broadcast(block.keys)
        block.choose(_counts(docs, text_col, counting, block))
        counting.unpersist()
        shared = sc.broadcast(block)

        def factory(shared=shared):
            block, memo = shared.value, WordHash()

            def work(rows):
                before = zip(rows["spans"], rows["items"]) if "spans" in rows else None
                n, spans, items = [], [], []
                for text in rows["text"]:
                    ids = hashed(text, memo)
                    s, x = block.spans(ids)
                    x.discard(None)
                    if before:
                        s0, x0 = next(before)
                        # an item's texts may be in several blocks
                        s, x = s + [(p["start"], p["end"]) for p in s0], x | set(x0)
                    n.append(len(ids))
                    spans.append([{"start": a, "end": b} for a, b in merged(s)])
                    items.append(sorted(x))
                return {"n_words": n, "hit_spans": spans, "items": items}

            return work

        whole = carry if text_col in carry else [*carry, text_col]
        source = attach(source, needs, factory, fields, whole)
        needs = {"text": text_col, "spans": "hit_spans", "items": "items"}
        done += 1
        if done % 4 == 0:
            source = checkpointed(source)
    if not done:

        def nothing():
            return lambda rows: {"n_words": [len(words(t)) for t in rows["text"]], "hit_spans": [[] for _ in rows["text"]], "items": [[] for _ in rows["text"]]}

        source = attach(source, needs, nothing, fields, carry)
    return source.select(*[col(c) for c in [*(c for c in carry if c not in fields), *fields]])


def contamination(found: DataFrame) -> DataFrame:
    """Add ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` (a twentieth of the words or more)."""
    found = found.withColumn("n_hit", F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"])))
    found = found.withColumn("n_items", F.size("items").cast("long")).withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
    return found.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def items_digest(items: Iterable[object]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
