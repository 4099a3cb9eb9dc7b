"""Toxicity by class-conditional Kneser-Ney models of characters in words.

A word is a sequence of characters between two marks. For toxic and for
ordinary texts a model gives the probability of each character after up to
four before it: counts of the class, discounted, and for the rest the
probability after one character less in a model that both classes share. That
one is a Kneser-Ney model of all documents, labelled or not: expressions from
the start of a word count by the documents' words that open with them, all
others by the distinct characters that they follow. So an expression that a
class has seen rarely or never is smoothed through the same back-off in both,
and says little. Characters carry insults over to inflected and unseen forms.

A text's features are its log-likelihood ratio a character, the largest ratio
of a word, that of its three largest words, and its length; logistic
regression on labelled rows, each judged by models that have not seen it,
turns them into a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_ROWS, attach, checkpointed, col, ship
from .decontaminate import WORD_TABLE

#: Labelled rows taken of each class, the least by hash, and their characters at most.
MAX_ROWS_A_CLASS, MAX_CHARS_A_CLASS = 4_000, 20_000_000
#: Characters of the longest expression, and the discount of a count.
ORDER, DISCOUNT = 5, 0.75
#: Characters of a stretch of a long word that is judged as one.
STRETCH = 24
#: Words that a task remembers, and that it gathers before it counts their expressions.
REMEMBERED, GATHERED = 200_000, 100_000
#: What stands before and after a word.
OPEN, SHUT = "\x02", "\x03"
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> set[bytes]:
    """The distinct words of a text in lower case."""
    return set((text or "").lower().encode().translate(WORD_TABLE).split())


def expressions(word: bytes) -> list[str]:
    """What each character of a word, and its end, is counted with: up to ORDER characters from no further than its start."""
    w = OPEN + word.decode() + SHUT
    return [w[max(0, i + 1 - ORDER) : i + 1] for i in range(1, len(w))]


def hashes(x: np.ndarray) -> np.ndarray:
    """Row k has the hashes of the k + 1 characters that end at each place."""
    out = np.zeros((ORDER, len(x)), np.uint64)
    h = np.zeros(len(x), np.uint64)
    for k in range(min(ORDER, len(x))):
        h[k:] = (h[k:] ^ (x[: len(x) - k].astype(np.uint64) + np.uint64(1))) * _MULT
        h ^= h >> np.uint64(29)
        out[k] = h * _MULT
    return out


class Table:
    """Rows by their 64-bit keys, found through the keys' first bits."""

    def __init__(self, keys: np.ndarray):
        """``keys`` ascend and are distinct."""
        self.keys = keys
        self.bits = max(1, min(24, len(keys).bit_length()))
        self.start = np.searchsorted(keys >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        b = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end, out = self.start[b], self.start[b + 1], np.full(len(keys), -1, np.int64)
        left = np.nonzero(at < end)[0]
        while len(left):
            hit = self.keys[at[left]] == keys[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


def _joined(words: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the marked words one after another, and each place's distance from its word's start."""
    x = np.frombuffer((OPEN + (SHUT + OPEN).join(w.decode() for w in words) + SHUT).encode("utf-32-le"), np.uint32)
    start = np.maximum.accumulate(np.where(x == ord(OPEN), np.arange(len(x)), 0))
    return x, np.arange(len(x)) - start


class ToxicityModel:
    """Log-likelihood ratios of expressions, and of contexts for what else follows them."""

    def __init__(self, grams: np.ndarray, ratios: np.ndarray, contexts: np.ndarray, rests: np.ndarray):
        self.grams, self.ratios = Table(grams), ratios.astype(np.float32)
        self.contexts, self.rests = Table(contexts), rests.astype(np.float32)
        self.weights, self.bias = np.zeros(4), -4.0
        self._known: dict[bytes, tuple[float, float]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_known": {}}

    def places(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ratio at each place of the marked words, and the places' distances."""
        x, far = _joined(words)
        h, order, place = hashes(x), np.minimum(far, ORDER - 1), np.arange(len(x))
        out = np.zeros(len(x))
        at = self.grams.find(h[order, place])
        out[at >= 0] = self.ratios[at[at >= 0]]
        rest = np.nonzero((at < 0) & (far > 0))[0]
        at = self.contexts.find(h[order[rest] - 1, rest - 1])
        out[rest[at >= 0]] = self.rests[at[at >= 0]]
        out[far == 0] = 0
        return out, far

    def _learn(self, words: list[bytes]) -> None:
        """Remember each word's ratio as a whole and of its largest stretch."""
        ratio, far = self.places(words)
        begins = np.nonzero(far == 0)[0]
        total = np.add.reduceat(ratio, begins)
        sizes = np.diff(np.append(begins, len(far)))
        best = total.copy()
        for i in np.nonzero(sizes > STRETCH + 1)[0].tolist():
            run = np.cumsum(np.concatenate(([0.0], ratio[begins[i] : begins[i] + sizes[i]])))
            best[i] = (run[STRETCH:] - run[:-STRETCH]).max()
        self._known.update(zip(words, zip(total.tolist(), best.tolist())))

    def features(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text; all 0 for a text without words."""
        sets = [words_of(t) for t in texts]
        if len(self._known) >= REMEMBERED:
            self._known.clear()
        new = [w for w in set().union(*sets) if w not in self._known]
        if new:
            self._learn(new)
        out = np.zeros((len(texts), 4))
        for i, words in enumerate(sets):
            if words:
                total, best = np.array([self._known[w] for w in words]).T
                top = np.sort(best)[::-1][:3]
                out[i] = 10 * total.sum() / sum(map(len, words)), top[0], top.sum() / 3, np.log(len(words))
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights + self.bias, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[np.ndarray, float]:
    """Newton's method with a light ridge on scaled features; a default without both classes."""
    if not len(x) or y.min() == y.max():
        return np.array([0.0, 1.0, 0.0, 0.0]), -4.0
    mid, spread = x.mean(0), x.std(0) + 1e-9
    a = np.concatenate(((x - mid) / spread, np.ones((len(x), 1))), 1)
    w, ridge = np.zeros(a.shape[1]), np.diag([*[1e-2] * x.shape[1], 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.clip(np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge, a.T @ (p - y) + ridge @ w), -1, 1)
    return w[:-1] / spread, float(w[-1] - (w[:-1] * mid / spread).sum())


def _signature(text: str | None) -> int:
    """Least hash of the words' first halves of a text: near copies mostly share it."""
    joined = b" ".join((text or "").lower().encode().translate(WORD_TABLE).split())
    x = np.frombuffer(joined, np.uint8).astype(np.uint64)
    k = min(13, len(x))
    if not k:
        return 0
    h = np.zeros(len(x) - k + 1, np.uint64)
    for i in range(k):
        h = (h ^ x[i : i + len(h)]) * _MULT
        h ^= h >> np.uint64(31)
    return int(h.min() >> np.uint64(1))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, held_out: int, limit: int) -> DataFrame:
    """At most ``limit`` training rows of each class, one of each group of copies: (y, part, text)."""
    spark = docs.sparkSession
    rows = labels.select(col(id_col).cast("long").alias("id"), col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    rows = rows.withColumn("part", F.crc32(F.col("id").cast("string").cast("binary")) % held_out).where("part != 0")
    taken = [r for y in (0, 1) for r in rows.where(F.col("y") == y).orderBy(F.xxhash64("id", F.lit("toxicity")), "id").limit(limit).collect()]
    sample = spark.createDataFrame([(r.id, r.y, int(r.part)) for r in taken], "id long, y int, part int")
    texts = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text")).join(F.broadcast(sample), "id")
    signed = attach(texts, {"text": "text"}, lambda: lambda rows: {"sig": [_signature(t) for t in rows["text"]]}, {"sig": pa.int64()}, ["id", "y", "part", "text"])
    # a group's least id gives its part
    once = signed.groupBy("y", "sig").agg(F.min_by(F.struct("part", "text"), F.struct("id", "text")).alias("r")).select("y", "sig", "r.part", "r.text")
    # a few thousand rows of each class
    so_far = F.sum(F.length("text")).over(Window.partitionBy("y").orderBy("sig").rowsBetween(Window.unboundedPreceding, -1))
    return once.withColumn("so_far", so_far).where(f"coalesce(so_far, 0) < {MAX_CHARS_A_CLASS}").select("y", "part", "text")


def class_counts(sample: DataFrame) -> pa.Table:
    """Rows (g, y, part, n): how many words of the class's documents hold an expression, a document's distinct words each once."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                sums: dict[tuple[int, int], Counter] = {}
                for y, part, text in zip(*(batch.column(c).slice(i, SLICE_ROWS).to_pylist() for c in ("y", "part", "text"))):
                    count = sums.setdefault((y, part), Counter())
                    for word in words_of(text):
                        count.update(expressions(word))
                for (y, part), count in sums.items():
                    k = len(count)
                    yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array([y] * k, pa.int32()), pa.array([part] * k, pa.int32()), pa.array(list(count.values()), pa.int64())], names=["g", "y", "part", "n"])

    rows = sample.select("y", "part", "text").mapInArrow(run, "g string, y int, part int, n long")
    return rows.groupBy("g", "y", "part").agg(F.sum("n").alias("n")).toArrow()


class Expressions:
    """The expressions of the sample, and all shorter ones that they back off to, as hashes.

    For each order: ``keys`` ascending, ``shorter`` the place of the same
    without its first character, and ``context`` the place of the context
    among the contexts of this order. ``top`` has, for each expression of the
    sample, its order and place.
    """

    def __init__(self, grams: list[str]):
        size = np.array(list(map(len, grams)), np.int64)
        x = np.frombuffer("".join(g.rjust(ORDER, "\0") for g in grams).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
        h = hashes(x.reshape(-1)).reshape(ORDER, -1, ORDER) if len(grams) else np.zeros((ORDER, 0, ORDER), np.uint64)
        whole, before = h[:, :, -1], h[:, :, -2]
        self.keys, self.shorter, self.context, self.contexts, self.initial = [], [], [], [], []
        for k in range(ORDER):
            mine = size > k
            keys, at = np.unique(whole[k][mine], return_index=True)
            rows = np.nonzero(mine)[0][at]
            self.keys.append(keys)
            self.initial.append(x[rows, ORDER - 1 - k] == ord(OPEN))
            self.shorter.append(np.searchsorted(self.keys[k - 1], whole[k - 1][rows]) if k else None)
            contexts, place = np.unique(before[k - 1][rows], return_inverse=True) if k else (np.zeros(1, np.uint64), np.zeros(len(rows), np.int64))
            self.contexts.append(contexts)
            self.context.append(place)
        self.order = size - 1
        self.place = np.zeros(len(grams), np.int64)
        for k in range(ORDER):
            mine = self.order == k
            self.place[mine] = np.searchsorted(self.keys[k], whole[k][mine])


def shared_counts(docs: DataFrame, text_col: str, tables: list[np.ndarray]) -> list[np.ndarray]:
    """Over all documents, for the expressions of each order: how many words they open, or else how many characters they follow.

    The characters are told apart by 256 bits: Latin letters each have their own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        finders = [Table(keys) for keys in shared.value]
        opens = [np.zeros(len(t.keys), np.int64) for t in finders]
        masks = [np.zeros((len(t.keys), 4), np.uint64) for t in finders]
        gathered: Counter = Counter()

        def count():
            if not gathered:
                return
            x, far = _joined(gathered)
            times = np.array(list(gathered.values()), np.int64)[np.cumsum(far == 0) - 1]
            h = hashes(x)
            for k, finder in enumerate(finders):
                ends = np.nonzero((far >= k) & (far > 0))[0]
                at = finder.find(h[k, ends])
                ends, at = ends[at >= 0], at[at >= 0]
                first = far[ends] == k
                np.add.at(opens[k], at[first], times[ends[first]])
                left = x[ends[~first] - k - 1]
                bit = np.where(left < 0x180, left & 0xFF, left * np.uint32(2654435761) >> np.uint32(24))
                np.bitwise_or.at(masks[k], (at[~first], (bit >> 6).astype(np.int64)), np.uint64(1) << (bit & 63).astype(np.uint64))
            gathered.clear()

        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                for text in batch.column("text").slice(i, SLICE_ROWS).to_pylist():
                    gathered.update(words_of(text))
                if len(gathered) >= GATHERED:
                    count()
        count()
        for k in range(len(finders)):
            for i in range(0, len(opens[k]), 50_000):
                n, m = opens[k][i : i + 50_000], masks[k][i : i + 50_000].view(np.int64)
                some = np.nonzero((n > 0) | m.any(1))[0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(some + i), pa.array(n[some]), *(pa.array(m[some, j]) for j in range(4))], names=["k", "at", "n", "m0", "m1", "m2", "m3"])

    rows = docs.select(col(text_col).alias("text")).mapInArrow(run, "k int, at long, n long, m0 long, m1 long, m2 long, m3 long")
    follow = sum((F.bit_count(F.bit_or(f"m{j}")) for j in range(1, 4)), F.bit_count(F.bit_or("m0")))
    found = rows.groupBy("k", "at").agg((F.sum("n") + follow).alias("n")).toArrow()
    k, at, n = (found.column(c).to_numpy() for c in ("k", "at", "n"))
    out = [np.zeros(len(keys)) for keys in tables]
    for j in range(len(tables)):
        out[j][at[k == j]] = n[k == j]
    return out


def discounted(n: np.ndarray, context: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
    """The discounted share of each count in its context, and the share that each context leaves over: all if it has none."""
    total = np.bincount(context, weights=n, minlength=contexts)
    seen = np.bincount(context, weights=n > 0, minlength=contexts)
    rest = np.where(total > 0, DISCOUNT * seen / np.maximum(total, 1e-9), 1.0)
    return np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1e-9)[context], rest


def shared_probabilities(of: Expressions, counts: list[np.ndarray]) -> list[np.ndarray]:
    """The shared model's probability of each expression's last character after the ones before it, by order."""
    out = [(counts[0] + 1) / (counts[0].sum() + len(counts[0]) + 1)]
    for k in range(1, len(counts)):
        p, rest = discounted(counts[k], of.context[k], len(of.contexts[k]))
        out.append(p + rest[of.context[k]] * out[k - 1][of.shorter[k]])
    return out


def class_model(of: Expressions, shared: list[np.ndarray], n: np.ndarray) -> ToxicityModel:
    """The model of counts ``n`` (sample's expressions by class)."""
    keys, ratios, contexts, rests = [], [], [], []
    for k in range(1, ORDER):
        mine = np.nonzero(of.order == k)[0]
        if not len(mine):
            continue
        at, count = of.place[mine], np.zeros((len(of.keys[k]), 2))
        count[at] = n[mine]
        p = []
        for y in (0, 1):
            own, rest = discounted(count[:, y], of.context[k], len(of.contexts[k]))
            p.append((own + rest[of.context[k]] * shared[k - 1][of.shorter[k]], rest))
        keys.append(of.keys[k][at])
        ratios.append((np.log(p[1][0]) - np.log(p[0][0]))[at])
        used = np.unique(of.context[k][at])
        contexts.append(of.contexts[k][used])
        rests.append((np.log(p[1][1]) - np.log(p[0][1]))[used])
    join = lambda xs, kind: np.concatenate(xs) if xs else np.empty(0, kind)
    keys, ratios, contexts, rests = join(keys, np.uint64), join(ratios, float), join(contexts, np.uint64), join(rests, float)
    keys, a = np.unique(keys, return_index=True)
    contexts, b = np.unique(contexts, return_index=True)
    return ToxicityModel(keys, ratios[a], contexts, rests[b])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 5, max_rows: int = MAX_ROWS_A_CLASS) -> ToxicityModel:
    """Fit the models; rows whose crc32(id as text) is divisible by ``held_out`` are not used.

    The sample has at most ``max_rows`` rows and MAX_CHARS_A_CLASS characters
    of each class, which bounds the expressions that reach the driver and the
    tasks. The shared counts of these expressions are taken over all documents.
    The logistic function is fitted on features of each remainder's rows under
    models of the other remainders.
    """
    ship(docs.sparkSession)
    sample = checkpointed(_labelled(docs, labels, id_col, text_col, label_col, held_out, max_rows))
    found = class_counts(sample)
    names = found.column("g").combine_chunks().dictionary_encode()
    grams, code = names.dictionary.to_pylist(), names.indices.to_numpy()
    of = Expressions(grams)
    shared = shared_probabilities(of, shared_counts(docs, text_col, of.keys[: ORDER - 1]))
    n = np.zeros((len(grams), 2, held_out))
    n[code, found.column("y").to_numpy(), found.column("part").to_numpy()] = found.column("n").to_numpy()
    model = class_model(of, shared, n.sum(2))
    xs, ys = [], []
    for part in range(1, held_out):
        other = docs.sparkSession.sparkContext.broadcast(class_model(of, shared, n.sum(2) - n[:, :, part]))

        def factory(other=other):
            return lambda rows: {"x": other.value.features(rows["text"]).tolist()}

        fit = attach(sample.where(F.col("part") == part), {"text": "text"}, factory, {"x": pa.list_(pa.float64())}, ["y"]).toPandas()
        xs += fit["x"].tolist()
        ys += fit["y"].tolist()
        other.unpersist()
    model.weights, model.bias = fit_logistic(np.array(xs, float).reshape(-1, 4), np.array(ys, float))
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 5, max_rows: int = MAX_ROWS_A_CLASS) -> DataFrame:
    """Rows (id, held_out, score, predicted), one per document.

    The score depends on the text alone: null and empty texts get that of no
    evidence, equal texts equal scores. Labels other than 0 and 1, of null ids
    or of no document are left aside; an id labelled both ways counts as
    toxic. Without labels of both classes the scale is a default. Repeated
    rows stay; other columns are ignored; an empty table gives none.
    """
    model = train(docs, labels, id_col, text_col, label_col, held_out, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def factory():
        model = shared.value
        return lambda rows: {"score": model.scores(model.features(rows["text"])).tolist()}

    scored = attach(docs, {"text": text_col}, factory, {"score": pa.float64()}, [id_col])
    mine = F.crc32(col(id_col).cast("string").cast("binary")) % held_out == 0
    return scored.select(col(id_col), F.coalesce(mine, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
