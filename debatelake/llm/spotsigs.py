"""Document fingerprints by SpotSigs.

A spot signature is a common word and the chain of content words that follow
it. Its 32-bit hash goes into the document's set, and two documents are
compared by the Jaccard similarity of their sets. The similarity of two sets
is at most the quotient of their sizes: the comparison of pairs stops there
if that is under the threshold, and the join meets only sets of the same or
of the next length partition. Next documents are compared without a threshold,
as their likeness itself is asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, attach, checkpointed, col, ship
from .decontaminate import words
from .jaccard_join import _shared, linked, parities, prefix_length

#: Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    w.encode()
    for w in """
    a an and are as at be by for from has he in is it of on or that the this to was were will with
    als am an auf aus bei das dem den der des die ein eine er es für im in ist mit nicht sich sie und von zu
    au aux avec ce dans de des du elle en est et il la le les ne par pas pour que qui sur un une
    al con de del el en es la las lo los no o para por que se su un una y
    """.split()
)
CHAIN = 2
#: Bytes of text in a range of ids.
RANGE_BYTES = 8_000_000
_MULT = np.uint64(0x9E3779B97F4A7C15)


def signatures(text: str | None, memo: WordHash, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct 32-bit spot signatures.

    Without any whole chain, as in texts of few or no common words, every
    chain of content words counts, or else the words as they are. A text
    without words has no signature.
    """
    w = words(text)
    if not w:
        return np.empty(0, np.uint32)
    h = np.fromiter(map(memo.__getitem__, w), np.uint64, len(w))
    common = (h & np.uint64(1)).astype(bool)
    content = np.nonzero(~common)[0]
    spots = np.nonzero(common)[0]
    first = np.searchsorted(content, spots)
    whole = first + chain <= len(content)
    spots, first = spots[whole], first[whole]
    if len(spots):
        out = h[spots]
    elif len(content) >= chain:
        first, out = np.arange(len(content) - chain + 1), np.full(len(content) - chain + 1, 1, np.uint64)
    else:
        content, first, out, chain = np.arange(len(h)), np.arange(len(h)), np.full(len(h), 2, np.uint64), 1
    for i in range(chain):
        out = (out ^ h[content[first + i]]) * _MULT
        out ^= out >> np.uint64(32)
    return np.unique((out * _MULT >> np.uint64(32)).astype(np.uint32))


def to_text(sigs: np.ndarray) -> str:
    """A fingerprint: eight hex digits a signature, ascending."""
    return sigs.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def jaccard(x: np.ndarray, y: np.ndarray, threshold: float = 0.0) -> float:
    """Jaccard similarity; 0 as soon as the sizes rule out the threshold. Two empty sets are alike."""
    small, large = sorted((len(x), len(y)))
    if not large:
        return 1.0
    if not small or small < threshold * large:
        return 0.0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return common / (small + large - common)


def fingerprints(docs: DataFrame, text_col: str = "text", anchors: frozenset[bytes] = ANCHORS, chain: int = CHAIN, keep: Iterable[str] | None = None) -> DataFrame:
    """Add ``fingerprint`` to each document; null and empty texts have the empty one."""

    def factory():
        memo = WordHash(anchors)
        return lambda rows: {"fingerprint": [to_text(signatures(t, memo, chain)) for t in rows["text"]]}

    return attach(docs, {"text": text_col}, factory, {"fingerprint": pa.string()}, docs.columns if keep is None else keep)


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as many first characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anchors: frozenset[bytes] = ANCHORS, chain: int = CHAIN, partitions: int | None = None) -> DataFrame:
    """Fingerprint each document, its edited text and compare both and the next document.

    Rows: id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. The next document
    is by ascending id, nulls first, rows of equal ids by text; after the last
    comes the first. A single document is its own next. Texts are shuffled
    once, into ranges of ids; each range also gets the first row of the next.
    """
    spark = docs.sparkSession
    ship(spark)
    ids = docs.select(col(id_col).cast("long").alias("id"))
    size = docs.agg(F.sum(F.octet_length(col(text_col)))).first()[0] or 0
    count = partitions or max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), 8, -(-size // RANGE_BYTES))
    cuts = sorted({int(x) for x in (ids.where("id is not null").approxQuantile("id", [i / count for i in range(1, count)], 0.1 / count) if count > 1 else [])})
    bucket = _search(cuts)
    placed = ids.withColumn("bucket", bucket).groupBy("bucket").agg(F.min(F.struct(F.col("id").isNotNull().alias("some"), "id")).alias("r")).select("bucket", "r.id").orderBy("bucket").collect()
    if not placed:
        return spark.createDataFrame([], f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    # the least id of each range also goes to the range before it, the very first to the last
    before = {r.id: placed[i - 1].bucket for i, r in enumerate(placed)}
    guests = spark.createDataFrame([(i, b) for i, b in before.items()], "gid long, gb int")
    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text")).withColumn("bucket", bucket)
    rows = rows.join(F.broadcast(guests), F.col("id").eqNullSafe(F.col("gid")), "left")
    guest = F.col("gb")
    rows = rows.withColumn("places", F.when(guest.isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("guest")))).otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("guest")), F.struct(guest.alias("b"), F.lit(1).alias("guest")))))
    rows = rows.select("id", "text", F.explode("places").alias("p")).select("id", "text", "p.b", "p.guest")
    # several ranges go to a partition, which evens out their hashes
    rows = rows.repartition(max(-(-count // 4), int(spark.conf.get("spark.sql.shuffle.partitions"))), "b").sortWithinPartitions("b", "guest", F.col("id").isNotNull(), "id", "text")

    def run(batches):
        memo = WordHash(anchors)
        last = None  # (bucket, id, text, signatures)
        done_with = None  # the bucket whose guest has been met
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out = []
                for bucket, guest, key, text in zip(*(part.column(c).to_pylist() for c in ("b", "guest", "id", "text"))):
                    if guest and done_with == bucket:
                        continue  # repeated ids send more than one guest; the first by text counts
                    text = text or ""
                    sigs = signatures(text, memo, chain)
                    if last is not None and last[0] == bucket:
                        out.append(_compared(last, text, sigs, memo, chain))
                    last = None if guest else (bucket, key, text, sigs)
                    done_with = bucket if guest else done_with
                yield pa.RecordBatch.from_pylist(out, schema=_COMPARED)

    result = rows.select("b", "guest", "id", "text").mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return result.withColumnRenamed("id", id_col)


_COMPARED = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compared(row, following: str, next_sigs: np.ndarray, memo: WordHash, chain: int) -> dict:
    _, key, text, sigs = row
    new = edited(text, following)
    new_sigs = signatures(new, memo, chain)
    return {"id": key, "n_chars": len(text), "edited_sha256": hashlib.sha256(new.encode()).hexdigest(), "fingerprint": to_text(sigs), "edited_fingerprint": to_text(new_sigs), "near_edited": jaccard(sigs, new_sigs), "near_next": jaccard(sigs, next_sigs)}


def _search(cuts: list[int]):
    """The number of cuts at or under the id, by a tree of comparisons."""

    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("id") < cuts[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(F.col("id").isNull(), 0).otherwise(tree(0, len(cuts)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (8, 10), anchors: frozenset[bytes] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Near-duplicate classes by spot signatures: rows (id, class_id).

    Equal fingerprints are one vertex. Vertices of the same or of the next
    length partition meet in the buckets of the signatures of their prefixes,
    where sizes, positions and parities prune the pairs, as in the n-gram join:
    a large bucket gives a tree of pairs and not all of them. Texts without
    words are classes of their own; a row with a null id names no class.
    """
    num, den = threshold
    prints = fingerprints(docs, text_col, anchors, chain, [id_col]).select(col(id_col).cast("long").alias("id"), "fingerprint")
    prints = checkpointed(prints.withColumn("v", F.unhex(F.sha2("fingerprint", 256))))
    sets = checkpointed(prints.where("fingerprint != ''").groupBy("v").agg(F.first("fingerprint").alias("fp")))
    step = -np.log(num / den)

    def run(batches):
        for batch in batches:
            out = []
            for v, fp in zip(batch.column("v").to_pylist(), batch.column("fp").to_pylist()):
                mixed = _mixed(from_text(fp))
                n = len(mixed)
                k = prefix_length(n, num, den)
                prefix = np.sort(mixed)[:k]
                # sizes from threshold ** -i to threshold ** -(i + 1) form partition i, which also meets the one below
                part = int(np.log(n) / step + 1e-9)
                for p in (part, part - 1):
                    tok = (prefix + np.uint64(p + 1)) * _MULT
                    out += zip(tok.view(np.int64).tolist(), [v] * k, [n] * k, range(k))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out) if out else ((), (), (), ()), (pa.int64(), pa.binary(), pa.int64(), pa.int64()))], names=["tok", "v", "n", "pos"])

    entries = _shared(sets.mapInArrow(run, "tok long, v binary, n long, pos long"), num, den)
    sigs = attach(sets, {"fp": "fp"}, lambda: lambda rows: {"sig": [parities(_mixed(from_text(x))) for x in rows["fp"]]}, {"sig": pa.binary()}, ["v"])

    def verify(pairs: DataFrame) -> DataFrame:
        x, y = (sets.select(F.col("v").alias(e), F.col("fp").alias(f"f{e}")) for e in "ab")
        both = pairs.join(x, "a").join(y, "b")
        alike = lambda x, y: jaccard(from_text(x), from_text(y), num / den) >= num / den - 1e-12
        return attach(both, {"x": "fa", "y": "fb"}, lambda: lambda rows: {"_keep": [alike(x, y) for x, y in zip(rows["x"], rows["y"])]}, {}, ["a", "b"])

    labels = linked(entries, checkpointed(sigs.join(entries.select("v").distinct(), "v", "left_semi")), verify, num, den)
    known = prints.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    empty = F.col("fingerprint") == ""
    classes = known.where(~empty).groupBy("label").agg(F.min("id").alias("class_id"))
    return known.where(~empty).join(classes, "label").select("id", "class_id").unionAll(known.where(empty).select("id", F.col("id").alias("class_id"))).withColumnRenamed("id", id_col)


def _mixed(sigs: np.ndarray) -> np.ndarray:
    """Distinct 64-bit numbers of signatures, in no order."""
    h = (sigs.astype(np.uint64) + np.uint64(1)) * _MULT
    return h ^ (h >> np.uint64(32))
