"""Jaccard similarity join of documents on word n-grams.

A document's set holds the 64-bit hashes of its distinct n-word shingles.
Documents are compared under one total order of shingles, rarest first, so
that two sets above the threshold share a shingle of their short prefixes.

1. Counts. Each task sends its shingles, packed by hash range, to the task that
   counts this range over the whole corpus; a shingle that a task meets often
   goes as one count. The shingles of more than one set come back.
2. Prefixes. The other shingles are the rarest and link with nothing, so most
   prefixes hold nothing that is shared and end here. The rest meet in buckets.
3. Forests. In each bucket the length filter, the positional filter and a bound
   by parities of hash bins leave the pairs that may link; a spanning forest of
   them, likeliest first, is verified. A bucket of few such pairs sends all.
4. What is left. Buckets with further pairs between different components are
   paired once more around a ring of tiles, and then in full: only pairs with
   an end outside the bucket's largest component remain. So a large group of
   near copies costs a tree and not a clique, and no link is lost.
5. Verification applies the suffix filter and counts the overlap, once a pair.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHash, checkpointed, col, ship

#: Bytes other than white space stay; A-Z are lower-cased.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_A, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Characters of text for one hash range of shingles, and shingles that a task sends at a time.
RANGE_CHARS, CHUNK = 8_000_000, 1 << 20
#: Most ranges; beyond that many times RANGE_CHARS each range grows, and is counted in parts of so many shingles.
MOST_RANGES, PASS = 1 << 18, 1 << 22
#: Sets of a chunk from which a shingle goes as one count.
OFTEN = 8
#: Members of a bucket that are compared in one task.
TILE = 1024
#: Bits of a set's parities.
LEAST_BITS, MOST_BITS = 512, 4096
#: Most rows (v, label) that are broadcast: about 10 MB; more are joined by a shuffle.
BROADCAST_ROWS = 100_000


def shingles(text: str | None, width: int, memo: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text.

    Words are runs of characters other than U+0020 and U+0009 to U+000D. A
    text of fewer words gives one shingle of them all; one without words none.
    """
    words = (text or "").encode().translate(_FOLD).split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    k = min(width, n)
    mixed = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        mixed = (mixed ^ h[i : n - k + 1 + i]) * _A
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * _M1
    mixed = (mixed ^ (mixed >> np.uint64(27))) * _M2
    mixed ^= mixed >> np.uint64(31)
    mixed.sort()
    return mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]


def digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def needed_overlap(nx: int, ny: int, num: int, den: int) -> int:
    """Least intersection of sets of these sizes whose Jaccard is num/den."""
    return -(-num * (nx + ny) // (num + den))


def prefix_length(n, num: int, den: int):
    """How many of a set's rarest shingles must hold one that it shares with any set it links to."""
    return n - -(-num * n // den) + 1


def suffix_bound(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    """Upper bound of the overlap of two sorted sets, by splitting at a pivot."""
    if not len(x) or not len(y) or not depth:
        return min(len(x), len(y))
    pivot = x[len(x) // 2]
    i, j = len(x) // 2, int(np.searchsorted(y, pivot))
    found = int(j < len(y) and y[j] == pivot)
    return suffix_bound(x[:i], y[:j], depth - 1) + found + suffix_bound(x[i + 1 :], y[j + found :], depth - 1)


def similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Exact test den * |x & y| >= num * |x | y|, after the suffix filter."""
    least = needed_overlap(len(x), len(y), num, den)
    if suffix_bound(x, y, 3) < least:
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return den * common >= num * (len(x) + len(y) - common)


def parities(grams: np.ndarray) -> bytes:
    """The parity of a set's shingles in each bin of their lowest hash bits.

    Two sets differ in at least as many shingles as their parities do in bits.
    Of twice as many bins, the halves' exclusive or gives the parities of half.
    """
    bits = min(max(LEAST_BITS, 1 << (2 * len(grams)).bit_length()), MOST_BITS)
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def parity_gap(x: bytes, y: bytes) -> int:
    """How many shingles two sets differ in at least."""
    return (_halved(x, len(y)) ^ _halved(y, len(x))).bit_count()


def _halved(x: bytes, size: int) -> int:
    while len(x) > size:
        half = len(x) // 2
        x = (int.from_bytes(x[:half]) ^ int.from_bytes(x[half:])).to_bytes(half)
    return int.from_bytes(x)


def _pylist(batch: pa.RecordBatch, name: str, step: int = 256) -> Iterator:
    column = batch.column(name)
    for i in range(0, len(column), step):
        yield from column.slice(i, step).to_pylist()


def _text_hash(text: str | None) -> int:
    return xxhash.xxh64_intdigest((text or "").encode()) - 2**63


def _runs(batches, key: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each value of a sorted column of numbers."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.nonzero(k[1:] != k[:-1])[0] + 1).tolist(), len(k)]
        for a, b in zip(cuts, cuts[1:]):
            if held and k[a] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = int(k[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held)


#: Kinds of rows between the steps: documents, shingles with the sets that have them, shingles met often with their
#: counts, these with their sets, the sets of a chunk, shared shingles with their sets, and those met often.
DOC, OWN, MANY, HOME, SETS, SHARED, SHARED_MANY = range(7)
_ROWS = pa.schema([("kind", pa.int8()), ("range", pa.int32()), ("chunk", pa.int64()), ("id", pa.int64()), ("v", pa.binary()), ("n", pa.int64()), ("t", pa.int64()), ("sig", pa.binary()), ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())])
_ROWS_DDL = "kind byte, range int, chunk long, id long, v binary, n long, t long, sig binary, x binary, y binary, z binary"


def _rows(columns: dict[str, list]) -> pa.RecordBatch:
    size = len(columns["kind"])
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * size), f.type) for f in _ROWS], schema=_ROWS)


def _sent(docs: DataFrame, width: int, ranges: int, chunk: int) -> DataFrame:
    """The documents, and each chunk's shingles by range; equal sets of a task are sent once."""

    def packed(number: int, held: list[np.ndarray], names: list[bytes]) -> pa.RecordBatch:
        h = np.concatenate(held)
        owner = np.repeat(np.arange(len(held), dtype=np.uint16), list(map(len, held)))
        key = (((h >> np.uint64(32)) * np.uint64(ranges)) & ~np.uint64(0xFFFFFFFF)) | (h & np.uint64(0xFFFFFFFF))
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        first = np.nonzero(np.concatenate(([True], key[1:] != key[:-1])))[0]
        times = np.diff(np.append(first, len(key)))
        often = np.repeat(times >= OFTEN, times)
        out = {"kind": [SETS], "range": [number % ranges], "x": [b"".join(names)], "y": [np.array(list(map(len, held)), np.uint32).tobytes()]}

        def put(kind: int, place: int, x: np.ndarray, y: np.ndarray) -> None:
            for name, value in (("kind", kind), ("range", place), ("x", x.tobytes()), ("y", y.tobytes())):
                out[name].append(value)

        def by_range(kind: int, keys: np.ndarray, values: np.ndarray) -> None:
            places = (keys >> np.uint64(32)).astype(np.int64)
            cuts = [0, *(np.nonzero(places[1:] != places[:-1])[0] + 1).tolist(), len(keys)] if len(keys) else []
            low = keys.astype(np.uint32)
            for a, b in zip(cuts, cuts[1:]):
                put(kind, int(places[a]), low[a:b], values[a:b])

        by_range(OWN, key[~often], owner[~often])
        by_range(MANY, key[first][times >= OFTEN], times[times >= OFTEN].astype(np.uint32))
        if often.any():
            put(HOME, number % ranges, key[often], owner[often])
        return _rows(out | {"chunk": [number] * len(out["kind"])})

    def run(batches):
        memo, seen = WordHash(), set()
        number = TaskContext.get().partitionId() << 24
        held, names, total = [], [], 0
        for batch in batches:
            out = {name: [] for name in ("kind", "range", "v", "n", "t", "sig")}
            ready = []
            for text in _pylist(batch, "text"):
                grams = shingles(text, width, memo)
                v, t = digest(grams), _text_hash(text)
                for name, value in (("kind", DOC), ("range", t % ranges), ("v", v), ("n", len(grams)), ("t", t), ("sig", parities(grams))):
                    out[name].append(value)
                if len(grams) and v not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(v)
                    held.append(grams)
                    names.append(v)
                    total += len(grams)
                    if total >= chunk or len(held) == 1 << 16:
                        ready.append(packed(number, held, names))
                        held, names, total, number = [], [], 0, number + 1
            yield _rows(out).set_column(_ROWS.get_field_index("id"), _ROWS.field("id"), batch.column("id"))
            yield from ready
        if held:
            yield packed(number, held, names)

    return docs.mapInArrow(run, _ROWS_DDL)


def _counted(sent: DataFrame) -> DataFrame:
    """Rows of other kinds as they are; of each range, the shingles of more than one set, back by chunk."""

    def of(table: pa.Table, kind: int, dtype) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        part = table.filter(pc.equal(table.column("kind"), kind))
        return part.column("chunk").to_pylist(), [np.frombuffer(x, np.uint32) for x in part.column("x").to_pylist()], [np.frombuffer(y, dtype) for y in part.column("y").to_pylist()]

    def run(batches):
        def others():
            for batch in batches:
                mine = pc.is_in(batch.column("kind"), pa.array([OWN, MANY], pa.int8()))
                passed.append(batch.filter(pc.invert(mine)))
                yield batch.filter(mine)

        passed: list[pa.RecordBatch] = []
        for place, table in _runs(others(), "range"):
            while passed:
                yield passed.pop()
            chunks, keys, owners = of(table, OWN, np.uint16)
            chunks2, keys2, times = of(table, MANY, np.uint32)
            parts = [(OWN, *x) for x in zip(chunks, keys, owners)] + [(MANY, *x) for x in zip(chunks2, keys2, times)]
            out = {name: [] for name in ("kind", "range", "chunk", "x", "y", "z")}
            passes = -(-sum(map(len, keys + keys2)) // PASS)
            for low in range(passes):
                # a chunk's shingles are sorted, so a part of the range is a slice
                ends = [(low << 32) // passes, (low + 1 << 32) // passes]
                cut = [(kind, chunk, key[slice(*at)], value[slice(*at)]) for kind, chunk, key, value in parts for at in [np.searchsorted(key, np.array(ends, np.uint64)).tolist()] if at[0] < at[1]]
                every = np.concatenate([key for _, _, key, _ in cut])
                weight = np.concatenate([np.ones(len(key), np.int64) if kind == OWN else value.astype(np.int64) for kind, _, key, value in cut])
                distinct, back = np.unique(every, return_inverse=True)
                total = np.bincount(back, weights=weight, minlength=len(distinct))
                # the order needs no exact count: eight steps from one power of two to the next
                rank, shared, at = np.minimum(8 * np.log2(total), 255).astype(np.uint8)[back], (total > 1)[back], 0
                for kind, chunk, key, value in cut:
                    ok, r = shared[at : at + len(key)], rank[at : at + len(key)]
                    at += len(key)
                    if ok.any():
                        for name, x in (("kind", SHARED if kind == OWN else SHARED_MANY), ("range", place), ("chunk", chunk), ("x", key[ok].tobytes()), ("y", value[ok].tobytes()), ("z", r[ok].tobytes())):
                            out[name].append(x)
            yield _rows(out)
        while passed:
            yield passed.pop()

    return sent.repartition("range").sortWithinPartitions("range").mapInArrow(run, _ROWS_DDL)


def _prefixes(counted: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (tok, v, n, pos): the shared shingles of each set's rare-first prefix."""

    def run(batches):
        for _, table in _runs(batches, "chunk"):
            owners, keys, ranks = [], [], []
            names, sizes, many_keys, many_ranks, home = b"", np.empty(0, np.int64), [], [], []
            for row in table.select(["kind", "range", "x", "y", "z"]).to_pylist():
                place, kind = np.uint64(row["range"]) << np.uint64(32), row["kind"]
                if kind == SETS:
                    names, sizes = row["x"], np.frombuffer(row["y"], np.uint32).astype(np.int64)
                elif kind == HOME:
                    home.append((np.frombuffer(row["x"], np.uint64), np.frombuffer(row["y"], np.uint16)))
                elif kind == SHARED:
                    keys.append(np.frombuffer(row["x"], np.uint32).astype(np.uint64) | place)
                    owners.append(np.frombuffer(row["y"], np.uint16))
                    ranks.append(np.frombuffer(row["z"], np.uint8))
                else:
                    many_keys.append(np.frombuffer(row["x"], np.uint32).astype(np.uint64) | place)
                    many_ranks.append(np.frombuffer(row["z"], np.uint8))
            if many_keys:
                known, rank = np.concatenate(many_keys), np.concatenate(many_ranks)
                order = np.argsort(known)
                for key, owner in home:
                    keys.append(key)
                    owners.append(owner)
                    ranks.append(rank[order[np.searchsorted(known, key, sorter=order)]])
            if not keys:
                continue
            key, owner, rank = np.concatenate(keys), np.concatenate(owners).astype(np.int64), np.concatenate(ranks)
            shared = np.bincount(owner, minlength=len(sizes))
            alone, long = sizes - shared, prefix_length(sizes, num, den)
            some = (alone < long)[owner]
            key, owner, rank = key[some], owner[some], rank[some]
            order = np.lexsort((key, rank, owner))
            key, owner = key[order], owner[order]
            begins = np.searchsorted(owner, np.arange(len(sizes)))
            pos = alone[owner] + np.arange(len(owner)) - begins[owner]
            inside = pos < long[owner]
            key, owner, pos = key[inside], owner[inside], pos[inside]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array([names[16 * i : 16 * i + 16] for i in owner.tolist()], pa.binary()), pa.array(sizes[owner]), pa.array(pos)], names=["tok", "v", "n", "pos"])

    rows = counted.where(F.col("kind") >= HOME).select("kind", "range", "chunk", "x", "y", "z")
    return rows.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, "tok long, v binary, n long, pos long")


class _Members:
    """The members of a bucket or tile: which pairs of them may link, and how far apart these are at least."""

    def __init__(self, rows: list[tuple], num: int, den: int):
        self.v, n, pos, label, self.sig = zip(*rows)
        self.n, self.pos = np.array(n, np.int64), np.array(pos, np.int64)
        self.label = np.unique(np.array([x.hex() for x in label]), return_inverse=True)[1]
        self.num, self.den = num, den
        self.size = np.array(list(map(len, self.sig)))
        #: for each size of parities: the members of just that size, and all of at least that, with their words
        self.words = {}
        for s in np.unique(self.size).tolist():
            at = np.nonzero(self.size >= s)[0]
            words = np.stack([np.frombuffer(_halved(self.sig[i], s).to_bytes(s), np.uint64) for i in at.tolist()])
            own = np.nonzero(self.size[at] == s)[0]
            self.words[s] = at, words, at[own], words[own], dict(zip(at.tolist(), range(len(at))))

    def gaps(self, i: int) -> np.ndarray:
        """The least difference to each member, or a very large one if they can't link."""
        gap = np.zeros(len(self.v), np.int64)
        for s, (at, words, own, own_words, place) in self.words.items():
            if s <= self.size[i]:
                members, rows = (at, words) if s == self.size[i] else (own, own_words)
                gap[members] = np.bitwise_count(rows ^ words[place[i]]).sum(1, dtype=np.int64)
        n, m, num, den = self.n[i], self.n, self.num, self.den
        both = n + m
        ok = (den * np.minimum(n, m) >= num * np.maximum(n, m)) & ((1 + np.minimum(n - self.pos[i] - 1, m - self.pos - 1)) * (num + den) >= num * both) & ((both - gap) * (num + den) >= 2 * num * both) & (self.label != self.label[i])
        return np.where(ok, gap, _FAR)


_FAR = 1 << 40


def _few(rows: list[tuple], num: int, den: int) -> list[tuple[int, int, int]]:
    """(gap, i, j) of the pairs of a small bucket that may link."""
    out = []
    for i, (_, n, pos, label, sig) in enumerate(rows):
        for j in range(i):
            _, m, mpos, other, msig = rows[j]
            if label != other and den * min(n, m) >= num * max(n, m) and (1 + min(n - pos - 1, m - mpos - 1)) * (num + den) >= num * (n + m):
                gap = parity_gap(sig, msig)
                if (n + m - gap) * (num + den) >= 2 * num * (n + m):
                    out.append((gap, i, j))
    return out


def _forest(members: _Members) -> tuple[list[tuple[int, int]], bool]:
    """Pairs that may link: all if they are few, else a spanning forest by Prim's method on labels; and whether there are more."""
    m = len(members.v)
    best, near, out = np.full(m, _FAR), np.zeros(m, np.int64), np.ones(m, bool)
    edges, every = [], []
    while out.any():
        j = int(np.argmin(np.where(out, best, _FAR + 1)))
        if best[j] < _FAR:
            edges.append((j, int(near[j])))
        for i in np.nonzero(out & (members.label == members.label[j]))[0].tolist():
            out[i] = False
            gap = np.where(out, members.gaps(i), _FAR)
            if len(every) <= 2 * m:
                every += [(i, k) for k in np.nonzero(gap < _FAR)[0].tolist()]
            closer = gap < best
            best[closer], near[closer] = gap[closer], i
    return (every, False) if len(every) <= 2 * m else (edges, True)


def _candidates(rows: DataFrame, num: int, den: int, last: bool = False, back: bool = False) -> DataFrame:
    """Rows (tok, a, b): pairs to verify, and with null ends the buckets that have more.

    ``rows`` have a number for each tile. Tiles of few such pairs give them
    all, others a forest, or the last time all of them. ``back`` reverses
    which of equally likely pairs come first.
    """
    names = ("tile", "tok", "v", "n", "pos", "label", "sig")

    def of(tok: int, rows: list[tuple]) -> list[tuple]:
        if len(rows) <= 6:
            return [(tok, rows[i][0], rows[j][0]) for _, i, j in _few(rows, num, den)]
        if all(r[3] == rows[0][3] for r in rows):
            return []
        members = _Members(rows, num, den)
        if not last:
            pairs, more = _forest(members)
            return [(tok, rows[i][0], rows[j][0]) for i, j in pairs] + [(tok, None, None)] * more
        # all members meet those outside the largest component
        common = np.bincount(members.label).argmax()
        return [(tok, rows[i][0], rows[j][0]) for i in np.nonzero(members.label != common)[0].tolist() for j in np.nonzero(members.gaps(i) < _FAR)[0].tolist()]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        tok, a, b = zip(*found) if found else ((), (), ())
        ends = [(x, y) if x is None or x > y else (y, x) for x, y in zip(a, b)]
        return pa.RecordBatch.from_arrays([pa.array(tok, pa.int64()), pa.array([x for x, _ in ends], pa.binary()), pa.array([y for _, y in ends], pa.binary())], names=["tok", "a", "b"])

    def run(batches):
        rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in names)))
        found: list[tuple] = []
        for _, group in groupby(rows, itemgetter(0)):
            group = list(group)
            found += of(group[0][1], sorted((r[2:] for r in group), key=itemgetter(0), reverse=back))
            if len(found) >= 5_000:
                yield batch(found)
                found = []
        yield batch(found)

    return rows.select(*names).repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "tok long, a binary, b binary")


#: Bits of the filter of wanted sets: at most 16 MB.
_BLOOM_MIN, _BLOOM_MAX = 1 << 16, 1 << 27


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Rows (v, grams): the sets of the vertices in ``wanted`` (v, t), t the hash of one of its texts.

    A bitmap of fixed size over the hashes drops nearly all other documents
    in the map before their shingles are made; the join makes it exact.
    """
    sc = docs.sparkSession.sparkContext
    wanted = checkpointed(wanted)
    bits = _BLOOM_MIN
    while bits < min(_BLOOM_MAX, 64 * wanted.count()):
        bits *= 2
    at = F.pmod("t", F.lit(bits)) + 1  # the functions count from 1
    rows = wanted.select(at.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("m")).collect()
    bitmap = bytearray(bits // 8 + 4096)
    for row in rows:
        bitmap[(row.k - 1) * 4096 : row.k * 4096] = row.m
    shared = sc.broadcast(bytes(bitmap))

    def run(batches):
        memo, seen, bitmap = WordHash(), set(), shared.value
        for batch in batches:
            vs, sets = [], []
            for text in _pylist(batch, "text"):
                t = _text_hash(text)
                h = t % bits
                if bitmap[h >> 3] >> (h & 7) & 1 and t not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(t)
                    grams = shingles(text, width, memo)
                    vs.append(digest(grams))
                    sets.append(grams.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(vs, pa.binary()), pa.array(sets, pa.binary())], names=["v", "grams"])

    found = docs.select("text").mapInArrow(run, "v binary, grams binary")
    return found.join(wanted.select("v"), "v", "left_semi").groupBy("v").agg(F.first("grams").alias("grams"))


def _verified(docs: DataFrame, pairs: DataFrame, vertices: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link, each tested once on its whole sets."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct()
    sets = _sets(docs, ends.join(vertices.select("v", "t"), "v"), width)
    x, y = (sets.select(F.col("v").alias(side), F.col("grams").alias(f"g{side}")) for side in "ab")
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "ga", "gb")

    def run(batches):
        for batch in batches:
            ok = [similar(np.frombuffer(g, np.uint64), np.frombuffer(h, np.uint64), num, den) for g, h in zip(_pylist(batch, "ga"), _pylist(batch, "gb"))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (v, label), label the least vertex.

    Alternates large-star and small-star steps until each vertex has one edge,
    to a vertex that has none upwards; vertices without edges do not appear.
    """
    oriented = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges = checkpointed(oriented(edges))
    while True:
        ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select("b", F.lit(0), F.lit(1)))
        state = ends.groupBy("v").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).agg(F.count_if(F.expr("up > 1 or (up > 0 and down > 0)")).alias("open"), F.sum("up").alias("edges")).first()
        if not state.open:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("label")).union(edges.select("b", "b")).distinct()
        small = F.broadcast if 2 * state.edges <= BROADCAST_ROWS else lambda df: df
        around = edges.union(edges.select(F.col("b"), F.col("a")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = oriented(around.join(small(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        lower = large.join(small(low), "a")
        edges = checkpointed(oriented(lower.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lower.select("a", "m"))))


def _settle(spark) -> None:
    """Let Spark drop the shuffles of steps whose results are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (8, 10), tile: int = TILE) -> DataFrame:
    """Link documents whose shingle sets have at least the given Jaccard similarity.

    Returns one row per input row: ``id``, ``n_shingles`` and ``component_id``,
    the smallest id reachable by links. Null and empty texts have no shingles
    and link with nothing. Rows with a null id count for links but never give
    a component its name; such a row alone has a null component. Repeated ids
    stay separate rows. Other columns are ignored; an empty table gives none.
    The rows of a partition must come in the same order whenever it is read,
    as those of files and checkpoints do.
    """
    num, den = threshold
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = min(max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // RANGE_CHARS)), MOST_RANGES)
    counted = checkpointed(_counted(_sent(docs, width, ranges, min(max(CHUNK, 64 * ranges), 16 * CHUNK))))
    _settle(spark)
    members = counted.where(F.col("kind") == DOC).select("id", "v", "n", "t", "sig")

    entries = _shared(_prefixes(counted, num, den), num, den)
    vertices = members.where("n > 0").join(entries.select("v").distinct(), "v", "left_semi")
    vertices = checkpointed(vertices.groupBy("v").agg(F.min("t").alias("t"), F.first("sig").alias("sig")))
    known = linked(entries, vertices.select("v", "sig"), lambda pairs: _verified(docs, pairs, vertices, width, num, den), num, den, tile)

    least = members.where("n > 0").groupBy("v").agg(F.min("id").alias("id")).join(known, "v", "left").withColumn("label", F.coalesce("label", "v"))
    least = checkpointed(least)
    names = least.groupBy("label").agg(F.min("id").alias("component_id"))
    named = least.join(names, "label").select("v", "component_id")
    result = members.where("n > 0").join(named, "v").select("id", F.col("n").alias("n_shingles"), "component_id")
    return result.unionAll(members.where("n = 0").select("id", "n", "id")).withColumnRenamed("id", id_col)


def _shared(entries: DataFrame, num: int, den: int) -> DataFrame:
    """Entries (tok, v, n, pos), each once, of buckets with two sets of similar size, and the bucket's ``size``."""
    entries = entries.repartition("tok").groupBy("tok", "v").agg(F.first("n").alias("n"), F.min("pos").alias("pos"))
    # by size, a neighbour in the bucket is the closest there is
    by_size = _by("tok").orderBy("n")
    entries = entries.withColumns({"size": F.count("*").over(_by("tok")), "less": F.lag("n").over(by_size), "more": F.lead("n").over(by_size)})
    return checkpointed(entries.where(f"{den} * less >= {num} * n or {den} * n >= {num} * more").drop("less", "more"))


def linked(entries: DataFrame, parities: DataFrame, verify: Callable[[DataFrame], DataFrame], num: int, den: int, tile: int = TILE) -> DataFrame:
    """Components (v, label) of the sets that link.

    ``entries`` are as ``_shared`` gives them, ``parities`` rows (v, sig), and
    ``verify`` keeps the pairs (a, b) that link.
    """
    spark = entries.sparkSession
    rows = entries.join(parities, "v").withColumn("label", F.col("v"))
    known = tried = None
    for step in range(3):
        rows = [_own_tiles, _ring_tiles, _last_tiles][step](rows, tile)
        found = checkpointed(_candidates(rows, num, den, last=step == 2, back=step == 1))
        pairs = found.where("a is not null").select("a", "b").distinct()
        pairs = checkpointed(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        links = checkpointed(verify(pairs))
        tried = pairs if tried is None else tried.unionAll(pairs)
        if known is not None:
            links = links.unionAll(known.select(F.col("v").alias("a"), F.col("label").alias("b")))
        known = checkpointed(components(links))
        _settle(spark)
        if step < 2:
            more = found.where("a is null").select("tok").union(entries.where(F.col("size") > tile).select("tok")).distinct()
            rows = checkpointed(_mixed(entries.join(more, "tok", "left_semi"), known))
            if rows.isEmpty():
                break
            rows = rows.join(parities, "v")
    return known


def _mixed(entries: DataFrame, known: DataFrame) -> DataFrame:
    """Entries with their labels, of buckets with several components."""
    small = known.count() <= BROADCAST_ROWS
    own = entries.join(F.broadcast(known) if small else known, "v", "left").withColumn("label", F.coalesce("label", "v"))
    return own.withColumns({"lo": F.min("label").over(_by("tok")), "hi": F.max("label").over(_by("tok"))}).where("lo != hi").drop("lo", "hi")


def _dealt(salt: int, count: Column) -> Column:
    return F.pmod(F.xxhash64("v", F.lit(salt)), count)


def _own_tiles(rows: DataFrame, tile: int) -> DataFrame:
    """Each bucket in tiles that are joined for themselves."""
    return rows.withColumn("tile", F.xxhash64("tok", _dealt(0, F.ceil(F.col("size") / tile))))


def _ring_tiles(rows: DataFrame, tile: int) -> DataFrame:
    """Each tile of a bucket with the next one, the last with the first."""
    rows = rows.withColumn("count", F.ceil(F.col("size") / tile)).withColumn("i", _dealt(0, F.col("count")))
    ring = F.array_distinct(F.array(F.col("i"), F.pmod(F.col("i") + 1, F.col("count"))))
    return rows.withColumn("i", F.explode(ring)).withColumn("tile", F.xxhash64("tok", "i"))


def _last_tiles(rows: DataFrame, tile: int) -> DataFrame:
    """Blocks of the members outside a bucket's largest component, each with blocks of all its members."""
    rows = rows.withColumn("_of", F.count("*").over(_by("tok", "label")))
    rows = rows.withColumn("_most", F.max(F.struct("_of", "label")).over(_by("tok"))).withColumn("minor", F.col("label") != F.col("_most.label"))
    rows = rows.withColumns({"all_": F.count("*").over(_by("tok")), "minors": F.count_if("minor").over(_by("tok"))})
    rows = rows.withColumns({"ca": F.ceil(F.col("all_") / tile), "cm": F.ceil(F.col("minors") / tile)}).withColumns({"i": _dealt(1, F.col("ca")), "j": _dealt(2, F.col("cm"))})
    pair = lambda i, j: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"))
    up_to = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c).cast("long") - 1)
    as_member = F.transform(up_to("cm"), lambda j: pair(F.col("i"), j))
    as_minor = F.filter(F.transform(up_to("ca"), lambda i: pair(i, F.col("j"))), lambda p: p["i"] != F.col("i"))
    places = F.when(F.col("minor"), F.concat(as_member, as_minor)).otherwise(as_member)
    return rows.withColumn("at", F.explode(places)).withColumn("tile", F.xxhash64("tok", "at.i", "at.j"))


def _by(*names: str):
    return Window.partitionBy(*names)
