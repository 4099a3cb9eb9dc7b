"""SentencePiece BPE encoding by backtracking, and decoding.

The library merges the best-scored adjacent pair until none is left. The same
pieces come out of a left-to-right search: take the longest piece at a
position (all are found by one Aho-Corasick run over the reversed string),
accept it if it is compatible with the piece before it, else try its next
shorter prefix piece, else step back, and never try a position again from
which the search has failed. Two pieces are compatible if merging their joined
text gives back just these two.

No piece has a word mark after another character, so no merge crosses the
start of a run of marks; and no piece has a character outside the vocabulary,
so none crosses one of those. Between such points strings are encoded on their
own, and those seen last are remembered.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
import struct
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import attach

#: U+2581, the mark that stands for a space.
MARK = "▁"


#: Texts by which a model is told apart that normalises, drops spaces, adds no dummy prefix or has no byte fallback.
PROBES = ("", " ", "a", " a", "a  b ", "\t\n", "Ａ ﬁ ① é é", "😀\u0378\U000e0001", "\u2028\u00a0x", "Der Rat, 12 % <b>!", "zzzqqq日本語")


class PieceCodec:
    """Encoder and decoder of a BPE model with byte fallback and no normalisation."""

    REMEMBERED = 250_000

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.bytes_ids = [0] * 256
        self.surface: list[bytes] = [b""] * size
        self.byte_of: dict[int, int] = {}
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_of[i] = int(piece[1:-1], 16)
                self.bytes_ids[self.byte_of[i]] = i
            elif sp.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif not sp.is_control(i):
                self.id_of[piece], self.score[piece] = i, sp.get_score(i)
                self.surface[i] = piece.replace(MARK, " ").encode()
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("a piece holds a word mark after another character")
        self.chars = {p for p in self.id_of if len(p) == 1}
        own = [p for p in self.id_of if len(p) == 1 or self.merged(p) == [p]]
        if len(own) < len(self.id_of):
            raise ValueError("a piece is not the merge of its own characters")
        self.finder = ahocorasick.Automaton()
        for p in own:
            self.finder.add_word(p[::-1], len(p))
        self.finder.make_automaton()
        #: the longest piece that is a proper prefix of a piece, "" if none is
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id_of), "") for p in own}
        self._compatible: dict[tuple[str, str], bool] = {}
        self._segments: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        # where no piece mixes letters with other characters, strings also part between the two;
        # letters of the few mixed pieces count as other characters, if that leaves none mixed
        letter, other = rf"[^{MARK}\n]+", rf"[^{MARK}\n]+"
        of = re.compile(r"[^\W\d_]").match
        kinds = lambda p, odd: {bool(of(c)) and c not in odd for c in p.lstrip(MARK)}
        odd = {c for p in self.id_of if len(kinds(p, "")) > 1 for c in p if of(c)}
        if all(len(kinds(p, odd)) < 2 for p in self.id_of):
            inner = rf"[^\W\d_{re.escape(''.join(sorted(odd)))}]"
            letter, other = f"{inner}+", rf"(?:(?!{inner})[^{MARK}\n])+"
        self._split = re.compile(rf"{MARK}+(?:{letter}|{other})?|{letter}|{other}|\n" if "\n" not in self.chars else rf"{MARK}+[^{MARK}]*|[^{MARK}]+")

        for probe in PROBES:
            if self.encode(probe) != struct.pack("<%dI" % len(ids := sp.encode(probe, add_bos=True, add_eos=True)), *ids):
                raise ValueError(f"the model treats {probe!r} in another way: it must not normalise, and must have a dummy prefix and byte fallback")

    def merged(self, text: str) -> list[str]:
        """Pieces by merging best-scored pairs, leftmost first among equals."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        queue: list[tuple[float, int, str, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (both := parts[i] + parts[j]) in self.score:
                heapq.heappush(queue, (-self.score[both], i, both, j))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, both, j = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or right[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j], right[i] = both, None, right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None]

    def compatible(self, a: str, b: str) -> bool:
        if len(self._compatible) >= self.REMEMBERED:
            self._compatible.clear()
        known = self._compatible[a, b] = self.merged(a + b) == [a, b]
        return known

    def backtrack(self, text: str) -> list[str]:
        """The pieces of a string of known characters."""
        n = len(text)
        longest = [0] * n
        for end, k in self.finder.iter(text[::-1]):
            start = n - 1 - end
            if k > longest[start]:
                longest[start] = k
        failed = bytearray(n + 1)  # a flag for each position from which the search has failed
        known, shorter = self._compatible, self.shorter
        out: list[str] = []
        at, last = 0, ""
        piece = text[: longest[0]] if n else ""
        while at < n:
            while piece:
                if not failed[at + len(piece)]:
                    ok = known.get((last, piece)) if last else True
                    if ok is None:
                        ok = self.compatible(last, piece)
                    if ok:
                        break
                piece = shorter[piece]
            if piece:
                out.append(piece)
                at += len(piece)
                last = piece
                piece = text[at : at + longest[at]] if at < n else ""
                continue
            failed[at] = 1
            if not out:
                raise ValueError(f"no encoding of {text!r}")
            at -= len(last)
            piece = shorter[out.pop()]
            last = out[-1] if out else ""
        return out

    def _known(self, text: str) -> list[int]:
        return [self.id_of[p] for p in self.backtrack(text)]

    def _segment(self, text: str) -> bytes:
        if self.chars.issuperset(text):
            ids = self._known(text)
            return struct.pack(f"<{len(ids)}I", *ids)
        ids = []
        run: list[str] = []
        for c in text:
            if c in self.chars:
                run.append(c)
                continue
            if run:
                ids += self._known("".join(run))
                run = []
            ids += [self.bytes_ids[b] for b in c.encode()]
        if run:
            ids += self._known("".join(run))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, with begin and end ids."""
        known = self._segments
        parts = [struct.pack("<I", self.bos)]
        if text:
            for s in self._split.findall(MARK + text.replace(" ", MARK)):
                if (ids := known.get(s)) is None:
                    if (ids := self._older.get(s)) is None:
                        ids = self._segment(s)
                    if len(s) <= 64:
                        if len(known) >= self.REMEMBERED:
                            self._older, self._segments = known, {}
                            known = self._segments
                        known[s] = ids
                parts.append(ids)
        parts.append(struct.pack("<I", self.eos))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """Text of ids; each byte that is no part of valid UTF-8 becomes U+FFFD."""
        surface, byte_of, parts, raw = self.surface, self.byte_of, [], bytearray()
        first = True
        for (i,) in struct.iter_unpack("<I", ids):
            if i in byte_of:
                raw.append(byte_of[i])
                first = False
                continue
            if raw:
                parts.append(_utf8(bytes(raw)))
                raw = bytearray()
            s = surface[i]
            if first and s:
                s, first = s.removeprefix(b" "), False
            parts.append(s)
        if raw:
            parts.append(_utf8(bytes(raw)))
        return b"".join(parts).decode()


def _utf8(raw: bytes) -> bytes:
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for k in (1, 2, 3, 4):
                try:
                    raw[i : i + k].decode()
                    out.append(raw[i : i + k])
                    i += k
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�".encode())
                i += 1
        return b"".join(out)


def _working(model: bytes, work):
    """A task's function of a codec, with the collector's walks over its memories put off until the task ends."""
    codec, before = PieceCodec(model), gc.get_threshold()
    gc.freeze()
    gc.set_threshold(500_000, 20, 100)

    def run(rows):
        return work(codec, rows)

    def done():
        gc.set_threshold(*before)
        gc.unfreeze()

    run.done = done
    return run


def encode_pieces(docs: DataFrame, model_path: str, text_col: str = "text", decoded: bool = True, keep: Iterable[str] | None = None) -> DataFrame:
    """Add ``ids`` (array of int) and, if asked, ``decoded`` to each document.

    A null text counts as empty: begin and end ids, decoded as the empty text.
    Rows are independent; repeated ones give equal results. ``keep`` names the
    columns to carry, all by default; those named like new ones are replaced.
    The model file is read on the driver and shipped by broadcast.
    """
    fields = {"ids": pa.list_(pa.int32())} | ({"decoded": pa.string()} if decoded else {})
    shared = docs.sparkSession.sparkContext.broadcast(open(model_path, "rb").read())

    def work(codec, rows):
        ids = [codec.encode(t or "") for t in rows["text"]]
        out = {"ids": [list(memoryview(x).cast("i")) for x in ids]}
        return out | ({"decoded": [codec.decode(x) for x in ids]} if decoded else {})

    def factory():
        return _working(shared.value, work)

    return attach(docs, {"text": text_col}, factory, fields, docs.columns if keep is None else keep)


def encode_digests(docs: DataFrame, model_path: str, text_col: str = "text", keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """As ``encode_pieces``, but digests: ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``."""
    fields = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    shared = docs.sparkSession.sparkContext.broadcast(open(model_path, "rb").read())

    def work(codec, rows):
        ids = [codec.encode(t or "") for t in rows["text"]]
        return {"n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids], "decoded_sha256": [hashlib.sha256(codec.decode(x).encode()).hexdigest() for x in ids]}

    def factory():
        return _working(shared.value, work)

    return attach(docs, {"text": text_col}, factory, fields, keep)
