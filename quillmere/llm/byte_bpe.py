"""Byte-level BPE encoding and decoding by longest match and backtracking.

Bytes are mapped to Latin-1 so that an Aho-Corasick automaton finds every vocabulary entry
in a piece. Encoding takes the longest entry at each place; two neighbours are kept only if
merging their bytes alone gives just these two (told from how each is formed at its ends, and memoised), else the shorter entry or the
place before is tried. A place that led nowhere is never tried again, so the work is linear
in the piece. A sequence whose neighbours are all compatible is the one that the merges give.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quillmere.llm.common import arrow_map, keep, text_list
from quillmere.llm.neighbours import apart, ends
from quillmere.llm.unicode_tables import older, recent

#: Bounds of the memos of a worker: pieces, pairs of neighbours, and how entries are formed.
MEMO_PIECES, MEMO_PAIRS, MEMO_SHAPES, MEMO_LENGTH = 200_000, 1_000_000, 16_384, 64
#: Characters beyond which the pieces of a text are encoded in batches, and pieces in a batch.
LONG, BATCH_PIECES = 2_000_000, 250_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines `base64 rank`."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class ByteBPE:
    """ranks: bytes -> rank, with every single byte among them; pattern splits text before the merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.older = regex.compile(older(pattern))
        self.bytes_of = {r: b for b, r in ranks.items()}
        self._find = ahocorasick.Automaton()
        for b, r in ranks.items():
            self._find.add_word(b.decode("latin-1"), (r, len(b)))
        self._find.make_automaton()
        self._shorter: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[tuple, bool] = {}
        self._shapes: dict[int, tuple[tuple, tuple] | None] = {}
        self._memo: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def merged(self, b: bytes) -> list[int]:
        """Plain merging, lowest rank first and leftmost among equals; for short byte strings."""
        parts = [b[i : i + 1] for i in range(len(b))]
        while len(parts) > 1:
            best, at = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, *ids: int) -> bool:
        """Whether these entries, one or two, stay as they are when their bytes are merged alone."""
        if (known := self._fits.get(ids)) is None:
            if len(self._fits) >= MEMO_PAIRS:
                self._fits.clear()
            shapes = [self._shape(i) for i in ids]
            known = self._fits[ids] = None not in shapes and (len(ids) == 1 or apart(shapes[0][1], shapes[1][0], self._rank))
        return known

    def _rank(self, a: bytes, b: bytes) -> int | None:
        return self.ranks.get(a + b)

    def _shape(self, i: int) -> tuple[tuple, tuple] | None:
        """How an entry is formed at its ends."""
        if i not in self._shapes:
            if len(self._shapes) >= MEMO_SHAPES:
                self._shapes.clear()
            b = self.bytes_of[i]
            self._shapes[i] = ends([b[k : k + 1] for k in range(len(b))], self._rank)
        return self._shapes[i]

    def shorter(self, i: int) -> tuple[int, int] | None:
        """The longest entry that is a proper prefix of entry i, and its length."""
        if i not in self._shorter:
            b = self.bytes_of[i]
            self._shorter[i] = next(((self.ranks[b[:n]], n) for n in range(len(b) - 1, 0, -1) if b[:n] in self.ranks), None)
        return self._shorter[i]

    def piece(self, b: bytes) -> list[int]:
        """Ids of one piece."""
        if (whole := self.ranks.get(b)) is not None:
            return [whole]
        n, fits = len(b), self._fits
        longest: list[tuple] = [None] * n  # (id, length) of the longest entry from each place
        for end, entry in self._find.iter(b.decode("latin-1")):
            longest[end + 1 - entry[1]] = entry  # ends grow, so the last is the longest
        out: list[tuple] = []
        dead, at, entry = None, 0, longest[0]
        while at < n:
            while entry is not None:
                if dead is None or at + entry[1] not in dead:
                    pair = (out[-1][0], entry[0]) if out else (entry[0],)
                    ok = fits.get(pair)
                    if self.fits(*pair) if ok is None else ok:
                        break
                entry = self.shorter(entry[0])
            if entry is not None:
                out.append(entry)
                at += entry[1]
                entry = longest[at] if at < n else None
            else:
                dead = dead or set()
                dead.add(at)
                last = out.pop()
                at -= last[1]
                entry = self.shorter(last[0])
        return [e[0] for e in out]

    def _packed(self, piece: str) -> bytes:
        """Packed ids of a piece. Of known pieces, those not asked for in the last MEMO_PIECES new ones are forgotten."""
        ids = self._old.get(piece) or np.array(self.piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= MEMO_LENGTH:
            if len(self._memo) >= MEMO_PIECES:
                self._old, self._memo = self._memo, {}
            self._memo[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        pattern = self.older if recent(text) else self.pattern
        if len(text) <= LONG:
            return self._coded(pattern.findall(text))
        # matched over the whole text, as the pattern looks past a piece's end; only one batch of pieces is held
        found = (m[0] for m in pattern.finditer(text))
        return b"".join(map(self._coded, iter(lambda: [*islice(found, BATCH_PIECES)], [])))

    def _coded(self, pieces: list[str]) -> bytes:
        ids, i = list(map(self._memo.get, pieces)), -1
        for _ in range(ids.count(None)):
            i = ids.index(None, i + 1)
            ids[i] = self._memo.get(pieces[i]) or self._packed(pieces[i])
        return b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of little-endian unsigned 32-bit ids."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> ByteBPE:
    """One per worker and vocabulary."""
    return ByteBPE(load_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids array<int> (unless with_ids is false), ids_sha256, decoded_sha256 of each row of docs.

    The ids of the whole text, without special tokens; decoded_sha256 is of the bytes that the ids
    decode to, so it equals the text's own hash. Null text counts as empty: no ids, hashes of nothing.
    A null id stays null; repeated rows give a row each; other columns are left out; an empty table gives none.
    """

    def run(b: pa.RecordBatch) -> dict:
        c = coder(path, pattern)
        ids = [c.encode(t) for t in text_list(b.column("text"))]
        out = {"doc_id": b.column("doc_id"), "n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids], "decoded_sha256": [hashlib.sha256(c.decode(x)).hexdigest() for x in ids]}
        if with_ids:
            flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *out["n_tokens"]]), pa.int32()), pa.array(flat))
        return out

    return arrow_map(keep(docs, doc_id=id_col, text=text_col), run, "doc_id long, n_tokens long, " + "ids array<int>, " * with_ids + "ids_sha256 string, decoded_sha256 string")


def decode(rows: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of the ids of each row; null ids give an empty text, bytes that are no UTF-8 become U+FFFD."""

    def run(b: pa.RecordBatch) -> dict:
        c = coder(path, pattern)
        return {"doc_id": b.column("doc_id"), "text": [b"".join(map(c.bytes_of.__getitem__, x or ())).decode("utf-8", "replace") for x in b.column("ids").to_pylist()]}

    return arrow_map(keep(rows, doc_id=id_col, ids=ids_col), run, "doc_id long, text string")
