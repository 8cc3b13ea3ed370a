"""Token counts at every prefix of a text, by dynamic programming over prefixes.

For a BPE with word ends, the encoding of a word's prefix is the encoding of a shorter prefix
and one more entry: the one entry, among those that end there, whose neighbour on the left
stays apart from it when both are merged alone. So one pass over a word gives the last entry
and the count at each of its prefixes. A text is tokenised once: the counts of its words' prefixes, added up along the
text, are stored as one array, and counts, truncation and budget questions are look-ups in it.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmere.llm.common import arrow_map, keep, text_list
from quillmere.llm.neighbours import apart, ends
from quillmere.llm.unicode_tables import NEW_CAPITALS, older, recent

#: Bounds of a worker's memos.
MEMO_WORDS, MEMO_PREFIXES, MEMO_PAIRS, MEMO_SHAPES, MEMO_LENGTH = 250_000, 600_000, 1_000_000, 16_384, 48
END = "</w>"


def byte_letters() -> dict[int, str]:
    """The usual letters for bytes: printable Latin-1 for itself, the others from U+0100 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class PrefixCounter:
    """Counts for a tokenizer file: a byte-level BPE with word ends, lower-cased words, special strings as one token."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab = set(model["vocab"])
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.longest = max(map(len, self.vocab))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.older = regex.compile(older(split["pattern"]["Regex"]))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.letters = {ord(chr(b)): c for b, c in byte_letters().items()}
        self._counts: dict[str, bytes] = {}
        self._old_counts: dict[str, bytes] = {}
        self._prefix: dict[str, tuple[str, int]] = {}
        self._ends: dict[str, int] = {}
        self._shapes: dict[str, tuple[tuple, tuple] | None] = {}
        self._fits: dict[tuple, bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain merging of short symbol lists, first rule first and leftmost among equals."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best, at = min((self.rank.get((symbols[i], symbols[i + 1]), 1 << 60), i) for i in range(len(symbols) - 1))
            if best == 1 << 60:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    @staticmethod
    def symbols(token: str) -> list[str]:
        """A token's single letters; a word end belongs to the last of them."""
        if len(token) > len(END) and token.endswith(END):
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    def fits(self, *tokens: str) -> bool:
        """Whether one token, or two neighbours, stay as they are when merged alone."""
        if (known := self._fits.get(tokens)) is None:
            if len(self._fits) >= MEMO_PAIRS:
                self._fits.clear()
            shapes = [self._shape(t) for t in tokens]
            known = self._fits[tokens] = None not in shapes and (len(tokens) == 1 or apart(shapes[0][1], shapes[1][0], self._rank))
        return known

    def _rank(self, a: str, b: str) -> int | None:
        return self.rank.get((a, b))

    def _shape(self, token: str) -> tuple[tuple, tuple] | None:
        """How a token, one of the vocabulary, is formed at its ends."""
        if token not in self._shapes:
            if len(self._shapes) >= MEMO_SHAPES:
                self._shapes.clear()
            self._shapes[token] = ends(self.symbols(token), self._rank)
        return self._shapes[token]

    def _last(self, word: str, n: int, end: str, before) -> tuple[str, int]:
        """Last entry and count of word[:n] (as a whole word if end), given those of its proper prefixes."""
        for size in range(min(n, self.longest), 0, -1):
            token = word[n - size : n] + end
            if token in self.vocab:
                if size == n:
                    if self.fits(token):
                        return token, 1
                else:
                    last, count = before(n - size)
                    if self.fits(last, token):
                        return token, count + 1
        raise ValueError(f"no encoding for {word[:n]!r}")

    def _inner(self, word: str, upto: int):
        """States of the prefixes of word of 1..upto letters, without a word end."""
        if len(word) > MEMO_LENGTH:
            states: list[tuple[str, int]] = [("", 0)]
            for n in range(1, upto + 1):
                states.append(self._last(word, n, "", states.__getitem__))
            return states.__getitem__
        # the known prefixes of a word are always its first few: they are added in order and forgotten together
        known, vocab, fits, longest = self._prefix, self.vocab, self._fits, self.longest
        if len(known) >= MEMO_PREFIXES:
            known.clear()
        n = upto
        while n > 0 and word[:n] not in known:
            n -= 1
        for k in range(n + 1, upto + 1):
            for a in range(max(0, k - longest), k):
                token = word[a:k]
                if token in vocab:
                    state = known[word[:a]] if a else None
                    pair = (state[0], token) if a else (token,)
                    ok = fits.get(pair)
                    if self.fits(*pair) if ok is None else ok:
                        known[word[:k]] = token, state[1] + 1 if a else 1
                        break
        return lambda k: known[word[:k]]

    def _prefix_counts(self, piece: str) -> list[int]:
        """Tokens of piece[:1], piece[:2] ... each taken as a text's last piece.

        A cut inside 'll, 're or 've leaves the apostrophe as a piece of its own before the letters.
        """
        if len(piece) > 1 and piece[0] == "'" and piece[1].isalpha():
            one = self._prefix_counts("'")[0]
            cut = [one, *(one + c for c in self._prefix_counts(piece[1:-1]))] if len(piece) > 2 else [one]
            word = piece.encode().decode("latin-1").translate(self.letters)
            return [*cut, self._last(word, len(word), END, self._inner(word, len(word) - 1))[1]]
        word = piece.encode().decode("latin-1").translate(self.letters)
        inner, out, at = self._inner(word, len(word) - 1), [], 0
        known = self._ends if len(word) <= MEMO_LENGTH else {}  # counts of words, which many words begin with
        if len(known) >= MEMO_PREFIXES:
            known.clear()
        for ch in piece:
            at += 1 if ch < "\x80" else len(ch.encode())
            own = word[:at]
            if (n := known.get(own)) is None:
                n = known[own] = self._last(word, at, END, inner)[1]
            out.append(n)
        return out

    def counts_of(self, piece: str) -> bytes:
        """_prefix_counts() packed, four bytes each. Of known pieces, those not asked for in the last MEMO_WORDS new ones are forgotten."""
        packed = self._old_counts.get(piece) or np.array(self._prefix_counts(piece), "<i4").tobytes()
        if len(piece) <= MEMO_LENGTH:
            if len(self._counts) >= MEMO_WORDS:
                self._old_counts, self._counts = self._counts, {}
            self._counts[piece] = packed
        return packed

    def normal(self, text: str) -> str:
        """NFC and lower case, letter by letter (no final sigma)."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return text.translate(NEW_CAPITALS) if recent(text) else text

    @lru_cache(maxsize=65536)  # noqa: B019  one counter lives as long as its worker
    def blank(self, ch: str) -> bool:
        """Whether a character is in no piece."""
        return not (self.older if recent(ch) else self.pattern).findall(ch)

    def segments(self, text: str):
        """(is special, segment) in order."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                yield False, text[at : m.start()]
            yield True, m[0]
            at = m.end()
        if at < len(text):
            yield False, text[at:]

    def prefixes(self, text: str) -> Prefixes:
        return Prefixes(self, text)

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        return self.prefixes(text).total


class Prefixes:
    """The exact token count at every prefix of a normalised text, stored: count(k), total, longest(budget).

    Characters that are in no piece (white space) add nothing, so counts holds one number for each character of a piece, in
    order, and at() its place in the text, which is worked out when first asked for.
    """

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter = counter
        parts, shown, n, tail = [], [], 0, ""  # counts of the parts between special strings; the piece that the last part ends with
        for special, part in counter.segments(text) if counter.special and "<|" in text else ((False, text),):
            if special:  # one token from its last character on; before that it is text like any other, after the piece before it
                counts, _ = self._part(counter, tail + counter.normal(part[:-1]))
                k = len(tail)
                parts.append(np.append(counts[k:] - (counts[k - 1] if k else 0) + n, n + 1))
                n, tail = n + 1, ""
            else:
                part = counter.normal(part)
                counts, last = self._part(counter, part)
                parts.append(counts + n if n else counts)
                n, tail = n + (int(counts[-1]) if len(counts) else 0), last if part.endswith(last) else ""
            shown.append(part)
        self.counts = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.text, self.total, self._at = shown, n, None
        self.length = sum(map(len, shown))

    @staticmethod
    def _part(counter: PrefixCounter, part: str) -> tuple[np.ndarray, str]:
        """(count at each character of a piece, last piece) of a normalised text without special strings."""
        pieces = (counter.older if recent(part) else counter.pattern).findall(part)
        if not pieces:
            return np.zeros(0, np.int32), ""
        packed, i = list(map(counter._counts.get, pieces)), -1
        for _ in range(packed.count(None)):
            i = packed.index(None, i + 1)
            packed[i] = counter._counts.get(pieces[i]) or counter.counts_of(pieces[i])
        counts = np.frombuffer(b"".join(packed), "<i4")
        size = np.fromiter(map(len, packed), np.int32, len(packed)) >> 2
        before = np.cumsum(counts[np.cumsum(size) - 1])
        out = np.empty_like(counts)
        np.add(counts, np.repeat(np.append(np.int32(0), before[:-1].astype(np.int32)), size), out=out)
        return out, pieces[-1]

    def at(self) -> np.ndarray:
        """Places, in the normalised text, of the characters that are in a piece: all but white space."""
        if self._at is None:
            points = np.frombuffer("".join(self.text).encode("utf-32-le"), "<u4")
            blank = points == 32
            odd = np.flatnonzero((points < 32) | (points >= 127))
            if len(odd):
                each, of = np.unique(points[odd], return_inverse=True)
                blank[odd] = np.array([self.counter.blank(chr(c)) for c in each.tolist()])[of]
            self._at = np.flatnonzero(~blank)
        return self._at

    def count(self, k: int) -> int:
        """Tokens of the first k characters; a special string counts as one from its last character on."""
        i = int(np.searchsorted(self.at(), k))
        return int(self.counts[i - 1]) if i else 0

    def longest(self, budget: int) -> int:
        """Length of the longest prefix of at most budget tokens. A word may have fewer tokens than some prefix of it."""
        if self.total <= budget:
            return self.length
        fits = np.flatnonzero(self.counts <= budget)
        # up to the next character that counts, so white space after the cut is in
        return int(self.at()[fits[-1] + 1 if len(fits) else 0])


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    """One per worker and vocabulary."""
    return PrefixCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, cut_chars of each row of docs.

    n_tokens counts the whole text; over_limit is n_tokens > limit; cut_chars is the length of the longest prefix (of the
    normalised text) within the limit, null where the text is within it. Both are read off the counts stored at every prefix, of any
    text, however long. Null text counts as empty: 0 bytes, 0 tokens. Null ids stay; repeated rows give a row each; other columns are
    left out; an empty table gives none.
    """

    def run(b: pa.RecordBatch) -> dict:
        c, n, cut, size = counter(path), [], [], []
        for t in text_list(b.column("text")):
            p = c.prefixes(t)
            n.append(p.total), cut.append(p.longest(limit) if p.total > limit else None), size.append(len(t.encode()))
        return {"doc_id": b.column("doc_id"), "n_bytes": size, "n_tokens": n, "cut_chars": cut}

    out = arrow_map(keep(docs, doc_id=id_col, text=text_col), run, "doc_id long, n_bytes long, n_tokens long, cut_chars long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "cut_chars")
