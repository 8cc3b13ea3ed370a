"""Vectorised word hashing over UTF-8 bytes: all words of a run of documents in a few numpy passes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
#: Bytes hashed at once; longer documents go through in segments cut between words.
SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_GRAM = U(0xD1342543DE82EF95)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U), np.ones(1, U))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words [^\x20\x09-\x0D]+ and of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to n."""
    global _powers
    if len(_powers[0]) <= n:
        made = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            a = np.full(n + 1, b, U)
            a[0] = 1
            made.append(np.multiply.accumulate(a))
        _powers = (made[0], made[1])
    return _powers


def _segment(data: np.ndarray, word: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of data; a word ends at a document's end."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, U)
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    inner = doc_starts[(doc_starts > 0) & (doc_starts < n)]
    before[inner] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    after[inner - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    p, inv = powers(n + 1)
    run = np.zeros(n + 1, U)
    np.cumsum((data.astype(U) + U(1)) * p[:n], out=run[1:])
    return starts, ends, mix((run[ends] - run[starts]) * inv[starts] + (ends - starts).astype(U) * U(0xA24BAED4963EE407))


class Words:
    """Words of documents lo..hi-1: hash, and byte range within the batch; first[i]:first[i+1] are those of document lo+i."""

    __slots__ = ("lo", "hi", "hash", "start", "end", "first")

    def __init__(self, lo, hi, hash, start, end, first):
        self.lo, self.hi, self.hash, self.start, self.end, self.first = lo, hi, hash, start, end, first

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.hi - self.lo), np.diff(self.first))


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool = True, segment: int = SEGMENT) -> Iterator[Words]:
    """Words of the documents, a run of documents of about segment bytes (or one longer document) at a time."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + segment, "right")) - 1)
        a, b = int(offsets[lo]), int(offsets[hi])
        part = LOWER[data[a:b]] if lower else data[a:b]
        word = is_word[part]
        if b - a <= 2 * segment or hi > lo + 1:
            s, e, h = _segment(part, word, offsets[lo:hi] - a)
        else:  # one long document, in segments cut between words
            cut, made, gaps = 0, [], np.flatnonzero(~word)
            while cut < b - a:
                to = cut + segment
                if to < b - a:
                    k = int(np.searchsorted(gaps, to))
                    to = int(gaps[k]) if k < len(gaps) else b - a
                else:
                    to = b - a
                s, e, h = _segment(part[cut:to], word[cut:to], np.zeros(0, np.int64))
                made.append((s + cut, e + cut, h))
                cut = to
            s, e, h = (np.concatenate(x) for x in zip(*made))
        first = np.searchsorted(s, offsets[lo : hi + 1] - a)
        yield Words(lo, hi, h, s + a, e + a, first)
        lo = hi


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of k words within a document, and the index of its first word."""
    h = words.hash
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    g = h[:n].copy()
    for j in range(1, k):
        g *= _GRAM
        g += h[j : j + n]
    doc = words.doc
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mix(g[at] + U(k)), at


def whole_gram(h: np.ndarray) -> int:
    """The hash that grams() gives the word sequence h taken as one run."""
    g = h[:1].copy()
    for x in h[1:]:
        g = g * _GRAM + x
    return int(mix(g + U(len(h)))[0])
