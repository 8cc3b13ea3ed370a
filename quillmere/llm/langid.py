"""Language identification by nearest centroid over TF-IDF vectors of byte n-grams.

Each text is a unit vector of hashed n-gram weights; each language has several centroids
(spherical k-means of a bounded sample of its texts). The nearest centroid by cosine names the language;
a text farther from it than nearly all that centroid's own texts is marked as rejected
(in a column of its own, as lang_pred names a learned language for every text with a letter).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmere.llm.common import arrow_map, bounded_sample, keep, text_bytes, text_list
from quillmere.llm.texthash import LOWER

DIMS, ORDERS = 4096, (1, 2, 3, 4)
#: The centroids are fitted on at most MAX_TEXTS texts a language, and on fewer, but at least LEAST_TEXTS, if there are so many languages that
#: all together would be over ALL_TEXTS. These are dense rows of DIMS floats on the driver (16 kB a text).
MAX_TEXTS, ALL_TEXTS, LEAST_TEXTS, CENTROIDS = 500, 10_000, 8, 4
#: A text is rejected below this quantile of the cosines of a centroid's own texts, less the margin.
REJECT_QUANTILE, REJECT_MARGIN = 0.005, 0.1

#: A-Z in lower case; digits, signs and white space all as a space.
_FOLD = LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed n-gram counts, one row for each document; n-grams within a document only."""
    n, out = len(offsets) - 1, np.zeros((len(offsets) - 1, DIMS), np.float32)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20), "right")) - 1)
        for a in range(int(offsets[lo]), int(offsets[hi]), 1 << 22):  # a longer document goes through in pieces
            b = min(int(offsets[hi]), a + (1 << 22))
            x = _FOLD[data[a : min(b + max(ORDERS) - 1, int(offsets[hi]))]].astype(np.uint32)
            ends = np.minimum(offsets[lo + 1 : hi + 1] - a, len(x))
            length = np.diff(np.concatenate([[0], np.maximum(ends, 0)]))
            row = np.repeat(np.arange(hi - lo, dtype=np.int64), length)
            packed = np.zeros(len(x), np.uint32)
            for k in range(max(ORDERS)):
                m = len(x) - k
                if m <= 0:
                    break
                packed = (packed[:m] << np.uint32(8)) | x[k:]
                ok = row[:m] == row[k:]
                ok[b - a :] = False
                h = (packed ^ np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
                h = (h * np.uint32(0xC2B2AE35)) >> np.uint32(20)
                out[lo:hi] += np.bincount(row[:m][ok] * DIMS + h[ok], minlength=(hi - lo) * DIMS).reshape(-1, DIMS)
        lo = hi
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Centroids:
    """langs: names; idf; centroid vectors with the language and the rejection bound of each."""

    def __init__(self, langs, idf, vectors, lang_of, bound):
        self.langs, self.idf, self.vectors, self.lang_of, self.bound = langs, idf, vectors, lang_of, bound

    def weigh(self, c: np.ndarray) -> np.ndarray:
        return unit(np.log1p(c) * self.idf)

    def predict(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, rejected) for rows of counts."""
        cos = self.weigh(c) @ self.vectors.T
        best = cos.argmax(1)
        lang = self.lang_of[best]
        other = np.where(self.lang_of[None, :] == lang[:, None], -1.0, cos).max(1)
        top = cos[np.arange(len(cos)), best]
        return lang, 1 / (1 + np.exp(-20 * (top - np.maximum(other, 0)))), top < self.bound[best]


def fit_centroids(c: np.ndarray, lang: np.ndarray, per_lang: int = CENTROIDS, rounds: int = 8, seed: int = 7) -> Centroids:
    """Centroids from n-gram counts and names."""
    langs = sorted(set(lang))
    idf = np.log((1 + len(c)) / (1 + (c > 0).sum(0))).astype(np.float32) + 0.1
    m = Centroids(langs, idf, None, None, None)
    x, rng = m.weigh(c), np.random.default_rng(seed)
    vectors, lang_of, bound = [], [], []
    for i, name in enumerate(langs):
        own = x[lang == name]
        k = min(per_lang, len(own))
        v = own[rng.choice(len(own), k, replace=False)]
        for _ in range(rounds):
            near = (own @ v.T).argmax(1)
            v = unit(np.stack([own[near == j].sum(0) if (near == j).any() else v[j] for j in range(k)]))
        cos = own @ v.T
        for j in range(k):
            mine = cos[cos.argmax(1) == j, j]
            vectors.append(v[j]), lang_of.append(i), bound.append(np.quantile(mine, REJECT_QUANTILE) - REJECT_MARGIN if len(mine) else -1.0)
    return Centroids(langs, idf, np.array(vectors, np.float32).reshape(-1, DIMS), np.array(lang_of, int), np.array(bound))


def fit(docs: DataFrame, trainable, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_texts: int = MAX_TEXTS) -> Centroids:
    """Centroids from the rows where the condition `trainable` (on doc_id) holds and lang isn't null: of every language at most max_texts
    (see ALL_TEXTS) rows, those whose ids hash lowest. Without such rows nothing is learned."""
    rows = keep(docs, doc_id=id_col, text=text_col, lang=lang_col).where(trainable & F.col("lang").isNotNull())
    langs = max(1, rows.select("lang").distinct().count())
    some = bounded_sample(rows, "doc_id", min(max_texts, max(LEAST_TEXTS, ALL_TEXTS // langs)), within="lang")

    def run(b: pa.RecordBatch) -> dict:
        c = counts(*text_bytes(b.column("text")))
        at = [np.flatnonzero(r) for r in c]
        return {"doc_id": b.column("doc_id"), "lang": b.column("lang"), "dims": pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())), "n": pa.array([r[a] for r, a in zip(c, at)], pa.list_(pa.float32()))}

    got = arrow_map(some, run, "doc_id long, lang string, dims array<int>, n array<float>").toArrow().combine_chunks()
    ids, lang = got.column("doc_id").to_numpy(), np.array(got.column("lang").to_pylist(), object)
    dims, n = (got.column(k).combine_chunks() for k in ("dims", "n"))
    first, dims, n = dims.offsets.to_numpy(), dims.values.to_numpy(), n.values.to_numpy()
    order = np.lexsort((first[:-1] - first[1:], ids))  # the same rows in the same order, however the job ran
    c = np.zeros((len(ids), DIMS), np.float32)
    for to, i in enumerate(order):
        c[to, dims[first[i] : first[i + 1]]] = n[first[i] : first[i + 1]]
    return fit_centroids(c, lang[order])


def identify(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of each row of docs.

    lang_pred is a learned language, or `und` where the text is null or has no letter (score 0, rejected) or nothing
    was learned. Of centroids that are equally near the first counts, in order of the languages' names. Texts of any length are read
    whole. Null ids stay; repeated rows give a row each; other columns, lang among them, aren't read; an empty table gives none.
    """

    def run(b: pa.RecordBatch) -> dict:
        texts = text_list(b.column("text"))
        some = np.array([bool(model.langs) and has_letter(t) for t in texts], bool)
        if model.langs:
            lang, score, far = model.predict(counts(*text_bytes(b.column("text"))))
        else:
            lang, score, far = np.zeros(len(texts), int), np.zeros(len(texts)), some
        return {"doc_id": b.column("doc_id"), "lang_pred": [model.langs[k] if s else "und" for k, s in zip(lang, some)], "score": pa.array(np.where(some, score, 0.0).astype(float)), "rejected": pa.array(far | ~some)}

    return arrow_map(keep(docs, doc_id=id_col, text=text_col), run, "doc_id long, lang_pred string, score double, rejected boolean")
