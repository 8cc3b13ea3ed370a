"""Quality rules: base rules, then gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled documents, with monotonic constraints on
the statistics that can only speak against a document, and flattened into numpy node arrays
that score a batch of documents at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmere.llm.common import arrow_filter, arrow_map, bounded_sample, keep, text_bytes, text_list
from quillmere.llm.texthash import NOT_SPACE, U, grams, mix, words_of

MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
#: The trees are fitted on at most so many labelled documents; a document is kept from this probability on.
MAX_LABELLED, THRESHOLD = 6000, 0.5
#: Statistics in the order of the columns, with the direction in which the verdict may change: -1 is only against.
STATISTICS = {
    "log_words": 0, "word_length": 0, "symbols_a_word": -1, "repeated_share": -1, "duplicate_line_share": -1,
    "upper_share": -1, "digit_share": 0, "distinct_share": 1, "stops_a_word": 0, "exclamations_a_word": -1,
    "bars_a_word": -1, "words_a_line": 0, "same_neighbour_share": -1, "non_ascii_share": 0,
}


def _per_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    c = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]


def _set(*bytes_: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(b"".join(bytes_))] = True
    return m


SYMBOL, UPPER, DIGIT, STOP = _set(b"#*$%&|<>"), _set(bytes(range(65, 91))), _set(b"0123456789"), _set(b".,;:?")
LETTER = _set(bytes(range(65, 91)), bytes(range(97, 123)))


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def statistics(data: np.ndarray, offsets: np.ndarray, texts: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(base counts by name, matrix of STATISTICS) of the documents of a batch."""
    n = len(offsets) - 1
    head = (data & 0xC0) != 0x80
    count = lambda m: _per_doc(m[data], offsets)
    n_words, repeat, distinct, same = (np.zeros(n, np.int64) for _ in range(4))
    for w in words_of(data, offsets, NOT_SPACE, lower=False):
        doc, k = w.doc, w.hi - w.lo
        n_words[w.lo : w.hi] = np.diff(w.first)
        if len(doc) == 0:
            continue
        # the distinct words of a document: tagged hashes, then one representative each
        tag = w.hash ^ mix(doc.astype(U))
        order = np.argsort(tag, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = tag[order[1:]] != tag[order[:-1]]
        distinct[w.lo : w.hi] = np.bincount(doc[order[new]], minlength=k)
        same[w.lo : w.hi] = np.bincount(doc[1:][(w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])], minlength=k)
        g, at = grams(w, WINDOW)
        if len(g):
            g = mix(g + doc[at].astype(U) * U(0x9FB21C651E98DF25))
            order = np.argsort(g, kind="stable")
            eq = g[order[1:]] == g[order[:-1]]
            twice = np.zeros(len(g), bool)
            twice[order[1:][eq]] = twice[order[:-1][eq]] = True
            cover = np.zeros(len(doc) + 1, np.int64)
            np.add.at(cover, at[twice], 1)
            np.add.at(cover, at[twice] + WINDOW, -1)
            repeat[w.lo : w.hi] = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=k)
    code_points = _per_doc(head, offsets)
    base = {"n_words": n_words, "word_chars": code_points - count(~NOT_SPACE), "n_symbols": count(SYMBOL), "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64), "n_repeat_words": repeat}
    w, chars, lines = np.maximum(n_words, 1), np.maximum(base["word_chars"], 1), count(_set(b"\n")) + 1
    x = np.column_stack([
        np.log1p(n_words), base["word_chars"] / w, base["n_symbols"] / w, repeat / w, base["n_dup_lines"] / lines,
        count(UPPER) / np.maximum(count(LETTER), 1), count(DIGIT) / chars, distinct / w, count(STOP) / w, count(_set(b"!")) / w,
        count(_set(b"|")) / w, n_words / lines, same / w, (code_points - _per_doc(data < 128, offsets)) / chars,
    ])
    return base, x


class Trees:
    """Boosted trees as node arrays: feature (-1: leaf), threshold, left, right, value; roots has each tree's first node."""

    def __init__(self, feature, threshold, left, right, value, roots, bias, depth):
        self.feature, self.threshold, self.left, self.right, self.value, self.roots, self.bias, self.depth = feature, threshold, left, right, value, roots, bias, depth

    def probability(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(self.roots[None, :], len(x), 0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            at = np.where(f < 0, at, np.where(x[rows, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at]))
        return 1 / (1 + np.exp(-(self.bias + self.value[at].sum(1))))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: int = 10) -> Trees:
    """Newton boosting of the logistic loss on histograms. monotone: -1, 0 or 1 for each feature."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else c for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
    mean = np.clip(y.mean() if len(y) else 1.0, 0.01, 0.99)
    bias = float(np.log(mean / (1 - mean)))
    score = np.full(len(y), bias)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for a, v in ((feature, -1), (threshold, 0.0), (left, 0), (right, 0), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    def grow(rows, grad, hess, level, low, high) -> int:
        at = node()
        g, h = grad[rows].sum(), hess[rows].sum()
        value[at] = rate * float(np.clip(-g / (h + ridge), low, high))
        if level == depth or len(rows) < 2 * least:
            return at
        best = (1e-6, None)
        for f in range(x.shape[1]):
            k = len(edges[f]) + 1
            if k < 2:
                continue
            b = binned[rows, f]
            gl, hl, nl = (np.cumsum(np.bincount(b, v, k))[:-1] for v in (grad[rows], hess[rows], np.ones(len(rows))))
            vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-(g - gl) / (h - hl + ridge), low, high)
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            gain[(nl < least) | (len(rows) - nl < least) | (monotone[f] * (vr - vl) < 0)] = -1
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = gain[i], (f, i, vl[i], vr[i])
        if best[1] is None:
            return at
        f, i, vl, vr = best[1]
        go = binned[rows, f] <= i
        mid = (vl + vr) / 2
        bounds = ((low, high), (low, high)) if monotone[f] == 0 else ((low, mid), (mid, high)) if monotone[f] > 0 else ((mid, high), (low, mid))
        feature[at], threshold[at] = f, float(edges[f][i])
        left[at] = grow(rows[go], grad, hess, level + 1, *bounds[0])
        right[at] = grow(rows[~go], grad, hess, level + 1, *bounds[1])
        return at

    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -4.0, 4.0))
        t = Trees(*(np.array(a) for a in (feature, threshold, left, right, value)), np.array(roots[-1:]), 0.0, depth)
        p1 = t.probability(x)
        score += np.log(p1 / (1 - p1))
    if not roots:
        roots.append(node())
    return Trees(*(np.array(a) for a in (feature, threshold, left, right, value, roots)), bias, depth)


def _columns(batch: pa.RecordBatch):
    arr = batch.column("text")
    return statistics(*text_bytes(arr), text_list(arr))


def labelled_statistics(docs: DataFrame, labels: DataFrame, label_col: str, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """STATISTICS and labels of at most bound labelled documents, brought to the driver."""
    own = keep(labels, doc_id="doc_id", label=label_col).where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    some = bounded_sample(own, "doc_id", bound)
    rows = docs.join(F.broadcast(some), "doc_id")  # at most bound rows of two numbers

    def run(b: pa.RecordBatch) -> dict:
        x = _columns(b)[1]
        return {"doc_id": b.column("doc_id"), "label": b.column("label"), "x": pa.array(list(x), pa.list_(pa.float64()))}

    # bounded again, by rows: a table may repeat an id
    got = bounded_sample(arrow_map(rows, run, "doc_id long, label int, x array<double>"), "doc_id", bound).collect()
    got.sort(key=lambda r: (r.doc_id, r.label, r.x))
    return np.array([r.x for r in got], float).reshape(-1, len(STATISTICS)), np.array([r.label for r in got], float)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", bound: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees for P(label = 1), from at most bound labelled documents."""
    x, y = labelled_statistics(keep(docs, doc_id=id_col, text=text_col), labels, label_col, bound)
    return fit_trees(x, y, np.array([*STATISTICS.values()]))


def _verdict(base: dict, x: np.ndarray, trees: Trees, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base_failed, probability, kept)"""
    n, r = base["n_words"], base["n_repeat_words"]
    failed = (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)
    p = trees.probability(x)
    return failed, p, ~failed & (p >= threshold)


def keep_good(docs: DataFrame, trees: Trees, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, that quality_rules() keeps."""

    def run(b: pa.RecordBatch) -> np.ndarray:
        arr = b.column(b.schema.get_field_index(text_col))
        return _verdict(*statistics(*text_bytes(arr), text_list(arr)), trees, threshold)[2]

    return arrow_filter(docs, run)


def quality_rules(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality (probability), kept of each row of docs.

    base_failed: under 20 words, or more than 30 % of the words in repeated 8-word windows. kept: not base_failed
    and a probability of at least the threshold. Null or empty text has no words and fails; without labels of both
    kinds the trees keep all. Null ids stay; repeated rows give a row each; other columns are left out; an empty table gives none.
    """

    def run(b: pa.RecordBatch) -> dict:
        base, x = _columns(b)
        failed, p, kept = _verdict(base, x, trees, threshold)
        return {"doc_id": b.column("doc_id"), **{k: pa.array(v) for k, v in base.items()}, "base_failed": pa.array(failed), "quality": pa.array(p), "kept": pa.array(kept)}

    return arrow_map(keep(docs, doc_id=id_col, text=text_col), run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, quality double, kept boolean")
