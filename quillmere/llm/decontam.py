"""Benchmark decontamination by winnowing.

A window is 13 consecutive words of a benchmark item (an item of fewer words is one window). Of the hashes of K-word grams,
the minimum of each W neighbours is kept on either side; with K + W - 1 = 13 every shared window holds a kept gram of both sides,
so joining a document's kept grams with the benchmark's finds every one. Each hit is extended: the windows that hold the gram are
joined with the benchmark's windows by 128-bit hashes of their words. The benchmark's kept grams are looked up where the
texts are if they are few enough to be held (8 bytes each); beyond, both sides' grams meet by hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmere.llm.common import arrow_map, fresh, keep, looked_up, spread_join, stored, text_bytes
from quillmere.llm.texthash import ALNUM, LOWER, U, Words, grams, mix, words_of

WINDOW, GRAM = 13, 7
#: Grams of the benchmark that every worker holds at most (8 bytes each); with more, texts' grams are shuffled to them.
MAX_HELD = 4_000_000

_NEAR = "array<struct<first:int,m:int,w1:bigint,w2:bigint>>"


def winnowed(g: np.ndarray, at: np.ndarray, doc: np.ndarray, w: int) -> np.ndarray:
    """Marks of the grams that are the minimum of some w neighbours within their document."""
    n = len(g) - w + 1
    picked = np.zeros(len(g), bool)
    if n <= 0:
        return picked
    low = g[:n].copy()
    for j in range(1, w):
        np.minimum(low, g[j : j + n], out=low)
    ok = doc[at[:n]] == doc[at[w - 1 :]]
    for j in range(w):
        picked[j : j + n] |= ok & (g[j : j + n] == low)
    return picked


def found(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of x are in sorted_, their places there)."""
    if len(sorted_) == 0 or len(x) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = np.searchsorted(sorted_, x)
    k[k == len(sorted_)] = 0
    hit = np.flatnonzero(sorted_[k] == x)
    return hit, k[hit]


def short_items(w: Words):
    """(document, first word, number of words, hash of them all) of the documents of fewer words than a window, but not none."""
    for d in np.flatnonzero((np.diff(w.first) > 0) & (np.diff(w.first) < WINDOW)):
        a, b = int(w.first[d]), int(w.first[d + 1])
        yield int(d), a, b - a, grams(Words(0, 1, w.hash[a:b], None, None, np.array([0, b - a])), b - a)[0][0]


def kept_grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The winnowed grams of documents, and the index of the first word of each."""
    g, at = grams(w, GRAM)
    p = winnowed(g, at, w.doc, WINDOW - GRAM + 1)
    return g[p], at[p]


def window_hashes(w: Words, low: bytes, first: np.ndarray, m: int) -> np.ndarray:
    """128-bit hashes, as rows of two integers, of the runs of m words from these words on; low is the batch in lower case."""
    word = lambda j: low[w.start[j] : w.end[j]]
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(map(word, range(i, i + m)))) for i in first.tolist()), "<i8").reshape(-1, 2)


def benchmark_grams(items: DataFrame) -> DataFrame:
    """m, g of items (text), each once: the kept grams of items of a window or more (m = WINDOW), the hash of all m words of shorter ones."""

    def run(b: pa.RecordBatch) -> dict:
        m, g = [np.zeros(0, np.int32)], [np.zeros(0, U)]
        for w in words_of(*text_bytes(b.column("text")), ALNUM):
            own = np.unique(kept_grams(w)[0])
            short = [(n, h) for _, _, n, h in short_items(w)]
            g += [own, np.array([h for _, h in short], U)]
            m += [np.full(len(own), WINDOW, np.int32), np.array([n for n, _ in short], np.int32)]
        return {"m": pa.array(np.concatenate(m)), "g": pa.array(np.concatenate(g).view(np.int64))}

    return arrow_map(items.select("text"), run, "m int, g long").distinct()


def benchmark_windows(items: DataFrame) -> DataFrame:
    """w1, w2, items, held of items (item_id, text): for each different window the ids of the items that hold it, in order, and a name
    of this list; what many items share, in many windows, is a few lists."""

    def run(b: pa.RecordBatch) -> dict:
        data, offsets = text_bytes(b.column("text"))
        low, rows, hashes = LOWER[data].tobytes(), [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]
        for w in words_of(data, offsets, ALNUM):
            at = grams(w, WINDOW)[1]
            rows.append(w.lo + w.doc[at]), hashes.append(window_hashes(w, low, at, WINDOW))
            for d, a, n, _ in short_items(w):
                rows.append(np.array([w.lo + d])), hashes.append(window_hashes(w, low, np.array([a]), n))
        h = np.concatenate(hashes)
        return {"w1": pa.array(h[:, 0]), "w2": pa.array(h[:, 1]), "item": b.column("item_id").take(pa.array(np.concatenate(rows)))}

    # an item without an id is an empty one: it comes first, and is told from ids by its being null
    each = arrow_map(items, run, "w1 long, w2 long, item string").distinct()
    own = each.groupBy("w1", "w2").agg(F.array_sort(F.collect_set("item")).alias("items"), F.max(F.col("item").isNull()).alias("nameless"))
    own = own.select("w1", "w2", F.when(F.col("nameless"), F.concat("items", F.array(F.lit(None).cast("string")))).otherwise(F.col("items")).alias("items"))
    return own.withColumn("held", F.md5(F.to_json("items")))


def near_windows(texts, kept: dict[int, np.ndarray], own: list | None = None) -> tuple[list[int], list]:
    """(words, windows (first, m, w1, w2)) of each text of an Arrow column: all windows that hold a kept gram which is also in `kept`
    (by m, in order), or, with own, among the text's own hits (m, g)."""
    data, offsets = text_bytes(texts)
    low, n, out = None, [0] * (len(offsets) - 1), [[] for _ in range(len(offsets) - 1)]
    for w in words_of(data, offsets, ALNUM):
        doc, sized, known = w.doc, np.diff(w.first), kept
        n[w.lo : w.hi] = sized.tolist()
        tag = lambda g, d: g
        if own is not None:  # hits are looked up together with their document; a false one is found out later
            tag, known = (lambda g, d: mix(g ^ mix(d.astype(U)))), {}
            rows = [(d, x["m"], x["g"]) for d in range(w.hi - w.lo) for x in own[w.lo + d] or ()]
            for m in {r[1] for r in rows}:
                mine = [(d, g) for d, k, g in rows if k == m]
                known[m] = np.unique(tag(np.array([g for _, g in mine], np.int64).view(U), np.array([d for d, _ in mine])))
        for m, sorted_ in known.items():
            g, at = kept_grams(w) if m == WINDOW else grams(w, m)
            hit = at[found(sorted_, tag(g, doc[at]))[0]]
            if m == WINDOW and len(hit):
                first = np.unique((hit[:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
                first = first[(first >= 0) & (first + WINDOW <= len(doc))]
                hit = first[doc[first] == doc[first + WINDOW - 1]]
            if len(hit):
                low = low or LOWER[data].tobytes()
                for i, (w1, w2) in zip(hit.tolist(), window_hashes(w, low, hit, m).tolist()):
                    out[w.lo + doc[i]].append({"first": i - int(w.first[doc[i]]), "m": m, "w1": w1, "w2": w2})
    return n, out


def scanned(docs: DataFrame, asked: DataFrame, max_held: int) -> DataFrame:
    """row, doc_id, n_words, near, t1, t2 (hashes of the text) of docs (doc_id, text), stored: near has the windows that may be the benchmark's."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2"))
    shape = f"doc_id string, n_words long, near {_NEAR}, t1 long, t2 long".replace("string", docs.schema["doc_id"].dataType.simpleString(), 1)
    if asked.limit(max_held + 1).count() <= max_held:
        held: dict[int, np.ndarray] = {}
        t = asked.toArrow()  # at most max_held rows of two numbers
        m, g = t.column("m").to_numpy(), t.column("g").to_numpy().view(U)
        for k in np.unique(m).tolist():
            held[k] = np.sort(g[m == k])
        sent = docs.sparkSession.sparkContext.broadcast(held)

        def run(b: pa.RecordBatch) -> dict:
            n, near = near_windows(b.column("text"), sent.value)
            return {"doc_id": b.column("doc_id"), "n_words": n, "near": near, "t1": b.column("t1"), "t2": b.column("t2")}

        return stored(arrow_map(docs, run, shape).withColumn("row", F.monotonically_increasing_id()), "windows")
    lengths = [r.m for r in asked.select("m").distinct().collect()]  # 1 to 13

    def ask(b: pa.RecordBatch) -> dict:
        row, m, g = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, U)]
        for w in words_of(*text_bytes(b.column("text")), ALNUM):
            for k in lengths:
                own, at = kept_grams(w) if k == WINDOW else grams(w, k)
                row.append(w.lo + w.doc[at]), m.append(np.full(len(at), k, np.int32)), g.append(own)
        row = pa.array(np.concatenate(row))
        return {"t1": b.column("t1").take(row), "t2": b.column("t2").take(row), "m": pa.array(np.concatenate(m)), "g": pa.array(np.concatenate(g).view(np.int64))}

    theirs = arrow_map(docs.select("text", "t1", "t2"), ask, "t1 long, t2 long, m int, g long").distinct()
    hits = spread_join(theirs, asked, ["m", "g"], ["t1", "t2"]).groupBy("t1", "t2").agg(F.collect_list(F.struct("m", "g")).alias("own"))  # a text's own

    def run_own(b: pa.RecordBatch) -> dict:
        n, near = near_windows(b.column("text"), {}, b.column("own").to_pylist())
        return {"doc_id": b.column("doc_id"), "n_words": n, "near": near, "t1": b.column("t1"), "t2": b.column("t2")}

    with_own = spread_join(docs, stored(hits, "hits"), ["t1", "t2"], ["doc_id"], "left", wide=True)
    return stored(arrow_map(with_own, run_own, shape).withColumn("row", F.monotonically_increasing_id()), "windows")


def union(spans) -> list[tuple[int, int]]:
    """Spans (first, length) as disjoint (first, end) in order."""
    out: list[tuple[int, int]] = []
    for a, m in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], a + m)
        else:
            out.append((a, a + m))
    return out


def _merged(b: pa.RecordBatch) -> dict:
    joined = [union([(x["first"], x["m"]) for x in s]) for s in b.column("s").to_pylist()]
    return {"row": b.column("row"), "n_hit": [sum(e - a for a, e in s) for s in joined], "spans": [[{"first": a, "end": e} for a, e in s] for s in joined]}


def _hits(scan: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, n_hit, spans) of the rows that are hit, and (row, held) of the lists of items whose windows they hold, each once."""
    near = scan.where("size(near) > 0").select("row", F.inline("near"))
    hit = stored(spread_join(near, windows.select("w1", "w2", "held"), ["w1", "w2"], ["row", "first"]).drop("w1", "w2"), "hits")
    spans = hit.groupBy("row").agg(F.collect_list(F.struct("first", "m")).alias("s"))  # a row's own windows
    return arrow_map(spans, _merged, "row long, n_hit long, spans array<struct<first:int,end:int>>"), hit.select("row", "held").distinct()


def _contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_held: int = MAX_HELD) -> DataFrame:
    """The rows of docs, all columns, that contamination() does not find contaminated. Texts are told by two hashes of 64 bits."""
    items = keep(benchmark, item_id="item_id", text="text").withColumn("item_id", F.col("item_id").cast("string"))
    own = docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    scan = scanned(own, stored(benchmark_grams(items), "grams"), max_held)
    spans, _ = _hits(scan, stored(benchmark_windows(items), "items"))
    t1, t2 = fresh(docs, "t1"), fresh(docs, "t2")
    bad = stored(scan.join(spans, "row").where(_contaminated()).select(F.col("t1").alias(t1), F.col("t2").alias(t2)).distinct(), "contaminated")
    text = F.col(f"`{text_col}`")
    rows = docs.withColumn(t1, F.xxhash64(text)).withColumn(t2, F.xxhash64(F.lit(7), text))
    return looked_up(rows, bad, [t1, t2], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", max_held: int = MAX_HELD) -> DataFrame:
    """doc_id, n_words, n_hit, spans array<struct<first,end>> (words), items array<string>, contaminated of each row of docs.

    A word is hit if it lies in an occurrence of a window; contaminated is n_hit > 0 and 20 * n_hit >= n_words.
    Null and empty texts have no words; items without text or words have no window; items without an id
    hit like others and are one null at the end of items; an empty benchmark hits nothing. Null ids stay; repeated rows give a row
    each; other columns are left out; an empty table gives none. A benchmark of any size is asked in one pass over the texts.
    """
    bench = keep(benchmark, item_id=item_col, text=item_text).withColumn("item_id", F.col("item_id").cast("string"))
    windows = stored(benchmark_windows(bench), "items")
    scan = scanned(keep(docs, doc_id=id_col, text=text_col), stored(benchmark_grams(bench), "grams"), max_held)
    spans, lists = _hits(scan, windows)
    named = spread_join(lists, windows.select("held", "items").dropDuplicates(["held"]), ["held"], ["row"], wide=True)
    flat = F.flatten(F.collect_list("items"))
    named = named.groupBy("row").agg(F.array_sort(F.array_distinct(flat)).alias("items"))
    out = scan.select("row", "doc_id", "n_words").join(spans, "row", "left").join(named, "row", "left")
    out = out.withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    return out.select(
        "doc_id", "n_words", "n_hit", F.coalesce("spans", F.array().cast("array<struct<first:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), _contaminated().alias("contaminated"),
    )


def digest(found_: DataFrame) -> DataFrame:
    """contamination() with the items as a count and a hash."""
    return found_.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def sha_of_items(items) -> str:
    """The hash digest() gives for item ids."""
    return hashlib.sha256(",".join(sorted(str(i) for i in items if i is not None)).encode()).hexdigest()
