"""Quality rules, language identification and the quality network: base counts against brute force, models on held-out rows."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmere.llm import langid, quality_net, quality_rules, queries
from quillmere.llm.common import crc_of_id, table

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w, where, m = WORD.findall(text), defaultdict(list), set()
    for i in range(len(w) - 7):
        where[tuple(w[i : i + 8])].append(i)
    for v in where.values():
        if len(v) > 1:
            m.update(j for i in v for j in range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(m), n < 20 or 100 * len(m) > 30 * n


def labels_of(odd):
    return odd.where("doc_id is not null").select("doc_id", F.expr("case when length(coalesce(text, '')) < 60 then 0 else 1 end").alias("quality"))


def test_base_counts(odd, texts):
    trees = quality_rules.fit(odd, labels_of(odd))
    got = quality_rules.quality_rules(odd, trees).collect()
    want = {d: base(t or "") for d, t in texts}
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:7] == want[r.doc_id] and not (r.base_failed and r.kept)
    kept = quality_rules.keep_good(odd, trees)
    assert kept.columns == odd.columns and sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.doc_id) for r in got if r.kept)


def test_long_document_is_cut_between_words(monkeypatch, spark):
    from quillmere.llm import texthash

    text = " ".join(f"w{i % 977} é{i}" for i in range(40_000)) + " tail" * 30
    data = np.frombuffer(text.encode(), np.uint8)
    whole = next(texthash.words_of(data, np.array([0, len(data)]), texthash.NOT_SPACE))
    cut = next(texthash.words_of(data, np.array([0, len(data)]), texthash.NOT_SPACE, segment=999))
    assert len(whole.hash) == len(text.split()) and (whole.hash == cut.hash).all() and (whole.start == cut.start).all() and (whole.end == cut.end).all()


def test_no_labels(odd, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    trees = quality_rules.fit(odd, none)
    assert all(r.kept != r.base_failed for r in quality_rules.quality_rules(odd, trees).collect())
    net = quality_net.fit(odd, none, F.lit(True))
    assert {r.predicted for r in quality_net.score(odd, net).collect()} == {1}
    assert quality_net.score(odd.where("false"), net).count() == 0 and quality_rules.quality_rules(odd.where("false"), trees).count() == 0


def walked(t, row):
    """The probability by a plain walk down each tree."""
    total = t.bias
    for at in t.roots:
        while t.feature[at] >= 0:
            at = t.left[at] if row[t.feature[at]] <= t.threshold[at] else t.right[at]
        total += t.value[at]
    return 1 / (1 + np.exp(-total))


def test_node_arrays_equal_a_plain_walk(odd, spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.random((800, 5)), 2)  # ties at thresholds
    t = quality_rules.fit_trees(x, (x[:, 0] > x[:, 1]).astype(float), np.array([1, -1, 0, 0, 0]))
    assert len(t.roots) == 60 and np.allclose(t.probability(x), [walked(t, row) for row in x])
    docs = table(spark, SF, "documents").limit(300)
    trees = quality_rules.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    rows = docs.collect()
    data = [(r.text or "").encode() for r in rows]
    stats = quality_rules.statistics(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]), [r.text or "" for r in rows])[1]
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs, trees).collect()}
    for r, row in zip(rows, stats):
        p = walked(trees, row)
        assert abs(got[r.doc_id].quality - p) < 1e-9 and got[r.doc_id].kept == (not got[r.doc_id].base_failed and p >= quality_rules.THRESHOLD)


def test_fits_are_bounded_by_rows(spark, monkeypatch):
    rows = [(1, "a text that is here many times over", "en")] * 300 + [(i, f"text number {i} of them", ["en", "fr"][i % 2]) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    x, y = quality_rules.labelled_statistics(docs.select("doc_id", "text"), labels, "quality", 40)
    assert len(x) == len(y) == 40
    seen = []
    monkeypatch.setattr(quality_net, "fit_net", lambda d, y: seen.append(len(d)))
    quality_net.fit(docs, labels, F.lit(True), bound=40)
    monkeypatch.setattr(langid, "fit_centroids", lambda c, lang: seen.append((len(c), *sorted(set(lang)))))
    langid.fit(docs, F.lit(True), max_texts=10)
    assert seen == [40, (20, "en", "fr")]
    many = docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id").cast("string")))
    langid.fit(many, F.lit(True), max_texts=500)
    assert seen[-1][0] >= 59 and len(seen[-1]) == 60  # no language is left out, however many there are


def test_network_equals_plain_loops(texts):
    rng = np.random.default_rng(3)
    net = quality_net.Net(rng.normal(size=(quality_net.WIDTH, 256, 5)).astype(np.float32), rng.normal(size=5).astype(np.float32), rng.normal(size=5).astype(np.float32), 0.3)
    some = ["", "x", "é" * 700, *[t for _, t in texts if t][:12]]
    data = [t.encode() for t in some]
    got = net.probability(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    for raw, p in zip(data, got):
        pooled, at = [], 0
        while True:  # chunks that overlap, over all bytes
            chunk = raw[at : at + quality_net.CHUNK].ljust(quality_net.CHUNK, b" ")
            best = [max(sum(float(net.table[w][chunk[i + w]][f]) for w in range(quality_net.WIDTH)) for i in range(0, quality_net.CHUNK - quality_net.WIDTH + 1, quality_net.STRIDE)) for f in range(5)]
            pooled.append([max(b + float(s), 0) for b, s in zip(best, net.shift)])
            at += quality_net.CHUNK - quality_net.OVERLAP
            if at >= len(raw) - quality_net.OVERLAP:
                break
        z = float(np.mean(pooled, 0) @ net.out) + net.bias
        assert abs(p - 1 / (1 + np.exp(-z))) < 1e-4


def test_trees_are_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.5 * np.sin(9 * x[:, 0]) + 0.3 * rng.random(3000) > 0.8).astype(float)
    t = quality_rules.fit_trees(x, y, np.array([1, 0, -1]))
    grid = np.repeat(rng.random((50, 3))[:, None], 60, 1)
    grid[:, :, 0] = np.linspace(0, 1, 60)
    assert (np.diff(t.probability(grid.reshape(-1, 3)).reshape(50, 60), axis=1) >= -1e-12).all()
    assert ((t.probability(x) >= 0.5) == y).mean() > 0.85


def test_quality_on_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    trees = quality_rules.fit(docs, labels.where(crc_of_id() % 3 != 1))
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs, trees).collect()}
    held = [r for r in labels.where(crc_of_id() % 3 == 1).collect()]
    failed = {r.doc_id for r in quality_rules.quality_rules(docs, trees).where("base_failed").collect()}
    assert np.mean([got[r.doc_id] for r in held if r.quality == 0]) < 0.1
    assert np.mean([got[r.doc_id] for r in held if r.quality == 1 and r.doc_id not in failed]) > 0.97
    score = {r.doc_id: r for r in queries.op7_quality_net(spark, SF).collect()}
    assert all(score[r.doc_id].held_out for r in held) and np.mean([score[r.doc_id].predicted == r.quality for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in score.values())


def test_languages_on_held_out(spark):
    docs = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    got = queries.op3_language_id(spark, SF).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in held]) > 0.99 and all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_texts(odd):
    m = langid.fit(odd, F.col("doc_id").isNotNull())
    got = langid.identify(odd, m).collect()
    assert len(got) == odd.count() and m.langs == ["en", "fr"]
    by = {r.doc_id: r for r in got}
    assert by[0].lang_pred == by[1].lang_pred == by[10].lang_pred == "und" and by[0].score == 0 and by[9].lang_pred in ("en", "fr")
    nothing = langid.fit(odd.where("false"), F.lit(True))
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}


def grams_of(text):
    """Counts of n-grams of 1 to 4 bytes of the folded text, plainly."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in text.encode())
    out = np.zeros(langid.DIMS)
    for k in range(4):
        for i in range(len(raw) - k):
            h = (int.from_bytes(raw[i : i + k + 1], "big") ^ (k * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF
            h ^= h >> 15
            out[(h * 0xC2B2AE35 & 0xFFFFFFFF) >> 20] += 1
    return out


def test_nearest_centroids_equal_plain_cosines(spark, odd, texts):
    m = langid.fit(table(spark, SF, "documents"), crc_of_id() % 4 != 2)
    got = {r.doc_id: r for r in langid.identify(odd, m).collect()}
    for d, t in dict(texts).items():
        if d is None or not t or len(t) > 6000 or not langid.has_letter(t):
            continue
        v = np.log1p(grams_of(t)) * m.idf
        cos = [float(v @ c / max(np.linalg.norm(v), 1e-9)) for c in m.vectors]
        best = int(np.argmax(cos))
        rest = max((x for x, lang in zip(cos, m.lang_of) if lang != m.lang_of[best]), default=-1)
        assert got[d].lang_pred == m.langs[m.lang_of[best]] and abs(got[d].score - 1 / (1 + np.exp(-20 * (cos[best] - max(rest, 0))))) < 1e-3
    assert langid.identify(odd.where("false"), m).count() == 0


def test_texts_of_several_megabytes(spark, tmp_path):
    from quillmere.llm import byte_bpe, chosen_path, decontam, line_dedup, secrets, token_counts
    import public_tokenizers as P

    words = " ".join(f"wort{i % 4999} ist{i % 13}" for i in range(300_000))
    rows = [(1, words + "\ntail of it, a longer line", "en", "a"), (2, words + " x", "en", "b"), (3, "tail of it, a longer line", "fr", "a"), (4, "a" * 2_000_000, "fr", "c"), (5, "\n" * 1_000_000, None, "c"), (6, "token=abcdefg1 " * 50_000, "fr", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 7)], "doc_id long, quality int")
    bench = spark.createDataFrame([(7, " ".join(words.split()[500_000:500_040]))], "item_id long, text string")
    trees = quality_rules.fit(docs, labels)
    by = lambda df: {r.doc_id: r for r in df.collect()}
    assert {d: r.n_words for d, r in by(quality_rules.quality_rules(docs, trees)).items()} == {d: len(t.split()) for d, t, _, _ in rows}
    near = by(chosen_path.near_duplicates(docs))
    assert near[2].component_id == 1 and near[3].kept and near[5].n_shingles == 0
    assert by(line_dedup.dedup_lines(docs))[3].n_dropped == 1
    hit = by(decontam.contamination(docs, bench))
    assert hit[1].n_hit >= 40 and hit[1].n_hit == hit[2].n_hit and hit[3].n_hit == hit[4].n_hit == 0
    assert by(token_counts.token_counts(docs.where("doc_id <> 4"), P.path("word_bpe_49k.json")))[5].n_tokens == 0
    enc = by(byte_bpe.encode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=False))
    import hashlib
    assert all(enc[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for d, t, _, _ in rows)
    assert by(secrets.scan_secrets(docs))[6].n_assign == 50_000
    net = quality_net.fit(docs, labels, F.lit(True))
    assert len(by(quality_net.score(docs, net))) == len(by(langid.identify(docs, langid.fit(docs, F.lit(True))))) == 6


@pytest.mark.parametrize("size", [0, 1, 100, 511, 512, 513, 960, 961, 5000])
def test_chunks_cover_all_bytes(size):
    s = quality_net.chunk_starts(size)
    assert s[0] == 0 and s[-1] + quality_net.CHUNK >= size and all(np.diff(s) < quality_net.CHUNK)
