"""Near-duplicates, line dedup and decontamination against brute force."""

import hashlib
import re

import numpy as np
import pytest

from quillmere.llm import chosen_path, common, decontam, line_dedup
from quillmere.llm.components import connected_components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def groups(texts, k, num):
    sets = {}
    for d, t in texts:
        w = WORD.findall((t or "").translate(LOW))
        sets[d] = frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = [d for d in sets if d is not None and sets[d]]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize(("k", "num", "small", "block"), [(3, 85, 256, 10**6), (5, 80, 256, 10**6), (3, 85, 2, 10**6), (3, 85, 128, 300), (5, 80, 2, 300)])
def test_near_duplicates(odd, texts, monkeypatch, k, num, small, block):
    monkeypatch.setattr(chosen_path, "SMALL", small)  # larger nodes branch on
    monkeypatch.setattr(chosen_path, "BLOCK_SHINGLES", block)  # groups are compared in blocks
    monkeypatch.setattr(chosen_path, "BLOCK_DOCS", block // 300)
    monkeypatch.setattr(common, "BROADCAST_ROWS", block // 300)  # texts are shuffled to the groups, and hot joins spread
    want = groups(texts, k, num)
    got = chosen_path.near_duplicates(odd, k, (num, 100)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_near_duplicates_of_none(odd):
    assert chosen_path.near_duplicates(odd.where("false")).count() == 0
    assert {r.kept for r in chosen_path.near_duplicates(odd.where("text is null or text = ''")).collect()} == {True}


def test_recall_of_trees():
    assert chosen_path.trees_for(0.85, 3) >= 10 and chosen_path.survival(0.85, 3) > 0.5
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**62, (200, 100)).astype(np.uint64)
    met = 0
    for row in a:  # pairs of similarity 0.85
        b = row.copy()
        b[:8] = rng.integers(0, 2**62, 8)
        sk = np.concatenate([chosen_path.sketches(np.sort(s), np.array([0, len(s)])) for s in (row, b)])
        n = chosen_path.trees_for(0.85, 3)
        root = chosen_path.mix(np.arange(1, n + 1, dtype=np.uint64))
        path, who = chosen_path.branch(np.repeat(root, 2), np.tile([0, 1], n), sk, 0.85, 3)
        met += bool(set(path[who == 0]) & set(path[who == 1]))
    assert met == 200


@pytest.mark.parametrize(("num", "level"), [(80, 3), (80, 7), (80, 12), (85, 3), (85, 7), (85, 12)])
def test_recall_at_every_level(num, level):
    pairs, (common, a, b) = 15_000, (8, 1, 1) if num == 80 else (17, 2, 1)
    x = np.random.default_rng(level).integers(0, 2**62, (pairs, common + a + b)).astype(np.uint64)
    sides = [x[:, : common + a], np.concatenate([x[:, :common], x[:, common + a :]], 1)]
    n = chosen_path.trees_for(num / 100, level)
    values = [chosen_path.turns(s.reshape(-1), np.arange(pairs + 1) * s.shape[1], level, n) for s in sides]
    met = np.zeros(pairs, bool)
    for t in range(n):
        here = [chosen_path.nodes(v, num / 100, level, range(t, t + 1)) for v in values]
        keys = [chosen_path.mix(path ^ chosen_path.mix(row.astype(np.uint64))) for path, row in here]
        met[here[0][1][np.isin(keys[0], keys[1])]] = True
    assert met.all()
    places = sum(u == v for u, v in zip(*(chosen_path.sketches(s.reshape(-1), np.arange(pairs + 1) * s.shape[1]).T for s in sides)))
    assert places.min() >= chosen_path.least_places(num / 100)


def test_sketches_miss_no_more_than_said():
    for s in (0.8, 0.85):
        chance = np.cumsum(chosen_path._agreement(64, s))
        assert chance[chosen_path.least_places(s) - 1] <= 1e-7 < chance[chosen_path.least_places(s)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 160), (7, 8), (9, 9), (3, 7)]
    got = {r.v: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {5} and got[8] == got[7] == 3 and 9 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def by_lines(texts):
    docs, own = dict(texts), {}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    for d, t in docs.items():
        for x in (t or "").split("\n"):
            if d is not None and len(key(x)) >= 10:
                own.setdefault(key(x), set()).add(d)
    out = {}
    for d, t in docs.items():
        lines = (t or "").split("\n")
        keep = [x for x in lines if d is None or len(key(x)) < 10 or len(own[key(x)]) < 2 or min(own[key(x)]) == d]
        out[d] = len(lines), len(lines) - len(keep), "\n".join(keep)
    return out


@pytest.mark.parametrize("filter_bytes", [line_dedup.FILTER_BYTES, 0])
def test_lines(odd, texts, monkeypatch, filter_bytes):
    want = by_lines(texts)
    if not filter_bytes:
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    out = line_dedup.dedup_lines(odd, filter_bytes=filter_bytes)
    got = out.collect()
    assert len(got) == len(texts) and all((r.n_lines, r.n_dropped, r.kept) == want[r.doc_id] for r in got)
    assert all(r.kept_sha256 == hashlib.sha256(want[r.doc_id][2].encode()).hexdigest() for r in line_dedup.digest(out).collect())
    docs = line_dedup.dedup_documents(odd, filter_bytes=filter_bytes)
    assert docs.columns == odd.columns and sorted((repr(r.doc_id), r.text or "") for r in docs.collect()) == sorted((repr(d), want[d][2]) for d, _ in texts)
    assert line_dedup.dedup_lines(odd.where("false")).count() == 0


def state(index):
    """Exact table, references, and what the filters say of every key that was ever there."""
    table = sorted(map(tuple, index.table().collect()))
    held = {r.shard: line_dedup.CuckooFilter.load(bytes(r.filter)) for r in index.filters.collect()}
    n = {r.shard: r.n for r in index.filters.collect()}
    slots = {s: int((f.slots != 0).sum()) + len(f.overflow) for s, f in held.items()}
    return table, sorted(map(tuple, index.refs.select("doc_id", "h1", "h2").collect())), held, n, slots


@pytest.mark.parametrize("shard_keys", [line_dedup.SHARD_KEYS, 8])
def test_line_index_is_reversible(odd, monkeypatch, shard_keys):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", shard_keys)
    docs = odd.select("doc_id", "text")
    low, high = docs.where("doc_id < 60"), docs.where("doc_id >= 60")
    whole, first = line_dedup.LineIndex.of(docs), line_dedup.LineIndex.of(low)
    assert (whole.shards > 3) == (shard_keys == 8)
    both = first.insert(high)
    again = both.insert(low.limit(7)).insert(high)  # documents that it holds count once
    assert state(again)[:2] == state(both)[:2] == state(whole)[:2]
    assert state(both.delete(high))[:2] == state(first)[:2]  # insert then delete equals never
    assert state(both.delete(low))[:2] == state(line_dedup.LineIndex.of(high))[:2]
    for index in (both, again, both.delete(low)):
        table, refs_, held, n, slots = state(index)
        rep = [(h1, h2) for h1, h2, refs, _ in table if refs > 1]
        assert sum(n.values()) == len(rep) and n == slots  # a fingerprint for each repeated key, none left behind
        assert all(held[h2 % index.shards].contains(np.array([h1]))[0] for h1, h2 in rep)
        assert all(refs == sum(r[1:] == (h1, h2) for r in refs_) for h1, h2, refs, _ in table)
    none = both.delete(docs)
    assert none.table().count() == none.filters.count() == none.refs.count() == 0


def test_lines_against_an_index(odd, texts):
    docs = odd.select("doc_id", "text")
    index = line_dedup.LineIndex.of(docs.where("doc_id >= 40")).insert(docs.where("doc_id < 40"))
    want = by_lines(texts)
    for filter_bytes in (line_dedup.FILTER_BYTES, 0):
        got = line_dedup.dedup_lines(odd.where("doc_id % 2 = 1"), filter_bytes=filter_bytes, index=index).collect()
        assert got and all((r.n_lines, r.n_dropped, r.kept) == want[r.doc_id] for r in got)


def test_names_that_clash(spark):
    rows = [(1, "the same long line\nx", 1, "a"), (2, "the same long line\ny", 2, "b"), (2, "the same long line\ny", 2, "b")]
    got = line_dedup.dedup_documents(spark.createDataFrame(rows, "doc_id long, text string, drop long, _of string"))
    assert got.columns == ["doc_id", "text", "drop", "_of"] and sorted(map(tuple, got.collect())) == [rows[0], (2, "y", 2, "b"), (2, "y", 2, "b")]


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    h, other = rng.integers(-(2**62), 2**62, 20_000), rng.integers(-(2**62), 2**62, 100_000)
    c = line_dedup.CuckooFilter(len(h))
    c.insert(h)
    assert c.contains(h).all() and c.contains(other).mean() < 0.002
    again = line_dedup.CuckooFilter.load(c.dump())
    again.delete(h[:10_000])
    assert again.contains(h[10_000:]).all() and again.contains(h[:10_000]).mean() < 0.01
    again.delete(h[10_000:])
    assert not again.slots.any()
    tight = line_dedup.CuckooFilter(8)
    tight.insert(h[:100])  # far beyond its room: the rest is kept whole
    assert tight.contains(h[:100]).all() and tight.overflow and line_dedup.CuckooFilter.load(tight.dump()).contains(h[:100]).all()


def hits(texts, items):
    windows = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOW))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).add(i)
    out = {}
    for d, t in texts:
        w, hit, got = ALNUM.findall((t or "").translate(LOW)), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if (x := windows.get(tuple(w[k : k + m]))) is not None:
                    hit.update(range(k, k + m))
                    got |= x
        out[d] = len(w), len(hit), len(got), decontam.sha_of_items(got), len(hit) > 0 and 20 * len(hit) >= len(w)
    return out


@pytest.mark.parametrize("max_held", [decontam.MAX_HELD, 3])
def test_contamination(spark, odd, texts, monkeypatch, max_held):
    if max_held == 3:
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    long = [t for _, t in texts if t and len(t.split()) > 60]
    items = [(1, None), (2, ""), (3, "..."), (4, "the same"), (10, " ".join(long[3].split()[5:30])), (11, "(" + ", ".join(long[9].split()[10:23]).upper() + ")"), (12, " ".join(long[20].split()[:12])), (13, "edit"), (14, "ab " * 40), (15, " ".join(long[3].split()[5:30]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = hits(texts, items)
    found = decontam.contamination(odd, bench, max_held=max_held)
    got = decontam.digest(found).collect()
    assert len(got) == len(texts) and sum(r.contaminated for r in got) > 5
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id], r
    kept = decontam.clean(odd, bench, max_held=max_held)
    assert kept.columns == odd.columns and sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.doc_id) for r in got if not r.contaminated)
    assert not any(r.n_hit for r in decontam.digest(decontam.contamination(odd, bench.where("false"))).collect())
    assert decontam.contamination(odd.where("false"), bench).count() == 0


@pytest.mark.parametrize("max_held", [decontam.MAX_HELD, 3])
def test_items_without_an_id_count_as_in_the_sql(spark, odd, texts, max_held):
    import duckdb

    from quillmere.llm.queries import ORACLE_SQL

    long = [t for _, t in texts if t and len(t.split()) > 60]
    items = [(None, long[3]), (None, " ".join(long[9].split()[5:40])), (1, " ".join(long[3].split()[5:30])), (2, "edit"), (None, "word"), (None, None)]
    docs = [(d, t) for d, t in dict(texts).items() if d is not None]
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    want = sorted(con.sql(ORACLE_SQL["op8_decontamination"]).fetchall())
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, decontam.digest(decontam.contamination(docs, bench, max_held=max_held)).collect())) == want
    assert sorted(r.doc_id for r in decontam.clean(docs, bench, max_held=max_held).collect()) == [r[0] for r in want if not r[5]]
