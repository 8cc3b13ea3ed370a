"""Line dedup: sharded cuckoo filters backed by exact reference-count tables.

A line's key is hashed to 128 bits; one half of the hash names its shard. The index is stored: for each shard the exact table of its
keys with their reference counts (documents that hold them) and owners (the smallest of these), and a cuckoo filter of the keys that more
than one document holds; beside them the references themselves, which give the next owner after a deletion. A filter answers
"surely not repeated"; only lines that pass their shard's filter go to the exact table, which decides. Inserting
or deleting documents counts only the keys they hold: the counts of these go up or down, keys that become repeated
are put into their shard's filter and those that cease to be are deleted from it. After a deletion the
index is what it would be had the documents never come.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmere.llm.common import arrow_map, fresh, keep, looked_up, shared_root, spread_join, stored, text_list
from quillmere.llm.texthash import U, mix
from quillmere.sources.shared import hadoop_path

MIN_KEY = 10
SPACE = b" \t\n\x0b\x0c\r"
SLOTS, KICKS = 4, 500
#: Keys that a shard has about, when an index is made; shards at most.
SHARD_KEYS, MAX_SHARDS = 500_000, 1 << 16
#: A filter with more of its slots in use is made anew, larger, from the exact table of its shard.
FULL = 0.9
#: Filters go to the lines' own tasks if all together take at most so many bytes; beyond, lines go to their shard's filter, so many to a task.
FILTER_BYTES, TASK_LINES = 64 << 20, 2_000_000


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; keys are given by 64-bit hashes. delete() undoes insert().

    A key that finds no place after KICKS moves is kept whole in an exact overflow list, so insertion never fails.
    """

    def __init__(self, capacity: int, slots: np.ndarray | None = None, overflow=()):
        n = 1 << max(1, int(np.ceil(np.log2(max(1, capacity) / SLOTS / 0.85))))
        self.slots = np.zeros((n, SLOTS), np.uint16) if slots is None else slots
        self.mask = U(len(self.slots) - 1)
        self.overflow: list[int] = list(overflow)

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint, first bucket, second bucket) of each hash."""
        h = mix(np.asarray(h).astype(U))
        f = (h >> U(48)).astype(np.uint16)
        f[f == 0] = 1
        a = h & self.mask
        return f, a, a ^ (mix(f.astype(U)) & self.mask)

    def _put(self, bucket: int, f) -> bool:
        free = np.flatnonzero(self.slots[bucket] == 0)
        if len(free):
            self.slots[bucket, free[0]] = f
        return bool(len(free))

    def insert(self, hashes: np.ndarray) -> None:
        hashes = np.asarray(hashes).astype(U)
        f, a, b = self.places(hashes)
        rest = np.arange(len(f))
        for place in (a, b):  # most find a free slot at once: one pass for all, by rank within the bucket
            order = rest[np.argsort(place[rest], kind="stable")]
            bucket = place[order].astype(np.int64)
            rank = np.arange(len(order)) - np.searchsorted(bucket, bucket)
            free = np.argsort(self.slots[bucket] != 0, axis=1, kind="stable")
            fit = rank < (self.slots[bucket] == 0).sum(1)
            to = np.flatnonzero(fit)
            self.slots[bucket[to], free[to, rank[to]]] = f[order[to]]
            rest = order[~fit]
        rng = np.random.default_rng(len(f))
        for i in rest:
            x, at = f[i], int(b[i])
            undo = []
            for _ in range(KICKS):
                if self._put(at, x):
                    break
                j = int(rng.integers(SLOTS))
                undo.append((at, j, self.slots[at, j]))
                x, self.slots[at, j] = self.slots[at, j], x
                at ^= int(mix(np.array([x], U))[0] & self.mask)
            else:
                for at, j, old in reversed(undo):
                    self.slots[at, j] = old
                self.overflow.append(int(hashes[i]))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        f, a, b = self.places(hashes)
        f = f[:, None]
        got = (self.slots[a.astype(np.int64)] == f).any(1) | (self.slots[b.astype(np.int64)] == f).any(1)
        return got | np.isin(np.asarray(hashes).astype(U), np.array(self.overflow, U)) if self.overflow else got

    def delete(self, hashes: np.ndarray) -> None:
        """Takes away hashes that were inserted."""
        hashes = np.asarray(hashes).astype(U)
        for h, f, a, b in zip(hashes, *self.places(hashes)):
            if int(h) in self.overflow:
                self.overflow.remove(int(h))
                continue
            for at in (int(a), int(b)):
                if len(k := np.flatnonzero(self.slots[at] == f)):
                    self.slots[at, k[0]] = 0
                    break

    def dump(self) -> bytes:
        return np.array([len(self.slots), *self.overflow], U).tobytes() + self.slots.tobytes()

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        n = int(np.frombuffer(data, U, 1)[0])
        head = len(data) - n * SLOTS * 2
        return cls(1, np.frombuffer(data, np.uint16, n * SLOTS, head).reshape(n, SLOTS).copy(), np.frombuffer(data, U, head // 8 - 1, 8).tolist())


def line_keys(text: str) -> list[bytes]:
    """Keys of the lines: ASCII white space off both ends, A-Z in lower case."""
    return [x.strip(SPACE) for x in text.encode().lower().split(b"\n")]


def _long(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _hashes(keys: list[bytes]) -> np.ndarray:
    """128-bit hashes as rows of two signed 64-bit integers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<i8").reshape(-1, 2)


def references(docs: DataFrame, least: int = MIN_KEY) -> DataFrame:
    """doc_id, h1, h2: each document's keys of at least `least` code points, each once."""

    def run(b: pa.RecordBatch) -> dict:
        ids, keys = [], []
        for d, t in zip(b.column("doc_id").to_pylist(), text_list(b.column("text"))):
            own = {k for k in line_keys(t) if _long(k, least)}
            keys.extend(own)
            ids += [d] * len(own)
        h = _hashes(keys)
        return {"doc_id": ids, "h1": pa.array(h[:, 0]), "h2": pa.array(h[:, 1])}

    return arrow_map(docs, run, "doc_id long, h1 long, h2 long")


def _shard(shards: int):
    return F.pmod(F.col("h2"), F.lit(shards)).cast("int")


def _filter_rows(t: pa.Table) -> pa.Table:
    """The filter of one shard's keys: shard, n, slots, filter."""
    h = np.unique(t.column("h1").to_numpy())
    c = CuckooFilter(len(h))
    c.insert(h)
    return _row(t.column("shard")[0].as_py(), len(h), c)


def _row(shard: int, n: int, c: CuckooFilter) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([n], pa.int64()), "slots": pa.array([c.slots.size], pa.int64()), "filter": pa.array([c.dump()], pa.binary())})


def _changed_filter(old: pa.Table, ops: pa.Table) -> pa.Table:
    """A shard's filter after keys were put in or deleted."""
    up = ops.column("up").to_numpy(zero_copy_only=False) if len(ops) else np.zeros(0, bool)
    h = ops.column("h1").to_numpy() if len(ops) else np.zeros(0, np.int64)
    c = CuckooFilter.load(old.column("filter")[0].as_py()) if len(old) else CuckooFilter(len(h))
    n = old.column("n")[0].as_py() if len(old) else 0
    c.delete(h[~up])
    c.insert(h[up])
    return _row((old if len(old) else ops).column("shard")[0].as_py(), n + int(up.sum()) - int((~up).sum()), c)


_FILTER = "shard int, n long, slots long, filter binary"
_COUNTS = "h1 long, h2 long, refs long, owner long"


class LineIndex:
    """A stored index. Each change gives a new one and leaves the old as it was; files of shards that didn't change are shared.

    refs: (doc_id, h1, h2), each once, however often a document's row was given. files: the folder of each shard's exact counts
    (h1, h2, refs, owner), of the shards that have any. filters: shard, n, slots, filter.
    """

    def __init__(self, spark: SparkSession, refs: DataFrame, shards: int, files: dict[int, str], filters: DataFrame, least: int):
        self.spark, self.refs, self.shards, self.files, self.filters, self.least = spark, refs, shards, files, filters, least

    @classmethod
    def of(cls, docs: DataFrame, least: int = MIN_KEY) -> LineIndex:
        """The index of docs (doc_id, text); rows without an id are left out."""
        refs = stored(_once(references(docs, least)), "references")
        keys = refs.agg(F.approx_count_distinct("h1")).first()[0]
        shards = min(MAX_SHARDS, max(1, -(-keys // SHARD_KEYS)))
        empty = docs.sparkSession.createDataFrame([], _FILTER)
        index = cls(docs.sparkSession, refs, shards, {}, empty, least)
        index._write(refs.groupBy("h1", "h2").agg(F.count("*").alias("refs"), F.min("doc_id").alias("owner")))
        rep = index.repeated().select(_shard(shards).alias("shard"), "h1")
        index.filters = stored(rep.groupBy("shard").applyInArrow(_filter_rows, _FILTER), "filters")
        return index

    def _write(self, counts: DataFrame) -> None:
        """Counts of whole shards, one folder for each; the driver keeps the names of at most MAX_SHARDS folders."""
        path = f"{shared_root(self.spark)}/quillmere/lines-{uuid.uuid4().hex}"
        counts.withColumn("shard", _shard(self.shards)).repartition("shard").write.partitionBy("shard").parquet(path)
        fs, p = hadoop_path(self.spark, path)
        fs.deleteOnExit(p)
        names = [x.getPath().getName() for x in fs.listStatus(p)]
        self.files |= {int(n.partition("=")[2]): f"{path}/{n}" for n in names if n.startswith("shard=")}

    def table(self, shards=None) -> DataFrame:
        """h1, h2, refs, owner of every key, or of the keys of some shards."""
        paths = [p for s, p in sorted(self.files.items()) if shards is None or s in shards]
        return self.spark.read.schema(_COUNTS).parquet(*paths) if paths else self.spark.createDataFrame([], _COUNTS)

    def repeated(self) -> DataFrame:
        """Keys that two or more documents hold."""
        return self.table().where("refs > 1")

    def insert(self, docs: DataFrame) -> LineIndex:
        """With the documents docs (doc_id, text). A key that a document is known to hold isn't counted again."""
        new = stored(_once(references(docs, self.least)).join(self.refs, ["doc_id", "h1", "h2"], "left_anti"), "references")
        delta = new.groupBy("h1", "h2").agg(F.count("*").alias("d"), F.min("doc_id").alias("first"))
        return self._changed(delta, F.least("owner", "first"), self.refs.unionByName(new))

    def delete(self, ids: DataFrame) -> LineIndex:
        """Without the documents whose doc_id is in ids. Keys whose owner goes get the next from the references to them that are left."""
        ids = ids.select("doc_id").where("doc_id is not null").distinct()
        gone = stored(self.refs.join(ids, "doc_id", "left_semi"), "references")
        left = self.refs.join(ids, "doc_id", "left_anti")
        delta = gone.groupBy("h1", "h2").agg((-F.count("*")).alias("d"), F.min("doc_id").alias("gone"))
        lost = delta.join(self.table(), ["h1", "h2"]).where("gone <= owner and refs + d > 0").select("h1", "h2")
        nxt = left.join(lost, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
        return self._changed(delta.drop("gone").join(nxt, ["h1", "h2"], "left"), F.coalesce("first", "owner"), left)

    def _changed(self, delta: DataFrame, owner, refs: DataFrame) -> LineIndex:
        """The index after the counts of some keys changed by d; only their shards are read and written."""
        delta = stored(delta, "changes")
        touched = {r[0] for r in delta.select(_shard(self.shards)).distinct().toLocalIterator()}  # at most MAX_SHARDS
        was = F.coalesce("refs", F.lit(0))
        both = self.table(touched).join(delta, ["h1", "h2"], "full")
        both = stored(both.select("h1", "h2", was.alias("was"), (was + F.coalesce("d", F.lit(0))).alias("refs"), owner.alias("owner")), "changes")
        out = LineIndex(self.spark, stored(refs, "references"), self.shards, {s: p for s, p in self.files.items() if s not in touched}, None, self.least)
        out._write(both.where("refs > 0").drop("was"))
        ops = both.where("(was > 1) <> (refs > 1)").select(_shard(self.shards).alias("shard"), "h1", (F.col("refs") > 1).alias("up"))
        ups = ops.groupBy("shard").agg(F.count_if("up").alias("ups"))
        full = self.filters.join(ups, "shard").where(F.col("n") + F.col("ups") > FULL * F.col("slots")).select("shard")
        full = stored(full, "shards")  # filters that would overflow are made anew from the exact table
        changed = self.filters.join(full, "shard", "left_anti").groupBy("shard").cogroup(ops.join(full, "shard", "left_anti").groupBy("shard")).applyInArrow(_changed_filter, _FILTER)
        again = out.repeated().select(_shard(self.shards).alias("shard"), "h1").join(full, "shard", "left_semi").groupBy("shard").applyInArrow(_filter_rows, _FILTER)
        out.filters = stored(changed.unionByName(again).where("n > 0"), "filters")
        return out


def _once(refs: DataFrame) -> DataFrame:
    """References of documents with an id, each once; dealt by all three columns, so a line that is everywhere lies in no one task."""
    return refs.where("doc_id is not null").groupBy("doc_id", "h1", "h2").agg(F.lit(1).alias("one")).drop("one")


def lines_of(docs: DataFrame, least: int, ask=None) -> DataFrame:
    """doc_id, line, h1, h2 of the lines of docs with a key of at least `least` code points; ask(h1, h2) picks some in their own task."""

    def run(b: pa.RecordBatch) -> dict:
        ids, at, keys = [], [], []
        for d, t in zip(b.column("doc_id").to_pylist(), text_list(b.column("text"))):
            if d is not None:
                for i, k in enumerate(line_keys(t)):
                    if _long(k, least):
                        keys.append(k), ids.append(d), at.append(i)
        h = _hashes(keys)
        pick = np.flatnonzero(ask(h[:, 0], h[:, 1])) if ask and len(h) else np.arange(len(h))
        return {"doc_id": pa.array(np.array(ids, np.int64)[pick]), "line": pa.array(np.array(at, np.int32)[pick]), "h1": pa.array(h[pick, 0]), "h2": pa.array(h[pick, 1])}

    return arrow_map(docs, run, "doc_id long, line int, h1 long, h2 long")


def _held(index: LineIndex):
    """ask() for lines_of: each key in its own shard's filter, all filters being held by every worker."""
    name, shards = uuid.uuid4().hex, index.shards
    sent = index.spark.sparkContext.broadcast({r.shard: bytes(r.filter) for r in index.filters.collect()})

    def ask(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        global _loaded
        if _loaded is None or _loaded[0] != name:
            _loaded = name, {s: CuckooFilter.load(f) for s, f in sent.value.items()}
        own, out = h2 % shards, np.zeros(len(h1), bool)
        for s in np.unique(own):
            if (f := _loaded[1].get(int(s))) is not None:
                at = np.flatnonzero(own == s)
                out[at] = f.contains(h1[at])
        return out

    return ask


def _routed(lines: DataFrame, index: LineIndex) -> DataFrame:
    """Lines that pass their shard's filter, which they are brought to: the lines of a shard go to as many tasks as their number
    asks for, by document and line, each with a copy of the filter at its head."""
    lines = stored(lines.withColumn("shard", _shard(index.shards)), "lines")
    tasks = lines.groupBy("shard").agg(F.ceil(F.count("*") / TASK_LINES).cast("int").alias("tasks"))  # at most MAX_SHARDS rows
    dealt = lines.join(F.broadcast(tasks), "shard").withColumn("task", F.pmod(F.xxhash64("doc_id", "line"), F.col("tasks")).cast("int")).drop("tasks")
    heads = index.filters.select("shard", "filter").join(F.broadcast(tasks), "shard").select("shard", F.explode(F.expr("sequence(0, tasks - 1)")).alias("task"), "filter")
    both = heads.unionByName(dealt, allowMissingColumns=True).repartition("shard", "task").sortWithinPartitions("shard", "task", F.col("filter").isNull())

    def run(batches):
        key, held = None, None
        for b in batches:
            shard, task, filters = b.column("shard").to_numpy(), b.column("task").to_numpy(), b.column("filter")
            cut = np.flatnonzero((shard[1:] != shard[:-1]) | (task[1:] != task[:-1])) + 1
            keep_ = []
            for a, z in zip([0, *cut], [*cut, b.num_rows]):
                if (shard[a], task[a]) != key:  # a shard without a filter has no repeated key
                    key, head = (shard[a], task[a]), filters[int(a)].as_py()
                    held = CuckooFilter.load(head) if head is not None else None
                    a += head is not None
                if held is not None and a < z:
                    keep_.append(a + np.flatnonzero(held.contains(b.column("h1").slice(a, z - a).to_numpy())))
            if keep_:
                yield pa.RecordBatch.from_arrays([b.column(n) for n in ("doc_id", "line", "h1", "h2")], ["doc_id", "line", "h1", "h2"]).take(pa.array(np.concatenate(keep_)))

    return both.mapInArrow(run, "doc_id long, line int, h1 long, h2 long")


def lines_to_drop(docs: DataFrame, least: int = MIN_KEY, filter_bytes: int = FILTER_BYTES, index: LineIndex | None = None) -> DataFrame:
    """doc_id, drop (numbers of the lines that go, from 0) of the documents (doc_id, text) that lose a line; against an index that
    holds these documents, or one made of them."""
    index = index or LineIndex.of(docs, least)
    small = (index.filters.agg(F.sum(F.length("filter"))).first()[0] or 0) <= filter_bytes
    lines = lines_of(docs, index.least, _held(index)) if small else _routed(lines_of(docs, index.least), index)
    found = spread_join(stored(lines, "lines"), index.repeated().select("h1", "h2", "owner"), ["h1", "h2"], ["doc_id", "line"])
    # a document given twice has each of its lines twice here
    return stored(found.where(F.col("doc_id") > F.col("owner")).groupBy("doc_id").agg(F.collect_set("line").alias("drop")), "drops")


def _without(text: str, gone) -> str:
    return "\n".join([x for i, x in enumerate(text.split("\n")) if i not in gone]) if gone else text


def dedup_lines(docs: DataFrame, least: int = MIN_KEY, id_col: str = "doc_id", text_col: str = "text", filter_bytes: int = FILTER_BYTES, index: LineIndex | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (text) of each row of docs.

    A line goes if its key has at least `least` code points, two or more documents hold it, and this
    document isn't the smallest of them. Within its smallest document all its lines stay. Null or empty
    text is one empty line. A row without an id keeps all its lines and counts for no other; rows of the same id are
    one document; other columns are left out; an empty table gives none. With an index, which holds these documents and others,
    the documents it holds count; without, those of docs.
    """
    docs = keep(docs, doc_id=id_col, text=text_col)

    def cut(b: pa.RecordBatch) -> dict:
        n_lines, n_dropped, kept = [], [], []
        for t, gone in zip(text_list(b.column("text")), b.column("drop").to_pylist()):
            gone = set(gone or ())
            n_lines.append(t.count("\n") + 1)
            n_dropped.append(len(gone))
            kept.append(_without(t, gone))
        return {"doc_id": b.column("doc_id"), "n_lines": n_lines, "n_dropped": n_dropped, "kept": pa.array(kept, pa.string())}

    return arrow_map(looked_up(docs, lines_to_drop(docs, least, filter_bytes, index), ["doc_id"], "left"), cut, "doc_id long, n_lines long, n_dropped long, kept string")


def dedup_documents(docs: DataFrame, least: int = MIN_KEY, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """docs with the lines that dedup_lines() drops taken out of text, and n_chars (if there is such a column) that of what is left.
    Every row stays, and every other column; a null text stays null."""
    gone_ = fresh(docs, "drop")
    drop = lines_to_drop(keep(docs, doc_id="doc_id", text="text"), least, filter_bytes).withColumnRenamed("drop", gone_)
    schema, names = docs.schema, docs.columns

    def run(batches):
        for b in batches:
            text, gone = b.column("text").to_pylist(), b.column(gone_).to_pylist()
            text = [t if t is None else _without(t, set(g or ())) for t, g in zip(text, gone)]
            cols = {n: b.column(n) for n in names} | {"text": pa.array(text, b.schema.field("text").type)}
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([len(t) if t is not None and g else n for t, g, n in zip(text, gone, b.column("n_chars").to_pylist())], b.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names)

    return looked_up(docs, drop, ["doc_id"], "left").select(*names, gone_).mapInArrow(run, schema)


_loaded = None


def digest(out: DataFrame) -> DataFrame:
    """dedup_lines() with the kept text as its hash."""
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
