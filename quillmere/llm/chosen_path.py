"""Near-duplicates by chosen-path set similarity join.

Each document is the set of its word shingles, sketched by minwise values. Documents of equal sets are one class.
In each of many trees, independent as each reads minwise values of its own, a node picks one or two of them by a hash of its path, the same
for all documents in it, and passes each document on to the child named by its value there; so a pair at the
threshold meets in one child on average, whatever the level, and unlike documents part. A document works out its
nodes at a level alone; only nodes that hold several documents are looked at: small ones are compared exhaustively on
sketches; in larger ones every document is compared with the first, and if that doesn't tie them all, they branch on
to levels where only like documents are still together. What is linked there are candidates; the groups that these
form are then compared exactly on the full sets: within blocks of bounded size, then what is not yet tied to the group's
largest part with all blocks. Pairs that are already tied are passed over. No cap drops anything.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmere.llm.common import arrow_map, arrow_schema, dropped, keep, looked_up, spread_join, stored, text_bytes
from quillmere.llm.components import connected_components
from quillmere.llm.texthash import NOT_SPACE, U, grams, mix, whole_gram, words_of

COORDINATES = 64
#: Levels at which nodes are looked at, one forest for each, and the minwise values that each tree has for itself; documents in a node that is compared exhaustively. Documents of larger
#: nodes go on to the next forest; in nodes of the last, only documents that are alike are still together.
TREE_COORDINATES, SMALL = {3: 8, 7: 16, 12: 16}, 256
LEVELS = tuple(TREE_COORDINATES)
#: Trees of a forest that are looked at first; in the others, nodes whose documents are all tied together by then are passed over.
FIRST_TREES = 4
#: Recall to which the number of trees is set, for a pair whose similarity is just the threshold.
RECALL = 0.999999
#: Chance that the sketches of such a pair agree in too few places to be compared exactly.
SKETCH_MISS = 1e-7
#: Shingles in a block of the exact comparison, and documents; first documents of parts that are compared at once.
BLOCK_SHINGLES, BLOCK_DOCS, BLOCK_HEADS = 1_000_000, 250, 250


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int):
    """(first document, end document, distinct shingle hashes in order, offsets into them) for runs of documents.

    A document of fewer words than k has its whole word sequence as one shingle; one without words has none.
    """
    for w in words_of(data, offsets, NOT_SPACE):
        doc, n = w.doc, w.hi - w.lo
        g, at = grams(w, k)
        d = doc[at]
        short = np.flatnonzero((np.diff(w.first) > 0) & (np.diff(w.first) < k))
        if len(short):
            g = np.concatenate([g, np.array([whole_gram(w.hash[w.first[i] : w.first[i + 1]]) for i in short], U)])
            d = np.concatenate([d, short])
        order = np.lexsort((g, d))
        g, d = g[order], d[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
        g, d = g[new], d[new]
        yield w.lo, w.hi, g, np.searchsorted(d, np.arange(n + 1))


def sketches(g: np.ndarray, first: np.ndarray, at: int = 0, coordinates: int = COORDINATES) -> np.ndarray:
    """Minwise values of 16 bits, those from number `at` on, a row for each set; sets must not be empty."""
    out = np.empty((len(first) - 1, coordinates), np.uint16)
    multiply = mix(np.arange(at + 1, at + coordinates + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(17)) | U(1)
    for c in range(coordinates):
        x = g * multiply[c]
        x ^= x >> U(29)
        x *= U(0xBF58476D1CE4E5B9)
        out[:, c] = mix(np.minimum.reduceat(x, first[:-1])) >> U(48)
    return out


def turns(g: np.ndarray, first: np.ndarray, level: int, trees: int) -> np.ndarray:
    """The minwise values that the trees of a level's forest read, TREE_COORDINATES for each tree; none is also in the sketch."""
    return sketches(g, first, COORDINATES + 100_000 * level, trees * TREE_COORDINATES[level])


def _agreement(n: int, similarity: float) -> list[float]:
    """Chances that 0..n of n minwise values of a pair agree."""
    return [math.comb(n, k) * similarity**k * (1 - similarity) ** (n - k) for k in range(n + 1)]


def survival(similarity: float, level: int) -> float:
    """Chance that a pair of this similarity shares a node of the level in a tree, when the threshold is the same: the mean
    over how many of the tree's minwise values agree, since all its nodes read these."""
    n, more, mean = TREE_COORDINATES[level], 1 / similarity - 1, 0.0
    for k, chance in enumerate(_agreement(n, similarity)):
        f, both, one = 1.0, k * (k - 1) / (n * (n - 1)), 2 * k * (n - k) / (n * (n - 1))
        for _ in range(level):
            f = (1 - more) * k / n * f + more * (both * (1 - (1 - f) ** 2) + one * f)
        mean += chance * f
    return mean


def trees_for(similarity: float, level: int, recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(similarity, level)))


def least_places(similarity: float) -> int:
    """In how many places sketches must agree, so that a pair at the threshold is missed with a chance of SKETCH_MISS at most."""
    return int(np.searchsorted(np.cumsum(_agreement(COORDINATES, similarity)), SKETCH_MISS, "right"))


def branch(path: np.ndarray, row: np.ndarray, sketch: np.ndarray, similarity: float, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(path, row) of the nodes `levels` below: a node has one child for each of one or two coordinates, 1 / similarity on average."""
    second, n = U(int((1 / similarity - 1) * 2**64)), sketch.shape[1]
    for _ in range(levels):
        h = mix(path)
        h2 = mix(path ^ U(0x5851F42D4C957F2D))
        i = (h % U(n)).astype(np.int64)
        j = (i + 1 + ((h >> U(20)) % U(n - 1)).astype(np.int64)) % n
        two = np.flatnonzero(h2 < second)
        down = lambda at, c: mix((path[at] + U(0x2545F4914F6CDD1D)) * U(0xD6E8FEB86659FD93) + c.astype(U) * U(65537) + sketch[row[at], c].astype(U))
        every = np.arange(len(path))
        path, row = np.concatenate([down(every, i), down(two, j[two])]), np.concatenate([row, row[two]])
    return path, row


def nodes(values: np.ndarray, similarity: float, level: int, trees: range) -> tuple[np.ndarray, np.ndarray]:
    """(path, row) of the nodes of a level in these trees, for rows of turns()."""
    roots = mix(np.arange(trees.start + 1, trees.stop + 1, dtype=U) * U(0x632BE59BD9B4E019) + U(level))
    n, rows = TREE_COORDINATES[level], np.arange(len(values))
    got = [branch(np.repeat(root, len(rows)), rows, values[:, t * n : (t + 1) * n], similarity, level) for t, root in zip(trees, roots)]
    return np.concatenate([p for p, _ in got]), np.concatenate([r for _, r in got])


def _sketch_rows(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, COORDINATES)


def sketch_table(docs: DataFrame, k: int, level: int, trees: int) -> DataFrame:
    """doc_id, n_shingles, k1, k2 (hash of the whole set), sketch, turns (for so many trees of the level) of each row of (doc_id, text)."""

    def run(b: pa.RecordBatch) -> dict:
        n, keys, sk, own = np.zeros(b.num_rows, np.int64), np.zeros((b.num_rows, 2), np.int64), [None] * b.num_rows, [None] * b.num_rows
        for lo, hi, g, first in shingle_sets(*text_bytes(b.column("text")), k):
            size = np.diff(first)
            n[lo:hi] = size
            some = np.flatnonzero(size)
            if len(some) == 0:
                continue
            starts = np.append(first[:-1][some], len(g))
            s, v = sketches(g, starts), turns(g, starts, level, trees)
            for i, d in enumerate(some):
                sk[lo + d], own[lo + d] = s[i].tobytes(), v[i].tobytes()
            for c, by in enumerate((U(0x8CB92BA72F3D8DD7), U(0xC13FA9A902A6328F))):
                keys[lo + some, c] = np.add.reduceat(mix(g * by), starts[:-1]).view(np.int64)
        return {"doc_id": b.column("doc_id"), "n_shingles": pa.array(n), "k1": pa.array(keys[:, 0]), "k2": pa.array(keys[:, 1]), "sketch": sk, "turns": own}

    return arrow_map(docs, run, "doc_id long, n_shingles long, k1 long, k2 long, sketch binary, turns binary")


def next_turns(rows: DataFrame, docs: DataFrame, k: int, level: int, trees: int) -> DataFrame:
    """rows with the turns of another level, from the texts of these documents."""

    def run(b: pa.RecordBatch) -> dict:
        own = [None] * b.num_rows
        for lo, hi, g, first in shingle_sets(*text_bytes(b.column("text")), k):
            if len(some := np.flatnonzero(np.diff(first))):
                for d, v in zip(some, turns(g, np.append(first[:-1][some], len(g)), level, trees)):
                    own[lo + d] = v.tobytes()
        return {"doc_id": b.column("doc_id"), "turns": own}

    texts = looked_up(docs, stored(rows.select("doc_id"), "ids"), ["doc_id"])
    return rows.drop("turns").join(arrow_map(texts, run, "doc_id long, turns binary").where("turns is not null").dropDuplicates(["doc_id"]), "doc_id")


def by_group(df: DataFrame, key: str, fn, schema: str) -> DataFrame:
    """fn(key, rows as a pyarrow table) for each group; rows of a key lie together, so a group is cut from the stream of
    batches, without a call for each group. fn gives columns or None."""
    arrow = arrow_schema(schema)

    def run(batches):
        rest, out, n = None, [], 0
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            keys = t.column(key).to_numpy()
            cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for a, z in zip(np.append(0, cut[:-1]), cut) if len(cut) else ():
                if (got := fn(t.slice(a, z - a).combine_chunks())) is not None:
                    out.append(got)
                    n += len(got)
            rest = t.slice(cut[-1]) if len(cut) else t
            if n > 20_000:
                yield from pa.concat_tables(out).cast(arrow).to_batches()
                out, n = [], 0
        if rest is not None and (got := fn(rest.combine_chunks())) is not None:
            out.append(got)
        if out:
            yield from pa.concat_tables(out).cast(arrow).to_batches()

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


class Links:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _alike(sk: np.ndarray, n: np.ndarray, similarity: float, least: int, block: int = 256):
    """(i, j) index arrays, i < j, of rows whose sizes allow the similarity and whose sketches agree in `least` places."""
    for a in range(0, len(sk), block):
        same = np.zeros((min(block, len(sk) - a), len(sk) - a), np.int16)
        for c in range(COORDINATES):
            same += sk[a : a + block, c][:, None] == sk[a:, c][None, :]
        x, y = n[a : a + block][:, None], n[a:][None, :]
        i, j = np.nonzero(np.triu(same >= least, 1) & (np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-9))
        yield i + a, j + a


def nodes_of(reps: DataFrame, similarity: float, level: int, trees: range) -> DataFrame:
    """path, doc_id, component: the nodes of a level that each document is in; every document works them out alone."""

    def run(b: pa.RecordBatch) -> dict | None:
        if not b.num_rows:
            return None
        values = np.frombuffer(b"".join(b.column("turns").to_pylist()), np.uint16).reshape(b.num_rows, -1)
        path, row = nodes(values, similarity, level, trees)
        key = np.unique(np.stack([path.view(np.int64), row], 1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
        return {"path": pa.array(key[:, 0]), "doc_id": b.column("doc_id").take(pa.array(key[:, 1])), "component": b.column("component").take(pa.array(key[:, 1]))}

    return arrow_map(reps.select("doc_id", "component", "turns"), run, "path long, doc_id long, component long")


def candidates(reps: DataFrame, docs: DataFrame, k: int, similarity: float, recall: float = RECALL) -> DataFrame:
    """v, component (smallest v reachable) of classes (doc_id, n_shingles, sketch, turns of the first level) with candidate links.

    A pair meets in some node of each forest with the recall asked for. If a node they share is small, they are compared on
    sketches, which must agree in so many places as those of a pair at the threshold do but for a chance of SKETCH_MISS. If all are
    large, both go on to the next forest, which reads other minwise values. In large nodes of the last every document is tied to the smallest.

    Forests are looked at in two parts, and documents that a part is seen to tie together have one label in the next. Nodes of a single
    label have no link to add and are passed over; other nodes tie labels, not documents. So a large group gives a few
    ties for each document, not one for each node that the document is in. Labels are followed for two ties only, which is enough to
    pass over most; the components of all ties are worked out once, at the end.
    """
    least = least_places(similarity)

    def compare(t: pa.Table):
        """Components linked here, tied to the smallest of them."""
        own, of = np.unique(t.column("component").to_numpy(), return_inverse=True)
        links = Links(len(own))
        for i, j in _alike(_sketch_rows(t.column("sketch")), t.column("n_shingles").to_numpy(), similarity, least):
            for x, y in np.unique(np.stack([of[i], of[j]], 1)[of[i] != of[j]], axis=0).tolist():
                links.link(x, y)
        roots = np.array([links.root(i) for i in range(len(own))])
        tied = np.flatnonzero(roots != np.arange(len(own)))
        return pa.table({"a": pa.array(own[roots[tied]]), "b": pa.array(own[tied])}) if len(tied) else None

    def like_first(b: pa.RecordBatch) -> dict:
        """Components of a node's documents that are like its first, tied to that one's."""
        x, y = b.column("n_shingles").to_numpy(), b.column("first_n").to_numpy()
        same = (_sketch_rows(b.column("sketch")) == _sketch_rows(b.column("first_sketch"))).sum(1) >= least
        ok = pa.array(same & (np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-9))
        return {"a": b.column("first_component").filter(ok), "b": b.column("component").filter(ok)}

    groups, rows, found = None, reps, []
    for level in LEVELS:
        trees, hot = trees_for(similarity, level, recall), []
        for part in (range(min(FIRST_TREES, trees)), range(min(FIRST_TREES, trees), trees)):
            if not part:
                continue
            nodes = stored(nodes_of(_labelled(rows, groups), similarity, level, part), "nodes")
            size = nodes.groupBy("path").agg(F.count("*").alias("size"), F.min("component").alias("least"), F.max("component").alias("most"), F.min(F.struct("doc_id", "component")).alias("first"))
            size = stored(size.where("size > 1 and least < most"), "sizes")
            sketch = rows.select("doc_id", "n_shingles", "sketch")
            small = nodes.join(size.where(F.col("size") <= SMALL).select("path"), "path").join(sketch, "doc_id")
            ties = by_group(small.select("path", "component", "n_shingles", "sketch"), "path", compare, "a long, b long")
            large = size.where(F.col("size") > SMALL)
            some_large = bool(large.limit(1).count())
            if some_large and level == LEVELS[-1]:
                in_large = nodes.join(large.select("path", "least"), "path")
                ties = ties.unionByName(in_large.where("component > least").select(F.col("least").alias("a"), F.col("component").alias("b")))
            elif some_large:
                first = large.select("path", F.col("first.doc_id").alias("doc_id"), F.col("first.component").alias("first_component"))
                first = first.join(sketch, "doc_id").select("path", "first_component", F.col("n_shingles").alias("first_n"), F.col("sketch").alias("first_sketch"))
                in_large = stored(spread_join(nodes, stored(first, "firsts"), ["path"], ["doc_id"]), "large")
                to_first = in_large.where("component <> first_component").join(sketch, "doc_id")
                ties = ties.unionByName(arrow_map(to_first, like_first, "a long, b long"))
            found.append(stored(ties.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "ties"))
            groups = _followed(groups, found[-1])
            if some_large and level != LEVELS[-1]:
                now = stored(_labelled(in_large.select("path", "doc_id"), groups), "large")
                apart = now.groupBy("path").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("path")
                apart = stored(apart, "apart")
                hot.append(stored(spread_join(now, apart, ["path"], ["doc_id"]).select("doc_id").distinct(), "hot"))
                dropped(in_large, now)
            dropped(nodes, size)
        if not hot:
            break
        more = hot[0] if len(hot) == 1 else hot[0].unionByName(hot[1]).distinct()
        rows = stored(rows.join(more, "doc_id", "left_semi"), "hot")
        if not rows.limit(1).count():
            break
        level = LEVELS[LEVELS.index(level) + 1]
        rows = stored(next_turns(rows, docs, k, level, trees_for(similarity, level, recall)), "hot")
    return connected_components(reduce(DataFrame.unionByName, found))


def _labelled(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """rows with their component: that of groups (v, component), or their own id."""
    if groups is None:
        return rows.withColumn("component", F.col("doc_id"))
    return rows.join(groups.withColumnRenamed("v", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def _followed(groups: DataFrame | None, ties: DataFrame) -> DataFrame:
    """groups (v, component) after ties (a, b), a < b, of components: each goes to the least it is tied to, and to the least of that."""
    up = ties.groupBy(F.col("b").alias("component")).agg(F.min("a").alias("to"))
    on = up.select(F.col("component").alias("to"), F.col("to").alias("next"))
    up = stored(up.join(on, "to", "left").select("component", F.coalesce("next", "to").alias("to")), "ups")
    new = up.select(F.col("component").alias("v"), F.col("to").alias("component"))
    if groups is None:
        return new
    moved = groups.join(up, "component", "left").select("v", F.coalesce("to", "component").alias("component"))
    return stored(moved.unionByName(new.join(groups, "v", "left_anti")), "groups")


def _verified(t: pa.Table, similarity: tuple[int, int]):
    """Links (a, b) among documents whose full sets have the similarity num / den; pairs that are tied already, by label or
    by links found here, are passed over. If some rows roam (visit from elsewhere), only pairs of a row that does and one that doesn't."""
    num, den = similarity
    t = t.sort_by("doc_id")
    ids, roams = t.column("doc_id").to_numpy(), t.column("roams").to_numpy(zero_copy_only=False)
    label = np.unique(t.column("label").to_numpy(), return_inverse=True)[1]
    sets = [np.frombuffer(x, U) for x in t.column("shingles").to_pylist()]
    n, a, b, across = np.array([len(x) for x in sets]), [], [], bool(roams.any())

    def confirm(x: int, ys: np.ndarray) -> None:
        for y in ys[(label[ys] != label[x]) & ((roams[ys] != roams[x]) if across else True)]:
            if label[y] != label[x] and ids[x] != ids[y]:
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if den * common >= num * (n[x] + n[y] - common):
                    label[label == label[y]] = label[x]
                    a.append(ids[x]), b.append(ids[y])

    if len(ids) <= 12:
        for x in range(len(ids)):
            ys = np.arange(x + 1, len(ids))
            confirm(x, ys[den * np.minimum(n[x], n[ys]) >= num * np.maximum(n[x], n[ys])])
    else:
        sk = sketches(np.concatenate(sets), np.append(0, np.cumsum(n)))
        for i, j in _alike(sk, n, num / den, least_places(num / den)):
            for x, ys in zip(*_runs(i, j)):
                confirm(x, ys)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}) if a else None


def _runs(i: np.ndarray, j: np.ndarray) -> tuple[list, list]:
    """Pairs in order of i as (i, all its j)."""
    if not len(i):
        return [], []
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
    return i[first].tolist(), np.split(j, first[1:])


def _confirmed(rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """a, b: links within the groups of rows (pair, doc_id, label, roams, shingles), each group of bounded size."""
    return by_group(rows.select("pair", "doc_id", "label", "roams", "shingles"), "pair", lambda t: _verified(t, similarity), "a long, b long")


def links(docs: DataFrame, groups: DataFrame, k: int, similarity: tuple[int, int]) -> DataFrame:
    """a, b: confirmed links, enough of them to tie all documents of each group (v, component) that links tie.

    Groups are cut into blocks, each compared in itself. Of a group of several blocks, the first documents of the blocks' largest
    parts are compared, then each document outside the group's largest part (as known by then) visits every block, in
    blocks of such documents, and is compared with those there that have another label. So what a large group of like
    documents costs grows with its size; only documents that few others are like are compared with all of their group.
    """
    groups = groups.withColumnRenamed("v", "doc_id")
    texts = looked_up(docs, groups, ["doc_id"])

    def run(b: pa.RecordBatch) -> dict:
        out, size = [None] * b.num_rows, np.zeros(b.num_rows, np.int64)
        for lo, hi, g, first in shingle_sets(*text_bytes(b.column("text")), k):
            for d in range(hi - lo):
                out[lo + d] = g[first[d] : first[d + 1]].tobytes()
            size[lo:hi] = np.diff(first)
        return {"doc_id": b.column("doc_id"), "component": b.column("component"), "n": pa.array(size), "shingles": out}

    sets = stored(arrow_map(texts, run, "doc_id long, component long, n long, shingles binary").dropDuplicates(["doc_id"]), "sets")
    blocks = sets.groupBy("component").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_DOCS), F.lit(1)).cast("int").alias("blocks"))
    rows = looked_up(sets, stored(blocks, "blocks"), ["component"]).withColumn("side", F.expr("cast(pmod(xxhash64(doc_id), blocks) as int)"))
    inside = rows.withColumns({"pair": F.xxhash64("component", "side"), "label": F.col("doc_id"), "roams": F.lit(False)})
    found = stored(_confirmed(inside, similarity), "links")
    rows = rows.where("blocks > 1")
    if not rows.limit(1).count():
        return found
    rows = stored(rows, "sets")
    known = lambda ties: rows.drop("label").join(connected_components(ties).select(F.col("v").alias("doc_id"), F.col("component").alias("label")), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    part = known(found).groupBy("component", "blocks", "side", "label").agg(F.count("*").alias("size"))
    heads = part.groupBy("component", "blocks", "side").agg(F.max_by("label", "size").alias("doc_id")).drop("side").distinct()
    at = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("blocks") / BLOCK_HEADS))
    heads = heads.select("doc_id", F.xxhash64("component", at).alias("pair"), F.col("doc_id").alias("label"), F.lit(False).alias("roams")).dropDuplicates(["doc_id"]).join(rows.select("doc_id", "shingles"), "doc_id")
    found = stored(found.unionByName(_confirmed(heads, similarity)), "links")
    labelled = stored(known(found), "sets")
    part = labelled.groupBy("component", "label").agg(F.count("*").alias("size"))
    main = part.groupBy("component").agg(F.max_by("label", F.struct("size", "label")).alias("main"), (F.sum("size") - F.max("size")).alias("others"))
    main = stored(main.where("others > 0"), "parts")
    labelled = looked_up(labelled, main, ["component"])
    visits = F.greatest(F.ceil(F.col("others") / BLOCK_DOCS), F.lit(1)).cast("int")  # blocks of visitors
    pair = F.xxhash64("component", "at", "visit")
    stay = labelled.withColumns({"at": F.col("side"), "roams": F.lit(False), "visit": F.explode(F.sequence(F.lit(0), visits - 1))})
    roam = labelled.where("label <> main").withColumns({"visit": F.pmod(F.xxhash64("doc_id", "side"), visits).cast("int"), "roams": F.lit(True), "at": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    pick = ["doc_id", "label", "roams", "shingles"]
    return found.unionByName(_confirmed(stay.select(pair.alias("pair"), *pick).unionByName(roam.select(pair.alias("pair"), *pick)), similarity))


def near_duplicates(docs: DataFrame, k: int = 5, similarity: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of docs.

    Documents are linked if den * |intersection| >= num * |union| for similarity (num, den) of their sets of k-word
    shingles (A-Z in lower case; fewer words: the whole sequence as one); component_id is the smallest id reachable,
    kept is doc_id = component_id. Null and empty texts and texts without words have no shingles and are linked with nothing.
    A row without an id is linked with nothing, has no component_id and is kept; rows of one id are taken as equal and
    give a row each; other columns are left out; an empty table gives none.
    """
    docs = keep(docs, doc_id=id_col, text=text_col)
    share = similarity[0] / similarity[1]
    whole = stored(sketch_table(docs, k, LEVELS[0], trees_for(share, LEVELS[0], recall)), "sketches")
    linkable = F.expr("n_shingles > 0 and doc_id is not null")
    some = whole.where(linkable)
    classes = stored(some.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    reps = some.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "n_shingles", "sketch", "turns")
    reps = stored(reps, "reps")
    groups = candidates(reps, docs, k, share, recall)
    # stored first, so that no task has two Python workers at a time
    parts = connected_components(stored(links(docs, groups, k, similarity), "links"))
    of_class = classes.join(parts.select(F.col("v").alias("rep"), "component"), "rep", "left").select("k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    # copies of one text may be a third of all rows: they are spread; rows that link with nothing take no part in the join
    linked = spread_join(some.select("doc_id", "n_shingles", "k1", "k2"), stored(of_class, "components"), ["k1", "k2", "n_shingles"], ["doc_id"])
    alone = whole.where(~linkable).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = linked.select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, k: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of docs (doc_id, text and others), all columns, of one document of each group that near_duplicates() finds: the
    smallest id, and one row of it if the table repeats it. Documents without words, and rows without an id, all stay."""
    found = near_duplicates(docs, k, similarity)
    rows = stored(found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_and("kept").alias("kept")).where("rows > 1 or not kept"), "gone")
    # rows of repeated ids are taken out with those that go, and one of each is put back
    some = lambda test: rows.where(test).select("doc_id")
    out = looked_up(docs, rows.select("doc_id"), ["doc_id"], "left_anti").select(*docs.columns)
    if not some("kept").limit(1).count():
        return out
    back = looked_up(docs, stored(some("kept"), "repeated"), ["doc_id"], "left_semi").dropDuplicates(["doc_id"])
    return out.unionByName(back.select(*docs.columns))
