"""Connected components of an edge table, distributed: every vertex takes the smallest label it can reach."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmere.llm.common import dropped, spread_join, stored


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a < b, of the same components: each part of the table gives only ties of its vertices to the smallest they reach there."""

    def run(batches):
        up: dict[int, int] = {}

        def root(v: int) -> int:
            while (u := up.setdefault(v, v)) != v:
                up[v] = v = up[u]
            return v

        for t in batches:
            for a, b in zip(t.column("a").to_pylist(), t.column("b").to_pylist()):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        tied = [(root(v), v) for v in list(up)]
        tied = [(a, b) for a, b in tied if a != b]
        yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in tied], pa.int64()), "b": pa.array([b for _, b in tied], pa.int64())})

    return edges.mapInArrow(run, "a long, b long")


def connected_components(edges: DataFrame) -> DataFrame:
    """v, component (smallest vertex reachable) for every vertex of edges (a, b); nothing is collected.

    Each part of the table is contracted alone, dealt anew by the larger vertex, and contracted again: what links the vertices
    stays, and the many ties of a large group become one for each vertex and part. Then, each round, a vertex takes the
    least label among its own and its neighbours', and then that label's own label, so labels travel twice as far each
    round; vertices with many neighbours, and those of one label, are spread over many tasks. Rounds end when no label
    changes. Each is written to the shared folder.
    """
    once = _contracted(edges.select("a", "b").where("a <> b"))
    ties = stored(_contracted(once.repartition("b")).distinct(), "edges")
    both = ties.unionByName(ties.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("component")), "labels")
    while True:
        theirs = spread_join(both, label.select(F.col("v").alias("b"), "component"), ["b"], ["a"]).select(F.col("a").alias("v"), "component", F.lit(None).cast("long").alias("was"))
        own = label.select("v", "component", F.col("component").alias("was"))
        now = stored(theirs.unionByName(own).groupBy("v").agg(F.min("component").alias("now"), F.max("was").alias("was")), "labels")
        if not now.where("now < was").limit(1).count():
            dropped(ties, now)
            return label
        jump = label.select(F.col("v").alias("now"), F.col("component").alias("jump"))
        nxt = stored(spread_join(now, jump, ["now"], ["v"]).select("v", F.least("now", "jump").alias("component")), "labels")
        dropped(label, now)
        label = nxt
