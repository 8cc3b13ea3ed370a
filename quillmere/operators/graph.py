"""Merging, entity resolution and the domain gate (extensions: planned, not executed, in what this engine follows)."""

from __future__ import annotations

from functools import lru_cache

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmere.functions.rowschema import HOME

#: A CURIE or an absolute address.
URI = r"^[A-Za-z_][A-Za-z0-9_.+-]*:\S+$"


def merge(*parts: DataFrame) -> DataFrame:
    """Fragments of several sources in one table."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def dedupe_nodes(nodes: DataFrame) -> DataFrame:
    """id, @type, name, mentions, and source where nodes have one (the smallest): one row for each id, the name of the first by (name,
    type); reduced before the shuffle."""
    more = [F.min("source").alias("source")] if "source" in nodes.columns else []
    out = nodes.groupBy("id").agg(F.min(F.struct("name", "@type")).alias("m"), F.count("*").alias("mentions"), *more)
    return out.select("id", F.col("m.`@type`").alias("@type"), F.col("m.name").alias("name"), "mentions", *(["source"] if more else []))


def resolve(keyed: DataFrame) -> DataFrame:
    """id, canonical_id of every id of keyed (id, source, key; a node may have several keys, or none: null).

    Nodes of different sources that share a key are one, named by the smallest id. Never two of one source: a key that several ids
    of a source have says nothing, as do keys that would tie a node to several others, or a group in which a source comes twice.
    Keys and groups are only counted, so none that many rows have is gathered in one task.
    """
    ids = keyed.groupBy("id").agg(F.min("source").alias("source"))
    pairs = keyed.where("key is not null").select("id", "key").distinct().join(ids, "id")
    alone = (F.count("*") > 1) & (F.count("*") == F.count_distinct("source"))
    good = pairs.groupBy("key").agg(F.min("id").alias("least"), alone.alias("good")).where("good").select("key", "least")
    one = pairs.join(good, "key").groupBy("id").agg(F.min("least").alias("least"), F.max("least").alias("most")).where("least = most").select("id", "least")
    both = one.unionByName(one.select(F.col("least").alias("id"), "least")).distinct().join(ids, "id")
    apart = both.groupBy("least").agg(alone.alias("good")).where("good").select("least")
    named = both.join(apart, "least").groupBy("id").agg(F.min("least").alias("canonical"))
    return ids.join(named, "id", "left").select("id", F.coalesce("canonical", "id").alias("canonical_id"))


def person_keys(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, source, key of nodes (id, @type, name, source): persons by name and a node that they share an edge with, such as a party; a
    name alone is no key, nor is a name with a missing part. Others have no key: their ids are the same in every source."""
    near = edges.select(F.col("subject").alias("id"), F.col("object").alias("near")).unionByName(edges.select(F.col("object").alias("id"), F.col("subject").alias("near"))).distinct()
    named = (F.col("`@type`") == "Person") & ~F.coalesce(F.col("name").rlike(r"\bNone\b"), F.lit(True))
    key = F.when(named & F.col("near").isNotNull(), F.concat_ws("|", F.lower(F.trim("name")), "near"))
    return nodes.join(near, "id", "left").select("id", "source", key.alias("key"))


def rewrite(edges: DataFrame, canonical: DataFrame) -> DataFrame:
    """Edges between canonical ids, each once."""
    own = canonical.dropDuplicates(["id"])
    for end in ("subject", "object"):
        edges = edges.join(own.select(F.col("id").alias(end), F.col("canonical_id").alias("_c")), end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    return edges.dropDuplicates(["@type", "subject", "object"])


@lru_cache(maxsize=1)
def domain() -> dict:
    return yaml.safe_load((HOME / "domain.yaml").read_text(encoding="utf-8"))


def kinds_of(name: str) -> list[str]:
    """A class and all below it."""
    own = domain()["nodes"]
    up = lambda n: [n, *(up(own[n]["is_a"]) if "is_a" in own[n] else [])]
    return sorted(n for n in own if name in up(n))


def node_faults(nodes: DataFrame) -> DataFrame:
    """nodes with fault: null, or why the domain doesn't allow the node."""
    concrete = [n for n, c in domain()["nodes"].items() if not c.get("abstract") and n != "Node"]
    fault = F.when(F.col("id").isNull(), "id is required").when(~F.col("id").rlike(URI), "id is no uri").when(~F.coalesce(F.col("`@type`").isin(concrete), F.lit(False)), "unknown class")
    return nodes.withColumn("fault", fault)


def edge_faults(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """edges with fault: the predicate must be the triple's own and both ends nodes of the right classes."""
    ends = nodes.select("id", F.col("`@type`").alias("kind")).dropDuplicates(["id"])
    out = edges
    for end in ("subject", "object"):
        out = out.join(ends.select(F.col("id").alias(end), F.col("kind").alias(f"{end}_kind")), end, "left")
    fault = F.lit(None).cast("string")
    known = domain()["triples"]
    fault = F.when(~F.coalesce(F.col("`@type`").isin(list(known)), F.lit(False)), "unknown triple")
    for name, t in known.items():
        own = F.col("`@type`") == name
        fault = fault.when(own & ~F.coalesce(F.col("predicate") == t["predicate"], F.lit(False)), "wrong predicate")
        for end in ("subject", "object"):
            fault = fault.when(own & F.col(f"{end}_kind").isNull(), f"dangling {end}").when(own & ~F.col(f"{end}_kind").isin(kinds_of(t[end])), f"wrong {end}")
    return out.withColumn("fault", fault).drop("subject_kind", "object_kind")


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of which an end is no node."""
    ids = nodes.select("id").distinct()
    lost = lambda end: edges.join(ids.withColumnRenamed("id", end), end, "left_anti")
    return lost("subject").unionByName(edges.join(ids.withColumnRenamed("id", "subject"), "subject", "left_semi").join(ids.withColumnRenamed("id", "object"), "object", "left_anti"))
