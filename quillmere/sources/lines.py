"""JSON lines with their physical line numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmere.functions.columns import trimmed

#: Block offsets are sent to every executor while there are at most so many blocks (some 64 bytes each).
MAX_BLOCKS = 200_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line (from 1, over files in path order), record: lines that aren't blank; blank ones count.

    A row's place in its block is its running id less the block's first; only one row for each block is summed in order.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    blocks = raw.groupBy("f", "b").agg(F.count("*").alias("n"), F.min("i").alias("first"))
    w = Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("f", "b", (F.coalesce(F.sum("n").over(w), F.lit(0)) - F.col("first") + 1).alias("shift"))
    if raw.rdd.getNumPartitions() <= MAX_BLOCKS // 64:
        offsets = F.broadcast(offsets)
    record = trimmed(F.col("value"))
    return raw.join(offsets, ["f", "b"]).select((F.col("i") + F.col("shift")).cast("long").alias("line"), record.alias("record")).where("record <> ''")
