"""Staged lines as they arrive: each micro-batch passes the gate; accepted and rejected lines go to two folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmere.functions.columns import trimmed
from quillmere.functions.rowschema import RowSchema
from quillmere.operators.gate import accepts, with_errors


def gated_stream(spark: SparkSession, folder: str, schema: RowSchema) -> DataFrame:
    """file, record, errors, accepted of the lines of new files. A line that isn't JSON is rejected, as a stream mustn't stop."""
    lines = spark.readStream.format("text").load(folder).select(F.col("_metadata.file_path").alias("file"), trimmed(F.col("value")).alias("record")).where("record <> ''")
    return with_errors(lines, schema, strict_json=False).withColumn("accepted", accepts(F.col("errors")))


def watch(spark: SparkSession, folder: str, schema: RowSchema, bronze: str, quarantine: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """A running query. A batch that is run again after a failure overwrites what it had written before."""

    def write(batch: DataFrame, number: int) -> None:
        batch.where("accepted").select(F.col("record").alias("value")).write.mode("overwrite").text(f"{bronze}/batch={number}")
        batch.where("not accepted").select("file", "record", "errors").write.mode("overwrite").json(f"{quarantine}/batch={number}")

    w = gated_stream(spark, folder, schema).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")).start()
