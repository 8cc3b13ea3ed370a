"""Tables cut from their lineage in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of this process's own, by application, where the session names none (single-machine sessions only).
_own: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where that is unset, a folder of our own if all of Spark is one local process;
    on a cluster that is an error, since no local folder would be seen by all."""
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = tempfile.mkdtemp(prefix="quillmere-")
        atexit.register(shutil.rmtree, _own[sc.applicationId], ignore_errors=True)
    return _own[sc.applicationId]


def hadoop_path(spark: SparkSession, path: str):
    """(the file system that holds a path, the path) of Hadoop's API."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts lineage and survives lost executors.

    The files go when the application ends, or before that by dropped()."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/quillmere/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._quillmere_path = path
    return out


def stored_text(lines: DataFrame, label: str, *by: str) -> str:
    """The address of a folder of text files with the column value of lines, in folders by the columns `by`; it goes when the application ends."""
    path = f"{shared_root(lines.sparkSession)}/quillmere/{label}-{uuid.uuid4().hex}"
    lines.write.partitionBy(*by).text(path)
    fs, p = hadoop_path(lines.sparkSession, path)
    fs.deleteOnExit(p)
    return path


def dropped(*tables: DataFrame) -> None:
    """Deletes what stored() wrote, once nothing reads it any more."""
    for df in tables:
        fs, p = hadoop_path(df.sparkSession, df._quillmere_path)
        fs.delete(p, True)
