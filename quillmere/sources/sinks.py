"""Outputs through Hadoop's file systems: text in order, as a folder of part files or one named file, and JSON documents.

Everything is written aside and then takes the place of what was there, so a run that fails leaves the old output as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from quillmere.sources.shared import hadoop_path


def _aside(path: str) -> str:
    folder, _, name = str(path).rstrip("/").rpartition("/")
    return f"{folder or '.'}/_{name}-{uuid.uuid4().hex}"


def _put(fs, new, path) -> None:
    """new in the place of path; what was there goes last."""
    old = new.suffix("-old")
    if fs.exists(path):
        fs.rename(path, old)
    if not fs.rename(new, path):
        fs.rename(old, path)
        raise OSError(f"can't write {path}")
    fs.delete(old, True)


def write_lines(rows: DataFrame, path, *order: str, single_file: bool = False) -> None:
    """The column value of rows, by the order columns. Sorting is by ranges, so no task holds all rows; part files are in order by
    name. A single file is put together from the parts, streamed through the driver: for small outputs that something else reads."""
    spark = rows.sparkSession
    if order:
        rows = rows.orderBy(*order)
    fs, target = hadoop_path(spark, str(path))
    fs, parts = hadoop_path(spark, _aside(path))
    rows.select("value").write.text(parts.toString())
    if not single_file:
        _put(fs, parts, target)
        return
    fs, one = hadoop_path(spark, _aside(path))
    out = fs.create(one)
    copy = spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    for name in sorted(f.getPath().toString() for f in fs.listStatus(parts) if f.getPath().getName().startswith("part-")):
        part = fs.open(spark._jvm.org.apache.hadoop.fs.Path(name))
        copy(part, out, 1 << 20, False)
        part.close()
    out.close()
    _put(fs, one, target)
    fs.delete(parts, True)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(f"{one.getParent()}/.{one.getName()}.crc")
    fs.delete(hidden, False)


def exists(spark: SparkSession, path) -> bool:
    fs, p = hadoop_path(spark, str(path))
    return fs.exists(p)


def folder(spark: SparkSession, path):
    """path as a folder that is there."""
    fs, p = hadoop_path(spark, str(path))
    fs.mkdirs(p)
    return path


def read_json(spark: SparkSession, path) -> dict:
    fs, p = hadoop_path(spark, str(path))
    f = fs.open(p)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8")
    f.close()
    return json.loads(text)


def write_json(spark: SparkSession, path, value: dict) -> dict:
    """A document, indented, in the place of what was there."""
    fs, p = hadoop_path(spark, str(path))
    _, new = hadoop_path(spark, _aside(path))
    out = fs.create(new)
    out.write(bytearray(json.dumps(value, indent=2, ensure_ascii=False).encode()))
    out.close()
    _put(fs, new, p)
    return value
