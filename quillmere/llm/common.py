"""Shared plumbing: Arrow maps over (id, text), joins that hot keys don't clog, bounded samples."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmere.sources.shared import dropped, shared_root, stored

__all__ = ["arrow_filter", "arrow_map", "bounded_sample", "crc_of_id", "dropped", "fresh", "keep", "looked_up", "shared_root", "spread_join", "stored", "table", "text_bytes", "text_list"]

#: Rows of a batch that a function sees at most; keeps a worker's memory at a few MB of ordinary texts.
BATCH_ROWS = 1000
_RECORDS, _DEFAULT_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
#: Rows of a few numbers that are broadcast at most, after counting them; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000
#: So many times fewer where the other side would otherwise only be shuffled by key.
KEYED_SHARE = 10
#: Tasks that the rows of one key are spread over at most.
BUCKETS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, opened by Spark's own reader (any store that Spark can reach)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns under internal names, so that extra or clashing columns do no harm."""
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in cols.items()])


def fresh(df: DataFrame, name: str) -> str:
    """A column name like this one that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_list(arr) -> list[str]:
    """Texts of an Arrow column; null counts as empty."""
    return [t or "" for t in arr.to_pylist()]


def text_bytes(arr) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of an Arrow column, end to end, and their offsets; null counts as empty."""
    arr = pc.fill_null(arr, "")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = arr.buffers()
    off = np.frombuffer(offs, kind, len(arr) + 1, arr.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, BATCH_ROWS):
            yield b.slice(at, BATCH_ROWS)


def small_batches(spark: SparkSession) -> None:
    """Batches of BATCH_ROWS rows between Spark and Python, unless the session has a size of its own: whole batches of texts are held on
    both sides, and the setting is read when a plan is run, so it can't be put back before that."""
    if spark.conf.get(_RECORDS) == _DEFAULT_RECORDS:
        spark.conf.set(_RECORDS, str(BATCH_ROWS))


def _released() -> None:
    """Gives memory that a task has freed back to the system; workers live on, idle, beside the next tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """mapInArrow with fn(batch of at most BATCH_ROWS rows) -> columns. fn is pure, so a lost task can be run again."""
    arrow = arrow_schema(schema)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            out = fn(b)
            if out is not None:
                yield pa.RecordBatch.from_arrays([out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
        _released()

    return df.mapInArrow(run, schema)


def arrow_filter(df: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of df, all columns, where fn(batch) is true: no join, so it doesn't matter what ids there are."""

    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            yield b.filter(pa.array(fn(b), pa.bool_()))
        _released()

    return df.mapInArrow(run, df.schema)


def _few(table: DataFrame, bound: int) -> bool:
    return table.limit(bound + 1).count() <= bound


def spread_join(rows: DataFrame, keyed: DataFrame, on: list[str], by: list[str], how: str = "inner", wide: bool = False) -> DataFrame:
    """rows joined with keyed (one row for each key; stored, so that it can be counted) on the columns `on`, without one task for a
    key that many rows have.

    If keyed is found to have few narrow rows it is broadcast, and rows stay where they are. Beyond, or if it is wide, rows of a key are
    dealt into BUCKETS by a hash of the columns `by`; keyed is brought to the (key, bucket) pairs that
    occur, which are found by a distinct that is reduced before its shuffle; then both meet by pair.
    """
    if not wide and _few(keyed, BROADCAST_ROWS // KEYED_SHARE):
        return rows.join(F.broadcast(keyed), on, how)
    bucket = fresh(rows, "bucket")
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64(*by), F.lit(BUCKETS)).cast("int"))
    pairs = rows.select(*on, bucket).distinct().join(keyed, on)
    return rows.join(pairs, [*on, bucket], how).drop(bucket)


def looked_up(rows: DataFrame, few: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """rows joined with a stored table few: where it is found to have at most BROADCAST_ROWS rows it is broadcast and rows (texts) stay
    where they are; beyond, rows are shuffled."""
    return rows.join(F.broadcast(few) if _few(few, BROADCAST_ROWS) else few, on, how)


def crc_of_id(col="doc_id"):
    """crc32 of an id written as text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def bounded_sample(rows: DataFrame, id_col: str, bound: int, within: str | None = None) -> DataFrame:
    """At most bound rows (of each value of the column `within`, which must not be null): those whose ids hash lowest, the same however
    the table is cut.

    Rows are counted, not ids, so the bound holds for a table that repeats an id. Of the ids, only the share that
    holds some 8 times the bound goes on from where they lie; these are ranked, each partition passing on no more than the bound.
    """
    if within is None:
        return rows.orderBy(F.xxhash64(id_col), *[F.col(f"`{c}`") for c in rows.columns]).limit(bound)
    hash_, share, rank = (fresh(rows, c) for c in ("hash", "share", "rank"))
    ids = F.greatest(F.approx_count_distinct(id_col), F.lit(1))
    shares = stored(rows.groupBy(within).agg((F.lit(8.0 * bound) / ids).alias(share)), "shares")
    at = (F.col(hash_).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    near = looked_up(rows, shares, [within]).withColumn(hash_, F.xxhash64(id_col)).where(at <= F.col(share))
    w = Window.partitionBy(within).orderBy(hash_, *[F.col(f"`{c}`") for c in rows.columns])
    return near.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= bound).select(*rows.columns)
