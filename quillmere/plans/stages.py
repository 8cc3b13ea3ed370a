"""The stages: ingest, validate, transform, and the planned merge and publish. Each takes a run and returns its manifest."""

from __future__ import annotations

import logging
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quillmere.operators import fragments as fr
from quillmere.operators import gate as gt
from quillmere.operators import graph
from quillmere.operators.maps import Mapped
from quillmere.plans.config import map_file, row_schema, source_config
from quillmere.plans.contexts import IngestRun, Place, TransformRun, ValidateRun, place
from quillmere.plans.errors import BronzeInputError, EmptyBronzeError, EmptySourceError, FetchError, StagingInputError, ValidationFailedError
from quillmere.sources.fetch import fetch_raw
from quillmere.sources.lines import numbered_lines
from quillmere.sources.rows import get_adapter
from quillmere.sources.shared import stored
from quillmere.sources.sinks import exists, folder, read_json, write_json, write_lines

log = logging.getLogger(__name__)


def session() -> SparkSession:
    """A session with what the stages need: UTC, and objects with repeated keys read as the last of them."""
    spark = SparkSession.builder.appName("quillmere").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def _now() -> str:
    return datetime.now(UTC).isoformat()


def current(staged: DataFrame) -> DataFrame:
    """Extension: rows with an id and without an end."""
    return staged.where("person_id is not null and to_date_time is null")


def run_ingest(spark: SparkSession, run: IngestRun, get=None) -> dict:
    """Raw file to staged records. Zero records raise EmptySourceError before a manifest is written.

    With run.current_only (extension), rows without an id or with an end are left out and counted as rejected.
    """
    adapter, config = get_adapter(run.source), source_config(run.source, run.config_path)
    if isinstance(run.folder, Place):
        raise FetchError("raw files are fetched to this machine: give a local staging root")
    run.folder.mkdir(parents=True, exist_ok=True)
    started = _now()
    log.info("ingesting %s %s", run.source, run.run_id)
    raw, meta = fetch_raw(run, config, get) if get else fetch_raw(run, config)
    staged = stored(adapter.normalize(adapter.parse(spark, str(raw))).withColumn("_n", F.monotonically_increasing_id()), "staged")
    total = staged.count()
    log.info("%s: %d records read", run.source, total)
    if run.current_only:
        staged = current(staged)
    if (keep := adapter.keep()) is not None:
        staged = staged.where(keep)
    kept = staged.count()
    names = [s.name for s in adapter.schema.slots]
    write_lines(staged.select("_n", F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value")), run.records, "_n", single_file=run.single_file)
    if kept == 0:
        raise EmptySourceError(f"{run.source} gave no record")
    log.info("ingested %s %s: %d records", run.source, run.run_id, kept)
    return write_json(spark, run.manifest, {
        "run_id": run.run_id, "source": run.source, "started_at": started, "finished_at": _now(), "status": "success", "inputs": [meta],
        "output": {"records_path": "records.jsonl", "record_count": kept, "rejected_count": total - kept},
    })


def run_validate(spark: SparkSession, run: ValidateRun) -> dict:
    """Staged records to accepted and quarantined ones with a drift report.

    Without any accepted record EmptyBronzeError is raised before a file is written; in a fail-fast run with a rejected
    record the files are written, then ValidationFailedError is raised.
    """
    schema_file, schema = row_schema(run.source, run.config_path)
    manifest, records = run.staged / "manifest.json", run.staged / "records.jsonl"
    if not exists(spark, manifest):
        raise StagingInputError(f"no staging manifest {manifest}")
    staging_manifest = read_json(spark, manifest)
    folder(spark, run.bronze), folder(spark, run.quarantine)
    if not exists(spark, records):
        raise StagingInputError(f"no staged records {records}")
    started = _now()
    gated = stored(gt.gate(numbered_lines(spark, str(records)), schema, run.fail_fast), "gated")
    n = gt.summary(gated).first()
    log.info("%s: %d of %d records accepted", run.source, n.accepted_count, n.input_record_count)
    if n.accepted_count == 0:
        raise EmptyBronzeError(f"{run.source}: no record was accepted")
    bronze, report = run.bronze / "records.jsonl", run.quarantine / "drift_report.json"
    write_lines(gated.where("accepted").select("line", F.col("record").alias("value")), bronze, "line", single_file=run.single_file)
    write_lines(gt.reject_rows(gated).withColumnRenamed("reject", "value"), run.quarantine / "rejects.jsonl", "line", single_file=run.single_file)
    # as many rows as there are slots and unknown keys: the report is a single document
    counts = {r.key: r.n for r in gt.error_counts(gated).orderBy("key").toLocalIterator()}
    write_json(spark, report, {
        "run_id": run.run_id, "source": run.source, "staging_run_id": run.staging_run_id, "started_at": started, "finished_at": (finished := _now()),
        "schema_path": f"schemas/{schema_file}", "target_class": schema.name, "input_record_count": n.input_record_count, "accepted_count": n.accepted_count,
        "rejected_count": n.rejected_count, "error_counts": counts, "fail_fast": run.fail_fast,
    })
    out = write_json(spark, run.bronze / "manifest.json", {
        "run_id": run.run_id, "source": run.source, "stage": "validate", "tier": "bronze", "started_at": started, "finished_at": finished, "status": "success",
        "inputs": [{"staging_run_id": run.staging_run_id, "staging_manifest": staging_manifest}],
        "output": {"records_path": str(bronze), "record_count": n.accepted_count, "rejected_count": n.rejected_count, "drift_report_path": str(report)},
    })
    if run.fail_fast and n.rejected_count:
        raise ValidationFailedError(f"{run.source}: a record was rejected")
    log.info("validated %s %s: %d accepted, %d rejected", run.source, run.run_id, n.accepted_count, n.rejected_count)
    return out


def bronze_rows(spark: SparkSession, path, names: list[str], needs: tuple[str, ...], strict: bool) -> DataFrame:
    """line, record, materializable and the slots as text. In strict mode a record that lacks a needed key fails the job."""
    lines = numbered_lines(spark, str(path))
    has = F.coalesce(F.size(F.array_intersect(F.json_object_keys("record"), F.array(*[F.lit(n) for n in needs]))) == len(needs), F.lit(False))
    if strict:
        has = F.when(has, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("a needed key is missing in line "), F.col("line").cast("string"))).cast("boolean"))
    struct = StructType([StructField(n, StringType()) for n in names])
    return lines.withColumn("materializable", has).withColumn("r", F.from_json("record", struct)).select("line", "record", "materializable", "r.*")


def materializer_of(run: TransformRun):
    """(materializer, what the manifest calls its map, its name) of a run."""
    config = source_config(run.source, run.config_path)
    if run.map_path or "materializer" not in config:
        path = map_file(run.source, run.map_path, run.config_path)
        _, schema = row_schema(run.source, run.config_path)
        return Mapped(run.source, run.bronze_run_id, path, schema.name, schema.names), str(path), "quillmere.operators.maps.Mapped"
    made = fr.load_materializer(config["materializer"])(run.source, run.bronze_run_id, **({"extended": True} if run.extended else {}))
    return made, f"schemas/{config['schema']}", config["materializer"]


def summarised(rows: DataFrame, fragments: DataFrame | None) -> dict:
    """record_count, accepted_count, rejected_count of bronze rows, and fragment_count."""
    n = rows.agg(F.count("*").alias("records"), F.count_if("materializable").alias("accepted")).first()
    return {"fragment_count": fragments.count() if fragments is not None else 0, "record_count": n.records, "accepted_count": n.accepted, "rejected_count": n.records - n.accepted}


def run_transform(spark: SparkSession, run: TransformRun) -> dict:
    """Accepted records to fragments. Zero records are no failure; the Bronze manifest is only named.

    An untransformed run passes the records on as they are, and makes no fragment.
    """
    folder(spark, run.silver)
    config = source_config(run.source, run.config_path)
    _, schema = row_schema(run.source, run.config_path)
    made, named, maker = (None, None, None) if run.untransformed else materializer_of(run)
    records = run.bronze / "records.jsonl"
    if not exists(spark, records):
        raise BronzeInputError(f"no accepted records {records}")
    started = _now()
    rows = stored(bronze_rows(spark, records, schema.names, made.needs if made else (), run.strict), "bronze")
    quarantine = run.silver / "quarantine.jsonl"
    if made:
        target = run.silver / "fragments.jsonl"
        out = stored(fr.as_json(fr.exploded(rows.where("materializable"), made)), "fragments")
        write_lines(out, target, "line", "pos", single_file=run.single_file)
    else:
        target, out = run.silver / "records.jsonl", None
        write_lines(rows.select("line", F.col("record").alias("value")), target, "line", single_file=run.single_file)
    write_lines(rows.where("not materializable").select("line", F.col("record").alias("value")), quarantine, "line", single_file=run.single_file)
    counts = summarised(rows, out)
    log.info("transformed %s %s: %d records", run.source, run.run_id, counts["record_count"])
    return write_json(spark, run.silver / "manifest.json", {
        "run_id": run.run_id, "bronze_run_id": run.bronze_run_id, "source": run.source, "stage": "transform", "tier": "silver",
        "transform_map": named, "source_class": config["target_class"], "materializer": maker,
        "started_at": started, "finished_at": _now(), "status": "success",
        "inputs": [{"bronze_run_id": run.bronze_run_id, "bronze_manifest_path": str(run.bronze / "manifest.json")}],
        "output": {("fragments_path" if made else "records_path"): str(target), "quarantine_path": str(quarantine), **counts},
    })


FRAGMENT = StructType([StructField(f, StringType()) for f in fr.FIELDS if f != "bronze_reference"])


def read_fragments(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(FRAGMENT).json(list(paths))


def run_merge(spark: SparkSession, paths: list[str], out, single_file: bool = False) -> dict:
    """Extension: fragments of several runs into canonical nodes and edges. Persons are tied across sources only, and by more than the name."""
    out = folder(spark, place(out))
    all_ = spark.read.schema(StructType([*FRAGMENT, StructField("bronze_reference", StructType([StructField("source", StringType())]))])).json(list(paths))
    all_ = all_.withColumn("source", F.col("bronze_reference.source"))
    nodes, edges = graph.dedupe_nodes(fr.nodes(all_)), fr.edges(all_)
    canonical = stored(graph.resolve(graph.person_keys(nodes, edges)), "canonical")
    nodes = stored(nodes.join(canonical.where("id = canonical_id").select("id"), "id", "left_semi"), "nodes")
    edges = stored(graph.rewrite(edges, canonical), "edges")
    write_lines(nodes.select("id", F.to_json(F.struct("`@type`", "id", "name")).alias("value")), out / "nodes.jsonl", "id", single_file=single_file)
    write_lines(edges.select("subject", "object", F.to_json(F.struct("`@type`", "subject", "predicate", "rel_type", "object")).alias("value")), out / "edges.jsonl", "subject", "object", single_file=single_file)
    return write_json(spark, out / "manifest.json", {"stage": "integrate", "inputs": list(paths), "output": {"node_count": nodes.count(), "edge_count": edges.count()}})


def run_publish(spark: SparkSession, merged, out, single_file: bool = False) -> dict:
    """Extension: merged nodes and edges that the domain allows, the rest in quarantine, with counts of faults."""
    merged, out = place(merged), folder(spark, place(out))
    nodes, edges = (read_fragments(spark, str(merged / f"{n}.jsonl")) for n in ("nodes", "edges"))
    nodes = stored(graph.node_faults(nodes), "nodes")
    edges = stored(graph.edge_faults(edges, nodes.where("fault is null")), "edges")
    both = nodes.unionByName(edges, allowMissingColumns=True)
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in both.columns])).alias("value")
    write_lines(both.where("fault is null").select(value), out / "graph.jsonl", "value", single_file=single_file)
    write_lines(both.where("fault is not null").select(value), out / "quarantine.jsonl", "value", single_file=single_file)
    faults = {r.fault: r.n for r in both.where("fault is not null").groupBy("fault").agg(F.count("*").alias("n")).orderBy("fault").toLocalIterator()}
    return write_json(spark, out / "drift_report.json", {"stage": "publish", "accepted_count": both.where("fault is null").count(), "fault_counts": faults})
