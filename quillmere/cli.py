"""python -m quillmere {ingest,validate,transforms} {run,list-sources}; also integrate and publish."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from quillmere.plans import stages
from quillmere.plans.config import sources, uncovered
from quillmere.plans.contexts import POLICIES, IngestRun, TransformRun, ValidateRun, place, run_stamp
from quillmere.sources.rows import list_sources


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillmere")
    stage = top.add_subparsers(dest="stage", required=True)

    def commands(name: str):
        p = stage.add_parser(name).add_subparsers(dest="command", required=True)
        run = p.add_parser("run")
        run.add_argument("--source", required=True)
        run.add_argument("--run-id", default=None)
        run.add_argument("--single-file", action="store_true", help="one file for each output instead of a folder of parts")
        run.add_argument("--config", type=Path, default=None, help="another registry of sources")
        if name != "transforms":
            p.add_parser("list-sources")
        if name == "ingest":
            p.add_parser("check", help="sources with an adapter but no row schema")
            p.add_parser("run-all").add_argument("--staging-root", type=Path, default=Path("staging"))
        return run

    run = commands("ingest")
    run.add_argument("--staging-root", type=Path, default=Path("staging"))
    run.add_argument("--fetch-policy", choices=POLICIES, default="default")
    run.add_argument("--input", type=Path, default=None)
    run.add_argument("--current-only", action="store_true")
    run = commands("validate")
    run.add_argument("--staging-run-id", required=True)
    for root in ("staging", "bronze", "quarantine"):
        run.add_argument(f"--{root}-root", type=place, default=Path(root))
    run.add_argument("--fail-fast", action="store_true")
    run = commands("transforms")
    run.add_argument("--bronze-run-id", required=True)
    for root in ("bronze", "silver"):
        run.add_argument(f"--{root}-root", type=place, default=Path(root))
    run.add_argument("--lenient", action="store_true", help="quarantine records that lack a needed key")
    run.add_argument("--experimental", action="store_true", help="also districts, seats, parties, dates and named triples")
    run.add_argument("--map", type=Path, default=None, help="a declarative map (with --experimental)")
    run.add_argument("--untransformed", action="store_true", help="pass records on as they are")
    run = stage.add_parser("integrate")
    run.add_argument("fragments", nargs="+")
    run.add_argument("--out", type=place, required=True)
    run = stage.add_parser("publish")
    run.add_argument("merged", type=place)
    run.add_argument("--out", type=place, required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    top = parser()
    a = top.parse_args(argv)
    if getattr(a, "map", None) and not a.experimental:
        top.error("--map needs --experimental")
    show = lambda x: print(json.dumps(x, indent=2))
    command = getattr(a, "command", "run")
    if command == "list-sources":
        print("\n".join(list_sources() if a.stage == "ingest" else sorted(sources())))
        return 0
    if command == "check":
        print("\n".join(uncovered(list_sources())))
        return int(bool(uncovered(list_sources())))
    spark = stages.session()
    if command == "run-all":
        for s in list_sources():
            if not sources()[s].get("local_only"):
                show(stages.run_ingest(spark, IngestRun(s, run_stamp(), staging_root=a.staging_root))["output"])
        return 0
    if a.stage == "integrate":
        show(stages.run_merge(spark, a.fragments, a.out)["output"])
        return 0
    if a.stage == "publish":
        show(stages.run_publish(spark, a.merged, a.out))
        return 0
    common = {"source": a.source, "run_id": a.run_id or run_stamp(), "single_file": a.single_file, "config_path": a.config}
    if a.stage == "ingest":
        out = stages.run_ingest(spark, IngestRun(**common, staging_root=a.staging_root, fetch_policy=a.fetch_policy, input_path=a.input, current_only=a.current_only))
    elif a.stage == "validate":
        out = stages.run_validate(spark, ValidateRun(**common, staging_run_id=a.staging_run_id, staging_root=a.staging_root, bronze_root=a.bronze_root, quarantine_root=a.quarantine_root, fail_fast=a.fail_fast))
    else:
        out = stages.run_transform(spark, TransformRun(**common, bronze_run_id=a.bronze_run_id, bronze_root=a.bronze_root, silver_root=a.silver_root, strict=not a.lenient, extended=a.experimental and not a.map, map_path=a.map, untransformed=a.untransformed))
    show(out["output"])
    return 0


def _stage(name: str) -> int:
    return main([name, *sys.argv[1:]])


def ingest() -> int:
    """The console script of this stage; so for the others."""
    return _stage("ingest")


def validate() -> int:
    return _stage("validate")


def transforms() -> int:
    return _stage("transforms")
