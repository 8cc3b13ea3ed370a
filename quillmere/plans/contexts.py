"""Where a run reads and writes: {root}/{source}/{run}/..., on this machine or in any store that Spark reaches."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

POLICIES = ("default", "refresh", "cache-only", "local-file")


def run_stamp() -> str:
    """The time in UTC, without colons."""
    return datetime.now(UTC).strftime("%Y-%m-%dT%H%M%SZ")


class Place(str):
    """An address with a scheme, joined with / as paths are."""

    def __truediv__(self, name) -> Place:
        return Place(f"{self.rstrip('/')}/{name}")


def place(root) -> Path | Place:
    return Place(root) if "://" in str(root) else Path(root)


@dataclass(frozen=True)
class Run:
    """single_file: outputs are one named file each, put together from Spark's part files; otherwise folders of part files.
    config_path: another registry of sources than the package's own."""

    source: str
    run_id: str
    single_file: bool = False
    config_path: Path | None = None

    def under(self, root, run_id: str | None = None):
        return place(root) / self.source / (run_id or self.run_id)


@dataclass(frozen=True)
class IngestRun(Run):
    staging_root: Path = Path("staging")
    fetch_policy: str = "default"
    input_path: Path | None = None
    current_only: bool = False

    @property
    def folder(self):
        return self.under(self.staging_root)

    @property
    def raw(self):
        return self.folder / "raw"

    @property
    def cache(self):
        return place(self.staging_root) / self.source / "cache"

    @property
    def records(self):
        return self.folder / "records.jsonl"

    @property
    def manifest(self):
        return self.folder / "manifest.json"


@dataclass(frozen=True)
class ValidateRun(Run):
    staging_run_id: str = ""
    staging_root: Path = Path("staging")
    bronze_root: Path = Path("bronze")
    quarantine_root: Path = Path("quarantine")
    fail_fast: bool = False

    @property
    def staged(self):
        return self.under(self.staging_root, self.staging_run_id)

    @property
    def bronze(self):
        return self.under(self.bronze_root)

    @property
    def quarantine(self):
        return self.under(self.quarantine_root)


@dataclass(frozen=True)
class TransformRun(Run):
    """map_path: a declarative map instead of the source's materializer. untransformed: records go on as they are."""

    bronze_run_id: str = ""
    bronze_root: Path = Path("bronze")
    silver_root: Path = Path("silver")
    strict: bool = True
    extended: bool = False
    map_path: Path | None = None
    untransformed: bool = False

    @property
    def bronze(self):
        return self.under(self.bronze_root, self.bronze_run_id)

    @property
    def silver(self):
        return self.under(self.silver_root)
