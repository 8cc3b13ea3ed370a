"""The registry of sources: address, format, row schema, materializer, declarative map."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

import yaml

from quillmere.functions.rowschema import HOME, RowSchema, load


@lru_cache(maxsize=8)
def sources(path: str | Path | None = None) -> dict:
    return yaml.safe_load(Path(path or HOME / "sources.yaml").read_text(encoding="utf-8"))


def source_config(source: str, path: str | Path | None = None) -> dict:
    """KeyError for a source that isn't configured."""
    return sources(path)[source]


def _beside(name: str, path: str | Path | None) -> Path:
    """A file that a registry names: beside the registry, or else among the package's own."""
    own = Path(path).parent / name if path else HOME / name
    return own if own.exists() else HOME / name


def row_schema(source: str, path: str | Path | None = None) -> tuple[str, RowSchema]:
    """(schema file, schema). KeyError for an unknown source, FileNotFoundError for a missing file."""
    cfg = source_config(source, path)
    file = _beside(cfg["schema"], path)
    if not file.exists():
        raise FileNotFoundError(file)
    return cfg["schema"], load(file, cfg["target_class"])


def map_file(source: str, map_path: str | Path | None = None, path: str | Path | None = None) -> Path:
    """The declarative map of a source: the one given, or the registry's. KeyError if it has none."""
    file = Path(map_path) if map_path else _beside(source_config(source, path)["map"], path)
    if not file.exists():
        raise FileNotFoundError(file)
    return file


def uncovered(adapters: list[str]) -> list[str]:
    """Sources with an adapter but no row schema."""
    return sorted(set(adapters) - {s for s, c in sources().items() if "schema" in c})
