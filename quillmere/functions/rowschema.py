"""Row schemas from YAML: slots with a range, whether required, and the publisher's header."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import yaml
from pyspark.sql.types import StringType, StructField, StructType

HEADER = "gckg:publisher_header"
HOME = Path(__file__).resolve().parent.parent / "schemas"


@dataclass(frozen=True)
class Slot:
    name: str
    range: str = "string"
    required: bool = False
    header: str | None = None


@dataclass(frozen=True)
class RowSchema:
    name: str
    slots: tuple[Slot, ...]

    @property
    def names(self) -> list[str]:
        return [s.name for s in self.slots]

    @property
    def headers(self) -> dict[str, str]:
        """Publisher header -> slot, of the slots that have one."""
        return {s.header: s.name for s in self.slots if s.header}

    @property
    def struct(self) -> StructType:
        return StructType([StructField(s.name, StringType()) for s in self.slots])


@lru_cache(maxsize=32)
def load(path: str | Path, target_class: str) -> RowSchema:
    """The class of a schema file, slots in file order. Relative paths start in this package's schemas."""
    p = Path(path)
    spec = yaml.safe_load((p if p.is_absolute() or p.exists() else HOME / p).read_text(encoding="utf-8"))
    attributes = spec["classes"][target_class].get("attributes") or {}
    return RowSchema(target_class, tuple(Slot(n, (a or {}).get("range", "string"), bool((a or {}).get("required")), ((a or {}).get("annotations") or {}).get(HEADER)) for n, a in attributes.items()))
