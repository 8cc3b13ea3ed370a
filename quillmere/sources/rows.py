"""Publisher files as rows of slots: XML and CSV adapters and their registry."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from quillmere.functions import columns as C
from quillmere.functions.rowschema import RowSchema, load
from quillmere.plans.errors import UnknownSourceError

_registry: dict[str, type[Adapter]] = {}


class Adapter(ABC):
    """A source: parse() gives raw text in slots, normalize() the staged columns, keep() a condition on staged rows."""

    source = ""

    @property
    @abstractmethod
    def schema(self) -> RowSchema: ...

    @abstractmethod
    def parse(self, spark: SparkSession, path: str) -> DataFrame: ...

    def normalize(self, rows: DataFrame) -> DataFrame:
        return rows

    def keep(self) -> Column | None:
        return None


def register(cls: type[Adapter]) -> type[Adapter]:
    """Class decorator; the last registration of a source wins."""
    if not cls.source:
        raise ValueError("an adapter needs a source")
    _registry[cls.source] = cls
    return cls


def get_adapter(source: str) -> Adapter:
    if source not in _registry:
        raise UnknownSourceError(f"unknown source {source!r}; there are {', '.join(list_sources())}")
    return _registry[source]()


def list_sources() -> list[str]:
    return sorted(_registry)


def child_struct(headers) -> StructType:
    """Each header as all its occurrences, with text and nil mark."""
    one = StructType([StructField("_VALUE", StringType()), StructField("_nil", StringType())])
    return StructType([StructField(h, ArrayType(one)) for h in headers])


def xml_rows(spark: SparkSession, path: str, row_tag: str, headers: dict[str, str]) -> DataFrame:
    """One row for each element row_tag, whatever its prefix; the text of the first child of each header. Only mapped children are read."""
    # a marker that no document has: an element without any mapped child still is a row
    schema = StructType([*child_struct(headers).fields, StructField("_corrupt_record", StringType())])
    raw = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).option("mode", "FAILFAST").schema(schema).load(path)
    return raw.select(*[C.first_child(F.col(f"`{h}`")).alias(s) for h, s in headers.items()])


def renamed(raw: DataFrame, headers: dict[str, str]) -> DataFrame:
    """The columns that headers name, as slots; a header that raw lacks gives nulls; other columns are dropped."""
    return raw.select(*[(F.col(f"`{h}`") if h in raw.columns else F.lit(None).cast("string")).alias(s) for h, s in headers.items()])


def csv_rows(spark: SparkSession, path: str, headers: dict[str, str]) -> DataFrame:
    """All cells as text. A file is read in as many tasks as it has blocks, unless a record goes over several lines: that is so only if
    some line has an odd number of quotes, which one pass over the lines tells."""
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    several = bool(spark.read.text(path).where(odd).limit(1).count())
    raw = spark.read.option("header", True).option("multiLine", several).option("escape", '"').csv(path)
    return renamed(raw, headers)


def typed(rows: DataFrame, schema: RowSchema) -> DataFrame:
    """Slots in schema order: ids and texts trimmed (blank is null), date-times as UTC text; a bad date-time fails the job."""
    of = lambda s: C.iso_text(C.iso_timestamp(F.col(s.name))) if s.range == "datetime" else C.trim_or_null(F.col(s.name))
    return rows.select(*[of(s).alias(s.name) for s in schema.slots])


@register
class Members(Adapter):
    source = "commons_members"

    @property
    def schema(self) -> RowSchema:
        return load("commons_members.yaml", "CommonsMembersRow")

    def parse(self, spark: SparkSession, path: str) -> DataFrame:
        return xml_rows(spark, path, "MemberOfParliament", self.schema.headers)

    def normalize(self, rows: DataFrame) -> DataFrame:
        return typed(rows, self.schema)


@register
class Contributions(Adapter):
    """Cells that stand for missing values become null before the ids are trimmed; ids stay text, never 1.0."""

    source = "open_canada_federal_election_contribution"
    ids = ("recipient_id", "form_id", "part_number_of_return")

    @property
    def schema(self) -> RowSchema:
        return load("contributions.yaml", "ContributionRow")

    def parse(self, spark: SparkSession, path: str) -> DataFrame:
        return csv_rows(spark, path, self.schema.headers)

    def normalize(self, rows: DataFrame) -> DataFrame:
        cell = lambda n: C.missing_to_null(F.col(n))
        return rows.select(*[(C.id_text(cell(n)) if n in self.ids else C.trim_or_null(cell(n))).alias(n) for n in self.schema.names])

    def keep(self) -> Column:
        return F.col("recipient_id").isNotNull() & (F.col("recipient_id") != "")
