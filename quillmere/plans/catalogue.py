"""Each operator as a query over the driver's tables, with its DuckDB equivalent.

The tables hold no faults, so rows are derived from them and faults are put in by the key's remainder, alike in Spark and SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quillmere.functions import columns as C
from quillmere.functions.rowschema import RowSchema, load
from quillmere.operators import fragments as fr
from quillmere.operators import gate as gt
from quillmere.operators import graph
from quillmere.operators.maps import Mapped
from quillmere.plans import stages
from quillmere.plans.config import map_file
from quillmere.sources.lines import numbered_lines
from quillmere.sources.rows import Contributions, Members, child_struct, renamed
from quillmere.sources.shared import stored_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

RUN = "2025-01-01T000000Z"


def in_utc(f):
    """f with the session's zone at UTC while its plan is made; the caller's zone is put back."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            return f(spark, sf_dir)
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    return run


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = in_utc(f)
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return QUERIES[f.__name__]

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def members_schema() -> RowSchema:
    return load("commons_members.yaml", "CommonsMembersRow")


#: DuckDB's white space class for trimming as Python's strip does.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_strip = lambda x: f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


# -- projections and scalar functions ---------------------------------------------------------------------------------


@query("SELECT c_custkey AS person_id, c_name AS person_official_first_name, c_mktsegment AS caucus_short_name FROM customer")
def field_map_rename(spark, sf):
    headers = {"c_custkey": "person_id", "c_name": "person_official_first_name", "c_mktsegment": "caucus_short_name"}
    return renamed(_t(spark, sf, "customer"), headers)


@query("""SELECT unnest(['person_id', 'person_short_honorific', 'person_official_first_name', 'person_official_last_name', 'constituency_name',
'constituency_province_territory_name', 'caucus_short_name', 'from_date_time', 'to_date_time']) AS slot, unnest(range(9)) AS pos""")
def normalized_slots(spark, sf):
    names = F.array(*[F.lit(n) for n in members_schema().names])
    return spark.range(1).select(F.posexplode(names).alias("pos", "slot")).select("slot", F.col("pos").cast("long").alias("pos"))


_XML = """CASE c_custkey % 6 WHEN 0 THEN concat('<P><Name> ', c_name, ' </Name></P>') WHEN 1 THEN concat('<P><Name>', c_name, '</Name><Name>second</Name></P>')
WHEN 2 THEN concat('<P xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"><Name xsi:nil="true">', c_name, '</Name></P>') WHEN 3 THEN '<P><Name>   </Name></P>'
WHEN 4 THEN '<P><Other>x</Other></P>' ELSE concat('<P xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"><Name xsi:nil="1">', c_name, '</Name></P>') END"""


@query("SELECT c_custkey, CASE WHEN c_custkey % 6 IN (0, 1, 5) THEN c_name END AS name FROM customer")
def xml_child_text(spark, sf):
    x = _t(spark, sf, "customer").select("c_custkey", F.expr(_XML).alias("xml"))
    return x.select("c_custkey", F.from_xml("xml", child_struct(["Name"]), {"ignoreNamespace": "true"}).alias("r")).select("c_custkey", C.first_child(F.col("r.Name")).alias("name"))


@query("SELECT n_nationkey, regexp_replace(concat('{http://x/', n_nationkey, '}', n_name), '^.*\\}', '') AS tag FROM nation")
def strip_namespace(spark, sf):
    return _t(spark, sf, "nation").select("n_nationkey", C.local_name(F.concat(F.lit("{http://x/"), F.col("n_nationkey").cast("string"), F.lit("}"), F.col("n_name"))).alias("tag"))


_PAD = "CASE WHEN c_custkey % 5 = 0 THEN concat(chr(9), chr(32), chr(160)) ELSE concat(chr(160), chr(32), c_name, chr(28), chr(8195)) END"


@query(f"SELECT c_custkey, nullif({_strip(_PAD)}, '') AS name FROM customer")
def normalize_strings(spark, sf):
    nbsp, em = " ", " "
    padded = F.when(F.col("c_custkey") % 5 == 0, F.lit("\t " + nbsp)).otherwise(F.concat(F.lit(nbsp + " "), "c_name", F.lit("\x1c" + em)))
    return _t(spark, sf, "customer").select("c_custkey", C.trim_or_null(padded).alias("name"))


@query("SELECT o_orderkey, trim(concat(' ', o_orderkey, ' ')) AS id FROM orders")
def normalize_id(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", C.id_text(F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" "))).alias("id"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS present, CAST(NULL AS VARCHAR) AS absent FROM nation")
def null_padding(spark, sf):
    text = F.when(F.col("n_nationkey") % 2 == 0, F.to_json(F.struct(F.col("n_name").alias("present")))).otherwise("{}")
    struct = StructType([StructField("present", StringType()), StructField("absent", StringType())])
    return _t(spark, sf, "nation").select("n_nationkey", F.from_json(text, struct).alias("r")).select("n_nationkey", "r.*")


@query("""SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 1 THEN ts - INTERVAL 2 HOUR ELSE ts END AS at FROM events""")
def parse_iso_datetime(spark, sf):
    naive = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    k = F.col("event_id") % 4
    text = F.when(k == 0, naive).when(k == 1, F.concat(naive, F.lit("+02:00"))).when(k == 2, F.concat(F.lit(" "), naive, F.lit("Z"))).otherwise("  ")
    return _t(spark, sf, "events").select("event_id", C.iso_timestamp(text).alias("at"))


@query("""SELECT event_id, CASE WHEN microsecond(t) % 1000000 = 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(t, '%Y-%m-%dT%H:%M:%S.%fZ') END AS at
FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) ELSE ts END AS t FROM events)""")
def render_iso_utc(spark, sf):
    t = F.when(F.col("event_id") % 3 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    return _t(spark, sf, "events").select("event_id", C.iso_text(t).alias("at"))


@query("SELECT DISTINCT concat('gckg:Person:Commons:', c_custkey) AS id FROM customer")
def mint_person_ids(spark, sf):
    return _t(spark, sf, "customer").select(C.person_uri(F.col("c_custkey").cast("string")).alias("id"))


@query("""SELECT o_orderkey, concat('gckg:MemberOfParliament:', o_custkey, ':', CASE WHEN o_orderkey % 7 = 0 THEN 'None' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END) AS id FROM orders""")
def mint_role_ids(spark, sf):
    start = F.when(F.col("o_orderkey") % 7 != 0, C.iso_text(F.col("o_orderdate")))
    return _t(spark, sf, "orders").select("o_orderkey", C.role_uri(F.col("o_custkey").cast("string"), start).alias("id"))


@query("""SELECT c_custkey, concat(coalesce(f, 'None'), ' ', coalesce(l, 'None')) AS name, concat(coalesce(f, ''), ' ', coalesce(l, '')) AS name_blank
FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS f, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS l FROM customer)""")
def full_name_none(spark, sf):
    f, l = F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))  # noqa: E741
    return _t(spark, sf, "customer").select("c_custkey", C.full_name(f, l).alias("name"), C.full_name_blank(f, l).alias("name_blank"))


@query(f"SELECT o_orderkey, 'commons_members' AS source, '{RUN}' AS bronze_run_id, CAST(o_orderkey AS BIGINT) AS line_number FROM orders")
def bronze_reference(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", C.bronze_reference("commons_members", RUN, F.col("o_orderkey")).alias("r")).select("o_orderkey", "r.*")


@query("SELECT page_id, substr(sha256(url), 1, 16) AS key FROM pages")
def cache_key(spark, sf):
    return _t(spark, sf, "pages").select("page_id", C.cache_key(F.col("url")).alias("key"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS sha256, strlen(coalesce(text, '')) AS bytes FROM documents")
def fingerprint_sha256(spark, sf):
    text = F.coalesce("text", F.lit(""))
    return _t(spark, sf, "documents").select("doc_id", C.fingerprint(text).alias("sha256"), F.octet_length(text).cast("long").alias("bytes"))


@query("SELECT event_id, 1704067200 + 86400 * 20 - CASE WHEN event_id % 9 = 0 THEN 0 ELSE CAST(epoch(date_trunc('second', ts)) AS BIGINT) END < 21600 AS fresh FROM events")
def cache_fresh(spark, sf):
    at = F.when(F.col("event_id") % 9 != 0, F.unix_seconds(F.col("ts").cast("timestamp")))
    return _t(spark, sf, "events").select("event_id", C.is_fresh(at, F.lit(1704067200 + 86400 * 20), 21600).alias("fresh"))


# -- lines, the gate and its summaries --------------------------------------------------------------------------------


@query("""SELECT line, concat('e', event_id) AS record FROM (SELECT row_number() OVER (ORDER BY event_id) AS line, event_id FROM events) WHERE event_id % 5 <> 0""")
def line_numbers_skip_blank(spark, sf):
    """Written as lines, some of them blank, and read again by the numbered scan."""
    text = F.when(F.col("event_id") % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit("e"), F.col("event_id").cast("string"), F.lit(" ")))
    path = stored_text(_t(spark, sf, "events").orderBy("event_id").select(text.alias("value")), "lines")
    return numbered_lines(spark, path)


# -- publisher files: written from the tables, read by the adapters -----------------------------------------------------



def _files(rows: DataFrame, key: str, head: str, tail: str | None, label: str, n: int = 8) -> str:
    """The column value of rows, by key, between two lines: n files, each with its own first and last line."""
    spark = rows.sparkSession
    lines = [(i, k, v) for i in range(n) for k, v in ((-1, head), (2**62, tail)) if v is not None]
    ends = spark.createDataFrame(lines, "part int, k long, value string")
    body = rows.select(F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("part"), F.col(key).cast("long").alias("k"), "value")
    return stored_text(ends.unionByName(body).repartition("part").sortWithinPartitions("part", "k").select("part", "value"), label, "part")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS person_id, CASE WHEN c_custkey % 3 = 1 THEN c_name END AS person_official_first_name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'A & ' || c_mktsegment END AS caucus_short_name,
'2025-04-28T00:00:00Z' AS from_date_time, CAST(NULL AS VARCHAR) AS to_date_time FROM customer""")
def xml_scan(spark, sf):
    """The members adapter over XML: blank, nil, repeated and missing children, a prefix, an entity, a child that isn't mapped."""
    k = F.col("c_custkey")
    first = F.when(k % 3 == 0, F.lit("<PersonOfficialFirstName>  </PersonOfficialFirstName>")).when(k % 3 == 1, F.concat(F.lit("<PersonOfficialFirstName> "), "c_name", F.lit("</PersonOfficialFirstName><PersonOfficialFirstName>x</PersonOfficialFirstName>")))
    first = F.coalesce(first, F.concat(F.lit('<PersonOfficialFirstName xsi:nil="true">'), "c_name", F.lit("</PersonOfficialFirstName>")))
    party = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<CaucusShortName>A &amp; "), "c_mktsegment", F.lit("</CaucusShortName>")))
    row = F.concat(F.lit("<MemberOfParliament><PersonId>"), k.cast("string"), F.lit("</PersonId>"), first, party, F.lit("<Other>1</Other><FromDateTime>2025-04-28T00:00:00</FromDateTime></MemberOfParliament>"))
    rows = _t(spark, sf, "customer").select("c_custkey", row.alias("value"))
    path = _files(rows, "c_custkey", '<All xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">', "</All>", "xml")
    rows = Members().normalize(Members().parse(spark, path))
    return rows.select("person_id", "person_official_first_name", "caucus_short_name", "from_date_time", "to_date_time")


_CSV_ID = "CASE o_orderkey % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 3 THEN 'null' ELSE CAST(o_orderkey AS VARCHAR) END"


@query(f"""SELECT trim(id) AS recipient_id, concat('Say "', o_orderpriority, '", twice') AS recipient_name, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS monetary_amount, CAST(NULL AS VARCHAR) AS form_id
FROM (SELECT *, {_CSV_ID} AS id FROM orders) WHERE id NOT IN ('NA', '', 'null')""")
def csv_scan(spark, sf):
    """The contributions adapter over CSV: quotes and commas within cells, cells that stand for missing values, a column that isn't mapped,
    headers that the file lacks, records without an id dropped."""
    id_ = _CSV_ID.replace("VARCHAR", "STRING")
    row = F.expr(f"""concat_ws(',', concat(' ', {id_}, ' '), concat('"Say ""', o_orderpriority, '"", twice"'), 'x', CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' ELSE o_orderstatus END)""")
    # cells of missing values are matched before they are trimmed, so those aren't padded
    bare = F.regexp_replace(row, "^ (NA|null|) ,", "$1,")
    rows = _t(spark, sf, "orders").select("o_orderkey", bare.alias("value"))
    path = _files(rows, "o_orderkey", "Recipient ID,Recipient,Extra,Monetary amount", None, "csv")
    adapter = Contributions()
    return adapter.normalize(adapter.parse(spark, path)).where(adapter.keep()).select("recipient_id", "recipient_name", "monetary_amount", "form_id")


#: A JSON record for each event, with a fault by remainder; the same text in both engines.
_RECORD = """CASE event_id % 9
WHEN 1 THEN '{"from_date_time": "2025-04-28T00:00:00Z"}'
WHEN 2 THEN '{"person_id": null, "to_date_time": null}'
WHEN 3 THEN concat('{"person_id": "', user_id, '", "from_date_time": "not-a-date"}')
WHEN 4 THEN concat('{"person_id": "', user_id, '", "zz": 1, "aa": "x"}')
WHEN 5 THEN concat('{"person_id": ', user_id, ', "caucus_short_name": true}')
WHEN 6 THEN concat('{"person_id": "', user_id, '", "from_date_time": null, "caucus_short_name": null}')
WHEN 7 THEN '{"person_id": null, "from_date_time": "2025-02-30T00:00:00Z"}'
WHEN 8 THEN concat('{"person_id": "', user_id, '", "from_date_time": "2025-04-28T00:00:00"}')
ELSE concat('{"person_id": "', user_id, '", "caucus_short_name": "', event_type, '", "from_date_time": "2025-04-28t00:00:00.5+02:00"}') END"""

_SLOTS = "'person_id', 'person_short_honorific', 'person_official_first_name', 'person_official_last_name', 'constituency_name', 'constituency_province_territory_name', 'caucus_short_name', 'from_date_time', 'to_date_time'"
_GATE = f"""WITH j AS (SELECT event_id AS line, {_RECORD} AS record FROM events),
s AS (SELECT unnest([{_SLOTS}]) AS slot, unnest(range(9)) AS i),
v AS (SELECT line, slot, i, json_type(record, '$.' || slot) AS kind, list_contains(json_keys(record), slot) AS has, json_extract_string(record, '$.' || slot) AS x FROM j, s),
e AS (SELECT line, slot, CASE
   WHEN has AND (kind NOT IN ('VARCHAR', 'NULL') OR slot = 'person_id' AND kind <> 'VARCHAR') THEN slot || ' has a wrong type'
   WHEN has AND slot IN ('from_date_time', 'to_date_time') AND kind = 'VARCHAR' AND NOT (regexp_matches(x, '^\\d{{4}}-\\d{{2}}-\\d{{2}}[Tt]\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d+)?([Zz]|[+-]\\d{{2}}:\\d{{2}})$') AND try_cast(upper(x) AS TIMESTAMPTZ) IS NOT NULL) THEN slot || ' is no date-time'
   WHEN slot = 'person_id' AND NOT has THEN slot || ' is required' END AS message FROM v),
u AS (SELECT line, unnest(list_filter(json_keys(record), lambda k: NOT list_contains([{_SLOTS}], k))) AS slot FROM j),
errors AS (SELECT line, slot, message FROM e WHERE message IS NOT NULL UNION ALL SELECT line, slot, 'unknown key' FROM u),
g AS (SELECT line, record, line NOT IN (SELECT line FROM errors) AS accepted FROM j)
"""


def _gated(spark, sf, fail_fast: bool = False) -> DataFrame:
    rows = _t(spark, sf, "events").select(F.col("event_id").alias("line"), F.expr(_RECORD).alias("record"))
    return gt.gate(rows, members_schema(), fail_fast)


def _errors(spark, sf) -> DataFrame:
    return _gated(spark, sf).select("line", F.explode("errors").alias("e")).select("line", "e.slot", "e.message")


def _one_fault(name: str, end: str) -> None:
    def f(spark, sf):
        return _errors(spark, sf).where(F.col("message").endswith(end))

    f.__name__ = name
    query(_GATE + f"SELECT line, slot, message FROM errors WHERE message LIKE '%{end}'")(f)


_one_fault("gate_required_key", "is required")
_one_fault("gate_type", "has a wrong type")
_one_fault("gate_datetime", "is no date-time")
_one_fault("gate_closed_world", "unknown key")


@query(_GATE + "SELECT line FROM errors WHERE slot = 'person_id' AND line % 9 IN (2, 7)")
def gate_required_null(spark, sf):
    null = F.coalesce(F.expr("is_variant_null(try_variant_get(try_parse_json(record), '$.person_id', 'variant'))"), F.lit(False))
    return _gated(spark, sf).where(null & F.exists("errors", lambda e: e["slot"] == "person_id")).select("line")


@query(_GATE + "SELECT line, record FROM g WHERE accepted")
def validate_accepted(spark, sf):
    return _gated(spark, sf).where("accepted").select("line", "record")


@query(_GATE + "SELECT line, record, count(*) AS n_errors FROM g JOIN errors USING (line) GROUP BY line, record")
def validate_rejected(spark, sf):
    return _gated(spark, sf).where("not accepted").select("line", "record", F.size("errors").cast("long").alias("n_errors"))


@query(_GATE + "SELECT count(*) AS input_record_count, count(*) FILTER (accepted) AS accepted_count, count(*) FILTER (NOT accepted) AS rejected_count FROM g")
def validate_summary(spark, sf):
    return gt.summary(_gated(spark, sf))


@query(_GATE + "SELECT slot AS key, count(*) AS n FROM errors GROUP BY slot")
def drift_error_counts(spark, sf):
    return gt.error_counts(_gated(spark, sf))


@query(_GATE + "SELECT line, accepted FROM g WHERE line <= (SELECT min(line) FROM g WHERE NOT accepted)")
def fail_fast_prefix(spark, sf):
    return _gated(spark, sf, True).select("line", "accepted")


# -- fragments --------------------------------------------------------------------------------------------------------

_ROWS = """SELECT o_orderkey AS line, CAST(o_custkey AS VARCHAR) AS person_id, CASE WHEN o_orderkey % 5 <> 0 THEN c_name END AS first, c_mktsegment AS last,
CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS start FROM orders JOIN customer ON o_custkey = c_custkey"""
_FRAGMENTS = f"""WITH r AS ({_ROWS}), x AS (SELECT line, concat('gckg:Person:Commons:', person_id) AS person, concat('gckg:MemberOfParliament:', person_id, ':', coalesce(start, 'None')) AS role,
concat(coalesce(first, 'None'), ' ', coalesce(last, 'None')) AS name FROM r), f AS (
SELECT line, 0 AS pos, 'MemberOfParliament' AS kind, role AS id, NULL AS name, NULL AS subject, NULL AS rel_type, NULL AS object FROM x
UNION ALL SELECT line, 1, 'Person', person, name, NULL, NULL, NULL FROM x UNION ALL SELECT line, 2, 'RELATIONSHIP', NULL, NULL, person, 'HAS_ROLE', role FROM x)
"""


def _member_rows(spark, sf) -> DataFrame:
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        F.col("o_orderkey").alias("line"), F.col("o_custkey").cast("string").alias("person_id"), F.when(F.col("o_orderkey") % 5 != 0, F.col("c_name")).alias("person_official_first_name"),
        F.col("c_mktsegment").alias("person_official_last_name"), F.when(F.col("o_orderkey") % 7 != 0, C.iso_text(F.col("o_orderdate"))).alias("from_date_time"),
    )


def _fragments(spark, sf) -> DataFrame:
    x = fr.exploded(_member_rows(spark, sf), fr.Members("commons_members", RUN))
    return x.withColumnRenamed("@type", "kind")


@query(_FRAGMENTS + "SELECT * FROM f")
def materialize_fragments(spark, sf):
    return _fragments(spark, sf).select("line", "pos", "kind", "id", "name", "subject", "rel_type", "object")


@query(_FRAGMENTS + "SELECT line, kind, id, name FROM f WHERE id IS NOT NULL")
def fragments_nodes(spark, sf):
    return fr.nodes(_fragments(spark, sf)).select("line", "kind", "id", "name")


@query(_FRAGMENTS + "SELECT line, subject, rel_type, object FROM f WHERE subject IS NOT NULL")
def fragments_edges(spark, sf):
    return fr.edges(_fragments(spark, sf)).select("line", "subject", "rel_type", "object")


@query(_FRAGMENTS + f"""SELECT line, pos, CASE pos
WHEN 0 THEN concat('{{"@type":"', kind, '","bronze_reference":{{"source":"commons_members","bronze_run_id":"{RUN}","line_number":', line, '}},"id":"', id, '"}}')
WHEN 1 THEN concat('{{"@type":"', kind, '","bronze_reference":{{"source":"commons_members","bronze_run_id":"{RUN}","line_number":', line, '}},"id":"', id, '","name":"', name, '"}}')
ELSE concat('{{"@type":"', kind, '","bronze_reference":{{"source":"commons_members","bronze_run_id":"{RUN}","line_number":', line, '}},"subject":"', subject, '","rel_type":"HAS_ROLE","object":"', object, '"}}') END AS value FROM f""")
def fragments_json(spark, sf):
    return fr.as_json(fr.exploded(_member_rows(spark, sf), fr.Members("commons_members", RUN)))


_NEEDS_LAST = "line % 11 <> 0"


def _bronze(spark, sf) -> DataFrame:
    """Member rows as accepted records, some of which lack a needed key, read by the stage's own scan."""
    names = ["person_id", "person_official_first_name", "person_official_last_name", "from_date_time"]
    whole = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    rows = _member_rows(spark, sf).select("line", F.when(F.expr(_NEEDS_LAST), whole).otherwise(F.to_json(F.struct("person_id"))).alias("value"))
    path = stored_text(rows.orderBy("line").select("value"), "bronze")
    return stages.bronze_rows(spark, path, members_schema().names, fr.Members.needs, strict=False)


_LINES = f"SELECT row_number() OVER (ORDER BY line) AS n, * FROM ({_ROWS})"


@query(f"WITH r AS ({_ROWS}) SELECT count(*) AS record_count, count(*) FILTER ({_NEEDS_LAST}) AS accepted_count, count(*) FILTER (NOT {_NEEDS_LAST}) AS rejected_count, 3 * count(*) FILTER ({_NEEDS_LAST}) AS fragment_count FROM r")
def transform_summary(spark, sf):
    rows = _bronze(spark, sf)
    got = stages.summarised(rows, fr.exploded(rows.where("materializable"), fr.Members("commons_members", RUN)))
    return spark.createDataFrame([tuple(got.values())], ", ".join(f"{k} long" for k in got))


@query(f"""WITH r AS ({_LINES}) SELECT n AS line, concat('{{"person_id":"', person_id, '"}}') AS record FROM r WHERE NOT {_NEEDS_LAST}""")
def transform_quarantine(spark, sf):
    return _bronze(spark, sf).where("not materializable").select("line", "record")


_PASSED = """CASE WHEN c_custkey % 4 = 0 THEN '{"b": 1,  "a": null}' ELSE concat('{"person_id": "', c_custkey, '"}') END"""


@query(f"SELECT row_number() OVER (ORDER BY c_custkey) AS line, {_PASSED} AS record FROM customer")
def bronze_pass_through(spark, sf):
    """Records of a run without a map: as they are."""
    path = stored_text(_t(spark, sf, "customer").orderBy("c_custkey").select(F.expr(_PASSED).alias("value")), "bronze")
    return stages.bronze_rows(spark, path, members_schema().names, (), strict=True).where("materializable").select("line", "record")


@query(f"""WITH r AS ({_ROWS}), x AS (SELECT line, concat('gckg:Person:Commons:', person_id) AS person, concat('gckg:MemberOfParliament:', person_id, ':', coalesce(start, 'None')) AS role,
concat(coalesce(first, ''), ' ', coalesce(last, '')) AS name, start FROM r)
SELECT line, 0 AS pos, 'MemberOfParliament' AS kind, role AS id, NULL AS name, start AS start_date, NULL AS subject, NULL AS predicate, NULL AS object FROM x
UNION ALL SELECT line, 1, 'Person', person, name, NULL, NULL, NULL, NULL FROM x UNION ALL SELECT line, 2, 'PersonHasRoleMemberOfParliament', NULL, NULL, NULL, person, 'hasRole', role FROM x""")
def declarative_map(spark, sf):
    schema = members_schema()
    rows = _member_rows(spark, sf)
    rows = rows.select("*", *[F.lit(None).cast("string").alias(n) for n in schema.names if n not in rows.columns])
    made = Mapped("commons_members", RUN, map_file("commons_members"), schema.name, schema.names)
    return fr.exploded(rows, made).select("line", "pos", F.col("`@type`").alias("kind"), "id", "name", "start_date", "subject", "predicate", "object")


# -- contributions ----------------------------------------------------------------------------------------------------

_CELL = "CASE o_orderkey % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN concat(' ', o_orderpriority, ' ') WHEN 3 THEN 'null' WHEN 4 THEN '   ' ELSE o_orderpriority END"
_CLEAN = "nullif(trim(CASE WHEN cell NOT IN ('NA', '', 'null') THEN cell END), '')"


def _cells(spark, sf) -> DataFrame:
    return _t(spark, sf, "orders").select("o_orderkey", F.expr(_CELL).alias("cell"))


@query(f"SELECT o_orderkey, {_CLEAN} AS value FROM (SELECT o_orderkey, {_CELL} AS cell FROM orders)")
def contrib_missing_to_null(spark, sf):
    return _cells(spark, sf).select("o_orderkey", C.trim_or_null(C.missing_to_null(F.col("cell"))).alias("value"))


@query(f"SELECT {_CLEAN} AS recipient_id, o_orderstatus AS recipient_name FROM (SELECT *, {_CELL} AS cell FROM orders) WHERE {_CLEAN} <> ''")
def contrib_filter(spark, sf):
    adapter = Contributions()
    raw = _t(spark, sf, "orders").select(F.expr(_CELL).alias("Recipient ID"), F.col("o_orderstatus").alias("Recipient"))
    return adapter.normalize(renamed(raw, adapter.schema.headers)).where(adapter.keep()).select("recipient_id", "recipient_name")


@query("""WITH x AS (SELECT o_orderkey AS line, concat('gckg:contribution/""" + RUN + """/', o_orderkey) AS event, concat('gckg:Recipient:', o_custkey) AS recipient, concat('gckg:contributor/', replace(lower(o_clerk), '#', '-')) AS giver,
concat('gckg:party/commons/', lower(o_orderstatus)) AS party, CASE WHEN o_orderkey % 3 <> 0 THEN concat('gckg:district/commons/', trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '-', 'g'), '-')) END AS place FROM (SELECT *, concat('Clerk#', o_custkey % 50) AS o_clerk FROM orders))
SELECT line, 'AgentMadeContribution' AS kind, giver AS subject, 'made' AS predicate, event AS object FROM x UNION ALL SELECT line, 'ContributionReceivedByPerson', event, 'receivedBy', recipient FROM x
UNION ALL SELECT line, 'PersonAssociatedWithPoliticalParty', recipient, 'associatedWith', party FROM x UNION ALL SELECT line, 'ContributionInFederalElectoralDistrict', event, 'inDistrict', place FROM x WHERE place IS NOT NULL""")
def contribution_edges(spark, sf):
    adapter = Contributions()
    raw = _t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("line"), F.col("o_custkey").cast("string").alias("Recipient ID"), F.concat(F.lit("Clerk#"), (F.col("o_custkey") % 50).cast("string")).alias("Contributor name"),
        F.col("o_orderstatus").alias("Political Party of Recipient"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("Electoral District"),
    )
    rows = renamed(raw, {"line": "line", **adapter.schema.headers})
    return fr.edges(fr.exploded(rows, fr.Contributions("c", RUN))).select("line", F.col("`@type`").alias("kind"), "subject", "predicate", "object")


# -- extensions: planned by the reference, not executed there ------------------------------------------------------------


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS person_id FROM orders WHERE o_orderkey % 3 <> 0 AND o_custkey IS NOT NULL")
def current_only(spark, sf):
    rows = _t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("person_id"), F.when(F.col("o_orderkey") % 3 == 0, C.iso_text(F.col("o_orderdate"))).alias("to_date_time"))
    return stages.current(rows).select("o_orderkey", "person_id")


_slug = lambda x: f"nullif(regexp_replace(regexp_replace(translate(lower({x}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), '')"
_PLACE = "concat('É', n_name, '—', r_name, CASE WHEN n_nationkey % 4 = 0 THEN '  !' ELSE '' END)"


@query(f"SELECT n_nationkey, {_slug(_PLACE)} AS slug FROM nation JOIN region ON n_regionkey = r_regionkey")
def slugify(spark, sf):
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    place = F.concat(F.lit("É"), "n_name", F.lit("—"), "r_name", F.when(F.col("n_nationkey") % 4 == 0, "  !").otherwise(""))
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", C.slug(place).alias("slug"))


@query(f"""WITH x AS (SELECT {_slug("concat_ws(' ', n_name, r_name)")} AS place, {_slug('r_name')} AS party FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT 'FederalElectoralDistrict' AS kind, concat('gckg:district/commons/', place) AS id FROM x UNION ALL SELECT 'HouseOfCommonsSeat', concat('gckg:seat/hoc/', place) FROM x
UNION ALL SELECT 'PoliticalParty', concat('gckg:party/commons/', party) FROM x""")
def district_party_nodes(spark, sf):
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    null = F.lit(None).cast("string")
    rows = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("line"), F.col("n_nationkey").cast("string").alias("person_id"), null.alias("person_official_first_name"), null.alias("person_official_last_name"),
        F.col("n_name").alias("constituency_name"), F.col("r_name").alias("constituency_province_territory_name"), F.col("r_name").alias("caucus_short_name"), null.alias("from_date_time"), null.alias("to_date_time"),
    )
    x = fr.exploded(rows, fr.Members("commons_members", RUN, extended=True))
    return x.where(F.col("`@type`").isin("FederalElectoralDistrict", "HouseOfCommonsSeat", "PoliticalParty")).select(F.col("`@type`").alias("kind"), "id")


_PEOPLE = """SELECT concat('gckg:Person:Commons:', c_custkey) AS id, concat('k', c_custkey % 700) AS name FROM customer
UNION ALL SELECT concat('gckg:Organization:', s_suppkey), concat('k', s_suppkey % 700) FROM supplier"""


def _people(spark, sf) -> DataFrame:
    c = _t(spark, sf, "customer").select(F.concat(F.lit("gckg:Person:Commons:"), F.col("c_custkey").cast("string")).alias("id"), F.concat(F.lit("k"), (F.col("c_custkey") % 700).cast("string")).alias("name"), F.lit("Person").alias("@type"))
    s = _t(spark, sf, "supplier").select(F.concat(F.lit("gckg:Organization:"), F.col("s_suppkey").cast("string")).alias("id"), F.concat(F.lit("k"), (F.col("s_suppkey") % 700).cast("string")).alias("name"), F.lit("Organization").alias("@type"))
    return graph.merge(c, s)


@query(f"SELECT id, name, 2 AS mentions FROM ({_PEOPLE})")
def integrate_union_dedupe(spark, sf):
    p = _people(spark, sf)
    return graph.dedupe_nodes(graph.merge(p, p)).select("id", "name", F.col("mentions").cast("int").alias("mentions"))


#: Persons of two sources, some of them namesakes, and the parties they are tied to: two for some.
_KEYED = """SELECT concat('a:', c_custkey) AS id, 'a' AS source, concat('k', c_custkey % 5000) AS name, concat('party', c_nationkey) AS near FROM customer
UNION ALL SELECT concat('a:', c_custkey), 'a', concat('k', c_custkey % 5000), concat('party', c_nationkey + 1) FROM customer WHERE c_custkey % 7 = 0
UNION ALL SELECT concat('b:', s_suppkey), 'b', concat('K', s_suppkey % 700), concat('party', s_suppkey % 25) FROM supplier"""


@query(f"""WITH k AS (SELECT DISTINCT id, source, lower(name) || '|' || near AS key FROM ({_KEYED})), ids AS (SELECT DISTINCT id, source FROM k),
g AS (SELECT key, min(id) AS least FROM k GROUP BY key HAVING count(DISTINCT id) > 1 AND count(DISTINCT id) = count(DISTINCT source)),
o AS (SELECT id, min(least) AS least FROM k JOIN g USING (key) GROUP BY id HAVING count(DISTINCT least) = 1), b AS (SELECT id, least FROM o UNION SELECT least, least FROM o),
w AS (SELECT least FROM b JOIN ids USING (id) GROUP BY least HAVING count(DISTINCT id) > 1 AND count(DISTINCT id) = count(DISTINCT source)), c AS (SELECT id, min(least) AS c FROM b JOIN w USING (least) GROUP BY id)
SELECT id, coalesce(c, id) AS canonical_id FROM ids LEFT JOIN c USING (id)""")
def resolve_entities(spark, sf):
    c, s = _t(spark, sf, "customer"), _t(spark, sf, "supplier")
    a = lambda more: c.select(F.expr("concat('a:', c_custkey)").alias("id"), F.lit("a").alias("source"), F.expr("concat('k', c_custkey % 5000)").alias("name"), F.expr(f"concat('party', c_nationkey + {more})").alias("near"), "c_custkey")
    b = s.select(F.expr("concat('b:', s_suppkey)").alias("id"), F.lit("b").alias("source"), F.expr("concat('K', s_suppkey % 700)").alias("name"), F.expr("concat('party', s_suppkey % 25)").alias("near"))
    people = graph.merge(a(0).drop("c_custkey"), a(1).where("c_custkey % 7 = 0").drop("c_custkey"), b)
    nodes = people.select("id", "source", "name", F.lit("Person").alias("@type")).distinct()
    return graph.resolve(graph.person_keys(nodes, people.select(F.col("id").alias("subject"), F.col("near").alias("object"))))


_EDGES = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'PersonHasRoleMemberOfParliament' WHEN o_orderkey % 4 = 1 THEN 'Other' ELSE 'PersonHasRoleMemberOfParliament' END AS kind,
CASE WHEN o_orderkey % 5 = 0 THEN 'HAS_ROLE' ELSE 'hasRole' END AS predicate, concat('p', CASE WHEN o_orderkey % 6 = 0 THEN -1 ELSE o_custkey END) AS subject,
concat('m', CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE o_orderkey END) AS object FROM orders"""


def _graph(spark, sf) -> tuple[DataFrame, DataFrame]:
    edges = _t(spark, sf, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 4 = 1 THEN 'Other' ELSE 'PersonHasRoleMemberOfParliament' END").alias("@type"), F.expr("CASE WHEN o_orderkey % 5 = 0 THEN 'HAS_ROLE' ELSE 'hasRole' END").alias("predicate"), F.expr("concat('p', CASE WHEN o_orderkey % 6 = 0 THEN -1 ELSE o_custkey END)").alias("subject"), F.expr("concat('m', CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE o_orderkey END)").alias("object"))
    people = _t(spark, sf, "customer").select(F.expr("concat('p', c_custkey)").alias("id"), F.lit("Person").alias("@type"))
    roles = _t(spark, sf, "orders").select(F.expr("concat('m', o_orderkey)").alias("id"), F.lit("MemberOfParliament").alias("@type"))
    return graph.merge(people, roles), edges


@query(f"WITH e AS ({_EDGES}) SELECT o_orderkey FROM e WHERE o_orderkey % 6 = 0 OR o_orderkey % 7 = 0")
def gold_dangling_edges(spark, sf):
    nodes, edges = _graph(spark, sf)
    return graph.dangling(edges, nodes).select("o_orderkey")


_FAULT = """CASE WHEN kind = 'Other' THEN 'unknown triple' WHEN predicate <> 'hasRole' THEN 'wrong predicate' WHEN o_orderkey % 6 = 0 THEN 'dangling subject' WHEN o_orderkey % 7 = 0 THEN 'dangling object' END"""


@query(f"WITH e AS ({_EDGES}) SELECT o_orderkey, {_FAULT} AS fault FROM e WHERE {_FAULT} = 'wrong predicate'")
def gold_equals_string(spark, sf):
    nodes, edges = _graph(spark, sf)
    return graph.edge_faults(edges, nodes).where("fault = 'wrong predicate'").select("o_orderkey", "fault")


@query(f"WITH e AS ({_EDGES}) SELECT o_orderkey, {_FAULT} AS fault FROM e")
def gold_accept(spark, sf):
    nodes, edges = _graph(spark, sf)
    return graph.edge_faults(edges, nodes).select("o_orderkey", "fault")


@query("""SELECT id, CASE WHEN NOT regexp_matches(id, '^[A-Za-z_][A-Za-z0-9_.+-]*:\\S+$') THEN 'id is no uri' WHEN kind NOT IN ('Person') THEN 'unknown class' END AS fault
FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE concat('x:', c_custkey) END AS id, CASE WHEN c_custkey % 5 = 0 THEN 'Entity' ELSE 'Person' END AS kind FROM customer)""")
def gold_nodes(spark, sf):
    n = _t(spark, sf, "customer").select(F.expr("CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE concat('x:', c_custkey) END").alias("id"), F.expr("CASE WHEN c_custkey % 5 = 0 THEN 'Entity' ELSE 'Person' END").alias("@type"))
    return graph.node_faults(n).select("id", "fault")


@in_utc
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Records that pass the gate, as fragments."""
    schema = members_schema()
    rows = _member_rows(spark, sf)
    given = [n for n in schema.names if n in rows.columns]
    record: Column = F.to_json(F.struct(*given), {"ignoreNullFields": "false"})
    good = gt.gate(rows.select("line", record.alias("record")), schema).where("accepted")
    parsed = good.select("line", F.from_json("record", schema.struct).alias("r")).select("line", "r.*")
    return fr.as_json(fr.exploded(parsed, fr.Members("commons_members", RUN)))


QUERIES["flagship"] = flagship
ORACLE_SQL["flagship"] = ORACLE_SQL["fragments_json"]
