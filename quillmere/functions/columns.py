"""Column expressions of the row-level functions; all stay within whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space at the ends of a text, Unicode's and the separators U+001C to U+001F.
ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
#: RFC 3339 date-times, with an offset.
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
#: What a data-frame reader takes for a missing cell.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def trimmed(c: Column) -> Column:
    """White space off both ends."""
    return F.regexp_replace(c, ENDS, "")


def trim_or_null(c: Column) -> Column:
    """White space off both ends; blank becomes null."""
    return F.nullif(trimmed(c), F.lit(""))


def id_text(c: Column) -> Column:
    """An id as trimmed text; blank stays blank."""
    return trimmed(c.cast("string"))


def local_name(c: Column) -> Column:
    """A tag without its {namespace}."""
    return F.regexp_replace(c, r"^.*\}", "")


def first_child(c: Column) -> Column:
    """Text of the first of repeated children (array<struct<_VALUE,_nil>>): null if nil, blank or absent."""
    one = F.get(c, F.lit(0))
    return F.when(one["_nil"] == "true", F.lit(None)).otherwise(trim_or_null(one["_VALUE"]))


#: ISO date-times: calendar or week date, compact or with hyphens; perhaps any one character, a time to hours, minutes, seconds or
#: fractions, compact or with colons; perhaps an offset.
_ISO = r"^(\d{4})-?(?:(\d{2})-?(\d{2})|W(\d{2})(?:-?([1-7]))?)(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?)?([Zz]|[+-]\d{2}(?::?\d{2})?)?$"


def iso_timestamp(c: Column) -> Column:
    """ISO text, extended, compact or by week, as a timestamp, UTC if it has no offset (the session's zone must be UTC); blank is null;
    other text fails."""
    text = trim_or_null(c)
    part = lambda i, none: F.coalesce(F.nullif(F.regexp_extract(text, _ISO, i), F.lit("")), F.lit(none))
    zone = F.regexp_replace(F.upper(part(10, "Z")), r"^([+-]\d{2}):?(\d{2})?$", "$1:$2")
    zone = F.when(zone.endswith(":"), F.concat(zone, F.lit("00"))).otherwise(zone)
    time = F.concat(part(6, "00"), F.lit(":"), part(7, "00"), F.lit(":"), part(8, "00"), F.lit("."), F.substring(part(9, "0"), 1, 6), zone)
    # the Monday of week 1 is that of the week with 4 January
    monday = F.date_trunc("week", F.to_date(F.concat(part(1, "1970"), F.lit("-01-04")))).cast("date")
    day = F.date_add(monday, (part(4, "1").cast("int") - 1) * 7 + part(5, "1").cast("int") - 1).cast("string")
    date = F.when(F.regexp_extract(text, _ISO, 4) != "", day).otherwise(F.concat(part(1, ""), F.lit("-"), part(2, ""), F.lit("-"), part(3, "")))
    return F.to_timestamp(F.when(text.rlike(_ISO), F.concat(date, F.lit("T"), time)).otherwise(text))


def iso_text(ts: Column) -> Column:
    """A timestamp as UTC text ending in Z; microseconds only where they aren't zero."""
    ts = ts.cast("timestamp")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def missing_to_null(c: Column) -> Column:
    """Null for a cell that stands for a missing value."""
    return F.when(c.isin(MISSING), F.lit(None)).otherwise(c)


def _or_none(c: Column) -> Column:
    return F.coalesce(c, F.lit("None"))


def person_uri(person_id: Column) -> Column:
    return F.concat(F.lit("gckg:Person:Commons:"), person_id)


def role_uri(person_id: Column, start: Column) -> Column:
    """A null start is written None."""
    return F.concat(F.lit("gckg:MemberOfParliament:"), person_id, F.lit(":"), _or_none(start))


def full_name(first: Column, last: Column) -> Column:
    """Null parts are written None."""
    return F.concat(_or_none(first), F.lit(" "), _or_none(last))


def full_name_blank(first: Column, last: Column) -> Column:
    """Null parts are left empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def bronze_reference(source: str, run_id: str, line: Column) -> Column:
    """Where a fragment comes from."""
    return F.struct(F.lit(source).alias("source"), F.lit(run_id).alias("bronze_run_id"), line.cast("long").alias("line_number"))


def cache_key(url: Column) -> Column:
    """First 16 hexadecimal digits of the address's SHA-256."""
    return F.substring(F.sha2(url.cast("binary"), 256), 1, 16)


def fingerprint(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def is_fresh(retrieved_at: Column, now: Column, ttl_seconds: int) -> Column:
    """Whether less than the time to live has passed; no time counts as 0."""
    return now - F.coalesce(retrieved_at, F.lit(0)) < ttl_seconds


def slug(c: Column) -> Column:
    """ASCII lower-case words joined by hyphens: accents off, everything else a break; null if nothing is left."""
    plain = F.translate(F.lower(c), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    return F.nullif(F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(""))
