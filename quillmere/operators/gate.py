"""The schema gate: each JSON record against a closed-world row schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmere.functions.columns import RFC3339
from quillmere.functions.rowschema import RowSchema
from quillmere.sources.shared import stored

SEVERITIES = ("ERROR", "FATAL")


def _error(message: Column, slot: Column) -> Column:
    return F.struct(message.alias("message"), F.lit("ERROR").alias("severity"), slot.alias("slot"))


def date_time_ok(c: Column) -> Column:
    """RFC 3339 with an offset, and a date that exists."""
    return c.rlike(RFC3339) & F.try_to_timestamp(F.upper(c)).isNotNull()


def once(df: DataFrame, **values: Column) -> DataFrame:
    """df with columns that are computed once for each row. Through a generator of one row, since the optimiser would
    copy a plain projection into every expression and filter that uses it."""
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))))


def with_errors(records: DataFrame, schema: RowSchema, strict_json: bool = True) -> DataFrame:
    """records (with a JSON text `record`) and errors, array<struct<message,severity,slot>>: slots in schema order, then unknown keys in order.

    The session must read repeated keys as the last of them (spark.sql.variant.allowDuplicateKeys). Missing keys, nulls and wrong types are told apart. A record that isn't an object lacks every key. Text that isn't JSON
    fails the job (or, without strict_json, is an error of its own). Each record is parsed once.
    """
    v, names = F.col("_v"), F.array(*[F.lit(n) for n in schema.names])
    parsed = once(records, _v=F.try_parse_json("record"), _keys=F.json_object_keys("record"))
    value = [F.try_variant_get(v, f"$.{s.name}", "variant") for s in schema.slots]
    text = {s.name: F.try_variant_get(v, f"$.{s.name}", "string") for s in schema.slots if s.range == "datetime"}
    seen = once(parsed, _kinds=F.array(*[F.schema_of_variant(x) for x in value]), _texts=F.array(*text.values(), F.lit(None).cast("string")), _has=F.transform(names, lambda n: F.coalesce(F.array_contains("_keys", n), F.lit(False))))
    found = []
    for i, s in enumerate(schema.slots):
        has, kind = F.get("_has", F.lit(i)), F.coalesce(F.get("_kinds", F.lit(i)), F.lit("NONE"))
        fine = kind == "STRING" if s.required else kind.isin("STRING", "VOID")
        err = F.when(has & ~fine, _error(F.lit(f"{s.name} has a wrong type"), F.lit(s.name)))
        if s.name in text:
            err = err.when(has & (kind == "STRING") & ~date_time_ok(F.get("_texts", F.lit([*text].index(s.name)))), _error(F.lit(f"{s.name} is no date-time"), F.lit(s.name)))
        if s.required:
            err = err.when(~has, _error(F.lit(f"{s.name} is required"), F.lit(s.name)))
        found.append(err)
    unknown = F.array_sort(F.array_except(F.coalesce("_keys", F.array().cast("array<string>")), names))
    errors = F.concat(F.filter(F.array(*found), lambda e: e.isNotNull()), F.transform(unknown, lambda k: _error(F.lit("unknown key"), k)))
    bad = F.raise_error(F.concat(F.lit("not JSON: "), F.substring("record", 1, 80))).cast("array<struct<message:string,severity:string,slot:string>>") if strict_json else F.array(_error(F.lit("not JSON"), F.lit(None).cast("string")))
    return once(seen, errors=F.when(v.isNull(), bad).otherwise(errors)).drop("_v", "_keys", "_kinds", "_texts", "_has")


def accepts(errors: Column) -> Column:
    """Whether no error is of a severity that rejects a record; one without a severity does."""
    return F.size(F.filter(errors, lambda e: e["severity"].isNull() | e["severity"].isin(*SEVERITIES))) == 0


def gate(records: DataFrame, schema: RowSchema, fail_fast: bool = False, strict_json: bool = True) -> DataFrame:
    """records (line, record) with errors and accepted. With fail_fast, only lines up to the first rejected one, whose
    errors are cut to the first."""
    out = with_errors(records, schema, strict_json)
    out = out.withColumn("accepted", accepts(F.col("errors")))
    if not fail_fast:
        return out
    out = stored(out, "gated")  # read twice: for the first rejected line, and up to it
    first = out.where("not accepted").agg(F.min("line")).first()[0]  # one number
    return (out if first is None else out.where(F.col("line") <= first)).withColumn("errors", F.slice("errors", 1, 1))


def summary(gated: DataFrame) -> DataFrame:
    """One row: input_record_count, accepted_count, rejected_count."""
    return gated.agg(F.count("*").alias("input_record_count"), F.count_if("accepted").alias("accepted_count"), F.count_if(~F.col("accepted")).alias("rejected_count"))


def error_counts(gated: DataFrame) -> DataFrame:
    """key, n: errors by slot, or message where there is no slot, or `unknown`."""
    e = gated.select(F.explode("errors").alias("e"))
    return e.groupBy(F.coalesce(F.nullif("e.slot", F.lit("")), F.nullif("e.message", F.lit("")), F.lit("unknown")).alias("key")).agg(F.count("*").alias("n"))


def reject_rows(gated: DataFrame) -> DataFrame:
    """line, reject: rejected records as JSON with their line and errors; the record is its original text."""
    errors = F.to_json("errors", {"ignoreNullFields": "false"})
    return gated.where("not accepted").select("line", F.concat(F.lit('{"line": '), F.col("line").cast("string"), F.lit(', "record": '), "record", F.lit(', "errors": '), errors, F.lit("}")).alias("reject"))
