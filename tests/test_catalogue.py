"""Every query against its DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from compare import TABLES, plain
from quillmere.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_sql(spark, con, name):
    df, rel = catalogue.QUERIES[name](spark, SF), con.sql(catalogue.ORACLE_SQL[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    theirs = sorted((tuple(plain(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall()), key=repr)
    assert mine == theirs


def test_null_is_told_from_other_faults_on_any_line(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "_RECORD", """CASE event_id % 9 WHEN 2 THEN '{"person_id": 5}' WHEN 4 THEN '{"person_id": null}' WHEN 7 THEN '{"zz": null}' ELSE '{"person_id": "x"}' END""")
    lines = [r.event_id for r in spark.read.parquet(f"{SF}/events.parquet").select("event_id").collect()]
    assert sorted(r.line for r in catalogue.gate_required_null(spark, SF).collect()) == sorted(x for x in lines if x % 9 == 4)


def test_no_python_in_plans(spark):
    for name, f in catalogue.QUERIES.items():
        if name == "transform_summary":
            continue  # its one row of counts is made on the driver
        plan = f(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct")), name


def test_scan_is_pruned(spark):
    plan = catalogue.mint_person_ids(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint>" in plan


def test_entry():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
