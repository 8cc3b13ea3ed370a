"""The stages over synthetic files: goldens, each kind of bad record, and every way to fail."""

import json

import pytest
from pyspark.errors import PySparkException

from quillmere import cli
from quillmere.plans import stages
from quillmere.plans.contexts import IngestRun, TransformRun, ValidateRun, run_stamp
from quillmere.plans.errors import BronzeInputError, EmptyBronzeError, EmptySourceError, FetchError, StagingInputError, UnknownSourceError, ValidationFailedError
from quillmere.sources import fetch, rows

SRC = "commons_members"
GOOD = {"person_id": "7", "person_short_honorific": None, "person_official_first_name": "Ann", "person_official_last_name": "Bé", "constituency_name": "X", "constituency_province_territory_name": "Y", "caucus_short_name": "Z", "from_date_time": "2025-04-28T00:00:00Z", "to_date_time": None}
NO_ID = {k: v for k, v in GOOD.items() if k != "person_id"}
NULL_ID, BAD_DATE, EXTRA = GOOD | {"person_id": None}, GOOD | {"from_date_time": "not-a-date"}, GOOD | {"zz": "1"}


def element(pid="", first="F", last="L", start="2025-04-28T00:00:00", end='<ToDateTime xsi:nil="true"/>', more="", tag="MemberOfParliament"):
    return f"<{tag}><PersonId>{pid}</PersonId><PersonShortHonorific/><PersonOfficialFirstName>{first}</PersonOfficialFirstName><PersonOfficialLastName>{last}</PersonOfficialLastName><ConstituencyName>A—B</ConstituencyName><FromDateTime>{start}</FromDateTime>{end}{more}</{tag}>"


def xml(tmp_path, *elements):
    p = tmp_path / "in.xml"
    p.write_text('<?xml version="1.0" encoding="utf-8"?><All xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns:n="urn:n">' + "\n".join(elements) + "</All>", encoding="utf-8")
    return p


def ingest(spark, tmp_path, *elements, **more):
    run = IngestRun(SRC, "r", staging_root=tmp_path / "staging", fetch_policy="local-file", input_path=xml(tmp_path, *elements), **more)
    return run, stages.run_ingest(spark, run)


def staged(tmp_path, *records, manifest=True):
    d = tmp_path / "staging" / SRC / "r"
    d.mkdir(parents=True, exist_ok=True)
    (d / "records.jsonl").write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in records), encoding="utf-8")
    if manifest:
        (d / "manifest.json").write_text(json.dumps({"run_id": "r", "source": SRC, "status": "success", "output": {"record_count": len(records)}}))
    return ValidateRun(SRC, "b", staging_run_id="r", staging_root=tmp_path / "staging", bronze_root=tmp_path / "bronze", quarantine_root=tmp_path / "q")


def lines(p):
    return [json.loads(x) for x in text(p).splitlines()]


def text(p):
    """A file's text, or that of the parts of a folder in order."""
    return "".join(f.read_text(encoding="utf-8") for f in (sorted(p.glob("part-*")) if p.is_dir() else [p]))


def test_all_stages(spark, tmp_path):
    run, m = ingest(spark, tmp_path, *[element(100 + i) for i in range(10)], element(""))
    assert m["output"] == {"records_path": "records.jsonl", "record_count": 11, "rejected_count": 0}
    got = lines(run.records)
    assert [r["person_id"] for r in got] == [*(str(100 + i) for i in range(10)), None]
    assert got[0]["from_date_time"] == "2025-04-28T00:00:00Z" and got[0]["person_short_honorific"] is None and got[0]["caucus_short_name"] is None
    assert (run.raw / "members.xml").exists() and m["inputs"][0]["bytes"] > 0 and m["inputs"][0]["cache_hit"] is False
    v = ValidateRun(SRC, "b", staging_run_id="r", staging_root=tmp_path / "staging", bronze_root=tmp_path / "bronze", quarantine_root=tmp_path / "q")
    out = stages.run_validate(spark, v)
    assert out["output"]["record_count"] == 10 and out["output"]["rejected_count"] == 1 and out["tier"] == "bronze"
    reject = lines(v.quarantine / "rejects.jsonl")
    assert [r["line"] for r in reject] == [11] and reject[0]["errors"][0]["slot"] == "person_id"
    t = TransformRun(SRC, "s", bronze_run_id="b", bronze_root=tmp_path / "bronze", silver_root=tmp_path / "silver")
    out = stages.run_transform(spark, t)["output"]
    assert (out["record_count"], out["fragment_count"], out["rejected_count"]) == (10, 30, 0)
    f = lines(t.silver / "fragments.jsonl")
    assert [x["@type"] for x in f[:3]] == ["MemberOfParliament", "Person", "RELATIONSHIP"]
    assert list(f[0]) == ["@type", "bronze_reference", "id"] and list(f[1]) == ["@type", "bronze_reference", "id", "name"] and list(f[2]) == ["@type", "bronze_reference", "subject", "rel_type", "object"]
    assert f[27]["bronze_reference"] == {"source": SRC, "bronze_run_id": "b", "line_number": 10}


def test_xml_children(spark, tmp_path):
    run, _ = ingest(
        spark, tmp_path,
        element(1, more="<PersonId>2</PersonId><Other>x</Other>"), element(3, first='</PersonOfficialFirstName><PersonOfficialFirstName xsi:nil="true">'),
        "<n:MemberOfParliament><n:PersonId> 4 </n:PersonId></n:MemberOfParliament>", element(5, end='<ToDateTime xsi:nil="1">2025-05-01T10:00:00.25+02:00</ToDateTime>'),
        '<MemberOfParliament><PersonId xsi:nil="true">9</PersonId></MemberOfParliament>',
    )
    got = lines(run.records)
    assert [r["person_id"] for r in got] == ["1", "3", "4", "5", None]
    assert got[1]["person_official_first_name"] is None and got[3]["to_date_time"] == "2025-05-01T08:00:00.250000Z"


def test_ingest_failures(spark, tmp_path):
    with pytest.raises(EmptySourceError):
        ingest(spark, tmp_path)
    assert not (tmp_path / "staging" / SRC / "r" / "manifest.json").exists()
    with pytest.raises(PySparkException):
        ingest(spark, tmp_path, element(1, start="not-a-date"))
    with pytest.raises(UnknownSourceError):
        stages.run_ingest(spark, IngestRun("nobody", "r", staging_root=tmp_path))


def test_current_only(spark, tmp_path):
    _, m = ingest(spark, tmp_path, element(1), element(2, end="<ToDateTime>2025-05-01T00:00:00</ToDateTime>"), element(""), current_only=True)
    assert m["output"]["record_count"] == 1 and m["output"]["rejected_count"] == 2


@pytest.mark.parametrize(("bad", "slot"), [(NO_ID, "person_id"), (NULL_ID, "person_id"), (BAD_DATE, "from_date_time"), (EXTRA, "zz"), (GOOD | {"person_id": 7}, "person_id"), (GOOD | {"from_date_time": "2025-02-30T00:00:00Z"}, "from_date_time"), (GOOD | {"from_date_time": "2025-02-03T00:00:00"}, "from_date_time"), ("[1]", "person_id"), (GOOD | {"caucus_short_name": {"a": 1}}, "caucus_short_name")])
def test_gate_rejects(spark, tmp_path, bad, slot):
    run = staged(tmp_path, GOOD, "", bad, "   ", GOOD)
    out = stages.run_validate(spark, run)["output"]
    assert (out["record_count"], out["rejected_count"]) == (2, 1)
    r = lines(run.quarantine / "rejects.jsonl")
    assert r[0]["line"] == 3 and r[0]["errors"][0]["slot"] == slot and r[0]["record"] == (json.loads(bad) if isinstance(bad, str) else bad)
    report = json.loads((run.quarantine / "drift_report.json").read_text())
    assert report["error_counts"] == {slot: 1} and report["input_record_count"] == 3 and len(report) == 12


def test_gate_accepts(spark, tmp_path):
    run = staged(tmp_path, GOOD, {"person_id": "1"}, '{"person_id": null, "person_id": "2"}', GOOD | {"from_date_time": "2025-04-28t00:00:00.5+02:00"})
    assert stages.run_validate(spark, run)["output"]["record_count"] == 4
    assert text(run.quarantine / "rejects.jsonl") == ""
    assert text(run.bronze / "records.jsonl").splitlines()[2] == '{"person_id": null, "person_id": "2"}'


def test_two_errors_count_twice(spark, tmp_path):
    run = staged(tmp_path, GOOD, NULL_ID | {"from_date_time": "x"})
    stages.run_validate(spark, run)
    assert json.loads((run.quarantine / "drift_report.json").read_text())["error_counts"] == {"from_date_time": 1, "person_id": 1}


def test_validate_failures(spark, tmp_path):
    run = staged(tmp_path, NO_ID, NULL_ID, BAD_DATE, EXTRA)
    with pytest.raises(EmptyBronzeError):
        stages.run_validate(spark, run)
    assert run.bronze.exists() and not list(run.quarantine.iterdir())
    with pytest.raises(PySparkException):
        stages.run_validate(spark, staged(tmp_path, GOOD, "{broken"))
    (run.staged / "records.jsonl").unlink()
    with pytest.raises(StagingInputError):
        stages.run_validate(spark, run)
    (run.staged / "manifest.json").unlink()
    with pytest.raises(StagingInputError):
        stages.run_validate(spark, run)
    with pytest.raises(KeyError):
        stages.run_validate(spark, ValidateRun("nobody", "b", staging_run_id="r"))


def test_fail_fast(spark, tmp_path):
    run = staged(tmp_path, GOOD, NULL_ID | {"from_date_time": "x"}, GOOD, EXTRA)
    run = ValidateRun(**{**run.__dict__, "fail_fast": True})
    with pytest.raises(ValidationFailedError):
        stages.run_validate(spark, run)
    report = json.loads((run.quarantine / "drift_report.json").read_text())
    assert (report["input_record_count"], report["accepted_count"], report["rejected_count"]) == (2, 1, 1) and report["error_counts"] == {"person_id": 1}
    assert json.loads((run.bronze / "manifest.json").read_text())["status"] == "success"
    with pytest.raises(EmptyBronzeError):
        stages.run_validate(spark, ValidateRun(**{**staged(tmp_path, NO_ID, GOOD).__dict__, "fail_fast": True}))


def bronze(tmp_path, *records):
    d = tmp_path / "bronze" / SRC / "b"
    d.mkdir(parents=True)
    (d / "records.jsonl").write_text("".join(json.dumps(x) + "\n" for x in records))
    return {"bronze_run_id": "b", "bronze_root": tmp_path / "bronze", "silver_root": tmp_path / "silver"}


def test_transform_nulls_and_quarantine(spark, tmp_path):
    lacks = {k: v for k, v in GOOD.items() if k != "person_official_last_name"}
    roots = bronze(tmp_path, GOOD | {"person_official_first_name": None, "from_date_time": None}, lacks)
    with pytest.raises(PySparkException):
        stages.run_transform(spark, TransformRun(SRC, "s", **roots))
    t = TransformRun(SRC, "s", strict=False, **roots)
    out = stages.run_transform(spark, t)["output"]
    assert (out["record_count"], out["accepted_count"], out["rejected_count"], out["fragment_count"]) == (2, 1, 1, 3)
    f = lines(t.silver / "fragments.jsonl")
    assert f[0]["id"] == "gckg:MemberOfParliament:7:None" and f[1]["name"] == "None Bé"
    assert lines(t.silver / "quarantine.jsonl") == [lacks]


def test_transform_failures(spark, tmp_path):
    with pytest.raises(KeyError):
        stages.run_transform(spark, TransformRun("nobody", "s", silver_root=tmp_path))
    with pytest.raises(BronzeInputError):
        stages.run_transform(spark, TransformRun(SRC, "s", bronze_run_id="none", bronze_root=tmp_path, silver_root=tmp_path))
    roots = bronze(tmp_path)
    assert stages.run_transform(spark, TransformRun(SRC, "s", **roots))["output"]["fragment_count"] == 0


def test_merge_and_publish(spark, tmp_path):
    roots = bronze(tmp_path, GOOD, GOOD | {"from_date_time": "2026-01-01T00:00:00Z"})
    t = TransformRun(SRC, "s", extended=True, **roots)
    stages.run_transform(spark, t)
    m = stages.run_merge(spark, [str(t.silver / "fragments.jsonl")], tmp_path / "merged")
    assert m["output"] == {"node_count": 6, "edge_count": 3}
    p = stages.run_publish(spark, tmp_path / "merged", tmp_path / "gold")
    assert p["accepted_count"] == 9 and p["fault_counts"] == {}
    plain = TransformRun(SRC, "s2", **roots)
    stages.run_transform(spark, plain)
    stages.run_merge(spark, [str(plain.silver / "fragments.jsonl")], tmp_path / "m2")
    assert stages.run_publish(spark, tmp_path / "m2", tmp_path / "g2")["fault_counts"] == {"unknown triple": 2}


def test_contributions(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text('﻿Recipient ID,Recipient,Form ID,Extra,Monetary amount\n 12 ,"A, B",3,x,10.5\nNA,C,4,x,\n,D,5,x,1\n13,null, ,x,2\n', encoding="utf-8")
    run = IngestRun("open_canada_federal_election_contribution", "r", staging_root=tmp_path / "staging", fetch_policy="local-file", input_path=p)
    m = stages.run_ingest(spark, run)
    assert m["output"]["record_count"] == 2 and m["output"]["rejected_count"] == 2
    got = lines(run.records)
    assert [(r["recipient_id"], r["recipient_name"], r["monetary_amount"], r["form_id"], r["contributor_name"]) for r in got] == [("12", "A, B", "10.5", "3", None), ("13", None, "2", "", None)]
    assert len(got[0]) == 27
    v = ValidateRun(run.source, "b", staging_run_id="r", staging_root=tmp_path / "staging", bronze_root=tmp_path / "bronze", quarantine_root=tmp_path / "q")
    assert stages.run_validate(spark, v)["output"]["record_count"] == 2
    t = TransformRun(run.source, "s", bronze_run_id="b", bronze_root=tmp_path / "bronze", silver_root=tmp_path / "silver")
    assert stages.run_transform(spark, t)["output"]["fragment_count"] == 6
    stages.run_merge(spark, [str(t.silver / "fragments.jsonl")], tmp_path / "merged")
    assert stages.run_publish(spark, tmp_path / "merged", tmp_path / "gold") == {"stage": "publish", "accepted_count": 6, "fault_counts": {}}
    with pytest.raises(FetchError):
        stages.run_ingest(spark, IngestRun("open_canada_federal_election_contribution", "r", staging_root=tmp_path))


def test_fetch_policies(tmp_path):
    cfg, calls = {"url": "http://x/y", "format": "xml", "raw_filename": "m.xml", "ttl_seconds": 100}, []

    def get(status, body=b"<a/>", headers=None):
        def f(url, asked, to):
            calls.append(asked)
            if status == 200:
                to.write_bytes(body)
            return status, headers or {"ETag": "e1", "Last-Modified": "then"}

        return f

    run = lambda policy: IngestRun("s", "r", staging_root=tmp_path, fetch_policy=policy)
    with pytest.raises(FetchError):
        fetch.fetch_raw(run("cache-only"), cfg, get(200))
    with pytest.raises(FetchError):
        fetch.fetch_raw(run("default"), cfg, get(500))
    copy, meta = fetch.fetch_raw(run("default"), cfg, get(200))
    assert copy.read_bytes() == b"<a/>" and meta["cache_hit"] is False and isinstance(meta["retrieved_at"], str)
    n = len(calls)
    _, meta = fetch.fetch_raw(run("default"), cfg, get(500))
    assert len(calls) == n and meta["cache_hit"] is True and isinstance(meta["retrieved_at"], float)
    _, again = fetch.fetch_raw(run("refresh"), cfg, get(304))
    assert calls[-1]["If-None-Match"] == "e1" and calls[-1]["If-Modified-Since"] == "then" and again["retrieved_at"] == meta["retrieved_at"]
    assert fetch.fetch_raw(run("cache-only"), cfg, get(500))[1]["fetch_policy"] == "cache-only"
    cached = fetch.cache_path(run("default").cache, cfg["url"], "xml")
    assert len(cached.stem) == 16 and fetch.meta_path(cached).name.endswith(".xml.meta.json")
    assert fetch.is_fresh(cached, 100, meta["retrieved_at"] + 99.9) and not fetch.is_fresh(cached, 100, meta["retrieved_at"] + 100)
    with pytest.raises(FetchError):
        fetch.fetch_raw(run("local-file"), cfg)


def test_http(tmp_path):
    import http.server
    import threading

    class H(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(302 if self.path == "/old" else 404 if self.path == "/none" else 200)
            if self.path == "/old":
                self.send_header("Location", "/new?x=1")
            self.end_headers()
            if self.path.startswith("/new"):
                self.wfile.write(b"x" * 200_000 + self.path.encode() + self.headers["User-Agent"].encode())

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), H)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    try:
        status, _ = fetch.http_get(f"{at}/old", {"User-Agent": "u"}, tmp_path / "f")
        assert status == 200 and (tmp_path / "f").read_bytes() == b"x" * 200_000 + b"/new?x=1u"
        assert fetch.http_get(f"{at}/none", {}, tmp_path / "g")[0] == 404 and not (tmp_path / "g").exists()
    finally:
        server.shutdown()
        server.server_close()
    with pytest.raises(FetchError):
        fetch.http_get(f"{at}/new", {}, tmp_path / "g")


def test_csv_records_over_several_lines(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text('Recipient ID,Recipient\n1,"a ""b"", c"\n2,"d\ne"\n')
    assert [tuple(r) for r in rows.csv_rows(spark, str(p), {"Recipient ID": "i", "Recipient": "n"}).collect()] == [("1", 'a "b", c'), ("2", "d\ne")]


@pytest.mark.parametrize("text_", ["2025-04-28", "20250428", "20250428T103000", "2025-04-28T10", "2025-04-28T10:30", "20250428T1030", "2025-04-28 10:30:00.5", "2025-04-28T10:30:00,123456789", "2025-04-28T10:30:00+0230", "20250428T103000-05", "2025-W18-1", "2025W181T10", "2025-W18", "2020-W53-7", "2025-04-28T10:30:00Z", " 2025-04-28T10:30:00+02:00 ", "", "  "])
def test_iso_dates_are_read_as_python_reads_them(spark, text_):
    from datetime import UTC, datetime

    from quillmere.functions import columns as C

    want = datetime.fromisoformat(text_.strip()) if text_.strip() else None
    want = want and want.replace(tzinfo=want.tzinfo or UTC).astimezone(UTC).replace(tzinfo=None)
    got = spark.createDataFrame([(text_,)], "t string").select(C.iso_timestamp(stages.F.col("t")).cast("string").alias("t")).first().t
    assert (got and datetime.fromisoformat(got)) == want


@pytest.mark.parametrize("bad", ["2025-13-01", "20250230", "2025-04-28T25", "not-a-date", "2025-W54-1x"])
def test_bad_dates_fail(spark, bad):
    from quillmere.functions import columns as C

    with pytest.raises(PySparkException):
        spark.createDataFrame([(bad,)], "t string").select(C.iso_timestamp(stages.F.col("t"))).collect()


def test_maps(spark, tmp_path):
    from quillmere.operators.maps import compiled
    from quillmere.plans.errors import SchemaConfigError

    df = spark.createDataFrame([("x", None, "")], "a string, b string, c string")
    for expr, want in [("a + 'y'", "xy"), ("b + 'y'", None), ("str(b)", "None"), ("b or c or 'z'", "z"), ("a and 'q'", "q"), ("b and 'q'", None), ("a if b is None else 'n'", "x"), ("'t' if not c else 'f'", "t"), ("'t' if a == 'x' and b is None or c else 'f'", "t"), ("upper(a) + str(1)", "X1")]:
        assert df.select(compiled(expr, df.columns)).first()[0] == want, expr
    for expr in ["d", "a.b", "__import__('os')", "a[0]", "lambda: a", "a * 2", "str(a, b)", "eval('a')", "a +", "True"]:
        with pytest.raises(SchemaConfigError):
            compiled(expr, df.columns)
    roots = bronze(tmp_path, GOOD, GOOD | {"person_official_last_name": None})
    m = tmp_path / "m.yaml"
    m.write_text("class_derivations: {Person: {populated_from: CommonsMembersRow, slot_derivations: {id: {expr: \"'p:' + person_id\"}, name: {populated_from: person_official_last_name}}}, Other: {populated_from: Elsewhere}}")
    t = TransformRun(SRC, "s", map_path=m, **roots)
    out = stages.run_transform(spark, t)
    assert out["transform_map"] == str(m) and out["output"]["fragment_count"] == 2
    assert [{k: v for k, v in x.items() if k != "bronze_reference"} for x in lines(t.silver / "fragments.jsonl")] == [{"@type": "Person", "id": "p:7", "name": "Bé"}, {"@type": "Person", "id": "p:7"}]
    config = tmp_path / "sources.yaml"
    config.write_text("commons_members: {schema: commons_members.yaml, target_class: CommonsMembersRow, map: m.yaml}")
    again = TransformRun(SRC, "s2", config_path=config, **roots)
    assert stages.run_transform(spark, again)["output"]["fragment_count"] == 2
    m.write_text("class_derivations: {Person: {slot_derivations: {shoe: {expr: person_id}}}}")
    with pytest.raises(SchemaConfigError):
        stages.run_transform(spark, TransformRun(SRC, "s", map_path=m, **roots))
    with pytest.raises(SystemExit):
        cli.main(["transforms", "run", "--source", SRC, "--bronze-run-id", "b", "--map", str(m)])


def test_untransformed(spark, tmp_path):
    roots = bronze(tmp_path, GOOD, NO_ID)
    t = TransformRun(SRC, "s", untransformed=True, **roots)
    out = stages.run_transform(spark, t)
    assert out["output"]["record_count"] == 2 and out["output"]["fragment_count"] == 0 and out["transform_map"] is None
    assert text(t.silver / "records.jsonl") == (t.bronze / "records.jsonl").read_text()


def test_old_output_stays_if_the_new_fails(spark, tmp_path):
    from pyspark.sql import functions as F

    from quillmere.sources.sinks import write_lines

    for single in (True, False):
        out = tmp_path / f"{single}.txt"
        write_lines(spark.range(100).select(F.col("id").cast("string").alias("value"), "id"), f"file://{out}", "id", single_file=single)
        assert text(out).split() == [str(i) for i in range(100)] and out.is_file() == single
        with pytest.raises(PySparkException):
            write_lines(spark.range(5).select(F.raise_error(F.lit("x")).alias("value")), out, single_file=single)
        assert text(out).split() == [str(i) for i in range(100)]
        write_lines(spark.range(3).select(F.col("id").cast("string").alias("value")), out, single_file=single)
        assert sorted(text(out).split()) == ["0", "1", "2"]


def test_namesakes_stay_apart(spark):
    from quillmere.operators import graph

    nodes = spark.createDataFrame([("a:1", "Person", "Ann Lee", "a"), ("a:2", "Person", "Ann Lee", "a"), ("b:1", "Person", "ann lee", "b"), ("b:2", "Person", "Bo Li", "b"), ("a:3", "Person", "Bo Li", "a"), ("a:4", "Person", "Cy None", "a"), ("b:4", "Person", "Cy None", "b"), ("p:x", "PoliticalParty", "X", "a"), ("p:y", "PoliticalParty", "X", "b")], "id string, `@type` string, name string, source string")
    party = lambda who, p: (who, f"p:{p}")
    resolved = lambda *e: {r.id: r.canonical_id for r in graph.resolve(graph.person_keys(nodes, spark.createDataFrame(list(e), "subject string, object string"))).collect()}
    alone = {r.id: r.id for r in nodes.collect()}
    assert resolved(party("a:4", "x"), party("b:4", "x")) == alone  # a name without a part
    assert resolved(party("a:3", "x"), party("b:2", "x")) == alone | {"b:2": "a:3"}
    assert resolved(party("a:1", "x"), party("a:2", "x"), party("b:1", "x")) == alone  # which of the two isn't known
    assert resolved(party("a:1", "x"), party("a:2", "y"), party("b:1", "x")) == alone | {"b:1": "a:1"}
    assert resolved(party("a:1", "x"), party("a:2", "y"), party("b:1", "x"), party("b:1", "y")) == alone  # never two of one source
    assert resolved(party("a:3", "x"), party("b:2", "y")) == alone  # a name alone


def test_severities_and_keys_of_errors(spark):
    from quillmere.operators import gate

    kind = "line long, errors array<struct<message:string,severity:string,slot:string>>"
    errors = [(1, [("m", "WARN", "a")]), (2, [("m", "INFO", None), ("m", "ERROR", "a")]), (3, [("m", "FATAL", "")]), (4, [("m", None, None)]), (5, []), (6, [(None, "ERROR", None), ("", "ERROR", "")])]
    rows_ = spark.createDataFrame(errors, kind).withColumn("accepted", gate.accepts(stages.F.col("errors")))
    assert [r.line for r in rows_.where("accepted").orderBy("line").collect()] == [1, 5]
    n = gate.summary(rows_).first()
    assert tuple(n) == (6, 2, 4)
    assert {r.key: r.n for r in gate.error_counts(rows_).collect()} == {"a": 2, "m": 3, "unknown": 2}


def test_run_all_takes_what_can_be_fetched(spark, tmp_path, monkeypatch, capsys):
    source = xml(tmp_path, element(1), element(2))
    asked = []

    def fetched(run, config):
        asked.append(run.source)
        return source, {"url": config["url"]}

    monkeypatch.setattr(stages, "fetch_raw", fetched)
    assert cli.main(["ingest", "run-all", "--staging-root", str(tmp_path / "s")]) == 0
    assert asked == [SRC] and json.loads(capsys.readouterr().out)["record_count"] == 2


def test_registry():
    assert rows.list_sources() == ["commons_members", "open_canada_federal_election_contribution"]
    with pytest.raises(ValueError, match="source"):
        rows.register(type("X", (rows.Adapter,), {"source": ""}))


def test_parts_and_line_numbers(spark, tmp_path):
    d = tmp_path / "many"
    d.mkdir()
    n = 0
    for i in range(3):
        (d / f"f{i}.txt").write_text("".join("\n" if j % 4 == 0 else f'{{"n": {n + j + 1}}}\n' for j in range(50)))
        n += 50
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = stages.numbered_lines(spark, str(d)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(got) == sum(j % 4 != 0 for j in range(50)) * 3 and all(json.loads(r.record)["n"] == r.line for r in got)


def test_stream(spark, tmp_path):
    from quillmere.functions.rowschema import load
    from quillmere.streaming.watch import watch

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text(json.dumps(GOOD) + "\n\n" + json.dumps(EXTRA) + "\n{broken\n")
    q = watch(spark, str(tmp_path / "in"), load("commons_members.yaml", "CommonsMembersRow"), str(tmp_path / "b"), str(tmp_path / "q"), str(tmp_path / "cp"), once=True)
    q.awaitTermination(120)
    assert spark.read.text(str(tmp_path / "b")).count() == 1 and spark.read.json(str(tmp_path / "q")).count() == 2


def test_command_line(spark, tmp_path, capsys):
    p = xml(tmp_path, element(1))
    s = tmp_path / "staging"
    assert cli.main(["ingest", "run", "--source", SRC, "--run-id", "r", "--fetch-policy", "local-file", "--input", str(p), "--staging-root", str(s)]) == 0
    assert json.loads(capsys.readouterr().out)["record_count"] == 1
    assert cli.main(["validate", "run", "--source", SRC, "--staging-run-id", "r", "--run-id", "b", "--staging-root", str(s), "--bronze-root", str(tmp_path / "b"), "--quarantine-root", str(tmp_path / "q")]) == 0
    assert cli.main(["transforms", "run", "--source", SRC, "--bronze-run-id", "b", "--run-id", "x", "--bronze-root", str(tmp_path / "b"), "--silver-root", str(tmp_path / "sv"), "--single-file"]) == 0
    assert (tmp_path / "b" / SRC / "b" / "records.jsonl").is_dir() and (tmp_path / "sv" / SRC / "x" / "fragments.jsonl").is_file()
    capsys.readouterr()
    for stage in ("ingest", "validate"):
        cli.main([stage, "list-sources"])
        assert SRC in capsys.readouterr().out
    assert cli.main(["ingest", "check"]) == 0 and ":" not in run_stamp()
