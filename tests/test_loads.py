"""Whole loads over real files."""

from __future__ import annotations

import pytest
from conftest import RS, US, framed
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from feedlake.operators import audit, sinks
from feedlake.plans import load as load_plan
from feedlake.plans.ingest import directory_load, manifest_load
from feedlake.plans.load import Rules
from feedlake.scale import BROADCAST_BYTES
from feedlake.sources import framed as framed_source

A_TITLES, A_TYPES = ["Patient ID", "Allergy Name", "Allergy Code"], ["NUMBER", "VARCHAR", "NUMBER"]
P_TITLES, P_TYPES = ["City", "SSN", "Patient ID"], ["VARCHAR", "NUMBER", "NUMBER"]


def by_verdict(rows):
    out = {}
    for r in rows.collect():
        key = (r["verdict"], r["source_file"])
        value = r["file_verdict"] if r["verdict"] == "file" else tuple(r["line"].split(US))
        out.setdefault(key, []).append(value)
    return {k: sorted(v) for k, v in out.items()}


def fill(landing):
    landing.entity(
        "416", "2015-09-01", "allergy", A_TITLES, A_TYPES,
        [["1", "nuts\r\nand seeds", "520"], ["2", "", ""], US * 2, ["3", "x"], ["4", "a", "b", "c"], ["z", "q", "1e5"]],
    )
    landing.entity("416", "2015-09-01", "patient", P_TITLES, P_TYPES, [["Paris", "secret", "7"], ["Rome", "12"]])
    landing.entity("1267", "2015-09-02", "ALLERGY", A_TITLES[::-1], A_TYPES, [["c", "n", "9"]], tail="")
    landing.entity("1267", "2015-09-02", "allergy", A_TITLES[:2], A_TYPES, [["1", "n"]], stamp="1")
    landing.entity("1267", "2015-09-02", "chart", ["a"], ["b"], [["1"]])
    landing.entity("1267", "2015-09-02", "allergy", A_TITLES + ["More"], A_TYPES + ["X"], [["1", "n", "2", "m"]], stamp="2")
    landing.entity("1267", "2015-09-02", "allergy", A_TITLES, A_TYPES[:2], [["1", "n", "2"]], stamp="3")
    landing.entity("999", "2015-09-01", "allergy", A_TITLES, A_TYPES, [["9", "not", "1"]])
    landing.entity("416", "2015-10-01", "allergy", A_TITLES, A_TYPES, [["8", "later", "1"]])
    landing.entity("416", "2015-09-01", "other", A_TITLES, A_TYPES, [["8", "x", "1"]])
    landing.put("416", "2015-09-01", "notes", "no underscore")
    landing.control("416", "2015-09-01", "JOB1")


EXPECTED = {
    ("file", "allergy_4.0_20150901090417_416.asv"): ["ok"],
    ("ok", "allergy_4.0_20150901090417_416.asv"): [("1", "nuts and seeds", "520"), ("2", "", ""), ("z", "q", "1e5")],
    ("bad_arity", "allergy_4.0_20150901090417_416.asv"): [("3", "x"), ("4", "a", "b", "c")],
    ("file", "patient_4.0_20150901090417_416.asv"): ["ok"],
    ("ok", "patient_4.0_20150901090417_416.asv"): [("7", "", "Paris")],
    ("bad_arity", "patient_4.0_20150901090417_416.asv"): [("Rome", "")],
    ("file", "ALLERGY_4.0_20150901090417_1267.asv"): ["ok"],
    ("ok", "ALLERGY_4.0_20150901090417_1267.asv"): [("9", "n", "c")],
    ("file", "allergy_4.0_1_1267.asv"): ["schema_mismatch"],
    ("file", "chart_4.0_20150901090417_1267.asv"): ["no_golden_schema"],
    ("file", "allergy_4.0_2_1267.asv"): ["ok"],
    ("ok", "allergy_4.0_2_1267.asv"): [("1", "n", "2")],
    ("file", "allergy_4.0_3_1267.asv"): ["bad_header"],
}


def test_directory_load(spark, landing, golden, lists):
    fill(landing)
    loaded = directory_load(spark, landing.source, "2015-09*", lists, golden)
    assert by_verdict(loaded.rows) == EXPECTED
    jobs = {(r["org_id"], r["job_id"], r["feed_date"]) for r in loaded.rows.collect()}
    assert jobs == {("416", "JOB1", "2015-09-01"), ("1267", "", "2015-09-02")}
    extra = loaded.rows.where(F.size("extra_columns") > 0).select("source_file", "extra_columns").collect()
    assert [tuple(r) for r in extra] == [("allergy_4.0_2_1267.asv", ["more"])]


def test_validate_and_entity(spark, landing, golden, lists):
    fill(landing)
    rules = Rules(entity="Allergy", validate=True)
    loaded = directory_load(spark, landing.source, "2015-09-01", lists, golden, rules)
    expected = {k: v for k, v in EXPECTED.items() if k[1].startswith("allergy_4.0_20150901090417_416")}
    expected[("ok", "allergy_4.0_20150901090417_416.asv")] = [("1", "nuts and seeds", "520"), ("2", "", "")]
    expected[("bad_number", "allergy_4.0_20150901090417_416.asv")] = [("z", "q", "1e5")]
    assert by_verdict(loaded.rows) == expected


def test_nothing_found(spark, landing, golden, lists):
    loaded = directory_load(spark, landing.source, "2015-09-01", lists, golden)
    assert loaded.rows.count() == 0


@pytest.fixture
def tiny_splits(spark):
    """Files above 256 bytes are read in splits of 512 bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512b")
    spark.conf.set("spark.sql.files.openCostInBytes", "16b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def many(landing, n=400):
    for org, rows in (("416", n), ("1267", n // 3), ("AB1", 5)):
        landing.entity(
            org, "2015-09-01", "allergy", A_TITLES[::-1], ["NUMBER", "VARCHAR", "NUMBER"],
            [[str(i), f"name {i}", str(i * 2)] if i % 7 else [str(i), "short"] for i in range(rows)],
        )
        landing.entity(org, "2015-09-01", "patient", P_TITLES[:2], P_TYPES, [["x" * 30, str(i)] for i in range(rows)])


def snapshot(loaded):
    return sorted(
        (r["verdict"], r["source_file"], r["file_verdict"] or "", r["line"] or "", r["job_id"], r["record_no"] or 0)
        for r in loaded.rows.collect()
    )


@pytest.mark.parametrize("way", ["broadcast", "slices", "scanned heads", "part limit"])
def test_splits_do_not_change_the_result(spark, landing, golden, lists, tiny_splits, monkeypatch, request, way):
    many(landing)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = snapshot(directory_load(spark, landing.source, "2015-09-01", lists, golden))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512b")
    if way == "slices":
        monkeypatch.setattr(load_plan, "fits_broadcast", lambda df, limit: False)
        monkeypatch.setattr(framed_source, "measured_bytes", lambda df: 3 * BROADCAST_BYTES)
    if way == "scanned heads":
        monkeypatch.setattr("feedlake.sources.framed.head_reader", _no_heads)
    if way == "part limit":  # splits share partitions in another way
        spark.conf.set("spark.sql.files.maxPartitionNum", "3")
        request.addfinalizer(lambda: spark.conf.unset("spark.sql.files.maxPartitionNum"))
    split = directory_load(spark, landing.source, "2015-09-01", lists, golden)
    assert way == "part limit" or split.rows.rdd.getNumPartitions() > 8
    assert snapshot(split) == whole
    assert len(whole) == sum(n for n in (400, 133, 5)) + 6


def _no_heads():
    def read(batches):
        for batch in batches:
            yield batch.assign(titles=None, types=None)

    return read


def test_manifest_load(spark, landing, golden, lists):
    date = "2015-09-01"
    landing.manifest(
        "2208", date,
        [
            ["allergy_4.0_20150901090417_416.asv", "2", "h", "t", ""],
            ["patient_4.0_20150901090417_416.asv", "0", "h", "t"],
            ["allergy_4.0_20150901090417_1267.asv", "1", "h", "t"],
            ["patient_4.0_20150901090417_1267.asv", "1", "h", "t"],
            ["allergy_4.0_20150901090417_999.asv", "1", "h", "t"],
            ["allergy", "111", "h"],
            ["allergy_4.0_20150901090417_416.asv", "x", "h"],
            ["alone"],
        ],
    )
    landing.manifest("7777", date, [["patient_4.0_20150901090417_416.asv", "3", "h", "t"]])
    for org in ("416", "1267", "999"):
        landing.entity(org, date, "allergy", A_TITLES, A_TYPES, [[org, "n", "1"]])
    landing.entity("416", date, "patient", P_TITLES, P_TYPES, [["Paris", "secret", "7"]])
    landing.control("2208", date, "DIV")
    landing.control("2209", date, "UNUSED")
    landing.control("416", date, "J416")
    loaded = manifest_load(spark, landing.source, date, lists, golden)
    assert by_verdict(loaded.rows.where("verdict = 'ok'")) == {
        ("ok", "allergy_4.0_20150901090417_416.asv"): [("416", "n", "1")],
        ("ok", "allergy_4.0_20150901090417_1267.asv"): [("1267", "n", "1")],
    }
    assert {(r["org_id"], r["job_id"]) for r in loaded.rows.collect()} == {("416", "J416"), ("1267", "")}
    missing = [r["file_path"].rsplit("/", 1)[1] for r in loaded.missing_files.collect()]
    assert missing == ["patient_4.0_20150901090417_1267.asv"]
    rejects = sorted(r["status"] for r in loaded.manifest_rejects.collect())
    assert rejects == ["bad_count", "bad_name", "single_field", "zero_rows"]
    lines = [r["value"].split(US) for r in loaded.manifest_rows.collect()]
    assert len(lines) == 8
    assert ["allergy_4.0_20150901090417_416.asv", "2", "h", "t", "", "0", "DIV", "Manifest_4.0_2208.asv"] in lines
    controls = sorted(r["value"].split(US)[3] for r in loaded.control_rows.collect() if r["value"])
    assert controls == ["DIV", "J416"]


def test_sinks(spark, landing, golden, lists, tmp_path):
    fill(landing)
    loaded = directory_load(spark, landing.source, "2015-09*", lists, golden)
    out = str(tmp_path / "landed")
    for compact in (False, True):
        sinks.write_rows(loaded.rows, out, compact=compact)
        landed = spark.read.parquet(out)
        assert by_verdict(landed) == EXPECTED
    reasons = {r["file_path"].rsplit("/", 1)[1]: r["reason"] for r in sinks.rejected_files(landed, "r1").collect()}
    assert reasons == {
        "allergy_4.0_1_1267.asv": "schema_mismatch",
        "chart_4.0_20150901090417_1267.asv": "no_golden_schema",
        "allergy_4.0_3_1267.asv": "bad_header",
    }
    states = {r["entity"]: (*tuple(r)[1:4], r["state"]) for r in audit.outcome(landed).collect()}
    assert states == {"allergy": (5, 2, 2, "errors"), "patient": (1, 1, 0, "errors"), "chart": (0, 0, 1, "errors")}
    typed = sinks.typed_view(landed, golden, "patient").collect()
    assert [tuple(r) for r in typed] == [("7", None, "Paris", "0", "JOB1", "patient_4.0_20150901090417_416.asv")]
    text = str(tmp_path / "text")
    sinks.write_rows(loaded.rows, text, fmt="text")
    lines = {r["value"] for r in spark.read.text(text + "/verdict=ok/entity=allergy").collect()}
    assert US.join(["1", "nuts and seeds", "520", "0", "JOB1", "allergy_4.0_20150901090417_416.asv"]) in lines
    assert len(lines) == 5
    assert spark.read.text(text + "/verdict=file").count() == 3
    assert sinks.wants_compaction(loaded.files)


@pytest.mark.parametrize("compact", [False, True])
@pytest.mark.parametrize("folders", [1, 32])
def test_rows_are_not_sorted_by_folder(spark, landing, golden, lists, tmp_path, monkeypatch, compact, folders):
    fill(landing)
    key, real, seen = "spark.sql.maxConcurrentOutputFileWriters", DataFrameWriter.save, []
    before = spark.conf.get(key)

    def save(writer, path):
        seen.append(int(spark.conf.get(key)))
        real(writer, path)

    monkeypatch.setattr(DataFrameWriter, "save", save)
    monkeypatch.setattr(sinks, "OPEN_FOLDERS", folders, raising=False)
    out = str(tmp_path / "landed")
    sinks.write_rows(directory_load(spark, landing.source, "2015-09*", lists, golden).rows, out, compact=compact)
    assert seen == [folders] and spark.conf.get(key) == before
    assert by_verdict(spark.read.parquet(out)) == EXPECTED


def test_command_line(spark, landing, tmp_path):
    from feedlake.__main__ import main

    fill(landing)
    base = str(tmp_path)
    spark.createDataFrame(
        [
            ("db", "allergy", "Patient ID", "1", None),
            ("db", "allergy", "Allergy Name", "2", None),
            ("db", "allergy", "Allergy Code", "10", ""),
            ("db", "allergy", "Loaded At", "3", "ETL"),
            ("db", "patient", "Patient ID", "1", None),
            ("db", "patient", "SSN", "2", "Remove"),
            ("db", "patient", "City", "3", None),
            ("other", "patient", "Street", "4", None),
        ],
        "databasename string, tablename string, columntitle string, columnid string, commentstring string",
    ).write.parquet(base + "/catalog")
    (tmp_path / "practices").write_text('416~A, "quoted"\n1267~B\n1267~B again\n')
    (tmp_path / "divisions").write_text("2208~x\n")
    (tmp_path / "entities").write_text("ALLERGY\nPatient\nchart\n")
    main(
        [landing.source, "*", "2015-09*", base + "/out", base + "/practices", base + "/entities",
         base + "/divisions", "path", "--catalog", base + "/catalog", "--database", "db", "--text"]
    )
    landed = spark.read.parquet(base + "/out/rows")
    assert by_verdict(landed) == EXPECTED
    assert spark.read.parquet(base + "/out/error/files").count() == 3
    states = [r["state"] for r in spark.read.parquet(base + "/out/audit/status").orderBy("ts").collect()]
    assert states == ["started", "completed with errors"]
    assert spark.read.parquet(base + "/out/audit/work_queue").count() == 1
    assert spark.read.text(base + "/out/text").where("verdict = 'bad_arity'").count() == 3
    with pytest.raises(SystemExit):
        main([landing.source])


def test_manifest_run_writes_manifest_and_control(spark, landing, golden, lists, tmp_path):
    from feedlake.plans.job import Outputs, run

    landing.manifest("2208", "2015-09-01", [["allergy_4.0_20150901090417_416.asv", "2", "h", "t"]])
    landing.control("2208", "2015-09-01", "DIV")
    landing.entity("416", "2015-09-01", "allergy", A_TITLES, A_TYPES, [["1", "n", "1"]])
    out = Outputs(str(tmp_path / "out"))
    outcome = run(spark, "divisional", landing.source, "2015-09-01", lists, golden, out)
    assert [tuple(r) for r in outcome.collect()] == [("allergy", 1, 0, 0, 0, 0, "ok")]
    line = US.join(["allergy_4.0_20150901090417_416.asv", "2", "h", "t", "0", "DIV", "Manifest_4.0_2208.asv"])
    assert [r["value"] for r in spark.read.text(out.root + "/manifest").collect()] == [line]
    assert spark.read.text(out.root + "/control").first()["value"].startswith("2208\x1f2015-09-01")
    with pytest.raises(ValueError):
        run(spark, "other", landing.source, "2015-09-01", lists, golden, out)


def test_arrivals(spark, landing, golden, lists, tmp_path):
    from feedlake.streaming.arrivals import load_arrivals

    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def poll():
        query = load_arrivals(spark, str(landing.root / "data"), lists, golden, out, checkpoint)
        query.awaitTermination()
        assert query.exception() is None
        rows = spark.read.option("basePath", out).parquet(out + "/batch=*").where("verdict = 'ok'")
        return sorted((r["batch"], r["line"].split(US)[0], r["job_id"]) for r in rows.collect())

    landing.entity("416", "2015-09-01", "allergy", A_TITLES, A_TYPES, [["1", "n", "1"]])
    landing.control("416", "2015-09-01", "J1")
    landing.entity("1267", "2015-09-01", "allergy", A_TITLES, A_TYPES, [["2", "n", "1"]])
    assert poll() == [(0, "1", "J1")]
    assert poll() == [(0, "1", "J1")]
    landing.control("1267", "2015-09-01", "J2")
    assert poll() == [(0, "1", "J1"), (1, "2", "J2")]


def test_requested_runs(spark, landing, golden, lists, tmp_path):
    from feedlake.plans.job import run_requested
    from feedlake.sources.control import control_table

    landing.manifest("2208", "2015-09-01", [["allergy_4.0_20150901090417_1267.asv", "2", "h", "t"]])
    for org in ("416", "1267"):
        landing.entity(org, "2015-09-01", "allergy", A_TITLES, A_TYPES, [[org, "n", "1"]])
    for org in ("416", "2208"):
        landing.put(f"drop{org}", "x", "CONTROL.TXT", f"{org}~2015-09-01~2015-09-01~JOB{org}~/x\nmore\n")
    controls = control_table(spark, [str(landing.root / "data" / "drop*")])
    jobs = run_requested(spark, controls, landing.source, lists, golden, str(tmp_path))
    assert sorted(jobs) == ["JOB2208", "JOB416"]
    loaded = {j: [r["line"] for r in spark.read.parquet(f"{tmp_path}/{j}/{j[3:]}_2015-09-01/rows").where("verdict = 'ok'").collect()] for j in jobs}
    assert loaded == {"JOB416": [US.join(["416", "n", "1"])], "JOB2208": [US.join(["1267", "n", "1"])]}
    status = spark.read.parquet(f"{tmp_path}/JOB416/416_2015-09-01/audit/status").where("state = 'completed'").first()
    assert (status["job_id"], status["facility"]) == ("JOB416", "416")


ODD_ORGS = ("AB 1", "A+B", "50%", "7%41")


def odd_names(landing):
    """A root that holds /data/ twice, with names that scans give percent-escaped."""
    landing.root = landing.root / "data" / "la ke+1%"
    for org in ODD_ORGS:
        rows = [[str(k), f"of {org}", "1"] for k in range(40)]
        landing.entity(org, "2015-09-01", "allergy", A_TITLES, A_TYPES, rows, stamp="a b+c%41")
        landing.control(org, "2015-09-01", f"J{org}")
    return {("ok", f"allergy_4.0_a b+c%41_{org}.asv", org, "2015-09-01", f"J{org}", 40) for org in ODD_ORGS}


def landed(rows):
    key = ["verdict", "source_file", "org_id", "feed_date", "job_id"]
    return {tuple(r) for r in rows.where("verdict <> 'file'").groupBy(*key).count().collect()}


@pytest.mark.parametrize("size", ["small", "large"])
def test_names_that_scans_escape_below_two_data_folders(spark, landing, golden, lists, tmp_path, size, request):
    from dataclasses import replace

    from feedlake.streaming.arrivals import load_arrivals

    if size == "large":
        request.getfixturevalue("tiny_splits")
    want = odd_names(landing)
    lists = replace(lists, practices=spark.createDataFrame([(o,) for o in ODD_ORGS], "practice_id string"))
    assert landed(directory_load(spark, landing.source, "2015-09*", lists, golden).rows) == want
    names = [f"allergy_4.0_a b+c%41_{org}.asv" for org in ODD_ORGS]
    landing.manifest("2208", "2015-09-01", [[n, "40", "h", "t"] for n in names])
    loaded = manifest_load(spark, landing.source, "2015-09-01", lists, golden)
    assert landed(loaded.rows) == want
    assert loaded.missing_files.isEmpty()
    out = str(tmp_path / "out")
    load_arrivals(spark, str(landing.root / "data"), lists, golden, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert landed(spark.read.parquet(out + "/batch=*")) == want


def test_organisation_stands_where_the_pattern_has_it(spark):
    layout = Rules().layout
    for pattern, path in (
        ("/lake/data/x/data/*/feed/finished/2015*", "file:///lake/data/x/data/416/feed/finished/2015-09-01/"),
        ("hdfs://name:9/data/x/data/4*/data/finished/2015*", "hdfs://name:9/data/x/data/416/data/finished/2015-09-01/"),
        ("/lake/data/x/data", "file:/lake/data/x/data/416/finished/2015-09-01/"),
        ("/finished/data/416/finished/2015*", "/finished/data/416/finished/2015-09-01/"),
    ):
        at = layout.placed(pattern)
        row = spark.range(1).select(
            at.org_id(F.lit(path)), at.feed_date(F.lit(path)), at.for_practice(F.lit(path), F.lit("9"))
        ).first()
        assert tuple(row) == ("416", "2015-09-01", path.replace("416", "9"))
    assert layout.placed("/a/data/b/data/4*/finished").any_org("/a/data/b/data/4*/finished") == "/a/data/b/data/*/finished"
    with pytest.raises(ValueError):
        layout.placed("/lake/data/x/data/416/finished/2015*")


@pytest.mark.parametrize("columns", [700, 1500])
def test_wide_tables(spark, landing, lists, columns):
    """A table of many columns in reverse order, with personal data and numbers."""
    titles = [f"C {i}" for i in range(columns)]
    types = ["NUMBER" if i % 2 else "VARCHAR" for i in range(columns)]
    good = [str(i) for i in range(columns)]
    bad = [*good[:-1], "x"]
    landing.entity("416", "2015-09-01", "chart", titles, types, [good, bad, good[:5], [*good, "more"]])
    landing.entity("416", "2015-09-01", "allergy", [f"x{i}" for i in range(1000)], ["X"] * 1000, [["1"] * 1000])
    golden = spark.createDataFrame(
        [("chart", i, f"c_{columns - 1 - i}", "remove" if i == columns - 4 else None) for i in range(columns)]
        + [("allergy", 0, "x0", None)],
        "entity string, column_id long, column_name string, comment string",
    )
    loaded = directory_load(spark, landing.source, "2015-09-01", lists, golden, Rules(validate=True))
    got = by_verdict(loaded.rows.where("entity = 'chart'"))
    name = "chart_4.0_20150901090417_416.asv"
    blank = lambda row: tuple("" if i == 3 else v for i, v in enumerate(row))
    assert got == {
        ("file", name): ["ok"],
        ("ok", name): [blank(good)[::-1]],
        ("bad_number", name): [blank(bad)],
        ("bad_arity", name): sorted([blank(good[:5]), blank(good)]),
    }
    other = loaded.rows.where("entity = 'allergy'")
    assert other.where("verdict = 'ok'").first()["line"] == "1"
    narrow = directory_load(spark, landing.source, "2015-09-01", lists, golden.where("entity = 'allergy'"), Rules(entity="allergy"))
    assert sorted(r["verdict"] for r in narrow.rows.collect()) == ["file", "ok"]


def test_record_numbers_tell_the_place_in_the_file(spark, landing, golden, lists, tiny_splits):
    rows = [[str(i), "n", "1"] if i % 5 else [str(i)] for i in range(300)]
    rows[7] = "\n"  # a blank record vanishes and still counts
    landing.entity("416", "2015-09-01", "allergy", A_TITLES, A_TYPES, rows)
    for size in ("64b", "512b", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        found = directory_load(spark, landing.source, "2015-09-01", lists, golden).rows.where("verdict <> 'file'").collect()
        assert {int(r["line"].split(US)[0]): r["record_no"] for r in found} == {i: i + 4 for i in range(300) if i != 7}


def test_a_file_split_anew_fails_the_load(spark, landing, tiny_splits):
    from feedlake.sources.framed import _placed, block_numbers, large_file_records

    many(landing)
    records = large_file_records(spark, [str(landing.root)], F.lit(True))
    blocks = block_numbers(_placed(records)).collect()
    by_file = {}
    for b in sorted(blocks):
        assert b["before"] == by_file.get(b["file_path"], 0)
        by_file[b["file_path"]] = b["before"] + b["n"]
    counts = {r["file_path"]: r["count"] for r in records.groupBy("file_path").count().collect()}
    assert by_file == counts


@pytest.mark.parametrize("ids", [3, 10_001])
@pytest.mark.parametrize("size", ["small", "large"])
def test_a_file_that_comes_after_the_inventory_is_not_loaded(spark, landing, golden, lists, monkeypatch, request, ids, size):
    from dataclasses import replace

    if size == "large":
        request.getfixturevalue("tiny_splits")
    rows = [[str(k), "n", "1"] for k in range(60)]
    names = ["416", "1267", "AB1", *(f"P{k}" for k in range(ids - 3))]
    lists = replace(lists, practices=spark.createDataFrame([(n,) for n in names], "practice_id string"))
    for org in ("416", "1267"):
        landing.entity(org, "2015-09-01", "allergy", A_TITLES, A_TYPES, rows)
    landing.control("416", "2015-09-01", "J1")
    from feedlake.plans import ingest

    listed = ingest.inventory

    def then_more(*args):
        found = listed(*args)
        landing.entity("416", "2015-09-01", "allergy", A_TITLES, A_TYPES, rows, stamp="99")
        landing.entity("AB1", "2015-09-01", "allergy", A_TITLES, A_TYPES, rows)
        landing.control("AB1", "2015-09-01", "J2")
        return found

    monkeypatch.setattr(ingest, "inventory", then_more)
    loaded = directory_load(spark, landing.source, "2015-09-01", lists, golden)
    want = {("416", "J1", 60), ("1267", "", 60)}
    assert {tuple(r) for r in loaded.rows.where("verdict = 'ok'").groupBy("org_id", "job_id").count().collect()} == want
    assert loaded.files.count() == 2
    landing.manifest("2208", "2015-09-01", [[f"allergy_4.0_{stamp}_{org}.asv", "60", "h", "t"] for stamp, org in (("20150901090417", "1267"), ("77", "416"))])

    def then_named(*args):
        found = listed(*args)
        landing.entity("416", "2015-09-01", "allergy", A_TITLES, A_TYPES, rows, stamp="77")
        landing.manifest("2209", "2015-09-01", [["allergy_4.0_99_416.asv", "60", "h", "t"]])
        return found

    monkeypatch.setattr(ingest, "inventory", then_named)
    loaded = manifest_load(spark, landing.source, "2015-09-01", lists, golden)
    assert {tuple(r) for r in loaded.rows.where("verdict = 'ok'").groupBy("org_id").count().collect()} == {("1267", 60)}
    assert [r["file_path"].rpartition("/")[2] for r in loaded.missing_files.collect()] == ["allergy_4.0_77_416.asv"]


@pytest.mark.parametrize("size", ["small", "large"])
def test_contents_are_never_shuffled(spark, landing, golden, lists, monkeypatch, request, size):
    """Not even with maps that are too large for one broadcast."""
    if size == "large":
        request.getfixturevalue("tiny_splits")
    many(landing, 60)
    monkeypatch.setattr(load_plan, "fits_broadcast", lambda df, limit: False)
    monkeypatch.setattr(framed_source, "measured_bytes", lambda df: 2 * BROADCAST_BYTES)
    plan = directory_load(spark, landing.source, "2015-09-01", lists, golden).rows._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" in plan and "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "Exchange hashpartitioning" not in plan
