"""Loads that control files ask for, in one go."""

from __future__ import annotations

from test_loads import A_TITLES, A_TYPES

from feedlake.__main__ import main
from feedlake.plans.requests import load_requests, named_requests, requests_of

ROWS = [["1", "n", "2"], ["2", "m"]]


def fill(landing):
    for org in ("416", "1267"):
        for date in ("2015-09-01", "2015-09-02", "2015-10-01"):
            landing.entity(org, date, "allergy", A_TITLES, A_TYPES, ROWS)
    landing.manifest("2208", "2015-09-01", [["allergy_4.0_20150901090417_1267.asv", "2", "h", "t"]])
    landing.manifest("2209", "2015-09-02", [["allergy_4.0_20150901090417_416.asv", "2", "h", "t"]])


def landed(spark, out):
    rows = spark.read.parquet(f"{out}/rows").where("verdict = 'ok'")
    return {tuple(r) for r in rows.select("request", "org_id", "feed_date").collect()}


def test_requests_share_one_load(spark, landing, golden, lists, tmp_path):
    fill(landing)
    asked = [
        ("J1", "416", "2015-09*"),
        ("J1", "416", "2015-09*"),  # the same request
        ("J2", "416", "2015-09-02"),
        ("", "1267", "2015-10-01"),
        ("J3", "2208", "2015-09-01"),
        ("J4", "9999", "2015-09*"),
        ("J5", "416", "2016*"),  # no such files
        ("J6", "777", "2015-09*"),  # not an allowed practice
    ]
    asked = spark.createDataFrame(asked, "job_id string, facility string, from_date string")
    out = str(tmp_path / "out")
    outcome = load_requests(spark, asked, landing.source, lists, golden, load_rules(), out)
    want = {
        ("J1/416_2015-09*", "416", "2015-09-01"),
        ("J1/416_2015-09*", "416", "2015-09-02"),
        ("J2/416_2015-09-02", "416", "2015-09-02"),
        ("no-job/1267_2015-10-01", "1267", "2015-10-01"),
        ("J3/2208_2015-09-01", "1267", "2015-09-01"),
        ("J4/9999_2015-09*", "1267", "2015-09-01"),
        ("J4/9999_2015-09*", "416", "2015-09-02"),
    }
    assert landed(spark, out) == want
    assert {(r.request, r.n_ok, r.n_rejected, r.state) for r in outcome.collect()} >= {("J1/416_2015-09*", 2, 2, "errors")}
    again = asked.where("job_id = 'J2'")
    load_requests(spark, again, landing.source, lists, golden, load_rules(), out)  # replaces its own request only
    assert landed(spark, out) == want
    assert spark.read.parquet(f"{out}/rows").where("request like 'J2%' and verdict = 'ok'").count() == 1


def load_rules():
    from feedlake.plans.load import Rules

    return Rules()


def test_command_line_follows_control_files(spark, landing, golden, lists, tmp_path):
    fill(landing)
    landing.control("416", "2015-09-01", "JOB1")
    assert [tuple(r) for r in requests_of(spark, landing.source, "2015-09*").collect()] == [("JOB1", "416", "2015-09-01")]
    columns = golden.selectExpr("'edw' databasename", "entity tablename", "column_name columntitle", "column_id columnid", "comment commentstring")
    columns.write.parquet(str(tmp_path / "catalog"))
    for name, text in (("practices", "416~A\n"), ("entities", "allergy\n"), ("divisions", "2208~x\n")):
        (tmp_path / name).write_text(text)
    main([landing.source, "*", "2015-09*", str(tmp_path / "out"), *(str(tmp_path / n) for n in ("practices", "entities", "divisions")), "requested", "--catalog", str(tmp_path / "catalog")])
    assert landed(spark, tmp_path / "out") == {("JOB1/416_2015-09-01", "416", "2015-09-01")}


def test_no_requests(spark, landing, golden, lists):
    asked = requests_of(spark, landing.source, "2015*")
    assert asked.isEmpty() and named_requests(asked, lists.divisions).isEmpty()
