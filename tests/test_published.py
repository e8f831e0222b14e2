"""Runs whose outputs appear at once, and the warehouse tables they fill."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

import duckdb
import pytest
from pyspark.sql import functions as F
from test_loads import A_TITLES, A_TYPES

from feedlake.operators import audit
from feedlake.plans import exports, job, queries
from feedlake.plans.job import PARTS, RunContext, published, remove_replaced, run_published, status_log, take_work
from feedlake.plans.oracles import ORACLES

US = "\x1f"
DAY = "2015-09-01"
NAME = "allergy_4.0_20150901090417_{}.asv"


@pytest.fixture
def again(spark, landing, golden, lists, tmp_path):
    def run(date=DAY, kind="divisional", **kw):
        context = RunContext("J", "2208", "feed")
        return run_published(spark, kind, landing.source, date, lists, golden, str(tmp_path), context=context, **kw)

    return run


def ids(df):
    return sorted(r["line"].split(US)[0] for r in df.where("verdict = 'ok'").collect())


def states(spark, root):
    return {r["stage"]: r["state"] for r in status_log(spark, root).latest().collect()}


def test_a_run_replaces_its_own_outputs_at_once(spark, landing, again, tmp_path, monkeypatch):
    root = str(tmp_path)
    for date in (DAY, "2015-09-02"):
        landing.entity("416", date, "allergy", A_TITLES, A_TYPES, [[date[-1], "n", "1"]])
        landing.manifest("2208", date, [[NAME.format("416"), "1", "h", "t"], [NAME.format("1267"), "1", "h", "t"], ["patient_1.asv", "x"]])
    outcome = {r["entity"]: r.asDict() for r in again().collect()}
    assert (outcome["allergy"]["n_missing_files"], outcome["allergy"]["state"]) == (1, "errors")
    assert (outcome["patient"]["n_bad_manifest_rows"], outcome["patient"]["state"]) == (1, "errors")
    assert states(spark, root) == {"load": "completed with errors"}
    again("2015-09-02")
    assert ids(published(spark, root)) == ["1", "2"]
    landing.entity("1267", DAY, "allergy", A_TITLES, A_TYPES, [["3", "n", "1"]])

    def stop(*_, **__):
        raise RuntimeError("stopped between two outputs")

    with monkeypatch.context() as m:
        m.setattr(audit, "outcome", stop)
        with pytest.raises(RuntimeError):
            again()
    assert ids(published(spark, root)) == ["1", "2"]  # rows of the stopped run are written, but do not count
    assert states(spark, root)["run"] == "failed"
    assert published(spark, root, "error/missing_files").count() == 2
    again()
    assert ids(published(spark, root)) == ["1", "2", "3"]
    assert published(spark, root, "error/missing_files").count() == 1
    assert published(spark, root, "manifest", text=True).count() == 6
    taken = [[tuple(r)[:3] for r in take_work(spark, root, worker).collect()] for worker in ("a", "b")]
    assert taken == [[("J", "2208", "feed")], []]


def test_replaced_and_stopped_runs_are_removed_once_old(spark, landing, again, tmp_path, monkeypatch):
    root = str(tmp_path)

    def folders():
        return {p.name for part in PARTS for p in (tmp_path / part).glob("run=*")}

    for date in (DAY, "2015-09-02"):
        landing.entity("416", date, "allergy", A_TITLES, A_TYPES, [[date[-1], "n", "1"]])
        again(date, kind="path", text=True)
    again(kind="path", text=True)
    with monkeypatch.context() as m:
        m.setattr(audit, "outcome", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            again(kind="path")
    assert len(folders()) == 4
    now = datetime.now(timezone.utc)
    assert remove_replaced(spark, root, now - timedelta(days=1)) == [] and len(folders()) == 4
    before = published(spark, root).count()
    assert len(remove_replaced(spark, root, now + timedelta(days=1))) == 2
    assert len(folders()) == 2 and published(spark, root).count() == before and ids(published(spark, root)) == ["1", "2"]
    assert published(spark, root, "error/files").count() == 0 and states(spark, root)["run"] == "failed"
    assert remove_replaced(spark, root, now + timedelta(days=1)) == []
    assert remove_replaced(spark, str(tmp_path / "none"), now) == []


def test_warehouse_is_loaded_once(spark, landing, again, golden, tmp_path):
    prefix = f"wh_{uuid.uuid4().hex}"

    def table():
        return sorted(tuple(r) for r in spark.table(f"{prefix}_allergy").select("patient_id", "load_key").collect())

    for date in (DAY, "2015-09-02"):
        landing.entity("416", date, "allergy", A_TITLES, A_TYPES, [[date[-1], "n", "1"], ["x", "n", "1"]])
    for date in (DAY, "2015-09-02", DAY):
        again(date, kind="path", warehouse=prefix)
    first, second = (f"path|{landing.source}|{d}|*|False|drop" for d in (DAY, "2015-09-02"))
    assert table() == [("1", first), ("2", second), ("x", first), ("x", second)]
    rows = spark.table(f"{prefix}_allergy")
    assert rows.select("run_id").distinct().count() == 2 and rows.where("load_ts is null").isEmpty()
    (landing.root / "data/416/feed/finished" / DAY / NAME.format("416")).unlink()
    again(DAY, kind="path", warehouse=prefix)
    assert table() == [("2", second), ("x", second)]
    spark.sql(f"DROP TABLE {prefix}_allergy")


def test_the_query_loads_every_file_of_a_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exports, "ROWS_PER_FILE", 50)
    i, years = F.col("id"), F.array(F.lit(1995), F.lit(1995), F.lit(1999), F.lit(2000))
    orders = spark.range(0, 1500, 1, 1).select(
        i.alias("o_orderkey"),
        (i % 7).alias("o_custkey"),
        F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (i % 3 + 1).cast("int")).alias("o_orderstatus"),
        F.when(i % 11 == 0, 100.25).otherwise(30000.5 + i).alias("o_totalprice"),
        F.make_timestamp(F.element_at(years, (i % 4 + 1).cast("int")), F.lit(3), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("o_orderdate"),
        F.concat((i % 5 + 1).cast("string"), F.lit("-X")).alias("o_orderpriority"),
    )
    # keys that repeat, and rows without a date or a priority, which belong to no place
    orders = orders.unionByName(orders.where("o_orderkey < 100"))
    for column in ("o_orderdate", "o_orderpriority"):
        orders = orders.unionByName(orders.limit(20).withColumn(column, F.lit(None).cast(orders.schema[column].dataType)))
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    found = {(r["part"], r["what"]): r["n"] for r in queries.published_runs(spark, str(tmp_path)).collect()}
    wanted = spark.read.parquet(f"{tmp_path}/orders.parquet").where("year(o_orderdate) < 2000 and substr(o_orderpriority, 1, 1) in ('1', '3')")
    assert found["rows", "ok"] + found["rows", "bad_arity"] == wanted.count() > 400
    n_files = wanted.groupBy("o_orderpriority", F.year("o_orderdate")).agg(F.ceil(F.count(F.lit(1)) / 50).alias("n")).agg(F.sum("n")).first()[0]
    assert found["rows", "file"] - found["files", "schema_mismatch"] == n_files > 4
    assert found["missing", ""] == 6  # one a place
    db = duckdb.connect()
    db.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    sql = ORACLES["published_runs"].replace("1000000", "50")
    assert found == {(part, what): n for part, what, n in db.execute(sql).fetchall()}
