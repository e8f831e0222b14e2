"""What one task of a registered query holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.plans import queries


def test_numbers_are_counted_in_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_TASK", 100)
    rows = spark.range(0, 5000, 1, 1).select(F.lit("1").alias("org_id"), (F.col("id") % 2500).alias("record_no"))
    spread = queries._spread(rows, "org_id", "record_no")
    sizes = spread.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("record_no").alias("d"))
    found = sizes.collect()
    assert sum(r["n"] for r in found) == 5000 and sum(r["d"] for r in found) == 2500  # equal numbers together
    assert len(found) > 40 and max(r["n"] for r in found) < 200
    assert queries._spread(rows.limit(0), "org_id").count() == 0


def test_customers_of_a_nation_come_in_a_row(spark, tmp_path):
    rows = spark.range(0, 2000, 1, 1).select(
        F.col("id").alias("c_custkey"),
        F.concat(F.lit("Customer "), "id").alias("c_name"),
        (F.col("id") % 20).cast("int").alias("c_nationkey"),
        F.when(F.col("id") % 7 > 0, F.lit(1.5)).alias("c_acctbal"),
        F.lit("BUILDING").alias("c_mktsegment"),
    )
    once_and_twice = rows.unionByName(rows.where("c_custkey < 100")).unionByName(rows.limit(3).withColumn("c_custkey", F.lit(None).cast("bigint")))
    once_and_twice.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    found = queries._customer_records(spark, str(tmp_path)).select(F.spark_partition_id(), "org_id", "c_custkey").collect()
    assert len(found) == 2103
    changes = sum(a[:2] != b[:2] for a, b in zip(found, found[1:]))
    assert changes < 20 * len({r[0] for r in found})
