"""Where a load goes: landed rows, rejected files, run records, the warehouse."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.rows import with_audit
from feedlake.functions.text import US, split_fields
from feedlake.operators.rows import FILE_RECORD

SMALL_FILE_BYTES = 16 << 20
OPEN_FOLDERS = 32
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_folders(spark: SparkSession):
    """Writes inside keep a file open in each folder of a task, instead of sorting its rows by folder first.

    A sort holds all rows of the task, whose files repeat their path in every row, at many times their size on disk.
    What goes to more folders than ``OPEN_FOLDERS`` is sorted as before.
    """
    return _set(spark, _WRITERS, str(OPEN_FOLDERS))


def wants_compaction(files: DataFrame) -> bool:
    """Many tiny input files would become as many tiny output files."""
    size = files.agg(F.avg("file_size")).first()[0]
    return size is not None and size < SMALL_FILE_BYTES


def output_lines(rows: DataFrame) -> DataFrame:
    """(verdict, entity, value): rows as text lines with their audit fields.

    The line of a rejected file is its path and the reason; accepted files leave none.
    """
    value = F.when(
        F.col("verdict") == FILE_RECORD,
        F.concat_ws(US, "file_path", "file_verdict"),
    ).otherwise(with_audit(F.col("line"), F.col("job_id"), F.col("source_file")))
    return rows.where((F.col("verdict") != FILE_RECORD) | (F.col("file_verdict") != "ok")).select(
        "verdict", "entity", value.alias("value")
    )


def write_rows(rows: DataFrame, path: str, fmt: str = "parquet", compact: bool = False) -> None:
    """One pass over the input; folders by verdict and entity, replaced on every run.

    Without ``compact`` there is no shuffle: a file holds one entity, so tasks already write few
    folders. With it, AQE rebalances the folders and splits the big ones. Rows are not sorted in either case.
    """
    out = output_lines(rows) if fmt == "text" else rows
    if compact:
        out = out.hint("rebalance", F.col("verdict"), F.col("entity"))
    with open_folders(rows.sparkSession):
        out.write.mode("overwrite").partitionBy("verdict", "entity").format(fmt).save(path)


def rejected_files(landed: DataFrame, run_id: str) -> DataFrame:
    return landed.where(
        (F.col("verdict") == FILE_RECORD) & (F.col("file_verdict") != "ok")
    ).select("file_path", F.col("file_verdict").alias("reason"), F.lit(run_id).alias("run_id"))


def write_text(rows: DataFrame, path: str) -> None:
    rows.select("value").write.mode("overwrite").text(path)


def typed_view(landed: DataFrame, golden: DataFrame, entity: str) -> DataFrame:
    """Accepted rows of one entity with a column per golden title; empty text becomes null."""
    titles = [
        r["column_name"]
        for r in golden.where(F.col("entity") == entity.lower())
        .groupBy("column_name")
        .agg(F.min("column_id").alias("column_id"))
        .orderBy("column_id", "column_name")
        .collect()
    ]
    rows = landed.where((F.col("verdict") == "ok") & (F.col("entity") == entity.lower()))
    return rows.withColumn("fields", split_fields(F.col("line"))).select(
        *[F.nullif(F.get("fields", F.lit(i)), F.lit("")).alias(t) for i, t in enumerate(titles)],
        "load_flag",
        "job_id",
        "source_file",
    )


def load_warehouse(df: DataFrame, table: str, jdbc: dict[str, str] | None = None) -> None:
    """Append to a warehouse table over JDBC, or to a table of Spark's own catalog."""
    if jdbc is None:
        df.write.mode("append").saveAsTable(table)
    else:
        df.write.format("jdbc").options(**jdbc).option("dbtable", table).mode("append").save()


def load_warehouse_once(df: DataFrame, table: str, key: str, run_id: str, loaded_at: datetime, path: str | None = None) -> None:
    """Put the rows of one load into a table of Spark's own catalog in place of those of its last run.

    The table has a partition per load key; run_id and load_ts tell where a row comes from. Spark stages the
    new partition and moves it into place when the job commits, so a repeat doubles nothing. ``path`` makes a
    new table external.
    """
    spark = df.sparkSession
    rows = df.withColumns({"run_id": F.lit(run_id), "load_ts": F.lit(loaded_at).cast("timestamp"), "load_key": F.lit(key)})
    if not spark.catalog.tableExists(table):
        empty = rows.limit(0).write.partitionBy("load_key")
        (empty.option("path", path) if path else empty).saveAsTable(table)
    if df.isEmpty():
        literal = key.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (load_key = '{literal}')")
        return
    columns = spark.table(table).columns
    with _set(spark, _OVERWRITE, "dynamic"), open_folders(spark):
        rows.select(*columns).write.mode("overwrite").insertInto(table)


def append_status(
    spark: SparkSession, path: str, job_id: str, facility: str, source: str, stage: str, state: str, message: str
) -> None:
    row = spark.createDataFrame(
        [(job_id, facility, source, stage, state, message)],
        "job_id string, facility string, source string, stage string, state string, message string",
    )
    row.withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path)


def append_work(spark: SparkSession, path: str, job_id: str, facility: str, source: str, event: str) -> None:
    row = spark.createDataFrame(
        [(job_id, facility, source, event)],
        "job_id string, facility string, source string, event string",
    )
    row.withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path)
