"""From a set of landing files to routed rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.paths import Layout, directory, entity_of, file_kind, file_name, scanned_path
from feedlake.functions.rows import LOAD_FLAG
from feedlake.operators.joins import with_job_id
from feedlake.operators.rows import route
from feedlake.operators.schema import LAYOUT_COLUMNS, WIDE_COLUMNS, resolve_layout
from feedlake.scale import BROADCAST_BYTES, fits_broadcast, literal_values, materialise
from feedlake.sources.catalog import golden_by_entity
from feedlake.sources.framed import (
    large_file_headers,
    large_file_records,
    numbered,
    probe,
    small_files,
    whole_file_bytes,
    with_header,
)
from feedlake.functions.text import HEADER_RECORDS, RS

ROUTED_COLUMNS = (
    "verdict",
    "entity",
    "line",
    "n_fields",
    "load_flag",
    "job_id",
    "source_file",
    "file_path",
    "org_id",
    "feed_date",
    "file_verdict",
    "extra_columns",
    "record_no",
)

ROUTED_SCHEMA = (
    "verdict string, entity string, line string, n_fields int, load_flag string, "
    "job_id string, source_file string, file_path string, org_id string, feed_date string, "
    "file_verdict string, extra_columns array<string>, record_no bigint"
)


@dataclass(frozen=True)
class Rules:
    """How rows are judged. ``validate`` turns the numeric check on."""

    entity: str = "*"
    validate: bool = False
    pii_extra_columns: str = "drop"
    job_field: int = 3
    layout: Layout = field(default_factory=Layout)


def path_is_in(column: Column, allow: DataFrame, name: str) -> Column | None:
    """Predicate over ``_metadata`` for a small allow-list; Spark prunes files with it."""
    values = literal_values(allow, name)
    return None if values is None else column.isin(values)


def _described(df: DataFrame, rules: Rules) -> DataFrame:
    """Adds what the path says about a file."""
    path = F.col("file_path")
    return df.select(
        "*",
        F.lower(entity_of(file_name(path))).alias("entity"),
        file_name(path).alias("source_file"),
        rules.layout.org_id(path).alias("org_id"),
        rules.layout.feed_date(path).alias("feed_date"),
    )


def _finished(records: DataFrame, rules: Rules) -> DataFrame:
    is_file = F.col("value").isNull()
    return (
        route(records, rules.validate, rules.pii_extra_columns, wide=True)
        .withColumn("load_flag", F.when(~is_file, LOAD_FLAG))
        .withColumn("file_verdict", F.when(is_file, F.col("file_verdict")))
        .withColumn("extra_columns", F.when(is_file, F.col("extra_columns")))
        .withColumn("record_no", F.when(~is_file, F.col("record_no")))
        .select(*ROUTED_COLUMNS)
    )


def routed_rows(
    spark: SparkSession,
    paths: Sequence[str],
    keep: Column,
    files: DataFrame,
    golden: DataFrame,
    controls: DataFrame,
    rules: Rules,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Routed rows of the data files ``files``, an inventory of exactly the files to load.

    ``keep`` prunes files from the metadata alone and may let through more than the inventory has;
    ``probe`` leaves out the rest. What is known of a file (its job, its catalog columns or its layout) is
    worked out on the inventory and comes with the probe.

    Every file adds one record with the verdict ``file``. It carries file_verdict, the reason
    why the file was rejected or ``ok``, and the columns the catalog does not know. Other records have
    ``record_no``, their number in the file from 0, the header's records counted.
    """
    tables = materialise(golden_by_entity(golden))
    keep = keep & (file_kind(scanned_path()) == "data")
    apart = fits_broadcast(tables, broadcast_bytes)  # one copy of the catalog serves all files
    described = with_job_id(_described(files, rules), directory(F.col("file_path")), controls.select("dir", "job_id"))
    known = ["file_path", "file_size", "job_id"]
    listed = materialise(described.select(*known) if apart else described.join(tables, "entity", "left").select(*known, *(c for c in tables.columns if c != "entity")))

    def prepared(df: DataFrame) -> DataFrame:
        told = _described(df, rules)
        return resolve_layout(told.join(F.broadcast(tables), "entity", "left") if apart else told)

    small = small_files(spark, paths, keep)
    if small is None:
        return spark.createDataFrame([], ROUTED_SCHEMA)
    is_small = F.col("file_size") <= whole_file_bytes(spark)
    bodies = prepared(probe(with_header(small), listed.where(is_small).drop("file_size"), broadcast_bytes)).withColumn(
        "records",
        F.when(
            (F.col("file_verdict") == "ok") & F.col("body").isNotNull(),
            F.split("body", RS, -1),
        ).otherwise(F.array().cast("array<string>")),
    )
    file_record = F.array(F.lit(None).cast("string"))
    records = bodies.select("*", F.posexplode(F.concat(file_record, "records")).alias("at", "value")).withColumn(
        "record_no", F.col("at").cast("bigint") + (HEADER_RECORDS - 1)
    )
    routed = _finished(records.drop("body", "records"), rules)

    big = listed.where(~is_small)
    if big.isEmpty():
        return routed
    heads = large_file_headers(spark, big, paths, keep).join(big, "file_path")
    signature = F.concat_ws(
        RS,
        entity_of(file_name(F.col("file_path"))),
        F.coalesce("titles", F.lit("")),
        F.coalesce("types", F.lit("")),
    )
    headers = materialise(prepared(heads.withColumn("layout_id", F.md5(signature))))
    good = headers.where(F.col("file_verdict") == "ok")
    columns = [*LAYOUT_COLUMNS, *WIDE_COLUMNS]
    by_file = ["file_path", "job_id", "entity", "source_file", "org_id", "feed_date"]
    layouts = good.dropDuplicates(["layout_id"]).select("layout_id", *columns)
    records = probe(large_file_records(spark, paths, keep, big), good.select("file_path"), broadcast_bytes)
    records = numbered(records, broadcast_bytes).where(F.col("record_no") >= HEADER_RECORDS)
    if fits_broadcast(layouts, broadcast_bytes):
        split = probe(records, good.select(*by_file, "layout_id"), broadcast_bytes).join(F.broadcast(layouts), "layout_id")
    else:
        split = probe(records, good.select(*by_file, *columns), broadcast_bytes)
    per_file = headers.select("*", F.lit(None).cast("string").alias("value"), F.lit(None).cast("bigint").alias("record_no"))
    return routed.unionByName(_finished(split, rules)).unionByName(
        _finished(per_file, rules)
    )
