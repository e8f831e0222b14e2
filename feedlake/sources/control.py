"""Control files: one line that names the facility, the dates, the job and the source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.manifest import CONTROL_FIELDS, control_entry
from feedlake.functions.paths import CONTROL_NAME, directory, file_kind, file_name, scanned_path
from feedlake.functions.text import RS, control_to_fields
from feedlake.sources.framed import probe


def first_lines(lines: DataFrame) -> DataFrame:
    """First line per file from (file_path, position, value); combines before the shuffle."""
    return lines.groupBy("file_path").agg(F.min_by("value", "position").alias("line"))


def control_table(
    spark: SparkSession, paths: Sequence[str], job_field: int = 3, files: DataFrame | None = None
) -> DataFrame:
    """(dir, facility, from_date, to_date, job_id, path), one row per directory.

    With ``files``, an inventory, no other file counts.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(list(paths)).where(
        F.upper(file_name(scanned_path())) == CONTROL_NAME
    ).select(
        scanned_path().alias("file_path"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("position"),
        "value",
    )
    if files is not None:
        lines = probe(lines, files.select("file_path"))
    entry = control_entry(F.col("line"), job_field)
    return (
        first_lines(lines)
        .select(directory(F.col("file_path")).alias("dir"), entry.alias("c"))
        .groupBy("dir")
        .agg(F.min("c").alias("c"))
        .select("dir", *[f"c.{name}" for name in CONTROL_FIELDS])
    )


def control_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_path, value): control records with the feed's field separator."""
    scan = spark.read.option("recursiveFileLookup", "true").text(list(paths), lineSep=RS)
    return scan.where(file_kind(scanned_path()) == "control").select(
        scanned_path().alias("file_path"), control_to_fields(F.col("value")).alias("value")
    )
