"""What happened in a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.paths import entity_of, file_name
from feedlake.operators.rows import FILE_RECORD


def counts(rows: DataFrame) -> DataFrame:
    """(entity, verdict, n_rows); over landed tables this reads folder names and row counts."""
    return rows.groupBy("entity", "verdict").agg(F.count(F.lit(1)).alias("n_rows"))


MISSING, BAD_NAME = "missing_file", "bad_manifest_row"


def unloadable(missing_files: DataFrame, manifest_rejects: DataFrame) -> DataFrame:
    """(entity, verdict): a record for every file that is missing and every manifest record that names none."""
    entity = F.lower(entity_of(file_name(F.col("file_path"))))
    named = missing_files.select(entity.alias("entity"), F.lit(MISSING).alias("verdict"))
    return named.unionByName(manifest_rejects.select(F.lower("entity").alias("entity"), F.lit(BAD_NAME).alias("verdict")))


def outcome(rows: DataFrame, *by: str, others: DataFrame | None = None) -> DataFrame:
    """(entity, n_ok, n_rejected, n_rejected_files, n_missing_files, n_bad_manifest_rows, state) per entity, or
    per other columns; ``others`` are the records of ``unloadable``."""
    by = by or ("entity",)
    seen = rows.select(*by, "verdict", "file_verdict")
    if others is not None:
        seen = seen.unionByName(others.withColumn("file_verdict", F.lit(None).cast("string")))
    verdict = F.col("verdict")
    numbers = {
        "n_ok": verdict == "ok",
        "n_rejected": ~verdict.isin("ok", FILE_RECORD, MISSING, BAD_NAME),
        "n_rejected_files": (verdict == FILE_RECORD) & (F.col("file_verdict") != "ok"),
        "n_missing_files": verdict == MISSING,
        "n_bad_manifest_rows": verdict == BAD_NAME,
    }
    clean = sum((F.col(n) for n in list(numbers)[1:]), F.lit(0)) == 0
    counted = seen.groupBy(*by).agg(*(F.count_if(c).alias(n) for n, c in numbers.items()))
    return counted.withColumn("state", F.when(clean, "ok").otherwise("errors"))
