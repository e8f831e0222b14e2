"""Manifest and control records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.text import CONTROL_SEP, US, clean_record, split_fields

CONTROL_FIELDS = ("facility", "from_date", "to_date", "job_id", "path")


def manifest_line(value: Column) -> Column:
    return clean_record(F.regexp_replace(value, r"^\s+", ""))


def manifest_entry(value: Column) -> Column:
    """Struct(file_name, entity, practice_id, row_count, status) of one manifest record.

    status: ok | single_field | bad_count | zero_rows | bad_name. A bad count or name only
    marks its own record; the load goes on.
    """
    line = manifest_line(value)
    fields = split_fields(F.rtrim(line, F.lit(US)))
    count = F.get(fields, 1).try_cast("bigint")
    name = F.regexp_extract(line, r"(?s)^(.*?\.asv)", 1)
    stem = F.substring_index(name, ".asv", 1)
    status = (
        F.when(F.size(fields) < 2, "single_field")
        .when(count.isNull(), "bad_count")
        .when(count <= 0, "zero_rows")
        .when((name == "") | ~F.contains(stem, F.lit("_")), "bad_name")
        .otherwise("ok")
    )
    return F.struct(
        name.alias("file_name"),
        F.substring_index(stem, "_", 1).alias("entity"),
        F.substring_index(stem, "_", -1).alias("practice_id"),
        count.alias("row_count"),
        status.alias("status"),
    )


def control_entry(line: Column, job_field: int = 3) -> Column:
    """Struct of the control line; ``job_field`` is the position that holds the job id."""
    parts = F.split(line, CONTROL_SEP, -1)
    cols = [
        F.coalesce(F.get(parts, job_field if name == "job_id" else i), F.lit("")).alias(name)
        for i, name in enumerate(CONTROL_FIELDS)
    ]
    return F.struct(*cols)
