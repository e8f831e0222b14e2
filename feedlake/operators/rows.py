"""The row pipeline: one projection from raw record to routed row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.rows import (
    WIDE,
    blank_personal,
    field_count,
    numbers_ok,
    to_golden_order,
    wide_blank_personal,
    wide_golden_order,
    wide_numbers_ok,
)
from feedlake.functions.text import clean_record, is_blank, split_fields

ROW_VERDICTS = ("ok", "bad_arity", "bad_number")
FILE_RECORD = "file"


def route(
    records: DataFrame, validate: bool = False, pii_extra_columns: str = "drop", wide: bool = False
) -> DataFrame:
    """Adds verdict, n_fields and the output line to raw records with their layout.

    ``records`` has value and the layout columns. A null value is the record of the file itself:
    it gets the verdict ``file`` and no line. Blank records vanish. Accepted rows come out in
    catalog order, rejected ones in source order with personal data emptied.

    The width is compared on the raw fields. ``pii_extra_columns="reject"`` rejects all rows of
    a file that has both personal data and columns unknown to the catalog. ``wide`` also handles
    files of more than ``WIDE`` columns, whose ``WIDE_COLUMNS`` have to be there.
    """
    value, clean = F.col("value"), F.col("clean")
    rows = (
        records.where(value.isNull() | ~is_blank(value))
        .withColumn("clean", clean_record(value))
        .withColumn("n_fields", field_count(clean))
    )
    wrong_width = F.col("n_fields") != F.col("width")
    if pii_extra_columns == "reject":
        wrong_width = wrong_width | (F.col("has_pii") & (F.size("extra_columns") > 0))
    numbers = numbers_ok(clean, F.col("number_pattern"))
    accepted = F.when(F.col("accept_pattern").isNull(), clean).otherwise(
        to_golden_order(clean, F.col("accept_pattern"), F.col("accept_text"))
    )
    rejected = F.when(F.col("source_pattern").isNull(), clean).otherwise(
        blank_personal(clean, F.col("source_pattern"), F.col("source_text"))
    )
    if wide:
        is_wide, fields = F.col("width") > WIDE, F.col("wide_fields")
        rows = rows.withColumn("wide_fields", F.when(is_wide, split_fields(clean)))
        numbers = F.when(is_wide, wide_numbers_ok(fields, F.col("numeric"))).otherwise(numbers)
        moved = is_wide & F.col("accept_pattern").isNotNull()
        accepted = F.when(
            moved, wide_golden_order(fields, F.col("positions"), F.col("golden_pii"))
        ).otherwise(accepted)
        rejected = F.when(
            is_wide & F.col("has_pii"),
            wide_blank_personal(fields, F.col("source_known"), F.col("source_pii")),
        ).otherwise(rejected)
    verdict = F.when(clean.isNull(), FILE_RECORD).when(wrong_width, "bad_arity")
    if validate:
        verdict = verdict.when(~numbers, "bad_number")
    return rows.withColumn("verdict", verdict.otherwise("ok")).withColumn(
        "line", F.when(F.col("verdict") == "ok", accepted).otherwise(rejected)
    )
