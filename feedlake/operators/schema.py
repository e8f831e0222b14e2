"""File header against golden schema: one verdict and one set of positions per file layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.header import (
    golden_positions,
    needs_reorder,
    normalise_all,
    number_positions,
)
from feedlake.functions.rows import (
    all_fields_pattern,
    golden_text,
    numbers_pattern,
    source_pattern,
    source_text,
)
from feedlake.functions.text import header_fields

FILE_VERDICTS = ("bad_header", "no_golden_schema", "schema_mismatch")

LAYOUT_COLUMNS = (
    "file_verdict",
    "width",
    "has_pii",
    "extra_columns",
    "accept_pattern",
    "accept_text",
    "source_pattern",
    "source_text",
    "number_pattern",
)
WIDE_COLUMNS = ("positions", "golden_pii", "source_known", "source_pii", "numeric")


def match_counts(df: DataFrame) -> DataFrame:
    """Adds n_matched and n_golden from ``names`` (normalised) and ``golden``."""
    return df.withColumn("n_matched", F.size(F.array_intersect("names", "golden"))).withColumn(
        "n_golden", F.size(F.array_distinct("golden"))
    )


def resolve_layout(headers: DataFrame) -> DataFrame:
    """Adds the layout columns to rows with titles, types, golden and golden_pii.

    A file is rejected when it has no usable header, when the catalog does not know its entity,
    or when a golden column is missing. Extra columns are allowed and listed. The accept columns
    are null when rows can stay as they are, the source columns when no data is personal.
    The width of a file does not matter: beyond ``WIDE`` columns rows go by the array columns.
    """
    names, golden = F.col("names"), F.col("golden")
    base = headers.withColumn("names", normalise_all(header_fields(F.col("titles")))).withColumn(
        "type_names", header_fields(F.col("types"))
    )
    verdict = (
        F.when(golden.isNull() | (F.size(golden) == 0), "no_golden_schema")
        .when(F.coalesce(F.size("type_names") < F.size(names), F.lit(True)), "bad_header")
        .when(F.col("n_matched") < F.col("n_golden"), "schema_mismatch")
    )
    source_pii = F.transform(
        names,
        lambda n: F.coalesce(
            F.get(F.col("golden_pii"), F.array_position(golden, n).cast("int") - 1), F.lit(False)
        ),
    )
    numeric = F.filter(
        number_positions(F.col("type_names")),
        lambda i: ~F.coalesce(F.get(F.col("source_pii"), i), F.lit(False)),
    )
    pii = F.col("has_pii")
    moved = F.col("reorder") | pii
    return (
        match_counts(base)
        .withColumn("file_verdict", verdict.otherwise("ok"))
        .withColumn("width", F.size(names))
        .withColumn("reorder", needs_reorder(names, golden))
        .withColumn("has_pii", F.exists("golden_pii", lambda p: p))
        .withColumn("positions", golden_positions(names, golden))
        .withColumn("source_known", F.transform(names, lambda n: F.array_contains(golden, n)))
        .withColumn("source_pii", source_pii)
        .withColumn("numeric", numeric)
        .withColumn("extra_columns", F.array_except(names, golden))
        .withColumn("accept_pattern", F.when(moved, all_fields_pattern(names)))
        .withColumn("accept_text", F.when(moved, golden_text(F.col("positions"), F.col("golden_pii"))))
        .withColumn("source_pattern", F.when(pii, source_pattern(F.col("source_known"), F.col("source_pii"))))
        .withColumn("source_text", F.when(pii, source_text(F.col("source_known"))))
        .withColumn("number_pattern", numbers_pattern(names, F.col("numeric")))
        .drop("names", "type_names", "n_matched", "n_golden", "golden", "titles", "types")
    )
