"""Membership and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def allowed(df: DataFrame, key: Column, allow: DataFrame, column: str, keep: bool = True) -> DataFrame:
    """Rows whose key is (or, with ``keep=False``, is not) in the allow-list column.

    The planner picks the join by the sizes it knows; a hot key on the left only repeats a
    lookup, and AQE splits its partition when both sides have to be shuffled.
    """
    listed = allow.select(F.col(column).alias("_allowed"))
    return df.join(listed, key == F.col("_allowed"), "left_semi" if keep else "left_anti")


def for_entity(df: DataFrame, entity: Column, requested: str) -> DataFrame:
    """Rows of the requested entity in any case; ``*`` asks for all of them."""
    return df if requested == "*" else df.where(F.upper(entity) == requested.upper())


def on_date(date_of: Column, pattern: str) -> Column:
    """Feed date equal to the pattern, or starting with it when it ends in ``*``."""
    if pattern.endswith("*"):
        return date_of.startswith(pattern[:-1])
    return date_of == pattern


def facility_route(
    df: DataFrame, facility: Column, source: Column, division_ids: DataFrame, all_id: str = "9999"
) -> DataFrame:
    """Adds run_type (all | divisional | path) and run_source.

    ``*`` in the source becomes the facility id, except for the id that stands for all divisions.
    """
    listed = division_ids.select(F.col("org_id").alias("_division")).distinct()
    routed = df.join(listed, facility == F.col("_division"), "left")
    return routed.select(
        *df.columns,
        F.when(facility == all_id, "all")
        .when(F.col("_division").isNotNull(), "divisional")
        .otherwise("path")
        .alias("run_type"),
        F.when(facility == all_id, source)
        .otherwise(F.replace(source, F.lit("*"), facility))
        .alias("run_source"),
    )
