"""Allow-lists of divisions, practices and entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.text import CONTROL_SEP, upper_prefix


def division_id(line: Column) -> Column:
    """First field, case kept."""
    return F.substring_index(line, CONTROL_SEP, 1)


def practice_id(line: Column) -> Column:
    """Text before the separator, upper-cased. Names after it are never parsed."""
    return upper_prefix(line, CONTROL_SEP)


def entity_name(line: Column) -> Column:
    return F.upper(line)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.col("value") != "")


def divisions(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).select(division_id(F.col("value")).alias("org_id")).distinct()


def practices(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).select(practice_id(F.col("value")).alias("practice_id")).distinct()


def entities(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).select(entity_name(F.col("value")).alias("entity")).distinct()
