"""Golden schema from the warehouse catalog."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedlake.functions.text import normalise_title

# Fixed values of the catalog comments.
SKIPPED_COMMENTS = ("Ignore", "ETL")
PERSONAL_COMMENT = "remove"

_ID_RANGE = 100_000


def jdbc_options(url: str, user: str | None = None, driver: str | None = None) -> dict[str, str]:
    """Connection options; the password comes from the environment, never from arguments."""
    options = {"url": url}
    if user:
        options["user"] = user
    if driver:
        options["driver"] = driver
    if os.environ.get("FEEDLAKE_JDBC_PASSWORD"):
        options["password"] = os.environ["FEEDLAKE_JDBC_PASSWORD"]
    return options


def warehouse_query(spark: SparkSession, sql: str, jdbc: dict[str, str] | None = None) -> DataFrame:
    """Run a statement in the warehouse, or against Spark's own tables without JDBC options."""
    if jdbc is None:
        return spark.sql(sql)
    return spark.read.format("jdbc").options(**jdbc).option("query", sql).load()


def golden_schema(columns: DataFrame, database: str | None = None) -> DataFrame:
    """(entity, column_id, column_name, comment) of the columns that a feed must carry.

    ``columns`` has tablename, columntitle, columnid, commentstring and, when ``database`` is
    given, databasename.
    """
    comment = F.coalesce("commentstring", F.lit(""))
    kept = columns.where(
        (F.lower("tablename") == F.col("tablename"))
        & ~comment.isin(*SKIPPED_COMMENTS)
        & (F.coalesce("columntitle", F.lit("")) != "")
    )
    if database is not None:
        kept = kept.where(F.col("databasename") == database)
    return kept.select(
        F.lower("tablename").alias("entity"),
        F.col("columnid").cast("bigint").alias("column_id"),
        normalise_title(F.col("columntitle")).alias("column_name"),
        F.col("commentstring").alias("comment"),
    )


def with_ordinal(golden: DataFrame) -> DataFrame:
    """Position of every column in its entity, from 0, in the order of column ids.

    Ids are cut into ranges; rows are numbered inside a range and ranges are offset by the counts
    before them, so that no task ever sorts a whole entity.
    """
    ranged = golden.withColumn("id_range", F.floor(F.col("column_id") / _ID_RANGE))
    order = ["column_id", "column_name"]
    inside = F.row_number().over(W.partitionBy("entity", "id_range").orderBy(*order))
    before = F.sum("n").over(
        W.partitionBy("entity").orderBy("id_range").rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = (
        ranged.groupBy("entity", "id_range")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("entity", "id_range", F.coalesce(before, F.lit(0)).alias("offset"))
    )
    return (
        ranged.withColumn("inside", inside)
        .join(offsets, ["entity", "id_range"])
        .withColumn("ordinal", (F.col("offset") + F.col("inside") - 1).cast("bigint"))
        .drop("id_range", "inside", "offset")
    )


def has_personal_data(golden: DataFrame) -> DataFrame:
    """(entity, has_pii): does any column of the entity carry the personal-data comment?"""
    flag = F.lower(F.coalesce("comment", F.lit(""))) == PERSONAL_COMMENT
    return golden.groupBy("entity").agg(F.bool_or(flag).alias("has_pii"))


def golden_by_entity(golden: DataFrame) -> DataFrame:
    """(entity, golden, golden_pii): one row per warehouse table, as wide as the table.

    A title that the catalog repeats keeps its first place, and is personal if any of its
    entries is.
    """
    flag = F.lower(F.coalesce("comment", F.lit(""))) == PERSONAL_COMMENT
    columns = golden.groupBy("entity", "column_name").agg(
        F.min("column_id").alias("column_id"), F.bool_or(flag).alias("pii")
    )
    ordered = F.array_sort(F.collect_list(F.struct("column_id", "column_name", "pii")))
    return columns.groupBy("entity").agg(ordered.alias("c")).select(
        "entity",
        F.col("c.column_name").alias("golden"),
        F.col("c.pii").alias("golden_pii"),
    )


def column_counts(columns: DataFrame, tables: DataFrame, database: str) -> DataFrame:
    """(tablename, n_columns) over catalog columns joined to catalog tables.

    Both sides are counted before they meet, so a wide table shuffles one row per task.
    """
    keys = ["databasename", "tablename"]
    per_table = (
        columns.where(~F.coalesce("commentstring", F.lit("")).isin(*SKIPPED_COMMENTS))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kept = (
        tables.where(
            (F.upper("databasename") == database.upper())
            & (F.coalesce("commentstring", F.lit("")) != SKIPPED_COMMENTS[0])
        )
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("m"))
    )
    return (
        per_table.join(kept, keys)
        .groupBy(F.upper("tablename").alias("tablename"))
        .agg(F.sum(F.col("n") * F.col("m")).alias("n_columns"))
    )
