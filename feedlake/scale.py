"""Size checks in front of broadcasts, and where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 256 << 20
LITERAL_VALUES = 10_000

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def conf_bytes(spark: SparkSession, key: str, default: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", spark.conf.get(key, default).lower()).groups()
    return int(number) * _UNITS[unit]


def shared_dir(spark: SparkSession) -> str:
    """A new folder for intermediate tables below the cluster's ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master that has none configured.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="feedlake-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/feedlake-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back: a cut that outlives executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _width(field: T.DataType, column: Column) -> Column:
    if isinstance(field, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field, T.ArrayType):
        return F.aggregate(
            F.coalesce(column, F.array().cast(field)),
            F.lit(16).cast("long"),
            lambda total, item: total + _width(field.elementType, item),
        )
    if isinstance(field, T.StructType):
        total = F.lit(16)
        for f in field.fields:
            total = total + _width(f.dataType, column.getField(f.name))
        return total
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of the frame, summed over its rows by Spark."""
    total = F.lit(32)
    for field in df.schema.fields:
        total = total + _width(field.dataType, F.col(field.name))
    return df.select(F.coalesce(F.sum(total), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when the measured size allows it; otherwise the planner chooses."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def literal_values(df: DataFrame, column: str, limit: int = LITERAL_VALUES) -> list | None:
    """The distinct values of a small column for use in a pruning predicate, else None."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    return [r[0] for r in rows] if len(rows) <= limit else None
