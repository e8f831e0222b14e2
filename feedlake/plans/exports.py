"""Write a table as a landing tree of framed feed files.

Loads read such trees. Spark writes the files; the driver only gives them their feed names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.paths import CONTROL_NAME
from feedlake.functions.text import HEADER_RECORDS, RS, US
from feedlake.scale import broadcast_if_small, materialise, shared_dir

ROWS_PER_FILE = 1_000_000
_PLACE = ["org_id", "feed_date", "part"]


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _name_files(spark: SparkSession, staged: str, root: str, name: str) -> None:
    """Move ``org_id=…/feed_date=…/part=…/x.txt`` to the place and name a sender would use."""
    jvm, fs = _hadoop(spark, staged)
    path = jvm.org.apache.hadoop.fs.Path
    found = fs.globStatus(path(f"{staged}/*/*/*/*.txt"))
    made = set()
    for status in found:
        source = status.getPath()
        org, date, part = [s.split("=", 1)[1] for s in source.toString().split("/")[-4:-1]]
        folder = f"{root}/data/{org}/feed/finished/{date}"
        if folder not in made:
            fs.mkdirs(path(folder))
            made.add(folder)
        target = name.format(org=org, stamp=date.replace("-", "") + part.zfill(6))
        fs.rename(source, path(f"{folder}/{target}"))


def in_parts(rows: DataFrame) -> DataFrame:
    """Adds part: a place (org_id, feed_date) with many rows gets several files."""
    place = ["org_id", "feed_date"]
    counts = materialise(rows.groupBy(*place).agg(F.count(F.lit(1)).alias("n")))
    n_parts = F.ceil(F.col("n") / ROWS_PER_FILE)
    return rows.join(broadcast_if_small(counts), place).withColumn(
        "part", F.pmod(F.xxhash64("key"), n_parts).cast("int")
    )


def write_feed(
    rows: DataFrame, root: str, name: str, titles: Column | None = None, types: Column | None = None
) -> None:
    """Rows (org_id, feed_date, part, value) as one framed file per place and part below ``root``.

    ``titles`` and ``types`` may depend on the place; without them the files have no header.
    """
    spark = rows.sparkSession
    data = rows.select(*_PLACE, F.lit(HEADER_RECORDS).alias("rec"), "value")
    if titles is not None:
        header = F.array(titles, types, F.lit(""), F.lit(""))
        places = data.select(*_PLACE).distinct()
        data = data.unionByName(places.select(*_PLACE, F.posexplode(header).alias("rec", "value")))
    staged = shared_dir(spark)
    (
        data.repartition(*_PLACE)
        .sortWithinPartitions(*_PLACE, "rec")
        .select(*_PLACE, "value")
        .write.partitionBy(*_PLACE)
        .option("lineSep", RS + "\n")
        .text(staged)
    )
    _name_files(spark, staged, root, name)


def entity_name(entity: str) -> str:
    return entity + "_4.0_{stamp}_{org}.asv"


def write_controls(places: DataFrame, root: str, job_id: Column, name: str = CONTROL_NAME) -> None:
    """One control file for every (org_id, feed_date)."""
    lines = places.select(
        "org_id",
        "feed_date",
        F.lit(0).alias("part"),
        F.concat_ws(
            "~", "org_id", "feed_date", "feed_date", job_id, F.concat(F.lit("/data/"), "org_id")
        ).alias("value"),
    )
    write_feed(lines, root, name)


def write_manifest(places: DataFrame, root: str, division: str, entity: str) -> None:
    """A manifest per feed date under the division; ``places`` is (org_id, feed_date, part, n)."""
    stamp = F.concat(F.translate("feed_date", "-", ""), F.lpad(F.col("part").cast("string"), 6, "0"))
    name = F.concat(F.lit(entity + "_4.0_"), stamp, F.lit("_"), "org_id", F.lit(".asv"))
    lines = places.select(
        F.lit(division).alias("org_id"),
        "feed_date",
        F.lit(0).alias("part"),
        F.concat_ws(US, name, F.col("n").cast("string"), F.lit("h"), "feed_date").alias("value"),
    )
    titles = F.lit(US.join(["File", "Rows", "Hash", "Time"]))
    types = F.lit(US.join(["VARCHAR", "NUMBER", "VARCHAR", "VARCHAR"]))
    write_feed(lines, root, "Manifest_4.0_{stamp}_{org}.asv", titles, types)
