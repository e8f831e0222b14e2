"""Record-separated files as DataFrames.

Two scans cover every file exactly once, by size:

* files up to half of ``spark.sql.files.maxPartitionBytes`` are read whole, one row per file. The
  header stands in the same row as the data, so nothing has to be joined, and Spark packs many
  small files into a task;
* larger files are read as records and split as usual. A first pass counts the records of every
  block (split) and notes the row its partition has there first; the sum of the blocks before it gives
  every record its number in the file.

Which files are loaded is settled once, by the inventory: every scan probes a broadcast map of the
inventoried files, in slices of the inventory when the map is too large for one broadcast. What
arrives later is in no scan's result, and file contents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.functions.paths import directory, entity_of, file_kind, file_name, literal_glob, scanned_path
from feedlake.functions.text import HEADER_RECORDS, RS
from feedlake.scale import BROADCAST_BYTES, conf_bytes, literal_values, materialise, measured_bytes, shared_dir


def _meta(name: str) -> Column:
    return F.col(f"_metadata.{name}")


_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in its low 33 bits
_LISTING_TASKS = "2000"

INVENTORY = "file_path string, file_size long, modified timestamp, kind string"


def whole_file_bytes(spark: SparkSession) -> int:
    return conf_bytes(spark, "spark.sql.files.maxPartitionBytes", "128MB") // 2


def _text(spark: SparkSession, paths: Sequence[str], whole: bool) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    if whole:
        return reader.text(list(paths), wholetext=True)
    return reader.text(list(paths), lineSep=RS)


def _existing(read: Callable[[list[str]], DataFrame], paths: Sequence[str]) -> DataFrame | None:
    """Read paths and globs, leaving out those without a match; None if all are."""
    found = list(paths)
    while found:
        try:
            return read(found)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            if len(found) == 1:
                return None
        found = [p for p in found if _existing(read, [p]) is not None]
    return None


def _load(spark: SparkSession, paths: Sequence[str], whole: bool) -> DataFrame | None:
    return _existing(lambda found: _text(spark, found, whole), paths)


def inventory(spark: SparkSession, paths: Sequence[str], keep: Column | None = None) -> DataFrame:
    """Table of the files below the paths: path, size, time of change and kind.

    Only file metadata is read. The listing runs in a session of its own because it bounds the
    number of tasks, which must not change how the data scans are split. The result is written
    once and serves the whole load as one snapshot.
    """
    listing = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            listing.conf.set(key, value)
    listing.conf.set("spark.sql.files.maxPartitionNum", _LISTING_TASKS)
    reader = listing.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = _existing(reader.load, paths)
    if files is None:
        return spark.createDataFrame([], INVENTORY)
    if keep is not None:
        files = files.where(keep)
    target = shared_dir(spark)
    files.select(
        scanned_path().alias("file_path"),
        _meta("file_size").alias("file_size"),
        _meta("file_modification_time").alias("modified"),
        file_kind(scanned_path()).alias("kind"),
    ).write.parquet(target)
    return spark.read.schema(INVENTORY).parquet(target)


def small_files(spark: SparkSession, paths: Sequence[str], keep: Column) -> DataFrame | None:
    """(file_path, content) of the files that are read whole. ``keep`` may use ``_metadata`` only."""
    scan = _load(spark, paths, whole=True)
    if scan is None:
        return None
    return scan.where((_meta("file_size") <= whole_file_bytes(spark)) & keep).select(
        scanned_path().alias("file_path"), F.col("value").alias("content")
    )


def _below(folders: list[str]) -> list[str]:
    """Folders without those that stand below another one; globs take them literally."""
    kept: list[str] = []
    for folder in sorted(folders):
        if not (kept and folder.startswith(kept[-1])):
            kept.append(folder)
    return [literal_glob(f) for f in kept]


def places_of(files: DataFrame) -> tuple[list[str], str] | None:
    """Folders of the files and a glob for their names, None when there are too many.

    A scan that is narrowed this way needs no predicate on the path of every record.
    """
    path = F.col("file_path")
    folders = literal_values(files.select(directory(path).alias("dir")), "dir")
    prefixes = literal_values(files.select(entity_of(file_name(path)).alias("p")), "p")
    if not folders or not prefixes or any(re.search(r"[^\w.-]", p) for p in prefixes):
        return None
    return _below(folders), "{" + ",".join(sorted(prefixes)) + "}_*"


def large_file_records(
    spark: SparkSession, paths: Sequence[str], keep: Column, files: DataFrame | None = None
) -> DataFrame | None:
    """(file_path, block_start, value) of the records of large files.

    With ``files`` the scan covers their folders; it may still hold files that are not listed.
    """
    narrowed = places_of(files) if files is not None else None
    if narrowed is not None:
        reader = spark.read.option("recursiveFileLookup", "true")
        scan = reader.text(narrowed[0], lineSep=RS, pathGlobFilter=narrowed[1])
        keep = F.lit(True)
    else:
        scan = _load(spark, paths, whole=False)
    if scan is None:
        return None
    return scan.where((_meta("file_size") > whole_file_bytes(spark)) & keep).select(
        scanned_path().alias("file_path"),
        _meta("file_block_start").alias("block_start"),
        "value",
    )


def _placed(records: DataFrame) -> DataFrame:
    """Adds the partition and the row in it, as of this frame."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    return records.select("file_path", "block_start", F.spark_partition_id().alias("part"), row.alias("part_row"), "value")


def block_numbers(records: DataFrame) -> DataFrame:
    """(file_path, block_start, first_part, first_row, n, before): the records of each block, and those before it.

    One row per block, some tens of bytes for each split. A block is read by one task in a row.
    """
    blocks = materialise(
        records.groupBy("file_path", "block_start").agg(
            F.min("part").alias("first_part"), F.min("part_row").alias("first_row"), F.count(F.lit(1)).alias("n")
        )
    )
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))


def numbered(records: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(file_path, record_no, value) of all records of some large files, numbered from 0 in each file.

    The records are counted in a pass of their own over the same files in the same splits. A split that
    is read elsewhere than it was counted fails the load instead of giving wrong numbers.
    """
    records = _placed(records)
    told = probe(records, materialise(block_numbers(records)), limit, also=["block_start"])
    moved = (F.col("part") != F.col("first_part")) | (F.col("part_row") - F.col("first_row") >= F.col("n"))
    number = F.when(moved, F.raise_error(F.lit("a file was split anew while it was loaded")).cast("bigint")).otherwise(
        F.col("before") + F.col("part_row") - F.col("first_row")
    )
    return told.select("file_path", number.alias("record_no"), "value")


def probe(scan: DataFrame, per_file: DataFrame, limit: int = BROADCAST_BYTES, also: Sequence[str] = ()) -> DataFrame:
    """The rows of the scan whose file is in ``per_file``, with the columns that it has of the file.

    ``per_file`` has one row per file_path (and per ``also``) and is broadcast under 128 bits of hash in
    place of the path. If it is larger than ``limit``, the files go in slices by hash: each slice scans
    its own files alone. The scan itself is never shuffled.
    """
    path = F.col("file_path")
    keys = {"_path1": F.xxhash64(path), "_path2": F.xxhash64(F.lit(1), path)}
    table = per_file.withColumns(keys).drop("file_path")
    slices = max(1, -(-measured_bytes(table) // limit))
    slice_of = F.pmod(F.xxhash64(F.lit(2), path), F.lit(slices))
    parts = []
    for k in range(slices):
        own = per_file.where(slice_of == k).withColumns(keys).drop("file_path") if slices > 1 else table
        rows = scan.where(slice_of == k) if slices > 1 else scan
        parts.append(rows.withColumns(keys).join(F.broadcast(own), [*keys, *also]).drop(*keys))
    return reduce(DataFrame.unionByName, parts)


def with_header(files: DataFrame) -> DataFrame:
    """Small files as (file_path, titles, types, body); missing parts are null."""
    parts = F.split("content", RS, HEADER_RECORDS + 1)
    return files.withColumn("parts", parts).select(
        "file_path",
        F.get("parts", F.lit(0)).alias("titles"),
        F.get("parts", F.lit(1)).alias("types"),
        F.get("parts", F.lit(HEADER_RECORDS)).alias("body"),
    )


def data_records(spark: SparkSession, paths: Sequence[str], keep: Column, files: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(file_path, record_no, value): the records after the header of the inventoried ``files``, of any size."""
    small = small_files(spark, paths, keep)
    if small is None:
        return spark.createDataFrame([], "file_path string, record_no bigint, value string")
    whole = probe(small, files.where(F.col("file_size") <= whole_file_bytes(spark)).select("file_path"), limit)
    body = F.posexplode(F.split("body", RS, -1)).alias("record_no", "value")
    records = with_header(whole).select("file_path", body).withColumn("record_no", F.col("record_no").cast("bigint") + HEADER_RECORDS)
    big = files.where(F.col("file_size") > whole_file_bytes(spark)).select("file_path")
    if big.isEmpty():
        return records
    large = numbered(probe(large_file_records(spark, paths, keep), big, limit), limit)
    return records.unionByName(large.where(F.col("record_no") >= HEADER_RECORDS))


# -- headers of large files ---------------------------------------------------------------------

_OPENS_PER_TASK = 32
_CHUNK = 1 << 16
_HEAD_LIMIT = 16 << 20


def head_reader(separator: bytes = RS.encode(), chunk: int = _CHUNK, limit: int = _HEAD_LIMIT):
    """Function for mapInPandas: first two records of every file in ``file_path``.

    Nulls where the file cannot be opened from Python or has no two records near its start.
    It is a closure, so executors need nothing but pandas and pyarrow.
    """

    def first_two(path):
        import re
        from urllib.parse import quote, unquote

        from pyarrow import fs

        scheme, rest = re.fullmatch(r"(?s)(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)", path).groups()
        head = b""
        try:
            if scheme in (None, "file"):
                system, inner = fs.LocalFileSystem(), re.sub("^//[^/]*", "", rest)
                if system.get_file_info(inner).type == fs.FileType.NotFound:  # given percent-escaped
                    inner = unquote(inner)
            else:
                scheme = "s3" if scheme in ("s3a", "s3n") else scheme
                system, inner = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe="/:@!$&'()*+,;=~")}")
            with system.open_input_stream(inner) as stream:
                while head.count(separator) < 2 and len(head) < limit:
                    block = stream.read(chunk)
                    if not block:
                        break
                    head += block
        except PermissionError:
            raise
        except (OSError, ValueError, NotImplementedError):  # a store, or credentials, that only Spark has
            return None, None
        parts = head.split(separator)
        if len(parts) < 3:
            return None, None
        return parts[0].decode("utf-8", "replace"), parts[1].decode("utf-8", "replace")

    def read(batches):
        for batch in batches:
            heads = [first_two(path) for path in batch["file_path"]]
            batch["titles"] = [h[0] for h in heads]
            batch["types"] = [h[1] for h in heads]
            yield batch

    return read


def large_file_headers(spark: SparkSession, files: DataFrame, paths: Sequence[str], keep: Column) -> DataFrame:
    """(file_path, titles, types) for the large files of an inventory.

    The tasks read the first bytes of each file, so the header pass costs a few kilobytes per
    file instead of a second scan. Files that cannot be opened that way are found by the record
    scan. A file without a header keeps null titles and is rejected later.
    """
    wanted = files.where(F.col("file_size") > whole_file_bytes(spark)).select("file_path")
    tasks = max(1, min(4 * spark.sparkContext.defaultParallelism, wanted.count() // _OPENS_PER_TASK))
    heads = materialise(
        wanted.repartition(tasks).mapInPandas(
            head_reader(), "file_path string, titles string, types string"
        )
    )
    missing = heads.where(F.col("titles").isNull()).select("file_path")
    if missing.isEmpty():
        return heads
    records = numbered(probe(large_file_records(spark, paths, keep, missing), missing))
    scanned = records.where(F.col("record_no") < 2).groupBy("file_path").agg(
        F.max(F.when(F.col("record_no") == 0, F.col("value"))).alias("titles"),
        F.max(F.when(F.col("record_no") == 1, F.col("value"))).alias("types"),
    )
    return heads.where(F.col("titles").isNotNull()).unionByName(
        missing.join(scanned, "file_path", "left")
    )


