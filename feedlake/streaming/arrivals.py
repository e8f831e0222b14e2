"""Load what has arrived since the last run, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedlake.functions.paths import CONTROL_NAME, directory, literal_glob
from feedlake.operators.sinks import wants_compaction, write_rows
from feedlake.plans.ingest import AllowLists, directories_load, placed
from feedlake.plans.load import Rules

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def any_case(name: str) -> str:
    """Glob for a name in upper, lower or mixed case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in name)


def arrivals(spark: SparkSession, glob: str, max_controls: int = 1000) -> DataFrame:
    """Stream of (dir): directories whose control file has newly arrived.

    Senders put the control file last, so its presence means the directory is complete. Only
    file metadata is read. Its name counts in any case, as in a batch load, and its age does not
    matter.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", any_case(CONTROL_NAME))
        .option("maxFileAge", "36500d")
        .option("maxFilesPerTrigger", max_controls)
        .load(glob)
        .select(directory(F.col("path")).alias("dir"))
    )


def load_arrivals(
    spark: SparkSession,
    glob: str,
    lists: AllowLists,
    golden: DataFrame,
    out: str,
    checkpoint: str,
    rules: Rules = Rules(),
    max_controls: int = 1000,
) -> StreamingQuery:
    """Directory-driven load of the new directories below ``glob``, then stop.

    Each micro-batch holds at most ``max_controls`` directories and replaces its own
    ``batch={id}`` folder, so a batch that is repeated after a failure changes nothing.
    """

    rules = placed(rules, glob)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        dirs = [literal_glob(r["dir"]) for r in batch.distinct().collect()]
        if not dirs:
            return
        load = directories_load(session, dirs, lists, golden, rules)
        write_rows(load.rows, f"{out}/batch={batch_id}", compact=wants_compaction(load.files))

    return (
        arrivals(spark, glob, max_controls)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
