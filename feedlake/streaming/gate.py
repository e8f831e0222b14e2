"""Which directories and manifests may be loaded now, and loads of those that may, each exactly once.

Every poll looks at what is in the landing tree and at a ledger of what was done. Nothing is kept in the
driver between polls, a file's age does not matter, and markers that have gone count as gone.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.paths import CONTROL_NAME, directory, file_name, literal_glob, scanned_path
from feedlake.operators import audit, sinks
from feedlake.operators.filters import for_entity
from feedlake.operators.ledger import Ledger, file_system
from feedlake.plans.ingest import AllowLists, Load, _controls, directories_load, named_files, placed
from feedlake.plans.load import ROUTED_SCHEMA, Rules, routed_rows
from feedlake.scale import broadcast_if_small, materialise
from feedlake.sources.framed import INVENTORY, data_records, inventory
from feedlake.streaming.arrivals import any_case

WORKING_NAME = "WORKING.TXT"
FAILURE_NAME = "_FAILURE"

# A subject is a directory (its path ends in a slash) or a file. ``about`` is claim, load or note.
KEYS = ("subject", "about")
EVENTS = "subject string, about string, state string, run string, mark string, message string, at timestamp"


@dataclass(frozen=True)
class Patience:
    """How long data may lack a control file or a named file may be missing before it is reported, how
    long a claim counts, and how many directories or files one load takes."""

    late: timedelta = timedelta(hours=2)
    claim: timedelta = timedelta(hours=6)
    at_once: int = 1000


def ledger_of(spark: SparkSession, out: str) -> Ledger:
    return Ledger(spark, f"{out}/ledger", KEYS, EVENTS)


def markers(spark: SparkSession, glob: str) -> DataFrame:
    """Working and failure markers in the directories that the glob names, in the form of the inventory.

    Spark's own listing hides empty files and those whose name begins with an underscore.
    """
    path, fs = file_system(spark, glob)
    names = ((WORKING_NAME, "working"), (FAILURE_NAME, "failure"))
    found = [
        (s.getPath().toString(), s.getLen(), datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc), kind)
        for name, kind in names
        for s in fs.globStatus(path(f"{glob.rstrip('/')}/{any_case(name)}")) or ()
    ]
    return spark.createDataFrame(found, INVENTORY)


def directories(found: DataFrame) -> DataFrame:
    """(subject, working, control, failure, n_data, newest, mark): a directory's markers and what is in it.

    ``mark`` tells one set of files from another: it changes with any file's name, size or time of change.
    """
    name = F.upper(file_name(F.col("file_path")))
    marker = F.col("kind").isin("working", "failure")
    data = F.col("kind") == "data"
    counts = data | (name == CONTROL_NAME)
    return (
        found.where(data | marker | (F.col("kind") == "control"))
        .groupBy(directory(F.col("file_path")).alias("subject"))
        .agg(
            F.max(F.col("kind") == "working").alias("working"),
            F.max(name == CONTROL_NAME).alias("control"),
            F.max(F.col("kind") == "failure").alias("failure"),
            F.count_if(data).alias("n_data"),
            F.max(F.when(data, F.col("modified"))).alias("newest"),
            F.concat_ws(":", F.count_if(counts), F.sum(F.when(counts, _mark().cast("decimal(38,0)")))).alias("mark"),
        )
    )


def _mark() -> Column:
    """Changes with a file's name, size or time of change."""
    return F.xxhash64("file_path", "file_size", "modified")


def _with_last(subjects: DataFrame, latest: DataFrame) -> DataFrame:
    """Adds what the ledger knows of each subject: the mark of its load, when it was claimed, its last note."""
    about, state = F.col("about"), F.col("state")
    last = latest.groupBy("subject").agg(
        F.max(F.when(about == "load", F.col("mark"))).alias("loaded_mark"),
        F.max(F.when((about == "claim") & (state == "claimed"), F.col("at"))).alias("claimed_at"),
        F.max(F.when(about == "note", F.concat_ws(" ", "state", "mark"))).alias("noted"),
    )
    return subjects.join(last, "subject", "left")


def _step(now: datetime, patience: Patience) -> Column:
    """done, claimed or ready, for a subject that is complete. Claims run out."""
    return (
        F.when(F.col("loaded_mark") == F.col("mark"), "done")
        .when(F.col("claimed_at") > F.lit(now - patience.claim), "claimed")
        .otherwise("ready")
    )


def gate(subjects: DataFrame, latest: DataFrame, now: datetime, patience: Patience = Patience()) -> DataFrame:
    """Adds ``decision`` to directories.

    * working: another process has put its marker there;
    * ready: the control file is there and this set of files was not loaded yet;
    * done, claimed: it was, or someone is at it;
    * failed: no control file, and the sender says that the transfer failed;
    * late: data whose control file has not come in time;
    * waiting: anything else.

    A directory that got more files after its load is ready again; its new load takes the place of the old one.
    """
    state = _with_last(subjects, latest)
    return state.withColumn(
        "decision",
        F.when(F.col("working"), "working")
        .when(F.col("control"), _step(now, patience))
        .when(F.col("failure"), "failed")
        .when((F.col("n_data") > 0) & (F.col("newest") < F.lit(now - patience.late)), "late")
        .otherwise("waiting"),
    )


def _events(subjects: DataFrame, about: str, state: Column | str, run: str, now: datetime, message: str = "") -> DataFrame:
    return subjects.select(
        "subject",
        F.lit(about).alias("about"),
        (state if isinstance(state, Column) else F.lit(state)).alias("state"),
        F.lit(run).alias("run"),
        "mark",
        F.lit(message).alias("message"),
        F.lit(now).alias("at"),
    )


def _claim(ledger: Ledger, judged, patience: Patience, run: str, now: datetime, notes: tuple[str, ...]) -> DataFrame:
    """Claim up to ``at_once`` ready subjects, and note those that are newly late, failed or missing."""

    def choose(latest: DataFrame) -> DataFrame:
        state = judged(latest)
        ready = state.where("decision = 'ready'").orderBy("subject").limit(patience.at_once)
        news = state.where(F.col("decision").isin(*notes)).where(~F.col("noted").eqNullSafe(F.concat_ws(" ", "decision", "mark")))
        return _events(ready, "claim", "claimed", run, now).unionByName(_events(news, "note", F.col("decision"), run, now))

    return ledger.decide(choose).where("about = 'claim'")


def _land(spark: SparkSession, load: Load, out: str, run: str) -> None:
    """Rows, rejected files and the outcome of one load, in folders that no reader takes before the commit."""
    sinks.write_rows(load.rows, f"{out}/rows/run={run}", compact=sinks.wants_compaction(load.files))
    landed = spark.read.schema(load.rows.schema).parquet(f"{out}/rows/run={run}")
    sinks.rejected_files(landed, run).drop("run_id").write.mode("overwrite").parquet(f"{out}/error/files/run={run}")
    audit.outcome(landed).write.mode("overwrite").parquet(f"{out}/audit/outcome/run={run}")


def _polled(spark, ledger: Ledger, judged, load, out: str, patience: Patience, now: datetime | None, notes: tuple[str, ...]) -> list[str]:
    """Claim, load and commit until nothing is ready; returns the ids of the loads.

    A load that fails gives its claims back and the error is raised. Claims of a process that was killed run out.
    """
    runs = []
    while True:
        run, at = f"r{uuid.uuid4().hex}", now or datetime.now(timezone.utc)
        claims = _claim(ledger, judged(at), patience, run, at, notes)
        if claims.isEmpty():
            return runs
        try:
            _land(spark, load(claims), out, run)
        except Exception as e:
            ledger.append(_events(claims, "claim", "error", run, at, str(e)))
            raise
        at = now or datetime.now(timezone.utc)
        ledger.append(_events(claims, "load", "loaded", run, at).unionByName(_events(claims, "claim", "released", run, at)))
        runs.append(run)


def poll_directories(
    spark: SparkSession,
    glob: str,
    lists: AllowLists,
    golden: DataFrame,
    out: str,
    rules: Rules = Rules(),
    patience: Patience = Patience(),
    now: datetime | None = None,
) -> list[str]:
    """Load the directories below ``glob`` that are ready, at most ``at_once`` in one load."""
    rules = placed(rules, glob)
    seen = materialise(directories(inventory(spark, [glob]).unionByName(markers(spark, glob))))

    def load(claims: DataFrame) -> Load:
        paths = [literal_glob(r["subject"]) for r in claims.select("subject").collect()]
        return directories_load(spark, paths, lists, golden, rules)

    def judged(at: datetime):
        return lambda latest: gate(seen, latest, at, patience)

    return _polled(spark, ledger_of(spark, out), judged, load, out, patience, now, ("late", "failed"))


def named_gate(named: DataFrame, latest: DataFrame, now: datetime, patience: Patience = Patience()) -> DataFrame:
    """Adds ``decision`` to files that manifests name: ready, done, claimed, missing or waiting.

    ``named`` has subject (the file), mark (null while it is not there) and since, when its manifest came. A file that
    comes after it was reported missing is ready like any other.
    """
    state = _with_last(named, latest)
    return state.withColumn(
        "decision",
        F.when(F.col("mark").isNotNull(), _step(now, patience))
        .when(F.col("since") < F.lit(now - patience.late), "missing")
        .otherwise("waiting"),
    ).withColumn("mark", F.coalesce("mark", F.lit("")))


def poll_manifests(
    spark: SparkSession,
    glob: str,
    lists: AllowLists,
    golden: DataFrame,
    out: str,
    rules: Rules = Rules(),
    patience: Patience = Patience(),
    now: datetime | None = None,
) -> list[str]:
    """Load the files that manifests of allowed divisions name, as they come; missing ones are noted in the ledger.

    ``glob`` has a wildcard for the organisation. A manifest counts once its directory has a control file and
    no marker of another process. A file that several manifests name is loaded once.
    """
    rules = placed(rules, glob)
    everywhere = rules.layout.any_org(glob)
    found = inventory(spark, [everywhere])
    controls = _controls(spark, [everywhere], found, rules)
    complete = directories(found.unionByName(markers(spark, glob))).where("control and not working").select(F.col("subject").alias("dir"))
    manifests = found.where(F.col("kind") == "manifest").withColumn("dir", directory(F.col("file_path")))
    manifests = materialise(manifests.join(complete, "dir", "left_semi"))
    records = data_records(spark, [everywhere], F.contains(F.upper(scanned_path()), F.lit("MANIFEST")), manifests.drop("dir"))
    _, expanded = named_files(records, found, lists, rules)
    since = manifests.select(F.col("file_path").alias("manifest_path"), F.col("modified").alias("since"))
    wanted = for_entity(expanded, F.col("entity"), rules.entity).join(since, "manifest_path")
    there = found.select("file_path", _mark().cast("string").alias("mark"))
    named = materialise(
        wanted.groupBy("file_path").agg(F.min("since").alias("since")).join(there, "file_path", "left").withColumnRenamed("file_path", "subject")
    )

    def load(claims: DataFrame) -> Load:
        taken = claims.select(F.col("subject").alias("file_path"))
        files = materialise(found.join(broadcast_if_small(taken), "file_path", "left_semi"))
        paths = [literal_glob(r["file_path"]) for r in taken.collect()]
        return Load(rows=routed_rows(spark, paths, F.lit(True), files, golden, controls, rules), files=files)

    def judged(at: datetime):
        return lambda latest: named_gate(named, latest, at, patience)

    return _polled(spark, ledger_of(spark, out), judged, load, out, patience, now, ("missing",))


def landed(spark: SparkSession, out: str) -> DataFrame:
    """The rows of the last load of every directory or file; loads that were not committed do not show."""
    loads = ledger_of(spark, out).latest().where("about = 'load'").select("run", "subject")
    schema = f"{ROUTED_SCHEMA}, run string"
    if loads.isEmpty():
        return spark.createDataFrame([], schema)
    loads = materialise(loads)
    by_file = loads.groupBy("run").agg(F.max(~F.endswith("subject", F.lit("/"))).alias("by_file"))
    rows = spark.read.schema(schema).parquet(f"{out}/rows").join(broadcast_if_small(by_file), "run")
    subject = F.when(F.col("by_file"), F.col("file_path")).otherwise(directory(F.col("file_path")))
    told = rows.withColumn("subject", subject)
    return told.join(broadcast_if_small(loads), ["run", "subject"], "left_semi").drop("subject", "by_file")
