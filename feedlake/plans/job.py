"""Run a load and write everything it produces."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.paths import literal_glob
from feedlake.operators import audit, sinks
from feedlake.operators.filters import facility_route
from feedlake.operators.ledger import Ledger, changed_before, remove
from feedlake.plans.ingest import AllowLists, Load, directory_load, manifest_load, placed
from feedlake.plans.load import ROUTED_SCHEMA, Rules

LOADS = {"divisional": manifest_load, "path": directory_load}


PARTS = (
    "rows",
    "text",
    "error/files",
    "error/manifest_rows",
    "error/missing_files",
    "manifest",
    "control",
    "audit/outcome",
)


@dataclass(frozen=True)
class Outputs:
    """Output folders below one root, each with a folder per ``run`` if that is given.

    ``text`` also writes the rows as separated lines.
    """

    root: str
    text: bool = False
    run: str = ""

    def at(self, part: str) -> str:
        return f"{self.root}/{part}/run={self.run}" if self.run else f"{self.root}/{part}"

    @property
    def rows(self) -> str:
        return self.at("rows")

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"


@dataclass(frozen=True)
class RunContext:
    """Identity of a run in the status and work-queue records."""

    job_id: str = ""
    facility: str = ""
    source: str = ""


def write_load(
    spark: SparkSession, load: Load, out: Outputs, run_id: str, requested: str = "*"
) -> DataFrame:
    """Write rows, rejected files and, when all entities were asked for, manifests and controls.

    Returns the landed rows. Every output is replaced as a whole, so a repeated run leaves the
    same result.
    """
    sinks.write_rows(load.rows, out.rows, "parquet", sinks.wants_compaction(load.files))
    landed = spark.read.schema(load.rows.schema).parquet(out.rows)
    if out.text:
        sinks.write_rows(landed, out.at("text"), "text")
    sinks.rejected_files(landed, run_id).write.mode("overwrite").parquet(out.at("error/files"))
    if load.manifest_rows is not None:
        load.manifest_rejects.write.mode("overwrite").parquet(out.at("error/manifest_rows"))
        load.missing_files.write.mode("overwrite").parquet(out.at("error/missing_files"))
        if requested == "*":
            sinks.write_text(load.manifest_rows, out.at("manifest"))
            sinks.write_text(load.control_rows, out.at("control"))
    others = None if load.manifest_rows is None else audit.unloadable(load.missing_files, load.manifest_rejects)
    audit.outcome(landed, others=others).write.mode("overwrite").parquet(out.at("audit/outcome"))
    return landed


def run(
    spark: SparkSession,
    kind: str,
    input_path: str,
    date: str,
    lists: AllowLists,
    golden: DataFrame,
    out: Outputs,
    rules: Rules = Rules(),
    context: RunContext = RunContext(),
) -> DataFrame:
    """One load of the given kind, ``divisional`` or ``path``; returns the outcome per entity.

    A failure is recorded as a status row and raised.
    """
    if kind not in LOADS:
        raise ValueError(f"load must be one of {sorted(LOADS)}, not {kind!r}")
    run_id = uuid.uuid4().hex
    status = f"{out.audit}/status"
    who = (context.job_id, context.facility, context.source or input_path)
    started = time.monotonic()
    sinks.append_status(spark, status, *who, "load", "started", run_id)
    try:
        load = LOADS[kind](spark, input_path, date, lists, golden, rules)
        write_load(spark, load, out, run_id, rules.entity)
    except Exception as e:
        sinks.append_status(spark, status, *who, "load", "failed", str(e))
        raise
    outcome = spark.read.parquet(out.at("audit/outcome"))
    state = "completed" if outcome.where("state != 'ok'").isEmpty() else "completed with errors"
    message = f"{run_id}: {time.monotonic() - started:.1f} s"
    sinks.append_status(spark, status, *who, "load", state, message)
    sinks.append_work(spark, f"{out.audit}/work_queue", *who, "loaded")
    return outcome


LOADS_DONE = "load string, run string, at timestamp"
WORK = "job_id string, facility string, source string, event string, worker string, at timestamp"
STATUS = "job_id string, facility string, source string, stage string, state string, message string, at timestamp"


def publications(spark: SparkSession, root: str) -> Ledger:
    """Which run stands for a load: the same kind, input, date, entity and rules."""
    return Ledger(spark, f"{root}/published", ("load",), LOADS_DONE)


def status_log(spark: SparkSession, root: str) -> Ledger:
    """Steps of runs; the latest event of a stage is its state."""
    return Ledger(spark, f"{root}/status", ("job_id", "facility", "source", "stage"), STATUS)


def work_queue(spark: SparkSession, root: str) -> Ledger:
    """What was loaded and waits for the next stage; the latest event of a load is its state."""
    return Ledger(spark, f"{root}/work", ("job_id", "facility", "source"), WORK)


def take_work(spark: SparkSession, root: str, worker: str, limit: int = 1) -> DataFrame:
    """Up to ``limit`` loads that wait longest, now this worker's; no other worker gets them."""
    taken = [F.lit("taken").alias("event"), F.lit(worker).alias("worker"), F.lit(datetime.now(timezone.utc)).alias("at")]

    def choose(latest: DataFrame) -> DataFrame:
        waiting = latest.where("event = 'loaded'").orderBy("at", "job_id", "facility", "source").limit(limit)
        return waiting.select("job_id", "facility", "source", *taken)

    return work_queue(spark, root).decide(choose)


def run_published(
    spark: SparkSession,
    kind: str,
    input_path: str,
    date: str,
    lists: AllowLists,
    golden: DataFrame,
    root: str,
    rules: Rules = Rules(),
    context: RunContext = RunContext(),
    text: bool = False,
    warehouse: str | None = None,
) -> DataFrame:
    """Like ``run``, but all outputs of a load appear at once and take the place of those of its last run.

    They are written into folders of their own, ``run=…``, which nobody reads before the commit that names it; a run
    that stops halfway leaves what was published before. With ``warehouse``, a prefix of table names, the
    accepted rows of every entity go into its table, once per load however often that is repeated.
    """
    run_id = f"r{uuid.uuid4().hex}"
    key = "|".join((kind, input_path, date, rules.entity, str(rules.validate), rules.pii_extra_columns))
    log = status_log(spark, root)
    who = (context.job_id, context.facility, context.source or input_path)

    def tell(stage: str, state: str, message: str) -> None:
        log.append(spark.createDataFrame([(*who, stage, state, message, datetime.now(timezone.utc))], STATUS))

    tell("load", "started", run_id)
    try:
        out = Outputs(root, text, run_id)
        outcome = run(spark, kind, input_path, date, lists, golden, out, rules, context)
        clean = outcome.where("state != 'ok'").isEmpty()
        tell("load", "completed" if clean else "completed with errors", run_id)
        publications(spark, root).append(spark.createDataFrame([(key, run_id, datetime.now(timezone.utc))], LOADS_DONE))
        if warehouse is not None:
            tell("warehouse", "started", run_id)
            _to_warehouse(spark, out, golden, warehouse, key, run_id)
            tell("warehouse", "completed", run_id)
        work_queue(spark, root).append(spark.createDataFrame([(*who, "loaded", "", datetime.now(timezone.utc))], WORK))
    except Exception as e:
        tell("run", "failed", f"{run_id}: {e}")
        raise
    return outcome


def _to_warehouse(spark: SparkSession, out: Outputs, golden: DataFrame, prefix: str, key: str, run_id: str) -> None:
    """A table per entity, so this walks the catalog's entities; their rows stay in Spark.

    An entity that has no rows any more loses those of the load's last run.
    """
    landed = spark.read.schema(ROUTED_SCHEMA).parquet(out.rows)
    loaded_at = datetime.now(timezone.utc)
    filled = spark.read.parquet(out.at("audit/outcome")).select("entity", (F.col("n_ok") > 0).alias("filled"))
    for r in golden.select("entity").distinct().join(filled, "entity", "left").orderBy("entity").collect():
        table = f"{prefix}_{r['entity']}"
        if r["filled"] or spark.catalog.tableExists(table):
            sinks.load_warehouse_once(sinks.typed_view(landed, golden, r["entity"]), table, key, run_id, loaded_at)


def published(spark: SparkSession, root: str, part: str = "rows", text: bool = False) -> DataFrame:
    """One output, such as ``rows`` or ``error/files``, of the run that stands for each load, and that ``run``."""
    runs = [r["run"] for r in publications(spark, root).latest().collect()]
    reader = spark.read.format("text" if text else "parquet").option("basePath", f"{root}/{part}")
    if part == "rows":
        reader = reader.schema(f"{ROUTED_SCHEMA}, run string")
    return reader.load([f"{literal_glob(root)}/{part}/run={r}" for r in runs])


def remove_replaced(spark: SparkSession, root: str, before: datetime) -> list[str]:
    """Remove the outputs of runs that stand for no load, and what the logs no longer need; returns the runs removed.

    Those are runs that a later one replaced and runs that stopped. One of which any output changed at ``before`` or
    later stays: it may still be running, or be read by someone who asked ``published`` earlier. So ``before`` must lie
    further back than the longest run or read takes.
    """
    ledger = publications(spark, root)
    found = [(part, name, old) for part in PARTS for name, old in changed_before(spark, f"{root}/{part}", before).items()]
    standing = {f"run={r['run']}" for r in ledger.latest().collect()}
    kept = standing | {name for _, name, old in found if not old}
    gone = [(part, name) for part, name, _ in found if name.startswith("run=") and name not in kept]
    for part, name in gone:
        remove(spark, f"{root}/{part}/{name}")
    for log in (ledger, status_log(spark, root), work_queue(spark, root)):
        log.remove_before(before)
    return sorted({name.removeprefix("run=") for _, name in gone})


def requested_runs(controls: DataFrame, divisions: DataFrame, source: str) -> DataFrame:
    """(job_id, facility, from_date, run_type, run_source): what the control files ask for."""
    asked = controls.select("job_id", "facility", "from_date", F.lit(source).alias("source"))
    return facility_route(asked, F.col("facility"), F.col("source"), divisions).drop("source")


def run_requested(
    spark: SparkSession,
    controls: DataFrame,
    source: str,
    lists: AllowLists,
    golden: DataFrame,
    root: str,
    rules: Rules = Rules(),
) -> list[str]:
    """One load per request, into ``{root}/{job_id}/{facility}_{from_date}``; returns the job ids.

    Control files that ask for the same are one request; those of one job stay apart. Requests
    without a job id go below ``no-job``.

    A facility on the division list, or the id that stands for all divisions, is loaded by its
    manifests, any other one by its directories.
    """
    if "*" in source:  # the facility takes the place of the wildcard
        rules = placed(rules, source)
    runs = requested_runs(controls, lists.divisions, source).distinct().collect()
    for r in runs:
        kind = "path" if r["run_type"] == "path" else "divisional"
        context = RunContext(r["job_id"], r["facility"], r["run_source"])
        out = Outputs(f"{root}/{r['job_id'] or 'no-job'}/{r['facility']}_{r['from_date']}")
        run(spark, kind, r["run_source"], r["from_date"], lists, golden, out, rules, context)
    return [r["job_id"] for r in runs]
