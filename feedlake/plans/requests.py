"""Loads that control files ask for, as one relation: requests joined to the inventory, one load, one write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.paths import entity_of, file_name, scanned_path
from feedlake.operators import audit
from feedlake.operators.filters import allowed, facility_route, for_entity
from feedlake.operators.sinks import open_folders
from feedlake.plans.ingest import AllowLists, _controls, landing_path, named_files, placed
from feedlake.plans.load import Rules, routed_rows
from feedlake.scale import materialise
from feedlake.sources.control import control_table
from feedlake.sources.framed import data_records, inventory, probe


def requests_of(spark: SparkSession, input_path: str, date: str, rules: Rules = Rules()) -> DataFrame:
    """(job_id, facility, from_date) of the control files below a landing path."""
    path = landing_path(input_path, date)
    found = inventory(spark, [path]).where(F.col("kind") == "control")
    if found.isEmpty():
        return spark.createDataFrame([], "job_id string, facility string, from_date string")
    return control_table(spark, [path], rules.job_field, found).select("job_id", "facility", "from_date")


def named_requests(asked: DataFrame, divisions: DataFrame) -> DataFrame:
    """Distinct requests (request, facility, from_date, run_type) of (job_id, facility, from_date).

    ``request`` is ``{job_id}/{facility}_{from_date}``; control files that ask for the same are one request.
    Requests without a job id go below ``no-job``.
    """
    job = F.when(F.coalesce("job_id", F.lit("")) == "", "no-job").otherwise(F.col("job_id"))
    name = F.concat(job, F.lit("/"), "facility", F.lit("_"), "from_date")
    routed = facility_route(asked.withColumn("source", F.lit("")), F.col("facility"), F.col("source"), divisions)
    return routed.select(name.alias("request"), "facility", "from_date", "run_type").distinct()


def _asked_on(requests: DataFrame, dated: DataFrame) -> DataFrame:
    """Requests and rows (org_id, feed_date) of the same organisation whose date fits: equal, or from the prefix on.

    The organisation joins by equality; a request's few dates are compared with those of its own files.
    """
    prefix = F.col("from_date").endswith("*")
    fits = F.when(prefix, F.col("feed_date").startswith(F.expr("left(from_date, length(from_date) - 1)"))).otherwise(
        F.col("feed_date") == F.col("from_date")
    )
    return dated.join(requests, "org_id").where(fits)


def requested_files(
    requests: DataFrame, found: DataFrame, expanded: DataFrame, lists: AllowLists, rules: Rules
) -> DataFrame:
    """(file_path, request): the inventoried files that each request asks for.

    A practice's request takes its own entity files; a division's those that its manifests name; the
    facility that stands for all divisions those of every manifest. ``expanded`` are the manifests' files.
    """
    path = F.col("file_path")
    entity = F.upper(entity_of(file_name(path)))
    data = allowed(found.where(F.col("kind") == "data"), entity, lists.entities, "entity")
    data = for_entity(allowed(data, F.upper(rules.layout.org_id(path)), lists.practices, "practice_id"), entity, rules.entity)
    own = data.select("file_path", rules.layout.org_id(path).alias("org_id"), rules.layout.feed_date(path).alias("feed_date"))
    practice = requests.where(F.col("run_type") == "path").withColumnRenamed("facility", "org_id")
    manifest = F.col("manifest_path")
    named = for_entity(expanded.where("found"), F.col("entity"), rules.entity).select(
        "file_path", rules.layout.org_id(manifest).alias("org_id"), rules.layout.feed_date(manifest).alias("feed_date")
    )
    division = requests.where(F.col("run_type") == "divisional").withColumnRenamed("facility", "org_id")
    every = requests.where(F.col("run_type") == "all").drop("facility")
    # a date that equals or begins with the request's: by equality, on each of the date's prefixes
    prefixes = F.explode(F.transform(F.sequence(F.lit(0), F.length("feed_date")), lambda n: F.concat(F.substr("feed_date", F.lit(1), n), F.lit("*"))))
    days = named.select("feed_date").distinct()
    wanted = days.select("feed_date", prefixes.alias("from_date")).unionByName(days.withColumn("from_date", F.col("feed_date")))
    everywhere = named.join(wanted.join(every, "from_date").select("feed_date", "request").distinct(), "feed_date")
    parts = (_asked_on(practice, own), _asked_on(division, named), everywhere)
    pairs = [p.select("file_path", "request") for p in parts]
    return pairs[0].unionByName(pairs[1]).unionByName(pairs[2]).distinct()


def load_requests(
    spark: SparkSession,
    asked: DataFrame,
    source: str,
    lists: AllowLists,
    golden: DataFrame,
    rules: Rules,
    out: str,
) -> DataFrame:
    """Load what (job_id, facility, from_date) rows ask for below ``source``; the outcome per request and entity.

    ``source`` has a wildcard for the organisation. Files are listed once and every file is read once, however many
    requests want it; its rows are written below each of them: ``{out}/rows/request=…/verdict=…/entity=…``.
    A run replaces the requests it was given, and no others. Requests that match no file leave no rows.
    """
    everywhere = landing_path(source, "*")
    rules = placed(rules, everywhere)
    requests = materialise(named_requests(asked, lists.divisions))
    found = inventory(spark, [everywhere])
    controls = _controls(spark, [everywhere], found, rules)
    manifests = found.where(F.col("kind") == "manifest")
    records = data_records(spark, [everywhere], F.contains(F.upper(scanned_path()), F.lit("MANIFEST")), manifests)
    _, expanded = named_files(records, found, lists, rules)
    pairs = materialise(requested_files(requests, found, expanded, lists, rules))
    files = materialise(found.join(pairs.select("file_path").distinct(), "file_path", "left_semi"))
    rows = routed_rows(spark, [everywhere], F.lit(True), files, golden, controls, rules)
    told = probe(rows, pairs)
    with open_folders(spark):
        told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("request", "verdict", "entity").parquet(f"{out}/rows")
    landed = spark.read.schema(told.schema).parquet(f"{out}/rows").join(F.broadcast(requests.select("request")), "request", "left_semi")
    outcome = audit.outcome(landed, "request", "entity")
    outcome.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("request").parquet(f"{out}/audit/outcome")
    written = spark.read.schema(outcome.schema).parquet(f"{out}/audit/outcome")
    return written.join(F.broadcast(requests.select("request")), "request", "left_semi")
