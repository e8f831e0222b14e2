"""Command line: ``python -m feedlake`` or ``spark-submit … feedlake/__main__.py``."""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from feedlake.plans.ingest import AllowLists, landing_path
from feedlake.plans.job import LOADS, Outputs, RunContext, remove_replaced, run, run_published
from feedlake.plans.load import Rules
from feedlake.plans.requests import load_requests, requests_of
from feedlake.sources import allowlists
from feedlake.sources.catalog import golden_schema, jdbc_options, warehouse_query
from feedlake.streaming.gate import poll_directories, poll_manifests

POLLS = {"arrivals": poll_directories, "named": poll_manifests}
CATALOG_QUERY = "SELECT databasename, tablename, columntitle, columnid, commentstring FROM {}"


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="feedlake")
    p.add_argument("input_path", help="landing path, e.g. /land/data/*/feed/finished")
    p.add_argument("entity", help="entity name, or * for all")
    p.add_argument("date", help="yyyy-mm-dd, or a prefix followed by *")
    p.add_argument("out_path")
    p.add_argument("practice_list")
    p.add_argument("entity_list")
    p.add_argument("division_list")
    p.add_argument(
        "load",
        choices=[*sorted(LOADS), "requested", *POLLS],
        help="requested: what the control files below input_path ask for; arrivals, named: directories, or files named by "
        "manifests, that are complete and not loaded yet",
    )
    p.add_argument("mode", choices=["standard", "validate"], nargs="?", default="standard")
    p.add_argument("--catalog", required=True, help="catalog table name, or parquet path")
    p.add_argument("--database", help="keep catalog columns of this database")
    p.add_argument("--jdbc-url", help="read the catalog over JDBC; password: FEEDLAKE_JDBC_PASSWORD")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-driver")
    p.add_argument("--job-id", default="")
    p.add_argument("--facility", default="")
    p.add_argument("--publish", action="store_true", help="let all outputs of a load appear at once, in place of its last run's")
    p.add_argument(
        "--remove-replaced",
        type=float,
        metavar="DAYS",
        help="with --publish: then remove outputs of replaced and stopped runs unchanged for so many days",
    )
    p.add_argument("--warehouse", help="with --publish: prefix of the tables that take the accepted rows, one per entity")
    p.add_argument("--text", action="store_true", help="also write the rows as text lines")
    return p


def catalog(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.jdbc_url:
        options = jdbc_options(args.jdbc_url, args.jdbc_user, args.jdbc_driver)
        columns = warehouse_query(spark, CATALOG_QUERY.format(args.catalog), options)
    elif "/" in args.catalog:
        columns = spark.read.parquet(args.catalog)
    else:
        columns = spark.table(args.catalog)
    return golden_schema(columns, args.database)


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName("feedlake").getOrCreate()
    lists = AllowLists(
        divisions=allowlists.divisions(spark, args.division_list),
        practices=allowlists.practices(spark, args.practice_list),
        entities=allowlists.entities(spark, args.entity_list),
    )
    rules = Rules(entity=args.entity, validate=args.mode == "validate")
    if args.load == "requested":
        asked = requests_of(spark, args.input_path, args.date, rules)
        outcome = load_requests(spark, asked, args.input_path, lists, catalog(spark, args), rules, args.out_path.rstrip("/"))
        shown = outcome.orderBy("request", "entity")
        print(f"{shown.count()} requests and entities")
        shown.show(1000, truncate=False)
        return
    if args.load in POLLS:
        path = landing_path(args.input_path, args.date)
        runs = POLLS[args.load](spark, path, lists, catalog(spark, args), args.out_path.rstrip("/"), rules)
        print(f"{len(runs)} loads")
        return
    load = (spark, args.load, args.input_path, args.date, lists, catalog(spark, args))
    root, context = args.out_path.rstrip("/"), RunContext(args.job_id, args.facility, args.input_path)
    if args.publish:
        outcome = run_published(*load, root, rules, context, args.text, args.warehouse)
        if args.remove_replaced is not None:
            before = datetime.now(timezone.utc) - timedelta(days=args.remove_replaced)
            print(f"{len(remove_replaced(spark, root, before))} runs removed")
    else:
        outcome = run(*load, Outputs(root, text=args.text), rules, context)
    print(f"{outcome.count()} entities, the first 1000 of them:")
    outcome.orderBy("entity").show(1000, truncate=False)


if __name__ == "__main__":
    main()
