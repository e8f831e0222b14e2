"""One query per operator over the given tables.

Every query takes (spark, folder of parquet tables) and reads whole tables. ``oracles.py`` has the
SQL that states the expected result.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import header, manifest, paths, rows, text
from feedlake.functions.text import RS, US
from feedlake.operators import audit, filters, joins, schema, sinks
from feedlake.operators.rows import FILE_RECORD, route
from feedlake.plans import exports, job
from feedlake.plans.ingest import AllowLists, directory_load, manifest_load
from feedlake.plans.load import Rules
from feedlake.plans.requests import load_requests
from feedlake.scale import broadcast_if_small, materialise, shared_dir
from feedlake.sources import allowlists, catalog, control
from feedlake.streaming import gate
from feedlake.streaming.arrivals import load_arrivals


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _s(column: str) -> Column:
    return F.col(column).cast("string")


def _cat(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _landing(org: Column, date: Column) -> Column:
    return _cat("/land/data/", org, "/feed/finished/", date, "/")


# -- records ------------------------------------------------------------------------------------


def frame_records(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("rec_no", "value")).where(
        (F.col("rec_no") >= text.HEADER_RECORDS) & ~text.is_blank(F.col("value"))
    )


def clean_record(spark, folder):
    docs = table(spark, folder, "documents")
    dirty = F.replace(F.replace("text", F.lit(" "), F.lit("\r")), F.lit("."), F.lit("." + RS))
    return docs.select("doc_id", text.clean_record(dirty).alias("value"))


def control_jobid(spark, folder):
    org, day = _s("o_custkey"), _day("o_orderdate")
    line = F.concat_ws("~", org, day, day, _cat("JOB", _s("o_orderkey")), _landing(org, day))
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", line.alias("line"))
        .select(
            "o_orderkey",
            manifest.control_entry(F.col("line")).alias("c"),
            text.control_to_fields(F.col("line")).alias("fields"),
        )
        .select("o_orderkey", "c.*", "fields")
    )


def first_line_per_file(spark, folder):
    lines = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("file_path"), F.col("turn").alias("position"), F.col("text").alias("value")
    )
    return control.first_lines(lines).select(F.col("file_path").alias("conv_id"), "line")


def _manifest_record() -> Column:
    kind = F.col("event_type")
    stem = F.concat_ws("_", kind, F.lit("4.0"), F.date_format("ts", "yyyyMMddHHmmss"), _s("user_id"))
    name = F.concat(stem, F.when(kind == "error", ".txt").otherwise(".asv"))
    count = F.floor("value").cast("string")
    return (
        F.when(kind == "view", _cat("\n", name, US))
        .when(kind == "signup", _cat("\n", name, US, count, "x", US, "hash"))
        .otherwise(_cat("\r\n", name, US, count, US, "hash", US))
    )


def manifest_parse(spark, folder):
    events = table(spark, folder, "events")
    return events.select(
        "event_id", manifest.manifest_entry(_manifest_record()).alias("e")
    ).select("event_id", "e.*")


# -- paths --------------------------------------------------------------------------------------


def path_parts(spark, folder):
    layout = paths.Layout()
    name = _cat(F.lower("o_orderpriority"), "_4.0_", _s("o_orderkey"), ".asv")
    place = _landing(_s("o_custkey"), _day("o_orderdate"))
    path = F.col("file_path")
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", F.concat(place, name).alias("file_path"))
        .select(
            "o_orderkey",
            layout.org_id(path).alias("org_id"),
            layout.feed_date(path).alias("feed_date"),
            paths.directory(path).alias("dir"),
            paths.file_name(path).alias("file_name"),
            paths.entity_of(paths.file_name(path)).alias("entity"),
            layout.for_practice(paths.directory(path), _cat("P", _s("o_orderkey"))).alias("practice_dir"),
            paths.output_name(
                paths.entity_of(paths.file_name(path)), F.timestamp_millis("o_orderkey")
            ).alias("output_name"),
        )
    )


def classify_files(spark, folder):
    name = (
        F.when(F.col("o_orderstatus") == "F", _cat("Manifest_", _s("o_orderkey"), ".asv"))
        .when(F.col("o_orderstatus") == "O", "control.txt")
        .when(F.col("o_orderpriority") == "5-LOW", _s("o_orderkey"))
        .otherwise(_cat("orders_", _s("o_orderkey"), ".asv"))
    )
    path = F.concat(_landing(_s("o_custkey"), F.lit("2015-09-01")), name)
    return table(spark, folder, "orders").select("o_orderkey", paths.file_kind(path).alias("kind"))


def date_prefix_scan(spark, folder):
    layout = paths.Layout()
    path = F.concat(_landing(_s("o_custkey"), _day("o_orderdate")), F.lit("x_1.asv"))
    files = table(spark, folder, "orders").select("o_orderkey", path.alias("file_path"))
    date = layout.feed_date(F.col("file_path"))
    return files.select("o_orderkey", "file_path", date.alias("feed_date")).where(
        filters.on_date(F.col("feed_date"), "1997-0*") | filters.on_date(F.col("feed_date"), "1998-12-31")
    )


def facility_route(spark, folder):
    divisions = table(spark, folder, "supplier").select(_s("s_suppkey").alias("org_id"))
    facilities = table(spark, folder, "customer").select(
        _s("c_custkey").alias("facility"), F.lit("/land/data/*/feed/finished").alias("source")
    )
    return filters.facility_route(facilities, F.col("facility"), F.col("source"), divisions, all_id="25").drop(
        "source"
    )


# -- allow-lists and joins ----------------------------------------------------------------------


def _allow(spark, folder):
    line = _cat("c", _s("c_custkey"), "~", F.col("c_name"))
    practices = table(spark, folder, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    entities = table(spark, folder, "orders").where(F.col("o_orderpriority") < "4")
    return (
        practices.select(allowlists.practice_id(line).alias("practice_id")).distinct(),
        entities.select(allowlists.entity_name(F.lower("o_orderpriority")).alias("entity")).distinct(),
    )


def _orders_by_practice(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", F.upper(_cat("c", _s("o_custkey"))).alias("practice"), F.upper("o_orderpriority").alias("e")
    )


def allowlist_semi(spark, folder):
    practices, entities = _allow(spark, folder)
    orders = _orders_by_practice(spark, folder)
    kept = filters.allowed(orders, F.col("practice"), practices, "practice_id")
    return filters.allowed(kept, F.col("e"), entities, "entity").select("o_orderkey")


def allowlist_anti(spark, folder):
    practices, _ = _allow(spark, folder)
    orders = _orders_by_practice(spark, folder)
    return filters.allowed(orders, F.col("practice"), practices, "practice_id", keep=False).select("o_orderkey")


def division_list(spark, folder):
    line = _cat("c", _s("c_custkey"), "~", F.col("c_name"))
    return table(spark, folder, "customer").select(
        allowlists.division_id(line).alias("division_id"),
        allowlists.practice_id(line).alias("practice_id"),
        allowlists.entity_name(F.col("c_mktsegment")).alias("entity"),
    )


def entity_param(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    one = filters.for_entity(events, F.col("event_type"), "PurCHASE").select("event_id", F.lit("one").alias("request"))
    every = filters.for_entity(events, F.col("event_type"), "*").select("event_id", F.lit("all").alias("request"))
    return one.unionByName(every)


def control_semi_join(spark, folder):
    controls = table(spark, folder, "customer").select(_s("c_custkey").alias("org_id"))
    manifests = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F").select(
        paths.Layout().org_id(_landing(_s("o_custkey"), F.lit("d"))).alias("org_id")
    )
    return joins.controls_with_manifest(controls, manifests)


def control_contains_join(spark, folder):
    controls = table(spark, folder, "supplier").select(_s("s_suppkey").alias("org_id"))
    manifests = table(spark, folder, "orders").select(_cat("/land/data/", _s("o_custkey"), "/feed/").alias("file_path"))
    return joins.controls_contained_in_manifest(controls, manifests)


def _manifest_entries(spark, folder):
    key = _s("o_orderkey")
    place = _cat("/land/data/", _s("o_custkey"), "/feed/finished/2015-09-01/Manifest.asv")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        place.alias("manifest_path"),
        key.alias("practice_id"),
        _cat("lineitem_4.0_", key, ".asv").alias("file_name"),
    )


def manifest_expand(spark, folder):
    key = _s("l_orderkey")
    listing = (
        table(spark, folder, "lineitem")
        .select("l_orderkey")
        .distinct()
        .select(F.concat(_landing(key, F.lit("2015-09-01")), F.lit("lineitem_4.0_"), key, F.lit(".asv")).alias("file_path"))
    )
    expanded = joins.expand_manifest(_manifest_entries(spark, folder), paths.Layout())
    return joins.against_listing(expanded, listing).select("o_orderkey", "file_path", "control_path", "found")


def distinct_control_paths(spark, folder):
    entries = table(spark, folder, "lineitem").select(
        F.lit("/land/data/2208/feed/finished/2015-09-01/Manifest.asv").alias("manifest_path"),
        _s("l_suppkey").alias("practice_id"),
        _cat("lineitem_", _s("l_orderkey"), ".asv").alias("file_name"),
    )
    return joins.distinct_control_paths(joins.expand_manifest(entries, paths.Layout()))


def jobid_left_join(spark, folder):
    controls = (
        table(spark, folder, "orders")
        .where(F.col("o_orderstatus") == "F")
        .groupBy("o_custkey")
        .agg(F.max("o_orderkey").alias("k"))
        .select(_landing(_s("o_custkey"), F.lit("d")).alias("dir"), _cat("JOB", _s("k")).alias("job_id"))
    )
    customers = table(spark, folder, "customer").select("c_custkey")
    return joins.with_job_id(customers, _landing(_s("c_custkey"), F.lit("d")), controls)


def paths_by_entity(spark, folder):
    events = table(spark, folder, "events")
    path = _cat("/land/", _s("user_id"), "/", F.col("event_type"))
    return joins.paths_by_entity(events, F.col("event_type"), path)


def entity_sizes(spark, folder):
    return joins.entity_sizes(paths_by_entity(spark, folder))


def consolidate_union(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.lit("customer").alias("entity"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.lit("supplier").alias("entity"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


# -- catalog ------------------------------------------------------------------------------------


def _catalog_columns(spark, folder):
    size = F.col("p_size")
    comment = (
        F.when(size <= 5, "Ignore")
        .when(size <= 10, "ETL")
        .when(size <= 20, F.lit(None).cast("string"))
        .when(size <= 25, "Remove")
        .otherwise("note")
    )
    return table(spark, folder, "part").select(
        F.when(F.col("p_retailprice") < 905, "stage").otherwise("edw").alias("databasename"),
        F.when(F.col("p_type") == "PROMO", F.col("p_brand")).otherwise(F.lower("p_brand")).alias("tablename"),
        F.when(F.col("p_type") == "ECONOMY", "").otherwise(_cat(F.initcap("p_name"), " ", _s("p_partkey"))).alias("columntitle"),
        _s("p_partkey").alias("columnid"),
        comment.alias("commentstring"),
    )


def golden_schema(spark, folder):
    return catalog.with_ordinal(catalog.golden_schema(_catalog_columns(spark, folder), "edw"))


def pii_flag(spark, folder):
    return catalog.has_personal_data(catalog.golden_schema(_catalog_columns(spark, folder)))


def catalog_counts(spark, folder):
    columns = table(spark, folder, "lineitem").select(
        F.lit("Edw").alias("databasename"),
        _cat("t", _s("l_orderkey")).alias("tablename"),
        F.when(F.col("l_returnflag") == "A", "ETL").when(F.col("l_returnflag") == "N", "x").alias("commentstring"),
    )
    tables = table(spark, folder, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "other").otherwise("Edw").alias("databasename"),
        _cat("t", _s("o_orderkey")).alias("tablename"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Ignore").alias("commentstring"),
    )
    return catalog.column_counts(columns, tables, "edw")


def warehouse_query(spark, folder):
    table(spark, folder, "lineitem").createOrReplaceTempView("feedlake_lineitem")
    return catalog.warehouse_query(
        spark,
        "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity "
        "FROM feedlake_lineitem GROUP BY l_returnflag, l_linestatus",
    )


# -- headers ------------------------------------------------------------------------------------


def _golden(spark, entity_columns: dict[str, list[str]]) -> DataFrame:
    """Catalog rows; a title with a trailing ``!`` is personal data."""
    return spark.createDataFrame(
        [
            (entity, i, title.rstrip("!"), "remove" if title.endswith("!") else None)
            for entity, titles in entity_columns.items()
            for i, title in enumerate(titles)
        ],
        "entity string, column_id long, column_name string, comment string",
    )


def schema_match(spark, folder):
    columns = ["order_key", "cust_key", "order_status"]
    golden = catalog.golden_by_entity(
        _golden(spark, {"1-urgent": columns, "2-high": columns, "3-medium": [*columns, "total!"], "5-low": columns[::-1]})
    )
    status = F.col("o_orderstatus")
    titles = (
        F.when(status == "F", US.join(["Order Key", "CUST_KEY", "Order Status"]))
        .when(status == "O", US.join(["Cust Key", "cust key", "Order Status", "Order Key", "Total", ""]))
        .otherwise(US.join(["Order Key", "Order, Status"]))
    )
    types = F.when(F.col("o_totalprice") < 50000, US.join(["NUMBER", "NUMBER"])).otherwise(
        "\n" + US.join(["number", "VARCHAR", "NUMBER", "X", "NUMBER"])
    )
    headers = table(spark, folder, "orders").select(
        "o_orderkey", F.lower("o_orderpriority").alias("entity"), titles.alias("titles"), types.alias("types")
    )
    return schema.resolve_layout(headers.join(golden, "entity", "left")).select(
        "o_orderkey",
        "file_verdict",
        "width",
        F.coalesce("reorder", F.lit(False)).alias("reorder"),
        F.array_join("positions", ",").alias("positions"),
        F.array_join("extra_columns", ",").alias("extra_columns"),
        F.array_join("numeric", ",").alias("numeric"),
    )


def header_map(spark, folder):
    names = text.header_fields(F.replace("text", F.lit("\n"), F.lit(US)))
    types = text.header_fields(F.replace("text", F.lit(". "), F.lit(US)))
    return (
        table(spark, folder, "documents")
        .select("doc_id", names.alias("names"), types.alias("types"))
        .select("doc_id", F.explode_outer(header.header_pairs(F.col("names"), F.col("types"))).alias("pair"))
        .select("doc_id", "pair.title", "pair.type")
    )


def needs_reorder(spark, folder):
    titles = F.when(F.col("c_mktsegment") == "BUILDING", US.join(["Cust Key", "NAME"])).when(
        F.col("c_mktsegment") == "MACHINERY", US.join(["cust_key", "name", ""])
    ).otherwise(US.join(["Name", "Cust Key"]))
    names = header.normalise_all(text.header_fields(titles))
    return table(spark, folder, "customer").select(
        "c_custkey", header.needs_reorder(names, F.array(F.lit("cust_key"), F.lit("name"))).alias("reorder")
    )


def numeric_positions(spark, folder):
    types = F.concat_ws(
        US,
        F.when(F.col("l_quantity") > 25, "NUMBER").otherwise("VARCHAR"),
        F.when(F.col("l_discount") > 0.05, "number").otherwise("DATE"),
        F.when(F.col("l_returnflag") == "A", "\nNumber").otherwise("N"),
        F.col("l_linestatus"),
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array_join(header.number_positions(text.header_fields(types)).cast("array<string>"), ",").alias("positions"),
    )


# -- rows ---------------------------------------------------------------------------------------


def _array(*values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def reorder_columns(spark, folder):
    names = F.when(F.col("c_mktsegment") == "BUILDING", _array("seg", "name", "key", "name")).otherwise(
        _array("key", "bal", "seg", "more")
    )
    positions = header.golden_positions(names, _array("key", "name", "seg"))
    line = F.concat_ws(US, _s("c_custkey"), "c_name", "c_mktsegment", F.lit(""))
    moved = rows.to_golden_order(
        line, rows.all_fields_pattern(names), rows.golden_text(positions, _array(False, False, False))
    )
    return table(spark, folder, "customer").select("c_custkey", moved.alias("value"))


def pii_blank(spark, folder):
    line = F.concat_ws(US, "c_name", _s("c_custkey"), "c_mktsegment", F.lit("beyond"))
    known, pii = _array(True, True, False), _array(True, False, False)
    source = rows.blank_personal(line, rows.source_pattern(known, pii), rows.source_text(known))
    golden = rows.to_golden_order(
        line,
        rows.all_fields_pattern(_array("name", "key", "seg", "more")),
        rows.golden_text(_array(2, 1, 0), _array(False, True, False)),
    )
    return table(spark, folder, "customer").select(
        "c_custkey", source.alias("source_order"), golden.alias("golden_order")
    )


def numeric_check(spark, folder):
    cents, kind = _s("c"), F.col("event_type")
    value = (
        F.when(F.col("c") < 50, "")
        .when(kind == "click", cents)
        .when(kind == "view", _cat(" ", cents, ".", cents, " "))
        .when(kind == "signup", _cat(cents, "L"))
        .when(kind == "error", _cat("1e", cents))
        .when(F.col("c") > 10000, _cat("99999999999999", cents))
        .otherwise(_cat(".", cents, "d"))
    )
    pattern = rows.numbers_pattern(_array("a", "b", "c"), _array(0, 1, 7))
    return (
        table(spark, folder, "events")
        .select("event_id", "event_type", _cents("value").alias("c"))
        .select("event_id", value.alias("v"))
        .select(
            "event_id",
            rows.is_number_text(F.col("v")).alias("is_number"),
            rows.numbers_ok(F.concat_ws(US, F.lit("+5"), "v", F.lit("text")), pattern).alias("row_ok"),
        )
    )


def arity_check(spark, folder):
    tail = F.when(F.col("l_returnflag") == "A", F.lit("")).when(F.col("l_returnflag") == "N", US).otherwise(
        _cat(US, "", US, "x")
    )
    line = F.concat(F.concat_ws(US, _s("l_orderkey"), _s("l_linenumber"), "l_linestatus"), tail)
    width = rows.field_count(line)
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", width.alias("n_fields"), (width == 4).alias("arity_ok")
    )


def audit_columns(spark, folder):
    line = F.concat_ws(US, _s("o_orderkey"), "o_orderstatus", F.lit(""))
    name = _cat("orders_", _day("o_orderdate"), ".asv")
    return table(spark, folder, "orders").select(
        "o_orderkey", rows.with_audit(line, _cat("JOB", _s("o_custkey")), name).alias("value")
    )


# -- the row pipeline ---------------------------------------------------------------------------

CUSTOMER_GOLDEN = {"customer": ["cust_key", "name!", "balance", "segment"]}


def _customer_files(spark, folder):
    """Layouts of one file per nation; their headers differ."""
    nation = F.col("org_id").cast("int")
    titles = (
        F.when(nation == 5, US.join(["Cust Key", "Balance", "Segment"]))
        .when(nation == 6, US.join(["Cust Key", "Name", "Balance", "Segment", "Color"]))
        .when(nation < 2, US.join(["Segment", "Name", "Balance", "Cust Key"]))
        .otherwise(US.join(["Cust Key", "Name", "Balance", "SEGMENT"]))
    )
    types = (
        F.when(nation == 7, US.join(["NUMBER", "VARCHAR"]))
        .when(nation < 2, US.join(["VARCHAR", "VARCHAR", "NUMBER", "NUMBER"]))
        .otherwise(US.join(["NUMBER", "VARCHAR", "NUMBER", "VARCHAR", "VARCHAR"]))
    )
    files = (
        table(spark, folder, "customer")
        .select(_s("c_nationkey").alias("org_id"))
        .distinct()
        .select("org_id", F.lit("customer").alias("entity"), titles.alias("titles"), types.alias("types"))
    )
    golden = catalog.golden_by_entity(_golden(spark, CUSTOMER_GOLDEN))
    return schema.resolve_layout(files.join(golden, "entity", "left"))


def _customer_records(spark, folder):
    nation, segment = F.col("c_nationkey"), F.col("c_mktsegment")
    balance = F.when(segment == "HOUSEHOLD", _cat(_s("bal"), "x")).otherwise(_s("bal"))
    line = (
        F.when(nation < 2, F.concat_ws(US, "c_mktsegment", "c_name", balance, _s("c_custkey")))
        .when(nation == 6, F.concat_ws(US, _s("c_custkey"), "c_name", balance, "c_mktsegment", F.lit("red")))
        .when(segment == "MACHINERY", F.concat_ws(US, _s("c_custkey"), "c_name", balance))
        .when(segment == "FURNITURE", F.lit(US * 3))
        .otherwise(F.concat_ws(US, _s("c_custkey"), "c_name", balance, F.lit("\r\n")))
    )
    records = (
        table(spark, folder, "customer")
        .withColumn("bal", _cents("c_acctbal"))
        .select(_s("c_nationkey").alias("org_id"), "c_custkey", F.concat(F.lit("\n"), line).alias("value"))
    )
    # as in files: a task has the records of a nation in a row, so it compiles its layout's patterns once and not for every row
    return records.repartition("org_id", "c_custkey").sortWithinPartitions("org_id")


def routed_customers(spark, folder):
    layouts = materialise(_customer_files(spark, folder))
    good = layouts.where(F.col("file_verdict") == "ok")
    records = _customer_records(spark, folder).join(broadcast_if_small(good), "org_id")
    per_file = layouts.select("*", F.lit(None).cast("string").alias("value"), F.lit(None).cast("bigint").alias("c_custkey"))
    return route(records.unionByName(per_file), validate=True)


def route_rows(spark, folder):
    routed = routed_customers(spark, folder)
    is_file = F.col("verdict") == FILE_RECORD
    line = rows.with_audit(F.col("line"), F.lit("J1"), _cat("customer_", F.col("org_id")))
    return routed.select(
        "c_custkey",
        "org_id",
        "verdict",
        F.when(is_file, F.col("file_verdict")).alias("file_verdict"),
        "n_fields",
        line.alias("value"),
    )


def run_audit(spark, folder):
    missing = table(spark, folder, "supplier").select(
        F.concat(F.lit("/land/"), F.when(F.col("s_nationkey") < 5, "customer_").otherwise("Vendor_"), _s("s_suppkey")).alias("file_path")
    )
    unnamed = table(spark, folder, "nation").select(F.lit("customer").alias("entity"))
    return audit.outcome(routed_customers(spark, folder), others=audit.unloadable(missing, unnamed))


# -- whole loads over files ---------------------------------------------------------------------

_TITLES = ["Order Key", "Status", "Clerk Name", "Price", "Priority"]
_TYPES = ["NUMBER", "VARCHAR", "VARCHAR", "NUMBER", "VARCHAR"]
ORDERS_GOLDEN = {"orders": ["order_key", "price", "clerk_name!", "priority", "status"]}
ROWS_PER_TASK = 200_000
PRACTICES = ["1", "2", "3", "4"]  # orders of priority 5 come from a practice that is not allowed


def _orders_feed(spark, folder, root: str, keep: Column | None = None) -> DataFrame:
    """Write orders as feed files: a practice per priority, a date per year. ``keep`` chooses among those."""
    status, price = F.col("o_orderstatus"), _s("price")
    columns = [_s("o_orderkey"), F.col("o_orderstatus"), _cat("Clerk ", _s("o_custkey"))]
    line = (
        F.when(F.col("o_totalprice") < 20000, F.concat_ws(US, *columns))
        .when(status == "P", F.concat_ws(US, *columns, _cat(price, "e1"), "o_orderpriority"))
        .otherwise(F.concat_ws(US, *columns, price, _cat("\r\n", F.col("o_orderpriority"))))
    )
    feed = exports.in_parts(
        table(spark, folder, "orders")
        .withColumn("price", _cents("o_totalprice"))
        .select(
            F.substring("o_orderpriority", 1, 1).alias("org_id"),
            _cat(F.date_format("o_orderdate", "yyyy"), "-01-01").alias("feed_date"),
            F.col("o_orderkey").alias("key"),
            line.alias("value"),
        )
        .where(F.lit(True) if keep is None else keep)
    )
    titles = F.when(F.col("org_id") == "4", US.join([*_TITLES[:3], "Prize", "Priority"])).otherwise(US.join(_TITLES))
    types = F.lit(US.join(_TYPES))
    exports.write_feed(feed, root, exports.entity_name("orders"), titles, types)
    return feed


def _lists(spark) -> AllowLists:
    return AllowLists(
        divisions=spark.createDataFrame([("2208",)], "org_id string"),
        practices=spark.createDataFrame([(p,) for p in PRACTICES], "practice_id string"),
        entities=spark.createDataFrame([("ORDERS",)], "entity string"),
    )


def _load_result(landed: DataFrame) -> DataFrame:
    return landed.select(
        "verdict",
        "entity",
        "org_id",
        "feed_date",
        "file_verdict",
        "n_fields",
        F.concat("line", F.lit(US), "load_flag", F.lit(US), "job_id").alias("value"),
    )


def _land(spark, rows_: DataFrame, files: DataFrame) -> DataFrame:
    out = shared_dir(spark)
    sinks.write_rows(rows_, out, compact=sinks.wants_compaction(files))
    return spark.read.schema(rows_.schema).parquet(out)


def ingest_directory(spark, folder):
    root = shared_dir(spark)
    feed = _orders_feed(spark, folder, root)
    places = feed.select("org_id", "feed_date").distinct()
    exports.write_controls(places.where(F.col("org_id") != "3"), root, _cat("JOB", F.col("org_id")))
    golden = _golden(spark, ORDERS_GOLDEN)
    load = directory_load(spark, f"{root}/data/*/feed/finished", "199*", _lists(spark), golden, Rules(validate=True))
    return _load_result(_land(spark, load.rows, load.files))


@contextmanager
def _settings(spark, **settings: str):
    """Settings below ``spark.sql.files`` for what is planned inside."""
    before = {k: spark.conf.get(f"spark.sql.files.{k}", None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(f"spark.sql.files.{key}", value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(f"spark.sql.files.{key}")
            else:
                spark.conf.set(f"spark.sql.files.{key}", value)


def _spread(rows_: DataFrame, *keys: str) -> DataFrame:
    """The rows by keys, in tasks of about ``ROWS_PER_TASK`` however they lie in files; AQE leaves a given number alone."""
    return rows_.repartition(rows_.count() // ROWS_PER_TASK + 1, *keys)


def ingest_large_files(spark, folder):
    """Files of many splits: how many records of each verdict a place has, and which record numbers."""
    root = shared_dir(spark)
    feed = _orders_feed(spark, folder, root)
    with _settings(spark, maxPartitionBytes="32k", openCostInBytes="4k"):
        load = directory_load(
            spark, f"{root}/data/*/feed/finished", "199*", _lists(spark), _golden(spark, ORDERS_GOLDEN), Rules(validate=True)
        )
        landed = _land(spark, load.rows, load.files)
    number = F.col("record_no")
    return _spread(landed, "org_id", "feed_date", "record_no").groupBy("org_id", "feed_date").agg(
        *(F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("ok", "bad_arity", "bad_number", "file")),
        F.count_distinct(number).alias("n_numbers"),
        F.min(number).alias("first_number"),
        F.max(number).alias("last_number"),
    )


def requested_runs(spark, folder):
    """What control files ask for, in one load: a request per practice, one for all years and a division's."""
    root, out = shared_dir(spark), shared_dir(spark)
    feed = _orders_feed(spark, folder, root)
    named = feed.where(F.col("org_id") != "2").groupBy("org_id", "feed_date", "part").agg(F.count(F.lit(1)).alias("n"))
    exports.write_manifest(named, root, "2208", "orders")
    practice = F.substring("o_orderpriority", 1, 1)
    orders = table(spark, folder, "orders")
    own = orders.select(practice.alias("facility"), _cat(F.date_format("o_orderdate", "yyyy"), "-01-01").alias("from_date")).distinct()
    years = own.select("facility", F.lit("199*").alias("from_date")).distinct().where(F.col("facility") < "3")
    division = spark.createDataFrame([("2208", "1995*"), ("9999", "1996-01-01")], "facility string, from_date string")
    asked = own.unionByName(years).unionByName(division).withColumn("job_id", F.concat_ws("_", F.lit("J"), "facility", "from_date"))
    golden = _golden(spark, ORDERS_GOLDEN)
    load_requests(spark, asked, f"{root}/data/*/feed/finished", _lists(spark), golden, Rules(validate=True), out)
    return (
        spark.read.parquet(f"{out}/rows")
        .where(F.col("verdict") != FILE_RECORD)
        .groupBy("request", "org_id", "feed_date", "verdict")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def ingest_manifest(spark, folder):
    root = shared_dir(spark)
    feed = _orders_feed(spark, folder, root)
    named = feed.where(F.col("org_id") != "2").groupBy("org_id", "feed_date", "part").agg(F.count(F.lit(1)).alias("n"))
    exports.write_manifest(named, root, "2208", "orders")
    golden = _golden(spark, ORDERS_GOLDEN)
    load = manifest_load(spark, f"{root}/data/*/feed/finished", "199*", _lists(spark), golden)
    return _load_result(_land(spark, load.rows, load.files))


def stream_arrivals(spark, folder):
    root, out = shared_dir(spark), shared_dir(spark)
    feed = _orders_feed(spark, folder, root)
    places = feed.select("org_id", "feed_date").distinct()
    exports.write_controls(places.where(F.col("org_id") != "3"), root, _cat("JOB", F.col("org_id")))
    golden = _golden(spark, ORDERS_GOLDEN)
    for _ in range(2):  # the second poll finds nothing new
        query = load_arrivals(spark, f"{root}/data/*/feed/finished", _lists(spark), golden, out, f"{root}/offsets")
        query.awaitTermination()
    return _load_result(spark.read.option("basePath", out).parquet(f"{out}/batch=*"))


def _polled(spark, out: str, state: str) -> DataFrame:
    """Per place what the loads of its polls landed, and how often it was noted in the ledger."""
    n = {v: F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("ok", "bad_arity", "file")}
    rows_ = gate.landed(spark, out).groupBy("org_id", "feed_date").agg(*n.values(), F.count_distinct("run").alias("n_loads"))
    layout, subject = Rules().layout, F.concat(F.col("subject"), F.lit("/"))
    noted = gate.ledger_of(spark, out).events().where((F.col("about") == "note") & (F.col("state") == state))
    notes = noted.groupBy(layout.org_id(subject).alias("org_id"), layout.feed_date(subject).alias("feed_date")).agg(F.count(F.lit(1)).alias(f"n_{state}"))
    numbers = ["n_ok", "n_bad_arity", "n_file", "n_loads", f"n_{state}"]
    return rows_.join(notes, ["org_id", "feed_date"], "full").select(
        "org_id", "feed_date", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in numbers)
    )


def poll_arrivals(spark, folder):
    """Three polls of directories: early years, all years with controls in lower case for a practice that was late, nothing."""
    root, out = shared_dir(spark), shared_dir(spark)
    early = F.col("feed_date") < "1995"
    golden, source = _golden(spark, ORDERS_GOLDEN), f"{root}/data/*/feed/finished/*"
    for part in (early, ~early, None):
        if part is not None:
            feed = _orders_feed(spark, folder, root, part)
            places = feed.select("org_id", "feed_date").distinct()
            exports.write_controls(places.where(F.col("org_id") != "3"), root, _cat("JOB", F.col("org_id")))
        if part is early:
            first = materialise(places.where(F.col("org_id") == "3"))
        elif part is not None and not first.isEmpty():
            exports.write_controls(first, root, F.lit("JOB3"), "control.txt")
        gate.poll_directories(spark, source, _lists(spark), golden, out, now=datetime.now(timezone.utc) + timedelta(days=1))
    return _polled(spark, out, "late")


def stream_manifest(spark, folder):
    """Two polls of what manifests name: early years and what is missing then, and the rest when it has come."""
    root, out = shared_dir(spark), shared_dir(spark)
    early = F.col("feed_date") < "1995"
    golden, source = _golden(spark, ORDERS_GOLDEN), f"{root}/data/*/feed/finished/*"
    feed = _orders_feed(spark, folder, root, early)
    for part in (early, ~early):
        if part is not early:
            feed = feed.unionByName(_orders_feed(spark, folder, root, part))
        else:
            years = table(spark, folder, "orders").select(_cat(F.date_format("o_orderdate", "yyyy"), "-01-01").alias("feed_date")).distinct()
            practices = F.explode(F.array(F.lit("1"), F.lit("3"), F.lit("5"))).alias("org_id")
            named = years.select("*", practices, F.lit(1).alias("n")).withColumn("part", F.explode(F.array(F.lit(0), F.lit(999_999))))
            exports.write_manifest(named, root, "2208", "orders")
            exports.write_controls(years.withColumn("org_id", F.lit("2208")), root, F.lit("D"))
        gate.poll_manifests(spark, source, _lists(spark), golden, out, now=datetime.now(timezone.utc) + timedelta(days=1))
    return _polled(spark, out, "missing")


def published_runs(spark, folder):
    """A load by manifests, published twice: how much each of its outputs holds, and its status events."""
    root, out = shared_dir(spark), shared_dir(spark)
    feed = _orders_feed(spark, folder, root)
    # every file of a place, however many in_parts made of it, and one that is not there
    files = materialise(feed.where(F.col("org_id") != "2").select("org_id", "feed_date", "part").distinct())
    places = files.select("org_id", "feed_date").distinct()
    named = files.unionByName(places.withColumn("part", F.lit(999_999))).withColumn("n", F.lit(1))
    exports.write_manifest(named, root, "2208", "orders")
    controls = places.where(F.col("org_id") == "1").unionByName(places.select(F.lit("2208").alias("org_id"), "feed_date").distinct())
    exports.write_controls(controls, root, F.lit("JOB"))
    golden, source = _golden(spark, ORDERS_GOLDEN), f"{root}/data/*/feed/finished"
    with _settings(spark, maxPartitionBytes="32m"):  # a task holds all rows of a file that it reads whole
        for _ in range(2):
            job.run_published(spark, "divisional", source, "199*", _lists(spark), golden, out, context=job.RunContext("J", "2208", "feed"))
    parts = {
        "rows": job.published(spark, out).groupBy(F.col("verdict").alias("what")),
        "files": job.published(spark, out, "error/files").groupBy(F.col("reason").alias("what")),
        "missing": job.published(spark, out, "error/missing_files").groupBy(F.lit("").alias("what")),
        "manifest": job.published(spark, out, "manifest", text=True).groupBy(F.lit("").alias("what")),
        "control": job.published(spark, out, "control", text=True).where(F.contains("value", F.lit("JOB"))).groupBy(
            F.substring_index("value", US, 1).alias("what")
        ),
        "status": job.status_log(spark, out).events().groupBy(F.concat_ws(" ", "facility", "stage", "state").alias("what")),
    }
    told = [g.agg(F.count(F.lit(1)).alias("n")).select(F.lit(p).alias("part"), "what", "n") for p, g in parts.items()]
    return reduce(DataFrame.unionByName, told)


def warehouse_load(spark, folder):
    """A table that two loads fill, one of them again with more rows."""
    name = f"feedlake_{uuid.uuid4().hex}"
    path = shared_dir(spark)
    typed = materialise(typed_view(spark, folder))  # three loads read it, each twice
    loads = (("all", F.col("segment") != "BUILDING"), ("building", F.col("segment") == "BUILDING"), ("all", F.lit(True)))
    for n, (key, part) in enumerate(loads):
        sinks.load_warehouse_once(typed.where(part), name, key, f"R{n}", datetime(2024, 1, 1 + n, 12, tzinfo=timezone.utc), path)
    rows_ = spark.read.schema(spark.table(name).schema).parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return rows_.select("cust_key", "segment", "run_id", "load_key", F.date_format("load_ts", "yyyy-MM-dd").alias("load_day"))


def text_sink(spark, folder):
    out = shared_dir(spark)
    routed = routed_customers(spark, folder).select(
        "*", F.lit("J1").alias("job_id"), _cat("customer_", F.col("org_id")).alias("source_file"), _cat("/land/", F.col("org_id")).alias("file_path")
    )
    sinks.write_rows(routed, out, fmt="text")
    return spark.read.text(out).select("verdict", "value")


def typed_view(spark, folder):
    routed = routed_customers(spark, folder).select(
        "*", F.lit("0").alias("load_flag"), F.lit("J1").alias("job_id"), _cat("customer_", F.col("org_id")).alias("source_file")
    )
    return sinks.typed_view(routed, _golden(spark, CUSTOMER_GOLDEN), "customer")


QUERIES = {
    f.__name__: f
    for f in (
        frame_records, clean_record, control_jobid, first_line_per_file, manifest_parse,
        path_parts, classify_files, date_prefix_scan, facility_route,
        allowlist_semi, allowlist_anti, division_list, entity_param, control_semi_join,
        control_contains_join, manifest_expand, distinct_control_paths, jobid_left_join,
        paths_by_entity, entity_sizes, consolidate_union,
        golden_schema, pii_flag, catalog_counts, warehouse_query,
        schema_match, header_map, needs_reorder, numeric_positions,
        reorder_columns, pii_blank, numeric_check, arity_check, audit_columns,
        route_rows, run_audit, text_sink, typed_view,
        ingest_directory, ingest_manifest, ingest_large_files, requested_runs, stream_arrivals,
        poll_arrivals, stream_manifest, published_runs, warehouse_load,
    )
}
