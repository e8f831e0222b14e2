"""The two loads: directory-driven and manifest-driven."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.manifest import manifest_entry, manifest_line
from feedlake.functions.paths import directory, entity_of, file_name, scanned_path
from feedlake.functions.rows import with_audit
from feedlake.functions.text import is_blank
from feedlake.operators.filters import allowed, for_entity
from feedlake.operators.joins import (
    against_listing,
    controls_with_manifest,
    distinct_control_paths,
    expand_manifest,
    with_job_id,
)
from feedlake.plans.load import Rules, path_is_in, routed_rows
from feedlake.scale import materialise
from feedlake.sources.control import control_records, control_table
from feedlake.sources.framed import data_records, inventory, probe


def placed(rules: Rules, pattern: str) -> Rules:
    """The rules with the organisation where the input pattern has it."""
    return replace(rules, layout=rules.layout.placed(pattern))


@dataclass(frozen=True)
class AllowLists:
    """divisions(org_id), practices(practice_id), entities(entity)."""

    divisions: DataFrame
    practices: DataFrame
    entities: DataFrame


@dataclass(frozen=True)
class Load:
    """What a load produces; the frames are lazy except the inventories behind them."""

    rows: DataFrame
    files: DataFrame
    manifest_rows: DataFrame | None = None  # every manifest record with audit fields
    manifest_rejects: DataFrame | None = None  # manifest records that name no loadable file
    missing_files: DataFrame | None = None  # named by a manifest but not in the landing tree
    control_rows: DataFrame | None = None  # control records as fields


def landing_path(input_path: str, date: str) -> str:
    """``…/data/*/…/finished`` and ``2015-09*`` as one glob."""
    return f"{input_path.rstrip('/')}/{date}"


def _in_list(column: Column, allow: DataFrame, name: str) -> Column:
    """Small lists prune files before they are opened; a long one leaves that to the probe of the inventory."""
    predicate = path_is_in(column, allow, name)
    return F.lit(True) if predicate is None else predicate


def _in_entities(entities: DataFrame, rules: Rules) -> Column:
    wanted = for_entity(entities, F.col("entity"), rules.entity)
    return _in_list(F.upper(entity_of(file_name(scanned_path()))), wanted, "entity")


def _in_practices(lists: AllowLists, rules: Rules) -> Column:
    return _in_list(F.upper(rules.layout.org_id(scanned_path())), lists.practices, "practice_id")


def directories_load(
    spark: SparkSession, paths: Sequence[str], lists: AllowLists, golden: DataFrame, rules: Rules
) -> Load:
    """Every allowed entity file of allowed practices below the paths."""
    practices = _in_practices(lists, rules)
    found = inventory(spark, paths, practices)
    path = F.col("file_path")
    entity = F.upper(entity_of(file_name(path)))
    data = allowed(found.where(F.col("kind") == "data"), entity, lists.entities, "entity")
    practice = F.upper(rules.layout.org_id(path))
    files = materialise(
        for_entity(allowed(data, practice, lists.practices, "practice_id"), entity, rules.entity)
    )
    wanted = practices & _in_entities(lists.entities, rules)
    controls = _controls(spark, paths, found, rules)
    rows = routed_rows(spark, paths, wanted, files, golden, controls, rules)
    return Load(rows=rows, files=files)


def directory_load(
    spark: SparkSession,
    input_path: str,
    date: str,
    lists: AllowLists,
    golden: DataFrame,
    rules: Rules = Rules(),
) -> Load:
    """Load every allowed entity file below the directories of allowed practices."""
    path = landing_path(input_path, date)
    return directories_load(spark, [path], lists, golden, placed(rules, path))


def _controls(
    spark: SparkSession, paths: Sequence[str], found: DataFrame, rules: Rules
) -> DataFrame:
    if found.where(F.col("kind") == "control").isEmpty():
        return spark.createDataFrame([], "dir string, job_id string")
    return materialise(control_table(spark, paths, rules.job_field, found.where(F.col("kind") == "control")))


def manifest_entries(records: DataFrame) -> DataFrame:
    """(manifest_path, line, file_name, entity, practice_id, row_count, status)."""
    return (
        records.where(~is_blank(F.col("value")))
        .withColumn("e", manifest_entry(F.col("value")))
        .select(
            F.col("file_path").alias("manifest_path"),
            manifest_line(F.col("value")).alias("line"),
            "e.*",
        )
    )


def named_files(
    records: DataFrame, found: DataFrame, lists: AllowLists, rules: Rules
) -> tuple[DataFrame, DataFrame]:
    """Manifest records as entries, and the files that the usable ones name, ``found`` in the listing or not."""
    entries = materialise(
        manifest_entries(
            allowed(records, rules.layout.org_id(F.col("file_path")), lists.divisions, "org_id")
        )
    )
    usable = allowed(
        allowed(
            entries.where(F.col("status") == "ok"),
            F.upper("practice_id"),
            lists.practices,
            "practice_id",
        ),
        F.upper("entity"),
        lists.entities,
        "entity",
    )
    return entries, materialise(against_listing(expand_manifest(usable, rules.layout), found))


def manifest_load(
    spark: SparkSession,
    input_path: str,
    date: str,
    lists: AllowLists,
    golden: DataFrame,
    rules: Rules = Rules(),
) -> Load:
    """Load the files that the manifests of allowed divisions name.

    Manifests stand with the division, data files with the practices; both are below the same
    landing root and date.
    """
    path = landing_path(input_path, date)
    rules = placed(rules, path)
    everywhere = rules.layout.any_org(path)
    division = rules.layout.org_id(scanned_path())
    is_division = _in_list(division, lists.divisions, "org_id")
    found = inventory(spark, [everywhere])
    controls = _controls(spark, [everywhere], found, rules)

    manifests = F.contains(F.upper(scanned_path()), F.lit("MANIFEST"))
    records = data_records(spark, [path], is_division & manifests, found.where(F.col("kind") == "manifest"))
    entries, expanded = named_files(records, found, lists, rules)
    named = expanded.where("found").select("file_path").distinct()
    wanted = for_entity(named, entity_of(file_name(F.col("file_path"))), rules.entity)
    files = materialise(found.join(wanted, "file_path", "left_semi"))
    keep = _in_list(scanned_path(), files, "file_path") & _in_practices(lists, rules) & _in_entities(lists.entities, rules)
    rows = routed_rows(spark, [everywhere], keep, files, golden, controls, rules)
    return Load(
        rows=rows,
        files=files,
        manifest_rows=_manifest_output(entries, controls),
        manifest_rejects=entries.where(F.col("status") != "ok"),
        missing_files=expanded.where(~F.col("found")).select("manifest_path", "file_path"),
        control_rows=_control_output(spark, everywhere, found, expanded, lists, rules),
    )


def _manifest_output(entries: DataFrame, controls: DataFrame) -> DataFrame:
    rows = with_job_id(entries, directory(F.col("manifest_path")), controls)
    line = with_audit(F.col("line"), F.col("job_id"), file_name(F.col("manifest_path")))
    return rows.select("manifest_path", line.alias("value"))


def _control_output(
    spark: SparkSession,
    everywhere: str,
    found: DataFrame,
    expanded: DataFrame,
    lists: AllowLists,
    rules: Rules,
) -> DataFrame:
    """Controls of divisions that sent a manifest, and of the practices a manifest names."""
    if found.where(F.col("kind") == "control").isEmpty():
        return spark.createDataFrame([], "file_path string, value string")
    placed = found.select("file_path", "kind", rules.layout.org_id(F.col("file_path")).alias("org_id"))
    divisional = allowed(placed, F.col("org_id"), lists.divisions, "org_id")
    own = controls_with_manifest(
        divisional.where(F.col("kind") == "control"), divisional.where(F.col("kind") == "manifest")
    ).select("file_path")
    named = distinct_control_paths(expanded).select(F.col("control_path").alias("file_path"))
    wanted = own.unionByName(named).distinct()
    listed = found.where(F.col("kind") == "control").join(wanted, "file_path", "left_semi")
    return probe(control_records(spark, [everywhere]), listed.select("file_path"))
