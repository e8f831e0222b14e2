"""Joins between manifests, control files and the files that were found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.paths import CONTROL_NAME, Layout, directory


def controls_with_manifest(controls: DataFrame, manifests: DataFrame) -> DataFrame:
    """Control files whose organisation sent a manifest; both sides have org_id."""
    return controls.join(manifests.select("org_id"), "org_id", "left_semi")


def controls_contained_in_manifest(controls: DataFrame, manifests: DataFrame) -> DataFrame:
    """Variant: the organisation id occurs anywhere in some manifest path (file_path).

    An id occurs in a path when it equals one of the path's substrings of its own length. The
    substrings are joined by equality, so paths and ids are never paired with each other.
    """
    lengths = controls.agg(F.sort_array(F.collect_set(F.length("org_id")))).scalar()
    paths = manifests.select("file_path").distinct()
    pieces = (
        paths.withColumn("n", F.explode(lengths))
        .where((F.col("n") > 0) & (F.col("n") <= F.length("file_path")))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.length("file_path") - F.col("n") + 1)))
        .select(F.substr("file_path", F.col("at"), F.col("n")).alias("piece"))
        .distinct()
    )
    return controls.join(pieces, F.col("org_id") == F.col("piece"), "left_semi")


def expand_manifest(entries: DataFrame, layout: Layout) -> DataFrame:
    """Adds file_path and control_path of the practice to accepted manifest rows.

    ``entries`` has manifest_path, practice_id and file_name.
    """
    practice_dir = layout.for_practice(directory(F.col("manifest_path")), F.col("practice_id"))
    return entries.withColumn("practice_dir", practice_dir).select(
        *entries.columns,
        F.concat("practice_dir", "file_name").alias("file_path"),
        F.concat("practice_dir", F.lit(CONTROL_NAME)).alias("control_path"),
    )


def against_listing(expanded: DataFrame, listing: DataFrame) -> DataFrame:
    """Adds ``found``: does the listing have the expanded file?"""
    present = listing.select("file_path", F.lit(True).alias("found"))
    return expanded.join(present, "file_path", "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def distinct_control_paths(expanded: DataFrame) -> DataFrame:
    return expanded.select("control_path").distinct()


def with_job_id(df: DataFrame, dir_of: Column, controls: DataFrame) -> DataFrame:
    """Job id from the control file of the same directory, empty when there is none."""
    jobs = controls.select(F.col("dir").alias("_dir"), F.col("job_id").alias("_job"))
    return df.join(jobs, dir_of == F.col("_dir"), "left").select(
        *df.columns, F.coalesce("_job", F.lit("")).alias("job_id")
    )


def paths_by_entity(files: DataFrame, entity: Column, path: Column) -> DataFrame:
    """(entity, path): the distinct files of every entity.

    The mapping stays relational. One list per entity would gather a busy entity in one task.
    """
    return files.select(F.upper(entity).alias("entity"), path.alias("path")).distinct()


def entity_sizes(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("entity").agg(F.count(F.lit(1)).alias("n_paths"))
