"""Ids of any type, repeated ids and clashing or unorderable columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedlake.llm import decontaminate, near_dedup, quality_model


def prose(seed, n=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(2 + k % 6)) for k in range(n))


@pytest.mark.parametrize("kind", ["smallint", "decimal(10,2)", "date", "string"])
def test_near_duplicates_with_ids_of_any_type(spark, kind):
    rows = spark.createDataFrame([(k, prose(k // 2)) for k in range(6)] + [(None, None)], "k long, text string")
    key = F.date_add(F.lit("2020-01-01").cast("date"), F.col("k").cast("int")) if kind == "date" else F.col("k").cast(kind)
    found = near_dedup.near_duplicates(rows.select(key.alias("doc_id"), "text")).collect()
    assert sum(r.kept for r in found if r.doc_id is not None) == 3


def test_benchmark_items_with_names(spark):
    docs = spark.createDataFrame([(1, f"x {prose(1)} y"), (2, prose(2))], "doc_id long, text string")
    items = spark.createDataFrame([("mmlu/1", prose(1)), ("mmlu/2", prose(3)), (None, prose(2))], "item_id string, text string")
    found = decontaminate.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, "mmlu/1"), (2, None)}


def test_scores_of_repeated_ids_do_not_depend_on_partitions(spark):
    rows = [(k % 20, prose(k) if k % 2 else f"{k} ### | " * 30) for k in range(80)]
    marks = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = [sorted(tuple(r) for r in quality_model.quality_scores(docs.repartition(n), marks, F.lit(False)).collect()) for n in (1, 5)]
    assert scored[0] == scored[1]


def test_pipeline_keeps_columns_of_clashing_names_and_unorderable_types(spark):
    rows = [(1, prose(1), "a", {"k": 1}, 7), (1, prose(1), "a", {"k": 2}, 7), (2, prose(2), "b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t1 string, t2 map<string,int>, key0 int")
    found = corpus_pipeline.near_dedup(spark, docs, "")
    assert found.columns == docs.columns
    assert [(r.doc_id, r.t1) for r in sorted(found.collect(), key=lambda r: r.doc_id)] == [(1, "a"), (2, "b")]
