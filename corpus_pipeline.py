"""A training corpus from raw documents: rules, near-duplicates, benchmark, secrets, packing.

Each stage takes the documents that its predecessor kept and returns documents again; the last one
returns packed pieces.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import small, table
from feedlake.llm.decontaminate import decontaminated
from feedlake.llm.near_dedup import labelled
from feedlake.llm.packing import pack
from feedlake.llm.quality_rules import judged
from feedlake.llm.queries import tokenizer_path
from feedlake.llm.secrets import masked
from feedlake.scale import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return judged(docs).where("kept").select(*(F.col(f"row.`{c}`") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) the row of the smallest id stays.

    A null id counts as the largest; among rows of one id and different texts a hash decides. Rows
    are told apart by id and text together, and rows equal in both are reduced to one, the least by
    its columns as JSON; so are wordless texts, which are near-duplicates of nothing.
    Other columns are passed on, whatever their names and types.
    """
    taken = {c.lower() for c in docs.columns}
    free = (name for name in map("key{}".format, count()) if name not in taken)
    key = t1, t2 = next(free), next(free)  # 128 bits of id and text
    keyed = docs.withColumns({t1: F.xxhash64("doc_id", "text"), t2: F.xxhash64("text", F.lit(1), "doc_id")})
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = materialise(
        labelled(keyed.select("doc_id", "text", *key), 5, 80, keys=key)
        .groupBy(*key)
        .agg(F.min("doc_id").alias("doc_id"), F.min("component").alias("component"), F.count("*").alias("times"))
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", *key)
    groups = rows.where("component is not null").groupBy("component").agg(F.min(order).alias("stays"), F.count("*").alias("n"))
    groups = small(materialise(groups.where("n > 1").select("component", "stays")))
    found = materialise(
        rows.join(groups, "component", "left")
        .select(*key, "times", ((F.col(t1) != F.col(f"stays.{t1}")) | (F.col(t2) != F.col(f"stays.{t2}"))).alias("gone"))
        .select(*key, "times", F.coalesce("gone", F.lit(False)).alias("gone"))
        .where("gone or times > 1")
    )
    rest = keyed.join(small(found.select(*key)), [*key], "left_anti").select(*columns)
    repeated = found.where("not gone").select(*key)
    if not repeated.isEmpty():
        row = F.struct(*columns)
        one = F.min_by(row, F.to_json(row)).alias("row")
        once = keyed.join(small(repeated), [*key], "left_semi").groupBy(*key).agg(one)
        rest = rest.unionByName(once.select(*(F.col(f"row.`{c}`") for c in docs.columns)))
    return rest


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; all documents stay."""
    return masked(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised documents in sequences of 4096."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret_scans", secrets),
    ("packing", packing),
]

#: The method of more than one stage is beyond SQL; tests/llm/test_pipeline.py holds the pipeline
#: against brute force on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
