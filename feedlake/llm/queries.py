"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.chat_format import as_records, canonical_turns, formatted, read_back
from feedlake.llm.common import table
from feedlake.llm.decontaminate import contaminated
from feedlake.llm.hard_negatives import hard_negatives, integer_vectors
from feedlake.llm.html_text import extract_text
from feedlake.llm.licenses import license_report
from feedlake.llm.near_dedup import near_duplicates
from feedlake.llm.packing import pack
from feedlake.llm.ppm import model_scores
from feedlake.llm.quality_model import quality_scores
from feedlake.llm.quality_rules import STOP_WORDS, rule_report
from feedlake.llm.repeats import remove_repeats
from feedlake.llm.secrets import secret_report
from feedlake.llm.token_alignment import align_tokens


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rule_report(table(spark, folder, "documents"))


def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


def op3_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = model_scores(table(spark, folder, "documents"), _fold(10) != 0)
    return scored.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_report(table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path())


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_report(table(spark, folder, "documents"))


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


def op10_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), _fold(4) == 2)


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = integer_vectors(table(spark, folder, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return read_back(formatted(canonical_turns(as_records(rows, "conv_id", ["turn", "role", "text"]))))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokens(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_repeats,
        op3_model_scores,
        op4_decontaminate,
        op5_secrets,
        op6_packing,
        op7_near_duplicates,
        op8_licenses,
        op9_html_text,
        op10_quality_model,
        op11_hard_negatives,
        op12_chat_format,
        op13_token_alignment,
    )
}

_STOP = ", ".join(f"'{v}'" for w in STOP_WORDS for v in (w, w.capitalize(), w.upper()))

#: Expected results in DuckDB SQL, where it can express them.
ORACLES = {
    "op1_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) > 2),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) > 1),
repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_filter(words, lambda x: x IN ({_STOP}))) AS n_stop_words
  FROM d LEFT JOIN repeated USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND word_chars / n_words BETWEEN 2 AND 12 AND n_symbols / n_words <= 0.1
  AND n_stop_words / n_words >= 0.04 AND n_dup_lines / greatest(n_lines, 1) <= 0.4 AS kept
FROM f""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
    "op12_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn >') + length(regexp_replace(role, '([\\>])', '\\\1', 'g')) + 1
    + length(regexp_replace(text, '(<turn |</turn>|### |<\||\\)', '\\\1', 'g')) + length('</turn>') + 2) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
}
