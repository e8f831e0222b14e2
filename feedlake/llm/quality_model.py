"""Quality classifier: supervised embeddings of hashed words, word pairs and character n-grams.

A text is the mean of its features' learned vectors; a softmax layer on top gives the probability of
label 1. Training is plain stochastic gradient descent in numpy over a bounded sample of the
labelled rows (``SAMPLE_ROWS``, each of at most ``2**BITS`` distinct features). As the layer is
linear, a feature adds the same amount to the log-odds of every text, so a text is scored by
averaging one number per feature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm import bytesnp
from feedlake.llm.common import small

BITS = 16
DIMENSIONS = 8
EPOCHS = 6
RATE = 0.4
SAMPLE_ROWS = 4000
_SALTS = [np.uint64(s) for s in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def features(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text of every word, pair of neighbouring words, and 3- and 4-gram of bytes."""
    top = np.uint64(64 - BITS)
    starts, ends = bytesnp.spans_of(~bytesnp.SPACE[data], bounds)
    words = bytesnp.span_hashes(bytesnp.prefix_hashes(data), starts, ends)
    text = bytesnp.owner(bounds, starts)
    yield (words * _SALTS[0] >> top).astype(np.int32), text
    pair = np.flatnonzero(text[1:] == text[:-1]) if len(text) else text
    yield ((words[pair] * _SALTS[1] + words[pair + 1]) * _SALTS[0] >> top).astype(np.int32), text[pair]
    inside = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    code = data.astype(np.uint64)
    for size in (2, 3, 4):
        code = code[:-1] << np.uint64(8) | data[size - 1 :]
        if size > 2 and len(code):
            whole = inside[: len(code)] == inside[size - 1 :]
            yield (code[whole] * _SALTS[size - 1] >> top).astype(np.int32), inside[: len(code)][whole]


def _bags(text: str, others: list[str]):
    """Distinct features of each text with their share of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in bytesnp.portions(batches, text):
            found = list(features(data, bounds))
            of = np.concatenate([own for _, own in found]).astype(np.int64)
            both, times = np.unique(of << BITS | np.concatenate([f for f, _ in found]), return_counts=True)
            of = both >> BITS
            share = times / np.bincount(of, weights=times, minlength=part.num_rows)[of]
            offsets = np.searchsorted(of, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in others),
                    pa.ListArray.from_arrays(offsets, pa.array((both & ((1 << BITS) - 1)).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(share.astype(np.float32))),
                ],
                [*others, "feature", "share"],
            )

    return run


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Each feature's addition to the log-odds of label 1, and the constant."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), np.float32)
    constant = np.zeros(2, np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(bags)):
            rate = RATE * (1 - done / steps)
            done += 1
            feature, share = bags[i]
            mean = share @ vectors[feature]
            logit = mean @ output + constant
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = output @ p
            output -= rate * np.outer(mean, p)
            constant -= rate * p
            # a feature's step follows its share, scaled to the text's number of features
            vectors[feature] -= rate * np.minimum(share * len(share), 4)[:, None] * back
    difference = output[:, 1] - output[:, 0]
    return vectors @ difference, float(constant[1] - constant[0])


def _trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bags, labels = [], []
    for batch in batches:
        labels += batch.column("label").to_pylist()
        bags += [(f.values.to_numpy(), s.values.to_numpy()) for f, s in zip(batch.column("feature"), batch.column("share"), strict=True)]
    order = np.argsort(labels, kind="stable")
    labels = np.array(labels, int)[order]
    weight, constant = train([bags[i] for i in order], labels)
    yield pa.RecordBatch.from_arrays([pa.array([weight.astype(np.float64).tobytes()]), pa.array([constant])], ["weight", "constant"])


def _scorer(model, text: str, others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, constant = model.value
        for part, data, bounds in bytesnp.portions(batches, text):
            n = part.num_rows
            total, times = np.zeros(n), np.zeros(n)
            for feature, of in features(data, bounds):
                total += np.bincount(of, weights=weight[feature], minlength=n)
                times += np.bincount(of, minlength=n)
            odds = np.clip(total / np.maximum(times, 1) + constant, -30, 30)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in others), pa.array(1 / (1 + np.exp(-odds)))], [*others, "score"]
            )

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per input row: (doc_id, held_out, score, predicted).

    Only the text goes into a score. Labels are learnt from rows where ``held_out`` (a condition on
    the id column, named ``doc_id`` here) is false, at most ``sample_rows`` of them, drawn by a hash
    of the id. A null or empty text has no features: its score is that of the constant alone. Null
    labels, null ids and labels other than 0 and 1 are not learnt from; an id labelled twice counts
    with its larger label, an id of several texts with the one whose hash is least. Without any label every score is 0.5. Repeated rows get a row each.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    spark = docs.sparkSession
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        "label in (0, 1) and doc_id is not null"
    )
    marks = marks.where(~F.coalesce(held_out, F.lit(False))).groupBy("doc_id").agg(F.max("label").alias("label"))
    # the sample is bounded, so both its ids and its features may be brought together
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    least = F.min(F.struct(F.xxhash64("text"), "text"))["text"]
    sample = docs.join(small(marks), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), least.alias("text"))
    bags = sample.mapInArrow(
        _bags("text", ["doc_id", "label"]),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, feature array<int>, share array<float>",
    )
    learnt = bags.orderBy("doc_id").coalesce(1).mapInArrow(_trainer, "weight binary, constant double").first()
    weight = np.frombuffer(learnt.weight) if learnt else np.zeros(1 << BITS)
    model = spark.sparkContext.broadcast((weight, learnt.constant if learnt else 0.0))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        _scorer(model, "text", ["doc_id", "held_out"]), f"doc_id {kind}, held_out boolean, score double"
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
