"""Hard-negative mining: bounds from the mean and deviation of vector segments, exact scores for the rest.

For two segments of m components the inner product lies within m * (mean * mean +- deviation *
deviation). Every vector keeps mean and deviation of its finest segments; coarser ones follow from
pairs of them. A pair of vectors is bounded over few long segments first, then over more and shorter
ones as long as the bounds leave it open, and scored exactly in the end.

Anchors are the stated queries: a block of them, of bounded size, is broadcast and meets all rows in
one scan. A task keeps the best few rows of each anchor, and Spark merges them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm import bytesnp
from feedlake.scale import materialise

#: Components of the finest segments, and how many times finer a level is than the one before.
SEGMENT, FINER = 4, 4
#: Bytes of anchors that are broadcast at once, and rows that are bounded at once.
BLOCK_BYTES, ROWS, ANCHORS = 16 << 20, 2048, 512
_EXACT = float(1 << 53)


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(vec_id, label, vector): components scaled and floored, as whole numbers in doubles.

    Rows with a null label, a null vector or a null, infinite or NaN component are left out.
    """
    part = F.col(vector_col).cast("array<double>")
    odd = F.exists(part, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vector = F.transform(part, lambda x: F.floor(x * scale).cast("double"))
    return rows.where(F.col(label_col).isNotNull() & part.isNotNull() & ~odd).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), vector.alias("vector")
    )


# -- summaries ----------------------------------------------------------------------------------


def segments_of(width: int) -> int:
    """Finest segments of vectors of this width: a power of ``FINER``."""
    n = 1
    while n * SEGMENT < width:
        n *= FINER
    return n


def summarise(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each finest segment; vectors are filled up with zeros."""
    filled = np.zeros((len(vectors), segments * SEGMENT))
    filled[:, : vectors.shape[1]] = vectors
    parts = filled.reshape(len(vectors), segments, SEGMENT)
    return parts.mean(axis=2), parts.std(axis=2)


def levels(means: np.ndarray, deviations: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(means, deviations) per level, coarsest first, both times the root of the segments' length."""
    found, size = [], SEGMENT
    while True:
        found.append((means * size**0.5, deviations * size**0.5))
        if means.shape[1] == 1:
            return found[::-1]
        means, deviations = (x.reshape(len(x), -1, FINER) for x in (means, deviations))
        wide = means.mean(axis=2)
        means, deviations = wide, np.sqrt((deviations**2).mean(axis=2) + ((means - wide[:, :, None]) ** 2).mean(axis=2))
        size *= FINER


def _scores(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products row by row; beyond 64 bits the range's end."""
    largest = np.abs(one).max(initial=0) * np.abs(two).max(initial=0) * one.shape[1]
    if largest < _EXACT:
        return np.einsum("ij,ij->i", one, two).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for a, b in zip(one.tolist(), two.tolist(), strict=True)]
    return np.array([max(-(1 << 63), min(x, (1 << 63) - 1)) for x in whole], np.int64)


@dataclass
class Side:
    """Vectors with their levels."""

    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    def rows(self, at) -> Side:
        return Side(self.vectors[at], [(m[at], d[at]) for m, d in self.levels])


def open_pairs(anchors: Side, rows: Side, pairs: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs (a boolean matrix) whose score may lie from ``least`` to ``most``.

    The bounds are widened by what doubles may lose, so a pair is only left out when its score is outside.
    """
    lost = 1e-9 * (1 + np.linalg.norm(anchors.vectors, axis=1)[:, None] * np.linalg.norm(rows.vectors, axis=1)[None, :])
    a = r = None
    for (am, ad), (rm, rd) in zip(anchors.levels, rows.levels, strict=True):
        if a is None and np.count_nonzero(pairs) > pairs.size // 8:
            middle, width = am @ rm.T, ad @ rd.T + lost
            pairs &= (middle + width >= least[:, None]) & (middle - width <= most[:, None])
            continue
        if a is None:
            a, r = np.nonzero(pairs)
        middle = np.einsum("ij,ij->i", am[a], rm[r])
        width = np.einsum("ij,ij->i", ad[a], rd[r]) + lost[a, r]
        keep = (middle + width >= least[a]) & (middle - width <= most[a])
        a, r = a[keep], r[keep]
    if a is None:
        a, r = np.nonzero(pairs)
    if not len(a):
        return a, r, np.zeros(0, np.int64)
    step = max(1, (1 << 22) // max(1, anchors.vectors.shape[1]))
    score = np.concatenate([_scores(anchors.vectors[a[i : i + step]], rows.vectors[r[i : i + step]]) for i in range(0, len(a), step)])
    keep = (score >= least[a]) & (score <= most[a])
    return a[keep], r[keep], score[keep]


# -- the best rows of each slot -------------------------------------------------------------------


class Best:
    """The first ``k`` rows of every slot, by score, then id (a null id last)."""

    def __init__(self, slots: int, k: int):
        self.k, self.slots = k, slots
        self.slot, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.id, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, key: np.ndarray, row: np.ndarray) -> None:
        slot, score = np.concatenate([self.slot, slot]), np.concatenate([self.score, score])
        key, row = np.concatenate([self.id, key]), np.concatenate([self.row, row])
        order = np.lexsort((row, key, ~score, slot))
        slot = slot[order]
        first = np.searchsorted(slot, slot)
        order = order[np.arange(len(slot)) - first < self.k]
        self.slot, self.score, self.id, self.row = np.sort(slot[np.arange(len(slot)) - first < self.k]), score[order], key[order], row[order]

    def bar(self) -> np.ndarray:
        """The score that a further row has to reach, by slot; doubles round it down, never up."""
        bar = np.full(self.slots, -np.inf)
        n = np.bincount(self.slot, minlength=self.slots)
        last = np.cumsum(n) - 1
        full = n == self.k
        bar[full] = np.nextafter(self.score[last[full]], -np.inf)
        return bar


_NO_ID = (1 << 63) - 1


def _matrix(batch: pa.RecordBatch, width: int, column: str = "vector") -> np.ndarray:
    lists = batch.column(column)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _sides(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Side]]:
    """(id, row, label, vectors and levels) of at most ``ROWS`` rows at a time."""
    segments = segments_of(width)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            key, row, label = (part.column(c).fill_null(_NO_ID).to_numpy() for c in ("vec_id", "row", "label"))
            means, deviations = (_matrix(part, segments, c) for c in ("means", "deviations"))
            yield key, row, label, Side(_matrix(part, width), levels(means, deviations))
    bytesnp.release()


def _emitted(best: Best, **columns: np.ndarray) -> pa.RecordBatch:
    columns |= {"score": best.score, "found_row": best.row}
    ids = pa.array(best.id, mask=best.id == _NO_ID)
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns.values()), ids], [*columns, "found_id"])


def _nearest(block, k: int, width: int):
    """The best ``k`` other rows of the same label for every anchor of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, a_row, a_label = block.value
        best = Best(len(a_row), k)
        for key, row, label, rows in _sides(batches, width):
            bar = best.bar()
            for at in range(0, len(a_row), ANCHORS):
                own = slice(at, at + ANCHORS)
                pairs = (a_label[own, None] == label[None, :]) & (a_row[own, None] != row[None, :])
                a, r, score = open_pairs(anchors.rows(own), rows, pairs, bar[own], np.full(len(bar[own]), np.inf))
                best.add(a + at, score, key[r], row[r])
        yield _emitted(best, anchor_row=a_row[best.slot])

    return run


def _hardest(block, wanted, k: int, width: int):
    """The best ``k`` rows of other labels for every positive, scored from ``low`` to ``high`` by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, _, a_label = block.value
        owner, low, high = wanted.value  # slots in the order of their anchors
        count = len(a_label)
        first, last = np.searchsorted(owner, np.arange(count)), np.searchsorted(owner, np.arange(count), "right")
        best = Best(len(owner), k)
        for key, row, label, rows in _sides(batches, width):
            bar = np.maximum(best.bar(), np.nextafter(low, -np.inf))
            least, most = np.full(count, np.inf), np.full(count, -np.inf)
            some = bar <= high
            np.minimum.at(least, owner[some], bar[some])
            np.maximum.at(most, owner[some], np.nextafter(high[some], np.inf))
            for at in range(0, count, ANCHORS):
                own = slice(at, at + ANCHORS)
                pairs = (a_label[own, None] != label[None, :]) & (least[own] <= most[own])[:, None]
                a, r, score = open_pairs(anchors.rows(own), rows, pairs, least[own], most[own])
                a = a + at
                for step in range(int((last - first).max(initial=0))):
                    slot = np.minimum(first[a] + step, len(owner) - 1)
                    fits = (first[a] + step < last[a]) & (score >= bar[slot]) & (score >= low[slot]) & (score <= high[slot])
                    best.add(slot[fits], score[fits], key[r[fits]], row[r[fits]])
        yield _emitted(best, slot=best.slot)

    return run


def _first(found: DataFrame, by: str, k: int) -> DataFrame:
    """The first k of every slot over all tasks, which sent k at most each."""
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.col("found_id").asc_nulls_last(), "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _summarised(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = segments_of(width)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                limits = pa.array(np.arange(part.num_rows + 1) * segments, pa.int32())
                sums = [pa.ListArray.from_arrays(limits, pa.array(x.ravel())) for x in summarise(_matrix(part, width), segments)]
                names = [*part.schema.names, "means", "deviations"]
                yield pa.RecordBatch.from_arrays([*part.columns, *sums], names)

    return run


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, label, vector).

    ``vector`` holds whole numbers, as ``integer_vectors`` gives them; a shorter one counts as filled up with
    zeros. An anchor's positives are its best ``positives`` other rows of its label; a positive's negatives
    are the best ``negatives`` rows of other labels that score from ``low`` to ``high`` per cent of it. Higher
    scores come first, then smaller ids, a null id last. Repeated rows are rows of their own, as anchors and
    as others; rows equal in id, label and vector give equal results. Scores are exact within 64 bits, beyond
    them the range's end. An anchor without a positive or negative gives no row, and so does
    an empty table. Other columns are not read.
    """
    spark = vectors.sparkSession
    width = vectors.agg(F.max(F.size("vector"))).first()[0] or 1
    columns = vectors.select("vec_id", "label", "vector", F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    plain = "vec_id long, label long, vector array<double>, anchor boolean"
    stored = materialise(
        columns.mapInArrow(_summarised(width), f"{plain}, means array<double>, deviations array<double>").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    rows = stored.select("vec_id", "row", "label", "vector", "means", "deviations")
    chosen = stored.where("anchor")
    blocks = max(1, -(-chosen.count() * (8 * width + 96 * segments_of(width)) // block_bytes))
    parts = []
    for b in range(blocks):
        own = chosen.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow().combine_chunks().to_batches()
        if not own or not own[0].num_rows:
            continue
        means, deviations = (_matrix(own[0], segments_of(width), c) for c in ("means", "deviations"))
        row, label = (own[0].column(c).to_numpy() for c in ("row", "label"))
        name = dict(zip(row.tolist(), own[0].column("vec_id").to_pylist(), strict=True))
        block = spark.sparkContext.broadcast((Side(_matrix(own[0], width), levels(means, deviations)), row, label))
        near = rows.mapInArrow(_nearest(block, positives, width), "anchor_row long, score long, found_row long, found_id long")
        near = _first(near, "anchor_row", positives).collect()  # a few rows for each anchor of the block
        place = {r: k for k, r in enumerate(row.tolist())}
        near.sort(key=lambda r: (place[r.anchor_row], r.rank))
        score = np.array([r.score for r in near], np.int64)
        # in whole numbers: low * positive <= 100 * negative <= high * positive
        least, most = (np.array(x, np.int64) for x in ([-(-low * s // 100) for s in score.tolist()], [high * s // 100 for s in score.tolist()]))
        wanted = spark.sparkContext.broadcast((np.array([place[r.anchor_row] for r in near], np.int64), least, most))
        hard = rows.mapInArrow(_hardest(block, wanted, negatives, width), "slot long, score long, found_row long, found_id long")
        slots = spark.createDataFrame(
            [(k, name[r.anchor_row], r.found_id, r.score) for k, r in enumerate(near)],
            "slot long, anchor_id long, positive_id long, positive_score long",
        )
        parts.append(
            materialise(
                _first(hard, "slot", negatives)
                .join(F.broadcast(slots), "slot")
                .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
            )
        )
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    result = parts[0] if parts else spark.createDataFrame([], empty)
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
