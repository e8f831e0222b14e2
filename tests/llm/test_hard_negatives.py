from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import hard_negatives as h

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, positives=5, negatives=5, every=3):
    """(anchor, positive, rank, negative, scores) by sorting all rows for every anchor."""
    kept = []
    for key, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((key, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    for k, (key, label, vector) in enumerate(kept):
        if key is None or key % every:
            continue
        scored = sorted(((-score(vector, r[2]), r[0] is None, r[0] or 0, j) for j, r in enumerate(kept) if j != k))
        near = [s for s in scored if kept[s[3]][1] == label][:positives]
        for p in near:
            hard = [s for s in scored if kept[s[3]][1] != label and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:negatives]
            out += [(key, kept[p[3]][0], n + 1, kept[s[3]][0], -p[0], -s[0]) for n, s in enumerate(hard)]
    return sorted(out, key=repr)


def mined(spark, rows, every=3, **options):
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "anchor": F.lit("x"), "means": F.lit(2)}).repartition(3)
    found = h.hard_negatives(h.integer_vectors(table), F.col("vec_id") % every == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def vectors(n, width, seed, labels=3):
    random = np.random.default_rng(seed)
    middles = random.normal(0, 0.3, (4, width))
    rows = middles[random.integers(0, 4, n)] + random.normal(0, 0.1, (n, width))
    return [(k, int(random.integers(0, labels)), [float(x) for x in v]) for k, v in enumerate(rows.astype(np.float32))]


@pytest.mark.parametrize(("n", "width"), [(300, 64), (200, 7), (60, 1)])
def test_equals_sorting_all_rows(spark, n, width):
    rows = vectors(n, width, n)
    assert mined(spark, rows) == brute(rows)


def test_blocks_of_anchors_change_nothing(spark):
    rows = vectors(150, 20, 5)
    assert mined(spark, rows, block_bytes=3000) == brute(rows)


def test_ties_copies_nulls_and_odd_rows(spark):
    rows = vectors(60, 8, 6)
    same = rows[7][2]
    rows += [(100 + k, k % 2, same) for k in range(25)]  # ties go to the smaller id
    rows += [(3, 1, rows[3][2]), (None, 0, same), (None, 1, same), (200, None, same), (201, 1, None), (202, 1, [None] * 8)]
    rows += [(204, 1, [float("nan")] * 8), (207, 0, [float("inf")] + [0.0] * 7), (210, 0, []), (213, 1, same[:3]), (216, 0, [0.0] * 8)]
    rows += [(219, 5, same), (222, 6, [-x for x in same])]  # the only row of its label
    assert mined(spark, rows) == brute(rows)


def test_values_beyond_doubles(spark):
    rows = [(k, k % 2, [float(np.float32(1e6 + 3 * k)), float(np.float32(-2e5 * k)), 5.0]) for k in range(12)]
    assert mined(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_bounds_hold_at_every_level():
    random = np.random.default_rng(1)
    one, two = (np.floor(random.normal(0, 80, (40, 50))) for _ in range(2))
    sides = [h.Side(x, h.levels(*h.summarise(x, h.segments_of(50)))) for x in (one, two)]
    exact, before = one @ two.T, None
    for (am, ad), (bm, bd) in zip(sides[0].levels, sides[1].levels, strict=True):
        middle, width = am @ bm.T, ad @ bd.T
        assert (np.abs(exact - middle) <= width + 1e-6).all()
        assert before is None or width.mean() <= before  # finer levels are tighter
        before = width.mean()


def test_pairs_outside_the_bounds_are_never_scored(monkeypatch):
    """The summaries alone rule pairs out."""
    ones, negative = np.full((5, 16), 10.0), np.full((50, 16), -10.0)
    sides = [h.Side(x, h.levels(*h.summarise(x, 4))) for x in (ones, negative)]
    monkeypatch.setattr(h, "_scores", lambda *a: pytest.fail("scored"))
    a, _, _ = h.open_pairs(*sides, np.ones((5, 50), bool), np.zeros(5), np.full(5, np.inf))
    assert not len(a)
