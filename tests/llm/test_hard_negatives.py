"""Hard negatives against products and sorts in plain Python."""

import math
import random

import numpy as np
import pytest
from llm_data import TINY
from pyspark.sql import functions as F

from tierstone.llm import hard_negatives, queries
from tierstone.llm.hard_negatives import Layout

SCHEMA = "vec_id long, embedding array<float>, label int, row long, planes string, score double, positives int"


def plainly(rows):
    """The contract's rows, every product written out."""
    kept = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for i, (anchor_id, own, a) in enumerate(kept):
        if anchor_id % 50:
            continue
        others = sorted(
            (-sum(x * y for x, y in zip(a, v)), vec_id, label) for j, (vec_id, label, v) in enumerate(kept) if j != i
        )
        for score, positive_id, _ in [x for x in others if x[2] == own][:5]:
            p = -score
            near = [x for x in others if x[2] != own and 50 * p <= -100 * x[0] <= 95 * p][:3]
            found += [(anchor_id, positive_id, k + 1, x[1], p, -x[0]) for k, x in enumerate(near)]
    return sorted(found)


def mined(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = hard_negatives.mine(df, F.col("vec_id") % 50 == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def some_rows(n, dimensions, seed, spread=1.0, labels=3):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(dimensions)] for _ in range(4)]
    return [
        (i, [spread * (m + rng.gauss(0, 0.3)) for m in rng.choice(middle)], rng.randrange(labels), 1, "p", 0.5, 2)
        for i in range(n)
    ]


@pytest.mark.parametrize("dimensions, largest", [(1, 1), (8, 255), (13, 256), (64, 100_000), (3, 1 << 28)])
def test_tables_and_planes_give_the_inner_product(dimensions, largest):
    rng = np.random.default_rng(dimensions)
    vectors = rng.integers(-largest, largest + 1, (40, dimensions))
    vectors[0], vectors[1] = -largest, largest
    layout = Layout.of(dimensions, largest)
    planes = layout.pack(vectors)
    assert planes.shape == (40, layout.places, layout.groups)
    whole = layout.unpack(planes)
    assert np.array_equal(whole[:, :dimensions], vectors) and not whole[:, dimensions:].any()
    assert np.array_equal(layout.scores(layout.tables(whole[:7]), planes), vectors @ vectors[:7].T)


def test_scores_beyond_64_bits_are_refused():
    with pytest.raises(OverflowError):
        Layout.of(64, 1 << 40)


@pytest.mark.parametrize("dimensions, spread", [(5, 1.0), (16, 300.0)])
def test_equals_plain_sorting(spark, dimensions, spread):
    rows = some_rows(240, dimensions, dimensions, spread)
    assert mined(spark, rows) == plainly(rows) != []


def test_ties_repeats_and_hot_vectors(spark, monkeypatch):
    """A third of the rows share a vector, some rows come twice; strips and anchors are small."""
    monkeypatch.setattr(hard_negatives, "STRIP_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 2)
    rows = some_rows(150, 4, 1)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, *rest) for i, v, *rest in rows]
    rows += rows[45:55] + [(0, [0.1, 0.2, 0.3, 0.4], 1, 0, "", 0.0, 0)]
    assert mined(spark, rows) == plainly(rows) != []


def test_rows_that_take_no_part(spark):
    rows = some_rows(120, 6, 2)
    odd = [
        (None, [1.0] * 6, 1), (50, None, 1), (100, [1.0] * 6, None), (50, [1.0, None] * 3, 1),
        (7, [float("nan")] * 6, 1), (9, [float("inf")] * 6, 2), (11, [], 1), (50, [2.0], 2), (13, [0.5] * 30, 0),
        (None, None, None),
    ]
    rows += [(*r, None, None, None, None) for r in odd]
    assert mined(spark, rows) == plainly(rows) != []


def test_no_rows_or_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, some_rows(30, 3, 3)[1:]) == []
    assert mined(spark, [(50, [1.0], 1, 0, "", 0.0, 0)]) == []


def test_query_equals_sql(spark, duck):
    ours = queries.QUERIES["op11_hard_negatives"](spark, TINY)
    columns = ", ".join(ours.columns)
    theirs = duck.sql(f"SELECT {columns} FROM ({queries.ORACLES['op11_hard_negatives']})").fetchall()
    assert sorted(tuple(r) for r in ours.collect()) == sorted(theirs) != []


def test_candidates_are_dealt_once_and_in_many_tasks(spark):
    rows = spark.createDataFrame(some_rows(400, 4, 5), SCHEMA)
    plan = hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(group" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
