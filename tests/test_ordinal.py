"""Cumulative-link stars: gradients and fit against numpy, scores by hand."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.operators import ordinal as OR
from newsflow.plans import catalog
from tests.conftest import SF_SMALL

GOOD, BAD = ["good", "Fine", "great", "!"], ["bad", "poor", "AWFUL", "??"]


def made(n, seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        y = draw.randrange(1, 6)
        words = [draw.choice(GOOD) if draw.random() < (y - 0.5) / 5 else draw.choice(BAD) for _ in range(12)]
        rows.append((" ".join(words), y))
    return rows


def matrix(spark, rows, buckets):
    df = spark.createDataFrame(rows, "text string, stars int").select(OR.pieces(F.col("text"), buckets).alias("b"), F.col("stars").alias("y"))
    got = df.collect()
    x = np.zeros((len(got), buckets))
    for i, r in enumerate(got):
        np.add.at(x[i], r.b, 1 / np.sqrt(max(len(r.b), 1)))
    return df, x, np.array([r.y for r in got])


def direct(x, y, weights, thresholds):
    """Log likelihood and its gradient, all rows at once."""
    s, edge = x @ weights, np.r_[-np.inf, thresholds, np.inf]
    u, low = (1 / (1 + np.exp(s - edge[y - j])) for j in (0, 1))
    p = u - low
    by_threshold = np.zeros(len(edge))
    np.add.at(by_threshold, y, u * (1 - u) / p)
    np.add.at(by_threshold, y - 1, -low * (1 - low) / p)
    return np.log(p).sum(), x.T @ (u + low - 1), by_threshold[1:-1]


def test_gradient_equals_direct_and_differences(spark):
    rows = [*made(150, 1), ("", 3), (None, 2), ("word", 5)]
    df, x, y = matrix(spark, rows, 64)
    rng = np.random.default_rng(2)
    model = OR.OrdinalModel(5, 64, rng.normal(size=64), np.array([-1.5, 0.2, -0.3, 0.1]))
    by_bucket, by_threshold, value, n = model.gradient(df.repartition(5))
    want = direct(x, y, model.weights, model.thresholds)
    assert n == len(rows) and value == pytest.approx(want[0], abs=1e-4)
    assert np.abs(by_bucket - want[1]).max() < 1e-4 and np.abs(by_threshold - want[2]).max() < 1e-4
    for k in range(0, 64, 9):
        step = np.zeros(64)
        step[k] = 1e-5
        slope = (direct(x, y, model.weights + step, model.thresholds)[0] - direct(x, y, model.weights - step, model.thresholds)[0]) / 2e-5
        assert by_bucket[k] == pytest.approx(slope, abs=1e-3)
    again = model.gradient(df.repartition(2))                # whatever the partitions: the same integers
    assert (again[0] == by_bucket).all() and (again[1] == by_threshold).all()


def test_fit_equals_direct_and_orders_held_out_rows(spark):
    _, x, y = matrix(spark, made(300, 3), 256)
    model = OR.OrdinalModel.fit(spark.createDataFrame([*made(300, 3), ("x", None), ("y", 9)], "text string, stars int").repartition(3), buckets=256, rounds=15)
    ref, seen = OR.OrdinalModel(5, 256), 0.0
    values = []
    for _ in range(15):
        value, by_bucket, by_threshold = direct(x, y, ref.weights, ref.thresholds)
        values.append(value)
        seen = ref.climb(by_bucket / len(y), by_threshold / len(y), seen)
    assert np.abs(ref.weights - model.weights).max() < 1e-3 and np.abs(ref.thresholds - model.thresholds).max() < 1e-3
    assert values[-1] > values[0] and (np.diff(model.thresholds) > 0).all()
    held = spark.createDataFrame(made(300, 4), "text string, y int")
    got = [(r.y, r.stars) for r in OR.OrdinalScorer(model).score(held, "text").collect()]
    assert np.mean([abs(a - b) for a, b in got]) < 0.8       # always three stars: 1.2
    assert all(1 <= s <= 5 for _, s in got)


def test_edges(spark):
    none = OR.OrdinalModel.fit(spark.createDataFrame([], "text string, stars int"))
    texts = spark.createDataFrame([(None, 7), ("", 7), ("a " * 200_000, 7)], "chunk string, stars_of long")
    rows = OR.OrdinalScorer(none).score(texts).collect()
    assert [r.hits for r in rows] == [0, 0, 399_999] and {r.stars for r in rows} == {3}
    plan = OR.OrdinalScorer(none).score(texts.coalesce(1))._jdf.queryExecution().optimizedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    one = OR.OrdinalModel.fit(spark.createDataFrame([("up", 5)] * 4, "text string, stars int"), buckets=32, rounds=8)
    assert OR.OrdinalScorer(one).score(spark.createDataFrame([("up",)], "chunk string")).first().stars >= 4


def test_query_scores_every_chunk(spark):
    got = catalog.QUERIES["chunk_stars_learned"](spark, SF_SMALL)
    key = ["doc_id", "sentence_no", "chunk_no"]
    all_chunks = catalog.QUERIES["person_context"](spark, SF_SMALL).select(key)
    assert got.select(key).exceptAll(all_chunks).count() == 0 and all_chunks.exceptAll(got.select(key)).count() == 0
