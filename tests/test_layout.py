"""The skew-proof layouts give the same rows as the plain ones and as brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetrisk.checks.registry import tidy
from fleetrisk.functions import fixed
from fleetrisk.operators import cleaning, features, labels, timeline
from fleetrisk.operators.oversampling import nearest, oversample
from fleetrisk.operators.ranks import exact_quantiles, values_at_ranks
from fleetrisk.operators.running import running_totals
from fleetrisk.operators.evaluation import pr_curve, ranking_metrics, roc_curve
from fleetrisk.operators.training_sets import expanding_folds, ordered_split
from fleetrisk.sources import views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """Half of all readings belong to one vehicle."""
    t = views.telemetry(spark, SF)
    vehicle = F.when(F.col("event_id") % 2 == 0, "V000000000").otherwise(F.col("vehicle_id"))
    empty = F.when(F.col("event_id") < 400, None).otherwise(F.col("oil_pressure"))
    return t.withColumn("vehicle_id", vehicle).withColumn("oil_pressure", empty)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left, right = tidy(a).select(columns), tidy(b).select(columns)
    rows = [sorted(map(str, df.collect())) for df in (left, right)]
    assert rows[0] == rows[1]


LAYOUT = {"hot_rows": 100, "block_rows": 37}


@pytest.mark.parametrize("block_rows", [8, 37])
def test_feature_table_in_blocks(hot, block_rows):
    cols = ["engine_temperature", "oil_pressure", "distance_km"]
    same(features.feature_table(hot, cols, hot_rows=100, block_rows=block_rows), features.feature_table(hot, cols))


def test_single_recipes_in_blocks(hot):
    cols = fixed.CRITICAL_INPUTS
    for recipe in (features.rolling_mean(cols), features.rolling_std(cols), features.pct_change(cols, 7),
                   features.acceleration(cols), features.violations(cols), features.maintenance_counter()):
        same(features.with_features(hot, recipe, **LAYOUT), features.with_features(hot, recipe))


def test_fills_and_next_fault_in_blocks(hot):
    cols = ["engine_temperature", "oil_pressure"]
    same(cleaning.fill_forward(hot, cols, **LAYOUT), cleaning.fill_forward(hot, cols))
    same(features.fill_gaps(hot, cols, **LAYOUT), features.fill_gaps(hot, cols))
    same(labels.next_fault(hot, **LAYOUT), labels.next_fault(hot))


@pytest.mark.parametrize("limits", [{"LISTED_KEYS": 3}, {"BROADCAST_CELLS": 10}, {"LISTED_KEYS": 3, "BROADCAST_CELLS": 10}])
def test_any_number_of_hot_vehicles_is_cut(hot, monkeypatch, limits):
    """Beyond the sizes that fit a list or a broadcast, hot vehicles and blocks are looked up by joins."""
    for name, value in limits.items():
        monkeypatch.setattr(timeline, name, value)
    few = {"hot_rows": 5, "block_rows": 10}
    cols = ["engine_temperature", "oil_pressure"]
    names, keys, rows = timeline._hot_keys(hot, "vehicle_id", 5)
    want = [r["count"] for r in hot.groupBy("vehicle_id").count().collect() if r["count"] > 5]
    assert (keys, rows) == (len(want), sum(want)) and names.count() == keys > 3
    same(features.with_features(hot, features.rolling_mean(cols), **few), features.with_features(hot, features.rolling_mean(cols)))
    same(features.fill_gaps(hot, cols, **few), features.fill_gaps(hot, cols))
    same(labels.next_fault(hot, **few), labels.next_fault(hot))


def test_null_vehicle_can_be_hot(hot):
    lost = hot.withColumn("vehicle_id", F.nullif("vehicle_id", F.lit("V000000000")))
    same(features.fill_gaps(lost, ["engine_temperature"], **LAYOUT), features.fill_gaps(lost, ["engine_temperature"]))


def test_copies_of_one_reading_are_parted(hot):
    copies = hot.where("event_id = 2").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("i")
    many = hot.unionByName(copies)
    out = features.with_features(many, features.maintenance_counter(1000), hot_rows=100, block_rows=20)
    counter = out.where("vehicle_id = 'V000000000'").agg(
        F.count_distinct("days_since_last_maintenance"), F.count(F.lit(1))).first()
    assert counter[0] == counter[1] > 800


def test_quantiles_by_narrowing(spark):
    random.seed(7)
    values = [random.choice([random.gauss(0, 1), random.gauss(1e6, 1e-3), 5.0, -1e300]) for _ in range(3000)] + [None, float("nan")]
    df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)], "x double, y int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, ["x", "y"], probs, fit_rows=20)
    clean = sorted(v for v in values if v is not None and v == v)
    assert got["x"] == pytest.approx(list(np.quantile(clean, probs)), rel=1e-12)
    assert got["y"] == pytest.approx(list(np.quantile([i % 7 for i in range(len(values))], probs)))
    assert exact_quantiles(df, ["x", "y"], probs)["x"] == pytest.approx(got["x"], rel=1e-12)
    assert exact_quantiles(df.where("x is null"), ["x"], [0.5]) == {"x": [None]}


def test_values_at_ranks(spark):
    values = sorted([1] * 500 + list(range(2, 900)) + [10 ** 12] * 300)
    df = spark.createDataFrame([(v,) for v in reversed(values)], "v bigint")
    for fit in (10, 100_000):
        got = values_at_ranks(df, F.col("v"), [0, 499, 500, 1300, len(values) - 1], fit)
        assert {r: v for r, (v, _) in got.items()} == {r: values[r] for r in got}
        assert all(below == sum(x < v for x in values) for v, below in got.values())


def test_running_totals_in_pieces(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.col("id").alias("v"), (F.col("id") % 3).alias("u"))
    plain, t1 = running_totals(df, F.col("k"), ["v", "u"])
    cut, t2 = running_totals(df, F.col("k"), ["v", "u"], one_task_rows=90)
    assert t1 == t2
    same(plain, cut)


def test_curves_in_pieces(spark):
    p = views.predictions(spark, SF)
    for fn in (roc_curve, pr_curve, ranking_metrics):
        same(fn(p), fn(p, one_task_rows=50))


def test_splits_by_narrowing(spark):
    t = views.telemetry(spark, SF).select("event_id", F.date_trunc("day", "ts").alias("ts"))
    order = [r["event_id"] for r in t.orderBy("ts", "event_id").collect()]
    for args in ({}, {"fit_rows": 15}):
        train, test = ordered_split(t, 0.2, **args)
        assert sorted(r["event_id"] for r in train.collect()) == sorted(order[:-200])
        assert sorted(r["event_id"] for r in test.collect()) == sorted(order[-200:])
        size = len(order) // 6
        for k, (past, coming) in enumerate(expanding_folds(t, 5, **args)):
            start = len(order) - size * (5 - k)
            assert sorted(r["event_id"] for r in past.collect()) == sorted(order[:start])
            assert sorted(r["event_id"] for r in coming.collect()) == sorted(order[start:start + size])
    with pytest.raises(ValueError):
        expanding_folds(t.limit(3), 5)


@pytest.fixture(scope="module")
def cloud(spark):
    """400 points, 120 of them copies of one point."""
    rng = np.random.default_rng(3)
    points = [(i, *([1.0, 2.0, 3.0] if i < 120 else [float(v) for v in rng.normal(0, [1, 5, 2])])) for i in range(400)]
    return spark.createDataFrame(points, "event_id bigint, a double, b double, c double"), points


@pytest.mark.parametrize("tile_rows", [16, 60, 1000])
def test_nearest_is_exact(cloud, tile_rows):
    df, points = cloud
    x = np.array([p[1:] for p in points])
    want = np.sort(np.where(np.eye(len(x), dtype=bool), np.inf, np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))), axis=1)[:, :5]
    rows = nearest(df, ["a", "b", "c"], 5, "event_id", len(points), tile_rows).collect()
    assert len(rows) == len(points)
    for r in rows:
        assert [n["d"] for n in r["_near"]] == pytest.approx(list(want[r["event_id"]]))
        assert r["event_id"] not in [n["id"] for n in r["_near"]]
        assert len({n["id"] for n in r["_near"]}) == 5


def test_oversample(spark, cloud):
    df, points = cloud
    labelled = df.withColumn("label", (F.col("event_id") % 10 == 0).cast("int"))
    for tile_rows in (16, 1000):
        out = oversample(labelled, "label", ["a", "b", "c"], 0.3, tile_rows=tile_rows)
        counts = {(r["label"], r["synthetic"]): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
        assert counts == {(0, 0): 360, (1, 0): 40, (1, 1): 68}
    box = labelled.where("label = 1").agg(*[f(c) for c in "abc" for f in (F.min, F.max)]).first()
    for r in out.where("synthetic = 1").collect():
        for i, c in enumerate("abc"):
            assert box[2 * i] - 1e-9 <= r[c] <= box[2 * i + 1] + 1e-9
    assert oversample(labelled, "label", ["a", "b", "c"], 0.1).count() == 400
    with pytest.raises(ValueError):
        oversample(labelled.where("label = 0"), "label", ["a"])
