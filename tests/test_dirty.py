"""Readings with NaN, infinities, large ids, missing times and vehicles of two rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetrisk.functions import readings
from fleetrisk.operators import cleaning, features, quality, training_sets
from fleetrisk.plans import dashboard

NAN, INF = float("nan"), float("inf")
START = dt.datetime(2024, 1, 1)
BIG = 2**60


@pytest.fixture(scope="module")
def dirty(spark):
    rows = []
    for i in range(24):
        temperature = NAN if i == 5 else INF if i == 9 else None if i == 13 else 90.0 + i % 3
        rows.append((BIG + i, f"V{i // 12}", START + dt.timedelta(hours=i), temperature, 12.0, 1000 + i))
    rows += [(BIG + 100, "V9", START, NAN, 11.0, 7), (BIG + 101, "V9", START + dt.timedelta(hours=1), None, NAN, 8)]
    return spark.createDataFrame(rows, "event_id long, vehicle_id string, ts timestamp, engine_temperature double, "
                                       "battery_voltage double, odometer long")


def test_nan_is_missing(dirty):
    got = {r["column"]: r["null_count"] for r in quality.null_profile(dirty).collect()}
    assert got == {"engine_temperature": 5, "battery_voltage": 1}
    assert quality.null_totals(dirty).first()["total_missing"] == 6


def test_cleaning_keeps_ids_and_ignores_nan(dirty):
    out = cleaning.clean_readings(dirty, numerical=["engine_temperature", "battery_voltage"])
    # The mileage has outliers, so it is capped and becomes a double; ids never are.
    assert dict(out.dtypes)["event_id"] == "bigint" and dict(out.dtypes)["odometer"] == "double"
    rows = {r.event_id: r for r in out.collect()}
    assert rows.keys() == {r.event_id for r in dirty.collect()}
    assert rows[BIG + 5].engine_temperature == rows[BIG + 9].engine_temperature == rows[BIG + 13].engine_temperature == 91.0
    assert max(r.engine_temperature for r in rows.values()) == 92.0


def test_integer_columns_without_outliers_keep_their_type(spark):
    df = spark.createDataFrame([(i, "V", START + dt.timedelta(hours=i), i % 5) for i in range(20)],
                               "event_id long, vehicle_id string, ts timestamp, gear int")
    out = cleaning.clean_readings(df)
    assert out.dtypes == df.dtypes and sorted(out.collect()) == sorted(df.collect())


@pytest.mark.parametrize("layout", [{}, {"hot_rows": 5, "block_rows": 4}])
def test_windows_see_null(dirty, layout):
    recipe = features.rolling_mean(["engine_temperature"], 3) + features.violations(["engine_temperature"], 3)
    plain = dirty.withColumn("engine_temperature", F.when(F.col("engine_temperature") < 1000, F.col("engine_temperature")))
    want, got = (sorted(features.with_features(df, recipe, **layout).collect()) for df in (plain, dirty))
    assert want == got and not any("nan" in str(r) for r in got)


def test_battery_health(dirty):
    assert dirty.where("event_id = %d" % (BIG + 101)).select(readings.battery_health()).first()[0] == "Poor"


def test_other_columns_get_the_median(dirty):
    df = dirty.withColumn("other", F.when(F.col("vehicle_id") == "V0", F.lit(3.0)).when(F.col("vehicle_id") == "V1", F.lit(NAN)))
    out = features.feature_table(df, cols=["battery_voltage"])
    assert {r.other for r in out.select("other").collect()} == {3.0}


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("fit_rows", [3, 1000])
def test_splits_keep_every_row(spark, share, fit_rows):
    time = lambda i: None if i % 5 == 0 else START + dt.timedelta(hours=i // 3)
    rows = [(None if i == 7 else i % 11 if i > 12 else i, time(i), i) for i in range(20)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, row int")
    train, test = ([r.row for r in part.collect()] for part in training_sets.ordered_split(df, share, fit_rows=fit_rows))
    assert sorted(train + test) == list(range(20))
    unknown = {r for e, t, r in rows if e is None or t is None}
    assert share == 1.0 or unknown <= set(train)
    key = {r: (t, e) for e, t, r in rows}
    known = [key[r] for r in train if r not in unknown]
    assert not test or not known or max(known) <= min(key[r] for r in test if r not in unknown)
    folds = training_sets.expanding_folds(df, 3, fit_rows=fit_rows)
    last = [r.row for part in folds[-1] for r in part.collect()]
    assert sorted(last) == list(range(20))


def test_equal_values_have_no_skew(spark):
    row = quality.numeric_profile(spark.createDataFrame([(2.5,)] * 6, "x double")).first()
    assert row["skew"] == row["kurtosis"] == 0.0


def test_mileage_keeps_its_fraction(spark):
    df = spark.createDataFrame([(i, f"V{i}", START, 1.0, 99.0, 1000.0 + i / 10) for i in range(9)],
                               "event_id long, vehicle_id string, ts timestamp, engine_temperature double, oil_pressure double, total_distance double")
    assert {r.vehicle_id for r in dashboard.recommendations(df, oldest=2).collect()} == {"V7", "V8"}
