"""Loading, validation, cleaning and labels on hand-made frames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fleetrisk.operators import cleaning as cl
from fleetrisk.operators import features as fe
from fleetrisk.operators import labels, quality
from fleetrisk.operators.training_sets import select_features
from fleetrisk.sources import files

START = dt.datetime(2023, 1, 1)


@pytest.fixture(scope="module")
def sample(spark):
    """100 hourly readings: nulls in two columns, one outlier, faults 1..59 days ahead."""
    rows = []
    for i in range(100):
        rows.append((
            f"V{i % 4:03d}", START + dt.timedelta(hours=i), i, None if i < 5 else 1500.0 + (i * 37) % 1000,
            200.0 if i == 20 else 80.0 + i % 20, 6.0 + (i * 7) % 5, float((i * 1999) % 200000),
            ["SUV", "Sedan", "Truck"][i % 3], None if 10 <= i < 15 else ["Petrol", "Diesel", "Electric"][i * i % 3], 0.0,
            START + dt.timedelta(hours=i, days=1 + (i * 13) % 59)))
    return spark.createDataFrame(rows, "vehicle_id string, timestamp timestamp, event_id bigint, engine_rpm double, "
                                 "oil_temperature double, fuel_consumption double, mileage double, vehicle_type string, "
                                 "fuel_type string, unused_column double, fault_date timestamp")


def test_read_csv_json_and_reject_others(spark, sample, tmp_path):
    files.write_table(sample.select("vehicle_id", "engine_rpm"), str(tmp_path / "a.csv"))
    assert files.read_readings(spark, str(tmp_path / "a.csv")).count() == 100
    (tmp_path / "b.json").write_text(json.dumps([{"x": 1, "y": "a"}, {"x": 2, "y": None}]))
    assert sorted(r["x"] for r in files.read_readings(spark, str(tmp_path / "b.json")).collect()) == [1, 2]
    with pytest.raises(ValueError, match="Unsupported file format"):
        files.read_readings(spark, "readings.txt")
    with pytest.raises(ValueError, match="Unsupported file format"):
        files.write_table(sample, "readings.pkl")
    with pytest.raises(ValueError, match="Unknown mart"):
        files.read_mart(spark, "nope")


def test_requests_explode(spark):
    df = spark.createDataFrame([([("a", 1.0), ("b", 2.0)],)], "vehicles array<struct<vehicle_id:string,rpm:double>>")
    assert [tuple(r) for r in files.explode_requests(df).collect()] == [("a", 1.0), ("b", 2.0)]


def test_report(sample):
    rows = {(r["section"], r["column"], r["metric"]): r["value"] for r in
            quality.validation_report(sample, {"vehicle_id": "object", "mileage": "int64", "absent": "object"}).collect()}
    assert rows["table", None, "total_records"] == 100
    assert rows["duplicates", None, "duplicate_records"] == 0
    assert rows["missing_values", "engine_rpm", "null_count"] == 5
    assert rows["missing_values", "fuel_type", "null_pct"] == 5.0
    assert rows["outliers", "oil_temperature", "outliers_count"] == 1
    assert rows["data_type_issues", "mileage", "mismatch"] == 1.0
    assert ("data_type_issues", "vehicle_id", "mismatch") not in rows


def test_clean(sample):
    out = cl.clean_readings(sample, ["vehicle_type", "fuel_type"], ["engine_rpm", "oil_temperature"],
                            ["timestamp", "fault_date"], order=("timestamp", "event_id"))
    assert out.count() == 100
    assert fe.columns_with_nulls(out, out.columns) == []
    assert out.agg(F.max("oil_temperature")).first()[0] < 200


def test_duplicates_are_dropped(sample):
    twice = sample.unionByName(sample)
    assert quality.duplicate_count(twice).first()[0] == 100
    assert cl.clean_readings(twice, ["fuel_type"], ["engine_rpm"], order=("timestamp", "event_id")).count() == 100


def test_empty_and_single_row(sample):
    empty = sample.limit(0)
    assert quality.null_profile(empty).count() == 0 and quality.duplicate_count(empty).first()[0] == 0
    assert quality.iqr_outliers(empty).count() == 0 and quality.content_hash(empty).first()["n_records"] == 0
    assert quality.quality_rules(empty).select("quality_score").first()[0] == 1.0
    assert cl.clean_readings(empty, order=("timestamp", "event_id")).count() == 0
    one = sample.limit(1)
    assert labels.with_target(one).count() == 1
    assert cl.clean_readings(one, order=("timestamp", "event_id")).count() == 1


def test_days_round_down_and_horizon(spark):
    day = dt.timedelta(days=1)
    gaps = [(-day / 2, -1, 0), (day / 2, 0, 1), (7 * day, 7, 1), (7 * day + 23 * day / 24, 7, 1), (8 * day, 8, 0)]
    rows = [(START, START + g) for g, _, _ in gaps] + [(START, None)]
    got = labels.with_target(spark.createDataFrame(rows, "timestamp timestamp, fault_date timestamp"), horizon=7).collect()
    assert [(r["days_to_fault"], r["target"]) for r in got] == [(d, t) for _, d, t in gaps] + [(None, 0)]


def test_missing_columns(sample):
    with pytest.raises(ValueError, match="fault_date"):
        labels.with_target(sample.drop("fault_date"))
    with pytest.raises(ValueError, match="target"):
        select_features(sample, "target")
    features = select_features(labels.with_target(sample), "target", drop=["unused_column"])
    assert sorted(features.columns) == ["engine_rpm", "fuel_consumption", "mileage", "oil_temperature", "target"]


def test_mode_tie_and_text(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    assert cl.modes(df, ["c"]) == {"c": "a"}
    assert quality.categorical_profile(df).first()["top_value"] == "a"
    assert cl.modes(df.limit(0), ["c"]) == {}


def test_row_errors(spark):
    df = spark.createDataFrame([("a", 1.0), (" ", float("nan")), (None, float("inf"))], "vehicle_id string, rpm double")
    good, bad = quality.split_valid(df, ["vehicle_id", "rpm"])
    assert good.count() == 1 and [len(r["errors"]) for r in bad.collect()] == [2, 2]


def test_hash_ignores_row_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(2, None), (1, "x")], "i int, s string")
    c = spark.createDataFrame([(2, ""), (1, "x")], "i int, s string")
    h = [quality.content_hash(d).first() for d in (a, b, c)]
    assert h[0] == h[1] != h[2]


def _vehicle(spark, values, vehicle="A"):
    rows = [(vehicle, START + dt.timedelta(days=i), i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "vehicle_id string, ts timestamp, event_id bigint, x double")


def _column(df, name):
    return [r[name] for r in df.orderBy("event_id").collect()]


def test_fills(spark):
    df = _vehicle(spark, [None, 1.0, None, 4.0, None])
    assert _column(cl.fill_forward(df, ["x"]), "x") == [None, 1.0, 1.0, 4.0, 4.0]
    assert _column(fe.fill_gaps(df, ["x"]), "x") == [1.0, 1.0, 1.0, 4.0, 4.0]
    assert _column(fe.with_features(df, fe.pct_change(["x"], 1)), "x_pct_change_1d") == [None, None, 0.0, 3.0, 0.0]
    assert _column(cl.fill_median(df, ["x"]), "x") == [2.5, 1.0, 2.5, 4.0, 2.5]


@pytest.mark.parametrize("n", [2, 3, 7, 8])
def test_minimum_rows(spark, n):
    df = _vehicle(spark, [float(i + 1) for i in range(n)])
    means = _column(fe.with_features(df, fe.rolling_mean(["x"])), "x_rolling_mean_7d")
    assert [m is None for m in means] == [i < 2 for i in range(n)]
    assert means[-1] == (None if n < 3 else sum(range(max(1, n - 6), n + 1)) / min(n, 7))
    assert _column(fe.with_features(df, fe.pct_change(["x"], 7)), "x_pct_change_7d")[7:] == [7.0] * (n == 8)


def test_zero_base_and_short_vehicles_get_medians(spark):
    rows = [("A", START + dt.timedelta(days=i), i, float(i), START.date()) for i in range(10)]
    rows += [("B", START, 99, 5.0, START.date())]
    df = spark.createDataFrame(rows, "vehicle_id string, ts timestamp, event_id bigint, oil_pressure double, date date")
    out = fe.feature_table(df)
    assert fe.columns_with_nulls(out, out.columns) == []
    b = out.where("vehicle_id = 'B'").first()
    a = [r["oil_pressure_roc"] for r in out.where("vehicle_id = 'A'").collect()]
    assert b["oil_pressure_roc"] == sorted(a)[len(a) // 2]


def test_feature_names(spark):
    from fleetrisk.sources import views
    t = views.telemetry(spark, "/root/testdata/sf0.001")
    new = set(fe.feature_table(t).columns) - set(t.columns)
    assert len(new) == 67


def test_calendar_edges(spark):
    from fleetrisk.functions import readings
    df = spark.sql("select date'2024-12-30' d union all select date'2024-12-31' union all select date'2024-01-06'")
    got = df.select("d", *[e.alias(n) for n, e in {**readings.calendar(F.col("d")), **readings.calendar_extra(F.col("d"))}.items()])
    rows = {str(r["d"]): r for r in got.collect()}
    assert rows["2024-12-30"]["week_of_year"] == 1 and rows["2024-12-31"]["day_of_year"] == 366
    assert (rows["2024-01-06"]["day_of_week"], rows["2024-01-06"]["is_weekend"]) == (5, 1)
