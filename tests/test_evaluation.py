"""Evaluation, marts, scoring and models on hand-made frames."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetrisk.functions import readings, risk
from fleetrisk.operators import evaluation as ev
from fleetrisk.operators import models as ml
from fleetrisk.operators import quality, scoring, training_sets
from fleetrisk.operators.features import FleetFeatures, FleetFeaturesModel
from fleetrisk.operators.oversampling import oversample
from fleetrisk.plans import dashboard, marts
from fleetrisk.sources import files, views


def frame(spark, y, p, prob=None):
    prob = prob or [float(v) for v in p]
    return spark.createDataFrame(list(zip(y, p, prob)), "label int, prediction int, probability double")


def metrics(spark, y, p):
    return ev.class_metrics(ev.confusion_matrix(frame(spark, y, p))).first()


def test_all_right_all_wrong_one_class_empty(spark):
    m = metrics(spark, [0, 1, 0, 1], [0, 1, 0, 1])
    assert (m["accuracy"], m["precision"], m["recall"], m["f1_score"]) == (1, 1, 1, 1)
    m = metrics(spark, [0, 1, 0, 1], [1, 0, 1, 0])
    assert (m["accuracy"], m["f1_score"], m["false_positive_rate"]) == (0, 0, 1)
    m = metrics(spark, [0, 0, 0], [0, 0, 0])
    assert (m["accuracy"], m["recall"], m["true_negative"], m["specificity"]) == (1, 0, 3, 1)
    m = metrics(spark, [], [])
    assert (m["accuracy"], m["true_negative"]) == (0, 0)
    one = ev.ranking_metrics(frame(spark, [0, 0], [0, 1], [0.2, 0.9])).first()
    assert one["roc_auc"] is None and one["average_precision"] is None
    assert ev.roc_curve(frame(spark, [], [])).count() == 0


@pytest.mark.parametrize("p,missed,alarms", [([0, 1, 0, 1, 0, 1], 0, 0), ([1, 0, 1, 0, 1, 0], 3, 3)])
def test_costs(spark, p, missed, alarms):
    cm = ev.confusion_matrix(frame(spark, [0, 1, 0, 1, 0, 1], p))
    c = ev.business_cost(cm).first()
    assert (c["missed_failures"], c["false_alarms"]) == (missed, alarms)
    hits = 3 - missed
    assert c["total_cost_with_pm"] == hits * 500 + alarms * 600 + missed * 5000
    assert c["total_cost_without_pm"] == 12000 and c["cost_savings"] == 12000 - c["total_cost_with_pm"]
    plan = ev.business_plan(cm).first()
    assert (plan["payback_period_years"] is None) == (plan["total_savings"] <= 0)
    assert ev.business_savings(cm).first()["estimated_savings"] == hits * 4000 - alarms * 1000


def test_ranking_by_brute_force(spark):
    rng = np.random.default_rng(5)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 40, 300) / 40
    got = ev.ranking_metrics(frame(spark, y.tolist(), y.tolist(), s.tolist())).first()
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    ap, pr, last, last_p = 0.0, 0.0, 0.0, 1.0
    for t in sorted(set(s), reverse=True):
        recall, precision = (pos >= t).mean(), (pos >= t).sum() / (s >= t).sum()
        ap += (recall - last) * precision
        pr += (recall - last) * (precision + last_p) / 2
        last, last_p = recall, precision
    assert (got["roc_auc"], got["average_precision"], got["pr_auc"]) == pytest.approx((auc, ap, pr))


def test_report_document(spark):
    doc = json.loads(ev.evaluation_report(frame(spark, [0, 1, 1], [0, 1, 0], [.1, .9, .4]), "m", "2024-01-01").first()["report"])
    assert set(doc) == {"run_date", "model_name", "dataset_info", "performance_metrics", "business_metrics", "model_interpretation"}
    assert doc["performance_metrics"]["confusion_matrix"]["true_positive"] == 1
    assert doc["model_interpretation"]["recommendations"][0].startswith("Consider tuning")


EDGES = [0.0, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 1.0]


def test_probability_edges(spark):
    df = spark.createDataFrame([(p,) for p in EDGES], "p double")
    p = F.col("p")
    rows = df.select(risk.risk_bucket(p).alias("b"), readings.risk_level(p).alias("l"), readings.confidence(p).alias("c")).collect()
    assert [r["b"] for r in rows] == [None, "Low Risk", *["Medium Risk"] * 4, "High Risk", "High Risk"]
    assert [r["l"] for r in rows] == ["LOW", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]
    assert rows[3]["c"] == 1.0
    bins = {r["bin"]: r["n"] for r in ev.calibration_bins(df.select(F.lit(1).alias("label"), p.alias("probability"))).collect()}
    assert bins == {0: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 9: 1}


def test_scoring_limits_are_strict(spark):
    base = dict(engine_temperature=105.0, oil_pressure=30.0, battery_voltage=11.8)
    hot = dict(engine_temperature=105.1, oil_pressure=29.9, battery_voltage=11.7)
    df = spark.createDataFrame([tuple(d.values()) for d in (base, hot)], "engine_temperature double, oil_pressure double, battery_voltage double")
    a, b = [r[0] for r in df.select(readings.recommended_action(F.lit("LOW"))).collect()]
    assert a == "Continue normal operation. Next scheduled maintenance."
    assert b == a + " Specific issues to address: Check cooling system, Check oil level and pressure, Check battery and charging system."


def test_risk_score_adds_left_to_right(spark):
    rows = [("a", 80.0, 25.0, 12.5, 100.0), ("b", 110.0, 40.0, 12.5, 4000.0), ("c", None, None, None, None)]
    df = spark.createDataFrame(rows, "v string, engine_temperature_mean double, oil_pressure_mean double, battery_voltage_min double, distance_km_sum double")
    score = risk.risk_score(df.columns)
    got = {r["v"]: (r["s"], r["c"], r["m"]) for r in df.select(
        "v", score.alias("s"), risk.risk_category(score).alias("c"), risk.maintenance_priority(score).alias("m")).collect()}
    assert got["a"] == ((.3 + .7 + .1 + .1) / 4, "Medium", "Within 30 days")
    assert got["b"] == ((.8 + .1 + .1 + .2) / 4, "Low", "Monitor")
    assert got["c"][0] == pytest.approx(0.1)
    assert df.select(risk.risk_score(["v"])).first()[0] == 0.0
    heavy = risk.risk_score(df.columns, {"engine_temperature_mean": 1.0})
    assert df.where("v = 'b'").select(risk.risk_category(heavy)).first()[0] == "High"


def test_weeks(spark):
    rows = [("A", dt.date(2024, 1, 7), 1, 90.0, 5.0), ("A", dt.date(2024, 1, 8), 0, 80.0, 7.0), ("B", dt.date(2024, 1, 25), 0, 70.0, 1.0)]
    df = spark.createDataFrame(rows, "vehicle_id string, date date, failure_in_next_7d int, engine_temperature double, distance_km double")
    got = {str(r["date"]): (r["engine_temperature"], r["distance_km"]) for r in dashboard.weekly_trends(df).collect()}
    assert got == {"2024-01-07": (90.0, 5.0), "2024-01-14": (80.0, 7.0), "2024-01-21": (None, 0.0), "2024-01-28": (70.0, 1.0)}
    assert dashboard.weekly_trends(df.limit(0)).count() == 0


def test_units_follow_branch_order(spark):
    df = spark.createDataFrame([(1.0, 2, "x")], "savings_percentage double, cost_per_vehicle int, failure_note string")
    got = {r["business_metric"]: tuple(r)[1:5] for r in marts.business_mart(df, "2024-01-01").collect()}
    assert got == {"Savings Percentage": (1.0, None, "USD", "Savings"), "Cost Per Vehicle": (2.0, None, "USD", "Cost Analysis"),
                   "Failure Note": (0.0, "x", "count", "Risk Analysis")}


def test_curves_start_where_nothing_is_flagged(spark):
    df = frame(spark, [1, 0, 1, 0], [1, 1, 1, 1], [0.9, 0.6, 0.6, 0.1])
    assert {tuple(r) for r in ev.roc_curve(df).collect()} == {
        (None, 0.0, 0.0), (0.9, 0.0, 0.5), (0.6, 0.5, 1.0), (0.1, 1.0, 1.0)}
    assert {tuple(r) for r in ev.pr_curve(df).collect()} == {
        (None, 1.0, 0.0, 0.5), (0.9, 1.0, 0.5, 0.5), (0.6, 2 / 3, 1.0, 0.5), (0.1, 0.5, 1.0, 0.5)}
    one_class = frame(spark, [0, 0], [0, 1], [0.2, 0.9])
    assert {tuple(r) for r in ev.roc_curve(one_class).collect()} == {(None, 0.0, None), (0.9, 0.5, None), (0.2, 1.0, None)}
    assert ev.pr_curve(frame(spark, [], [])).count() == 0


def test_labels_with_too_many_values_are_refused(spark):
    df = spark.range(500).withColumn("x", F.rand(1))
    with pytest.raises(ValueError, match="more than 100"):
        training_sets.with_class_weights(df, "id")
    with pytest.raises(ValueError, match="two classes"):
        oversample(df, "id", ["x"], seq="id")


def test_outliers_are_sought_in_every_column_unless_told(spark):
    df = spark.range(200).select(*[F.lit(1.0 * i).alias(f"c{i}") for i in range(6)],
                                 F.when(F.col("id") < 5, 1e6).otherwise(F.col("id").cast("double")).alias("late"))
    found = {r["check"] for r in quality.quality_rules(df).collect()}
    assert "outliers_late" in found
    assert "outliers_late" not in {r["check"] for r in quality.quality_rules(df, outlier_columns=5).collect()}


def test_dashboard_and_marts_are_complete(spark, tmp_path):
    t = views.telemetry(spark, "/root/testdata/sf0.001")
    tables = dashboard.dashboard(t, "2024-02-01", views.daily_predictions(spark, "/root/testdata/sf0.001"))
    assert len(tables) == 6 and all(df.count() > 0 for df in tables.values())
    p = views.as_predictions(t)
    cm = ev.confusion_matrix(p)
    built = marts.mart_set(p.drop("timestamp"), marts.with_matrix(ev.class_metrics(cm)), ev.business_cost(cm), "2024-02-01")
    assert sorted(built) == ["business_metrics", "fleet_summary", "model_metrics", "predictions"]
    files.write_marts({"fleet_summary": built["fleet_summary"]}, str(tmp_path / "m"))
    assert files.read_mart(spark, "fleet_summary", str(tmp_path / "m")).count() == 15


# -- models -----------------------------------------------------------------------------------------

FEATURES = [f"feature_{i}" for i in range(10)]


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(1000, 10))
    y = (1 / (1 + np.exp(-(x[:, 0] + 0.5 * x[:, 1] + 0.3 * x[:, 2]))) > 0.5).astype(int)
    flip = rng.choice(1000, 100, replace=False)
    y[flip] = 1 - y[flip]
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    schema = "event_id bigint, ts timestamp, " + ", ".join(f"{f} double" for f in FEATURES) + ", label int"
    return spark.createDataFrame(rows, schema).repartition(4).persist()


def test_models_learn(spark, training):
    built = {
        "logistic_regression": ml.train_logistic_regression(training, FEATURES),
        "random_forest": ml.train_random_forest(training, FEATURES, numTrees=10, maxDepth=5),
        "boosted_trees": ml.train_boosted_trees(training, FEATURES, maxIter=5),
        "gradient_boosting": ml.train_gradient_boosting(training, FEATURES, maxIter=5),
    }
    table, best = ml.compare_models(built, training)
    rows = {r["model_name"]: r for r in table.collect()}
    assert best == max(rows, key=lambda n: rows[n]["roc_auc"])
    for r in rows.values():
        assert all(0 <= r[c] <= 1 for c in ("accuracy", "precision", "recall", "f1_score", "roc_auc"))
        assert r["accuracy"] > 0.7
    for model in built.values():
        weights = [r["importance"] for r in ml.feature_importance(model, spark).collect()]
        assert len(weights) == 10 and sum(weights) > 0 and weights == sorted(weights, reverse=True)
    votes = ml.ensemble([built["logistic_regression"], built["random_forest"]], training.limit(10)).collect()
    assert len(votes) == 10 and {r["prediction"] for r in votes} <= {0, 1}


def test_search_and_folds(training):
    small = training.where("event_id < 300")
    found = ml.grid_search(small, "random_forest", FEATURES, grid=[{"numTrees": 3, "maxDepth": d} for d in (2, 4)], folds=2)
    assert 0 <= found.score <= 1 and found.params["maxDepth"] in (2, 4) and found.model is not None
    assert len(found.scores) == 4
    assert [len(ml.parameter_grid(f)) for f in ml.FAMILIES] == [1, 12, 24, 8]


def test_save_and_load(spark, training, tmp_path):
    model = ml.train_logistic_regression(training.where("event_id < 100"), FEATURES)
    ml.save_model(model, str(tmp_path / "m"), "logistic_regression", "2023-01-01")
    loaded, meta = ml.load_model(str(tmp_path / "m"))
    probe = training.where("event_id between 100 and 109").orderBy("event_id")
    assert ml.predict(model, probe).collect() == ml.predict(loaded, probe).collect()
    assert meta.first()["features_used"] == 10 and meta.first()["training_date"] == "2023-01-01"


def test_pipeline_of_raw_readings(spark, tmp_path):
    """Features, medians and model survive saving; a vehicle without any value gets the medians that were fitted."""
    t = views.telemetry(spark, "/root/testdata/sf0.001")
    stage = FleetFeatures(inputCols=["engine_temperature", "oil_pressure"]).fit(t)
    model = ml.train_logistic_regression(stage.transform(t), stage.features(), "failure_in_next_7d")
    ml.save_model(ml.from_readings(stage, model), str(tmp_path / "p"), "logistic_regression", "2024-01-01", metrics={"roc_auc": 0.75})
    loaded, meta = ml.load_model(str(tmp_path / "p"))
    assert isinstance(loaded.stages[0], FleetFeaturesModel) and loaded.stages[0].features() == stage.features()
    assert meta.first()["metrics"] == {"roc_auc": 0.75}
    new = t.where("event_id < 3").withColumn("vehicle_id", F.lit("new")).withColumn("engine_temperature", F.lit(None).cast("double"))
    medians = dict(zip(stage.getOrDefault("medianCols"), stage.getOrDefault("medians")))
    rows = loaded.stages[0].transform(new).collect()
    assert len(rows) == 3 and {r["engine_temperature_rolling_mean_7d"] for r in rows} == {medians["engine_temperature_rolling_mean_7d"]}
    assert all(r[c] is not None for r in rows for c in stage.features())
    assert {0 <= r["probability"] <= 1 for r in ml.predict(loaded, new).collect()} == {True}
    with pytest.raises(ValueError):
        loaded.transform(new.drop("oil_pressure"))


def test_bad_training_data(spark):
    one = spark.createDataFrame([(1.0, 0), (2.0, 0)], "feature double, label int")
    for df, features in ((one, ["feature"]), (one.limit(0), ["feature"]), (one, [])):
        with pytest.raises(ValueError):
            ml.train_logistic_regression(df, features)
    holes = spark.createDataFrame([(1.0, 0), (float("nan"), 1), (3.0, 0)], "feature double, label int")
    assert ml.predict(ml.train_logistic_regression(holes, ["feature"]), holes).count() == 3


def test_imbalance(training):
    skewed = training.where("label = 0 or event_id % 9 = 0")
    plain = ml.train_random_forest(skewed, FEATURES, numTrees=10, maxDepth=5)
    assert ml.model_metrics(plain, skewed, "m").first()["recall"] > 0.1
    more = oversample(skewed, "label", FEATURES, 0.5)
    assert more.where("synthetic = 1").count() > 0


def test_score_keeps_bad_rows(spark):
    t = scoring.scoring_features(views.telemetry(spark, "/root/testdata/sf0.001"))
    model = ml.train_random_forest(t, scoring.SCORING_COLUMNS, "failure_in_next_7d", numTrees=3, maxDepth=3)
    scored, rejected = scoring.score(views.telemetry(spark, "/root/testdata/sf0.001"), model)
    assert scored.count() + rejected.count() == 1000 and rejected.count() == 28


def test_the_query_searches_the_whole_grid(spark, monkeypatch):
    """The registered search looks at every point of the forest's grid on five folds, over all rows."""
    from fleetrisk.checks import all_queries

    seen = []

    def searched(df, grids, features, label, **args):
        seen.append((grids, args, df.count()))
        points = grids["random_forest"]
        return [ml.Search("random_forest", points[0], 0.5, [(p, k, 0.5) for p in points for k in range(5)])]

    monkeypatch.setattr(ml, "search", searched)
    rows = all_queries()["grid_search"](spark, "/root/testdata/sf0.001").collect()
    assert seen == [({"random_forest": ml.parameter_grid("random_forest")}, {"folds": 5}, 1000)]
    assert len({(r.num_trees, r.max_depth, r.min_instances, r.fold) for r in rows}) == len(rows) == 60


def test_fits_side_by_side(spark):
    """Small folds are fitted side by side; of large ones the driver holds two models at a time."""
    assert ml.side_by_side(spark.range(100).coalesce(1)) == 8
    assert ml.side_by_side(spark.range(100).repartition(8)) == 2 == ml.side_by_side(spark.range(300_000).coalesce(1))
    assert ml.side_by_side(spark.range(50_000).coalesce(1)) == 4


def test_folds_impute_only_where_gaps_are(spark, monkeypatch):
    """A fold's medians are those of features with gaps; scores are the ones of imputing all, and the refitted model knows all medians."""
    rng = np.random.default_rng(6)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(x), None if i % 9 == 0 else float(y), float(x + y / 2 > 0.2 * (i % 5)), float(z))
            for i, (x, y, z) in enumerate(rng.normal(size=(400, 3)))]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, a double, b double, label double, c double").cache()
    names, fitted, whole = ["a", "b", "c"], [], ml.stages

    def noted(features, gaps=None):
        fitted.append(gaps)
        return whole(features, gaps)

    found = []
    for stages in (noted, lambda features, gaps=None: whole(features)):
        monkeypatch.setattr(ml, "stages", stages)
        found.append(ml.grid_search(df, "logistic_regression", names, grid=[{"regParam": r} for r in (0.0, 0.5)], folds=2))
    assert fitted == [["b"], ["b"], None]
    assert [s for _, _, s in found[0].scores] == pytest.approx([s for _, _, s in found[1].scores]) and len(found[0].scores) == 4
    assert ml.feature_names(found[0].model) == names
    monkeypatch.setattr(ml, "stages", whole)
    assert ml.cross_validate(df, "logistic_regression", ["a", "c"], folds=2).first().mean_score > 0.5


def test_quantiles_of_many_written_columns(spark, tmp_path, monkeypatch):
    """Columns measured a few at a time have the same quantiles, gaps and empty columns too, in passes that read few of them."""
    from fleetrisk.operators import ranks

    cols = [f"v{i}" for i in range(30)]
    rows = spark.range(3_000).select(*[F.when(F.col("id") % (i + 2) != 0, (F.xxhash64("id", F.lit(i)) % 1_000) / 7.0).alias(c) for i, c in enumerate(cols)],
                                     F.lit(None).cast("double").alias("none"))
    rows.write.parquet(f"{tmp_path}/wide")
    df = spark.read.parquet(f"{tmp_path}/wide")
    want = ranks.exact_quantiles(df, [*cols, "none"], [0.25, 0.5], fit_rows=50)
    passes, measured = [], ranks._measured
    monkeypatch.setattr(ranks, "_measured", lambda values, aggs, written: passes.append(written) or measured(values, aggs, written))
    assert ranks.exact_quantiles(df, [*cols, "none"], [0.25, 0.5], fit_rows=50, written=True) == want
    assert want["none"] == [None, None] and len(passes) == 3 and all(passes)
