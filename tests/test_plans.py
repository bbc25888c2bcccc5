"""Physical plans keep their shape: few exchanges, pruned scans, no Python, no nested loops."""

import pytest

from fleetrisk.checks import all_queries
from fleetrisk.operators import models, ranks
from fleetrisk.operators.features import FleetFeatures
from fleetrisk.operators.training_sets import expanding_folds
from fleetrisk.plans.training import training_table
from fleetrisk.sources import views

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return all_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,exchanges,scans", [
    ("maintenance_priority", 1, 1), ("feature_table_all", 1, 1), ("next_fault_asof", 1, 1), ("recommendations", 2, 1),
    ("weekly_trends", 1, 1), ("daily_fleet", 2, 1), ("scoring_features", 0, 1), ("cap_outliers", 0, 1),
    ("ordered_split", 0, 2), ("null_profile", 0, 1), ("roc_curve", 1, 1)])
def test_exchanges_and_scans(spark, name, exchanges, scans):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == exchanges
    assert text.count("FileScan") == scans
    for bad in ("NestedLoop", "Cartesian", "Python", "Pandas", "SortAggregate"):
        assert bad not in text


def test_split_reaches_the_scan(spark):
    text = plan(spark, "ordered_split")
    assert "LessThan(ts," in text and "GreaterThanOrEqual(ts," in text


def test_columns_are_pruned(spark):
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan(spark, "fleet_summary")


def test_folds_read_their_row_groups(spark):
    """Training rows are parquet in the order of time: a fold is a filter at the scan, of the columns that it needs."""
    table, stage = training_table(views.telemetry(spark, SF), inputCols=["rpm"])
    for past, coming in expanding_folds(table, 2):
        for part in (past, coming):
            text = part.select("rpm", "label")._jdf.queryExecution().executedPlan().toString()
            assert "ExistingRDD" not in text and "FileScan parquet" in text and "PushedFilters: [" in text and "PushedFilters: []" not in text
            assert "ReadSchema: struct<ts:timestamp_ntz,event_id:bigint,rpm:double,label:int>" in text
    rows = spark.read.parquet(*table.inputFiles()[:1]).select("ts").collect()
    assert rows == sorted(rows) and len(rows) > 0 and "rpm_rolling_mean_7d" in stage.features()


def test_search_reads_written_rows(spark, monkeypatch):
    """What makes the training rows runs once: every fold is a scan of files, in few partitions, whatever the rows came in."""
    seen = []

    def folds(df, *args, **more):
        seen.extend(expanding_folds(df, *args, **more))
        return seen

    monkeypatch.setattr(models, "expanding_folds", folds)
    t = views.telemetry(spark, SF).selectExpr("ts", "event_id", "rpm", "cast(event_id % 2 as int) label").repartition(64)
    models.cross_validate(t, "logistic_regression", ["rpm"], folds=2, params={"maxIter": 1})
    for past, coming in seen:
        text = past._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in text and "Exchange" not in text and past.rdd.getNumPartitions() <= 16


def test_fit_reads_written_rows(spark, monkeypatch):
    """A fit passes over a scan of files, in few partitions, whatever the rows came in; written rows are not written again."""
    seen, fit = [], models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, df: seen.append(df) or fit(self, df))
    t = views.telemetry(spark, SF).selectExpr("rpm", "cast(event_id % 2 as int) label").repartition(64)
    for balanced in (False, True):
        models.train(t, "logistic_regression", ["rpm"], balanced=balanced, maxIter=1)
        text = seen[-1]._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in text and "Exchange" not in text and seen[-1].rdd.getNumPartitions() <= 16
        assert seen[-1].select("rpm", "label").exceptAll(t.select("rpm", "label")).count() == 0 and seen[-1].count() == t.count()
    path = models.stored(t, "rows").inputFiles()[0].rsplit("/", 1)[0]
    models.train(spark.read.parquet(path), "logistic_regression", ["rpm"], written=True, maxIter=1)
    assert seen[-1].inputFiles()[0].startswith(path)


def test_training_queries_make_their_rows_once(spark, monkeypatch):
    """The windows of the labels run when the rows are written, not in the fit nor when the model is tested."""
    seen, fit, metrics = [], models.Pipeline.fit, models.model_metrics
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, df: seen.append(df) or fit(self, df))
    monkeypatch.setattr(models, "model_metrics", lambda model, test, *a: seen.append(test) or metrics(model, test, *a))
    assert all_queries()["train_gbt"](spark, SF).count() == 1
    assert len(seen) == 2
    for df in seen:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in text and "Window" not in text and "Exchange" not in text


def test_fit_gives_the_table_without_windows(spark):
    """The windows of the features run once: the fitted table is read from files, with the rows that transform gives."""
    t = views.telemetry(spark, SF)
    stage, table = FleetFeatures(inputCols=["rpm", "engine_temperature"]).fit_table(t)
    text = table._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "FileScan parquet" in text
    direct = stage.transform(t)
    assert table.columns == direct.columns and table.exceptAll(direct).count() == direct.exceptAll(table).count() == 0


@pytest.mark.parametrize("value", ["id", "pow(id, 5)", "if(id % 3 = 0, 7, id)", "id % 4", "if(id = 9, 1e300, -id)"])
def test_brackets_of_a_sketch(spark, monkeypatch, value):
    """The first counted brackets hold few rows, and the ranks in them are the sorted ones."""
    sizes = []
    rows = ranks._bracket_rows
    monkeypatch.setattr(ranks, "_bracket_rows", lambda *a, **k: sizes.append(rows(*a, **k).count()) or rows(*a, **k))
    df = spark.range(20_000).selectExpr(f"cast({value} as double) as v")
    want = sorted(r.v for r in df.collect())
    got = ranks.exact_quantiles(df, ["v"], [0.0, 0.3, 0.5, 1.0], fit_rows=100)["v"]
    for p, v in zip((0.0, 0.3, 0.5, 1.0), got):
        at = 19_999 * p
        a, b = want[int(at)], want[min(int(at) + 1, 19_999)]
        assert v == pytest.approx(a + (b - a) * (at - int(at)))
    assert sum(sizes) < 20_000
