"""Streams: batch equality, late rows, restarts."""

from pyspark.sql import functions as F

from fleetrisk.checks.registry import tidy
from fleetrisk.plans.marts import fleet_summary
from fleetrisk.sources import views
from fleetrisk.streaming import live

SF = "/root/testdata/sf0.001"


def _write(events, folder, name):
    events.coalesce(1).write.parquet(str(folder / name))


def _stream(spark, folder, schema):
    return views.as_readings(live.read_stream(spark, f"{folder}/*", schema, files_per_batch=1))


def test_late_rows_and_repeats(spark, tmp_path):
    events = views.table(spark, SF, "events").where("user_id = 1")
    schema = events.schema
    first = events.where("ts < '2024-01-05'")
    _write(first, tmp_path, "a")
    _write(events.where("ts >= '2024-01-05' and ts < '2024-01-12'"), tmp_path, "b")
    _write(first.where("ts < '2024-01-04'"), tmp_path, "c")  # three days once more, a week late
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    daily = live.live_daily(_stream(spark, tmp_path / "[abc]", schema))
    live.run_to_files(daily, out, state)
    got = {r["window_start"].date(): r["n_readings"] for r in spark.read.parquet(out).collect()}
    want = {r["d"]: r["n"] for r in events.where("ts < '2024-01-12'").groupBy(F.to_date("ts").alias("d")).agg(
        F.count("*").alias("n")).collect()}
    last = max(want)
    assert last not in got and got == {d: n for d, n in want.items() if d != last}


def test_restart_goes_on(spark, tmp_path):
    events = views.table(spark, SF, "events")
    (tmp_path / "in").mkdir()
    table, state = live.SummaryTable(str(tmp_path / "marts")), str(tmp_path / "state")
    for i, part in enumerate((events.where("event_id < 600"), events.where("event_id >= 600"))):
        _write(part, tmp_path / "in", f"p{i}")
        p = views.as_predictions(_stream(spark, tmp_path / "in", events.schema))
        live.run_marts(p, state, table.refresh)
    merged = table.summary(spark)
    batch = fleet_summary(views.predictions(spark, SF), "2024-01-01").drop("risk_category", "update_date")
    a, b = (sorted(map(str, tidy(d.select(sorted(d.columns))).collect())) for d in (merged, batch))
    assert a == b


def test_repeated_batches_change_nothing(spark, tmp_path):
    """Batches one after the other, the last two again after a failure, and one that was not written to its end."""
    p = views.predictions(spark, SF)
    table, parts = live.SummaryTable(str(tmp_path / "m")), [p.where(f"event_id % 5 = {i}") for i in range(5)]
    for number in (0, 1, 2, 3, 3, 4, 4):
        table.refresh(parts[number], number)
    assert table.versions(spark) == [3, 4]
    (tmp_path / "m" / "after=5").mkdir()
    assert table.versions(spark) == [3, 4]
    batch = fleet_summary(p, "2024-01-01").drop("risk_category", "update_date")
    a, b = (sorted(map(str, tidy(d.select(sorted(d.columns))).collect())) for d in (table.summary(spark), batch))
    assert a == b
    # What a batch reads is one state and its own rows, however many batches came before.
    assert len(spark.read.parquet(str(tmp_path / "m" / "after=4")).inputFiles()) <= len(
        spark.read.parquet(str(tmp_path / "m" / "after=3")).inputFiles()) + 1


def test_moments_keep_their_digits(spark):
    """Probabilities that differ in the ninth digit; nulls, a null vehicle and one that comes later."""
    rows = [("a", 0.9 + 1e-9 * (i % 3), 1) for i in range(30)] + [(None, 0.5, 0), ("b", None, None), ("b", 0.25, 0)]
    df = spark.createDataFrame(rows, "vehicle_id string, probability double, prediction int").withColumn("n", F.monotonically_increasing_id())
    parts = [live.partial_summary(df.where(F.col("n") % 3 == i)) for i in range(3)]
    got = {r.vehicle_id: r for r in live.summary_of_state(live.merge_states(live.merge_states(*parts[:2]), parts[2])).collect()}
    want = {r.vehicle_id: r for r in df.groupBy("vehicle_id").agg(F.stddev_samp("probability").alias("s"), F.avg("probability").alias("m")).collect()}
    assert abs(got["a"].risk_score_std / want["a"].s - 1) < 1e-4 and abs(got["a"].avg_risk_score - want["a"].m) < 1e-12
    assert got[None].total_readings == 1 and got[None].risk_score_std is None and got["b"].avg_risk_score == 0.25 and got["b"].total_readings == 1


def test_live_risk_equals_batch(spark, tmp_path):
    events = views.table(spark, SF, "events")
    stream = live.read_stream(spark, SF, events.schema, "events.parquet")
    live_rows = live.live_risk(views.as_predictions(views.as_readings(stream)))
    live.run_to_files(live_rows.select("event_id", "risk_level", "recommended_action"), str(tmp_path / "o"), str(tmp_path / "s"))
    batch = live.live_risk(views.predictions(spark, SF)).select("event_id", "risk_level", "recommended_action")
    assert sorted(spark.read.parquet(str(tmp_path / "o")).collect()) == sorted(batch.collect())
