"""Digest-first duplicates, as-of joins of two tables, eager KPIs, sketches and rejected records against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetrisk.checks import all_queries
from fleetrisk.operators import labels
from fleetrisk.operators import quality as dq
from fleetrisk.operators import sketches as sk
from fleetrisk.plans import dashboard as db
from fleetrisk.sources import files

SF = "/root/testdata/sf0.001"


def test_duplicates_with_clashing_digests(spark, monkeypatch):
    """Rows of equal digests that differ are told apart; nulls in different places too."""
    rows = [(1, None, 0.0), (1, None, -0.0), (None, 1, 0.0), (2, 2, float("nan")), (2, 2, float("nan")), (2, 2, None), (3, 3, 1.0)]
    df = spark.createDataFrame(rows, "a int, b int, c double")
    assert dq.duplicate_count(df).first()[0] == 2 and dq.duplicate_count(df.limit(0)).first()[0] == 0
    monkeypatch.setattr(dq.F, "xxhash64", lambda *cols: F.lit(7).cast("long"))
    assert dq.duplicate_count(df).first()[0] == 2


def test_duplicates_shuffle_digests(spark):
    text = all_queries()["duplicate_count"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    first = [line for line in text.splitlines() if "HashAggregate(keys=[_d1" in line]
    assert first and "Exchange hashpartitioning(_d1" in text


def plain_next(readings, faults, inclusive):
    out = {}
    for i, v, ts in readings:
        later = [(at, code) for f, at, code in faults if f == v and v is not None and ts is not None and at is not None
                 and (at >= ts if inclusive else at > ts)]
        out[i] = min(later, default=(None, None))
    return out


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("layout", [{}, {"hot_rows": 40, "block_rows": 16}])
def test_next_fault_of_another_table(spark, inclusive, layout):
    """A vehicle with half of the rows, ties, several faults at one time, nulls, a vehicle of one table only."""
    rng, day = random.Random(3), dt.datetime(2024, 1, 1)
    at = lambda: day + dt.timedelta(hours=rng.randrange(200))
    readings = [(i, "hot" if i % 2 else f"v{i % 5}", at()) for i in range(160)] + [(900, None, at()), (901, "v1", None), (902, "alone", at())]
    faults = [("hot" if i % 2 else f"v{i % 5}", at(), i % 4) for i in range(60)] + [(None, at(), 1), ("v1", None, 1), ("other", at(), 2)]
    faults += [("hot", readings[1][2], 9), ("hot", readings[1][2], 8)]
    left = spark.createDataFrame(readings, "event_id long, vehicle_id string, ts timestamp_ntz")
    right = spark.createDataFrame(faults, "vehicle_id string, fault_ts timestamp_ntz, code int")
    got = labels.next_fault_from(left, right, carry=("code",), inclusive=inclusive, **layout)
    assert got.columns == ["event_id", "vehicle_id", "ts", "fault_ts", "code"]
    assert {r.event_id: (r.fault_ts, r.code) for r in got.collect()} == plain_next(readings, faults, inclusive)
    with pytest.raises(ValueError):
        labels.next_fault_from(left.withColumn("code", F.lit(1)), right, carry=("code",))


def test_eager_kpis(spark):
    """Several predictions on a day count once for each of its readings, and days without one stay."""
    t = spark.createDataFrame([("a", "2024-01-01", 1, 90.0, 30.0, 10.0, 2.0), ("a", "2024-01-01", 0, None, 40.0, 9.0, 0.0), ("a", "2024-01-02", 0, 80.0, None, 8.0, None),
                               ("b", "2024-01-01", 1, 70.0, 20.0, None, 4.0), (None, "2024-01-01", 0, 60.0, 10.0, 5.0, 5.0)],
                              "vehicle_id string, date string, failure_in_next_7d int, engine_temperature double, oil_pressure double, distance_km double, fuel_consumption double")
    p = spark.createDataFrame([("a", "2024-01-01", 1, 0.9), ("a", "2024-01-01", 1, 0.2), ("b", "2024-01-01", 0, 0.8), ("c", "2024-01-01", 1, 0.9)],
                              "vehicle_id string, date string, predicted_failure int, risk_score double")
    for rows, predictions in ((t, p), (t, p.drop("risk_score")), (t.drop("fuel_consumption"), p), (t.limit(0), p)):
        want = db.fleet_kpis(db.join_predictions(rows, predictions), "2024-02-01").first().asDict()
        got = db.fleet_kpis_joined(rows, predictions, "2024-02-01").first().asDict()
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert got[k] == (pytest.approx(v) if isinstance(v, float) else v), k


def test_kpis_join_days_only(spark):
    """The only readings that are shuffled are sums of vehicles and days; both sides meet on that partitioning."""
    text = all_queries()["fleet_kpis"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(vehicle_id") == 2 and "SortMergeJoin" in text or "BroadcastHashJoin" in text
    for at, line in enumerate(text.splitlines()):
        if "Exchange hashpartitioning(vehicle_id" in line:
            assert "Aggregate" in text.splitlines()[at + 1]


def test_sketches_are_merged(spark):
    """Ten unlike groups, nulls, NaN, a group without values and an empty table; any split gives the same counts."""
    rng = random.Random(5)
    rows = [(i % 10, float(rng.choice([rng.gauss(0, 1), 10**6 * rng.random(), 5.0])), str(i % 700)) for i in range(6_000)]
    rows += [(3, None, None), (4, float("nan"), "x"), (77, None, None), (77, float("inf"), None)]
    df = spark.createDataFrame(rows, "day int, x double, name string")
    table = sk.sketch_table(df, ["day"], ["x"], ["name"])
    assert table.where("column = 'x' and day = 77").select("rows", "n", "least").first() == (2, 0, None)
    got = {r["column"]: r for r in sk.approximate_profile(table).collect()}
    assert (got["x"]["rows"], got["x"].nulls, got["name"].nulls, got["name"].p50) == (6_004, 4, 3, None)
    values = [x for _, x, _ in rows if x is not None and x == x and x != float("inf")]
    assert (got["x"].min, got["x"].max) == (min(values), max(values))
    profile = sk.approximate_profile(table)
    assert sk.rank_bounds(df, profile).first().rank_error <= sk.RANK_ERROR
    assert abs(got["x"].n_distinct / len(set(values)) - 1) <= sk.DISTINCT_ERROR and abs(got["name"].n_distinct / 701 - 1) <= sk.DISTINCT_ERROR
    halves = sk.merged(table.where("day < 5")).unionByName(sk.merged(table.where("day >= 5")))
    assert {r["column"]: (r["rows"], r.min, r.max) for r in sk.approximate_profile(halves).collect()} == {c: (r["rows"], r.min, r.max) for c, r in got.items()}
    low, high = sk.approximate_bounds(table)["x"]
    assert low < got["x"].p25 < got["x"].p75 < high
    assert sk.approximate_profile(sk.sketch_table(df.limit(0), ["day"], ["x"])).count() == 0


def test_rejected_records(spark, tmp_path):
    """Every record of a file is in one of the tables, with its text if it cannot be read."""
    schema = "id int, name string, x double, at timestamp"
    (tmp_path / "a.csv").write_text('id,name,x,at\n1,"a, b",1.5,2024-01-01T00:00:00\n2,c,one,2024-01-01T00:00:00\n3,d\n\n4,e,2.5,2024-01-02T00:00:00,more\n5,,NaN,\n')
    good, bad = files.read_with_rejects(spark, str(tmp_path / "a.csv"), schema)
    assert [(r.id, r.name, r.x) for r in good.orderBy("id").collect()] == [(1, "a, b", 1.5), (5, None, None)]
    assert sorted(r.record[:4] for r in bad.collect()) == ["2,c,", "3,d", "4,e,"] and "a.csv" in bad.first().file
    assert files.read_readings(spark, str(tmp_path / "a.csv"), schema).count() == 5  # unseen nulls without it
    with pytest.raises(ValueError):
        files.read_with_rejects(spark, str(tmp_path / "a.csv"), "id int, x double, name string, at timestamp")
    with pytest.raises(ValueError):
        files.read_with_rejects(spark, str(tmp_path / "a.txt"), schema)
    (tmp_path / "b.json").write_text('{"id": 1, "name": "a"}\n{"id": "no", "name": "b"}\n{"id": 3, "na\n\n{"id": 4, "x": 2.5}\n')
    good, bad = files.read_with_rejects(spark, str(tmp_path / "b.json"), schema)
    assert [(r.id, r.name, r.x) for r in good.orderBy("id").collect()] == [(1, "a", None), (4, None, 2.5)]
    assert sorted(r.record for r in bad.collect()) == ['{"id": "no", "name": "b"}', '{"id": 3, "na']
    (tmp_path / "c.json").write_text('[{"id": 1, "name": "a, [b"},\n {"id": 2, "name": "x}y"}, {"id": 3}\n]\n')
    good, bad = files.read_with_rejects(spark, str(tmp_path / "c.json"), schema, array=True)
    assert [(r.id, r.name) for r in good.orderBy("id").collect()] == [(1, "a, [b"), (3, None)] and bad.count() == 2
    (tmp_path / "d.json").write_text("[]")
    assert [df.count() for df in files.read_with_rejects(spark, str(tmp_path / "d.json"), schema, array=True)] == [0, 0]
