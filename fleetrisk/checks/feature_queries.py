"""Checked queries: per-vehicle features, gap filling, labels and scoring columns."""

from pyspark.sql import functions as F

from fleetrisk.checks.mart_queries import importances
from fleetrisk.checks.registry import CORRELATED, PREDICTIONS, TELEMETRY, query
from fleetrisk.functions import fixed, readings
from fleetrisk.operators import features as fe
from fleetrisk.operators import labels
from fleetrisk.operators.timeline import on_timeline
from fleetrisk.sources import views

ALL = fixed.NUMERIC_INPUTS
CRITICAL = fixed.CRITICAL_INPUTS
KEYS = ["event_id", "vehicle_id"]
ORDER = "PARTITION BY vehicle_id ORDER BY ts, event_id"


def only_new(spark, sf, recipe):
    """Keys and the recipe's columns. Unneeded inputs are pruned before the shuffle."""
    t = views.telemetry(spark, sf)
    out = fe.with_features(t, recipe)
    return out.select(*KEYS, *[c for c in out.columns if c not in t.columns])


def frame(n):
    return f"({ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def guarded(fn, c, name, n):
    return f"CASE WHEN count({c}) OVER {frame(n)} >= 3 THEN {fn} OVER {frame(n)} END AS {name}"


def per_column(cols, make, source="telemetry"):
    return "SELECT event_id, vehicle_id,\n  " + ",\n  ".join(make(c) for c in cols) + f"\nFROM {source}"


def _names(cols, suffix):
    return " ".join(f"{c}_{suffix}" for c in cols)


FILLED = TELEMETRY + """,
filled AS (SELECT event_id, vehicle_id, ts, """ + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER ({ORDER} ROWS UNBOUNDED PRECEDING) AS {c}" for c in ALL) + " FROM telemetry)"


@query("rolling_mean_7", per_column(ALL, lambda c: guarded(f"avg({c})", c, f"{c}_rolling_mean_7d", 7)),
       _names(ALL, "rolling_mean_7d"), TELEMETRY)
def rolling_mean_7(spark, sf):
    return only_new(spark, sf, fe.rolling_mean(ALL))


@query("rolling_std_7", per_column(ALL, lambda c: guarded(f"stddev_samp({c})", c, f"{c}_rolling_std_7d", 7)),
       _names(ALL, "rolling_std_7d"), TELEMETRY)
def rolling_std_7(spark, sf):
    return only_new(spark, sf, fe.rolling_std(ALL))


def _pct(n):
    return per_column(ALL, lambda c: f"{c} / nullif(cast(lag({c}, {n}) OVER ({ORDER}) AS double), 0) - 1 AS {c}_pct_change_{n}d",
                      "filled")


@query("pct_change_1", _pct(1), _names(ALL, "pct_change_1d"), FILLED)
def pct_change_1(spark, sf):
    return only_new(spark, sf, fe.pct_change(ALL, 1))


@query("pct_change_7", _pct(7), _names(ALL, "pct_change_7d"), FILLED)
def pct_change_7(spark, sf):
    return only_new(spark, sf, fe.pct_change(ALL, 7))


@query("rate_of_change", per_column(CRITICAL, lambda c: f"{c} - lag({c}) OVER ({ORDER}) AS {c}_roc"),
       _names(CRITICAL, "roc"), TELEMETRY)
def rate_of_change(spark, sf):
    return only_new(spark, sf, fe.rate_of_change(CRITICAL))


@query("acceleration", per_column(CRITICAL, lambda c: f"{c}_roc - lag({c}_roc) OVER ({ORDER}) AS {c}_acceleration", f"""
  (SELECT *, {", ".join(f"{c} - lag({c}) OVER ({ORDER}) AS {c}_roc" for c in CRITICAL)} FROM telemetry) AS r"""),
       _names(CRITICAL, "acceleration"), TELEMETRY)
def acceleration(spark, sf):
    return only_new(spark, sf, fe.acceleration(CRITICAL))


@query("volatility_5", per_column(CRITICAL, lambda c: guarded(f"stddev_samp({c})", c, f"{c}_volatility", 5)),
       _names(CRITICAL, "volatility"), TELEMETRY)
def volatility_5(spark, sf):
    return only_new(spark, sf, fe.volatility(CRITICAL))


def _violation(c, side, edge):
    return (f"cast(CASE WHEN count({c}) OVER {frame(7)} >= 3 THEN count(*) FILTER ({c} {'>' if side == 'high' else '<'} {edge}e0)"
            f" OVER {frame(7)} END AS bigint) AS {c}_{side}_violations_7d")


@query("violations_7", per_column(fixed.VIOLATION_LIMITS, lambda v: _violation(*v)), "", TELEMETRY)
def violations_7(spark, sf):
    return only_new(spark, sf, fe.violations(CRITICAL))


def _rowwise(name, sql, expr, doubles=True):
    @query(name, f"SELECT event_id, vehicle_id, {sql} FROM telemetry", name if doubles else "", TELEMETRY)
    def run(spark, sf):
        return views.telemetry(spark, sf).select(*KEYS, expr().alias(name))
    return run


_rowwise("engine_stress", "(engine_temperature / 100) * (rpm / 3000) AS engine_stress", readings.engine_stress)
_rowwise("battery_health", "CASE WHEN battery_voltage > 12.4e0 THEN 'Good' WHEN battery_voltage > 12.0e0 THEN 'Fair' "
         "ELSE 'Poor' END AS battery_health", readings.battery_health, False)
_rowwise("oil_temp_ratio", "oil_pressure / (engine_temperature + 1e-5) AS oil_temp_ratio", readings.oil_temp_ratio)
_rowwise("fuel_efficiency", "distance_km / (fuel_consumption + 1e-5) AS fuel_efficiency", readings.fuel_efficiency)


@query("interactions", """
SELECT event_id, vehicle_id, engine_temperature * oil_pressure AS temp_pressure_interaction,
  max_speed_kmh * distance_km AS speed_distance_interaction,
  vehicle_age_days * total_distance / 1000e0 AS age_usage_interaction FROM telemetry""",
       "temp_pressure_interaction speed_distance_interaction age_usage_interaction", TELEMETRY)
def interactions(spark, sf):
    return views.telemetry(spark, sf).select(*KEYS, *[e.alias(n) for n, (_, e) in readings.interactions().items()])


def _dated(spark, sf, columns):
    return views.telemetry(spark, sf).select(*KEYS, *[e.alias(n) for n, e in columns.items()])


@query("calendar_features", """
SELECT event_id, vehicle_id, cast(dayofyear(date) AS integer) AS day_of_year, cast(weekofyear(date) AS integer) AS week_of_year,
  cast(quarter(date) AS integer) AS quarter FROM telemetry""", "", TELEMETRY)
def calendar_features(spark, sf):
    return _dated(spark, sf, readings.calendar(F.col("date")))


@query("cyclic_day", """
SELECT event_id, vehicle_id, sin(2 * pi() * dayofyear(date) / 365e0) AS day_sin, cos(2 * pi() * dayofyear(date) / 365e0) AS day_cos
FROM telemetry""", "day_sin day_cos", TELEMETRY)
def cyclic_day(spark, sf):
    return _dated(spark, sf, readings.cyclic_day(F.col("date")))


@query("calendar_extra", """
SELECT event_id, vehicle_id, cast(month(date) AS integer) AS month, cast(isodow(date) - 1 AS integer) AS day_of_week,
  CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM telemetry""", "", TELEMETRY)
def calendar_extra(spark, sf):
    return _dated(spark, sf, readings.calendar_extra(F.col("date")))


@query("maintenance_counter", f"""
SELECT event_id, vehicle_id, (row_number() OVER ({ORDER}) - 1) % 90 AS days_since_last_maintenance FROM telemetry""", "", TELEMETRY)
def maintenance_counter(spark, sf):
    return only_new(spark, sf, fe.maintenance_counter())


_CATALOG = ", ".join(f"('{f}', '{c}')" for c, names in fixed.FEATURE_CATALOG.items() for f in names)


@query("feature_catalog", f"""
SELECT c.feature, c.category, 'High' AS business_impact, '' AS description, i.importance
FROM (VALUES {_CATALOG}) AS c(feature, category) LEFT JOIN importances i ON i.feature = c.feature""", "importance", CORRELATED)
def feature_catalog(spark, sf):
    """The documented features, with the importances of those found in the data."""
    return fe.feature_catalog(spark).join(importances(spark, sf), "feature", "left")


# -- gap filling ------------------------------------------------------------------------------------

def _ffill(c):
    return f"last_value({c} IGNORE NULLS) OVER ({ORDER} ROWS UNBOUNDED PRECEDING)"


def _both(c):
    return f"""coalesce({_ffill(c)}, first_value({c} IGNORE NULLS) OVER ({ORDER}
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"""


_ROC = TELEMETRY + f""",
roc AS (SELECT *, engine_temperature - lag(engine_temperature) OVER ({ORDER}) AS engine_temperature_roc FROM telemetry)"""


@query("ffill_bfill", f"SELECT event_id, vehicle_id, {_both('engine_temperature')}, {_both('engine_temperature_roc')} FROM roc",
       "engine_temperature engine_temperature_roc", _ROC)
def ffill_bfill(spark, sf):
    cols = ["engine_temperature", "engine_temperature_roc"]
    recipe = fe.rate_of_change(["engine_temperature"])
    out = on_timeline(views.telemetry(spark, sf), lambda t: recipe.apply(t).fill_both(cols))
    return out.select(*KEYS, *cols)


_SAMPLE = {
    "engine_temperature": "engine_temperature",
    "engine_temperature_rolling_mean_7d": f"CASE WHEN count(engine_temperature) OVER {frame(7)} >= 3 THEN avg(engine_temperature) OVER {frame(7)} END",
    "rpm_rolling_std_7d": f"CASE WHEN count(rpm) OVER {frame(7)} >= 3 THEN stddev_samp(rpm) OVER {frame(7)} END",
    "oil_pressure_pct_change_1d": f"oil_pressure / nullif(lag(oil_pressure) OVER ({ORDER}), 0) - 1",
    "distance_km_pct_change_7d": f"distance_km / nullif(lag(distance_km, 7) OVER ({ORDER}), 0) - 1",
    "battery_voltage_roc": f"battery_voltage - lag(battery_voltage) OVER ({ORDER})",
    "engine_temperature_volatility": f"CASE WHEN count(engine_temperature) OVER {frame(5)} >= 3 THEN stddev_samp(engine_temperature) OVER {frame(5)} END",
    "engine_stress": "(engine_temperature / 100) * (rpm / 3000)",
    "oil_temp_ratio": "oil_pressure / (engine_temperature + 1e-5)",
    "fuel_efficiency": "distance_km / (fuel_consumption + 1e-5)",
    "temp_pressure_interaction": "engine_temperature * oil_pressure",
    "age_usage_interaction": "vehicle_age_days * total_distance / 1000e0",
}


@query("feature_table", f"""
SELECT event_id, vehicle_id, (row_number() OVER ({ORDER}) - 1) % 90 AS days_since_last_maintenance, {", ".join(_both(c) for c in _SAMPLE)}
FROM (SELECT event_id, vehicle_id, ts, {", ".join(f"{e} AS {c}" for c, e in _SAMPLE.items())} FROM telemetry) AS f""",
       " ".join(_SAMPLE), TELEMETRY)
def feature_table(spark, sf):
    """All stages of the feature table; twelve of its columns and the counter are compared."""
    return fe.feature_table(views.telemetry(spark, sf)).select(*KEYS, "days_since_last_maintenance", *_SAMPLE)


@query("feature_table_all")
def feature_table_all(spark, sf):
    """Every feature of every reading."""
    return fe.feature_table(views.telemetry(spark, sf))


# -- labels -----------------------------------------------------------------------------------------

NEXT = TELEMETRY + f""",
upcoming AS (SELECT *, min(fault_ts) OVER ({ORDER} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_fault_ts FROM telemetry),
dated AS (SELECT *, cast(floor((epoch_us(next_fault_ts) - epoch_us(ts)) / 86400e6) AS bigint) AS days_to_fault FROM upcoming)"""


def with_next_fault(spark, sf):
    return labels.next_fault(views.telemetry(spark, sf))


def labelled(spark, sf, horizon=30):
    return labels.with_target(with_next_fault(spark, sf), "next_fault_ts", "ts", horizon)


@query("next_fault_asof", "SELECT event_id, vehicle_id, next_fault_ts FROM upcoming", "", NEXT)
def next_fault_asof(spark, sf):
    return with_next_fault(spark, sf).select(*KEYS, "next_fault_ts")


@query("next_fault_two_tables", """
SELECT r.event_id, r.vehicle_id, r.ts, f.fault_ts, f.code
FROM (SELECT event_id, vehicle_id, ts FROM telemetry) AS r
ASOF LEFT JOIN (
  SELECT vehicle_id, fault_ts, min(code) AS code
  FROM (SELECT vehicle_id, CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('day', ts) END AS fault_ts, event_id % 7 AS code
        FROM telemetry WHERE fault_ts IS NOT NULL) AS g GROUP BY vehicle_id, fault_ts) AS f
ON r.vehicle_id = f.vehicle_id AND r.ts <= f.fault_ts""", "", TELEMETRY)
def next_fault_two_tables(spark, sf):
    """Faults in a table of their own, some at the very time of a reading, several at one time."""
    t = views.telemetry(spark, sf)
    at = F.when(F.col("event_id") % 2 == 0, F.col("ts")).otherwise(F.date_trunc("day", "ts").cast("timestamp_ntz"))
    faults = t.where("fault_ts IS NOT NULL").select("vehicle_id", at.alias("fault_ts"), (F.col("event_id") % 7).alias("code"))
    return labels.next_fault_from(t.select("event_id", "vehicle_id", "ts"), faults, carry=("code",))


@query("days_to_fault", "SELECT event_id, vehicle_id, days_to_fault FROM dated", "", NEXT)
def days_to_fault(spark, sf):
    return labelled(spark, sf).select(*KEYS, "days_to_fault")


@query("target_horizon", """
SELECT event_id, vehicle_id, CASE WHEN days_to_fault BETWEEN 0 AND 7 THEN 1 ELSE 0 END AS target_7d,
  CASE WHEN days_to_fault BETWEEN 0 AND 30 THEN 1 ELSE 0 END AS target_30d FROM dated""", "", NEXT)
def target_horizon(spark, sf):
    days = F.col("days_to_fault")
    return labelled(spark, sf).select(*KEYS, labels.within(days, 7).alias("target_7d"), labels.within(days, 30).alias("target_30d"))


@query("class_balance", """
SELECT target, count(*) AS n, count(*) / sum(count(*)) OVER () AS rate
FROM (SELECT CASE WHEN days_to_fault BETWEEN 0 AND 7 THEN 1 ELSE 0 END AS target FROM dated) AS d GROUP BY target""", "rate", NEXT)
def class_balance(spark, sf):
    return labels.class_balance(labelled(spark, sf, 7), "target")


# -- scoring columns --------------------------------------------------------------------------------

@query("scoring_features", f"""
SELECT event_id, vehicle_id, {", ".join(fixed.SCORING_INPUTS)}, (engine_temperature / 100) * (rpm / 3000) AS engine_stress,
  oil_pressure / (engine_temperature + 1e-5) AS oil_temp_ratio, distance_km * max_speed_kmh / 100e0 AS daily_usage_intensity,
  CASE WHEN engine_temperature > 105 THEN 1 ELSE 0 END AS temp_high_violation,
  CASE WHEN oil_pressure < 30 THEN 1 ELSE 0 END AS oil_low_violation,
  CASE WHEN battery_voltage < 11.8e0 THEN 1 ELSE 0 END AS battery_low_violation FROM telemetry""",
       "engine_temperature battery_voltage distance_km engine_stress oil_temp_ratio daily_usage_intensity", TELEMETRY)
def scoring_features(spark, sf):
    return views.telemetry(spark, sf).select(*KEYS, *[e.alias(n) for n, e in readings.scoring_columns().items()])


LEVEL = """CASE WHEN probability > 0.8e0 THEN 'CRITICAL' WHEN probability > 0.6e0 THEN 'HIGH'
  WHEN probability > 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END"""
ACTION = f"""CASE {" ".join(f"WHEN risk_level = '{k}' THEN '{v}'" for k, v in fixed.LEVEL_ADVICE.items())} END ||
  CASE WHEN issues = '' THEN '' ELSE ' Specific issues to address: ' || issues || '.' END"""
SCORED = PREDICTIONS + f""",
scored AS (SELECT *, {LEVEL} AS risk_level, concat_ws(', ', CASE WHEN engine_temperature > 105 THEN 'Check cooling system' END,
  CASE WHEN oil_pressure < 30 THEN 'Check oil level and pressure' END,
  CASE WHEN battery_voltage < 11.8e0 THEN 'Check battery and charging system' END) AS issues FROM predictions)"""


@query("risk_level", "SELECT event_id, vehicle_id, risk_level FROM scored", "", SCORED)
def risk_level(spark, sf):
    return views.predictions(spark, sf).select(*KEYS, readings.risk_level(F.col("probability")).alias("risk_level"))


@query("recommended_action", f"SELECT event_id, vehicle_id, {ACTION} AS recommended_action FROM scored", "", SCORED)
def recommended_action(spark, sf):
    level = readings.risk_level(F.col("probability"))
    return views.predictions(spark, sf).select(*KEYS, readings.recommended_action(level).alias("recommended_action"))


@query("confidence", """
SELECT event_id, vehicle_id, least(probability, 1 - probability) * 2 AS confidence,
  1 - least(probability, 1 - probability) * 2 AS certainty FROM predictions""", "confidence certainty", PREDICTIONS)
def confidence(spark, sf):
    p = F.col("probability")
    return views.predictions(spark, sf).select(*KEYS, readings.confidence(p).alias("confidence"),
                                               readings.certainty(p).alias("certainty"))
