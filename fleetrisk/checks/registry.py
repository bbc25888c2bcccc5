"""Names the checked queries and pairs each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetrisk.functions.numbers import fix

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

RUN_DATE = "2024-02-01"


def query(name: str, sql: str | None = None, doubles: str = "", ctes: str = ""):
    """Registers a query; its doubles are rounded to six digits on both sides."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = rounded(sql, doubles.split(), ctes)
        return fn

    return register


def tidy(df: DataFrame) -> DataFrame:
    return df.select(*[fix(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def rounded(sql: str, doubles: list[str], ctes: str) -> str:
    star = "*"
    if doubles:
        star = "* REPLACE (" + ", ".join(f"floor({d} * 1e6 + 0.5) / 1e6 AS {d}" for d in doubles) + ")"
    head = f"WITH {ctes}\n" if ctes else ""
    return f"{head}SELECT {star} FROM (\n{sql.strip()}\n) AS result"


TELEMETRY = """telemetry AS (
  SELECT event_id, ts, 'V' || lpad(cast(user_id AS varchar), 9, '0') AS vehicle_id, cast(ts AS date) AS date,
    CASE WHEN event_id % 37 <> 0 THEN 75.0e0 + (k % 50) * 0.8e0 END AS engine_temperature,
    20.0e0 + (event_id * 7) % 40 AS oil_pressure,
    1500.0e0 + (event_id * 13) % 2500 AS rpm,
    11.0e0 + ((event_id * 11) % 25) / 10.0e0 AS battery_voltage,
    value AS distance_km,
    CASE WHEN event_id % 500 = 0 THEN 0.0e0 ELSE 1.0e0 + (event_id * 19) % 30 END AS fuel_consumption,
    cast((event_id * 3) % 120 AS double) AS idle_time_minutes,
    60.0e0 + (event_id * 17) % 80 AS max_speed_kmh,
    100 + user_id * 3 + dd AS vehicle_age_days,
    user_id * 1000 + dd * 40 AS total_distance,
    CASE WHEN event_type = 'error' AND value > 60 THEN ts END AS fault_ts,
    CASE WHEN event_type = 'error' AND value > 60 THEN 1 ELSE 0 END AS failure_in_next_7d,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS failure_in_next_30d
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS bigint) AS k,
          date_diff('day', date '2024-01-01', cast(ts AS date)) AS dd FROM events) AS e
)"""

PREDICTIONS = TELEMETRY + """,
predictions AS (
  SELECT vehicle_id, ts AS "timestamp", date, event_id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction,
    p AS probability, failure_in_next_7d AS label, engine_temperature, oil_pressure, rpm, fuel_consumption,
    battery_voltage, distance_km, idle_time_minutes, max_speed_kmh, vehicle_age_days, total_distance
  FROM (SELECT *, ((event_id * 7919) % 1000) / 1000.0e0 AS p FROM telemetry) AS t
)"""

JOINED = PREDICTIONS + """,
daily_predictions AS (
  SELECT vehicle_id, date, max(probability) AS risk_score, max(prediction) AS predicted_failure,
    max(least(prediction, label)) AS true_positive, max(least(prediction, 1 - label)) AS false_positive,
    max(CASE WHEN probability > 0.8 THEN 1 ELSE 0 END) AS maintenance_required
  FROM predictions WHERE engine_temperature IS NOT NULL GROUP BY vehicle_id, date
),
joined AS (
  SELECT t.*, p.risk_score, p.predicted_failure, p.true_positive, p.false_positive, p.maintenance_required
  FROM telemetry t LEFT JOIN daily_predictions p ON t.vehicle_id = p.vehicle_id AND t.date = p.date
)"""

MATRIX = PREDICTIONS + """,
matrix AS (
  SELECT count(*) FILTER (label = 0 AND prediction = 0) AS true_negative,
    count(*) FILTER (label = 0 AND prediction = 1) AS false_positive,
    count(*) FILTER (label = 1 AND prediction = 0) AS false_negative,
    count(*) FILTER (label = 1 AND prediction = 1) AS true_positive FROM predictions
),
metrics AS (
  SELECT *, coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0e0) AS accuracy,
    coalesce(tp / nullif(tp + fp, 0), 0e0) AS "precision", coalesce(tp / nullif(tp + fn, 0), 0e0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0e0) AS f1_score,
    coalesce(tn / nullif(tn + fp, 0), 0e0) AS specificity,
    coalesce(fp / nullif(fp + tn, 0), 0e0) AS false_positive_rate,
    coalesce(fn / nullif(fn + tp, 0), 0e0) AS false_negative_rate,
    coalesce(tp / nullif(tp + fn, 0), 0e0) AS detection_rate,
    coalesce(fp / nullif(fp + tn, 0), 0e0) AS false_alarm_rate
  FROM (SELECT *, cast(true_negative AS double) AS tn, cast(false_positive AS double) AS fp,
          cast(false_negative AS double) AS fn, cast(true_positive AS double) AS tp FROM matrix) AS m
),
money AS (
  SELECT tp * 500e0 + fp * 600e0 + fn * 5000e0 AS total_cost_with_pm, (tn + fp + fn + tp) * 2000e0 AS total_cost_without_pm,
    (tn + fp + fn + tp) * 2000e0 - (tp * 500e0 + fp * 600e0 + fn * 5000e0) AS cost_savings,
    ((tn + fp + fn + tp) * 2000e0 - (tp * 500e0 + fp * 600e0 + fn * 5000e0)) * 100e0
      / ((tn + fp + fn + tp) * 2000e0) AS savings_percentage,
    true_positive + false_positive AS preventive_maintenances, true_positive AS reactive_maintenances_avoided,
    false_negative AS missed_failures, false_positive AS false_alarms,
    (tp * 500e0 + fp * 600e0 + fn * 5000e0) / (tn + fp + fn + tp) AS cost_per_vehicle FROM metrics
)"""

POINTS = PREDICTIONS + """,
points AS (
  SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
  FROM (SELECT probability AS threshold, cast(count(*) FILTER (label = 1) AS double) AS pos,
          cast(count(*) FILTER (label = 0) AS double) AS neg FROM predictions GROUP BY probability) AS s
  WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)
)"""

CORRELATED = TELEMETRY + """,
importances AS (
""" + "\n  UNION ALL\n".join(
    f"  SELECT '{c}' AS feature, abs(corr({c}, failure_in_next_7d)) AS importance FROM telemetry"
    for c in ["engine_temperature", "oil_pressure", "rpm", "battery_voltage", "distance_km", "fuel_consumption",
              "idle_time_minutes", "max_speed_kmh", "vehicle_age_days", "total_distance"]) + """
)"""


def first_word(column: str, groups, otherwise: str) -> str:
    cases = " ".join("WHEN " + " OR ".join(f"contains({column}, '{w}')" for w in words) + f" THEN '{label}'"
                     for label, words in groups)
    return f"CASE {cases} ELSE '{otherwise}' END"
