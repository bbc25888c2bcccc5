"""Checked queries: dashboard and BI marts."""

from pyspark.sql import functions as F

from fleetrisk.checks.registry import (CORRELATED, JOINED, MATRIX, PREDICTIONS, RUN_DATE, TELEMETRY,
                                       first_word, query)
from fleetrisk.functions import fixed, risk
from fleetrisk.operators import evaluation as ev
from fleetrisk.operators.training_sets import correlations
from fleetrisk.plans import dashboard as db
from fleetrisk.plans import marts as bi
from fleetrisk.sources import views

INPUTS = ["engine_temperature", "oil_pressure", "rpm", "battery_voltage", "distance_km", "fuel_consumption",
          "idle_time_minutes", "max_speed_kmh", "vehicle_age_days", "total_distance"]


def importances(spark, sf):
    strength = correlations(views.telemetry(spark, sf), "failure_in_next_7d", INPUTS)
    return strength.select("feature", F.abs("correlation").alias("importance"))


_STATS = """
SELECT vehicle_id, min(date) AS date_min, max(date) AS date_max, count(date) AS date_count,
  floor(avg(engine_temperature) * 100 + 0.5) / 100 AS engine_temperature_mean,
  floor(max(engine_temperature) * 100 + 0.5) / 100 AS engine_temperature_max,
  floor(stddev_samp(engine_temperature) * 100 + 0.5) / 100 AS engine_temperature_std,
  floor(avg(oil_pressure) * 100 + 0.5) / 100 AS oil_pressure_mean,
  floor(min(oil_pressure) * 100 + 0.5) / 100 AS oil_pressure_min,
  floor(stddev_samp(oil_pressure) * 100 + 0.5) / 100 AS oil_pressure_std,
  floor(avg(battery_voltage) * 100 + 0.5) / 100 AS battery_voltage_mean,
  floor(min(battery_voltage) * 100 + 0.5) / 100 AS battery_voltage_min,
  floor(sum(distance_km) * 100 + 0.5) / 100 AS distance_km_sum,
  cast(sum(failure_in_next_7d) AS bigint) AS failure_in_next_7d_sum,
  arg_max(total_distance, (ts, event_id)) FILTER (total_distance IS NOT NULL) AS total_distance_last
FROM telemetry GROUP BY vehicle_id"""
_SCORED = f"""
SELECT *, (CASE WHEN engine_temperature_mean > 105 THEN 0.8e0 WHEN engine_temperature_mean > 100 THEN 0.5e0
                WHEN engine_temperature_mean < 85 THEN 0.3e0 ELSE 0.1e0 END
  + CASE WHEN oil_pressure_mean < 30 THEN 0.7e0 WHEN oil_pressure_mean < 35 THEN 0.4e0
         WHEN oil_pressure_mean > 50 THEN 0.5e0 ELSE 0.1e0 END
  + CASE WHEN battery_voltage_min < 11.8e0 THEN 0.6e0 WHEN battery_voltage_min < 12.2e0 THEN 0.3e0 ELSE 0.1e0 END
  + CASE WHEN distance_km_sum > 5000 THEN 0.4e0 WHEN distance_km_sum > 3000 THEN 0.2e0 ELSE 0.1e0 END) / 4e0 AS risk_score
FROM ({_STATS}) AS stats"""
_CATEGORY = """CASE WHEN risk_score > 0 AND risk_score <= 0.3e0 THEN 'Low' WHEN risk_score > 0.3e0 AND risk_score <= 0.7e0
  THEN 'Medium' WHEN risk_score > 0.7e0 AND risk_score <= 1 THEN 'High' END"""
_PRIORITY = """CASE WHEN risk_score > 0.8e0 THEN 'Immediate' WHEN risk_score > 0.5e0 THEN 'Within 7 days'
  WHEN risk_score > 0.3e0 THEN 'Within 30 days' ELSE 'Monitor' END"""
_STAT_DOUBLES = """engine_temperature_mean engine_temperature_max engine_temperature_std oil_pressure_mean oil_pressure_min
 oil_pressure_std battery_voltage_mean battery_voltage_min distance_km_sum"""


@query("left_join_predictions", "SELECT * FROM joined", "engine_temperature battery_voltage distance_km risk_score", JOINED)
def left_join_predictions(spark, sf):
    return db.join_predictions(views.telemetry(spark, sf), views.daily_predictions(spark, sf))


@query("fleet_kpis", f"""
SELECT '{RUN_DATE}' AS date_generated, count(DISTINCT vehicle_id) AS total_vehicles, count(*) AS total_observations,
  avg(failure_in_next_7d) AS failure_rate, cast(sum(predicted_failure) AS bigint) AS predicted_failures,
  cast(sum(true_positive) AS bigint) AS true_positives, cast(sum(false_positive) AS bigint) AS false_positives,
  avg(engine_temperature) AS avg_engine_temp, avg(oil_pressure) AS avg_oil_pressure,
  avg(distance_km / nullif(fuel_consumption, 0)) AS avg_fuel_efficiency,
  cast(sum(maintenance_required) AS bigint) AS vehicles_requiring_maintenance,
  count(*) FILTER (risk_score > 0.7e0) AS high_risk_vehicles FROM joined""",
       "failure_rate avg_engine_temp avg_oil_pressure avg_fuel_efficiency", JOINED)
def fleet_kpis(spark, sf):
    return db.fleet_kpis_joined(views.telemetry(spark, sf), views.daily_predictions(spark, sf), RUN_DATE)


@query("weekly_trends", """
SELECT c.week AS date, w.f AS failure_in_next_7d, w.t AS engine_temperature, coalesce(w.d, 0e0) AS distance_km
FROM (SELECT cast(unnest(generate_series(min(w), max(w), interval 7 day)) AS date) AS week
      FROM (SELECT cast(date_trunc('week', date) AS date) + 6 AS w FROM telemetry) AS a) AS c
LEFT JOIN (SELECT cast(date_trunc('week', date) AS date) + 6 AS week, avg(failure_in_next_7d) AS f,
             avg(engine_temperature) AS t, sum(distance_km) AS d FROM telemetry GROUP BY 1) AS w ON w.week = c.week""",
       "failure_in_next_7d engine_temperature distance_km", TELEMETRY)
def weekly_trends(spark, sf):
    return db.weekly_trends(views.telemetry(spark, sf))


@query("vehicle_summary", _STATS, _STAT_DOUBLES, TELEMETRY)
def vehicle_statistics(spark, sf):
    return db.vehicle_statistics(views.telemetry(spark, sf))


@query("risk_score", f"SELECT vehicle_id, risk_score FROM ({_SCORED}) AS s", "risk_score", TELEMETRY)
def risk_score(spark, sf):
    return db.vehicle_summary(views.telemetry(spark, sf)).select("vehicle_id", "risk_score")


@query("risk_category", f"SELECT vehicle_id, {_CATEGORY} AS risk_category FROM ({_SCORED}) AS s", "", TELEMETRY)
def risk_category(spark, sf):
    return db.vehicle_summary(views.telemetry(spark, sf)).select("vehicle_id", "risk_category")


@query("maintenance_priority", f"""SELECT *, {_CATEGORY} AS risk_category, {_PRIORITY} AS maintenance_priority
FROM ({_SCORED}) AS s""", _STAT_DOUBLES + " risk_score", TELEMETRY)
def vehicle_risk(spark, sf):
    """The whole vehicle table: which vehicles need service first."""
    return db.vehicle_summary(views.telemetry(spark, sf))


_DAILY = """SELECT date, count(DISTINCT vehicle_id) AS active_vehicles, avg(engine_temperature) AS avg_engine_temp,
  avg(oil_pressure) AS avg_oil_pressure, cast(sum(failure_in_next_7d) AS bigint) AS failures,
  sum(distance_km) AS total_distance FROM telemetry GROUP BY date"""


@query("daily_fleet", _DAILY, "avg_engine_temp avg_oil_pressure total_distance", TELEMETRY)
def daily_fleet(spark, sf):
    return db.daily_fleet(views.telemetry(spark, sf))


@query("daily_moving_average", f"""
SELECT *, CASE WHEN count(avg_engine_temp) OVER w = 7 THEN avg(avg_engine_temp) OVER w END AS avg_engine_temp_7d_ma,
  CASE WHEN count(failures) OVER w = 7 THEN avg(failures) OVER w END AS failure_rate_7d_ma
FROM ({_DAILY}) AS d WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
       "avg_engine_temp avg_oil_pressure total_distance avg_engine_temp_7d_ma failure_rate_7d_ma", TELEMETRY)
def daily_moving_average(spark, sf):
    return db.daily_trends(views.telemetry(spark, sf))


def _advice(texts):
    issue, severity, text, cost, hours = texts
    return (f"'{issue}' AS issue, '{severity}' AS severity, '{text}' AS recommendation, {cost} AS estimated_cost, "
            f"{hours} AS estimated_downtime_hours")


@query("recommendations", f"""
SELECT vehicle_id, {_advice(fixed.RECOMMEND_TEMPERATURE)} FROM (
  SELECT vehicle_id, min((ts, event_id)) AS k FROM telemetry WHERE engine_temperature > 105 GROUP BY vehicle_id
  ORDER BY k LIMIT 10) AS a
UNION ALL SELECT vehicle_id, {_advice(fixed.RECOMMEND_OIL)} FROM (
  SELECT vehicle_id, min((ts, event_id)) AS k FROM telemetry WHERE oil_pressure < 30 GROUP BY vehicle_id
  ORDER BY k LIMIT 10) AS b
UNION ALL SELECT vehicle_id, {_advice(fixed.RECOMMEND_MILEAGE)} FROM (
  SELECT vehicle_id, max(total_distance) AS k FROM telemetry GROUP BY vehicle_id ORDER BY k DESC, vehicle_id LIMIT 5) AS c""",
       "", TELEMETRY)
def recommendations(spark, sf):
    return db.recommendations(views.telemetry(spark, sf))


@query("importance_categories", f"""
SELECT feature, importance, {first_word("lower(feature)", fixed.DASHBOARD_KEYWORDS, fixed.DASHBOARD_ELSE)} AS category
FROM (SELECT * FROM importances ORDER BY importance DESC, feature LIMIT 20) AS i""", "importance", CORRELATED)
def importance_categories(spark, sf):
    return db.importance_categories(importances(spark, sf))


# -- BI marts ---------------------------------------------------------------------------------------

_BUCKET = """CASE WHEN {p} > 0 AND {p} <= 0.3e0 THEN 'Low Risk' WHEN {p} > 0.3e0 AND {p} <= 0.7e0 THEN 'Medium Risk'
  WHEN {p} > 0.7e0 AND {p} <= 1 THEN 'High Risk' END"""


@query("predictions_mart", f"""
SELECT vehicle_id, "timestamp", prediction, CASE prediction WHEN 0 THEN 'No Maintenance Needed' WHEN 1 THEN 'Maintenance Needed'
  END AS prediction_label, probability, {_BUCKET.format(p="probability")} AS risk_category,
  date '{RUN_DATE}' AS prediction_date, date, event_id, label, engine_temperature, oil_pressure, rpm, fuel_consumption,
  battery_voltage, distance_km, idle_time_minutes FROM predictions""",
       "probability engine_temperature battery_voltage distance_km", PREDICTIONS)
def predictions_mart(spark, sf):
    return bi.predictions_mart(views.predictions(spark, sf), RUN_DATE)


@query("risk_bucket_cut", f"""
SELECT {_BUCKET.format(p="probability")} AS risk_category, count(*) AS n, min(probability) AS low, max(probability) AS high
FROM predictions GROUP BY 1""", "low high", PREDICTIONS)
def risk_bucket_cut(spark, sf):
    p = views.predictions(spark, sf)
    return p.groupBy(risk.risk_bucket(F.col("probability")).alias("risk_category")).agg(
        F.count(F.lit(1)).alias("n"), F.min("probability").alias("low"), F.max("probability").alias("high"))


_METRIC_NAMES = ["accuracy", "precision", "recall", "f1_score", "specificity", "false_positive_rate",
                 "false_negative_rate", "detection_rate", "false_alarm_rate"]
_COUNT_NAMES = ["true_negative", "false_positive", "false_negative", "true_positive"]
_METRIC_CASES = " ".join("WHEN metric_name IN ({}) THEN '{}'".format(", ".join(f"'{n}'" for n in names), label)
                         for label, names in fixed.METRIC_CATEGORIES)


@query("metrics_mart", f"""
SELECT metric_name, metric_value, CASE WHEN starts_with(metric_name, 'confusion_matrix_') THEN 'Confusion Matrix'
  {_METRIC_CASES} ELSE 'Other' END AS metric_category, date '{RUN_DATE}' AS update_date
FROM ({" UNION ALL ".join(f"SELECT '{m}' AS metric_name, " + chr(34) + m + chr(34) + " AS metric_value FROM metrics" for m in _METRIC_NAMES)}
  UNION ALL {" UNION ALL ".join(f"SELECT 'confusion_matrix_{m}', cast({m} AS double) FROM metrics" for m in _COUNT_NAMES)}) AS l""",
       "metric_value", MATRIX)
def metrics_mart(spark, sf):
    metrics = ev.class_metrics(ev.confusion_matrix(views.predictions(spark, sf)))
    return bi.metrics_mart(bi.with_matrix(metrics), RUN_DATE)


_MONEY_NAMES = ["total_cost_with_pm", "total_cost_without_pm", "cost_savings", "savings_percentage",
                "preventive_maintenances", "reactive_maintenances_avoided", "missed_failures", "false_alarms",
                "cost_per_vehicle"]


@query("business_mart", f"""
SELECT title AS business_metric, value, cast(NULL AS varchar) AS value_text, {first_word("name", fixed.BUSINESS_UNITS, "count")} AS unit,
  {first_word("name", fixed.BUSINESS_CATEGORIES, "Other")} AS category, date '{RUN_DATE}' AS update_date
FROM ({" UNION ALL ".join(f"SELECT '{m}' AS name, '{m.replace('_', ' ').title()}' AS title, cast({m} AS double) AS value FROM money" for m in _MONEY_NAMES)}) AS l""",
       "value", MATRIX)
def business_mart(spark, sf):
    return bi.business_mart(ev.business_cost(ev.confusion_matrix(views.predictions(spark, sf))), RUN_DATE)


@query("importance_mart", f"""
SELECT feature, importance, {first_word("lower(feature)", fixed.IMPORTANCE_KEYWORDS, fixed.IMPORTANCE_ELSE)} AS category,
  date '{RUN_DATE}' AS update_date
FROM (SELECT * FROM importances ORDER BY importance DESC, feature LIMIT 20) AS i""", "importance", CORRELATED)
def importance_mart(spark, sf):
    return bi.importance_mart(importances(spark, sf), RUN_DATE)


@query("daily_predictions", f"""
SELECT cast("timestamp" AS date) AS date, cast(sum(prediction) AS bigint) AS maintenance_predictions,
  count(prediction) AS total_predictions, avg(prediction) AS prediction_rate, avg(probability) AS avg_risk_score,
  stddev_samp(probability) AS risk_score_std, max(probability) AS max_risk_score, date '{RUN_DATE}' AS update_date
FROM predictions GROUP BY 1""", "prediction_rate avg_risk_score risk_score_std max_risk_score", PREDICTIONS)
def daily_predictions(spark, sf):
    return bi.daily_predictions_mart(views.predictions(spark, sf), RUN_DATE)


@query("fleet_summary", f"""
SELECT *, {_BUCKET.format(p="avg_risk_score")} AS risk_category, date '{RUN_DATE}' AS update_date FROM (
  SELECT vehicle_id, cast(sum(prediction) AS bigint) AS maintenance_alerts, count(prediction) AS total_readings,
    avg(prediction) AS alert_rate, avg(probability) AS avg_risk_score, max(probability) AS max_risk_score,
    min(probability) AS min_risk_score, stddev_samp(probability) AS risk_score_std
  FROM predictions GROUP BY vehicle_id) AS v""",
       "alert_rate avg_risk_score max_risk_score min_risk_score risk_score_std", PREDICTIONS)
def fleet_summary(spark, sf):
    return bi.fleet_summary(views.predictions(spark, sf), RUN_DATE)


def all_marts(spark, sf):
    p = views.predictions(spark, sf)
    cm = ev.confusion_matrix(p)
    return bi.mart_set(p, bi.with_matrix(ev.class_metrics(cm)), ev.business_cost(cm), RUN_DATE, importances(spark, sf))


@query("mart_set", """
SELECT 'predictions' AS mart, count(*) AS n, 17 AS n_columns FROM telemetry
UNION ALL SELECT 'model_metrics', 13, 4
UNION ALL SELECT 'business_metrics', 9, 6
UNION ALL SELECT 'feature_importance', 10, 4
UNION ALL SELECT 'time_series_predictions', count(DISTINCT date), 8 FROM telemetry
UNION ALL SELECT 'fleet_summary', count(DISTINCT vehicle_id), 10 FROM telemetry""", "", TELEMETRY)
def mart_set(spark, sf):
    out = None
    for name, df in all_marts(spark, sf).items():
        row = df.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n"), F.lit(len(df.columns)).alias("n_columns"))
        out = row if out is None else out.unionByName(row)
    return out
