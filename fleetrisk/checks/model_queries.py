"""Checked queries: training sets and evaluation."""

from pyspark.sql import functions as F

from fleetrisk.checks.registry import CORRELATED, MATRIX, POINTS, PREDICTIONS, RUN_DATE, TELEMETRY, query
from fleetrisk.checks.mart_queries import INPUTS
from fleetrisk.functions import fixed
from fleetrisk.operators import evaluation as ev
from fleetrisk.operators import training_sets as ts
from fleetrisk.sources import views


@query("select_features", "SELECT * EXCLUDE (event_id, ts, vehicle_id, date, fault_ts, failure_in_next_30d, max_speed_kmh) FROM telemetry",
       "engine_temperature battery_voltage distance_km", TELEMETRY)
def select_features(spark, sf):
    return ts.select_features(views.telemetry(spark, sf), "failure_in_next_7d", drop=["max_speed_kmh"])


@query("ordered_split", """
SELECT event_id, vehicle_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) > count(*) OVER () - ceil(0.2 * count(*) OVER ())
  THEN 'test' ELSE 'train' END AS part FROM telemetry""", "", TELEMETRY)
def ordered_split(spark, sf):
    train, test = ts.ordered_split(views.telemetry(spark, sf))
    return train.select("event_id", "vehicle_id", F.lit("train").alias("part")).unionByName(
        test.select("event_id", "vehicle_id", F.lit("test").alias("part")))


@query("expanding_folds", """
SELECT cast(k AS integer) AS fold, part, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM (
  SELECT f.k, t.event_id, CASE WHEN i < n - (n // 6) * (5 - f.k) THEN 'train' ELSE 'test' END AS part
  FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM telemetry) AS t
  JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS k) AS f ON t.i < t.n - (t.n // 6) * (4 - f.k)) AS r GROUP BY k, part""", "", TELEMETRY)
def expanding_folds(spark, sf):
    out = None
    for k, pair in enumerate(ts.expanding_folds(views.telemetry(spark, sf).select("ts", "event_id"))):
        for part, df in zip(("train", "test"), pair):
            row = df.agg(F.lit(k).alias("fold"), F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"),
                         F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
            out = row if out is None else out.unionByName(row)
    return out


@query("class_weights", """
SELECT failure_in_next_7d AS label, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * cast(count(*) AS double)) AS weight
FROM telemetry GROUP BY failure_in_next_7d""", "weight", TELEMETRY)
def class_weights(spark, sf):
    return ts.class_weights(views.telemetry(spark, sf), "failure_in_next_7d")


@query("weighted_rows", """
SELECT event_id, label, weight FROM (SELECT event_id, failure_in_next_7d AS label,
  count(*) OVER () / (2e0 * count(*) OVER (PARTITION BY failure_in_next_7d)) AS weight FROM telemetry) AS w""", "weight", TELEMETRY)
def weighted_rows(spark, sf):
    t = views.telemetry(spark, sf).select("event_id", F.col("failure_in_next_7d").alias("label"))
    return ts.with_class_weights(t, "label")


@query("feature_select_corr", "SELECT feature, importance FROM importances ORDER BY importance DESC, feature LIMIT 5",
       "importance", CORRELATED)
def feature_select_corr(spark, sf):
    return ts.top_correlated(views.telemetry(spark, sf), "failure_in_next_7d", 5, INPUTS)


# -- evaluation -------------------------------------------------------------------------------------

def matrix(spark, sf):
    return ev.confusion_matrix(views.predictions(spark, sf))


@query("confusion_matrix", "SELECT * FROM matrix", "", MATRIX)
def confusion_matrix(spark, sf):
    return matrix(spark, sf)


_RATES = "accuracy precision recall f1_score specificity false_positive_rate false_negative_rate detection_rate false_alarm_rate"


@query("class_metrics", "SELECT * EXCLUDE (tn, fp, fn, tp) FROM metrics",
       _RATES.replace(" precision", ' "precision"'), MATRIX)
def class_metrics(spark, sf):
    return ev.class_metrics(matrix(spark, sf))


_AUC = "SELECT sum(neg * (cum_pos - pos / 2)) / (max(all_pos) * max(all_neg)) AS roc_auc FROM points"
_AP = "SELECT sum(pos * cum_pos / (cum_pos + cum_neg)) / max(all_pos) AS average_precision FROM points"
_PR = """SELECT sum(pos * (cum_pos / (cum_pos + cum_neg)
  + coalesce((cum_pos - pos) / nullif(cum_pos - pos + cum_neg - neg, 0), 1e0)) / 2) / max(all_pos) AS pr_auc FROM points"""


@query("roc_auc", _AUC, "roc_auc", POINTS)
def roc_auc(spark, sf):
    return ev.ranking_metrics(views.predictions(spark, sf)).select("roc_auc")


@query("average_precision", _AP, "average_precision", POINTS)
def average_precision(spark, sf):
    return ev.ranking_metrics(views.predictions(spark, sf)).select("average_precision")


@query("pr_auc", _PR, "pr_auc", POINTS)
def pr_auc(spark, sf):
    return ev.ranking_metrics(views.predictions(spark, sf)).select("pr_auc")


@query("roc_curve", """SELECT threshold, cum_neg / all_neg AS fpr, cum_pos / all_pos AS tpr FROM points
UNION ALL SELECT NULL, 0 / max(all_neg), 0 / max(all_pos) FROM points HAVING count(*) > 0""", "threshold fpr tpr", POINTS)
def roc_curve(spark, sf):
    return ev.roc_curve(views.predictions(spark, sf))


@query("pr_curve", """SELECT threshold, cum_pos / (cum_pos + cum_neg) AS "precision", cum_pos / all_pos AS recall,
  all_pos / (all_pos + all_neg) AS no_skill FROM points
UNION ALL SELECT NULL, 1e0, 0 / max(all_pos), max(all_pos) / max(all_pos + all_neg) FROM points HAVING count(*) > 0""", 'threshold "precision" recall no_skill', POINTS)
def pr_curve(spark, sf):
    return ev.pr_curve(views.predictions(spark, sf))


@query("calibration_bins", """
SELECT cast(greatest(ceil(probability * 10) - 1, 0) AS integer) AS bin, avg(probability) AS mean_predicted,
  avg(cast(label AS double)) AS fraction_positive, count(*) AS n FROM predictions GROUP BY 1""",
       "mean_predicted fraction_positive", PREDICTIONS)
def calibration_bins(spark, sf):
    return ev.calibration_bins(views.predictions(spark, sf))


@query("classification_report", """
SELECT * FROM per_class
UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, true_negative + true_positive + false_negative + false_positive FROM metrics
UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1_score), cast(sum(support) AS bigint) FROM per_class
UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1_score * support) / sum(support), cast(sum(support) AS bigint) FROM per_class""", '"precision" recall f1_score', MATRIX + """,
per_class AS (
  SELECT '1' AS label, "precision", recall, f1_score, true_positive + false_negative AS support FROM metrics
  UNION ALL SELECT '0', coalesce(tn / nullif(tn + fn, 0), 0e0), coalesce(tn / nullif(tn + fp, 0), 0e0),
    coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0e0), true_negative + false_positive FROM metrics
)""")
def classification_report(spark, sf):
    return ev.classification_report(views.predictions(spark, sf))


@query("business_cost_v1", "SELECT * FROM money",
       "total_cost_with_pm total_cost_without_pm cost_savings savings_percentage cost_per_vehicle", MATRIX)
def business_cost_v1(spark, sf):
    return ev.business_cost(matrix(spark, sf))


@query("business_cost_v2", """
SELECT cost AS total_cost_with_pm, base AS total_cost_without_pm, base - cost AS total_savings,
  (base - cost) * 100 / nullif(base, 0) AS savings_percentage, 50000e0 AS investment_cost, (base - cost) * 100 / 50000e0 AS roi_percentage,
  CASE WHEN base - cost > 0 THEN 50000e0 / ((base - cost) * 12) END AS payback_period_years,
  true_positive + false_positive AS preventive_maintenances, true_positive AS reactive_maintenances_avoided,
  false_negative AS missed_failures, false_positive AS false_alarms, detection_rate, false_alarm_rate,
  true_positive * 24 AS downtime_hours_avoided, tp * 200e0 * 24e0 AS downtime_cost_avoided, 24e0 AS avg_downtime_hours
FROM (SELECT *, (tp + fp) * 500e0 + fn * 2000e0 + fp * 100e0 AS cost, (tn + fp + fn + tp) * 2000e0 AS base FROM metrics) AS m""",
       "total_cost_with_pm total_cost_without_pm total_savings savings_percentage roi_percentage payback_period_years "
       "detection_rate false_alarm_rate downtime_cost_avoided", MATRIX)
def business_cost_v2(spark, sf):
    return ev.business_plan(matrix(spark, sf))


@query("business_cost_v3", """
SELECT true_positive + false_negative AS total_failures, detection_rate, false_alarm_rate,
  tp * 4000e0 - fp * 1000e0 AS estimated_savings, (tp * 4000e0 - fp * 1000e0) / 100000e0 AS roi_first_year FROM metrics""",
       "detection_rate false_alarm_rate estimated_savings roi_first_year", MATRIX)
def business_cost_v3(spark, sf):
    return ev.business_savings(matrix(spark, sf))


@query("interpretation", f"""
SELECT section, cast(position AS integer) AS position, text FROM (
  SELECT 'performance_summary' AS section, 0 AS position, printf('The model achieves %.1f%% accuracy with %.1f%% precision and %.1f%% recall. This indicates good predictive capability for vehicle maintenance needs.',
    accuracy * 100, "precision" * 100, recall * 100) AS text FROM metrics
  UNION ALL SELECT 'business_impact', 0, 'Implementing this predictive maintenance system could save $' || format('{{:,}}', cast(floor(cost_savings) AS bigint))
    || printf('.%02d (%.1f%%) compared to reactive maintenance. It would enable %d preventive interventions while generating %d false alarms.',
    cast(round((cost_savings - floor(cost_savings)) * 100) AS integer), savings_percentage, reactive_maintenances_avoided, false_alarms) FROM money
  UNION ALL SELECT 'recommendations', row_number() OVER (ORDER BY k) - 1, text FROM (
    SELECT 1 AS k, '{fixed.ADVICE_RECALL}' AS text FROM metrics WHERE recall < 0.7e0
    UNION ALL SELECT 2, '{fixed.ADVICE_PRECISION}' FROM metrics WHERE "precision" < 0.6e0
    UNION ALL SELECT 3, '{fixed.ADVICE_ALARMS}' FROM metrics WHERE false_positive > true_positive
    UNION ALL SELECT 4, '{fixed.ADVICE_GOOD}' FROM metrics WHERE recall >= 0.7e0 AND "precision" >= 0.6e0 AND false_positive <= true_positive
  ) AS a) AS t""", "", MATRIX)
def interpretation(spark, sf):
    return ev.interpretation(ev.full_metrics(matrix(spark, sf)))


@query("evaluation_report")
def evaluation_report(spark, sf):
    return ev.evaluation_report(views.predictions(spark, sf), "stand-in scores", RUN_DATE)
