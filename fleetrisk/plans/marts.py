"""BI marts over predictions and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetrisk.functions import fixed
from fleetrisk.functions.numbers import first_match
from fleetrisk.functions.risk import risk_bucket


def _run_date(run_date: str) -> Column:
    return F.lit(run_date).cast("date")


def predictions_mart(df: DataFrame, run_date: str, extra: int = 10) -> DataFrame:
    """Ids, prediction with label text and risk bucket, then the first ``extra`` other columns."""
    ids = [c for c in ("vehicle_id", "timestamp") if c in df.columns]
    own = {
        "prediction": F.col("prediction"),
        "prediction_label": F.when(F.col("prediction") == 0, "No Maintenance Needed")
                             .when(F.col("prediction") == 1, "Maintenance Needed"),
        "probability": F.col("probability"),
        "risk_category": risk_bucket(F.col("probability")),
        "prediction_date": _run_date(run_date),
    }
    others = [c for c in df.columns if c not in [*ids, *own, "target", "true_label"]][:extra]
    return df.select(*ids, *[e.alias(n) for n, e in own.items()], *others)


def to_metrics(row: DataFrame) -> DataFrame:
    """A one-row table as (metric_name, metric_value, metric_text): a column becomes a row.

    Struct columns give ``<column>_<field>``; what is not a number has the value 0 and keeps its text, which is
    null for numbers.
    """
    cells = []

    def add(name: str, c: Column, t: T.DataType):
        number = isinstance(t, T.NumericType)
        cells.append(F.struct(F.lit(name).alias("metric_name"),
                              (c.cast("double") if number else F.lit(0.0)).alias("metric_value"),
                              F.lit(None if number else c.cast("string")).cast("string").alias("metric_text")))

    for f in row.schema.fields:
        if isinstance(f.dataType, T.StructType):
            for g in f.dataType.fields:
                add(f"{f.name}_{g.name}", F.col(f"`{f.name}`.`{g.name}`"), g.dataType)
        else:
            add(f.name, F.col(f.name), f.dataType)
    return row.select(F.explode(F.array(*cells)).alias("m")).select("m.*")


def metrics_mart(metrics: DataFrame, run_date: str) -> DataFrame:
    """Long metrics with their category, from one row whose matrix is a struct ``confusion_matrix``."""
    name = F.col("metric_name")
    category = F.when(name.startswith("confusion_matrix_"), "Confusion Matrix").otherwise(
        first_match(name, fixed.METRIC_CATEGORIES, "Other", exact=True))
    return to_metrics(metrics).select("metric_name", "metric_value", category.alias("metric_category"),
                                      _run_date(run_date).alias("update_date"))


def with_matrix(metrics: DataFrame) -> DataFrame:
    """Folds the four counts into the struct column ``confusion_matrix``."""
    counts = ["true_negative", "false_positive", "false_negative", "true_positive"]
    return metrics.select(*[c for c in metrics.columns if c not in counts], F.struct(*counts).alias("confusion_matrix"))


def business_mart(business: DataFrame, run_date: str) -> DataFrame:
    """Money metrics with readable name, unit and category. The order of the word tests is part of the result."""
    name = F.col("metric_name")
    return to_metrics(business).select(
        F.initcap(F.replace(name, F.lit("_"), F.lit(" "))).alias("business_metric"), F.col("metric_value").alias("value"),
        F.col("metric_text").alias("value_text"),
        first_match(name, fixed.BUSINESS_UNITS, "count").alias("unit"),
        first_match(name, fixed.BUSINESS_CATEGORIES, "Other").alias("category"),
        _run_date(run_date).alias("update_date"))


def importance_mart(importances: DataFrame, run_date: str, top: int = 20) -> DataFrame:
    """The most important features with a keyword category."""
    return importances.orderBy(F.col("importance").desc(), "feature").limit(top).select(
        "feature", "importance",
        first_match(F.lower("feature"), fixed.IMPORTANCE_KEYWORDS, fixed.IMPORTANCE_ELSE).alias("category"),
        _run_date(run_date).alias("update_date"))


def daily_predictions_mart(df: DataFrame, run_date: str) -> DataFrame:
    return df.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.sum("prediction").alias("maintenance_predictions"), F.count("prediction").alias("total_predictions"),
        F.avg("prediction").alias("prediction_rate"), F.avg("probability").alias("avg_risk_score"),
        F.stddev_samp("probability").alias("risk_score_std"), F.max("probability").alias("max_risk_score"),
    ).withColumn("update_date", _run_date(run_date))


def fleet_summary(df: DataFrame, run_date: str) -> DataFrame:
    return df.groupBy("vehicle_id").agg(
        F.sum("prediction").alias("maintenance_alerts"), F.count("prediction").alias("total_readings"),
        F.avg("prediction").alias("alert_rate"), F.avg("probability").alias("avg_risk_score"),
        F.max("probability").alias("max_risk_score"), F.min("probability").alias("min_risk_score"),
        F.stddev_samp("probability").alias("risk_score_std"),
    ).select("*", risk_bucket(F.col("avg_risk_score")).alias("risk_category"), _run_date(run_date).alias("update_date"))


def mart_set(predictions: DataFrame, metrics: DataFrame, business: DataFrame, run_date: str,
             importances: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every mart the available columns allow, each a lazy plan over the same input."""
    marts = {
        "predictions": predictions_mart(predictions, run_date),
        "model_metrics": metrics_mart(metrics, run_date),
        "business_metrics": business_mart(business, run_date),
    }
    if importances is not None:
        marts["feature_importance"] = importance_mart(importances, run_date)
    if "timestamp" in predictions.columns:
        marts["time_series_predictions"] = daily_predictions_mart(predictions, run_date)
    if "vehicle_id" in predictions.columns:
        marts["fleet_summary"] = fleet_summary(predictions, run_date)
    return marts
