"""Fleet views over the event tables: sensor readings and model predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetrisk.functions import fixed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_readings(events: DataFrame, **extra: Column) -> DataFrame:
    """Each event as one sensor reading, with further columns if given; works on a batch and on a stream."""
    e, user = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    dd = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    is_error = F.col("event_type") == "error"
    fault = is_error & (F.col("value") > 60)
    return events.select(
        "event_id",
        "ts",
        F.concat(F.lit("V"), F.lpad(user.cast("string"), 9, "0")).alias("vehicle_id"),
        F.col("ts").cast("date").alias("date"),
        F.when(e % 37 != 0, 75.0 + (k % 50) * 0.8).alias("engine_temperature"),
        (20.0 + (e * 7) % 40).alias("oil_pressure"),
        (1500.0 + (e * 13) % 2500).alias("rpm"),
        (11.0 + ((e * 11) % 25) / 10.0).alias("battery_voltage"),
        F.col("value").alias("distance_km"),
        F.when(e % 500 == 0, 0.0).otherwise(1.0 + (e * 19) % 30).alias("fuel_consumption"),
        ((e * 3) % 120).cast("double").alias("idle_time_minutes"),
        (60.0 + (e * 17) % 80).alias("max_speed_kmh"),
        (100 + user * 3 + dd).alias("vehicle_age_days"),
        (user * 1000 + dd * 40).alias("total_distance"),
        F.when(fault, F.col("ts")).alias("fault_ts"),
        F.when(fault, 1).otherwise(0).alias("failure_in_next_7d"),
        F.when(is_error, 1).otherwise(0).alias("failure_in_next_30d"),
        *[e.alias(n) for n, e in extra.items()],
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))


def as_predictions(readings: DataFrame) -> DataFrame:
    """A stand-in model output per reading, with ties, zeros and both sides of every edge."""
    p = ((F.col("event_id") * 7919) % 1000) / 1000.0
    return readings.select(
        "vehicle_id", F.col("ts").alias("timestamp"), "date", "event_id",
        F.when(p > 0.5, 1).otherwise(0).alias("prediction"), p.alias("probability"),
        F.col("failure_in_next_7d").alias("label"),
        *[c for c in fixed.NUMERIC_INPUTS],
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_predictions(telemetry(spark, sf_dir))


def daily_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vehicle and day that has a complete reading, so some days have no prediction."""
    p = predictions(spark, sf_dir).where(F.col("engine_temperature").isNotNull())
    return p.groupBy("vehicle_id", "date").agg(
        F.max("probability").alias("risk_score"),
        F.max("prediction").alias("predicted_failure"),
        F.max(F.least("prediction", "label")).alias("true_positive"),
        F.max(F.least(F.col("prediction"), 1 - F.col("label"))).alias("false_positive"),
        F.max(F.when(F.col("probability") > 0.8, 1).otherwise(0)).alias("maintenance_required"),
    )
