"""Fleet dashboard marts: KPIs, weekly and daily trends, vehicle summary, recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.functions import fixed, risk
from fleetrisk.functions.numbers import count_if, first_match, fix, order_key, ratio


def join_predictions(readings: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every reading with the prediction of its vehicle and day, if there is one.

    Days are cast on both sides. A hot (vehicle, day) sits on the reading side of the outer join,
    which adaptive execution splits; the prediction side is one row per vehicle and day.
    """
    left = readings.withColumn("date", F.col("date").cast("date"))
    right = predictions.withColumn("date", F.col("date").cast("date"))
    return left.join(right, ["vehicle_id", "date"], "left")


def fleet_kpis(df: DataFrame, run_date: str) -> DataFrame:
    """One row; prediction columns count only when present."""
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint") if c in df.columns else F.lit(0).cast("bigint")

    efficiency = (F.avg(ratio(F.col("distance_km"), F.col("fuel_consumption")))
                  if "fuel_consumption" in df.columns else F.lit(0.0))
    high_risk = count_if(F.col("risk_score") > 0.7) if "risk_score" in df.columns else F.lit(0).cast("bigint")
    return df.agg(
        F.count_distinct("vehicle_id").alias("total_vehicles"),
        F.count(F.lit(1)).alias("total_observations"),
        F.avg("failure_in_next_7d").alias("failure_rate"),
        total("predicted_failure").alias("predicted_failures"),
        total("true_positive").alias("true_positives"),
        total("false_positive").alias("false_positives"),
        F.avg("engine_temperature").alias("avg_engine_temp"),
        F.avg("oil_pressure").alias("avg_oil_pressure"),
        efficiency.alias("avg_fuel_efficiency"),
        total("maintenance_required").alias("vehicles_requiring_maintenance"),
        high_risk.alias("high_risk_vehicles"),
    ).select(F.lit(run_date).alias("date_generated"), "*")


def fleet_kpis_joined(readings: DataFrame, predictions: DataFrame, run_date: str) -> DataFrame:
    """``fleet_kpis`` of ``join_predictions(readings, predictions)``, without a join of readings.

    Readings become sums for each vehicle and day before the join, so what is shuffled are vehicles and days. A prediction
    counts once for each reading of its day, as it would in the joined rows.
    """
    ratios = ratio(F.col("distance_km"), F.col("fuel_consumption")) if "fuel_consumption" in readings.columns else F.lit(0.0)
    means = {"failure_rate": F.col("failure_in_next_7d"), "avg_engine_temp": F.col("engine_temperature"),
             "avg_oil_pressure": F.col("oil_pressure"), "avg_fuel_efficiency": ratios}
    days = readings.withColumn("date", F.col("date").cast("date")).groupBy("vehicle_id", "date").agg(
        F.count(F.lit(1)).alias("_n"), *[a for name, x in means.items() for a in (F.sum(x).alias(f"_s_{name}"), F.count(x).alias(f"_c_{name}"))])
    joined = join_predictions(days, predictions)
    n = F.col("_n")

    def total(c: str) -> Column:
        return F.coalesce(F.sum(F.col(c) * n), F.lit(0)).cast("bigint") if c in predictions.columns else F.lit(0).cast("bigint")

    high = F.sum(F.when(F.col("risk_score") > 0.7, n)) if "risk_score" in predictions.columns else F.lit(None)
    mean = lambda name: F.try_divide(F.sum(f"_s_{name}"), F.sum(f"_c_{name}")).alias(name)
    return joined.agg(
        F.count_distinct("vehicle_id").alias("total_vehicles"),
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("total_observations"),
        mean("failure_rate"),
        total("predicted_failure").alias("predicted_failures"),
        total("true_positive").alias("true_positives"),
        total("false_positive").alias("false_positives"),
        mean("avg_engine_temp"), mean("avg_oil_pressure"), mean("avg_fuel_efficiency"),
        total("maintenance_required").alias("vehicles_requiring_maintenance"),
        F.coalesce(high, F.lit(0)).cast("bigint").alias("high_risk_vehicles"),
    ).select(F.lit(run_date).alias("date_generated"), "*")


def weekly_trends(df: DataFrame) -> DataFrame:
    """Weeks end on, and are named by, their Sunday; weeks without readings are present.

    The missing weeks come from the gaps between the weekly rows, so the readings are scanned once.
    """
    week_end = F.next_day(F.date_sub(F.col("date").cast("date"), 1), "SUN")
    weeks = df.where(F.col("date").isNotNull()).groupBy(week_end.alias("week")).agg(
        F.avg("failure_in_next_7d").alias("failure_in_next_7d"),
        F.avg("engine_temperature").alias("engine_temperature"),
        F.sum("distance_km").alias("distance_km"),
    )
    following = F.lead("week").over(Window.orderBy("week"))  # one row per week
    until = F.coalesce(F.date_sub(following, 7), F.col("week"))
    filled = weeks.withColumn("until", until).select(
        "*", F.explode(F.sequence("week", "until", F.expr("interval 7 days"))).alias("date"))
    present = F.col("date") == F.col("week")
    return filled.select(
        "date", *[F.when(present, F.col(c)).alias(c) for c in ("failure_in_next_7d", "engine_temperature")],
        F.when(present, F.coalesce("distance_km", F.lit(0.0))).otherwise(0.0).alias("distance_km"))


def vehicle_statistics(df: DataFrame) -> DataFrame:
    """Rounded to two digits, half up. ``total_distance_last`` is the last non-null value in time order."""
    seen = F.when(F.col("total_distance").isNotNull(), order_key(F.col("ts"), F.col("event_id")))

    def two(c: Column) -> Column:
        return fix(c, 2)

    return df.groupBy("vehicle_id").agg(
        F.min("date").alias("date_min"), F.max("date").alias("date_max"), F.count("date").alias("date_count"),
        two(F.avg("engine_temperature")).alias("engine_temperature_mean"),
        two(F.max("engine_temperature")).alias("engine_temperature_max"),
        two(F.stddev_samp("engine_temperature")).alias("engine_temperature_std"),
        two(F.avg("oil_pressure")).alias("oil_pressure_mean"),
        two(F.min("oil_pressure")).alias("oil_pressure_min"),
        two(F.stddev_samp("oil_pressure")).alias("oil_pressure_std"),
        two(F.avg("battery_voltage")).alias("battery_voltage_mean"),
        two(F.min("battery_voltage")).alias("battery_voltage_min"),
        two(F.sum("distance_km")).alias("distance_km_sum"),
        F.sum("failure_in_next_7d").alias("failure_in_next_7d_sum"),
        F.max_by("total_distance", seen).alias("total_distance_last"),
    )


def vehicle_summary(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Statistics, risk score, category and service priority of each vehicle: one scan, one shuffle."""
    stats = vehicle_statistics(df)
    scored = stats.withColumn("risk_score", risk.risk_score(stats.columns, weights))
    return scored.select(
        "*", risk.risk_category(F.col("risk_score")).alias("risk_category"),
        risk.maintenance_priority(F.col("risk_score")).alias("maintenance_priority"))


def daily_fleet(df: DataFrame) -> DataFrame:
    """Vehicles are counted in two steps, so a day is never one group of raw rows."""
    per_vehicle = df.groupBy("date", "vehicle_id").agg(
        F.sum("engine_temperature").alias("t"), F.count("engine_temperature").alias("tn"),
        F.sum("oil_pressure").alias("o"), F.count("oil_pressure").alias("on"),
        F.sum("failure_in_next_7d").alias("f"), F.sum("distance_km").alias("d"))
    return per_vehicle.groupBy("date").agg(
        F.count("vehicle_id").alias("active_vehicles"),
        ratio(F.sum("t"), F.sum("tn")).alias("avg_engine_temp"),
        ratio(F.sum("o"), F.sum("on")).alias("avg_oil_pressure"),
        F.sum("f").alias("failures"), F.sum("d").alias("total_distance"))


def daily_trends(df: DataFrame) -> DataFrame:
    """``daily_fleet`` with means over the last seven present days; null before seven values."""
    daily = daily_fleet(df)
    last7 = Window.orderBy("date").rowsBetween(-6, 0)  # one row per day

    def mean7(c: str) -> Column:
        return F.when(F.count(c).over(last7) == 7, F.avg(c).over(last7))

    return daily.select("*", mean7("avg_engine_temp").alias("avg_engine_temp_7d_ma"),
                        mean7("failures").alias("failure_rate_7d_ma"))


def recommendations(df: DataFrame, first: int = 10, oldest: int = 5) -> DataFrame:
    """The first vehicles seen too hot and too low on oil, and those with the highest mileage.

    One scan: an aggregate per vehicle, then a top-k per issue that is pruned inside every
    partition before the few rows left are moved. A vehicle may appear for several issues.
    """
    key = order_key(F.col("ts"), F.col("event_id"))
    per_vehicle = df.groupBy("vehicle_id").agg(
        F.min(F.when(F.col("engine_temperature") > 105, key)).alias("hot"),
        F.min(F.when(F.col("oil_pressure") < 30, key)).alias("low"),
        (-F.max("total_distance")).alias("mileage"))
    far = dict(per_vehicle.dtypes)["mileage"]
    lists = [("hot", first, fixed.RECOMMEND_TEMPERATURE), ("low", first, fixed.RECOMMEND_OIL),
             ("mileage", oldest, fixed.RECOMMEND_MILEAGE)]
    names = ["issue", "severity", "recommendation", "estimated_cost", "estimated_downtime_hours"]
    cells = [F.when(F.col(c).isNotNull(), F.struct(
        F.when(F.lit(c != "mileage"), F.col("low" if c == "mileage" else c)).alias("key"),
        F.when(F.lit(c == "mileage"), F.col("mileage")).cast(far).alias("far"), F.lit(size).alias("size"), *[F.lit(v).alias(n) for n, v in zip(names, texts)]))
        for c, size, texts in lists]
    rows = per_vehicle.select("vehicle_id", F.explode(F.array_compact(F.array(*cells))).alias("r")).select("vehicle_id", "r.*")
    rank = F.row_number().over(Window.partitionBy("issue").orderBy("key", "far", "vehicle_id"))
    ranked = rows.withColumn("rank", rank).where(F.col("rank") <= max(first, oldest))
    return ranked.where(F.col("rank") <= F.col("size")).select("vehicle_id", *names)


def importance_categories(importances: DataFrame, top: int = 20) -> DataFrame:
    ranked = importances.orderBy(F.col("importance").desc(), "feature").limit(top)
    return ranked.withColumn(
        "category", first_match(F.lower("feature"), fixed.DASHBOARD_KEYWORDS, fixed.DASHBOARD_ELSE))


def sample_importances(spark) -> DataFrame:
    """Shown while there is no trained model."""
    return spark.createDataFrame(fixed.SAMPLE_IMPORTANCES, "feature string, importance double, category string")


def dashboard(readings: DataFrame, run_date: str, predictions: DataFrame | None = None,
              importances: DataFrame | None = None) -> dict[str, DataFrame]:
    """All dashboard tables over one input, each a lazy plan."""
    df = readings if predictions is None else join_predictions(readings, predictions)
    return {
        "dashboard_kpis_kpis": fleet_kpis(df, run_date),
        "dashboard_kpis_weekly_trends": weekly_trends(df),
        "vehicle_summary": vehicle_summary(df),
        "time_series": daily_trends(df),
        "recommendations": recommendations(df),
        "feature_importance": (sample_importances(df.sparkSession) if importances is None
                               else importance_categories(importances)),
    }
