"""Checked queries: sources and sinks, by writing whole tables and reading them back."""

from pyspark.sql import functions as F

from fleetrisk.checks.mart_queries import all_marts
from fleetrisk.checks.registry import TELEMETRY, query
from fleetrisk.session import scratch_path
from fleetrisk.sources import files, views

_COLUMNS = ["event_id", "vehicle_id", "date", "engine_temperature", "battery_voltage", "distance_km", "total_distance"]
_SCHEMA = ("event_id bigint, vehicle_id string, date date, engine_temperature double, battery_voltage double, "
           "distance_km double, total_distance bigint")
_SQL = f"SELECT {', '.join(_COLUMNS)} FROM telemetry"
_DOUBLES = "engine_temperature battery_voltage distance_km"


def _readings(spark, sf):
    return views.telemetry(spark, sf).select(*_COLUMNS)


@query("scan_csv", _SQL, _DOUBLES, TELEMETRY)
def scan_csv(spark, sf):
    path = scratch_path(spark, "readings.csv")
    files.write_table(_readings(spark, sf), path)
    return files.read_readings(spark, path, _SCHEMA)


@query("scan_json", _SQL, _DOUBLES, TELEMETRY)
def scan_json(spark, sf):
    path = scratch_path(spark, "readings.json")
    _readings(spark, sf).write.json(path)
    return files.read_readings(spark, path, _SCHEMA, multi_line=False)


@query("scan_named_marts", """
SELECT 'predictions' AS mart, count(*) AS n FROM telemetry UNION ALL SELECT 'model_metrics', 13
UNION ALL SELECT 'business_metrics', 9 UNION ALL SELECT 'feature_importance', 10
UNION ALL SELECT 'time_series_predictions', count(DISTINCT date) FROM telemetry
UNION ALL SELECT 'fleet_summary', count(DISTINCT vehicle_id) FROM telemetry""", "", TELEMETRY)
def scan_named_marts(spark, sf):
    folder = scratch_path(spark, "marts")
    files.write_marts(all_marts(spark, sf), folder, "parquet")
    out = None
    for name, df in files.refresh_marts(spark, folder, "parquet").items():
        row = df.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def _as_table(spark, sf, name):
    files.write_catalog_table(_readings(spark, sf), name, scratch_path(spark, name))
    return files.read_catalog_table(spark, name)


@query("scan_sql_table", "SELECT vehicle_id, count(*) AS n, sum(distance_km) AS distance_km FROM telemetry GROUP BY vehicle_id",
       "distance_km", TELEMETRY)
def scan_sql_table(spark, sf):
    return _as_table(spark, sf, "fleet_scan_readings").groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("distance_km").alias("distance_km"))


@query("sink_csv", "SELECT date, count(DISTINCT vehicle_id) AS active_vehicles FROM telemetry GROUP BY date", "", TELEMETRY)
def sink_csv(spark, sf):
    folder = scratch_path(spark, "export")
    daily = views.telemetry(spark, sf).groupBy("date").agg(F.count_distinct("vehicle_id").alias("active_vehicles"))
    files.write_marts({"time_series_predictions": daily}, folder)
    return files.read_mart(spark, "time_series_predictions", folder, schema="date date, active_vehicles bigint")


@query("sink_parquet", _SQL, _DOUBLES, TELEMETRY)
def sink_parquet(spark, sf):
    """Written by day; repartitioned so that one day is not split over all tasks' files."""
    path = scratch_path(spark, "readings.parquet")
    files.write_table(_readings(spark, sf), path, partition_by=["date"])
    return spark.read.schema(_SCHEMA).parquet(path).select(*_COLUMNS)


@query("sink_table", _SQL, _DOUBLES, TELEMETRY)
def sink_table(spark, sf):
    return _as_table(spark, sf, "fleet_sink_readings")


# -- records that cannot be read -----------------------------------------------------------------------

_DAMAGE = "event_id bigint, vehicle_id string, rpm double, battery_voltage double"
_REJECTS = """
SELECT event_id, event_id % 50 = 0 OR event_id % 70 = 0 AS rejected,
  CASE WHEN NOT (event_id % 50 = 0 OR event_id % 70 = 0) THEN rpm END AS rpm FROM telemetry"""


def _both(good, rejects, pattern):
    lost = rejects.select(F.regexp_extract("record", pattern, 1).cast("bigint").alias("event_id"), F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("rpm"))
    return good.select("event_id", F.lit(False).alias("rejected"), "rpm").unionByName(lost)


@query("scan_csv_rejects", _REJECTS, "rpm", TELEMETRY)
def scan_csv_rejects(spark, sf):
    """Every fiftieth record has a word for a number, every seventieth ends early; the rest is read as it is."""
    path, t = scratch_path(spark, "damaged.csv"), views.telemetry(spark, sf)
    whole = F.concat_ws(",", F.col("event_id"), "vehicle_id", F.when(F.col("event_id") % 50 == 0, "much").otherwise(F.col("rpm").cast("string")), "battery_voltage")
    line = F.when(F.col("event_id") % 70 == 0, F.concat_ws(",", F.col("event_id"), "vehicle_id")).otherwise(whole)
    # Each file begins with the header: the first row of a partition has number 0 in the low bits.
    head = F.when(F.monotonically_increasing_id() % 2**33 == 0, "event_id,vehicle_id,rpm,battery_voltage\n").otherwise("")
    t.select(F.concat(head, line).alias("value")).write.text(path)
    return _both(*files.read_with_rejects(spark, path, _DAMAGE), r"^(\d+),")


@query("scan_json_rejects", _REJECTS, "rpm", TELEMETRY)
def scan_json_rejects(spark, sf):
    """The same in JSON arrays: a word for a number, and an object that breaks off."""
    path, t = scratch_path(spark, "damaged.json"), views.telemetry(spark, sf)
    whole = F.to_json(F.struct("event_id", "vehicle_id", F.col("rpm").cast("string").alias("rpm"), "battery_voltage"))
    whole = F.regexp_replace(whole, '"rpm":"([^"]*)"', '"rpm":$1')
    value = (F.when(F.col("event_id") % 70 == 0, F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(', "vehicle_id" "V"}')))
             .when(F.col("event_id") % 50 == 0, F.regexp_replace(whole, '"rpm":[^,]*', '"rpm":"much"')).otherwise(whole))
    last = t.agg(F.max("event_id")).first()[0]
    mark = F.when(F.col("event_id") == last, "]").otherwise(",")
    t.select(F.concat(value, mark).alias("value")).write.text(path)
    return _both(*files.read_with_rejects(spark, path, _DAMAGE, array=True), r'"event_id":\s*(\d+)')
