"""Checked queries: profiling, validation and cleaning."""

from pyspark.sql import functions as F

from fleetrisk.checks.registry import TELEMETRY, query
from fleetrisk.functions import fixed
from fleetrisk.operators import cleaning as cl
from fleetrisk.operators import quality as dq
from fleetrisk.operators import sketches as sk
from fleetrisk.session import scratch_path
from fleetrisk.sources import views

COLUMNS = ["event_id", "ts", "vehicle_id", "date", "engine_temperature", "oil_pressure", "rpm", "battery_voltage",
           "distance_km", "fuel_consumption", "idle_time_minutes", "max_speed_kmh", "vehicle_age_days", "total_distance",
           "fault_ts", "failure_in_next_7d", "failure_in_next_30d"]
NUMBERS = fixed.NUMERIC_INPUTS


@query("null_profile", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, 100e0 * (count(*) - count({c})) / count(*) AS null_pct FROM telemetry"
    for c in COLUMNS) + ") AS p WHERE null_count > 0", "null_pct", TELEMETRY)
def null_profile(spark, sf):
    return dq.null_profile(views.telemetry(spark, sf))


@query("null_totals", f"""
SELECT {" + ".join(f"(count(*) - count({c}))" for c in COLUMNS)} AS total_missing,
  100e0 * ({" + ".join(f"(count(*) - count({c}))" for c in COLUMNS)}) / (count(*) * {len(COLUMNS)}) AS missing_percentage,
  'engine_temperature,fault_ts' AS columns_with_missing FROM telemetry""", "missing_percentage", TELEMETRY)
def null_totals(spark, sf):
    t = dq.null_totals(views.telemetry(spark, sf))
    return t.withColumn("columns_with_missing", F.array_join("columns_with_missing", ","))


@query("duplicate_count", """
SELECT cast(sum(n - 1) AS bigint) AS duplicate_records FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, l_quantity) AS g""")
def duplicate_count(spark, sf):
    return dq.duplicate_count(views.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity"))


@query("type_check", """
SELECT c.* , (SELECT count(*) FROM telemetry) AS n_records
FROM (VALUES ('total_distance', 'float64', 'int64'), ('date', 'object', 'datetime64[ns]')) AS c("column", expected, actual)""", "", TELEMETRY)
def type_check(spark, sf):
    """Types that differ from the expected ones, with the number of values they affect."""
    t = views.telemetry(spark, sf)
    wrong = dq.type_check(t, {"vehicle_id": "object", "rpm": "float64", "total_distance": "float64", "date": "object"})
    counts = dq.table_shape(t).select("column", "n_records")
    return wrong.join(counts, "column")


def _bounds(c, source="telemetry"):
    return (f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source}")


def _outlier_sql(cols):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", cast({c} AS double) AS x FROM telemetry" for c in cols)
    bounds = " UNION ALL ".join(_bounds(c) for c in cols)
    return f"""
SELECT b."column", count(*) FILTER (x < lo OR x > hi) AS outliers_count,
  100e0 * count(*) FILTER (x < lo OR x > hi) / count(*) AS outliers_percentage, lo AS lower_bound, hi AS upper_bound
FROM ({parts}) AS v JOIN (SELECT "column", q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM ({bounds}) AS q) AS b
  ON v."column" = b."column" GROUP BY b."column", lo, hi"""


@query("iqr_outlier_profile", f"SELECT * FROM ({_outlier_sql(NUMBERS)}) AS o WHERE outliers_count > 0",
       "outliers_percentage lower_bound upper_bound", TELEMETRY)
def iqr_outlier_profile(spark, sf):
    return dq.iqr_outliers(views.telemetry(spark, sf), NUMBERS)


_FIRST5 = ["event_id", "engine_temperature", "oil_pressure", "rpm", "battery_voltage"]
_RULE_COLUMNS = ["event_id", "engine_temperature", "oil_pressure", "rpm", "battery_voltage", "distance_km", "vehicle_id"]


@query("quality_rules", f"""
SELECT "check", status, value, avg(CASE WHEN status = 'passed' THEN 1e0 ELSE 0e0 END) OVER () AS quality_score FROM (
  SELECT 'missing_values' AS "check", CASE WHEN v > 0.01e0 THEN 'failed' ELSE 'passed' END AS status, v AS value
  FROM (SELECT cast(greatest({", ".join(f"count(*) - count({c})" for c in _RULE_COLUMNS)}) AS double) / count(*) AS v FROM telemetry) AS m
  UNION ALL SELECT 'duplicates', CASE WHEN v > 0.05e0 THEN 'failed' ELSE 'passed' END, v FROM (
    SELECT sum(n - 1) / cast(sum(n) AS double) AS v FROM (SELECT count(*) AS n FROM telemetry GROUP BY {", ".join(_RULE_COLUMNS)}) AS g) AS d
  UNION ALL SELECT 'outliers_' || "column", 'warning', outliers_percentage / 100 FROM ({_outlier_sql(["distance_km"])}) AS o
    WHERE outliers_percentage > 1
  UNION ALL SELECT 'data_type_rpm', 'failed', 1e0) AS c""", "value quality_score", TELEMETRY)
def quality_rules(spark, sf):
    t = views.telemetry(spark, sf).select("distance_km", *[c for c in _RULE_COLUMNS if c != "distance_km"])
    return dq.quality_rules(t, null_limit=0.01, expected_types={"rpm": "int64", "vehicle_id": "object"}, outlier_columns=5)


def _profile(c):
    return f"""SELECT '{c}' AS "column", avg({c}) AS mean, stddev_samp({c}) AS std, cast(min({c}) AS double) AS "min",
  cast(quantile_cont({c}, 0.25) AS double) AS p25, cast(quantile_cont({c}, 0.5) AS double) AS p50,
  cast(quantile_cont({c}, 0.75) AS double) AS p75, cast(max({c}) AS double) AS "max", skewness({c}) AS skew,
  kurtosis({c}) AS kurtosis FROM orders"""


@query("numeric_profile", " UNION ALL ".join(_profile(c) for c in ["o_orderkey", "o_custkey", "o_totalprice"]),
       "mean std min p25 p50 p75 max skew kurtosis")
def numeric_profile(spark, sf):
    return dq.numeric_profile(views.table(spark, sf, "orders"))


def _categories(c, source):
    return f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_unique,
  (SELECT {c} FROM {source} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top_value,
  (SELECT count(*) FROM {source} GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS top_frequency,
  (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM {source} ORDER BY v LIMIT 10) AS d) AS unique_values
FROM {source}"""


@query("categorical_profile", " UNION ALL ".join(_categories(c, "customer") for c in ["c_name", "c_mktsegment"]))
def categorical_profile(spark, sf):
    p = dq.categorical_profile(views.table(spark, sf, "customer"))
    return p.withColumn("unique_values", F.array_join("unique_values", "|"))


_TYPES = dict.fromkeys(COLUMNS, "double") | {
    "event_id": "bigint", "ts": "timestamp_ntz", "vehicle_id": "string", "date": "date", "vehicle_age_days": "bigint",
    "total_distance": "bigint", "fault_ts": "timestamp_ntz", "failure_in_next_7d": "int", "failure_in_next_30d": "int"}


@query("table_shape", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {i} AS position, '{_TYPES[c]}' AS data_type, count(*) AS n_records, {len(COLUMNS)} AS n_features FROM telemetry"
    for i, c in enumerate(COLUMNS)), "", TELEMETRY)
def table_shape(spark, sf):
    return dq.table_shape(views.telemetry(spark, sf))


@query("content_hash", """
SELECT count(*) AS n_records, cast(sum(('0x' || substr(h, 1, 8))::bigint) % 9007199254740992 AS bigint) AS hash_high,
  cast(sum(('0x' || substr(h, 9, 8))::bigint) % 9007199254740992 AS bigint) AS hash_low
FROM (SELECT md5('0=' || event_id || '|1=' || user_id || '|2=' || event_type || '|3=' || props) AS h FROM events) AS e""")
def content_hash(spark, sf):
    return dq.content_hash(views.table(spark, sf, "events"), ["event_id", "user_id", "event_type", "props"])


_REQUIRED = ["vehicle_id", "engine_temperature", "oil_pressure", "humidity"]


@query("validate_rows", """
SELECT event_id, 'Missing required feature: humidity' || CASE WHEN event_type = 'click' THEN '; Empty string for event_type' ELSE '' END
  || CASE WHEN engine_temperature IS NULL THEN '; Missing required feature: engine_temperature' ELSE '' END AS errors, false AS is_valid
FROM (SELECT t.*, e.event_type FROM telemetry t JOIN events e ON t.event_id = e.event_id) AS r""", "", TELEMETRY)
def validate_rows(spark, sf):
    events = views.table(spark, sf, "events")
    blank = F.when(F.col("event_type") == "click", "  ").otherwise(F.col("event_type"))
    t = views.as_readings(events, event_type=blank).select(
        "event_id", "event_type", "vehicle_id", "engine_temperature", "oil_pressure")
    return dq.validate_rows(t, _REQUIRED).select("event_id", F.array_join("errors", "; ").alias("errors"), "is_valid")


@query("validation_report", f"""
SELECT 'table' AS section, cast(NULL AS varchar) AS "column", 'total_records' AS metric, cast(count(*) AS double) AS value FROM telemetry
UNION ALL SELECT 'duplicates', NULL, 'duplicate_records', 0e0
UNION ALL SELECT 'missing_values', 'engine_temperature', 'null_count', cast(count(*) - count(engine_temperature) AS double) FROM telemetry
UNION ALL SELECT 'missing_values', 'engine_temperature', 'null_pct', 100e0 * (count(*) - count(engine_temperature)) / count(*) FROM telemetry
UNION ALL SELECT 'outliers', "column", m, v FROM (SELECT "column", unnest(['outliers_count', 'outliers_percentage', 'lower_bound', 'upper_bound']) AS m,
  unnest([cast(outliers_count AS double), outliers_percentage, lower_bound, upper_bound]) AS v
  FROM ({_outlier_sql(NUMBERS)}) AS o WHERE outliers_count > 0) AS u""", "value", TELEMETRY)
def validation_report(spark, sf):
    return dq.validation_report(views.telemetry(spark, sf).select(*NUMBERS, "vehicle_id", "ts"))


# -- cleaning ---------------------------------------------------------------------------------------

@query("fill_mode", """
SELECT o_orderkey, coalesce(p, (SELECT p FROM (SELECT nullif(o_orderpriority, '5-LOW') AS p FROM orders) AS x WHERE p IS NOT NULL
  GROUP BY p ORDER BY count(*) DESC, p LIMIT 1)) AS o_orderpriority
FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p FROM orders) AS o""")
def fill_mode(spark, sf):
    orders = views.table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    return cl.fill_mode(orders, ["o_orderpriority"])


@query("fill_median", """
SELECT event_id, coalesce(engine_temperature, (SELECT quantile_cont(engine_temperature, 0.5) FROM telemetry)) AS engine_temperature
FROM telemetry""", "engine_temperature", TELEMETRY)
def fill_median(spark, sf):
    return cl.fill_median(views.telemetry(spark, sf).select("event_id", "engine_temperature"), ["engine_temperature"])


_FF = "last_value({c} IGNORE NULLS) OVER (PARTITION BY vehicle_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS {c}"


@query("ffill", f"SELECT event_id, vehicle_id, ts, {_FF.format(c='engine_temperature')}, {_FF.format(c='fault_ts')} FROM telemetry",
       "engine_temperature", TELEMETRY)
def ffill(spark, sf):
    cols = ["engine_temperature", "fault_ts"]
    return cl.fill_forward(views.telemetry(spark, sf).select("event_id", "vehicle_id", "ts", *cols), cols)


@query("drop_duplicates", "SELECT DISTINCT l_suppkey, l_quantity, l_returnflag FROM lineitem", "l_quantity")
def drop_duplicates(spark, sf):
    return cl.drop_duplicates(views.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag"))


def _capped(c, source="telemetry"):
    lo, hi = (f"(SELECT quantile_cont({c}, {a}) {s} 1.5e0 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM {source})"
              for a, s in ((0.25, "-"), (0.75, "+")))
    return lo, hi


_LO, _HI = _capped("distance_km")


@query("cap_outliers", f"""
SELECT event_id, CASE WHEN engine_temperature IS NOT NULL THEN greatest(least(engine_temperature, {_capped('engine_temperature')[1]}),
  {_capped('engine_temperature')[0]}) END AS engine_temperature, greatest(least(distance_km, {_HI}), {_LO}) AS distance_km
FROM telemetry""", "engine_temperature distance_km", TELEMETRY)
def cap_outliers(spark, sf):
    cols = ["engine_temperature", "distance_km"]
    return cl.cap_outliers(views.telemetry(spark, sf).select("event_id", *cols), cols)


def _date_text(spark, sf):
    day = F.col("ts").cast("date").cast("string")
    return views.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "n/a").otherwise(day).alias("seen"))


@query("parse_dates", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN cast(cast(ts AS date) AS timestamp) END AS seen FROM events""")
def parse_dates(spark, sf):
    out = cl.parse_dates(_date_text(spark, sf), ["seen"])
    return out.withColumn("seen", F.col("seen").cast("timestamp_ntz"))


@query("rejected_dates", "SELECT event_id, 'n/a' AS seen FROM events WHERE event_type = 'error'")
def rejected_dates(spark, sf):
    return cl.rejected_dates(_date_text(spark, sf), ["seen"])


@query("clean_readings", f"""
SELECT DISTINCT event_id, vehicle_id, ts, coalesce(unit, (SELECT unit FROM raw WHERE unit IS NOT NULL GROUP BY unit
    ORDER BY count(*) DESC, unit LIMIT 1)) AS unit,
  greatest(least(coalesce(engine_temperature, (SELECT quantile_cont(engine_temperature, 0.5) FROM raw)),
    {_capped('engine_temperature')[1]}), {_capped('engine_temperature')[0]}) AS engine_temperature,
  greatest(least(distance_km, {_HI}), {_LO}) AS distance_km, {_FF.format(c='fault_ts')},
  cast(date AS timestamp) AS date
FROM raw""", "engine_temperature distance_km", TELEMETRY + """,
raw AS (SELECT t.*, nullif(e.event_type, 'error') AS unit FROM telemetry t JOIN events e ON t.event_id = e.event_id)""")
def clean_readings(spark, sf):
    """Every cleaning step in order, on readings with each row given twice."""
    events = views.table(spark, sf, "events")
    t = views.as_readings(events, unit=F.nullif("event_type", F.lit("error"))).select(
        "event_id", "vehicle_id", "ts", "unit", "engine_temperature", "distance_km", "fault_ts",
        F.col("date").cast("string").alias("date"))
    out = cl.clean_readings(t.unionByName(t), categorical=["unit"], numerical=["engine_temperature"], dates=["date"])
    return out.withColumn("date", F.col("date").cast("timestamp_ntz"))


# -- mergeable sketches -------------------------------------------------------------------------------

_SKETCHED = ["engine_temperature", "oil_pressure", "rpm", "distance_km", "total_distance"]


@query("sketch_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, cast(min({c}) AS double) AS "min",
  cast(max({c}) AS double) AS "max", true AS ranks_close, true AS distinct_close FROM telemetry""" for c in _SKETCHED), "min max", TELEMETRY)
def sketch_profile(spark, sf):
    """A profile merged from the written sketches of each day, held against exact ranks and numbers of distinct values."""
    t, path = views.telemetry(spark, sf), scratch_path(spark, "sketches")
    sk.sketch_table(t, ["date"], _SKETCHED).write.partitionBy("date").parquet(path)
    profile = sk.approximate_profile(spark.read.parquet(path))
    exact = t.agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED])
    exact = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("_distinct")) for c in _SKETCHED])).alias("s")).select("s.*")
    rows = profile.join(sk.rank_bounds(t, profile), "column").join(exact, "column")
    close = F.abs(F.col("n_distinct") - F.col("_distinct")) <= sk.DISTINCT_ERROR * F.col("_distinct")
    return rows.select("column", "rows", "nulls", "min", "max", (F.col("rank_error") <= sk.RANK_ERROR).alias("ranks_close"), close.alias("distinct_close"))


@query("sketch_by_week", """
SELECT cast(date_trunc('week', date) AS date) AS week, 'vehicle_id' AS "column", count(*) AS rows, true AS distinct_close
FROM telemetry GROUP BY 1""", "", TELEMETRY)
def sketch_by_week(spark, sf):
    """Vehicles seen in each week, from the sketches of its days; days can be added up only as sketches."""
    t = views.telemetry(spark, sf)
    days = sk.sketch_table(t, ["date"], [], ["vehicle_id"]).withColumn("week", F.date_trunc("week", "date").cast("date"))
    weeks = sk.approximate_profile(days, ["week"])
    exact = t.groupBy(F.date_trunc("week", "date").cast("date").alias("week")).agg(F.count_distinct("vehicle_id").alias("_n"))
    close = F.abs(F.col("n_distinct") - F.col("_n")) <= sk.DISTINCT_ERROR * F.col("_n")
    return weeks.join(exact, "week").select("week", "column", "rows", close.alias("distinct_close"))
