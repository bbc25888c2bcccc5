"""Reading and writing tables: CSV, JSON, parquet, catalog tables and databases."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetrisk.functions.numbers import finite_columns

MART_NAMES = ["predictions", "model_metrics", "business_metrics", "feature_importance",
              "time_series_predictions", "fleet_summary"]

READING_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("engine_temperature", T.DoubleType()), T.StructField("oil_pressure", T.DoubleType()),
    T.StructField("rpm", T.DoubleType()), T.StructField("battery_voltage", T.DoubleType()),
    T.StructField("distance_km", T.DoubleType()), T.StructField("idle_time_minutes", T.DoubleType()),
    T.StructField("max_speed_kmh", T.DoubleType()), T.StructField("vehicle_age_days", T.IntegerType()),
    T.StructField("total_distance", T.LongType()),
])


def read_readings(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                  multi_line: bool = True) -> DataFrame:
    """CSV with a header or JSON by extension; give a schema, or the file is read twice to infer one.

    A JSON file that is one array cannot be split among tasks. Give ``multi_line=False`` for one
    object per line, the form to use for large data. NaN and infinities are read as null.
    """
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "csv":
        return finite_columns(reader.option("header", True).option("inferSchema", schema is None).csv(path))
    if kind == "json":
        return finite_columns(reader.option("multiLine", multi_line).json(path))
    raise ValueError("Unsupported file format. Use CSV or JSON.")


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType | str, array: bool = False) -> tuple[DataFrame, DataFrame]:
    """(readings, rejects) of CSV with a header or of JSON by extension: a record that cannot be read whole is not one of nulls.

    rejects has the text of each record with an unreadable value, too few or too many CSV fields or broken JSON, and its
    file. Records of either table add up to those of the files. CSV records are lines, and the header names the columns of the
    schema in their order. JSON has an object on each line or, with ``array``, arrays of flat objects: those are read by
    their closing braces, so that one large array is shared among tasks, and an object with a brace inside a text is rejected.
    A JSON field that is not there is null. NaN and infinities are read as null.
    """
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in ("csv", "json"):
        raise ValueError("Unsupported file format. Use CSV or JSON.")
    if not isinstance(schema, T.StructType):
        schema = T.StructType.fromDDL(schema)
    clash = {"_corrupt", "_text"} & set(schema.names)
    if clash:
        raise ValueError(f"columns are there already: {', '.join(sorted(clash))}")
    reader = spark.read.option("lineSep", "}") if array and kind == "json" else spark.read
    lines = reader.text(path).select(F.col("value").alias("_text"), F.col("_metadata.file_path").alias("file"))
    with_text = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]).simpleString()
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    if kind == "csv":
        first = lines.where(F.trim("_text") != "").first()
        header = first["_text"] if first else ""
        named = [n.strip().strip('"') for n in header.split(",")]
        if first and named != schema.names:
            raise ValueError(f"the header {named} does not name the columns {schema.names}")
        lines = lines.where((F.trim("_text") != "") & (F.col("_text") != header))
        record = F.from_csv("_text", with_text.removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    else:
        if array:
            piece = F.regexp_replace("_text", r"^[\s,\[\]]+", "")
            lines = lines.withColumn("_text", F.when(piece != "", F.concat(piece, F.lit("}"))).otherwise(""))
        lines = lines.where(F.trim("_text") != "")
        record = F.from_json("_text", with_text, options)
    rows = lines.withColumn("_record", record)
    bad = F.col("_record").isNull() | F.col("_record._corrupt").isNotNull()
    good = rows.where(~bad).select(*[F.col("_record").getField(n).alias(n) for n in schema.names])
    return finite_columns(good), rows.where(bad).select(F.col("_text").alias("record"), "file")


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """CSV with a header or parquet by extension, replacing what is there.

    With ``partition_by`` the rows are rebalanced on those columns first: few files per folder,
    and adaptive execution splits a folder that holds much of the data over several tasks.
    """
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in ("csv", "parquet"):
        raise ValueError("Unsupported file format. Use CSV or Parquet.")
    partition_by = list(partition_by)
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_marts(marts: dict[str, DataFrame], folder: str, kind: str = "csv") -> None:
    for name, df in marts.items():
        write_table(df, f"{folder.rstrip('/')}/{name}.{kind}")


def read_mart(spark: SparkSession, name: str, folder: str | None = None, kind: str = "csv",
              schema: T.StructType | str | None = None) -> DataFrame:
    """One named mart from a folder, or from the catalog when no folder is given."""
    if name not in MART_NAMES:
        raise ValueError(f"Unknown mart: {name}")
    if folder is None:
        return spark.table(name)
    path = f"{folder.rstrip('/')}/{name}.{kind}"
    if kind == "parquet":
        return spark.read.parquet(path)
    return read_readings(spark, path, schema)


def refresh_marts(spark: SparkSession, folder: str | None = None, kind: str = "csv",
                  names: Iterable[str] = MART_NAMES) -> dict[str, DataFrame]:
    return {name: read_mart(spark, name, folder, kind) for name in names}


def write_catalog_table(df: DataFrame, name: str, path: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_database_table(df: DataFrame, url: str, name: str, **options) -> None:
    df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=name, **options).save()


def read_database_table(spark: SparkSession, url: str, name: str, split: tuple | None = None, **options) -> DataFrame:
    """``split`` = (numeric column, lower, upper, partitions) reads a large table in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    if split:
        column, lower, upper, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return reader.load()


def explode_requests(df: DataFrame, vehicles: str = "vehicles") -> DataFrame:
    """Batch requests (an array of readings per row) as one row per reading."""
    return df.select(F.explode(vehicles).alias("v")).select("v.*")
