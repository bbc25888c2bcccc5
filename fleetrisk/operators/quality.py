"""Validation and profiling. Reports are long tables (column, metric...), not nested objects."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetrisk.functions.numbers import count_if, finite, finite_columns, numeric_columns, ratio
from fleetrisk.operators.ranks import exact_quantiles

# Data frame type names and the Spark types that stand for them.
TYPE_NAMES = {
    "string": "object", "double": "float64", "float": "float32", "bigint": "int64", "int": "int32",
    "smallint": "int16", "tinyint": "int8", "boolean": "bool", "timestamp": "datetime64[ns]",
    "timestamp_ntz": "datetime64[ns]", "date": "datetime64[ns]",
}


def _long(df: DataFrame, rows: list[tuple[Column, ...]], names: list[str]) -> DataFrame:
    """One wide row turned into one row per tuple."""
    structs = [F.struct(*[e.alias(n) for n, e in zip(names, row)]) for row in rows]
    return df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def null_profile(df: DataFrame) -> DataFrame:
    """(column, null_count, null_pct) of the columns that have nulls, NaN or infinities; one pass."""
    df = finite_columns(df)
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [(F.lit(c), F.col(c), F.coalesce(ratio(100.0 * F.col(c), F.col("_n")), F.lit(0.0))) for c in df.columns]
    return _long(wide, rows, ["column", "null_count", "null_pct"]).where("null_count > 0")


def null_totals(df: DataFrame) -> DataFrame:
    """(total_missing, missing_percentage, columns_with_missing) over all cells; NaN and infinities count as missing."""
    df = finite_columns(df)
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = reduce(add, [F.col(c) for c in df.columns])
    return wide.select(
        total.alias("total_missing"),
        F.coalesce(ratio(100.0 * total, F.col("_n") * len(df.columns)), F.lit(0.0)).alias("missing_percentage"),
        F.array_compact(F.array(*[F.when(F.col(c) > 0, c) for c in df.columns])).alias("columns_with_missing"))


def _copies(df: DataFrame) -> DataFrame:
    """(n, repeats): the number of rows, and of those after the first of identical ones, exactly.

    Rows are told apart by two hashes first, so what is shuffled are two longs and a count. Only rows whose hashes
    appear twice are compared as a whole, which also parts different rows of equal hashes.
    """
    marked = df.select("*", F.xxhash64(*df.columns).alias("_d1"), F.xxhash64(F.lit("again"), *df.columns).alias("_d2"))
    digests = marked.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_n"))
    again = marked.join(digests.where("_n > 1").select("_d1", "_d2"), ["_d1", "_d2"], "left_semi")
    # Copies are combined before the shuffle.
    same = again.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    repeats = same.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("repeats"))
    total = digests.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n"))
    return total.crossJoin(repeats)  # one row each


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows after the first of identical rows (nulls are equal)."""
    return _copies(df).select(F.col("repeats").alias("duplicate_records"))


def type_check(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(column, expected, actual) where the expected type name is not part of the actual one."""
    actual = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rows = [(c, want, actual[c]) for c, want in expected.items() if c in actual and want not in actual[c]]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string")


def iqr_bounds(df: DataFrame, cols: list[str] | None = None, **rank_args) -> dict[str, tuple]:
    """{column: (lower, upper)} at 1.5 interquartile ranges; exact, columns without values left out."""
    cols = cols if cols is not None else numeric_columns(df)
    out = {}
    for c, (q1, q3) in exact_quantiles(df, cols, [0.25, 0.75], **rank_args).items():
        if q1 is not None:
            out[c] = (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    return out


def _outside(c: str, bounds: tuple) -> Column:
    x = finite(F.col(c))
    return (x < F.lit(bounds[0])) | (x > F.lit(bounds[1]))


def iqr_outliers(df: DataFrame, cols: list[str] | None = None, bounds: dict | None = None, **rank_args) -> DataFrame:
    """(column, outliers_count, outliers_percentage, lower_bound, upper_bound) of columns with outliers."""
    bounds = bounds if bounds is not None else iqr_bounds(df, cols, **rank_args)
    names = ["column", "outliers_count", "outliers_percentage", "lower_bound", "upper_bound"]
    if not bounds:
        return df.sparkSession.createDataFrame(
            [], "column string, outliers_count bigint, outliers_percentage double, lower_bound double, upper_bound double")
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[count_if(_outside(c, b)).alias(c) for c, b in bounds.items()])
    rows = [(F.lit(c), F.col(c), F.coalesce(ratio(100.0 * F.col(c), F.col("_n")), F.lit(0.0)),
             F.lit(float(lo)), F.lit(float(hi))) for c, (lo, hi) in bounds.items()]
    return _long(wide, rows, names).where("outliers_count > 0")


def quality_rules(df: DataFrame, null_limit: float = 0.1, duplicate_limit: float = 0.05,
                  outlier_limit: float = 0.01, expected_types: dict[str, str] | None = None,
                  outlier_columns: int | None = None, **rank_args) -> DataFrame:
    """(check, status, value, quality_score): each rule's outcome and the share of passed ones.

    A column without many outliers adds no row, so it neither helps nor hurts the score. Outliers are looked for in
    every numeric column, or in the first ``outlier_columns`` of them.
    """
    numbers = numeric_columns(df)[:outlier_columns]
    bounds = iqr_bounds(df, numbers, **rank_args)
    n = F.count(F.lit(1))
    # One row of measures for nulls and outliers, one for duplicates; both are constant size.
    wide = df.agg(
        F.coalesce(ratio(F.greatest(F.lit(0), *[count_if(F.col(c).isNull()) for c in df.columns]), n), F.lit(0.0)).alias("nulls"),
        n.alias("n"), *[F.coalesce(ratio(count_if(_outside(c, b)), n), F.lit(0.0)).alias(f"out_{c}") for c, b in bounds.items()])
    null_row = [(F.lit("missing_values"), F.when(F.col("nulls") > null_limit, "failed").otherwise("passed"), F.col("nulls"))]
    out_rows = [(F.lit(f"outliers_{c}"), F.when(F.col(f"out_{c}") > outlier_limit, "warning"), F.col(f"out_{c}"))
                for c in bounds]
    names = ["check", "status", "value"]
    checks = _long(wide, null_row + out_rows, names).where("status is not null")
    copies = _copies(df).select(F.coalesce(ratio(F.col("repeats"), F.col("n")), F.lit(0.0)).alias("d"))
    checks = checks.unionByName(copies.select(
        F.lit("duplicates").alias("check"),
        F.when(F.col("d") > duplicate_limit, "failed").otherwise("passed").alias("status"), F.col("d").alias("value")))
    if expected_types:
        wrong = type_check(df, expected_types)
        checks = checks.unionByName(wrong.select(
            F.concat(F.lit("data_type_"), "column").alias("check"), F.lit("failed").alias("status"),
            F.lit(1.0).alias("value")))
    whole = Window.partitionBy()  # a handful of rows: one per rule
    score = F.coalesce(ratio(F.sum(F.when(F.col("status") == "passed", 1).otherwise(0)).over(whole),
                             F.count(F.lit(1)).over(whole)), F.lit(1.0))
    return checks.select(*names, score.alias("quality_score"))


def numeric_profile(df: DataFrame, cols: list[str] | None = None, **rank_args) -> DataFrame:
    """Mean, deviation, range, quartiles and bias-corrected skew and excess kurtosis per column; both are 0 for equal values."""
    cols = cols or numeric_columns(df)
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75], **rank_args)
    aggs = []
    for i, c in enumerate(cols):
        x = finite(F.col(c))
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
                 F.skewness(x).alias(f"g{i}"), F.kurtosis(x).alias(f"k{i}")]
    rows = []
    for i, c in enumerate(cols):
        n = F.col(f"n{i}").cast("double")
        skew = F.when(n > 2, F.coalesce(F.col(f"g{i}") * F.sqrt(n * (n - 1)) / (n - 2), F.lit(0.0)))
        excess = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col(f"k{i}") + 6)
        kurt = F.when(n > 3, F.coalesce(excess, F.lit(0.0)))
        q = [F.lit(v).cast("double") for v in quartiles[c]]
        rows.append((F.lit(c), F.col(f"mean{i}"), F.col(f"std{i}"), F.col(f"min{i}"), *q, F.col(f"max{i}"), skew, kurt))
    return _long(df.agg(*aggs), rows, ["column", "mean", "std", "min", "p25", "p50", "p75", "max", "skew", "kurtosis"])


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n) of all non-null values; one shuffle for all columns, combined map-side."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    return (df.select(F.explode(F.array(*cells)).alias("s")).select("s.*")
            .where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def categorical_profile(df: DataFrame, cols: list[str] | None = None, first: int = 10) -> DataFrame:
    """(column, n_unique, top_value, top_frequency, unique_values): ties go to the smaller value.

    The lists come from a per-column top-k, which Spark prunes inside every partition first.
    """
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts = value_counts(df, cols)
    totals = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_unique"), F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("top"))
    by_value = Window.partitionBy("column").orderBy("value")
    heads = (counts.withColumn("r", F.row_number().over(by_value)).where(F.col("r") <= first)
             .groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("unique_values")))
    return totals.join(heads, "column").select(
        "column", "n_unique", F.col("top.value").alias("top_value"), (-F.col("top.n")).alias("top_frequency"),
        "unique_values")


def table_shape(df: DataFrame) -> DataFrame:
    """(column, position, data_type, n_records, n_features)."""
    rows = [(F.lit(f.name), F.lit(i), F.lit(f.dataType.simpleString()), F.col("n"), F.lit(len(df.columns)))
            for i, f in enumerate(df.schema.fields)]
    return _long(df.agg(F.count(F.lit(1)).alias("n")), rows, ["column", "position", "data_type", "n_records", "n_features"])


def content_hash(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(n_records, hash_high, hash_low): equal for equal contents in any row order.

    Row digests are summed, so it needs no sort. Give integers, text and dates; doubles are
    printed differently by different engines.
    """
    cols = cols or df.columns
    text = F.concat_ws("|", *[F.concat(F.lit(f"{i}="), F.coalesce(F.col(c).cast("string"), F.lit("\\N")))
                              for i, c in enumerate(cols)])
    digest = F.md5(text)

    def total(start):  # decimals: a bigint sum of 32-bit digests overflows after two billion rows
        part = F.conv(F.substring(digest, start, 8), 16, 10).cast("decimal(20,0)")
        return (F.coalesce(F.sum(part), F.lit(0)) % F.lit(2 ** 53)).cast("bigint")

    return df.agg(F.count(F.lit(1)).alias("n_records"), total(1).alias("hash_high"), total(9).alias("hash_low"))


def row_errors(df: DataFrame, required: list[str]) -> Column:
    """Array of messages for missing fields, non-finite numbers and blank strings of a row."""
    found = [F.lit(f"Missing required feature: {c}") for c in required if c not in df.columns]
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in required:
            found.append(F.when(c.isNull(), f"Missing required feature: {f.name}"))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            found.append(F.when(F.isnan(c) | (F.abs(c) == float("inf")), f"Invalid value for {f.name}"))
        elif isinstance(f.dataType, T.StringType):
            found.append(F.when(F.trim(c) == "", f"Empty string for {f.name}"))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def validate_rows(df: DataFrame, required: list[str]) -> DataFrame:
    """df with ``errors`` and ``is_valid``."""
    return df.withColumn("errors", row_errors(df, required)).withColumn("is_valid", F.size("errors") == 0)


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their errors): nothing is lost."""
    checked = validate_rows(df, required)
    return checked.where("is_valid").drop("errors", "is_valid"), checked.where("not is_valid").drop("is_valid")


def validation_report(df: DataFrame, expected_types: dict[str, str] | None = None, **rank_args) -> DataFrame:
    """(section, column, metric, value): the whole report as one long table."""
    def rows(frame, section, metrics):
        return [frame.select(F.lit(section).alias("section"), "column", F.lit(m).alias("metric"),
                             F.col(m).cast("double").alias("value")) for m in metrics]

    none = F.lit(None).cast("string").alias("column")
    total = df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("table").alias("section"), none, F.lit("total_records").alias("metric"), "value")
    copies = duplicate_count(df).select(
        F.lit("duplicates").alias("section"), none, F.lit("duplicate_records").alias("metric"),
        F.col("duplicate_records").cast("double").alias("value"))
    parts = [total, copies, *rows(null_profile(df), "missing_values", ["null_count", "null_pct"]),
             *rows(iqr_outliers(df, **rank_args), "outliers",
                   ["outliers_count", "outliers_percentage", "lower_bound", "upper_bound"])]
    if expected_types:
        parts.append(type_check(df, expected_types).select(
            F.lit("data_type_issues").alias("section"), "column", F.lit("mismatch").alias("metric"), F.lit(1.0).alias("value")))
    return reduce(DataFrame.unionByName, parts)
