"""Profiles from mergeable sketches: one pass over the data, kept by day or partition, put together later without it.

A sketch table has a row for each group and column: the number of values, least and largest one, a KLL sketch of the
numbers and an HLL sketch of the distinct values. Each has a bounded size. Tables of different days, files or
clusters are appended to each other; what is asked of several groups together is merged from their rows. The exact
operators in ``quality`` stay as they are; these are for tables that are not to be read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetrisk.functions.numbers import count_if, finite, numeric_columns

#: Size of a KLL sketch, and the error of its ranks that goes with it (99 % of all cases, both sides).
KLL_SIZE, RANK_ERROR = 400, 0.007
#: Base-2 logarithm of an HLL sketch's registers, and three times its standard error.
HLL_SIZE, DISTINCT_ERROR = 12, 0.05


def sketch_table(df: DataFrame, by: list[str], numbers: list[str] | None = None, texts: list[str] = ()) -> DataFrame:
    """(by..., column, rows, n, least, largest, quantiles, distinct) for each group of df.

    ``rows`` counts all rows and ``n`` those with a value; nulls, NaN and infinities are none. Numbers have both
    sketches, texts only that of distinct values.
    """
    numbers = numbers if numbers is not None else numeric_columns(df, exclude=by)
    wide, parts = [], []
    for i, c in enumerate([*numbers, *texts]):
        x = finite(F.col(c)).cast("double") if c in numbers else F.col(c).cast("string")
        wide += [F.count(x).alias(f"n{i}"), F.hll_sketch_agg(x.cast("string"), HLL_SIZE).alias(f"d{i}")]
        if c in numbers:
            wide += [F.kll_sketch_agg_double(x, KLL_SIZE).alias(f"q{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        none = F.lit(None)
        parts.append(F.struct(
            F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(f"n{i}").alias("n"),
            (F.col(f"lo{i}") if c in numbers else none.cast("double")).alias("least"),
            (F.col(f"hi{i}") if c in numbers else none.cast("double")).alias("largest"),
            (F.col(f"q{i}") if c in numbers else none.cast("binary")).alias("quantiles"), F.col(f"d{i}").alias("distinct")))
    grouped = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *wide)
    return grouped.select(*by, F.explode(F.array(*parts)).alias("_s")).select(*by, "_s.*")


def merged(sketches: DataFrame, by: list[str] = ()) -> DataFrame:
    """The sketches of all groups together, or of those that share ``by``; of the same columns as a sketch table."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("largest").alias("largest"),
        # A group without a value has an empty sketch, which adds nothing.
        F.kll_merge_agg_double(F.when(F.col("quantiles").isNotNull() & (F.col("n") > 0), F.col("quantiles")), KLL_SIZE).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"))


def _quantile(p: float) -> Column:
    inner = F.when(F.col("least").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(p)))
    return F.least(F.greatest(inner, F.col("least")), F.col("largest"))


def approximate_profile(sketches: DataFrame, by: list[str] = (), probs: tuple = (0.25, 0.5, 0.75)) -> DataFrame:
    """(by..., column, rows, nulls, n_distinct, min, quantiles as p25..., max) of merged sketches, from their rows only.

    The rank of a quantile is within RANK_ERROR of the one asked for, the number of distinct values within DISTINCT_ERROR of theirs.
    """
    m = merged(sketches, by)
    return m.select(*by, "column", "rows", (F.col("rows") - F.col("n")).alias("nulls"),
                    F.hll_sketch_estimate("distinct").alias("n_distinct"), F.col("least").alias("min"),
                    *[_quantile(p).alias(f"p{round(100 * p)}") for p in probs], F.col("largest").alias("max"))


def approximate_bounds(sketches: DataFrame) -> dict[str, tuple]:
    """{column: (lower, upper)} at 1.5 interquartile ranges, as ``quality.iqr_outliers`` takes them; one row for each column."""
    rows = approximate_profile(sketches.where("least IS NOT NULL"), probs=(0.25, 0.75)).collect()
    return {r["column"]: (r["p25"] - 1.5 * (r["p75"] - r["p25"]), r["p75"] + 1.5 * (r["p75"] - r["p25"])) for r in rows}


def rank_bounds(df: DataFrame, profile: DataFrame, probs: tuple = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, rank_error): how far the quantiles of a profile of df are from the ranks they stand for, exactly.

    The rank of a value is any between the share of the values below it and that of the values up to it.
    """
    out, rows = None, profile.where("min IS NOT NULL").collect()  # one row for each column
    wide, names = [], []
    for i, r in enumerate(rows):
        x = finite(F.col(r["column"])).cast("double")
        for k, p in enumerate(probs):
            q = F.lit(r[f"p{round(100 * p)}"])
            below, up_to = count_if(x < q) / F.count(x), count_if(x <= q) / F.count(x)
            wide.append(F.greatest(below - p, p - up_to, F.lit(0.0)).alias(f"e{i}_{k}"))
        names.append(F.struct(F.lit(r["column"]).alias("column"), F.greatest(*[F.col(f"e{i}_{k}") for k in range(len(probs))]).alias("rank_error")))
    out = df.agg(*wide).select(F.explode(F.array(*names)).alias("s"))
    return out.select("s.*")
