"""Cleaning of readings: fills, duplicates, outlier caps and date parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetrisk.functions import fixed
from fleetrisk.functions.numbers import finite, finite_columns, numeric_columns
from fleetrisk.operators.features import columns_with_nulls, fill_gaps, fill_median
from fleetrisk.operators.quality import iqr_bounds, value_counts
from fleetrisk.operators.ranks import exact_quantiles
from fleetrisk.operators.timeline import on_timeline

__all__ = ["fill_mode", "fill_median", "fill_forward", "fill_gaps", "drop_duplicates", "cap_outliers",
           "parse_dates", "rejected_dates", "clean_readings"]


ID_COLUMNS = ["event_id", "reading_id"]


def modes(df:DataFrame, cols: list[str]) -> dict[str, str]:
    """{column: most frequent value}, the smallest one on ties; values are counted, never gathered."""
    if not cols:
        return {}
    best = value_counts(df, cols).groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("m"))
    return {r["column"]: r["m"]["value"] for r in best.collect()}  # one row per column


def fill_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    found = modes(df, cols)
    types = dict(df.dtypes)
    return df.select(*[F.coalesce(F.col(c), F.lit(found[c]).cast(types[c])).alias(c) if c in found else F.col(c)
                       for c in df.columns])


def fill_forward(df: DataFrame, cols: list[str], **layout) -> DataFrame:
    """Last non-null value of the same vehicle. Row order across vehicles has no meaning here."""
    def build(t):
        t = t.fill_forward({f"_new_{c}": c for c in cols})
        return t.select(*[F.col(f"_new_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])

    return on_timeline(df, build, **layout) if cols else df


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def cap(c: str, bounds: tuple) -> Column:
    """Clipped to the bounds; null, NaN and infinities give null (greatest and least skip nulls)."""
    x = finite(F.col(c))
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(float(bounds[1]))), F.lit(float(bounds[0]))))


def cap_outliers(df: DataFrame, cols: list[str] | None = None, bounds: dict | None = None, **rank_args) -> DataFrame:
    bounds = bounds if bounds is not None else iqr_bounds(df, cols, **rank_args)
    return df.select(*[cap(c, bounds[c]).alias(c) if c in bounds else F.col(c) for c in df.columns])


def parse_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text to timestamp; what cannot be read becomes null, see ``rejected_dates``."""
    types = dict(df.dtypes)

    def parsed(c):
        return F.try_to_timestamp(F.col(c)) if types[c] == "string" else F.col(c).cast("timestamp")

    return df.select(*[parsed(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def rejected_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with text in a date column that is not a date."""
    types = dict(df.dtypes)
    bad = F.lit(False)
    for c in cols:
        if types[c] == "string":
            bad = bad | (F.col(c).isNotNull() & F.try_to_timestamp(F.col(c)).isNull())
    return df.where(bad)


def clean_readings(df: DataFrame, categorical=(), numerical=(), dates=(), key: str = "vehicle_id",
                   order: tuple = ("ts", "event_id"), layout: dict | None = None, **rank_args) -> DataFrame:
    """Fill nulls (mode, median, else forward), drop duplicates, cap outliers, parse dates.

    NaN and infinities are nulls here. Keys, the order, ids and targets are never capped, and a column without an outlier
    keeps its values and its type. Outlier bounds and medians come from the raw rows, in one set of passes; what is
    collected is a few numbers per column. The rows themselves move at most twice: by vehicle (only if
    something is filled forward) and by content.
    """
    df = finite_columns(df)
    numbers = numeric_columns(df, exclude=[key, *order, *ID_COLUMNS, "target", *fixed.TARGETS])
    quartiles = {c: q for c, q in exact_quantiles(df, numbers, [0.0, 0.25, 0.5, 0.75, 1.0], **rank_args).items() if q[0] is not None}
    bounds = {}
    for c, (least, q1, _, q3, most) in quartiles.items():
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        if least < low or most > high:
            bounds[c] = low, high
    holes = columns_with_nulls(df, df.columns)
    out = fill_mode(df, [c for c in holes if c in categorical])
    out = out.select(*[F.coalesce(F.col(c).cast("double"), F.lit(quartiles[c][2])).alias(c)
                       if c in holes and c in numerical and c in quartiles else F.col(c) for c in out.columns])
    rest = [c for c in holes if c not in categorical and c not in numerical and c not in (key, *order)]
    out = fill_forward(out, rest, key=key, order=order, **(layout or {}))
    return parse_dates(cap_outliers(drop_duplicates(out), bounds=bounds), [c for c in dates if c in out.columns])
