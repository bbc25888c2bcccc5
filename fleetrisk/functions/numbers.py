"""Small Column helpers shared by all operators."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fix(x: Column, digits: int = 6) -> Column:
    """Round half up; gives the same bits in any engine that has ``floor``."""
    scale = float(10 ** digits)
    return F.floor(x * scale + 0.5) / scale


def ratio(a: Column, b: Column) -> Column:
    """a / b, or null when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def finite(x: Column) -> Column:
    """x as double with NaN and infinities turned into null."""
    d = x.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), d)


def finite_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """df with NaN and infinities of its floating columns (or those of cols) turned into null; types stay."""
    names = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)
             and (cols is None or f.name in cols)]
    kept = {c: F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.col(c)) for c in names}
    return df.withColumns(kept) if kept else df


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down (half a day before is -1)."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(micros / F.lit(86400e6)).cast("bigint")


def order_key(ts: Column, seq: Column) -> Column:
    """(ts, seq) packed into one decimal, so min_by / max_by keep a hash aggregate.

    A struct key would force a sort of every map partition before the partial aggregate.
    """
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(18,0)")
    return (micros * F.lit(Decimal(10 ** 19)) + seq.cast("decimal(19,0)")).cast("decimal(38,0)")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def first_match(name: Column, groups, otherwise: str, exact: bool = False) -> Column:
    """Label of the first group with a word contained in (or equal to) ``name``."""
    out = F.lit(otherwise)
    for label, words in reversed(list(groups)):
        hit = name.isin(*words) if exact else reduce(or_, [name.contains(w) for w in words])
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out
