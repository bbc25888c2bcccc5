"""Targets from future faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.functions.numbers import days_between
from fleetrisk.operators.timeline import on_timeline


def within(days: Column, horizon: int) -> Column:
    return F.when(days.between(0, horizon), 1).otherwise(0)


def with_target(df: DataFrame, fault: str = "fault_date", ts: str = "timestamp", horizon: int = 30,
                target: str = "target", days: str = "days_to_fault") -> DataFrame:
    """Days to the fault (rounded down) and 1 if it falls within the horizon; no fault gives 0."""
    missing = [c for c in (fault, ts) if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    to_fault = days_between(F.col(ts), F.col(fault))
    return df.withColumn(days, to_fault).withColumn(target, within(F.col(days), horizon))


def next_fault(df: DataFrame, fault: str = "fault_ts", new: str = "next_fault_ts", **layout) -> DataFrame:
    """The next fault of the same vehicle after each reading: an as-of join without a join."""
    return on_timeline(df, lambda t: t.next_min(new, fault), **layout)


def next_fault_from(readings: DataFrame, faults: DataFrame, fault: str = "fault_ts", carry: tuple = (), key: str = "vehicle_id",
                    ts: str = "ts", seq: str = "event_id", inclusive: bool = True, **layout) -> DataFrame:
    """readings with the next fault of the same vehicle in a table of faults: its time, and the columns ``carry`` of it.

    An as-of join without a range join: both tables are ordered together, and each reading takes the least fault after
    it; a vehicle with very many rows is cut into blocks. With ``inclusive`` a fault at the very time of a reading is its next one.
    Of several faults of one time the one with the least carried columns is taken. Readings without a vehicle or time
    have none, and so have those after the last fault; faults without a vehicle or time count for nothing.
    """
    clash = [c for c in (fault, *carry) if c in readings.columns]
    if clash:
        raise ValueError(f"columns are there already: {', '.join(clash)}")
    at = F.struct(F.col(fault).alias("at"), *[F.col(c) for c in carry])
    kind = dict(readings.dtypes)[ts]
    known = faults.where(F.col(key).isNotNull() & F.col(fault).isNotNull()).select(
        F.col(key), F.col(fault).cast(kind).alias(ts), at.alias("_at"))
    # Equal times: readings first where faults of their time are to be found.
    rows = readings.withColumn("_kind", F.lit(1)).unionByName(
        known.withColumn("_kind", F.lit(2 if inclusive else 0)), allowMissingColumns=True)
    found = on_timeline(rows, lambda t: t.next_min("_next", "_at"), key=key, order=(ts, "_kind", seq), **layout).where("_kind = 1")
    placed = F.col(key).isNotNull() & F.col(ts).isNotNull()
    return found.select(*readings.columns, *[F.when(placed, F.col(f"_next.{'at' if c == fault else c}")).alias(c) for c in (fault, *carry)])


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """(target, n, rate): two steps, so the total needs no second scan."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per class
    return counts.select(F.col(target).alias("target"), "n", (F.col("n") / total).alias("rate"))
