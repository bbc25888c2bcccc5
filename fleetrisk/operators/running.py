"""Exact running totals over a whole table without putting it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.operators.ranges import cut_by_order

# Up to this many rows one window task is the cheapest exact plan.
ONE_TASK_ROWS = 1_000_000


def running_totals(points: DataFrame, order: Column, sums: list[str], one_task_rows: int = ONE_TASK_ROWS):
    """Adds ``cum_<c>`` (running total in ``order``, this row included) for each column in ``sums``.

    Returns the table and the grand totals. The row count is checked first: a bounded table is
    totalled in one window, a larger one is cut into ordered pieces that are totalled in parallel
    and shifted by the totals of the pieces before them.
    """
    head = points.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in sums]).first()
    totals = {c: head[c] for c in sums}
    if head["_n"] <= one_task_rows:
        upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return points.select("*", *[F.sum(c).over(upto).alias(f"cum_{c}") for c in sums]), totals

    pieces = -(-head["_n"] // one_task_rows)
    cut = cut_by_order(points, [order], pieces)
    inside = Window.partitionBy("_piece").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # One row per piece: pieces = rows / one_task_rows, so this side stays small.
    offsets = (
        cut.groupBy("_piece").agg(*[F.sum(c).alias(c) for c in sums])
        .select("_piece", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sums])
    )
    if pieces <= 100_000:
        offsets = F.broadcast(offsets)
    out = (
        cut.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums])
        .join(offsets, "_piece")
        .select(*points.columns, *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sums])
    )
    return out, totals
