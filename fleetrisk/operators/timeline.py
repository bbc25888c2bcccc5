"""Per-vehicle time order, laid out so that no vehicle is bound to one task.

Most vehicles have few rows: one shuffle by vehicle and a window per vehicle is the best plan.
A vehicle above ``hot_rows`` rows is cut into blocks of consecutive rows instead. Blocks know
their position in the vehicle, get copies of the rows just before them (for row frames and lags)
and the values carried over from other blocks (for fills and next-event lookups), so both
layouts give the same result. Operators are written once, against ``Timeline``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.functions.numbers import finite_columns
from fleetrisk.operators.ranges import cut_by_order

HOT_ROWS = 5_000_000
BLOCK_ROWS = 1_000_000
#: Tables of at most this many cells (keys, or blocks by columns) are broadcast; larger ones are joined by shuffles.
BROADCAST_CELLS = 1_000_000
#: Hot keys up to this number are looked up from the driver, more from a table.
LISTED_KEYS = 100_000
_LAYOUT = ["_block", "_pos", "_halo"]


class Timeline:
    """Rows with a key and an order; ``blocks`` is the number of blocks, or None when uncut."""

    def __init__(self, df: DataFrame, key: str, order: tuple, blocks: int | None = None, block_rows: int = 0):
        self.df, self.key, self.order = df, key, tuple(order)
        self.blocks, self.block_rows = blocks, block_rows
        self._window = Window.partitionBy(*self.groups).orderBy(*self.order)
        self._frames = {}

    def _with(self, df: DataFrame) -> "Timeline":
        return Timeline(df, self.key, self.order, self.blocks, self.block_rows)

    @property
    def groups(self) -> list[str]:
        return [self.key] if self.blocks is None else [self.key, "_block"]

    @property
    def window(self):
        return self._window

    @property
    def backwards(self):
        """Reverse order. A frame that is unbounded *following* is quadratic in Spark; this is not."""
        return Window.partitionBy(*self.groups).orderBy(*[F.col(c).desc() for c in self.order])

    def last_rows(self, n: int):
        """Frame of the last n rows, this one included."""
        if n not in self._frames:
            self._frames[n] = self.window.rowsBetween(-(n - 1), 0)
        return self._frames[n]

    def position(self) -> Column:
        """Row number in the vehicle, from 0."""
        return (F.row_number().over(self.window) - 1).cast("bigint") if self.blocks is None else F.col("_pos")

    # -- operators that look arbitrarily far -------------------------------------------------

    def fill_forward(self, columns: dict[str, str]) -> "Timeline":
        """{new: source}: the last non-null value up to this row."""
        upto = self.window.rowsBetween(Window.unboundedPreceding, 0)
        local = {new: F.last(src, ignorenulls=True).over(upto) for new, src in columns.items()}
        if self.blocks is None:
            return self._with(_assign(self.df, local))
        ends = {f"_c{i}": F.max_by(src, F.when(F.col(src).isNotNull(), F.col("_pos")))
                for i, src in enumerate(columns.values())}
        joined = self._carry(_assign(self.df, local), ends,
                             lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        return self._with(_assign(joined, {new: F.coalesce(F.col(new), F.col(f"_c{i}")) for i, new in enumerate(columns)},
                                  drop=list(ends)))

    def fill_both(self, columns: list[str]) -> "Timeline":
        """In place: last non-null value up to this row, else the first one of the vehicle.

        The first value is taken with min_by over the row number: Spark turns ``first`` over a whole
        partition into one offset frame per column, which is several times slower on wide tables.
        """
        upto = self.window.rowsBetween(Window.unboundedPreceding, 0)
        if self.blocks is None:
            whole = self.window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            numbered = self.df.withColumn("_row", F.row_number().over(self.window))
            return self._with(_assign(numbered, {
                c: F.coalesce(F.last(c, ignorenulls=True).over(upto),
                              F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_row"))).over(whole))
                for c in columns}, drop=["_row"]))
        value = {}
        for i, c in enumerate(columns):
            there = F.when(F.col(c).isNotNull(), F.col("_pos"))
            value[f"_s{i}"], value[f"_e{i}"] = F.min_by(c, there), F.max_by(c, there)

        def other_blocks(name, w):
            if name.startswith("_s"):
                return F.first(name, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            return F.last(name, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))

        local = {f"_b{i}": F.last(c, ignorenulls=True).over(upto) for i, c in enumerate(columns)}
        joined = self._carry(self.df, value, other_blocks)
        filled = _assign(joined, local)
        return self._with(_assign(
            filled, {c: F.coalesce(F.col(f"_b{i}"), F.col(f"_e{i}"), F.col(f"_s{i}")) for i, c in enumerate(columns)},
            drop=[f"{p}{i}" for p in ("_b", "_e", "_s") for i in range(len(columns))]))

    def next_min(self, new: str, src: str) -> "Timeline":
        """The smallest non-null value among the later rows of the vehicle."""
        local = {new: F.min(src).over(self.backwards.rowsBetween(Window.unboundedPreceding, -1))}
        if self.blocks is None:
            return self._with(_assign(self.df, local))
        joined = self._carry(_assign(self.df, local), {"_c0": F.min(src)},
                             lambda c, w: F.min(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), backwards=True)
        return self._with(_assign(joined, {new: F.least(F.col(new), F.col("_c0"))}, drop=["_c0"]))

    # -- operators that look a fixed number of rows back ---------------------------------------

    def with_lookback(self, n: int) -> "Timeline":
        """Blocks get copies of the n rows before them, marked ``_halo``; an uncut layout needs none."""
        if self.blocks is None or n == 0:
            return self
        if n > self.block_rows:
            raise ValueError("a block must be longer than the lookback")
        tail = F.col("_pos") % self.block_rows >= self.block_rows - n
        to = F.array_compact(F.array(F.col("_block"), F.when(tail, F.col("_block") + 1)))
        keep = [c for c in self.df.columns if c not in ("_block", "_halo")]
        df = self.df.select(*keep, F.explode(to).alias("_block"))
        return self._with(df.withColumn("_halo", F.col("_pos") < F.col("_block") * self.block_rows))

    def without_lookback(self) -> "Timeline":
        return self if self.blocks is None else self._with(self.df.where(~F.col("_halo")))

    def select(self, *cols) -> "Timeline":
        extra = [] if self.blocks is None else [c for c in _LAYOUT]
        return self._with(self.df.select(*cols, *extra))

    def add(self, columns: dict[str, Column]) -> "Timeline":
        return self._with(_assign(self.df, columns))

    def rows(self) -> DataFrame:
        return self.df.drop(*_LAYOUT)

    def _carry(self, df: DataFrame, ends: dict[str, Column], over: Callable, backwards: bool = False) -> DataFrame:
        """Joins one value per block, computed from the other blocks of the vehicle (one row per block)."""
        by_block = F.col("_block").desc() if backwards else F.col("_block")
        w = Window.partitionBy(self.key).orderBy(by_block)
        source = self.df.where(~F.col("_halo"))
        table = source.groupBy(*self.groups).agg(*[e.alias(n) for n, e in ends.items()]).select(
            F.col(self.key).alias("_k"), F.col("_block").alias("_kb"), *[over(n, w).alias(n) for n in ends])
        if self.blocks * (len(ends) + 2) <= BROADCAST_CELLS:
            table = F.broadcast(table)
        return df.join(table, F.col(self.key).eqNullSafe(F.col("_k")) & (F.col("_block") == F.col("_kb")), "left").drop("_k", "_kb")


def on_timeline(df: DataFrame, build: Callable[[Timeline], Timeline], key: str = "vehicle_id",
                order: tuple = ("ts", "event_id"), hot_rows: int | None = None,
                block_rows: int | None = None, any_hot: bool | None = None) -> DataFrame:
    """``build`` applied to the rows of every vehicle; hot vehicles take the block layout.

    NaN and infinities are nulls, for every operator and in the result. ``any_hot`` is given by callers that
    already know whether a vehicle exceeds ``hot_rows``.
    """
    df = finite_columns(df)
    hot_rows, block_rows = hot_rows or HOT_ROWS, block_rows or BLOCK_ROWS
    names, keys, rows = (None, 0, 0) if any_hot is False else _hot_keys(df, key, hot_rows)
    if not keys:
        return build(Timeline(df, key, order)).rows()
    same = F.col(key).eqNullSafe(F.col("_hot"))
    cold = df.join(names, same, "left_anti")
    warm = df.join(names, same, "left_semi")
    cut = _blocks(warm, key, order, rows, keys, block_rows)
    return build(Timeline(cold, key, order)).rows().unionByName(build(cut).rows())


def _hot_keys(df: DataFrame, key: str, hot_rows: int) -> tuple[DataFrame, int, int]:
    """(table of the keys above hot_rows rows as ``_hot``, their number, their rows together).

    Few keys become a broadcast list. More stay a table, and adaptive execution splits the hot side of its joins.
    """
    hot = df.groupBy(F.col(key).alias("_hot")).count().where(F.col("count") > hot_rows)
    names = hot.select("_hot")
    listed = hot.limit(LISTED_KEYS + 1).collect()
    if len(listed) > LISTED_KEYS:
        return names, *hot.agg(F.count(F.lit(1)), F.sum("count")).first()
    names = df.sparkSession.createDataFrame([(r["_hot"],) for r in listed], schema=names.schema)
    return F.broadcast(names), len(listed), sum(r["count"] for r in listed)


def _blocks(df: DataFrame, key: str, order: tuple, rows: int, keys: int, block_rows: int) -> Timeline:
    placed = cut_by_order(df, [F.col(c) for c in (key, *order)], -(-rows // block_rows))
    # One row per (vehicle, piece): at most pieces + vehicles of them.
    starts = placed.groupBy(F.col(key).alias("_k"), F.col("_piece").alias("_p")).agg(
        F.min("_slot").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_k", "_p", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_skip"))
    blocks = -(-rows // block_rows) + keys
    if blocks * len(starts.columns) <= BROADCAST_CELLS:
        starts = F.broadcast(starts)
    pos = F.col("_slot") - F.col("_first") + F.col("_skip")
    out = (
        placed.join(starts, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_piece") == F.col("_p")))
        .withColumn("_pos", pos)
        .withColumn("_block", F.floor(F.col("_pos") / block_rows).cast("bigint"))
        .withColumn("_halo", F.lit(False))
        .select(*df.columns, *_LAYOUT)
    )
    return Timeline(out, key, order, blocks=blocks, block_rows=block_rows)


def _assign(df: DataFrame, columns: dict[str, Column], drop: list[str] = ()) -> DataFrame:
    """All columns in one projection: existing names are replaced, new ones appended."""
    old = [columns.get(c, F.col(c)).alias(c) for c in df.columns if c not in drop]
    return df.select(*old, *[e.alias(n) for n, e in columns.items() if n not in df.columns])
