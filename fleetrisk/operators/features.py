"""Time-ordered features per vehicle. "7d" in a name means the last seven rows, as in the data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetrisk.functions import fixed, readings
from fleetrisk.functions.numbers import count_if, finite, finite_columns, numeric_columns, ratio
from fleetrisk.operators.ranks import exact_quantiles
from fleetrisk.operators.training_sets import feature_columns
from fleetrisk.operators.timeline import HOT_ROWS, Timeline, on_timeline
from fleetrisk.session import scratch_path

MIN_ROWS = 3


@dataclass(frozen=True)
class Recipe:
    """Window features: how far back they look, which inputs they need forward filled, the columns."""

    build: Callable[[Timeline], dict[str, Column]]
    lookback: int = 0
    filled: tuple = ()

    def __add__(self, other: "Recipe") -> "Recipe":
        return Recipe(lambda t: {**self.build(t), **other.build(t)}, max(self.lookback, other.lookback),
                      tuple(dict.fromkeys(self.filled + other.filled)))

    def apply(self, t: Timeline) -> Timeline:
        columns = t.df.columns
        t = t.fill_forward({_filled(c): c for c in self.filled}) if self.filled else t
        t = t.with_lookback(self.lookback)
        t = t.add(self.build(t)).without_lookback()
        new = [c for c in t.df.columns if c not in columns and c not in {_filled(f) for f in self.filled}]
        return t.select(*[c for c in columns if c not in ("_block", "_pos", "_halo")],
                        *[c for c in new if c not in ("_block", "_pos", "_halo")])


def _filled(c: str) -> str:
    return f"_filled_{c}"


def _guarded(value: Column, x, frame) -> Column:
    return F.when(F.count(x).over(frame) >= MIN_ROWS, value)


def rolling_mean(cols, n: int = 7) -> Recipe:
    return Recipe(lambda t: {f"{c}_rolling_mean_{n}d": _guarded(F.avg(c).over(t.last_rows(n)), c, t.last_rows(n))
                             for c in cols}, n - 1)


def rolling_std(cols, n: int = 7) -> Recipe:
    return Recipe(lambda t: {f"{c}_rolling_std_{n}d": _guarded(F.stddev_samp(c).over(t.last_rows(n)), c, t.last_rows(n))
                             for c in cols}, n - 1)


def pct_change(cols, n: int) -> Recipe:
    """x / x n rows ago - 1, on forward-filled values; a zero base gives null."""
    return Recipe(lambda t: {f"{c}_pct_change_{n}d": ratio(F.col(_filled(c)), F.lag(_filled(c), n).over(t.window)) - 1.0
                             for c in cols}, n, tuple(cols))


def rate_of_change(cols) -> Recipe:
    return Recipe(lambda t: {f"{c}_roc": F.col(c) - F.lag(c, 1).over(t.window) for c in cols}, 1)


def acceleration(cols) -> Recipe:
    def build(t):
        w = t.window
        return {f"{c}_acceleration": (F.col(c) - F.lag(c, 1).over(w)) - (F.lag(c, 1).over(w) - F.lag(c, 2).over(w))
                for c in cols}
    return Recipe(build, 2)


def volatility(cols, n: int = 5) -> Recipe:
    return Recipe(lambda t: {f"{c}_volatility": _guarded(F.stddev_samp(c).over(t.last_rows(n)), c, t.last_rows(n))
                             for c in cols}, n - 1)


def violations(cols, n: int = 7) -> Recipe:
    """Rows of the frame above the high or below the low limit."""
    limits = [(c, side, edge) for c, side, edge in fixed.VIOLATION_LIMITS if c in cols]

    def build(t):
        frame = t.last_rows(n)
        return {f"{c}_{side}_violations_{n}d": _guarded(
            F.sum(F.when(F.col(c) > edge if side == "high" else F.col(c) < edge, 1).otherwise(0)).over(frame), c, frame)
            for c, side, edge in limits}
    return Recipe(build, n - 1)


def maintenance_counter(period: int = 90) -> Recipe:
    return Recipe(lambda t: {"days_since_last_maintenance": t.position() % period})


def rowwise(columns: dict[str, tuple[list[str], Column]], have) -> Recipe:
    return Recipe(lambda t: {n: e for n, (needs, e) in columns.items() if set(needs) <= set(have)})


def with_features(df: DataFrame, recipe: Recipe, **layout) -> DataFrame:
    """df with the recipe's columns; one shuffle by vehicle."""
    return on_timeline(df, recipe.apply, **layout)


def fill_gaps(df: DataFrame, cols, **layout) -> DataFrame:
    """Per vehicle: last value before the gap, else the first value after it."""
    return on_timeline(df, lambda t: t.fill_both(list(cols)), **layout)


def input_columns(df: DataFrame, keys=("event_id", "reading_id")) -> list[str]:
    return numeric_columns(df, exclude=[*fixed.TARGETS, *keys])


def full_recipe(df: DataFrame, cols: list[str], day: str = "date") -> Recipe:
    critical = [c for c in fixed.CRITICAL_INPUTS if c in df.columns]
    have = df.columns
    recipe = (rolling_mean(cols) + rolling_std(cols) + pct_change(cols, 1) + pct_change(cols, 7)
              + rate_of_change(critical) + acceleration(critical) + volatility(critical)
              + rowwise(readings.engineered(), have) + violations(have) + rowwise(readings.interactions(), have))
    if day in have:
        dated = {n: ([], e) for n, e in {**readings.calendar(F.col(day)), **readings.cyclic_day(F.col(day))}.items()}
        recipe = recipe + rowwise(dated, have) + maintenance_counter()
    return recipe


def feature_table(df: DataFrame, cols: list[str] | None = None, medians: bool = True, **layout) -> DataFrame:
    """All features, gaps filled per vehicle and, where a vehicle has no value at all, by the median."""
    df = finite_columns(df)
    cols = cols or input_columns(df)
    recipe = full_recipe(df, cols)

    def build(t: Timeline) -> Timeline:
        t = recipe.apply(t)
        return t.fill_both(numeric_columns(t.df, exclude=[*fixed.TARGETS, *_keys(df), "_block", "_pos"]))

    open_vehicles, hot_vehicles = _vehicle_checks(df, cols, layout.get("hot_rows") or HOT_ROWS, **_named_key(layout))
    out = on_timeline(df, build, **layout, any_hot=hot_vehicles > 0)
    if not medians or not open_vehicles:
        return out
    numbers = numeric_columns(out, exclude=[*fixed.TARGETS, *_keys(df)])
    open_cols = columns_with_nulls(out, numbers)
    return fill_median(out, open_cols)


def _keys(df: DataFrame) -> list[str]:
    return [c for c in ("event_id", "reading_id") if c in df.columns]


def _named_key(layout: dict) -> dict:
    return {"key": layout["key"]} if "key" in layout else {}


def _vehicle_checks(df: DataFrame, cols: list[str], hot_rows: int, key: str = "vehicle_id") -> tuple[int, int]:
    """(vehicles that may keep an empty feature, vehicles above hot_rows) from one map-side aggregate.

    The first is an upper bound: with enough values per vehicle some frame must hold three of
    them, some pair and triple of rows must be complete, and some base eight rows back must be
    non-zero. It saves computing every feature twice just to learn that no median is needed.
    """
    n = F.count(F.lit(1))

    def crowded(c, width, need):
        return F.count(c) > (need - 1) * F.ceil(n / width)

    tests = []
    for c in cols:
        nonzero = count_if(F.col(c).isNotNull() & (F.col(c) != 0))
        tests += [crowded(c, 7, MIN_ROWS), nonzero >= 8]
    for c in fixed.CRITICAL_INPUTS:
        if c in df.columns:
            tests += [crowded(c, 5, MIN_ROWS), crowded(c, 2, 2), crowded(c, 3, 3)]
    # Numeric columns without features of their own are filled too.
    tests += [F.count(c) > 0 for c in numeric_columns(df, exclude=[*fixed.TARGETS, *_keys(df), *cols])]
    for needs, expr in [*readings.engineered().values(), *readings.interactions().values()]:
        if set(needs) <= set(df.columns):
            tests.append(F.count(expr) > 0)
    ok = tests[0]
    for test in tests[1:]:
        ok = ok & test
    per_vehicle = df.groupBy(key).agg(ok.alias("ok"), n.alias("n"))
    return tuple(per_vehicle.agg(count_if(~F.col("ok")), count_if(F.col("n") > hot_rows)).first())


def columns_with_nulls(df: DataFrame, cols: list[str]) -> list[str]:
    if not cols:
        return []
    row = finite_columns(df, cols).agg(*[count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def fill_median(df: DataFrame, cols: list[str], fit_rows: int | None = None) -> DataFrame:
    """Nulls, NaN and infinities of each column replaced by its exact median; a column without values stays as it is."""
    if not cols:
        return df
    args = {"fit_rows": fit_rows} if fit_rows else {}
    medians = {c: v[0] for c, v in exact_quantiles(df, cols, [0.5], **args).items() if v[0] is not None}
    return df.select(*[F.coalesce(finite(F.col(c)), F.lit(medians[c])).alias(c) if c in medians else F.col(c)
                       for c in df.columns])


def feature_catalog(spark) -> DataFrame:
    rows = [(f, c, "High", "") for c, features in fixed.FEATURE_CATALOG.items() for f in features]
    return spark.createDataFrame(rows, "feature string, category string, business_impact string, description string")


class _FleetFeaturesParams(Params):
    """How readings are keyed and ordered, which inputs get features, and what the fit has learned."""

    keyCol = Param(Params._dummy(), "keyCol", "vehicle of a reading", TypeConverters.toString)
    orderCols = Param(Params._dummy(), "orderCols", "order of a vehicle's readings", TypeConverters.toListString)
    inputCols = Param(Params._dummy(), "inputCols", "inputs with features; by default all numbers but ids and targets", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "the features in order, inputs included", TypeConverters.toListString)
    medianCols = Param(Params._dummy(), "medianCols", "features with a median", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "their medians", TypeConverters.toListFloat)

    def __init__(self, **params):
        super().__init__()
        self._setDefault(keyCol="vehicle_id", orderCols=["ts", "event_id"])
        self._set(**params)

    def _layout(self) -> dict:
        return {"key": self.getOrDefault(self.keyCol), "order": tuple(self.getOrDefault(self.orderCols))}


class FleetFeatures(Estimator, _FleetFeaturesParams, DefaultParamsReadable, DefaultParamsWritable):
    """``feature_table`` as an ML stage: the fit learns the medians, the model it gives is saved with them.

    A pipeline that begins with it takes raw readings, in training and in scoring. Readings are scored with the history
    they come with: the frames of a vehicle's first rows are those of a new vehicle.
    """

    def _fit(self, dataset: DataFrame) -> "FleetFeaturesModel":
        return self.fit_table(dataset)[0]

    def fit_table(self, dataset: DataFrame) -> tuple["FleetFeaturesModel", DataFrame]:
        """(the fitted stage, what it makes of these readings); the windows are computed once and written."""
        inputs = self.getOrDefault(self.inputCols) if self.isSet(self.inputCols) else input_columns(dataset)
        table = feature_table(dataset, inputs, medians=False, **self._layout())
        outputs = feature_columns(table)
        path = scratch_path(table.sparkSession, "features")
        table.write.parquet(path)
        table = table.sparkSession.read.schema(table.schema).parquet(path)
        medians = {c: v[0] for c, v in exact_quantiles(table, outputs, [0.5], written=True).items() if v[0] is not None}
        model = FleetFeaturesModel(keyCol=self.getOrDefault(self.keyCol), orderCols=self.getOrDefault(self.orderCols), inputCols=inputs,
                                   outputCols=outputs, medianCols=list(medians), medians=[float(m) for m in medians.values()])
        return model, model.filled(table)


class FleetFeaturesModel(Model, _FleetFeaturesParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the features; what a vehicle has no value for at all is the median of the readings that were fitted."""

    def features(self) -> list[str]:
        return self.getOrDefault(self.outputCols)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs = self.getOrDefault(self.inputCols)
        missing = [c for c in (*inputs, self.getOrDefault(self.keyCol), *self.getOrDefault(self.orderCols)) if c not in dataset.columns]
        if missing:
            raise ValueError(f"columns not found: {', '.join(missing)}")
        return self.filled(feature_table(dataset, inputs, medians=False, **self._layout()))

    def filled(self, table: DataFrame) -> DataFrame:
        """A table of features with the medians in its gaps."""
        medians = dict(zip(self.getOrDefault(self.medianCols), self.getOrDefault(self.medians)))
        lost = [c for c in self.features() if c not in table.columns]
        if lost:
            raise ValueError(f"columns not found: {', '.join(lost)}")
        return table.select(*[F.coalesce(finite(F.col(c)), F.lit(medians[c])).alias(c) if c in medians else F.col(c) for c in table.columns])
