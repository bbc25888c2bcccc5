"""Training sets: feature choice, time-ordered splits and folds, class weights, oversampling."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.functions import fixed
from fleetrisk.functions.numbers import finite, numeric_columns
from fleetrisk.operators.ranks import FIT_ROWS, values_at_ranks
from fleetrisk.session import scratch_path

#: A label with more values than this is taken for a wrong column.
MAX_CLASSES = 100

NOT_FEATURES = ["event_id", "reading_id", "ts", "timestamp", "date", "vehicle_id", "fault_date", "fault_ts",
                "next_fault_ts", "days_to_fault", "target", *fixed.TARGETS]


def feature_columns(df: DataFrame, drop=()) -> list[str]:
    """Numeric columns that are neither ids, times, faults nor targets."""
    return numeric_columns(df, exclude=[*NOT_FEATURES, *drop])


def select_features(df: DataFrame, target: str, drop=()) -> DataFrame:
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found in DataFrame")
    return df.select(*[c for c in feature_columns(df, drop) if c != target], F.col(target))


@dataclass(frozen=True)
class Cut:
    """A point of the (ts, seq) order. The rows before it are a comparison of bare columns with
    literals, so the filter reaches the scan and skips row groups. Rows without a time or a number come
    before every cut; every row is either before a cut or not."""

    ts: str
    seq: str
    kind: str
    micros: int | None = None
    number: int | None = None

    def before(self) -> Column:
        if self.micros is None:
            return F.lit(True)
        at = F.timestamp_micros(F.lit(self.micros)).cast(self.kind)
        ts, seq = F.col(self.ts), F.col(self.seq)
        return ts.isNull() | seq.isNull() | (ts < at) | ((ts == at) & (seq < self.number))


def cuts_at(df: DataFrame, ranks: list[int], rows: int, ts: str = "ts", seq: str = "event_id",
            fit_rows: int = FIT_ROWS) -> list[Cut]:
    """The cuts with exactly the given numbers of rows before them.

    Rank selection on the time column, then on the sequence number inside each found time: only
    counts move, the rows are never sorted or shuffled. Rows without a time or a number are counted first: a
    cut among them moves behind them. Rows that share both stay together, behind a cut that falls among them.
    """
    kind = dict(df.dtypes)[ts]
    known = df.where(F.col(ts).isNotNull() & F.col(seq).isNotNull())
    placed = known.count()
    # The rank of each cut among the rows that have a place.
    among = {r: max(0, r - (rows - placed)) for r in ranks}
    inside = sorted({k for k in among.values() if k < placed})
    cuts = {k: Cut(ts, seq, kind) for k in among.values() if k >= placed}
    if inside:
        micros = F.unix_micros(F.col(ts).cast("timestamp"))
        at = values_at_ranks(known, micros, inside, fit_rows)
        times = sorted({v for v, _ in at.values()})
        found = F.col(ts).isin(*[F.timestamp_micros(F.lit(t)).cast(kind) for t in times])
        single = {r["m"]: (r["n"], r["first"]) for r in known.where(found).groupBy(micros.alias("m")).agg(
            F.count(F.lit(1)).alias("n"), F.min(seq).alias("first")).collect()}  # one row per cut
        for k, (time, below) in at.items():
            n, number = single[time]
            if n > 1 and k > below:
                here = known.where(F.col(ts) == F.timestamp_micros(F.lit(time)).cast(kind))
                number = values_at_ranks(here, F.col(seq), [k - below], fit_rows)[k - below][0]
            cuts[k] = Cut(ts, seq, kind, time, number)
    return [cuts[among[r]] for r in ranks]


def in_time_order(df: DataFrame, order=("ts", "event_id")) -> DataFrame:
    """df written once as parquet in the order of time, and read from there.

    What made the rows runs once, however many folds and fits follow. A split or fold, which is a comparison with literals,
    reads its own row groups, and a pass has as many tasks as the bytes ask for instead of one for each shuffle partition.
    """
    path = scratch_path(df.sparkSession, "training")
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered_split(df: DataFrame, test_share: float = 0.2, **args) -> tuple[DataFrame, DataFrame]:
    """(train, test): the last ceil(share * n) rows in time order are the test set."""
    n = df.count()
    cut = cuts_at(df, [n - math.ceil(test_share * n)], n, **args)[0]
    return df.where(cut.before()), df.where(~cut.before())


def expanding_folds(df: DataFrame, folds: int = 5, **args) -> list[tuple[DataFrame, DataFrame]]:
    """[(train, test)]: equal test blocks at the end, each trained on everything before it."""
    n = df.count()
    size = n // (folds + 1)
    if size == 0:
        raise ValueError(f"cannot make {folds} folds of {n} rows")
    cuts = cuts_at(df, [n - size * (folds - k) for k in range(folds + 1)], n, **args)
    return [(df.where(a.before()), df.where(~a.before() & b.before())) for a, b in zip(cuts, cuts[1:])]


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight n / (classes * n of the class)."""

    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # one row per class
    return counts.select(F.col(label).alias("label"), "n",
                         (F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str, weight: str = "weight", classes: int = 1) -> DataFrame:
    """df with the balanced weight of its class, as a literal expression (one entry per class).

    A label of more than MAX_CLASSES values is an error, found before more than those reach the driver.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values")
    if len(found) < classes:
        raise ValueError(f"training needs rows of {classes} classes")
    total = sum(r["n"] for r in found)
    out = F.lit(None).cast("double")
    for r in found:
        out = F.when(F.col(label) == F.lit(r["label"]), F.lit(total / (len(found) * r["n"]))).otherwise(out)
    return df.withColumn(weight, out)


def correlations(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    """(feature, correlation) with the target; one pass for all features."""
    cols = cols or [c for c in feature_columns(df) if c != target]
    wide = df.agg(*[F.corr(finite(F.col(c)), F.col(target).cast("double")).alias(c) for c in cols])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def top_correlated(df: DataFrame, target: str, k: int, cols: list[str] | None = None) -> DataFrame:
    """The k features with the largest absolute correlation."""
    strength = correlations(df, target, cols).select(
        "feature", F.abs(F.nanvl("correlation", F.lit(None))).alias("importance"))
    return strength.orderBy(F.col("importance").desc_nulls_last(), "feature").limit(k)
