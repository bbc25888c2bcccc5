"""Structured Streaming over readings; the columns are those of the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetrisk.functions import fixed
from fleetrisk.functions.numbers import count_if, finite_columns
from fleetrisk.operators.scoring import advise, scoring_features

LATENESS = "1 hour"


def read_stream(spark: SparkSession, folder: str, schema, pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream; NaN and infinities are read as null."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return finite_columns(reader.parquet(folder))


def with_event_time(df: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Event time as a zoned timestamp (watermarks reject the other kind), with a lateness bound."""
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)


def live_risk(df: DataFrame) -> DataFrame:
    """Stateless: scoring columns, level and advice of readings that carry a probability."""
    return advise(scoring_features(df))


def _violation_counts() -> list[Column]:
    return [count_if(F.col(c) > edge if side == "high" else F.col(c) < edge).alias(f"{c}_{side}_violations")
            for c, side, edge in fixed.VIOLATION_LIMITS]


def _windowed(df: DataFrame, *window, lateness: str = LATENESS) -> DataFrame:
    out = with_event_time(df, lateness).groupBy(F.window("ts", *window), "vehicle_id").agg(
        F.count(F.lit(1)).alias("n_readings"),
        *[F.avg(c).alias(f"{c}_mean") for c in fixed.CRITICAL_INPUTS], *_violation_counts())
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      *[c for c in out.columns if c != "window"])


def live_daily(df: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Means and violations per vehicle and day; a day is emitted once no more of it can arrive in time."""
    return _windowed(df, "1 day", lateness=lateness)


def live_sliding(df: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The same over seven days, every day."""
    return _windowed(df, "7 days", "1 day", lateness=lateness)


def live_dedup(df: DataFrame, key: str = "event_id", lateness: str = LATENESS) -> DataFrame:
    """First arrival of each reading; the state of a key is dropped after the lateness bound."""
    return with_event_time(df, lateness).dropDuplicatesWithinWatermark([key])


def run_to_files(df: DataFrame, path: str, state: str, mode: str = "append") -> StreamingQuery:
    """Everything available now into parquet files, exactly once (the file sink keeps a log)."""
    query = (df.writeStream.format("parquet").outputMode(mode).option("path", path)
             .option("checkpointLocation", state).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def run_marts(df: DataFrame, state: str, refresh: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Calls ``refresh(batch, number)`` per micro-batch; a batch may come again after a failure."""
    query = (df.writeStream.foreachBatch(refresh).option("checkpointLocation", state)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def dropped_rows(query: StreamingQuery) -> int:
    """What the query's stateful operators left out as too late; rows that were combined before count as one."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"])


# -- incremental fleet summary -------------------------------------------------------------------------

#: Moments of the probabilities are kept as number, sum and sum of squared distances from the mean, which lose no
#: digits where probabilities are nearly equal.
_STATE = ["alerts", "n", "n_p", "sum_p", "m2_p", "max_p", "min_p"]


def partial_summary(batch: DataFrame) -> DataFrame:
    """State of the fleet summary of one batch, a row for each vehicle; ``merge_states`` adds two of them."""
    p = F.col("probability")
    return batch.groupBy("vehicle_id").agg(
        F.coalesce(F.sum("prediction"), F.lit(0)).alias("alerts"), F.count("prediction").alias("n"), F.count(p).alias("n_p"),
        F.coalesce(F.sum(p), F.lit(0.0)).alias("sum_p"), F.coalesce(F.var_pop(p) * F.count(p), F.lit(0.0)).alias("m2_p"),
        F.max(p).alias("max_p"), F.min(p).alias("min_p"))


def merge_states(old: DataFrame, new: DataFrame) -> DataFrame:
    """The state of both; each has one row for a vehicle, null being one too."""
    a, b = (df.select(F.struct("vehicle_id", *_STATE).alias(name)) for df, name in ((old, "a"), (new, "b")))
    both = a.join(b, F.col("a.vehicle_id").eqNullSafe(F.col("b.vehicle_id")), "full")

    def of(side: str, c: str, default) -> Column:
        return F.coalesce(F.col(f"{side}.{c}"), F.lit(default))

    n_a, n_b = of("a", "n_p", 0), of("b", "n_p", 0)
    apart = F.try_divide(of("b", "sum_p", 0.0), n_b) - F.try_divide(of("a", "sum_p", 0.0), n_a)
    between = F.coalesce(apart * apart * F.try_divide(n_a.cast("double") * n_b, n_a + n_b), F.lit(0.0))
    return both.select(
        F.when(F.col("a").isNull(), F.col("b.vehicle_id")).otherwise(F.col("a.vehicle_id")).alias("vehicle_id"),
        *[(of("a", c, 0) + of("b", c, 0)).alias(c) for c in ("alerts", "n", "n_p")],
        (of("a", "sum_p", 0.0) + of("b", "sum_p", 0.0)).alias("sum_p"),
        (of("a", "m2_p", 0.0) + of("b", "m2_p", 0.0) + between).alias("m2_p"),
        F.greatest("a.max_p", "b.max_p").alias("max_p"), F.least("a.min_p", "b.min_p").alias("min_p"))


def summary_of_state(state: DataFrame) -> DataFrame:
    """The fleet summary that a state stands for."""
    return state.select(
        "vehicle_id", F.when(F.col("n") > 0, F.col("alerts")).alias("maintenance_alerts"), F.col("n").alias("total_readings"),
        F.try_divide(F.col("alerts").cast("double"), F.col("n")).alias("alert_rate"), F.try_divide(F.col("sum_p"), F.col("n_p")).alias("avg_risk_score"),
        F.col("max_p").alias("max_risk_score"), F.col("min_p").alias("min_risk_score"),
        F.when(F.col("n_p") > 1, F.sqrt(F.col("m2_p") / (F.col("n_p") - 1))).alias("risk_score_std"))


class SummaryTable:
    """The summary's state as one parquet table for each batch number: the state after that batch.

    A batch reads the state before it and writes its own, so one that is repeated after a failure replaces itself, and
    a batch costs the vehicles, not the batches before it. Only the last ``keep`` states stay.
    """

    def __init__(self, folder: str, keep: int = 2):
        self.folder, self.keep = folder.rstrip("/"), max(2, keep)

    def refresh(self, batch: DataFrame, number: int) -> None:
        """For ``foreachBatch``."""
        spark = batch.sparkSession
        state = partial_summary(batch)
        before = [v for v in self.versions(spark) if v < number]
        if before:
            state = merge_states(self._state(spark, before[-1]), state)
        state.write.mode("overwrite").parquet(self._path(number))
        for old in before[:-(self.keep - 1)]:
            path, fs = self._file(spark, self._path(old))
            fs.delete(path, True)

    def versions(self, spark: SparkSession) -> list[int]:
        """The numbers of the states that were written to their end."""
        path, fs = self._file(spark, self.folder)
        if not fs.exists(path):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        found = [int(n.removeprefix("after=")) for n in names if n.startswith("after=")]
        return sorted(v for v in found if fs.exists(self._file(spark, f"{self._path(v)}/_SUCCESS")[0]))

    def summary(self, spark: SparkSession) -> DataFrame:
        """The fleet summary after the last batch."""
        versions = self.versions(spark)
        if not versions:
            raise ValueError("no batch was folded in yet")
        return summary_of_state(self._state(spark, versions[-1]))

    def _path(self, number: int) -> str:
        return f"{self.folder}/after={number}"

    def _state(self, spark: SparkSession, number: int) -> DataFrame:
        return spark.read.parquet(self._path(number))

    @staticmethod
    def _file(spark: SparkSession, name: str) -> tuple:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(spark._jsc.hadoopConfiguration())
