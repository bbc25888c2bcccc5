"""Session settings and the shared folder that lineage cuts are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "fleetrisk", **conf) -> SparkSession:
    """A session with the settings this library expects; a cluster keeps its own sizing."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Call sites of every Column call are of no use here and double the planning time of wide tables.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the cluster's own if it names one, a scratch folder only in local mode."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="fleetrisk-"))
        current = sc.getCheckpointDir()
    return named or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/fleetrisk/{uuid.uuid4().hex}/{name}"


def lineage_cut(df):
    """Materialise df in the checkpoint folder and go on from the written copy."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df, name: str):
    """df written to the shared folder as compressed parquet and read back; rows of a file stay in their order."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
