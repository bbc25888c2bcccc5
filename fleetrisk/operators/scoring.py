"""Scoring of readings, batch or stream: validate, derive, predict, advise."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetrisk.functions import fixed, readings
from fleetrisk.operators.models import predict
from fleetrisk.operators.quality import split_valid

SCORING_COLUMNS = fixed.SCORING_COLUMNS


def scoring_features(df: DataFrame) -> DataFrame:
    """df with the derived scoring columns."""
    new = {n: e for n, e in readings.scoring_columns().items() if n not in df.columns}
    return df.select("*", *[e.alias(n) for n, e in new.items()])


def advise(df: DataFrame) -> DataFrame:
    """Risk level, action, confidence and certainty from ``probability``."""
    p = F.col("probability")
    level = readings.risk_level(p)
    return df.select("*", level.alias("risk_level"), readings.recommended_action(level).alias("recommended_action"),
                     readings.confidence(p).alias("confidence"), readings.certainty(p).alias("certainty"))


def score(df: DataFrame, model: PipelineModel, required=("vehicle_id", *fixed.SCORING_INPUTS)) -> tuple[DataFrame, DataFrame]:
    """(scored rows, rejected rows with their errors); a bad row never stops the rest."""
    good, bad = split_valid(df, list(required))
    return advise(predict(model, scoring_features(good))), bad
