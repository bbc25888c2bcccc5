"""Cutting an ordered table into even pieces, whatever the distribution of its keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetrisk.session import lineage_cut

# monotonically_increasing_id() keeps the partition in the high bits and the row in the low 33.
_ROW_BITS = 33


def cut_by_order(df: DataFrame, order: list, pieces: int) -> DataFrame:
    """df in ``pieces`` ordered pieces of even size, with columns ``_piece`` and ``_slot``.

    The range exchange samples the keys, so one hot key is spread over as many pieces as its rows
    need; ``_copy`` is the last sort key and lets even equal rows be parted. The result is written
    out once, so the piece numbers stay the same for every later use and after lost executors.
    """
    marked = df.withColumn("_copy", F.monotonically_increasing_id())
    keys = [*order, F.col("_copy")]
    placed = (
        marked.repartitionByRange(max(int(pieces), 1), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
        .select(
            *df.columns,
            F.shiftright("_id", _ROW_BITS).cast("int").alias("_piece"),
            F.col("_id").bitwiseAND(F.lit(2 ** _ROW_BITS - 1).cast("bigint")).alias("_slot"),
        )
    )
    return lineage_cut(placed)
