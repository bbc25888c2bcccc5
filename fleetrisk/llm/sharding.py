"""Sharding by sampled splitters: ranges of a key that hold about equal weights."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.llm.common import staged

#: Sampled keys for each range.
DRAWS = 16


def hex_key(x: Column) -> Column:
    """A long as 16 hexadecimal digits of the same order; null first of all."""
    return F.coalesce(F.lpad(F.hex(x.cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0"), F.lit(""))


def range_of(key: Column, bounds: list[str]) -> Column:
    """The number of bounds that are not above the key."""
    at = np.array([b.encode() for b in bounds], dtype="S")

    @F.pandas_udf("int")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            values = np.array([k.encode() for k in keys], dtype="S")
            yield pd.Series(np.searchsorted(at, values, side="right") if len(at) and len(values) else
                            np.zeros(len(keys), np.int64), dtype="int32")

    return found(key)


def _draw(rows: DataFrame, draws: int, total: int) -> list[tuple[str, int]]:
    """About `draws` keys, each as often as its weight deserves; the same for the same rows."""
    due = F.col("_weight") * (draws / total)
    chance = F.shiftrightunsigned(F.xxhash64("_key", F.lit("draw")), 11) / float(2**53)
    times = (F.floor(due) + (chance < due - F.floor(due)).cast("long")).alias("times")
    return [(r[0], r[1]) for r in rows.select("_key", times).filter(F.col("times") > 0).collect()]


def _quantiles(drawn: list[tuple[str, int]], parts: int) -> list[str]:
    drawn = sorted(drawn)
    at = np.cumsum([t for _, t in drawn])
    picks = np.searchsorted(at, np.arange(1, parts) * at[-1] / parts) if len(at) else []
    return sorted({drawn[i][0] for i in picks})


def range_stats(rows: DataFrame, bounds: list[str]) -> dict[int, tuple]:
    """Weight, rows, and whether there are several keys, for each range that has rows."""
    stats = rows.groupBy(range_of(F.col("_key"), bounds).alias("r")).agg(
        F.sum("_weight"), F.count("*"), F.min("_key") < F.max("_key"))
    return {r[0]: (r[1], r[2], r[3]) for r in stats.collect()}


def splitters(rows: DataFrame, ranges: int, total: int, rounds: int = 4) -> tuple[list[str], dict[int, tuple]]:
    """Keys that cut rows (_key, _weight) into about `ranges` ranges of equal weight, and the ranges' statistics.

    A weighted sample gives the quantiles. Ranges that turn out to hold more than twice their share are sampled
    again by themselves and subdivided, until none is left or it has a single key. The driver gets DRAWS keys for
    each range, which is a setting, not the number of rows.
    """
    bounds = _quantiles(_draw(rows, DRAWS * ranges, total), ranges) if total else []
    for _ in range(rounds):
        stats = range_stats(rows, bounds)
        over = {r: w for r, (w, _, several) in stats.items() if several and w > 2 * total / ranges}
        if not over:
            return bounds, stats
        inside = rows.withColumn("_range", range_of(F.col("_key"), bounds)).filter(F.col("_range").isin(*over))
        weight = sum(over.values())
        parts = -(-weight * ranges // total)
        # The keys of other ranges sort apart from these, so one pass of quantiles serves all of them.
        more = _quantiles(_draw(inside, int(4 * DRAWS * parts), weight), int(2 * parts))
        if set(more) <= set(bounds):
            break
        bounds = sorted({*bounds, *more})
    return bounds, range_stats(rows, bounds)


def shard(docs: DataFrame, shards: int, size: Column, group: Column, order: Column, split_share: float = 0.01,
          range_bytes: int = 1 << 30, least_ranges: int = 1024) -> DataFrame:
    """docs with shard (0 to shards - 1) and slot (gapless from 0 in each shard), shards nearly equal in size.

    Records are ordered by the long `group` and then by the long `order`, and cut where the sizes before a record, and
    half its own, reach a shard's share. A group stays in one shard unless it is larger than split_share of
    a shard: then the cut goes through it, since a third of all records may be of one group. Records that agree in
    both longs are interchangeable; their slots may be dealt in any way. Sizes are 0 or more; a null size counts as 0, null
    longs come first. An empty table gives an empty one. Columns named shard and slot are replaced.

    Ranges of about range_bytes are found by sampled splitters, so each task sorts a bounded part.
    """
    key = F.concat(hex_key(group), hex_key(order))
    weight = F.coalesce(size.cast("long"), F.lit(0).cast("long"))
    rows = staged(docs.select(key.alias("_key"), weight.alias("_weight")), "keys")
    total = rows.agg(F.sum("_weight")).first()[0] or 0
    bounds, stats = splitters(rows, max(least_ranges, total // range_bytes), total)
    cuts = _shard_cuts(rows, bounds, stats, shards, total, split_share)
    bounds = sorted({*bounds, *cuts})
    stats, places, before = range_stats(rows, bounds), [], dict.fromkeys(range(shards), 0)
    for r in sorted(stats):
        own = int(np.searchsorted(cuts, bounds[r - 1], side="right")) if r else 0
        places.append((r, own, before[own]))
        before[own] += stats[r][1]
    # One row for each range, of which there are a set number.
    places = docs.sparkSession.createDataFrame(places, "_range int, shard int, _before long")
    out = docs.withColumn("_key", key).drop("shard", "slot").withColumn("_range", range_of(F.col("_key"), bounds))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    out = out.withColumn("_place", place).join(F.broadcast(places), "_range")
    return out.withColumn("slot", F.col("_before") + F.col("_place") - 1).drop("_key", "_range", "_place", "_before")


def _shard_cuts(rows: DataFrame, bounds: list[str], stats: dict, shards: int, total: int, split_share: float) -> list[str]:
    """The keys at which the shards after the first begin."""
    starts, at = {}, 0
    for r in sorted(stats):
        starts[r], at = at, at + stats[r][0]
    wanted = [k * total / shards for k in range(1, shards)]
    if not total:
        return []
    # A cut may fall behind the middle of a range's last record; then the next range begins with it.
    near = [r for r, s in starts.items() if any(s <= w <= s + stats[r][0] for w in wanted)]
    cut_in = {x for r in near for x in (r, min((y for y in starts if y > r), default=r))}
    before = F.create_map(*[F.lit(x) for r in cut_in for x in (r, starts[r])])
    inside = rows.withColumn("_range", range_of(F.col("_key"), bounds)).filter(F.col("_range").isin(*cut_in))
    running = F.sum("_weight").over(Window.partitionBy("_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0))
    middle = before[F.col("_range")] + running - F.col("_weight") / 2
    inside = inside.select("_key", middle.alias("_middle"))
    firsts = inside.agg(*[F.min(F.when(F.col("_middle") >= w, F.col("_key"))).alias(f"c{i}") for i, w in enumerate(wanted)]).first()
    cuts = [c for c in firsts if c is not None]
    groups = rows.filter(F.substring("_key", 1, 16).isin(*{c[:16] for c in cuts})).groupBy(
        F.substring("_key", 1, 16).alias("g")).agg(F.sum("_weight")).collect()
    whole = {g for g, w in groups if w <= split_share * total / shards}
    return sorted({c[:16] if c[:16] in whole else c for c in cuts})
