"""Shared pieces of the operators: reading tables, staging, text columns and joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetrisk.session import scratch_path

#: At most this many keys can each hold more than 1/HOT_KEYS of the rows, so a table of them may be broadcast.
HOT_KEYS = 1000

#: The fewest and most bits of a sieve: 128 KB, and 16 MB whatever the number of keys.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27

#: The white space of the text operators: space and the control characters tab to carriage return.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: later jobs start from the files, whoever is lost meanwhile."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def stripped(text: Column) -> Column:
    """text without white space at both ends."""
    return F.trim(text, F.lit(SPACES))


def lines(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def words(text: Column) -> Column:
    """The words of a text: runs of anything but white space."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+", -1), "")


def digest(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes; nulls are hashed as such, also between columns."""
    parts = [x for c in cols for x in (c, c.isNull())]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def row_key(*cols: Column) -> list[Column]:
    """The columns _k1, _k2 that name a row by its content: equal rows share them and have equal results."""
    return [c.alias(f"_k{i}") for i, c in enumerate(digest(*cols), 1)]


def lookup(left: DataFrame, right: DataFrame, on: list[str], copies: str, spread: str, values: list[str]) -> DataFrame:
    """left with the columns values of right, null where no key matches.

    right has each key once, and in `copies` the rows that left has of it. Keys that hold more than one in HOT_KEYS
    of all rows are looked up in a broadcast table, of which the size is bounded by that definition; the rows
    found there are dealt out by the hash of `spread` in the join of all other keys, so no task gets them all.
    The first column of on is a long without nulls.
    """
    total = right.agg(F.sum(copies)).first()[0] or 0
    is_hot = F.col(copies) > total // HOT_KEYS
    found = F.struct(*values)
    hot = right.filter(is_hot).select(*on, found.alias("_hot"))
    cold = right.filter(~is_hot).select(*[F.col(c).alias(f"_on{i}") for i, c in enumerate(on)], found.alias("_cold"))
    dealt = left.join(F.broadcast(hot), on, "left")
    keys = [F.when(F.col("_hot").isNull(), F.col(on[0])).otherwise(F.xxhash64(spread)), *map(F.col, on[1:])]
    dealt = dealt.withColumns({f"_on{i}": k for i, k in enumerate(keys)})
    out = dealt.join(cold, [f"_on{i}" for i in range(len(on))], "left")
    value = F.coalesce("_hot", "_cold")
    return out.select(*left.columns, *[value[v].alias(v) for v in values])


def sieve(keys: DataFrame, column: str) -> Callable[[str], Column]:
    """A test of a column of hashes (long, no nulls) that is false only for those that keys has not.

    It is a map of bits of a bounded size. One that is full lets more through, so an exact join has to follow; it only
    spares that join's shuffle the rows that cannot match.
    """
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * keys.count()).bit_length()))
    word = F.shiftright(F.col(column).bitwiseAND(F.lit(size - 1)), 6)
    bit = F.expr(f"shiftleft(1L, cast(`{column}` & 63L AS int))")
    found = keys.select(word.alias("word"), bit.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(size >> 6, np.uint64)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    shared = keys.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        at = hashes.to_numpy(np.int64) & (size - 1)
        return pd.Series((shared.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)) == 1)

    return maybe
