"""Token counts through a cache keyed by the digests of the content and of the tokenizer."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetrisk.llm.common import lookup, staged

#: Characters that are encoded at once.
PORTION = 500_000
_CACHE = "tokenizer string, _h long, _digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Names a tokenizer by its file and by the version of the library that reads it."""
    import tokenizers

    return hashlib.sha256(Path(path).read_bytes() + tokenizers.__version__.encode()).hexdigest()


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """One tokenizer for each worker process, without threads of its own: Spark's tasks share out the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Counter:
    """Counts the tokens of whole texts with the tokenizers library, without begin or end tokens."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)

    def __call__(self, texts: list[str]) -> list[int]:
        """The counts; about PORTION characters are encoded at a time."""
        counts, portion, size = [], [], 0
        for text in texts:
            portion.append(text)
            size += len(text)
            if size > PORTION:
                counts += self._portion(portion)
                portion, size = [], 0
        return counts + self._portion(portion)

    def _portion(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class TokenCache:
    """Counts kept as files of (tokenizer, digest, count) in a shared folder; every run appends its misses."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, tokenizer: str) -> DataFrame:
        """The counts of a tokenizer, each digest once, also if two runs have added it."""
        try:
            rows = self.spark.read.schema(_CACHE).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = self.spark.createDataFrame([], _CACHE)
        rows = rows.filter(F.col("tokenizer") == tokenizer)
        return rows.groupBy("_h", "_digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, tokenizer: str) -> None:
        rows = counts.select(F.lit(tokenizer).alias("tokenizer"), "_h", "_digest", "n_tokens")
        rows.write.mode("append").partitionBy("tokenizer").parquet(self.path)


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, text_col: str = "text") -> DataFrame:
    """docs with n_tokens, the tokens of each whole text; a null text counts as empty.

    The content is normalised as far as no count can change: null becomes empty. Distinct texts whose SHA-256 the cache
    does not have for this tokenizer (its file and the library's version) are encoded once and appended to the cache.
    Copies are combined before the shuffle, so a text may hold any share of the rows. A column n_tokens is
    replaced. The tokenizer's file must be readable under the same path on every executor.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.unhex(F.sha2(text, 256))
    own = tokenizer_digest(tokenizer_path)
    cache = TokenCache(docs.sparkSession, cache_path)
    keyed = docs.select(F.xxhash64(key).alias("_h"), key.alias("_digest"), text.alias("_text"))
    distinct = keyed.groupBy("_h", "_digest").agg(F.first("_text").alias("_text"))
    misses = distinct.join(cache.read(own).select("_h", "_digest"), ["_h", "_digest"], "left_anti")

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = Counter(tokenizer_path)
        for texts in batches:
            yield pd.Series(count(texts.tolist()), dtype="int64")

    cache.append(misses.select("_h", "_digest", tokens("_text").alias("n_tokens")), own)
    copies = keyed.groupBy("_h", "_digest").agg(F.count("*").alias("_copies"))
    counts = staged(copies.join(cache.read(own), ["_h", "_digest"]), "counts")
    rows = docs.drop("n_tokens").withColumns({"_h": F.xxhash64(key), "_digest": key})
    found = lookup(rows.withColumn("_deal", F.monotonically_increasing_id()), counts, ["_h", "_digest"], "_copies", "_deal",
                   ["n_tokens"])
    return found.drop("_h", "_digest", "_deal")
