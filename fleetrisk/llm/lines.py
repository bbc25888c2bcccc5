"""Line deduplication over levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetrisk.llm.common import digest, lines, lookup, lower_ascii, row_key, staged, stripped

KEY = ["_h1", "_h2"]


class LineRuns:
    """The line keys seen so far, each with the number of its documents, as sorted runs on levels.

    A run is a table of the shared warehouse, bucketed and sorted by the line hash, so that runs are merged and
    joined without shuffling them. Every batch adds a run to level 0; a level that has `fanout` runs is compacted
    into one run of the next, so a key is rewritten a logarithmic number of times.
    """

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name, self.levels, self.made = f"line_runs_{uuid.uuid4().hex}", {}, 0

    def _write(self, counts: DataFrame, level: int) -> None:
        self.made += 1
        name = f"{self.name}_{level}_{self.made}"
        counts.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        self.levels.setdefault(level, []).append(name)

    def _merged(self, names: list[str]) -> DataFrame:
        runs = None
        for name in names:
            run = self.spark.table(name)
            runs = run if runs is None else runs.unionByName(run)
        return runs.groupBy(*KEY).agg(F.sum("_docs").alias("_docs"), F.min("_first").alias("_first"))

    def names(self) -> list[str]:
        return [n for level in self.levels.values() for n in level]

    def add(self, batch: DataFrame) -> None:
        """Adds a batch with the columns _h1, _h2, _id: one row for each key of each document."""
        self._write(batch.groupBy(*KEY).agg(F.count("*").alias("_docs"), F.min("_id").alias("_first")), 0)
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            self.compact(level)
            level += 1

    def unseen(self, batch: DataFrame, min_docs: int = 1) -> DataFrame:
        """The rows of a batch whose key the runs have in fewer than min_docs documents: a merge anti-join."""
        return batch.join(self.frequent(min_docs).select(*KEY), KEY, "left_anti") if self.names() else batch

    def compact(self, level: int) -> None:
        """Merges the runs of a level into one run of the next and drops them."""
        old, self.levels[level] = self.levels[level], []
        self._write(self._merged(old), level + 1)
        for name in old:
            self.spark.sql(f"DROP TABLE {name}")

    def frequent(self, min_docs: int) -> DataFrame:
        """The keys found in min_docs documents or more."""
        return self._merged(self.names()).filter(F.col("_docs") >= min_docs)


def line_key(line: Column) -> Column:
    """What two lines must share to be equal: no white space at the ends, A-Z lower-cased."""
    return lower_ascii(stripped(line))


def _hashed(line: Column) -> Column:
    one, two = digest(line_key(line))
    return F.struct(one.alias("_h1"), two.alias("_h2"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1,
                keep_first: bool = False, batches: int = 4, fanout: int = 2) -> DataFrame:
    """docs with the lines removed whose key is found in min_docs documents or more, and n_lines, n_dropped.

    Every row is a document; a key counts once for each. Keys of fewer than min_chars code points always
    stay. With keep_first, the document of the smallest id that has a key keeps its lines (rows that share this id all
    do; a document without id does not). A null or empty text has one empty line; a text of which every line
    goes becomes empty. Columns named n_lines or n_dropped are replaced.

    The batches, dealt by a hash of the row, are added to the runs one by one. Then all lines are looked up in the frequent
    keys of the merged runs, as no batch alone tells which those are, by a shuffle join;
    keys that hold more than a thousandth of all lines are found by a broadcast table instead, see lookup().
    """
    spark = docs.sparkSession
    id_, text = F.col(id_col), F.col(text_col)
    long_enough = lambda line: F.char_length(line_key(line)) >= min_chars
    keys = F.array_distinct(F.transform(F.filter(lines(text), long_enough), _hashed))
    found = docs.select(*row_key(id_, text), id_.alias("_id"), F.explode(keys).alias("_key"))
    found = staged(found.select("_k1", "_k2", "_id", "_key.*"), "lines")
    runs = LineRuns(spark, fanout)
    for n in range(batches):
        runs.add(found.filter(F.pmod("_k1", F.lit(batches)) == n))
    frequent = staged(runs.frequent(min_docs), "frequent")
    goes = F.col("_docs").isNotNull()
    if keep_first:
        goes &= ~F.coalesce(F.col("_id") == F.col("_first"), F.lit(False))
    dropped = lookup(found, frequent, KEY, "_docs", "_k1", ["_docs", "_first"]).filter(goes)
    dropped = dropped.groupBy("_k1", "_k2").agg(F.collect_set(F.struct(*KEY)).alias("_dropped"))
    first, second = row_key(id_, text)
    out = docs.withColumns({"_k1": first, "_k2": second}).join(dropped, ["_k1", "_k2"], "left")
    kept = F.filter(lines(text), lambda line: ~F.array_contains("_dropped", _hashed(line)))
    out = out.withColumn("_kept", F.when(F.col("_dropped").isNotNull(), kept).otherwise(lines(text)))
    out = out.withColumns({
        "n_lines": F.size(lines(text)).cast("long"),
        "n_dropped": (F.size(lines(text)) - F.size("_kept")).cast("long"),
        text_col: F.array_join("_kept", "\n"),
    })
    return out.drop("_k1", "_k2", "_dropped", "_kept")
