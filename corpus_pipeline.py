"""The corpus pipeline: stages over documents, each on what the one before has kept, and the text operators' queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetrisk.llm.common import lookup, row_key, sieve, staged, table
from fleetrisk.llm.decontaminate import without_contamination
from fleetrisk.llm.lines import dedup_lines
from fleetrisk.llm.packing import pack, sequences
from fleetrisk.llm.queries import QUERIES, SQL, held_out
from fleetrisk.llm.shingles import near_copies
from fleetrisk.llm.toxicity import toxicity, train


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of 0.7 or more go; the model is that of op10_toxicity."""
    model = train(docs, table(spark, sf_dir, "labels").filter(~held_out("doc_id")))
    return docs.filter(toxicity(F.col("text"), model) < 0.7)


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more stay in the first one only; documents left without any text go.

    A document that was empty before stays; n_chars follows the text.
    """
    out = dedup_lines(docs, keep_first=True)
    emptied = (F.col("n_dropped") > 0) & (F.trim(F.col("text"), F.lit(" \t\n\x0b\f\r")) == "")
    out = out.filter(~emptied).withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles; fingerprints within 4 bits, or Jaccard similarity 0.8) the document of the smallest id stays.

    Null ids come last, repeated rows count once.
    """
    found = staged(near_copies(docs), "near_copies")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_k1", "_k2")).alias("_first")
    groups = staged(found.groupBy("_root").agg(first, F.count("*").alias("_rows")), "near_groups")
    # Documents that are alone in their group stay where they are; only the others are shuffled.
    crowded = lookup(found, groups, ["_root"], "_rows", "_k1", ["_rows"]).filter("_rows > 1")
    maybe = sieve(staged(crowded.select("_k1"), "crowded"), "_k1")
    kept = groups.select("_first._k1", "_first._k2").filter(maybe("_k1"))
    one, two = row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.withColumns({"_k1": one, "_k2": two})
    rest = keyed.filter(maybe("_k1")).join(kept, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
    return keyed.filter(~maybe("_k1")).unionByName(rest).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a benchmark item, with up to a tenth of its characters edited."""
    return without_contamination(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: bin_id, capacity, n_tokens, and the pieces of documents in order."""
    return sequences(pack(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_frequent_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", packed),
]

#: The stages use a fitted model and fingerprints that SQL has no function for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each writes to the shared folder what the next one reads."""
    def step(docs: DataFrame, stage: tuple) -> DataFrame:
        return staged(stage[1](spark, docs, sf_dir), stage[0])

    return reduce(step, STAGES, table(spark, sf_dir, "documents"))


QUERIES = QUERIES | {"pipeline": run}
