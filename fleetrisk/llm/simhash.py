"""SimHash near-duplicates: fingerprints, and a grid range join of their segments' bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetrisk.llm.common import lookup, row_key, staged
from fleetrisk.llm.components import components

SEED = 42
#: Shingles whose bits are counted at once.
_CHUNK = 50_000


def fingerprint(text: str | None, shingle_words: int) -> int:
    """The SimHash of the shingles' XXH64, repeats included; zero for a text without a word."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = max(1, len(found) - shingle_words + 1) if found else 0
    if n == 0:
        return 0
    whole, ends = b" ".join(found), np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1).tolist()
    size, last, ones = min(shingle_words, len(found)) - 1, xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array([last(whole[starts[i]:ends[i + size]], SEED) for i in range(at, min(n, at + _CHUNK))], ">u8")
        ones += _ones(hashes)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the highest first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint_of(hashes: np.ndarray) -> int:
    """The fingerprint of a text whose shingles have these XXH64, repeats included."""
    parts = [_ones(hashes[at:at + _CHUNK]) for at in range(0, len(hashes), _CHUNK)]
    return int.from_bytes(np.packbits(2 * sum(parts) > len(hashes)).tobytes(), "big") if parts else 0


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def with_fingerprints(docs: DataFrame, text_col: str, shingle_words: int) -> DataFrame:
    """docs with _fp, the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_signed(fingerprint(t, shingle_words)) for t in texts], dtype="int64")

    return docs.withColumn("_fp", fp(F.col(text_col)))


def _segment_counts(half: Column) -> Column:
    """The bit counts (0 to 2) of the 16 two-bit segments of a 32-bit half, packed two bits each."""
    return half - F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555))


def grid_cells(fps: DataFrame) -> DataFrame:
    """The grid cells of each distinct fingerprint: _fp, _cell.

    Two fingerprints of Hamming distance 4 or less have a half in which it is 2 or less, and there the
    Manhattan distance of their segments' bit counts is no larger. Vectors of whole numbers within 2 have a third within 1
    of both; so a vector is put into its own cell and those one step away, and such a pair meets in a cell.
    """
    cells = None
    for half in (0, 1):
        bits = F.shiftrightunsigned("_fp", 32) if half else F.col("_fp").bitwiseAND(F.lit(0xFFFFFFFF))
        counts = fps.select("_fp", F.lit(half).alias("_half"), _segment_counts(bits).alias("_cell"))
        ways = []
        for j in range(16):
            held = F.shiftright("_cell", 2 * j).bitwiseAND(F.lit(3))
            ways += [F.when(held < 2, F.col("_cell") + F.lit(1 << (2 * j))), F.when(held > 0, F.col("_cell") - F.lit(1 << (2 * j)))]
        out = counts.select("_fp", "_half", F.explode(F.array_compact(F.array("_cell", *ways))).alias("_cell"))
        cells = out if cells is None else cells.unionByName(out)
    return cells.select("_fp", F.col("_cell").bitwiseOR(F.shiftleft(F.col("_half").cast("long"), 32)).alias("_cell"))


def _close(members: np.ndarray, bits: int) -> tuple[list, list]:
    """For each of the distinct fingerprints of a cell that has a closer one: it, and the first of those it is linked to.

    A breadth-first walk that only ever compares with members not yet reached: a dense cell is reached in
    a few steps, whatever its number of pairs, and one edge for each member reached is enough.
    """
    left, nodes, others = members, [], []
    while len(left) > 1:
        first, left, front = left[0], left[1:], [left[0]]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= bits
            reached, left = left[near], left[~near]
            front.extend(reached)
            nodes.append(reached)
            others.append(np.full(len(reached), first))
    return nodes, others


def links(fps: DataFrame, bits: int = 4, block: int = 20_000) -> DataFrame:
    """Edges (node, other) that connect the distinct fingerprints _fp as all pairs within `bits` (4 at most) would.

    A cell of more than `block` fingerprints is cut into parts by their hash, and each two of its parts are
    compared in a task of their own: all pairs are still looked at, in bounded tasks.
    """
    cells = staged(grid_cells(fps), "cells")
    sizes = cells.groupBy("_cell").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    parts = F.ceil(F.col("_n") / block).cast("int")
    full = staged(sizes.filter(F.col("_n") > block).select("_cell", "_n", parts.alias("_parts")), "full_cells")
    if full.isEmpty():
        dealt = cells.withColumn("_part", F.lit(0).cast("long"))
    else:
        dealt = lookup(cells, full, ["_cell"], "_n", "_fp", ["_parts"])
        own = F.expr("pmod(xxhash64(_fp), _parts)")
        pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_parts") - F.lit(1).cast("long")),
                           lambda p: F.least(p, own) * F.col("_parts") + F.greatest(p, own))
        dealt = dealt.select("_cell", "_fp", F.explode(F.coalesce(pair, F.array(F.lit(0).cast("long")))).alias("_part"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "_cell", "_part").sortWithinPartitions("_cell", "_part", "_fp")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            done, rest = _whole_groups(rest)
            if len(done):
                yield _edges(done, bits)
        if rest is not None and len(rest):
            yield _edges(rest, bits)

    return dealt.select("_cell", "_part", "_fp").mapInPandas(compare, "node long, other long").distinct()


def _whole_groups(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The rows of groups that have ended, and those of the last group, which the next batch may continue."""
    at = np.flatnonzero((rows["_cell"].values[1:] != rows["_cell"].values[:-1])
                        | (rows["_part"].values[1:] != rows["_part"].values[:-1]))
    cut = int(at[-1]) + 1 if len(at) else 0
    return rows.iloc[:cut], rows.iloc[cut:]


def _edges(rows: pd.DataFrame, bits: int) -> pd.DataFrame:
    cell, part, fp = (rows[c].values for c in ("_cell", "_part", "_fp"))
    starts = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]))))
    sizes = np.diff(np.append(starts, len(fp)))
    word = fp.view(np.uint64)
    nodes, others = [], []
    # Groups of up to 8 members are compared all at once, by the distance of their places.
    group = np.repeat(np.arange(len(starts)), sizes)
    small = sizes[group] <= 8
    for d in range(1, 8):
        near = small[d:] & (group[d:] == group[:-d])
        near &= np.bitwise_count(word[d:] ^ word[:-d]) <= bits
        nodes.append(word[d:][near])
        others.append(word[:-d][near])
    for at, size in zip(starts[sizes > 8], sizes[sizes > 8]):
        a, b = _close(word[at:at + size], bits)
        nodes += a
        others += b
    nodes, others = np.concatenate(nodes).view(np.int64), np.concatenate(others).view(np.int64)
    return pd.DataFrame({"node": nodes, "other": others}).drop_duplicates()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                    bits: int = 4) -> DataFrame:
    """One row for each of docs: _k1, _k2, id_col, fingerprint, component_id, and _root, which names the component.

    Texts are linked whose fingerprints differ in at most `bits` (4 or fewer) bits; component_id is the smallest id
    reachable over links, the own one included. A text without a word, a null one too, has fingerprint zero and is linked
    like any other. Null ids never are the smallest: a component without ids has a null component_id.
    Equal fingerprints are joined before the search, so exact copies cost nothing more there, however many they are.
    """
    rows = docs.select(*row_key(F.col(id_col), F.col(text_col)), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = staged(with_fingerprints(rows, "_text", shingle_words).select("_k1", "_k2", "_id", "_fp"), "fingerprints")
    fps = staged(rows.groupBy("_fp").agg(F.min("_id").alias("_least"), F.count("*").alias("_copies")), "distinct")
    linked = components(links(fps.select("_fp"), bits)).select(F.col("node").alias("_fp"), "root")
    rooted = staged(fps.join(linked, "_fp", "left").withColumn("root", F.coalesce("root", "_fp")), "rooted")
    least = rooted.groupBy("root").agg(F.min("_least").alias("_component"), F.count("*").alias("_fps"))
    known = lookup(rooted, least, ["root"], "_fps", "_fp", ["_component"])
    found = lookup(rows, staged(known, "known"), ["_fp"], "_copies", "_k1", ["_component", "root"])
    return found.select("_k1", "_k2", F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
                        F.col("_component").alias("component_id"), F.col("root").alias("_root"))
