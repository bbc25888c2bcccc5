"""Best-fit packing into sequences of several permitted lengths, planned on the counts of piece lengths."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.llm.common import digest, staged

#: Pieces of one length that are ranked together, about; so a length that many texts have is many keys.
RANKED = 1_000


class Plan:
    """Best-fit decreasing over counts: which bins the pieces of each length go to.

    Bins that are alike are one group (first, number, room left), so the plan's size depends on the permitted lengths
    only. Pieces come by falling length. Each goes to the bin with the least room that it fits into, which takes more of
    the same length while they fit. If no bin has room, a bin is opened of the size that costs least for each token that
    it can be expected to hold: its cost is `overhead` and its length, and what it holds is filled up from the
    shorter pieces as far as there are any. In the end a bin gets the smallest permitted length that holds its contents.
    """

    def __init__(self, counts: dict[int, int], lengths: list[int], overhead: int):
        self.lengths, self.overhead = sorted(lengths), overhead
        self.parts: list[tuple] = []  # length, first rank, bins, pieces a bin, first bin, first slot, first place
        self.room: dict[int, list] = {}  # room left: groups of first bin, bins, size, pieces a bin
        self.open_rooms: list[int] = []
        self.bins, self.rank = 0, 0
        order = sorted((n for n in counts if n > 0), reverse=True)
        shorter = np.cumsum([n * counts[n] for n in reversed(order)])[::-1].tolist() + [0]
        for i, n in enumerate(order):
            self._place(n, counts[n], shorter[i + 1])
        groups = sorted((g[0], g[2] - room) for room, gs in self.room.items() for g in gs)
        self.group_bins = [b for b, _ in groups]
        self.group_size = [self.lengths[bisect.bisect_left(self.lengths, used)] for _, used in groups]

    def _add(self, room: int, group: list) -> None:
        if room not in self.room:
            bisect.insort(self.open_rooms, room)
        self.room.setdefault(room, []).append(group)

    def _fill(self, n: int, groups: list, room: int, count: int) -> tuple[int, list]:
        """Puts up to count pieces into groups of this room; gives the pieces left and the groups that got none."""
        each, rest = room // n, []
        for first, bins, size, held in groups:
            whole = min(bins, count // each)
            if whole:
                self._put(n, whole, each, first, size, held, room)
            count, first, bins = count - whole * each, first + whole, bins - whole
            if bins and count:
                self._put(n, 1, count, first, size, held, room)
                count, first, bins = 0, first + 1, bins - 1
            if bins:
                rest.append([first, bins, size, held])
        return count, rest

    def _put(self, n: int, bins: int, each: int, first: int, size: int, held: int, room: int) -> None:
        self.parts.append((n, self.rank, bins, each, first, held, size - room))
        self.rank += bins * each
        self._add(room - each * n, [first, bins, size, held + each])

    def _place(self, n: int, count: int, shorter: int) -> None:
        self.rank = 0
        while count and (at := bisect.bisect_left(self.open_rooms, n)) < len(self.open_rooms):
            room = self.open_rooms.pop(at)
            count, rest = self._fill(n, self.room.pop(room), room, count)
            for group in rest:
                self._add(room, group)
        if count:
            def cost(size: int) -> float:
                bins = -(-count // (size // n))
                filled = count * n + min(shorter, bins * size - count * n)
                return bins * (size + self.overhead) / filled

            size = min((s for s in self.lengths if s >= n), key=lambda s: (cost(s), s))
            bins = -(-count // (size // n))
            first, self.bins = self.bins, self.bins + bins
            _, rest = self._fill(n, [[first, bins, size, 0]], size, count)
            for group in rest:
                self._add(size, group)


def pieces(docs: DataFrame, id_col: str, text_col: str, longest: int) -> DataFrame:
    """The pieces of each text: its id, the piece's number, its first token, and its tokens.

    The tokens are the words of the text and an end mark, at most `longest` for each piece; a text without
    a word, a null one too, is its end mark alone.
    """
    words = F.size(F.array_remove(F.split(F.coalesce(text_col, F.lit("")), r"[ \t-\r]+", -1), "")).cast("long")
    rows = docs.select(F.col(id_col).alias("_id"), *[k.alias(f"_k{i}") for i, k in enumerate(digest(F.col(id_col), F.col(text_col)), 1)],
                       (words + 1).alias("_tokens"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("_tokens") - 1, F.lit(longest).cast("long"))
    rows = rows.select("_id", "_k1", "_k2", "_tokens", F.posexplode(starts).alias("piece", "start"))
    return rows.withColumn("length", F.least(F.lit(longest).cast("long"), F.col("_tokens") - F.col("start"))).drop("_tokens")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: tuple[int, ...] = (512, 1024, 2048, 4096),
         overhead: int = 32) -> DataFrame:
    """A row for each piece of docs: id_col, piece, start, length, bin_id, capacity, slot, offset.

    Bins have a capacity among the permitted lengths, hold pieces one after the other from offset 0, and never more
    than they have room for. Texts longer than the longest are cut, and none of their tokens is lost. Pieces of
    the same length are interchangeable; they are taken in the order of a hash of id, text and piece, so repeated
    rows, ties and null ids are packed like any other. An empty table gives an empty one; other columns are not
    looked at.

    The driver gets one count for each piece length, at most as many as the longest permitted one; the pieces stay where
    they are and look up their bin by their rank among those of their length.
    """
    spark, longest = docs.sparkSession, max(lengths)
    rows = staged(pieces(docs, id_col, text_col, longest), "pieces")
    counts = {r[0]: r[1] for r in rows.groupBy("length").agg(F.count("*")).collect()}
    plan = Plan(counts, list(lengths), overhead)
    # The pieces of one length are ranked in parts, by a hash.
    parts = spark.createDataFrame([(n, -(-c // RANKED)) for n, c in counts.items()], "length long, _parts int")
    rows = rows.join(F.broadcast(parts), "length").withColumn("_part", F.expr("cast(pmod(xxhash64(_k1, piece), _parts) as int)"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    # One row for RANKED pieces or for a length, joined on the partitioning that the ranks need anyway.
    sizes = sizes.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("length", "_part").orderBy("_k1", "_k2", "piece"))
    rows = rows.withColumn("_place", place).join(sizes, ["length", "_part"])
    rows = rows.select(F.col("_id").alias(id_col), "piece", "start", "length", (F.col("_before") + F.col("_place") - 1).alias("_rank"))

    table = np.array(sorted(plan.parts), np.int64).reshape(-1, 7)
    first_bins, sizes_of = np.array(plan.group_bins, np.int64), np.array(plan.group_size, np.int64)
    shared = spark.sparkContext.broadcast((table, first_bins, sizes_of))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, first_bins, sizes_of = shared.value
        keys = table[:, 0] * (1 << 40) + table[:, 1]
        for batch in batches:
            length, rank = batch["length"].values, batch["_rank"].values
            part = table[np.searchsorted(keys, length * (1 << 40) + rank, side="right") - 1]
            within = rank - part[:, 1]
            nth, turn = within // part[:, 3], within % part[:, 3]
            bins = part[:, 4] + nth
            size = sizes_of[np.searchsorted(first_bins, bins, side="right") - 1]
            yield batch.drop(columns="_rank").assign(bin_id=bins, capacity=size, slot=part[:, 5] + turn, offset=part[:, 6] + turn * length)

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(placed, f"{id_col} {kind}, piece int, start long, length long, bin_id long, capacity long, slot long, offset long")


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row for each bin: its capacity, its tokens, and its pieces in order; a bin's capacity bounds them."""
    piece = F.struct("slot", F.col(id_col), "piece", "start", "length", "offset")
    return packed.groupBy("bin_id").agg(F.max("capacity").alias("capacity"), F.sum("length").alias("n_tokens"),
                                        F.sort_array(F.collect_list(piece)).alias("pieces"))
