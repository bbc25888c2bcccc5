"""Hard negatives by exact maximum inner product search over an inverted multi-index of two half-space codebooks."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.llm.common import digest, lookup, staged

#: Vectors that the codebooks are fitted on, at most; every vector is indexed.
SAMPLE = 20_000
#: Rows that a cell has on average, until the codebooks have MOST_CENTROIDS each.
CELL_ROWS, MOST_CENTROIDS = 256, 1024
#: Rows and queries of one cell that are compared at once, and how many such blocks of queries share a copy of the rows.
BLOCK_ROWS, BLOCK_QUERIES, TURN = 1024, 256, 16
#: Rows that a query's first cells hold; a query that has no threshold by then goes on with GROWTH times as many.
FIRST_ROWS, GROWTH = 2_000, 16

_PLAN = "_h1 long, _h2 long, label int, x array<long>, limits array<long>, tau long, cells array<int>, seen int, done boolean"


def codebook(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k centroids by Lloyd's steps from a fixed draw; one that loses all rows stays where it is."""
    at = np.random.default_rng(0).permutation(len(x))[:k]
    centroids = x[np.sort(at)]
    for _ in range(rounds):
        near = nearest(x, centroids)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row, in blocks of rows."""
    half = (centroids**2).sum(axis=1) / 2
    parts = [np.argmin(half - x[i:i + 8192] @ centroids.T, axis=1) for i in range(0, len(x), 8192)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly: in doubles while they hold them, else in Python's numbers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if a.shape[1] * max(1, int(np.abs(a).max())) * max(1, int(np.abs(b).max())) < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


class MultiIndex:
    """The codebooks of both halves, the radius of each centroid over all its rows, and the rows of each cell."""

    def __init__(self, centroids: list[np.ndarray], radii: list[np.ndarray], sizes: np.ndarray):
        self.centroids, self.radii, self.sizes = centroids, radii, sizes

    def assign(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Centroid and distance to it for both halves of each row."""
        cut = self.centroids[0].shape[1]
        halves = [x[:, :cut], x[:, cut:]]
        at = [nearest(h, c) for h, c in zip(halves, self.centroids)]
        return at, [np.sqrt(((h - c[a]) ** 2).sum(axis=1)) for h, c, a in zip(halves, self.centroids, at)]

    def bounds(self, q: np.ndarray) -> list[np.ndarray]:
        """For each centroid of a half what a row of it can add to the score of q at most; -inf if it has no row."""
        cut = self.centroids[0].shape[1]
        out = []
        for half, c, r in zip((q[:cut], q[cut:]), self.centroids, self.radii):
            most = c @ half + np.sqrt(half @ half) * r
            out.append(np.where(r < 0, -np.inf, most + 1e-9 * (np.abs(c) @ np.abs(half) + np.abs(most)) + 1e-6))
        return out

    def visits(self, q: np.ndarray) -> Iterator[tuple[float, int]]:
        """Bound and cell of all cells that have rows, by falling bound: the multi-sequence walk over both sorted halves."""
        first, second = self.bounds(q)
        a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        a, b = a[np.isfinite(first[a])], b[np.isfinite(second[b])]
        if not len(a) or not len(b):
            return
        k, heap = len(second), [(-(first[a[0]] + second[b[0]]), 0, 0)]
        while heap:
            least, i, j = heapq.heappop(heap)
            cell = int(a[i]) * k + int(b[j])
            if self.sizes[cell]:
                yield -least, cell
            if j + 1 < len(b):
                heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.tolist()).astype(np.int64)


def _fitted(classes: DataFrame, k: int, cut: int, sample: int) -> list[np.ndarray]:
    """The two codebooks, fitted in one task on at most `sample` vectors, the first by their digests."""
    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = np.concatenate([_stacked(b["x"]) for b in batches if len(b)]).astype(float)
        for half, part in enumerate((x[:, :cut], x[:, cut:])):
            yield pd.DataFrame({"half": half, "at": range(min(k, len(x))), "c": list(codebook(part, k))})

    rows = classes.select("_h1", "_h2", "x").orderBy("_h1", "_h2").limit(sample).coalesce(1)
    found = rows.mapInPandas(fit, "half int, at int, c array<double>").orderBy("half", "at").collect()
    return [np.array([r.c for r in found if r.half == half]).reshape(-1, len(next(r.c for r in found if r.half == half)))
            for half in (0, 1)]


def build_index(classes: DataFrame, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> tuple[MultiIndex, DataFrame]:
    """The index of the vectors x of classes, and their rows in blocks: cell, part, and per row label, ids and x.

    A cell of more than BLOCK_ROWS rows is cut into parts by their digests. The driver gets the codebooks, the radii and the
    number of rows of each cell: at most MOST_CENTROIDS times MOST_CENTROIDS numbers, whatever the number of rows.
    """
    n, dims = classes.agg(F.count("*"), F.max(F.size("x"))).first()
    k = int(min(MOST_CENTROIDS, max(2, np.ceil(np.sqrt(n / cell_rows)))))
    cut = dims // 2
    index = MultiIndex(_fitted(classes, k, cut, sample), [], np.zeros(0))
    k = len(index.centroids[0])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, far = index.assign(_stacked(batch["x"]).astype(float)) if len(batch) else ([[], []], [[], []])
            yield batch.assign(c0=np.array(at[0], np.int32), c1=np.array(at[1], np.int32), r0=far[0], r1=far[1])

    shape = "_h1 long, _h2 long, label int, ids array<long>, x array<long>, c0 int, c1 int, r0 double, r1 double"
    placed = staged(classes.select("_h1", "_h2", "label", "ids", "x").mapInPandas(assign, shape), "placed")
    cells = placed.groupBy("c0", "c1").agg(F.count("*").alias("n"), F.max("r0").alias("r0"), F.max("r1").alias("r1")).toPandas()
    radii = [np.full(k, -1.0), np.full(k, -1.0)]
    for half in (0, 1):
        np.maximum.at(radii[half], cells[f"c{half}"].to_numpy(), cells[f"r{half}"].to_numpy())
    sizes = np.zeros(k * k, np.int64)
    sizes[cells["c0"].to_numpy() * k + cells["c1"].to_numpy()] = cells["n"].to_numpy()
    index = MultiIndex(index.centroids, radii, sizes)

    cell = F.col("c0") * k + F.col("c1")
    # At most one row for each cell.
    parts = placed.groupBy(cell.alias("cell")).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    rows = placed.withColumn("cell", cell).join(F.broadcast(parts), "cell")
    rows = rows.withColumn("part", F.pmod("_h2", "parts").cast("int"))
    held = F.collect_list(F.struct("label", "ids", "x"))
    return index, staged(rows.groupBy("cell", "part").agg(held.alias("rows")), "blocks")


def _planned(queries: DataFrame, index: MultiIndex, rows: int, first: bool) -> DataFrame:
    """queries with the cells that each visits in this round, in the order of their bounds.

    A query with a threshold tau is through once a bound is below it. Before it has one, and in the first round, it stops
    when its cells hold `rows` rows.
    """
    shared = queries.sparkSession.sparkContext.broadcast(index)

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for batch in batches:
            cells, seen, done = [], [], []
            for x, tau, before in zip(batch["x"], batch["tau"], batch["seen"]):
                mine, held, over = [], 0, True
                free = not first and not pd.isna(tau)
                for n, (bound, cell) in enumerate(index.visits(np.asarray(x, float))):
                    if not pd.isna(tau) and bound < tau:
                        break
                    if n < before:
                        continue
                    if not free and held >= rows:
                        over = False
                        break
                    mine.append(cell)
                    held += index.sizes[cell]
                cells.append(mine)
                seen.append(before + len(mine))
                done.append(over)
            yield batch.drop(columns=["seen"]).assign(tau=batch["tau"].astype("Int64"), cells=cells, seen=np.array(seen, np.int32), done=np.array(done, bool))

    return queries.select("_h1", "_h2", "label", "x", "limits", "tau", "seen").mapInPandas(plan, _PLAN)


def _compared(plan: DataFrame, blocks: DataFrame, score) -> DataFrame:
    """score(query block, row block) for all cells that the queries visit, as rows (_h1, _h2, limit, score, id).

    Rows below a query's threshold can't be in its result and are not passed on.

    Queries of a cell are blocked, the rows' blocks are copied for each TURN of them, and both meet by cell, part and
    turn: a cell that all queries visit, or one that holds a third of the rows, is many keys.
    """
    visits = plan.select("_h1", "_h2", "label", "x", "limits", "tau", F.explode("cells").alias("cell"))
    # At most one row for each cell.
    asked = visits.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
    asked = asked.withColumn("turns", F.ceil(F.col("blocks") / TURN).cast("int"))
    parts = blocks.groupBy("cell").agg((F.max("part") + 1).alias("parts"))
    spread = staged(asked.join(parts, "cell"), "spread")
    visits = visits.join(F.broadcast(spread), "cell").withColumn("block", F.pmod("_h1", "blocks").cast("int"))
    grouped = visits.groupBy("cell", "block").agg(F.max("turns").alias("turns"), F.max("parts").alias("parts"), F.collect_list(
        F.struct("_h1", "_h2", "label", "x", "limits", F.coalesce("tau", F.lit(-2**63)).alias("tau"))).alias("queries"))
    grouped = grouped.withColumn("turn", F.pmod("block", "turns")).select(
        "cell", "turn", "queries", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = blocks.join(F.broadcast(spread), "cell").select(
        "cell", "part", "rows", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for queries, rows in zip(batch["queries"], batch["rows"]):
                x = np.array([r["x"] for r in rows], np.int64)
                q = np.array([r["x"] for r in queries], np.int64)
                found += score(queries, products(q, x), np.array([r["label"] for r in rows]), [r["ids"] for r in rows])
            yield pd.DataFrame(found, columns=["_h1", "_h2", "limit", "score", "id"])

    return grouped.join(rows, ["cell", "part", "turn"]).select("queries", "rows").mapInPandas(
        compare, "_h1 long, _h2 long, limit long, score long, id long")


def _first(scores: np.ndarray, at: np.ndarray, ids: list, most: int) -> list[tuple[int, int]]:
    """The first (score, id) of the rows at `at`, by falling score and rising id."""
    if len(at) > most:
        least = np.partition(scores[at], len(at) - most)[len(at) - most]
        at = at[scores[at] >= least]
    found = [(int(scores[i]), int(x)) for i in at for x in ids[i]]
    return sorted(found, key=lambda f: (-f[0], f[1]))[:most]


def _searched(queries: DataFrame, index: MultiIndex, blocks: DataFrame, score, most: int, tau) -> DataFrame:
    """The first `most` rows (_h1, _h2, limit, score, id) of each query and limit, exactly, in a few rounds.

    tau(best) gives the threshold of each query, below which no row can change its result, from the best rows so far.
    """
    ranked = Window.partitionBy("_h1", "_h2", "limit").orderBy(F.desc("score"), "id")
    best, waiting, rows, n = None, queries, FIRST_ROWS, 0
    while True:
        plan = staged(_planned(waiting, index, rows, n == 0), f"plan_{n}")
        found = _compared(plan, blocks, score)
        found = found if best is None else best.unionByName(found)
        best = staged(found.withColumn("_n", F.row_number().over(ranked)).filter(F.col("_n") <= most).drop("_n"), f"best_{n}")
        going = plan.filter(~F.col("done")).select("_h1", "_h2", "label", "x", "limits", "seen")
        if going.isEmpty():
            return best
        waiting = going.join(tau(best), ["_h1", "_h2"], "left")
        if "floor" in waiting.columns:
            waiting = waiting.withColumn("tau", F.coalesce("tau", "floor"))
        rows, n = rows * GROWTH, n + 1


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80,
                   high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where `anchors` is true.

    A row's components x become floor(scale * x); a score is the inner product of those, higher ones first, equal ones by
    the smaller id. An anchor's positives are its first rows of the same label and another id; its negatives for a
    positive are the first rows of another label with low * positive_score <= 100 * negative_score <= high *
    positive_score. All results are exact: cells are visited until the next bound is below what could still change them.

    Rows with a null id, label or vector, with a null, NaN or infinite component, or with another number of components than
    most rows take no part. Repeated rows count once. Rows of equal label and numbers are one class, of which
    only the first ids can be in a result, and equal anchors are one query; so copies cost nothing more, however many they
    are. An empty table gives an empty result, other columns are not looked at. Scores beyond a long are an error.
    """
    x = F.col(vector_col).cast("array<double>")
    numbers = F.forall(x, lambda c: c.isNotNull() & (F.abs(c * scale) < F.lit(float("inf"))))
    rows = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & numbers)
    valid = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"),
                        F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("x"), anchors.alias("anchor"))
    dims = valid.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    kept = valid.filter(F.size("x") == (dims[0] if dims else 0))
    kept = kept.select("*", *[k.alias(f"_h{i}") for i, k in enumerate(digest(F.col("label"), F.col("x")), 1)])
    kept = staged(kept.dropDuplicates(["_h1", "_h2", "id"]), "vectors")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if dims is None or dims[0] < 2 and kept.isEmpty():
        return kept.sparkSession.createDataFrame([], out)

    # An anchor is left out of its own positives, so one more is looked for.
    want = positives + 1
    least = F.row_number().over(Window.partitionBy("_h1", "_h2").orderBy("id"))
    few = kept.withColumn("_n", least).filter(F.col("_n") <= max(want, negatives))
    classes = staged(few.groupBy("_h1", "_h2").agg(F.first("label").alias("label"), F.first("x").alias("x"),
                                                   F.sort_array(F.collect_list("id")).alias("ids")), "classes")
    index, blocks = build_index(classes)

    asked = kept.filter("anchor").groupBy("_h1", "_h2").agg(F.count("*").alias("_copies"))
    queries = staged(asked.join(classes.drop("ids"), ["_h1", "_h2"]), "queries")
    start = {"limits": F.array().cast("array<long>"), "tau": F.lit(None).cast("long"), "seen": F.lit(0)}

    def same(queries, scores, labels, ids):
        for q, s in zip(queries, scores):
            for value, i in _first(s, np.flatnonzero((labels == q["label"]) & (s >= q["tau"])), ids, want):
                yield q["_h1"], q["_h2"], 0, value, i

    def last_of(best: DataFrame) -> DataFrame:
        return best.groupBy("_h1", "_h2").agg(F.when(F.count("*") >= want, F.min("score")).alias("tau"))

    near = _searched(queries.withColumns(start), index, blocks, same, want, last_of)

    windows = near.groupBy("_h1", "_h2").agg(F.collect_set("score").alias("limits"), F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("_order"), "id", "score"))).alias("_pos"))
    windows = staged(windows.withColumn("limits", F.filter("limits", lambda s: s >= 0)), "windows")

    def other(queries, scores, labels, ids):
        for q, s in zip(queries, scores):
            rest = (labels != q["label"]) & (s >= q["tau"])
            for limit in q["limits"]:
                at = np.flatnonzero(rest & (100 * s <= high * limit) & (low * limit <= 100 * s))
                for value, i in _first(s, at, ids, negatives):
                    yield q["_h1"], q["_h2"], int(limit), value, i

    floors = windows.select("_h1", "_h2", F.explode("limits").alias("limit")).withColumn(
        "floor", F.ceil(F.col("limit") * low / 100).cast("long"))

    def lowest(best: DataFrame) -> DataFrame:
        full = best.groupBy("_h1", "_h2", "limit").agg(F.when(F.count("*") >= negatives, F.min("score")).alias("_last"))
        each = floors.join(full, ["_h1", "_h2", "limit"], "left")
        return each.groupBy("_h1", "_h2").agg(F.min(F.coalesce("_last", "floor")).alias("tau"))

    asking = queries.drop("_copies").join(windows.select("_h1", "_h2", "limits"), ["_h1", "_h2"]).filter(F.size("limits") > 0)
    asking = asking.join(floors.groupBy("_h1", "_h2").agg(F.min("floor").alias("tau")), ["_h1", "_h2"])
    far = _searched(asking.withColumn("seen", F.lit(0)), index, blocks, other, negatives, lowest)

    lists = far.groupBy("_h1", "_h2", "limit").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("_order"), "id", "score"))).alias("found"))
    lists = lists.groupBy("_h1", "_h2").agg(F.map_from_entries(F.collect_list(F.struct("limit", "found"))).alias("_neg"))
    known = windows.select("_h1", "_h2", "_pos").join(lists, ["_h1", "_h2"], "left").join(
        queries.select("_h1", "_h2", "_copies"), ["_h1", "_h2"])
    found = lookup(kept.filter("anchor").select("_h1", "_h2", "id"), staged(known, "found"), ["_h1", "_h2"], "_copies", "id",
                   ["_pos", "_neg"])
    mine = F.slice(F.filter("_pos", lambda p: p["id"] != F.col("id")), 1, positives)
    pairs = found.select(F.col("id").alias("anchor_id"), "_neg", F.explode(mine).alias("p"))
    pairs = pairs.select("anchor_id", "p", F.posexplode(F.element_at("_neg", F.col("p.score"))).alias("at", "n"))
    return pairs.select("anchor_id", F.col("p.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
                        F.col("n.id").alias("negative_id"), F.col("p.score").alias("positive_score"),
                        F.col("n.score").alias("negative_score"))
