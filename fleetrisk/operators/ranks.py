"""Exact order statistics by narrowing: no sort, no wide shuffle, no unbounded buffer.

Each pass counts the values of a bracket in even buckets (a small map-side aggregate), keeps the
bucket that holds the wanted rank, and stops once the bracket fits into one task. At a trillion
rows that is three scans of the needed columns; a table that fits at once takes one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetrisk.functions.numbers import finite

FIT_ROWS = 200_000
BUCKETS = 1024
#: Accuracy of the sketch that the first brackets come from.
SKETCH = 1000
#: Aggregates of one pass over written values.
AGGREGATES = 36


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], fit_rows: int = FIT_ROWS, written: bool = False) -> dict:
    """{column: [quantiles]} with linear interpolation; nulls and NaN are left out.

    Like ``DataFrame.approxQuantile`` it returns plain numbers (columns x probs of them), so the
    bounds enter later plans as literals. A column without values gives None. If df is ``written``, many columns are
    measured a few at a time.
    """
    if not cols:
        return {}
    values = df.select(*[finite(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    stats = _extent(values, len(cols), written)
    wanted = set()
    for i, s in enumerate(stats):
        for p in probs:
            if s["n"]:
                low = math.floor((s["n"] - 1) * p)
                wanted.update({(i, low), (i, min(low + 1, s["n"] - 1))})
    found = _select(values, stats, wanted, fit_rows, written)
    out = {}
    for i, c in enumerate(cols):
        n = stats[i]["n"]
        out[c] = [None] * len(probs)
        for k, p in enumerate(probs):
            if n:
                at = (n - 1) * p
                low = math.floor(at)
                a, b = found[i, low], found[i, min(low + 1, n - 1)]
                out[c][k] = _between(a, b, at - low)
    return out


def _between(a: float, b: float, share: float) -> float:
    """Linear interpolation from the nearer end, as the usual array libraries round it."""
    return a + (b - a) * share if share < 0.5 else b - (b - a) * (1 - share)


def values_at_ranks(df: DataFrame, col, ranks: list[int], fit_rows: int = FIT_ROWS) -> dict:
    """{rank: (value, rows below it)} of an integral column; ranks count from 0. All ranks share the passes."""
    values = df.select(col.cast("bigint").alias("c0"))
    found = _select(values, _extent(values, 1), {(0, r) for r in ranks}, fit_rows)
    edges = sorted({found[0, r] for r in ranks})
    below = values.agg(*[F.count(F.when(F.col("c0") < F.lit(e), 1)).alias(f"b{i}") for i, e in enumerate(edges)]).first()
    return {r: (found[0, r], below[f"b{edges.index(found[0, r])}"]) for r in ranks}


def _measured(values: DataFrame, aggs: list[Column], written: bool) -> dict:
    """The row of the aggregates by name. Many at once are too many for compiled code: of written values, a few at a time read their own columns only."""
    width = AGGREGATES if written else max(1, len(aggs))
    return {k: v for at in range(0, len(aggs), width) for k, v in values.agg(*aggs[at:at + width]).first().asDict().items()}


def _extent(values: DataFrame, k: int, written: bool = False) -> list[dict]:
    aggs = []
    for i in range(k):
        c = F.col(f"c{i}")
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    row = _measured(values, aggs, written)
    return [{"n": row[f"n{i}"], "lo": row[f"lo{i}"], "hi": row[f"hi{i}"]} for i in range(k)]


def _bucket(x, lo, hi):
    # Halves keep the span finite; every step is monotone in x, so buckets are ordered.
    share = (x / F.lit(2.0) - F.lit(lo / 2.0)) / F.lit(hi / 2.0 - lo / 2.0)
    return F.least(F.greatest(F.floor(share * BUCKETS), F.lit(0)), F.lit(BUCKETS - 1)).cast("int")


def _select(values: DataFrame, stats: list[dict], wanted: set, fit_rows: int, written: bool = False) -> dict:
    """{(column, rank): value} for all wanted ranks, narrowing their brackets together."""
    found = {}
    if max((stats[i]["n"] for i, _ in wanted), default=0) <= fit_rows:
        return _sorted_values(values, wanted)
    state = {t: (stats[t[0]]["lo"], stats[t[0]]["hi"], 0, stats[t[0]]["n"]) for t in wanted}
    state = _sketched(values, state, fit_rows, written)
    while True:
        for t in [t for t, (lo, hi, _, _) in state.items() if lo == hi]:
            found[t] = state.pop(t)[0]
        wide = sorted({(t[0], s[0], s[1]) for t, s in state.items() if s[3] > fit_rows})
        if not wide:
            break
        rows = _bracket_rows(values, wide, bucketed=True)
        cells = {}
        for r in rows.groupBy("b", "k").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"),
                                            F.max("x").alias("hi")).collect():  # <= brackets x BUCKETS rows
            cells.setdefault(r["b"], []).append((r["k"], r["n"], r["lo"], r["hi"]))
        for t, (lo, hi, below, n) in list(state.items()):
            if n <= fit_rows:
                continue
            at = below
            for _, inside, lo2, hi2 in sorted(cells[wide.index((t[0], lo, hi))]):
                if t[1] < at + inside:
                    state[t] = (lo2, hi2, at, inside)
                    break
                at += inside
    if state:
        narrow = sorted({(t[0], s[0], s[1]) for t, s in state.items()})
        lists = _bracket_rows(values, narrow, bucketed=False).groupBy("b").agg(
            F.sort_array(F.collect_list("x")).alias("xs"))  # each list holds at most fit_rows values
        targets = [[] for _ in narrow]
        for t, (lo, hi, below, _) in state.items():
            targets[narrow.index((t[0], lo, hi))].append((t, t[1] - below))
        places = F.array().cast("array<int>")
        for b, picks in enumerate(targets):
            places = F.when(F.col("b") == b, F.array(*[F.lit(at + 1) for _, at in picks])).otherwise(places)
        for row in lists.select("b", F.transform(places, lambda at: F.element_at("xs", at)).alias("v")).collect():
            for (t, _), v in zip(targets[row["b"]], row["v"]):  # one number per wanted rank
                found[t] = v
    return found


def _sketched(values: DataFrame, state: dict, fit_rows: int, written: bool = False) -> dict:
    """state with its wide brackets narrowed around the ranks by a sketch, so that later passes see few rows.

    The rows below and within a narrower bracket are counted; one that misses its rank is not taken, so nothing depends
    on the sketch being right.
    """
    wide = sorted(t for t, (lo, hi, _, n) in state.items() if n > fit_rows and lo != hi)
    if not wide:
        return state
    ends = {}
    for i, rank in wide:
        share = rank / state[i, rank][3]
        ends.setdefault(i, []).extend([max(0.0, share - 2 / SKETCH), min(1.0, share + 2 / SKETCH)])
    row = _measured(values, [F.percentile_approx(f"c{i}", ps, SKETCH).alias(f"q{i}") for i, ps in ends.items()], written)
    around = {t: tuple(row[f"q{t[0]}"][2 * k:2 * k + 2]) for i in ends for k, t in enumerate(t for t in wide if t[0] == i)}
    counts = _measured(values, [c for j, t in enumerate(wide) for c in (
        F.count_if(F.col(f"c{t[0]}") < F.lit(around[t][0])).alias(f"b{j}"),
        F.count_if(F.col(f"c{t[0]}").between(*map(F.lit, around[t]))).alias(f"n{j}"))], written)
    out = dict(state)
    for j, t in enumerate(wide):
        below, inside = counts[f"b{j}"], counts[f"n{j}"]
        if below <= t[1] < below + inside:
            out[t] = (*around[t], below, inside)
    return out


def _sorted_values(values: DataFrame, wanted: set) -> dict:
    """The wanted ranks of columns that hold at most fit_rows values each."""
    if not wanted:
        return {}
    lists = values.agg(*[F.sort_array(F.collect_list(f"c{i}")).alias(f"c{i}") for i in sorted({i for i, _ in wanted})])
    order = sorted(wanted)
    row = lists.select(*[F.element_at(f"c{i}", r + 1).alias(f"v{j}") for j, (i, r) in enumerate(order)]).first()
    return {t: row[j] for j, t in enumerate(order)}


def _bracket_rows(values: DataFrame, brackets: list, bucketed: bool) -> DataFrame:
    cells = []
    for b, (i, lo, hi) in enumerate(brackets):
        x = F.col(f"c{i}")
        fields = [F.lit(b).alias("b"), x.alias("x")]
        if bucketed:
            fields.insert(1, _bucket(x, lo, hi).alias("k"))
        cells.append(F.when(x.between(F.lit(lo), F.lit(hi)), F.struct(*fields)))
    return values.select(F.explode(F.array_compact(F.array(*cells))).alias("s")).select("s.*")
