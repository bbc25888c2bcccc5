"""Quality classifier: a generalised additive model with pairwise interactions, of lookup tables learned by cyclic boosting."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each class that the model is fitted on, at most; the first by a hash of their ids.
FIT_DOCS = 5_000
#: Bins of a feature, passes over all features, pairs of features, and passes over the pairs.
BINS, ROUNDS, PAIRS, PAIR_ROUNDS = 32, 150, 6, 60
#: What a tree adds, of its best step; what is added to the weight of each leaf; and the least weight of a leaf.
RATE, RIDGE, LEAF = 0.1, 2.0, 4.0
#: Share of the rows that is not learned from and decides how many passes are kept.
CHECKED = 0.2

FEATURES = ("words", "word_chars", "symbols", "capitals", "digits", "marks", "distinct", "commonest", "repeated", "short_words",
            "long_words", "bare_words", "line_words", "repeated_lines", "byte_bits")

_SYMBOL, _DIGIT, _UPPER = re.compile(r"[^\w\s.,;:!?'\"()-]"), re.compile(r"\d"), re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARK, _LETTER = re.compile(r"[!?;:\"()]"), re.compile(r"[^\W\d_]")


def features(text: str | None) -> tuple[float, ...]:
    """The numbers FEATURES of a text; those of a text without a word are all zero."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    chars, counts = sum(map(len, words)), Counter(words)
    grams = set(zip(words, words[1:], words[2:]))
    lines = [x for x in text.split("\n") if x.strip()]
    # Bytes are counted in pieces, so a long text takes no more memory than itself.
    bytes_ = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    share = bytes_[bytes_ > 0] / bytes_.sum()
    return (
        np.log2(1 + n), chars / n, len(_SYMBOL.findall(text)) / chars, len(_UPPER.findall(text)) / chars, len(_DIGIT.findall(text)) / chars,
        len(_MARK.findall(text)) / n, len(counts) / n, max(counts.values()) / n, 1 - len(grams) / max(1, n - 2) if n > 2 else 0.0,
        sum(c for w, c in counts.items() if len(w) <= 3) / n, sum(c for w, c in counts.items() if len(w) > 12) / n,
        sum(c for w, c in counts.items() if not _LETTER.search(w)) / n, np.log2(n / len(lines)), 1 - len(set(lines)) / len(lines),
        float(-(share * np.log2(share)).sum()))


def feature_rows(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


class Model:
    """An intercept, a table for the bins of each feature, and tables for the bins of pairs of features."""

    def __init__(self, edges: list, tables: list, pairs: list, bias: float):
        self.edges, self.tables = [np.asarray(e, float) for e in edges], [np.asarray(t, float) for t in tables]
        self.pairs, self.bias = [(a, b, np.asarray(t, float)) for a, b, t in pairs], bias

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1: the tables' entries of each row's bins, added up."""
        at, total = self.bins(x), np.full(len(x), self.bias)
        for bins, table in zip(at, self.tables):
            total += table[bins]
        for a, b, table in self.pairs:
            total += table[at[a], at[b]]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How much the loss falls by one value for rows of gradient g and weight h; none for too few rows."""
    return np.where(h >= LEAF, g * g / (h + RIDGE), -np.inf)


def _split(g: np.ndarray, h: np.ndarray) -> int:
    """Where bins are best cut in two: the first bin of the right part, or 0."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - g.sum() ** 2 / (h.sum() + RIDGE)
    best = int(np.argmax(gain)) if len(gain) else 0
    return best + 1 if len(gain) and gain[best] > 1e-9 else 0


def tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The values of a tree over the bins of one feature, for each bin."""
    cut = _split(g, h) if depth else 0
    if not cut:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate([tree(g[:cut], h[:cut], depth - 1), tree(g[cut:], h[cut:], depth - 1)])


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts one axis, and then either part along the other."""
    best, values = 0.0, np.zeros_like(g)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        whole = a.sum() ** 2 / (b.sum() + RIDGE)
        ga, ha = a.cumsum(0).cumsum(1), b.cumsum(0).cumsum(1)
        sides = []
        for gs, hs in ((ga[:-1], ha[:-1]), (ga[-1] - ga[:-1], ha[-1] - ha[:-1])):
            sides.append(_gain(gs[:, :-1], hs[:, :-1]) + _gain(gs[:, -1:] - gs[:, :-1], hs[:, -1:] - hs[:, :-1]))
        if not sides[0].size:
            continue
        gain = sides[0].max(1) + sides[1].max(1) - whole
        cut = int(np.argmax(gain))
        if gain[cut] > best:
            best, out = float(gain[cut]), np.zeros_like(a)
            for rows, side in ((slice(0, cut + 1), sides[0]), (slice(cut + 1, None), sides[1])):
                at = int(np.argmax(side[cut])) + 1
                for cols in (slice(0, at), slice(at, None)):
                    out[rows, cols] = a[rows, cols].sum() / (b[rows, cols].sum() + RIDGE)
            values = out.T if turned else out
    return best, values


def _loss(y: np.ndarray, total: np.ndarray, w: np.ndarray) -> float:
    return float((w * (np.logaddexp(0, total) - y * total)).sum() / max(1e-12, w.sum()))


def fit(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Model:
    """Boosts one tree after the other, in turn for each feature, then for each of the pairs that promise most.

    The passes kept are those after which the loss of the rows left out was least. Rows of x are given in an order that
    says nothing about y: every fifth one is left out. w weighs the rows.
    """
    n1, n0 = float(w[y > 0].sum()), float(w[y == 0].sum())
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    bias = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges], [], bias)
    if not n0 or not n1:
        return model
    at, sizes = model.bins(x), [len(e) + 1 for e in edges]
    held = np.arange(len(x)) % round(1 / CHECKED) == 0
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held = np.zeros(len(x), bool)
    weight = np.where(held, 0.0, w)
    total = np.full(len(x), bias)

    def steps() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
        return weight * (y - p), weight * p * (1 - p)

    def passes(rounds: int, places: list[tuple[np.ndarray, int]], grow, tables: list[np.ndarray]) -> list[np.ndarray]:
        nonlocal total
        best, kept, start = _loss(y[held], total[held], w[held]) if held.any() else np.inf, [t.copy() for t in tables], total.copy()
        since = 0
        for _ in range(rounds):
            for k, (place, size) in enumerate(places):
                g, h = steps()
                values = RATE * grow(k, np.bincount(place, g, size), np.bincount(place, h, size))
                tables[k] += values
                total += values[place]
            loss = _loss(y[held], total[held], w[held]) if held.any() else -np.inf
            since = 0 if loss < best else since + 1
            if loss < best or not held.any():
                best, kept = loss, [t.copy() for t in tables]
            if since >= 15:
                break
        total = start + sum((t[place] for t, (place, _) in zip(kept, places)), np.zeros(len(x)))
        return kept

    tables = passes(ROUNDS, list(zip(at, sizes)), lambda k, g, h: tree(g, h), model.tables)
    model = Model(edges, tables, [], bias)
    g, h = steps()
    promise = []
    for a, b in combinations(range(len(edges)), 2):
        place, shape = at[a] * sizes[b] + at[b], (sizes[a], sizes[b])
        grid = [np.bincount(place, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)]
        promise.append((-pair_tree(*grid)[0], a, b))
    pairs = [(a, b) for gain, a, b in sorted(promise)[:PAIRS] if gain < 0]
    shapes = [(sizes[a], sizes[b]) for a, b in pairs]
    found = passes(PAIR_ROUNDS, [(at[a] * sizes[b] + at[b], sizes[a] * sizes[b]) for a, b in pairs],
                   lambda k, g, h: pair_tree(g.reshape(shapes[k]), h.reshape(shapes[k]))[1].ravel(), [np.zeros(a * b) for a, b in shapes])
    return Model(edges, tables, [(a, b, t.reshape(s)) for (a, b), t, s in zip(pairs, found, shapes)], bias)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          fit_docs: int = FIT_DOCS) -> Model:
    """Fits a model to the labels (id_col, label_col; above zero is 1) of docs.

    At most fit_docs documents of each class are used, the first by a hash of their ids, weighed by the documents that they
    stand for. Null labels and ids are left out, and ids whose labels contradict each other. Without labels of both
    classes every text has the same score. Only a text and its label are seen; texts of any length are measured whole.
    The rows' features, at most twice fit_docs of them, are learned from in one task, and the tables come back.
    """
    y = (F.col(label_col) > 0).cast("int")
    known = labels.select(F.col(id_col).alias("_id"), y.alias("_y")).dropna().groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z"))
    known = known.filter(F.col("_y") == F.col("_z")).drop("_z")
    counts = {r[0]: r[1] for r in known.groupBy("_y").count().collect()}
    first = lambda k: known.filter(F.col("_y") == k).orderBy(F.xxhash64("_id"), "_id").limit(fit_docs)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"h": batch["_h"], "y": batch["_y"], "x": list(feature_rows(batch["_text"].tolist()))})

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # The broadcast side has 2 * fit_docs rows at most.
    rows = texts.join(F.broadcast(first(0).unionByName(first(1))), "_id").select(F.xxhash64("_id", "_text").alias("_h"), "_y", "_text")
    rows = rows.mapInPandas(measured, "h long, y int, x array<double>")

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        data = pd.concat([pd.DataFrame({"h": [], "y": [], "x": []}), *batches], ignore_index=True).drop_duplicates("h").sort_values("h")
        x, y = np.array(data["x"].tolist(), float).reshape(-1, len(FEATURES)), data["y"].to_numpy(int)
        share = {k: counts.get(k, 0) / max(1, int((y == k).sum())) for k in (0, 1)}
        w = np.array([share[k] for k in y], float)
        model = fit(x, y, w / w.mean() if len(w) else w)
        yield pd.DataFrame({"edges": [[e.tolist() for e in model.edges]], "tables": [[t.tolist() for t in model.tables]],
                            "pairs": [[[a, b] for a, b, _ in model.pairs]], "grids": [[t.ravel().tolist() for _, _, t in model.pairs]],
                            "bias": [model.bias]})

    out = rows.repartition(1).mapInPandas(learned, "edges array<array<double>>, tables array<array<double>>, pairs array<array<int>>, "
                                                "grids array<array<double>>, bias double").first()
    if out is None:
        return Model([[]] * len(FEATURES), [[0.0]] * len(FEATURES), [], 0.0)
    pairs = [(a, b, np.array(t).reshape(len(out.tables[a]), len(out.tables[b]))) for (a, b), t in zip(out.pairs, out.grids)]
    return Model(out.edges, out.tables, pairs, out.bias)


def quality(text: Column, model: Model) -> Column:
    """The probability that a text is of quality 1, by its whole text; null and empty texts have that of no word."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(feature_rows(texts.tolist())))

    return score(text)
