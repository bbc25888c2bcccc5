"""Divergence, quality model and hard negatives against brute force, with nulls, empty and long texts, ties and repeats."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetrisk.llm.divergence import divergence, terms
from fleetrisk.llm.hard_negatives import MultiIndex, codebook, hard_negatives, nearest, products
from fleetrisk.llm.quality_model import FEATURES, Model, feature_rows, features, fit, pair_tree, quality, train, tree

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, least, top):
    rows = [(text or "", lang or "", source or "") for text, lang, source in rows]
    docs, counts, langs = Counter(), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text)]
        docs.update({(lang, t) for t in found})
        counts[lang, source].update(found)
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = [t for (g, t), n in docs.items() if g == lang and n >= least]
        share = lambda c, c_all, kept=kept: {t: 1 + 10**9 * (c[t] + 2) // (c_all + 2 * len(kept)) for t in kept}
        own = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        p = {s: share(own[s], sum(own[s].values())) for s in sources}
        whole = Counter()
        for s in sources:
            whole.update(own[s])
        q = share(whole, sum(whole.values()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            told = [(-f(p[s][t], q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))),
                                ("term", sorted(told, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -v, n) for n, (v, item) in enumerate(items, 1)]
    return sorted(out)


def test_divergence(spark):
    rng = np.random.default_rng(2)
    words = ["Alpha", "alphabetical", "alphabets", "éclair", "漢字", "gamma", "a" * 70 + "b", "a" * 70 + "c", "Ωmega", "x1y", "omegaomegaomega"]
    rows = [(" ".join(rng.choice(words, rng.integers(1, 8))) + "-" + str(i), ["en", "de"][i % 2], f"s{i % 3 * (i % 5 > 0)}") for i in range(80)]
    rows += [(None, "en", "s0"), ("", None, None), ("Alpha " * 40_000, "en", "s1"), rows[0], rows[0], ("only here", "fr", "lone"), (None, "it", "none")]
    df = spark.createDataFrame([(*r, 7, "clash") for r in rows], "text string, lang string, source string, count long, term string")
    got = sorted(tuple(r) for r in divergence(df, least_docs=4, top=3).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == plain_divergence(rows, 4, 3) and {r[2] for r in got} == {"pair", "term"}
    assert divergence(df.limit(0)).count() == 0
    assert terms(b"A-b \xc3\x89x_1Y") == [b"a", b"b", b"\xc3\x89x", b"y"] and terms(None) == []


def test_trees_and_tables():
    """A tree is the best of all cuts of its depth; a pair's tree finds what no single feature shows."""
    rng = np.random.default_rng(4)
    g, h = rng.normal(size=12), np.full(12, 5.0)
    best = max(g[:c].sum() ** 2 / (h[:c].sum() + 2) + g[c:].sum() ** 2 / (h[c:].sum() + 2) for c in range(1, 12))
    values = tree(g, h, 1)
    cut = int(np.flatnonzero(np.diff(values))[0]) + 1
    assert np.isclose(g[:cut].sum() ** 2 / (h[:cut].sum() + 2) + g[cut:].sum() ** 2 / (h[cut:].sum() + 2), best)
    grid = np.outer([1.0, 1, -1, -1], [1.0, 1, -1, -1])
    gain, values = pair_tree(grid * 10, np.full((4, 4), 5.0))
    assert gain > 0 and (np.sign(values) == grid).all()
    x = rng.uniform(-1, 1, (2_000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    model = fit(x, y, np.ones(len(y)))
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.9 and {0, 1} in [{a, b} for a, b, _ in model.pairs]
    at = model.bins(x[:1])
    total = model.bias + sum(t[b[0]] for t, b in zip(model.tables, at)) + sum(t[at[a][0], at[b][0]] for a, b, t in model.pairs)
    assert np.isclose(model.scores(x[:1])[0], 1 / (1 + np.exp(-total)))


def test_quality_model(spark):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}" for a in ("mor", "tel", "vin") for b in ("ran", "den", "lix", "mu")]
    prose = lambda n: " ".join(rng.choice(words, n))
    texts = [prose(rng.integers(30, 120)) + ".\n" + prose(20) + "." if i % 3 else " ".join(w + "###" for w in rng.choice(words, 60)) for i in range(300)]
    texts += [None, "", "  \n", "word " * 40_000, texts[1], texts[1]]
    docs = spark.createDataFrame([(i if i != 299 else None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, quality long")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)] + [(1, 0), (2, None), (None, 1), (9_999, 1)], "doc_id long, quality int")
    model = train(docs, labels)
    rows = docs.select("doc_id", "text", quality(F.col("text"), model).alias("score")).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        assert np.isclose(r.score, model.scores(feature_rows([r.text]))[0])
        if r.doc_id is not None and 240 <= r.doc_id < 299:
            assert (r.score >= 0.5) == (r.doc_id % 3 > 0)
    assert features(None) == features("") == features(" \n") == (0.0,) * len(FEATURES)
    for few in (labels.limit(0), labels.where("quality = 1")):
        scores = {r[0] for r in docs.select(quality(F.col("text"), train(docs, few))).collect()}
        assert len(scores) == 1 and (few.count() == 0 or scores.pop() > 0.9)
    assert docs.limit(0).select(quality(F.col("text"), train(docs.limit(0), labels))).count() == 0
    assert isinstance(model, Model)


def plain_negatives(rows):
    seen = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v):
            seen.setdefault((i, label, tuple(int(np.floor(256 * x)) for x in v)))
    data, out = list(seen), []
    for a, la, va in data:
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in data)
        positives = [(-s, i) for s, i, label in scored if label == la and i != a][:5]
        for ps, p in positives:
            found = [(-s, i) for s, i, label in scored if label != la and 80 * ps <= -100 * s <= 100 * ps][:5]
            out += [(a, p, n, i, ps, s) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    """Clusters, a third of copies, ties, all kinds of bad rows; small cells and blocks force rounds, parts and turns."""
    import fleetrisk.llm.hard_negatives as hn

    for name, value in (("CELL_ROWS", 8), ("BLOCK_ROWS", 4), ("BLOCK_QUERIES", 3), ("TURN", 1), ("FIRST_ROWS", 10)):
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 1, (5, 6))
    rows = [(i, [float(x) for x in (centres[0] if i % 3 == 0 else centres[i % 5] + rng.normal(0, 0.2, 6))], i % 4) for i in range(240)]
    rows += [(1_000, None, 1), (1_010, [1.0] * 5, 1), (1_020, [float("nan")] + [1.0] * 5, 2), (1_030, [None] + [1.0] * 5, 2), (1_040, [1.0] * 6, None),
             (None, [1.0] * 6, 1), (1_050, [float("inf")] + [0.0] * 5, 3), (1_060, [0.0] * 6, 3), rows[0], rows[0], rows[7], (1_070, [-0.5] * 6, 9)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, score int")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % 10 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == plain_negatives(rows) and len(got) > 100
    assert hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives(df.where("vec_id = 1000"), F.col("vec_id") % 10 == 0).count() == 0


def test_cells_come_by_falling_bounds():
    rng = np.random.default_rng(9)
    x = rng.integers(-200, 200, (400, 8)).astype(float)
    halves = [x[:, :4], x[:, 4:]]
    books = [codebook(h, 5) for h in halves]
    at = [nearest(h, c) for h, c in zip(halves, books)]
    radii = [np.array([np.sqrt(((h[a == i] - c[i]) ** 2).sum(1)).max() if (a == i).any() else -1.0 for i in range(5)]) for h, c, a in zip(halves, books, at)]
    sizes = np.bincount(at[0] * 5 + at[1], minlength=25)
    index = MultiIndex(books, radii, sizes)
    for q in x[:20]:
        seen = list(index.visits(q))
        bounds = [b for b, _ in seen]
        assert bounds == sorted(bounds, reverse=True) and sorted(c for _, c in seen) == np.flatnonzero(sizes).tolist()
        for bound, cell in seen:
            assert (x[at[0] * 5 + at[1] == cell] @ q).max() <= bound
    big = np.array([[2**40, 3]]), np.array([[2**20, 5]])
    assert products(*big).tolist() == [[2**60 + 15]]
    with pytest.raises(OverflowError):
        products(np.array([[2**40]]), np.array([[2**40]]))


def test_divergence_counts_in_arrow(spark):
    """Keys of a level are slices, longer by one byte for prefixes; terms of lengths around a level's stay apart, and counts leave tasks as Arrow columns."""
    from fleetrisk.llm import divergence as d

    words = [f"{'abcdefghijklmnopqrstuvwxyz'[:n]}" for n in (7, 8, 9, 10, 16, 17, 18)]
    df = spark.createDataFrame([("en", bytearray(f"{w} {w}".encode())) for w in words for _ in range(3)], "lang string, text binary")
    level = d._level(df, None, 0, 8)
    assert {(bytes(r.key).decode(), r.n) for r in level.collect()} == {("abcdefg", 3), ("abcdefgh", 3), ("abcdefghi", 15)}
    assert {bytes(r.term).decode() for r in d.kept_terms(df, 3).collect()} == set(words) and d.kept_terms(df, 4).count() == 0
    plan = level._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
