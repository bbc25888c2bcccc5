"""Near copies of the pipeline against all pairs of shingle sets."""

import random

import numpy as np

import corpus_pipeline as cp
from fleetrisk.llm.common import sieve
from fleetrisk.llm.shingles import (
    COARSE, fine_histogram, fingerprint_pairs, finely_similar, finer, histogram, near_copies, rest_pairs, shingle_hashes, shingle_set, similar, verified)
from fleetrisk.llm.simhash import _signed, fingerprint, fingerprint_of


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_near_copies(spark):
    """Copies with words replaced, a shared passage, exact limits, chains, short and empty texts; groups of all pairs."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3_000)]
    passage = " ".join(rng.choices(words, k=40))
    texts = [None, "", " \n", "one two", "ONE  two", "one two three", "a b c d e f g h i", "a b c d e f g h"]
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(60, 200))
        texts.append(" ".join(base))
        for edits in (1, 1, 2, 3, 4, 6):
            copy = list(base)
            for at in rng.sample(range(len(base)), edits):
                copy[at] = rng.choice(words)
            texts.append(" ".join(copy))
    texts += [passage + " " + " ".join(rng.choices(words, k=rng.choice((4, 30, 80)))) for _ in range(30)]
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    close = [[j for j in root if jaccard(sets[i], sets[j]) >= 0.8] for i in root]
    for _ in texts:
        root = [min(root[j] for j in near) for near in close]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = {}
    for r in near_copies(df).collect():
        groups.setdefault(r["_root"], []).append(r.doc_id)
    want = {}
    for i, r in enumerate(root):
        want.setdefault(r, []).append(i)
    assert sorted(map(sorted, groups.values())) == sorted(want.values())
    assert {r.doc_id for r in cp.drop_near_duplicates(spark, df, "").collect()} == set(root)


def test_large_groups_are_cut_into_parts(spark):
    """The pairs of a group that pass the filter don't depend on how it is cut; equal roots give none."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(30)]
    sets = [shingle_set(" ".join(base[:k] + [f"x{i}"] + base[k:]), 2) for i, k in enumerate(rng.choices(range(30), k=40))]
    rows = [(5, i, len(s), histogram(s), i % 13) for i, s in enumerate(sets)] + [(6, i, len(s), histogram(s), 1) for i, s in enumerate(sets[:5])]
    df = spark.createDataFrame([(r[0], r[1], r[4]) for r in rows], "_shingle long, _set long, root long")
    shapes = spark.createDataFrame([(i, len(s), histogram(s)) for i, s in enumerate(sets)], "_set long, _n int, _hist binary")
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if i % 13 != j % 13 and similar(a, b, 60)}
    cut, whole = ({tuple(r) for r in rest_pairs(df, shapes, 60, block).collect()} for block in (7, 1000))
    assert cut == whole and want <= cut and len(want) > 5
    texts = spark.createDataFrame([(i, " ".join(f"w{x}" for x in range(i, i + 30))) for i in range(6)], "_set long, _text string")
    pairs = spark.createDataFrame([(i, 0) for i in range(1, 6)], "node long, other long")
    assert {r.node for r in verified(pairs, texts, 5, 80, turn=2).collect()} == {1, 2}


def test_fine_histograms_lose_no_pair(spark):
    """Large sets of all overlaps: no similar pair is left out, most unlike ones are; small and full ones always pass."""
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(-2**63, 2**63 - 1, 9_000))
    sets = [base[:COARSE], base[:COARSE + 1]]
    for n in (600, 1_023, 1_100, 2_500, 6_000):
        sets += [np.unique(np.concatenate([base[:n], base[6_000:6_000 + n * k // 100]])) for k in (0, 5, 20, 25, 26)]
        sets += [rng.permutation(base)[:n]]
    sets += [np.arange(0, 2_000_000, 1 << 10), np.arange(0, 2_100_000, 1 << 10)]
    fine = [fine_histogram(x) for x in sets]
    assert fine[0] == b"" and len(fine[1]) == 64 and max(map(len, fine)) == 1_024
    want, passed, unlike = set(), set(), 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            want |= {(i, j)} if similar(a, b, 80) else set()
            passed |= {(i, j)} if finely_similar(len(a), len(b), fine[i], fine[j], 80) else set()
            unlike += not similar(a, b, 80)
    assert len(want) > 10 and want <= passed and len(passed - want) < unlike // 3
    assert (len(sets) - 1, len(sets) - 2) in passed  # All of a class: 255 stands for any number.
    shapes = spark.createDataFrame([(i, len(x), fine[i]) for i, x in enumerate(sets)], "_set long, _n int, _fine binary")
    pairs = spark.createDataFrame([(i, j) for i in range(len(sets)) for j in range(i)], "node long, other long")
    assert {tuple(r) for r in finer(pairs, shapes, 80).collect()} == passed


def test_sieve(spark):
    """All keys pass, few others do; without keys nothing does."""
    df = spark.range(-20_000, 20_000).selectExpr("xxhash64(id) AS h", "id")
    keys = df.filter("id % 4 = 0")
    through = {r.id for r in df.filter(sieve(keys, "h")("h")).collect()}
    assert through >= set(range(-20_000, 20_000, 4)) and len(through) < 12_500
    assert df.filter(sieve(keys.limit(0), "h")("h")).count() == 0


def test_rows_alone_and_rows_together(spark):
    """Repeated rows count once, null ids come last, and documents alone in their group stay with all their columns."""
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "A b c d e f", "x"), (None, "alone here", "y"), (3, None, "z"),
            (2, " ", "z"), (4, "quite another text of words", None), (None, "twice", "w"), (None, "twice", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = cp.drop_near_duplicates(spark, df, "")
    assert out.columns == df.columns
    key = lambda r: tuple(map(str, r))
    want = [rows[0], rows[3], rows[5], rows[6], rows[7]]
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)


def test_fingerprints_give_pairs(spark, monkeypatch):
    """The stage's fingerprints are those of op4 with five words; their pairs connect what differs in four bits, and the stage looks at them."""
    rng = random.Random(9)
    base = rng.choices([f"w{i}" for i in range(900)], k=400)
    texts = [None, "one two", *(" ".join(base[:k] + ["x"] + base[k:]) for k in range(0, 400, 40)), *(" ".join(rng.choices(base, k=50)) for _ in range(9))]
    fps = [fingerprint(t, 5) for t in texts]
    assert fps == [fingerprint_of(shingle_hashes(t, 5)) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        root = [min(root[j] for j in range(len(texts)) if (fps[i] ^ fps[j]).bit_count() <= 4) for i in range(len(texts))]
    df = spark.createDataFrame([(i, _signed(f)) for i, f in enumerate(fps)], "_set long, _fp long")
    got = list(range(len(texts)))
    pairs = [tuple(r) for r in fingerprint_pairs(df, 4).collect()]
    for _ in texts:
        for a, b in pairs:
            got[a] = got[b] = min(got[a], got[b])
    assert got == root and len(set(root)) < len(texts)
    import fleetrisk.llm.shingles as module

    seen = []
    monkeypatch.setattr(module, "fingerprint_pairs", lambda sets, bits: seen.append(bits) or fingerprint_pairs(sets, bits))
    near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count()
    assert seen == [4]


def test_links_of_fingerprints_are_kept(spark):
    """Texts that op4's rule links are one group, though their sets are less alike; so are those of any fingerprint of equal sets."""
    ring = lambda c, n: " ".join([f"{c}{i}" for i in range(13)] * n + [f"{c}{i}" for i in range(4)])
    tail = lambda c: " " + " ".join(f"{c}{i}" for i in range(20))
    # 0 and 1 are equal sets with other repeats; 2 and 3 are each close to one of them, 4 to neither.
    texts = [ring("a", 200) + " " + ring("b", 1), ring("a", 1) + " " + ring("b", 200), ring("a", 200) + tail("c"), ring("b", 200) + tail("d"), tail("e")]
    sets, fps = [shingles(t) for t in texts], [fingerprint(t, 5) for t in texts]
    close = lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4
    assert sets[0] == sets[1] and not close(0, 1) and close(0, 2) and close(1, 3)
    assert all(jaccard(a, b) < 0.8 for i, a in enumerate(sets[1:], 1) for b in sets[i + 1:])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in cp.drop_near_duplicates(spark, df, "").collect()} == {0, 4}
