"""Near copies by close fingerprints, as op4 links them, and by the Jaccard similarity of their shingle sets, by an exact prefix-filter join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetrisk.llm.common import lookup, row_key, sieve, staged
from fleetrisk.llm.components import components
from fleetrisk.llm.simhash import SEED, _signed, _whole_groups, fingerprint_of, links as fingerprint_links

#: Documents in which frequent shingles are looked for, how many must have one, and how many shingles are kept.
SAMPLE, FREQUENT, MOST = 10_000, 5, 100_000
#: The largest count of a histogram's class.
FULL = 65_535
#: Sets of more shingles than this have a finer histogram as well, of at most so many classes (bytes).
COARSE, CLASSES = 500, 1 << 14


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    """The XXH64 of the shingles, repeats included; a text of fewer words is one shingle, one without a word has none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    whole, ends = b" ".join(found), np.cumsum([len(w) + 1 for w in found])
    starts, ends = np.concatenate(([0], ends[:-1])).tolist(), (ends - 1).tolist()
    size, digest = min(shingle_words, len(found)) - 1, xxhash.xxh64_intdigest
    return np.array([digest(whole[starts[i]:ends[i + size]], SEED) for i in range(len(found) - size)], np.uint64)


def shingle_set(text: str | None, shingle_words: int) -> np.ndarray:
    """The distinct hashes of the shingles, in order."""
    return np.unique(shingle_hashes(text, shingle_words).view(np.int64))


def prefix(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """The first shingles in an order that all sets share, frequent ones last: sets of that similarity have one of them in common.

    Of a set of n, at least ceil(n * percent / 100) are in a similar one, so one of the first n + 1 less that many is.
    """
    n = len(shingles)
    many = n + 1 + (-n * percent // 100) if n else 0
    keys, counts = frequent
    if len(keys) and n:
        at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
        rank = np.where(keys[at] == shingles, counts[at], 0)
        shingles = shingles[np.lexsort((shingles, rank))]
    return shingles[:many]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sets is percent / 100 or more, in whole numbers."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def frequent_shingles(rows: DataFrame, shingle_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many sampled texts and their counts; they only order the prefixes, so any sample gives the same links."""
    @F.pandas_udf("array<long>")
    def shingled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingle_set(t, shingle_words) for t in texts])

    parts = max(1, rows.count() // SAMPLE)
    sample = rows.filter(F.pmod("_k1", F.lit(parts)) == 0).select(F.explode(shingled("_text")).alias("_shingle"))
    counts = sample.groupBy("_shingle").count().filter(F.col("count") >= FREQUENT)
    found = counts.orderBy(F.desc("count"), "_shingle").limit(MOST).toPandas().sort_values("_shingle")
    return found["_shingle"].to_numpy(np.int64), found["count"].to_numpy(np.int64)


def histogram(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each of 64 classes by their last bits, up to FULL."""
    return np.minimum(np.bincount(shingles & 63, minlength=64), FULL).astype("<u2").tobytes()


def fine_histogram(shingles: np.ndarray) -> bytes:
    """How many shingles of a large set fall into each of its classes by their last bits, up to 255; nothing for small sets.

    There are four to eight shingles a class, up to CLASSES.
    """
    if len(shingles) <= COARSE:
        return b""
    classes = min(CLASSES, 1 << (len(shingles).bit_length() - 3))
    return np.minimum(np.bincount(shingles & (classes - 1), minlength=classes), 255).astype(np.uint8).tobytes()


def finely_similar(n: int, m: int, a: bytes, b: bytes, percent: int) -> bool:
    """Whether sets of n and m shingles can have the similarity, by what their finer histograms can share."""
    if not a or not b:
        return True
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if x.max() == 255 or y.max() == 255:
        return True
    # Classes by fewer last bits are sums of classes by more.
    classes = min(len(x), len(y))
    x, y = (h.reshape(-1, classes).sum(axis=0, dtype=np.int64) for h in (x, y))
    return (100 + percent) * int(np.minimum(x, y).sum()) >= percent * (n + m)


def _histograms(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, 64)


def may_be_similar(n: np.ndarray, m: np.ndarray, hist: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m shingles can have the similarity, by their sizes and by what their histograms can share.

    Two sets share at most the smaller count of each class; a full count stands for any larger one.
    """
    close = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    least = np.minimum(hist, other)
    both = np.where((least == FULL).any(axis=-1), np.minimum(n, m), least.sum(axis=-1, dtype=np.int64))
    return close & ((100 + percent) * both >= percent * (n + m))


#: Sets of groups up to this size are compared all at once, by the distance of their places.
_SMALL = 32


def _pairs_within(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The distinct pairs within the groups (_cell, _part) that may be similar and have different roots, larger set first.

    rows (_set, _n, _hist, root besides) are in the order of group and set.
    """
    cell, part, sets, n, root = (rows[c].to_numpy(np.int64) for c in ("_cell", "_part", "_set", "_n", "root"))
    hist, count = _histograms(rows["_hist"]), len(rows)
    starts = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]))))
    sizes = np.diff(np.append(starts, count))
    group = np.repeat(np.arange(len(starts)), sizes)
    small = sizes[group] <= _SMALL
    ours, theirs = [], []
    for step in range(1, min(_SMALL, count)):
        ours.append(np.flatnonzero(small[step:] & (group[step:] == group[:-step]) & (root[step:] != root[:-step])) + step)
        theirs.append(ours[-1] - step)
    for at, size in zip(starts[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
        for i in range(at + 1, at + size):
            close = 100 * np.minimum(n[at:i], n[i]) >= percent * np.maximum(n[at:i], n[i])
            theirs.append(np.flatnonzero(close & (root[at:i] != root[i])) + at)
            ours.append(np.full(len(theirs[-1]), i))
    nodes, others = [], []
    for i, j in zip(ours, theirs):
        passed = may_be_similar(n[i], n[j], hist[i], hist[j], percent)
        nodes.append(sets[i[passed]])
        others.append(sets[j[passed]])
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pd.DataFrame({"node": cat(nodes), "other": cat(others)}).drop_duplicates()


def rest_pairs(met: DataFrame, shapes: DataFrame, percent: int, block: int = 2_000) -> DataFrame:
    """The distinct pairs (node, other) of sets of different roots that meet in a group of met (_shingle, _set, root).

    Groups of the same sets are one. Only rows of groups that hold several roots get the sizes and histograms of shapes (_set, _n, _hist). A group of more than
    `block` sets is cut into parts by their names, and each two parts are compared in a task of their own.
    """
    names = [F.bit_xor(F.xxhash64(F.lit(i), "_set")).alias(f"_name{i}") for i in (1, 2)]
    sizes = met.groupBy("_shingle").agg(F.count("*").alias("_members"), F.min("root").alias("_low"), F.max("root").alias("_high"), *names)
    # Of the shingles of one passage, many are held by the same sets: one of them stands for all.
    alike = sizes.filter("_low <> _high").groupBy("_name1", "_name2", "_members").agg(F.min("_shingle").alias("_shingle"))
    open_ = staged(alike.select("_shingle", "_members"), "open_groups")
    rows = lookup(met, open_.withColumn("_all", F.col("_members")), ["_shingle"], "_members", "_set", ["_all"]).filter("_all IS NOT NULL")
    parts = F.ceil(F.col("_all") / block).cast("long")
    own = F.pmod(F.xxhash64("_set"), parts)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda p: F.least(p, own) * parts + F.greatest(p, own))
    # A set has no more rows in met than its prefix is long.
    dealt = rows.select(F.col("_shingle").alias("_cell"), F.explode(pairs).alias("_part"), "_set", "root").join(shapes, "_set")
    n = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "_cell", "_part").sortWithinPartitions("_cell", "_part", "_set")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            done, rest = _whole_groups(rest)
            if len(done):
                yield _pairs_within(done, percent)
        if rest is not None and len(rest):
            yield _pairs_within(rest, percent)

    return dealt.mapInPandas(compare, "node long, other long").distinct()


def finer(pairs: DataFrame, shapes: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (node, other) that pass by the finer histograms of shapes (_set, _n, _fine) too."""
    copies = pairs.groupBy("other").agg(F.count("*").alias("_copies"))
    known = copies.join(shapes.select(F.col("_set").alias("other"), F.struct("_n", "_fine").alias("_b")), "other")
    both = lookup(pairs, staged(known, "fine_leaders"), ["other"], "_copies", "node", ["_b"])
    both = both.join(shapes.select(F.col("_set").alias("node"), F.struct("_n", "_fine").alias("_a")), "node")
    flat = both.select("node", "other", F.col("_a._n").alias("_an"), F.col("_a._fine").alias("_af"), F.col("_b._n").alias("_bn"), F.col("_b._fine").alias("_bf"))

    def passed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            columns = zip(b["_an"].tolist(), b["_bn"].tolist(), b["_af"], b["_bf"])
            yield b.loc[[finely_similar(n, m, x, y, percent) for n, m, x, y in columns], ["node", "other"]]

    return flat.mapInPandas(passed, "node long, other long")


def verified(pairs: DataFrame, texts: DataFrame, shingle_words: int, percent: int, turn: int = 500) -> DataFrame:
    """Those of the distinct pairs (node, other) whose sets are similar, by the whole texts (_set, _text).

    The texts of all nodes stream past the text of their other one; that is copied for each `turn` of them, so a task holds
    two sets at a time and no text has all its partners in one task.
    """
    turns = pairs.groupBy("other").agg(F.ceil(F.count("*") / turn).cast("int").alias("_turns"), F.count("*").alias("_copies"))
    turns = staged(turns, "turns")
    dealt = lookup(pairs, turns, ["other"], "_copies", "node", ["_turns"])
    dealt = dealt.select("node", "other", F.pmod(F.xxhash64("node"), "_turns").cast("int").alias("_turn"))
    partners = dealt.join(texts, dealt["node"] == texts["_set"]).select("other", "_turn", "node", "_text")
    first = turns.select("other", F.explode(F.sequence(F.lit(0), F.col("_turns") - 1)).alias("_turn"))
    first = first.join(texts, first["other"] == texts["_set"]).select("other", "_turn", F.lit(None).cast("long").alias("node"), "_text")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = partners.unionByName(first).repartition(n, "other", "_turn").sortWithinPartitions("other", "_turn", F.asc_nulls_first("node"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            found = []
            for other, node, text in zip(batch["other"], batch["node"], batch["_text"]):
                shingles = shingle_set(text, shingle_words)
                if node is None:
                    held = shingles
                elif similar(held, shingles, percent):
                    found.append((int(node), other))
            yield pd.DataFrame(found, columns=["node", "other"], dtype="int64")

    # Names of sets are whole longs, which a double does not hold.
    rows = rows.select("other", F.col("node").cast("string").alias("node"), "_text")
    return rows.mapInPandas(check, "node long, other long")


def texts_of(pairs: DataFrame, sets: DataFrame, keyed: DataFrame) -> DataFrame:
    """(_set, _text): the texts of the sets that are in a pair, once each, of keyed (_k1, _k2, _text) by sets (_set, _k1, _k2).

    Most texts are in no pair, and a sieve keeps them out of the shuffle.
    """
    names = pairs.select(F.col("node").alias("_set")).union(pairs.select("other")).distinct()
    wanted = staged(sets.select("_set", "_k1", "_k2").join(names, "_set", "left_semi"), "wanted")
    maybe = sieve(wanted, "_k1")
    rows = keyed.filter(maybe("_k1")).select("_k1", "_k2", "_text").join(wanted, ["_k1", "_k2"])
    return staged(rows.select("_set", "_text").dropDuplicates(["_set"]), "texts")


def fingerprint_pairs(sets: DataFrame, bits: int) -> DataFrame:
    """Pairs (node, other) of sets (_set, _fp) that connect those whose fingerprints differ in at most `bits` bits, as op4 links them.

    Sets of one fingerprint are paired with the least of them, and the least ones of linked fingerprints with each other. A set
    may have several fingerprints.
    """
    least = staged(sets.groupBy("_fp").agg(F.min("_set").alias("_first"), F.count("*").alias("_copies")), "fingerprints")
    equal = lookup(sets, least.filter("_copies > 1"), ["_fp"], "_copies", "_set", ["_first"])
    equal = equal.filter("_set <> _first").select(F.col("_set").alias("node"), F.col("_first").alias("other"))
    linked = fingerprint_links(least.select("_fp"), bits)
    for end in ("node", "other"):
        linked = linked.join(least.select(F.col("_fp").alias(end), F.col("_first").alias(f"_{end}")), end)
    return equal.unionByName(linked.select(F.col("_node").alias("node"), F.col("_other").alias("other")))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                percent: int = 80, bits: int = 4) -> DataFrame:
    """One row for each of docs: _k1, _k2, id_col, and _root, which names its group of near copies.

    Texts are linked whose fingerprints differ in at most `bits` bits, as op4_simhash links them, and those whose sets of shingles
    have a Jaccard similarity of percent / 100 or more; groups are the components of all links. Case and white space do not
    count; texts without a word, null ones too, are one group. No group is torn: two similar sets have a shingle of their
    prefixes in common. Equal sets are joined before the search.

    The links of fingerprints come from the grid of op4_simhash and stand as they are: repeats count there, which a set does
    not know. At the similarity asked for most pairs differ in more bits, so prefixes of the sets find those, which are verified. All sets that share a shingle of their prefixes are first compared with the least of them, so that
    copies, however many, are joined by one comparison each. What then still meets under different roots is filtered by
    sizes and histograms, finer ones for large sets, pair by pair within the shingle's group, and compared by whole texts. No set carries its text
    into a group, and groups of unlike sets that only share a passage end at the filter.
    """
    keyed = docs.select(*row_key(F.col(id_col), F.col(text_col)), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    frequent = frequent_shingles(keyed, shingle_words)

    @F.pandas_udf("set long, n int, hist binary, fine binary, first array<long>, fp long")
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets, fps = [], []
            for text in texts:
                hashes = shingle_hashes(text, shingle_words)
                sets.append(np.unique(hashes.view(np.int64)))
                fps.append(_signed(fingerprint_of(hashes)))
            names = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            yield pd.DataFrame({"set": names, "n": [len(s) for s in sets], "hist": [histogram(s) for s in sets],
                                "fine": [fine_histogram(s) for s in sets],
                                "first": [prefix(s, frequent, percent) for s in sets], "fp": np.array(fps, np.int64)})

    rows = keyed.withColumn("_d", described("_text")).select(
        "_k1", "_k2", "_id", F.col("_d.set").alias("_set"), F.col("_d.n").alias("_n"), F.col("_d.hist").alias("_hist"),
        F.col("_d.fine").alias("_fine"), F.col("_d.first").alias("_first"), F.col("_d.fp").alias("_fp"))
    rows = staged(rows, "shingle_sets")
    one = F.min(F.struct("_k1", "_k2", "_n", "_hist", "_fine", "_first")).alias("_one")
    sets = staged(rows.groupBy("_set").agg(one, F.count("*").alias("_copies")).select("_set", "_copies", "_one.*"), "distinct_sets")

    firsts = sets.select("_set", F.explode("_first").alias("_shingle"))
    shared = firsts.groupBy("_shingle").agg(F.min("_set").alias("_least"), F.count("*").alias("_sets")).filter("_sets > 1")
    met = lookup(firsts, staged(shared, "shared"), ["_shingle"], "_sets", "_set", ["_least", "_sets"]).filter("_least IS NOT NULL")
    met = staged(met, "met")
    shapes, fine = sets.select("_set", "_n", "_hist"), sets.select("_set", "_n", "_fine")

    def possible(pairs: DataFrame) -> DataFrame:
        """The pairs that pass the filter; _least is a hot key where a shingle is frequent, and looked up as such."""
        copies = pairs.groupBy("other").agg(F.count("*").alias("_copies"))
        known = copies.join(shapes.select(F.col("_set").alias("other"), F.struct("_n", "_hist").alias("_b")), "other")
        both = lookup(pairs, staged(known, "leaders"), ["other"], "_copies", "node", ["_b"])
        both = both.join(shapes.select(F.col("_set").alias("node"), F.struct("_n", "_hist").alias("_a")), "node")

        def passed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                a, b_ = b["_an"].to_numpy(np.int64), b["_bn"].to_numpy(np.int64)
                yield b.loc[may_be_similar(a, b_, _histograms(b["_ah"]), _histograms(b["_bh"]), percent), ["node", "other"]]

        flat = both.select("node", "other", F.col("_a._n").alias("_an"), F.col("_a._hist").alias("_ah"), F.col("_b._n").alias("_bn"), F.col("_b._hist").alias("_bh"))
        return flat.mapInPandas(passed, "node long, other long")

    stars = met.filter("_set <> _least").select(F.col("_set").alias("node"), F.col("_least").alias("other")).distinct()
    pairs = staged(finer(staged(possible(stars), "star_pairs"), fine, percent), "fine_star_pairs")
    # A text's own repeats may part fingerprints of equal sets: each of them is linked.
    alike = fingerprint_pairs(rows.select("_set", "_fp").distinct(), bits)
    links = staged(verified(pairs, texts_of(pairs, sets, keyed), shingle_words, percent).unionByName(alike), "star_links")
    roots = components(links).withColumnRenamed("node", "_set")
    rooted = sets.select("_set").join(roots, "_set", "left").withColumn("root", F.coalesce("root", "_set"))
    rest = met.select("_shingle", "_set").join(rooted, "_set")
    pairs = staged(rest_pairs(staged(rest, "rest"), shapes, percent), "rest_pairs")
    pairs = staged(finer(pairs, fine, percent), "fine_rest_pairs")
    more = verified(pairs, texts_of(pairs, sets, keyed), shingle_words, percent)
    linked = components(links.unionByName(more)).select(F.col("node").alias("_set"), "root")
    known = sets.select("_set", "_copies").join(linked, "_set", "left").withColumn("root", F.coalesce("root", "_set"))
    found = lookup(rows.select("_k1", "_k2", "_id", "_set"), staged(known, "known_sets"), ["_set"], "_copies", "_k1", ["root"])
    return found.select("_k1", "_k2", F.col("_id").alias(id_col), F.col("root").alias("_root"))
