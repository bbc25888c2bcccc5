"""Source divergence audit: how a source's terms differ from its language's, over terms found by iceberg prefix refinement."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from operator import itemgetter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.llm.common import staged

#: Bytes of the first level's prefixes; each level doubles them. Shorter ones begin terms of nearly all documents and part nothing.
FIRST_BYTES = 8
#: Bits of the map of live prefixes that goes to every task: 2 MB, whatever the number of prefixes.
MAP_BITS = 1 << 24
#: Counters that a task holds before it passes them on.
HELD = 300_000
#: Bytes of texts of a group that are cut into terms at once.
JOINED = 1 << 19
#: Sources of a language that are compared with all others in one block.
SOURCES = 128

# Bytes of terms are letters and all bytes of characters beyond ASCII; the others part terms.
_PARTED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in order, A-Z lower-cased."""
    return bytes(text or b"").translate(_PARTED).split()


def _seeds(lang: str) -> tuple[int, int]:
    """Where the hashes of a language's whole terms and of its prefixes begin."""
    start = crc32(lang.encode("utf-8", "surrogatepass"))
    return start, crc32(b"+", start)


def _bit(lang: str, key: bytes, prefix: bool) -> int:
    return crc32(key, _seeds(lang)[prefix]) % MAP_BITS


class _Alive:
    """Which terms of a language may be live, by the map of bits."""

    def __init__(self, bits: bytes | None):
        self.bits, self.seeds = bits, {}

    def _seed(self, lang: str, prefix: bool) -> int:
        if lang not in self.seeds:
            self.seeds[lang] = _seeds(lang)
        return self.seeds[lang][prefix]

    def by_prefix(self, lang: str, found: list[bytes], size: int) -> set[bytes] | list[bytes]:
        """The terms of more than `size` bytes whose prefix of one byte more is live; any term if there is no map yet."""
        if self.bits is None:
            return found
        bits, seed, last, end = self.bits, self._seed(lang, True), MAP_BITS - 1, size + 1
        return [t for t in {t for t in found if len(t) > size} if bits[(h := crc32(t[:end], seed) & last) >> 3] >> (h & 7) & 1]

    def whole(self, lang: str, found: Counter) -> dict[bytes, int]:
        """The counts of terms that are live as a whole."""
        bits, seed, last = self.bits, self._seed(lang, False), MAP_BITS - 1
        return {t: n for t, n in found.items() if bits[(h := crc32(t, seed) & last) >> 3] >> (h & 7) & 1}


def _flushed(counts: dict, columns: list[str]) -> pa.RecordBatch:
    """The counts held so far, as rows; they begin anew."""
    joined = lambda arrays, kind: pa.concat_arrays([pa.array([], kind), *arrays])
    parts = [joined([pa.repeat(pa.scalar(group[i], pa.string()), len(c)) for group, c in counts.items()], pa.string()) for i in range(len(columns) - 2)]
    parts.append(joined([pa.array(list(c), pa.binary()) for c in counts.values()], pa.binary()))
    parts.append(joined([pa.array(list(c.values()), pa.int64()) for c in counts.values()], pa.int64()))
    counts.clear()
    return pa.RecordBatch.from_arrays(parts, columns)


def _level(docs: DataFrame, bits: bytes | None, before: int, size: int) -> DataFrame:
    """Documents for each (lang, key) of this level: terms of up to `size` bytes, and of longer ones the first `size` + 1.

    Only terms whose prefix of `before` + 1 bytes is live count. Each document counts once for a key, and tasks pass on
    sums, not single occurrences.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alive, counts, key = _Alive(shared.value), defaultdict(Counter), itemgetter(slice(size + 1))
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = counts[(lang,)]
                own.update(set(map(key, alive.by_prefix(lang, terms(text), before))))
                if len(own) > HELD:
                    yield _flushed(counts, ["lang", "key", "n"])
        yield _flushed(counts, ["lang", "key", "n"])

    return docs.select("lang", "text").mapInArrow(count, "lang string, key binary, n long").groupBy("lang", "key").agg(
        F.sum("n").alias("n"))


def _map(live: DataFrame, prefix: bool) -> bytes:
    """The map of bits of the keys (lang, key), prefixes or whole terms; the driver gets MAP_BITS / 64 words at most."""
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = np.array([_bit(lang, bytes(key), prefix) for lang, key in zip(batch["lang"], batch["key"])], np.int64)
            yield pd.DataFrame({"word": bits >> 6, "bits": np.left_shift(np.uint64(1), (bits & 63).astype(np.uint64)).view(np.int64)})

    words = live.select("lang", "key").mapInPandas(hashed, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out, found = np.zeros(MAP_BITS >> 6, "<u8"), words.toPandas()
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out.tobytes()


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term): the terms in at least least_docs of a language's docs (lang string, text binary).

    A key of a level that is longer than its terms may be is a prefix. Prefixes of terms are counted by documents, level by level. A prefix of too few documents cannot begin a term of enough,
    so its terms are left out of all further levels; a term is kept when a level counts it whole. The live prefixes
    go to the tasks as a map of bits of fixed size: a prefix that shares its bit with a live one is counted
    once more, exactly, and then discarded, so a full map costs time and changes nothing.
    """
    kept, bits, before, size = None, None, 0, FIRST_BYTES
    while True:
        level = staged(_level(docs, bits, before, size).filter(F.col("n") >= least_docs), f"level_{size}")
        longer = F.octet_length("key") > size
        whole, live = level.filter(~longer).select("lang", F.col("key").alias("term")), level.filter(longer)
        kept = whole if kept is None else kept.unionByName(whole)
        if live.isEmpty():
            return kept
        bits, before, size = _map(live, True), size, size * 2


def occurrences(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, count): how often each source of docs (lang, source, text binary) has each kept term."""
    shared = docs.sparkSession.sparkContext.broadcast(_map(kept.withColumnRenamed("term", "key"), False))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alive, counts, columns = _Alive(shared.value), defaultdict(Counter), ["lang", "source", "term", "count"]
        held = 0

        def live() -> pa.RecordBatch:
            # Terms are looked up once for all their occurrences in the texts held.
            kept = {group: alive.whole(group[0], c) for group, c in counts.items()}
            counts.clear()
            return _flushed(kept, columns)

        def add(group: tuple[str, str], texts: list[bytes]) -> int:
            own = counts[group]
            before = len(own)
            own.update(terms(b" ".join(texts)))
            return len(own) - before

        for batch in batches:
            # Texts of a group are cut together, so that its counts are at hand.
            waiting, sizes = defaultdict(list), Counter()
            for *group, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                group = tuple(group)
                waiting[group].append(text)
                sizes[group] += len(text)
                if sizes[group] > JOINED:
                    held += add(group, waiting.pop(group))
                    del sizes[group]
                    if held > 2 * HELD:
                        yield live()
                        held = 0
            for group, texts in waiting.items():
                held += add(group, texts)
                if held > 2 * HELD:
                    yield live()
                    held = 0
        yield live()

    found = docs.mapInArrow(count, "lang string, source string, term binary, count long")
    found = found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"))
    return found.join(kept, ["lang", "term"], "left_semi")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)), in whole numbers beyond a long."""
    wide = lambda c: c.cast("decimal(25,0)")
    return 1 + F.call_function("div", wide(F.lit(1_000_000_000) * wide(count + 2)), wide(total + 2 * terms))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(dense: DataFrame) -> DataFrame:
    """(lang, at, other, value): for each two of a language's sources the sum over its terms of their distances.

    dense has a row for each term: lang, and the shares p of all its sources, in order. A task adds up the terms it holds
    for a block of SOURCES sources against all, so what it holds and passes on grows with the sources, not with the terms.
    """
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.size("p") - 1) / SOURCES).cast("int")))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for (lang, block), group in batch.groupby(["lang", "block"], sort=False):
                p = np.stack(group["p"].tolist()).astype(np.int64)
                first = block * SOURCES
                for at in range(first, min(first + SOURCES, p.shape[1])):
                    q = p[:, at:at + 1]
                    value = ((p - q) * (p - q) // (p + q)).sum(axis=0)
                    sums[lang, at] = sums[lang, at] + value if (lang, at) in sums else value
        rows = [(lang, at, value.tolist()) for (lang, at), value in sums.items()]
        yield pd.DataFrame(rows, columns=["lang", "at", "values"])

    parts = dense.select("lang", "p", blocks.alias("block")).mapInPandas(add, "lang string, at int, values array<long>")
    return parts.select("lang", "at", F.posexplode("values").alias("other", "value")).groupBy("lang", "at", "other").agg(
        F.sum("value").alias("value"))


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               least_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source's terms are from other sources' and its language's.

    Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased; a language keeps those in at least
    least_docs of its documents (rows). Part `pair` has each other source of the language, part `term` the `top` terms that
    the source has more often than the language. All sums are of whole numbers, so they don't depend on any order.

    Null texts, languages and sources count as empty; a document without terms still has its source listed, repeated
    rows are documents of their own, and a text's length only takes time. An empty table gives an empty result; other
    columns are not looked at.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), empty(text_col).cast("binary").alias("text"))
    kept = staged(kept_terms(rows, least_docs), "kept_terms")
    counts = staged(occurrences(rows, kept), "occurrences")

    # One row for each source of a language, as many as the result has at least.
    named = rows.select("lang", "source").distinct()
    named = named.join(counts.groupBy("lang", "source").agg(F.sum("count").alias("total")), ["lang", "source"], "left")
    named = named.join(kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left").fillna(0, ["total", "terms"])
    sources = staged(named, "sources")
    langs = sources.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.first("terms").alias("terms"), F.array_sort(
        F.collect_list(F.struct("source", "total"))).alias("sources"))
    langs = staged(langs, "langs")

    # Terms of a language by the sources that have them: at most as many entries as it has sources.
    held = counts.groupBy("lang", "term").agg(F.map_from_entries(F.collect_list(F.struct("source", "count"))).alias("held"),
                                              F.sum("count").alias("lang_count"))
    rated = held.join(langs, "lang").select(
        "lang", "term", "held", _share(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("q"), F.transform("sources", lambda s: _share(
            F.coalesce(F.element_at("held", s["source"]), F.lit(0)), s["total"], F.col("terms"))).alias("p"),
        F.transform("sources", lambda s: s["source"]).alias("names"))
    rated = staged(rated, "rated")

    of_lang = langs.select("lang", F.transform("sources", lambda s: s["source"]).alias("names"))
    each = of_lang.select("lang", "names", F.posexplode("names").alias("at", "source"))
    each = each.select("lang", "at", "source", F.posexplode("names").alias("other", "item")).filter("at <> other")
    pairs = each.join(_pairs(rated.select("lang", "p")), ["lang", "at", "other"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))

    rated = rated.withColumn("n", F.transform("names", lambda s: F.element_at("held", s)))
    had = rated.select("lang", "term", "q", F.explode(F.arrays_zip("names", "p", "n")).alias("s"))
    had = had.filter((F.col("s.n") > 0) & (F.col("s.p") > F.col("q")))
    telling = had.select("lang", F.col("s.names").alias("source"), F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
                         _apart(F.col("s.p"), F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(telling).filter(F.col("rank") <= top))
