"""Benchmark decontamination: exact hits of pieces, verified by bit-parallel edit distance."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of benchmark items that are searched for at once; more are searched in several passes.
BLOCK_CHARS = 4_000_000
_HIT = "item_id long, distance int, start int, end int"


def normalised(text: str | None) -> str:
    """Lower case, with one space for each run of white space and none at the ends."""
    return " ".join((text or "").lower().split())


def _best_end(text: str, at: int, to: int, masks: dict[str, int], size: int) -> tuple[int, int]:
    """Least edit distance of the pattern to a part of text[at:to] (Myers, 1999) and the last place where one ends."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score, best, end = full, 0, size, size, at
    for i in range(at, to):
        equal = masks.get(text[i], 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
        if score < best:
            best, end = score, i + 1
    return best, end


def _masks(pattern: str) -> dict[str, int]:
    masks = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    return dict(masks)


class Matcher:
    """Finds items within a share of edits in texts.

    An item with an error budget of k is split into k + 1 pieces: k edits leave one of them whole. All pieces of all
    items are looked for in one walk over the text. In a match, m neighbouring pieces that hold fewer than m errors split
    into two parts of which one again holds fewer errors than pieces; so of the pieces left whole there is one around
    which 2, 4 and 8 pieces, counted off from the first, match with fewer errors than pieces too. A hit is verified in
    these steps, which end nearly all chance hits early, and then as a whole.

    Items of fewer than short_chars characters would be found within longer words everywhere; they are searched for with the
    same share of edits, but must begin and end at the borders of words.
    """

    def __init__(self, items: list[tuple[int, str]], rate: float, short_chars: int):
        self.items, self.automaton, places = [], ahocorasick.Automaton(), defaultdict(list)
        for item_id, text in items:
            text = normalised(text)
            if not text:
                continue
            budget = int(len(text) * rate)
            cuts = [len(text) * i // (budget + 1) for i in range(budget + 2)]
            around = [[_Part(text, cuts, j - j % m, min(budget + 1, j - j % m + m)) for j in range(0, budget + 1, m)]
                      for m in (2, 4, 8) if m < budget + 1]
            for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
                steps = [parts[j // m] for parts, m in zip(around, (2, 4, 8))]
                places[text[a:b]].append((len(self.items), a, [p for p in steps if p.budget]))
            self.items.append((item_id, text, budget, _masks(text), _masks(text[::-1]), len(text) < short_chars))
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def __call__(self, text: str | None) -> list[dict]:
        """The best place of each item in a text: item_id, distance, and start and end in the normalised text."""
        if not self.items or not text:
            return []
        text, starts = normalised(text), defaultdict(set)
        for last, (size, where) in self.automaton.iter(text):
            for item, offset, steps in where:
                start = last + 1 - size - offset
                if start not in starts[item] and all(p.near(text, start) for p in steps):
                    starts[item].add(start)
        found = []
        for item, places in starts.items():
            item_id, pattern, budget, forward, backward, short = self.items[item]
            if short:
                best, start, end = _between_words(text, places, pattern, budget)
                if best <= budget:
                    found.append({"item_id": item_id, "distance": best, "start": start, "end": end})
                continue
            best, end = budget + 1, 0
            if (at := text.find(pattern)) >= 0 and places:
                best, end = 0, at + len(pattern)
            for at, to in _windows(sorted(places), len(pattern), budget, len(text)) if best else ():
                distance, stop = _best_end(text, at, to, forward, len(pattern))
                if distance < best:
                    best, end = distance, stop
            if best <= budget:
                around = text[max(0, end - len(pattern) - best):end][::-1]
                _, length = _best_end(around, 0, len(around), backward, len(pattern))
                found.append({"item_id": item_id, "distance": best, "start": end - length, "end": end})
        return found


def _between_words(text: str, starts: set[int], pattern: str, budget: int) -> tuple[int, int, int]:
    """The least distance of the pattern to a part of text near the places that begins and ends at borders of words, and that part."""
    def border(i: int) -> bool:
        return i in (0, len(text)) or 0 < i < len(text) and not (text[i - 1].isalnum() and text[i].isalnum())

    best = (budget + 1, 0, 0)
    for start in sorted({s for at in starts for s in range(max(0, at - budget), at + budget + 1)}):
        for end in range(start + len(pattern) - budget, min(len(text), start + len(pattern) + budget) + 1):
            if start < end and border(start) and border(end):
                best = min(best, (_distance(text[start:end], pattern), start, end))
    return best


def _distance(a: str, b: str) -> int:
    """The edit distance of two short strings."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


class _Part:
    """Neighbouring pieces of an item, and whether they are near their place with fewer errors than pieces."""

    def __init__(self, text: str, cuts: list[int], first: int, last: int):
        self.at, self.to, self.budget = cuts[first], cuts[last], last - first - 1
        self.masks = _masks(text[self.at:self.to])

    def near(self, text: str, start: int) -> bool:
        at, to = max(0, start + self.at - self.budget), min(len(text), start + self.to + self.budget)
        return to > at and _best_end(text, at, to, self.masks, self.to - self.at)[0] <= self.budget


def _windows(starts: list[int], size: int, budget: int, length: int) -> Iterator[tuple[int, int]]:
    """The parts of the text in which an item may lie that starts near one of the places; near ones are merged."""
    at = to = None
    for start in starts:
        a, b = max(0, start - budget), min(length, start + size + budget)
        if to is not None and a <= to - size // 2:
            to = b
            continue
        if to is not None:
            yield at, to
        at, to = a, b
    if to is not None:
        yield at, to


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The distinct items in blocks of about block_chars characters."""
    items = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL").distinct()
    total = items.agg(F.sum(F.char_length("t"))).first()[0] or 0
    parts = max(1, -(-total // block_chars))
    for n in range(parts):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == n).collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       rate: float = 0.1, short_chars: int = 20, item_id: str = "item_id", item_text: str = "text",
                       block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id_col, item_id, distance, start, end): each benchmark item found in each of docs, at its best place.

    An item is found where a part of the text has an edit distance of at most rate times its length, both in lower case
    and with runs of white space as one space; start and end are places in the text so normalised. Whole texts are
    searched. Items of fewer than short_chars characters then must begin and end at borders of words; empty and null
    ones are not looked for.
    Null and empty texts have none; repeated rows and items give repeated results; other columns are not looked at.

    The items are a stated query set: they go to every task, in blocks of bounded size, one pass over docs for each.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind, out = docs.schema[id_col].dataType.simpleString(), None
    for items in blocks(benchmark, item_id, item_text, block_chars):
        def search(batches: Iterator[pd.DataFrame], items=items) -> Iterator[pd.DataFrame]:
            match = Matcher(items, rate, short_chars)
            for batch in batches:
                found = [{"_id": i, **hit} for i, t in zip(batch["_id"], batch["_text"]) for hit in match(t)]
                yield pd.DataFrame(found, columns=["_id", "item_id", "distance", "start", "end"])

        hits = rows.mapInPandas(search, f"_id {kind}, {_HIT}")
        out = hits if out is None else out.unionByName(hits)
    return out.withColumnRenamed("_id", id_col)


def without_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rate: float = 0.1,
                          short_chars: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs without those in which find_contamination() finds an item."""
    for items in blocks(benchmark, "item_id", "text", block_chars):
        docs = docs.filter(~_contaminated(F.col(text_col), items, rate, short_chars))
    return docs


def _contaminated(text: Column, items: list[tuple[int, str]], rate: float, short_chars: int) -> Column:
    @F.pandas_udf("boolean")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        match = Matcher(items, rate, short_chars)
        for texts in batches:
            yield pd.Series([bool(match(t)) for t in texts], dtype="bool")

    return found(text)
