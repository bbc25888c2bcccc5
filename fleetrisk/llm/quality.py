"""Quality rules: counts per text, and boilerplate lines by their document frequency per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetrisk.llm.common import digest, lookup, lower_ascii, row_key, staged, stripped, words
from fleetrisk.llm.common import lines as text_lines

WINDOW = 3


def _let(value: Column, body) -> Column:
    """body(value) with value computed once; a plain column would be put into lambdas and computed for each element."""
    return F.transform(F.array(value), body)[0]


def repeated_words(tokens: Column) -> Column:
    """The words that lie in a window of three words found twice or more in the text, the first time included.

    The windows' hashes are sorted with their places; equal neighbours are the repeated ones. Their places in
    order then cover three words each, less where the next one begins earlier.
    """
    def hashed(w: Column) -> Column:
        last = F.size(w) - (WINDOW - 1)
        window = lambda i: F.struct(F.xxhash64(*[F.get(w, i + d) for d in range(WINDOW)]).alias("h"), i.alias("i"))
        return F.when(last > 1, F.sort_array(F.transform(F.sequence(F.lit(0), last - 1), window)))

    def places(s: Column) -> Column:
        same = lambda x, j: F.coalesce(x["h"] == F.get(s, j)["h"], F.lit(False))
        found = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        new = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    return F.coalesce(_let(_let(_let(tokens, hashed), places), covered), F.lit(0).cast("long"))


def text_counts(text: Column) -> dict[str, Column]:
    """The base counts of a text; null is an empty text."""
    text = F.coalesce(text, F.lit(""))
    tokens = words(text)
    worded = F.filter(F.split(text, "\n", -1), lambda line: stripped(line) != "")
    return {
        "n_words": F.size(tokens).cast("long"),
        "word_chars": F.char_length(F.array_join(tokens, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size(worded) - F.size(F.array_distinct(worded))).cast("long"),
        "n_repeat_words": repeated_words(tokens),
    }


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_docs: int = 10, min_left: float = 0.3, min_words: int = 50) -> DataFrame:
    """One row for each of docs: id_col, the base counts, n_lost_words, base_failed, depleted, kept, clean_text.

    A line is boilerplate where more than max_docs documents of its host have it; lines are compared without white
    space at the ends and with A-Z lower-cased, and lines without a word are none. A document is depleted if
    boilerplate lines hold more than 1 - min_left of its words. It fails the base rules with fewer than min_words words,
    or if more than half of them lie in repeated windows. It is kept if neither holds. clean_text is the text without
    its boilerplate lines, and as it is, null too, where it has none; n_lost_words are the words that it lacks.

    Every row is a document, repeated rows too. A null text is an empty one, which fails; a null host is a host of
    its own. Other columns are not looked at. Hosts and lines may be as frequent as they like: the counts are combined
    before they are shuffled, and lines with more than a thousandth of all are found by broadcast, see lookup().
    """
    id_, text, host = F.col(id_col), F.col(text_col), F.col(host_col)

    def key(host: Column, line: Column) -> Column:
        one, two = digest(host, lower_ascii(stripped(line)))
        return F.struct(one.alias("_h1"), two.alias("_h2"))

    worded = F.filter(text_lines(text), lambda line: stripped(line) != "")
    keys = F.array_distinct(F.transform(worded, lambda line: key(host, line)))
    found = docs.select(*row_key(id_, host, text), F.explode(keys).alias("_key"))
    found = staged(found.select("_k1", "_k2", "_key.*"), "host_lines")
    frequent = found.groupBy("_h1", "_h2").agg(F.count("*").alias("_docs")).filter(F.col("_docs") > max_docs)
    hit = lookup(found, staged(frequent, "boilerplate"), ["_h1", "_h2"], "_docs", "_k1", ["_docs"])
    lost = hit.filter(F.col("_docs").isNotNull()).groupBy("_k1", "_k2").agg(
        F.collect_set(F.struct("_h1", "_h2")).alias("_lost"))

    rows = docs.select(id_, *row_key(id_, host, text), *[c.alias(n) for n, c in text_counts(text).items()],
                       host.alias("_host"), text.alias("_text"))
    left = F.filter(text_lines(F.col("_text")), lambda line: ~F.array_contains("_lost", key(F.col("_host"), line)))
    clean = F.when(F.col("_lost").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n"))
    gone = F.when(F.col("_lost").isNotNull(), F.col("n_words") - F.size(words(F.col("clean_text")))).otherwise(0).cast("long")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = rows.join(lost, ["_k1", "_k2"], "left").select(id_, *text_counts(text), "_lost", clean.alias("clean_text"))
    out = out.select(id_, *text_counts(text), gone.alias("n_lost_words"), failed.alias("base_failed"), "clean_text")
    depleted = F.col("n_lost_words") > (1 - min_left) * F.col("n_words")
    out = out.withColumn("depleted", depleted).withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    return out.select(*[c for c in out.columns if c != "clean_text"], "clean_text")
