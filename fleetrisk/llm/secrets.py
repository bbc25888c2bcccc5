"""Secret scans: fixed patterns, and windows of high entropy in strings that look like keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans of the same start are listed; the last is found by entropy.
KINDS = ["assign", "access", "hex", "entropy"]

# The patterns of the base rules. The runs of access and hex keys are matched with their least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE_CHARS = 12
ACCESS = "AKIA[A-Z0-9]{14,}+"
HEX = "[0-9a-f]{16,}+"

#: Candidates of the entropy rule, and the characters counted in them.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}+"

#: Bits per character that a window needs, by the first class whose pattern the candidate matches.
CLASSES = [("digits", "^[0-9]+$", 3.1), ("hex", "^[0-9a-fA-F]+$", 3.2), ("letters", "^[A-Za-z]+$", 4.1),
           ("mixed", "", 3.7)]

#: Candidates that are no secrets as a whole: UUIDs.
ALLOWED = r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
#: Parts that are none: samples, placeholders, counted-up characters, eight of one character. Windows that overlap one don't count.
ALLOWED_PARTS = r"(?i)example|sample|placeholder|changeme|your[_-]|0123456789|1234567890|abcdefgh|(.)\1{7}"

_BLOCK = 256
_ZERO = 65


def _let(value: Column, body) -> Column:
    """body(value) with value computed once; a plain column would be put into lambdas and computed for each element."""
    return F.transform(F.array(value), body)[0]


def _sums(xs: Column, start: Column) -> Column:
    """start, start + x1, start + x1 + x2 and so on."""
    return F.aggregate(xs, F.array(start), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))


def _starts(lengths: Column) -> Column:
    """Where each of the lengths starts when they are laid end to end; summed in blocks, as arrays grow by copying."""
    def blocked(xs: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(xs) / _BLOCK).cast("int")),
                             lambda b: F.slice(xs, b * _BLOCK + 1, _BLOCK))
        return _let(blocks, lambda bs: F.flatten(F.zip_with(
            bs, _sums(F.transform(bs, _total), F.lit(0)), lambda b, s: _sums(F.coalesce(b, F.array().cast("array<int>")), s))))

    return _let(lengths, blocked)


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches of a pattern that matches no empty string: start, end, and the text of a group.

    The text is cut at the matches; the lengths of the pieces and matches, laid end to end, give the places.
    """
    p = F.lit(pattern)
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def located(parts: Column) -> Column:
        whole, found, pieces = parts["whole"], parts["found"], parts["pieces"]
        both = F.flatten(F.zip_with(pieces, whole, lambda a, m: F.array(F.char_length(a), F.coalesce(F.char_length(m), F.lit(0)))))
        return _let(_starts(both), lambda at: F.transform(whole, lambda m, i: F.struct(
            F.get(at, 2 * i + 1).alias("start"), (F.get(at, 2 * i + 1) + F.char_length(m)).alias("end"),
            F.get(found, i).alias("found"))))

    parts = F.struct(F.regexp_extract_all(text, p, F.lit(0)).alias("whole"),
                     F.regexp_extract_all(text, p, F.lit(group)).alias("found"),
                     F.split(text, pattern, -1).alias("pieces"))
    return F.when(F.rlike(text, p), _let(parts, located)).otherwise(none)


def _spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))


def _flagged(candidate: Column, window: int, parts: Column) -> Column:
    """First and last place where a window of high entropy ends that overlaps none of the parts; first is null if there is none.

    A window's entropy is log2(window) - sum(c log2 c) / window over the counts c of its characters. The counts are
    kept in a string, one character for each symbol; each step changes two of them and the sum by
    their terms, which are whole millionths, so nothing drifts.
    """
    terms = F.array(*[F.lit(round(c * math.log2(c) * 1e6) if c else 0).cast("long") for c in range(window + 2)])
    most = F.lit(None).cast("long")
    for _, pattern, bits in reversed(CLASSES):
        limit = F.lit(int((math.log2(window) - bits) * window * 1e6)).cast("long")
        most = F.when(F.rlike(candidate, F.lit(pattern)), limit).otherwise(most) if pattern else limit

    def count(counts: Column, symbol: Column) -> Column:
        return F.ascii(F.substring(counts, F.instr(F.lit(ALPHABET), symbol), F.lit(1))) - _ZERO

    def changed(state: Column, symbol: Column, by: int) -> Column:
        def put(now: Column) -> Column:
            counts = F.overlay(state["counts"], F.char(now + (_ZERO + by)), F.instr(F.lit(ALPHABET), symbol), F.lit(1))
            total = state["total"] + F.get(terms, now + by) - F.get(terms, now)
            return F.struct(counts.alias("counts"), total.alias("total"))

        return _let(count(state["counts"], symbol), put)

    def scan(chars: Column, limit: Column, parts: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            moved = _let(changed(a["window"], F.get(chars, i), 1),
                         lambda w: F.when(i >= window, changed(w, F.get(chars, i - window), -1)).otherwise(w))
            free = ~F.exists(parts, lambda p: (p["start"] <= i) & (p["end"] > i - (window - 1)))
            return _let(moved, lambda w: _let((i >= window - 1) & (w["total"] <= limit) & free, lambda high: F.struct(
                w.alias("window"), F.when(high & a["first"].isNull(), i).otherwise(a["first"]).alias("first"),
                F.when(high, i).otherwise(a["last"]).alias("last"))))

        empty = F.struct(F.lit(chr(_ZERO) * len(ALPHABET)).alias("counts"), F.lit(0).cast("long").alias("total"))
        start = F.struct(empty.alias("window"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
        done = F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, step)
        return _let(done, lambda d: F.struct(d["first"].alias("first"), d["last"].alias("last")))

    return _let(F.struct(F.split(candidate, "").alias("chars"), most.alias("limit"), parts.alias("parts")),
                lambda c: scan(c["chars"], c["limit"], c["parts"]))


def entropy_spans(text: Column, base: Column, window: int, allowed: str, allowed_parts: str) -> Column:
    """Spans of candidate strings from the first to the last window of high entropy.

    Left out are candidates that the allow-list matches and those that lie within a span of the base rules. Where a
    part of one is allowed, windows that overlap it don't count.
    """
    def kept(c: Column) -> Column:
        within = F.exists(base, lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"]))
        return ~within & ~F.rlike(c["found"], F.lit(allowed))

    flagged = F.transform(F.filter(matches(text, CANDIDATE % window), kept), lambda c: F.struct(
        c["start"].alias("start"), _flagged(c["found"], window, matches(c["found"], allowed_parts)).alias("at")))
    return F.transform(F.filter(flagged, lambda f: f["at"]["first"].isNotNull()), lambda f: F.struct(
        (f["start"] + f["at"]["first"] - (window - 1)).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"),
        (f["start"] + f["at"]["last"] + 1).alias("end")))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, text_col: str = "text", window: int = 20, allowed: str = ALLOWED,
                 allowed_parts: str = ALLOWED_PARTS) -> DataFrame:
    """docs with base_spans and secret_spans: arrays of (start, kind, end) in code points, in order.

    kind is a place in KINDS. base_spans has the matches of the fixed patterns, secret_spans also those of high
    entropy. A null or empty text has none. Columns of these names are replaced. Each text is scanned whole and by
    itself, so there is no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.char_length(m["found"]) >= ASSIGN_VALUE_CHARS)
    base = F.sort_array(F.concat(_spans(assign, "assign"), _spans(matches(text, ACCESS), "access"),
                                 _spans(matches(text, HEX), "hex")))
    more = lambda b: F.struct(b.alias("base"), F.sort_array(F.concat(b, entropy_spans(text, b, window, allowed, allowed_parts))).alias("all"))
    return docs.withColumn("_found", _let(base, more)).withColumns({
        "base_spans": F.col("_found.base"), "secret_spans": F.col("_found.all")}).drop("_found")
