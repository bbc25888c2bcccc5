"""Toxicity: a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents that the model is fitted on, at most, for each class; the first by a hash of their ids.
TOXIC_DOCS, CLEAN_DOCS = 1_500, 3_000
#: Documents of more characters are not among those.
FIT_CHARS = 20_000
LANDMARKS = 96
#: Decay of a subsequence for each character that it spans, and the most characters that it may span.
DECAY, SPAN = 0.7, 7
#: Strings are looked at in windows of this many characters, each half over the next.
WINDOW = 24
#: Strings whose decision values a task remembers; then it starts anew.
MEMO = 300_000
#: What the errors of all toxic strings may cost next to the squared length of the weights; clean ones three times as much.
C = 10_000.0
#: How much more frequent a string is in toxic texts to be taken for toxic.
TELLING = 10
#: Its bags times the logarithm of that ratio must reach this, and this share of the most telling string's.
CLEAR, SHARE = 10.0, 0.1
#: The most telling strings, of which misspelled copies are learned too.
VARIED = 60

# Characters that are written for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

#: Begins the unit of a family of words; no word and no spelled string has it.
FAMILY = "\n"
#: Letters that the words of a family begin with.
STEM = 5
#: Subsequences of three letters, and those of families, which have weights of their own.
_OWN = 32**3
_SIZE = 2 * _OWN
_MARKS = ".,;:!?\"'()[]*-"

_SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_PAIRS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def _letters() -> np.ndarray:
    """1 to 26 for the code points of letters, accents folded, and of lookalikes; 0 for anything else."""
    table = np.zeros(0x250, np.uint16)
    for code in range(len(table)):
        c = unicodedata.normalize("NFD", LOOKALIKES.get(chr(code), chr(code)).lower())[0]
        if "a" <= c <= "z":
            table[code] = ord(c) - 96
    return table


_TABLE = _letters()


def units(text: str | None) -> set[str]:
    """The strings of a text that are scored: its words, runs of three or more single characters, and families.

    A family is a beginning that several longer words of the text share: one inflected word, of which each form may be rare.
    """
    text = (text or "").lower()
    words = set(text.split())
    stems = Counter([w[:STEM] for w in {w.strip(_MARKS) for w in words if len(w) > STEM} if len(w) > STEM])
    return {*words, *_SPELLED.findall(text), *[FAMILY + s for s, n in stems.items() if n > 1]}


def _coded(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the strings' windows, and which string each window is of.

    Letters of families are 32 higher, and accents and other alphabets are not folded there but letters of their own.
    """
    parts, owner = [], []
    for n, s in enumerate(strings):
        if len(s) <= WINDOW:
            parts.append(s.ljust(WINDOW))
            owner.append(n)
        else:
            for at in range(0, len(s) - WINDOW // 2, WINDOW // 2):
                parts.append(s[at:at + WINDOW].ljust(WINDOW))
                owner.append(n)
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, WINDOW)
    codes = np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], 0)
    family = points[:, :1] == ord(FAMILY)
    own = np.where(points < 128, codes, 27 + points % 5)
    return np.where(family & (own > 0), own + 32, np.where(family, 0, codes)).astype(np.uint16), np.array(owner, np.int64)


def _place(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the weights of each row's subsequences begin, and the rows' letters as 1 to 31."""
    return np.where(codes.max(axis=-1, keepdims=True, initial=0) > 32, _OWN, 0).astype(np.int32), codes & 31


def _products(codes: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The inner product of each row's subsequences with each weight vector, and the rows' norms.

    A row's features are its subsequences of three letters, each with DECAY to the power of its span for every
    place it has. The norm leaves out that one may have several places, which keeps the kernel a kernel: it is
    divided by a positive function of either string.
    """
    out = np.zeros((len(codes), len(weights)))
    norm = np.zeros(len(codes))
    start, codes = _place(codes)
    for a, b in _PAIRS:
        first, middle, last = codes[:, :-b], codes[:, a:WINDOW - b + a], codes[:, b:]
        place = (first.astype(np.int32) * 32 + middle) * 32 + last + start
        norm += ((first > 0) & (middle > 0) & (last > 0)).sum(axis=1) * DECAY ** (2 * (b + 1))
        for m, w in enumerate(weights):
            out[:, m] += w[place].sum(axis=1) * DECAY ** (b + 1)
    return out, np.sqrt(np.maximum(norm, 1e-12))


def _features(codes: np.ndarray) -> np.ndarray:
    """A row's features as a dense vector, divided by its norm."""
    out = np.zeros(_SIZE)
    norm = max(1e-12, _products(codes[None], [])[1][0])
    start, codes = _place(codes)
    for a, b in _PAIRS:
        first, middle, last = codes[:-b].astype(np.int32), codes[a:WINDOW - b + a], codes[b:]
        held = (first > 0) & (middle > 0) & (last > 0)
        np.add.at(out, ((first * 32 + middle) * 32 + last + start)[held], DECAY ** (b + 1))
    return out / norm


class Model:
    """Decision values of strings, and probabilities of texts by their highest one.

    The decision is linear in the kernel with the landmarks, and the kernel in the features, so the landmarks and
    their coefficients are one weight for each subsequence.
    """

    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift
        self.memo: dict[str, float] = {}

    def decisions(self, strings: list[str]) -> np.ndarray:
        best = np.full(len(strings), self.bias)
        for at in range(0, len(strings), 20_000):
            codes, owner = _coded(strings[at:at + 20_000])
            if len(codes):
                product, norm = _products(codes, [self.weights])
                np.maximum.at(best, owner + at, product[:, 0] / norm + self.bias)
        return best

    def highest(self, bags: list[set[str]]) -> np.ndarray:
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list({u for bag in bags for u in bag if u not in self.memo})
        self.memo.update(zip(new, self.decisions(new).tolist()))
        value = self.memo.__getitem__
        return np.array([max(map(value, bag), default=self.bias) for bag in bags])

    def probabilities(self, bags: list[set[str]]) -> np.ndarray:
        """Beyond the margin a string is not more toxic."""
        high = np.clip(self.highest(bags), -1.0, 1.5)
        return 1 / (1 + np.exp(-np.clip(self.slope * high + self.shift, -500, 500)))


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps; c weighs the examples."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x1.shape[1]), np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        active = y * (x1 @ w) < 1
        xa = x1[active] * c[active, None]
        new = np.linalg.solve(ridge + xa.T @ x1[active], xa.T @ y[active])
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w[:-1], float(w[-1])


def _platt(f: np.ndarray, y: np.ndarray, c: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through weighted outcomes, by damped Newton steps."""
    x, w = np.column_stack([f, np.ones(len(f))]), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (c * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (c * (y - p)) - 1e-6 * w)
        w = w + step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
    return float(w[0]), float(w[1])


def _landmarks(strings: list[str], most: int, marks: list[str], vectors: list[np.ndarray]) -> tuple[list, list]:
    """marks and vectors with the first of the strings added that are not much like one of them."""
    for s in (s[:WINDOW] for s in strings[:6 * most]):
        if len(marks) >= most:
            break
        codes = _coded([s])[0]
        if (codes > 0).sum() >= 3:
            v = _features(codes[0])
            if all(v @ u <= 0.9 * np.sqrt((u @ u) * (v @ v)) for u in vectors):
                marks, vectors = [*marks, s], [*vectors, v]
    return marks, vectors


def _variants(string: str) -> list[str]:
    """A string, the string with a character inserted at each inner place, and the string spelled out.

    Families have no spellings; each is repeated, so that it weighs as much as a word of its length.
    """
    if string.startswith(FAMILY):
        return [string] * (2 * len(string))
    inner = range(1, len(string)) if len(string) < WINDOW // 2 else ()
    return [string] + [string[:i] + c + string[i:] for i in inner for c in "*x"] + ([" ".join(string)] if inner else [])


def _distinct(bags: list[set[str]]) -> list[int]:
    """The places of bags that don't share half of their strings with an earlier one found by one of four least hashes."""
    kept, seen, hashes = [], defaultdict(list), {}
    for n, bag in enumerate(bags):
        values = np.array([hashes.setdefault(u, hash_of(u)) for u in bag], np.uint64)
        keys = [(i, int((values * np.uint64(f)).min())) for i, f in enumerate((1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F,
                                                                            0x165667B19E3779F9))] if bag else []
        near = {m for k in keys for m in seen[k]}
        if all(len(bag & bags[m]) * 2 < len(bag | bags[m]) for m in near):
            kept.append(n)
            for k in keys:
                seen[k].append(n)
    return kept


def fit(bags: list[set[str]], toxic: list[int], shares: tuple[float, float]) -> Model:
    """Fits the model to labelled bags of strings: a toxic bag has a toxic string, a clean one has none.

    The toxic strings are those that TELLING times as many toxic bags as clean ones have, by a clear margin, or the most
    telling one of each toxic bag if there are none.
    Bags without any may be labelled wrongly and teach nothing. Each comes with copies into which a
    character is inserted or that are spelled out. Clean bags give their most frequent strings, others by hash,
    and in each round the highest. Landmarks are the most telling strings and as many clean ones, none much like another.
    shares are the rows that a clean and a toxic bag stand for. Near copies of a bag count once, so that a
    wrong label that many copies share isn't believed.
    """
    alone = _distinct(bags)
    bags, toxic = [bags[n] for n in alone], [toxic[n] for n in alone]
    y = np.array(toxic)
    if len(set(toxic)) < 2:
        sure = 30.0 if toxic and toxic[0] else -30.0
        return Model(np.zeros(_SIZE), 0.0, 0.0, sure)
    pos, neg = [b for b, t in zip(bags, toxic) if t], [b for b, t in zip(bags, toxic) if not t]
    in_pos, in_neg = Counter(u for b in pos for u in b), Counter(u for b in neg for u in b)
    rate = lambda u: (in_pos[u] + 0.5) / (len(pos) + 1) / ((in_neg[u] + 0.5) / (len(neg) + 1))
    telling = {u: n * np.log(rate(u)) for u, n in in_pos.items() if n > 1 or len(pos) < 50}
    clean = sorted(in_neg, key=hash_of)
    ranked = sorted(telling, key=lambda u: (-telling[u], u))
    marks, vectors = _landmarks(ranked, LANDMARKS // 2, [], [])
    marks, vectors = _landmarks(clean, LANDMARKS, marks, vectors)
    if not marks:
        return Model(np.zeros(_SIZE), 0.0, 0.0, float(np.log(max(1e-9, y.mean() / (1 - y.mean())))))
    gram = np.array(vectors) @ np.array(vectors).T
    values, base = np.linalg.eigh(gram)
    keep = values > 1e-4 * values.max()
    white = base[:, keep] / np.sqrt(values[keep])

    def mapped(strings: list[str]) -> np.ndarray:
        codes, owner = _coded([s[:WINDOW] for s in strings])
        product, norm = _products(codes, vectors)
        return product / norm[:, None] @ white

    negatives = list(dict.fromkeys(clean[:4_000] + [u for u, n in in_neg.most_common(1_500)]))
    clear = max(CLEAR, SHARE * max(telling.values(), default=0.0))
    strings = [u for u in ranked if rate(u) >= TELLING and telling[u] >= clear]
    strings = strings or sorted({max(b, key=lambda u: (telling.get(u, 0.0), u)) for b in pos if b})
    x_pos, x_neg = mapped([v for n, u in enumerate(strings) for v in (_variants(u) if n < VARIED else [u])]), mapped(negatives)
    for _ in range(5):
        x, side = np.vstack([x_pos, x_neg]), np.repeat([1.0, -1.0], [len(x_pos), len(x_neg)])
        w, bias = _svm(x, side, np.where(side > 0, C / len(x_pos), 3 * C / len(x_neg)))
        model = Model((white @ w) @ np.array(vectors), bias, 1.0, 0.0)
        top = lambda b: max(b, key=lambda u: (model.memo[u], u))
        hard = [top(b) for b, h in zip(neg, model.highest(neg)) if b and h > -0.9]
        hard = [u for u in dict.fromkeys(hard) if u not in set(negatives) and rate(u) < TELLING][:1_000]
        if hard:
            negatives, x_neg = negatives + hard, np.vstack([x_neg, mapped(hard)])
    model.slope, model.shift = _platt(np.clip(model.highest(bags), -1.0, 1.5), y, np.where(y > 0, shares[1], shares[0]))
    model.memo = {}
    return model


def hash_of(text: str) -> int:
    """A hash that is the same in every process."""
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS) -> Model:
    """Fits a model to the labels (id_col, label_col) of docs.

    At most toxic_docs and clean_docs documents are used, the first by a hash of their ids, of up to FIT_CHARS
    characters. An id with several labels has the largest; null labels and ids are left out. Without labels of both
    classes the model gives every text the same score, near 0 or 1. Only a text's strings and its label are seen.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).dropna()
    known = known.groupBy("_id").agg((F.max("_y") > 0).cast("int").alias("_y"))
    counts = {r[0]: r[1] for r in known.groupBy("_y").count().collect()}
    first = lambda y, n: known.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = first(1, toxic_docs).unionByName(first(0, clean_docs))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = texts.filter(F.col("_text").isNotNull() & (F.char_length("_text") <= FIT_CHARS))

    def bagged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"y": batch["_y"], "bag": [sorted(units(t)) for t in batch["_text"]]})

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((y, b.tolist()) for batch in batches for y, b in zip(batch["y"].tolist(), batch["bag"]))
        sizes = Counter(y for y, _ in rows)
        model = fit([set(b) for _, b in rows], [y for y, _ in rows], tuple(counts.get(y, 0) / max(1, sizes[y]) for y in (0, 1)))
        yield pd.DataFrame([(model.weights.astype("<f8").tobytes(), model.bias, model.slope, model.shift)],
                           columns=["weights", "bias", "slope", "shift"])

    # The broadcast side has toxic_docs + clean_docs rows at most, so one task can learn from them; the weights come back.
    rows = texts.join(F.broadcast(chosen), "_id").mapInPandas(bagged, "y int, bag array<string>").repartition(1)
    out = rows.mapInPandas(fitted, "weights binary, bias double, slope double, shift double").first()
    return Model(np.frombuffer(out.weights, "<f8"), out.bias, out.slope, out.shift) if out else fit([], [], (1.0, 1.0))


def toxicity(text: Column, model: Model) -> Column:
    """The probability that a text is toxic, by its whole text; null and empty texts have that of no string."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = texts.tolist()
            yield pd.Series(np.concatenate([np.zeros(0)] + [model.probabilities([units(t) for t in texts[i:i + 500]])
                                                            for i in range(0, len(texts), 500)]))

    return score(text)
