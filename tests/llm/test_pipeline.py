"""Every stage of the pipeline against a plain version of its rule, and the token counts against the library."""

import random

import pytest

import corpus_pipeline as cp
from fleetrisk.llm.decontaminate import Matcher
from fleetrisk.llm.queries import held_out
from fleetrisk.llm.tokens import count_tokens
from fleetrisk.llm.toxicity import train, units

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"
ITEM = "the seventh lighthouse keeper wrote down every passing ship in a ledger of green leather"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """240 documents with insults, common lines, copies of one text, a benchmark item, nulls and one long text."""
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in ("mor", "tel", "vin", "sal", "kor") for b in ("a", "i", "o") for c in ("ran", "den", "lix", "mu")]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    texts = {}
    for i in range(240):
        text = prose(rng.randint(40, 90))
        if i % 4 == 0:
            text += " you utter numskull"
        if i % 5 == 1:
            text += "\nAll rights  reserved by the authors\n" + prose(12)
        texts[i] = text
    for i in range(201, 206):
        texts[i] = texts[13] if i % 2 else texts[13].replace("\n", " ", 1) + " mu" * (i % 4)
    texts |= {210: None, 211: "", 213: prose(5_000), 217: prose(30) + " " + ITEM.upper() + " " + prose(5), 219: "  \n "}
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", None if i % 7 else "site", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("numskull" in (t or ""))) for i, t in texts.items() if i < 200]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def kept_texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    before = kept_texts(docs)

    after = kept_texts(cp.drop_toxic(spark, docs, corpus))
    model = train(docs, spark.read.parquet(f"{corpus}/labels.parquet").filter(~held_out("doc_id")))
    assert after == {i: t for i, t in before.items() if model.probabilities([units(t)])[0] < 0.7}
    assert {i for i, t in before.items() if "numskull" in (t or "")} == before.keys() - after.keys()

    before, docs = after, cp.staged(cp.drop_toxic(spark, docs, corpus), "toxicity")
    key = lambda line: line.strip(" \t\n\x0b\f\r").lower()
    holders = {}
    for i, t in before.items():
        for k in {key(x) for x in (t or "").split("\n")} - {""}:
            holders.setdefault(k, []).append(i)
    goes = lambda k, i: len(holders.get(k, ())) >= 10 and min(holders[k]) != i
    want = {i: "\n".join(x for x in (t or "").split("\n") if not goes(key(x), i)) for i, t in before.items()}
    after = kept_texts(out := cp.staged(cp.drop_frequent_lines(spark, docs, corpus), "lines"))
    assert {i: t or "" for i, t in after.items()} == want and out.columns == docs.columns
    assert any(t != (before[i] or "") for i, t in want.items())

    before, docs = {i: t or "" for i, t in after.items()}, out
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    sets = {i: shingles(t) for i, t in before.items()}
    alike = lambda a, b: len(a & b) * 5 >= len(a | b) * 4
    root = dict.fromkeys(sets)
    for i in sorted(sets):
        if root[i] is None:
            root[i], front = i, [i]
            while front:
                a = front.pop()
                near = [b for b in sets if root[b] is None and alike(sets[a], sets[b])]
                root |= dict.fromkeys(near, i)
                front += near
    out = cp.staged(cp.drop_near_duplicates(spark, docs, corpus), "near")
    after = kept_texts(out)
    assert after.keys() == set(root.values()) and len(after) < len(before) and out.columns == docs.columns

    match = Matcher([(1, ITEM)], 0.1, 20)
    last = cp.staged(cp.drop_contaminated(spark, out, corpus), "clean")
    clean = kept_texts(last)
    assert clean == {i: t for i, t in after.items() if not match(t)} and 217 in after and 217 not in clean

    bins = cp.packed(spark, last, corpus).collect()
    held = {}
    for b in bins:
        assert b.n_tokens == sum(p.length for p in b.pieces) <= b.capacity
        end = 0
        for p in b.pieces:
            assert p.offset == end
            end += p.length
            held.setdefault(p.doc_id, []).append((p.start, p.length))
    for i, t in clean.items():
        at = 0
        for start, length in sorted(held.pop(i)):
            assert start == at
            at += length
        assert at == len((t or "").split()) + 1
    assert not held

    run = cp.run(spark, corpus)
    packed = lambda rows: sorted((b.bin_id, b.capacity, b.n_tokens, len(b.pieces)) for b in rows)
    assert packed(run.collect()) == packed(bins)


def test_stages_on_empty_documents(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        docs = cp.staged(stage(spark, docs, corpus), name)
        assert docs.count() == 0


def test_token_counts(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = [None, "", "a  b\n\n c", "<|endoftext|> é 漢字", "word " * 20_000, "x" * 30_000, "a  b\n\n c"]
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    cache = f"{tmp_path}/cache"
    first, second = docs.limit(4), docs
    want = [len(plain.encode(t or "", add_special_tokens=False).ids) for t in texts]
    for rows in (first, second, second):
        got = {r.doc_id: r.n_tokens for r in count_tokens(rows, path, cache).collect()}
        assert got == {i: want[i] for i in got} and len(got) == rows.count()
    # Each distinct text is in the cache once: later calls have encoded its misses only.
    assert spark.read.parquet(cache).count() == len({t or "" for t in texts})
    assert count_tokens(docs.limit(0), path, f"{tmp_path}/other").count() == 0
