"""Pieces and bit-parallel distance against a plain table of edit distances."""

import random

from fleetrisk.llm.decontaminate import Matcher, find_contamination, normalised, without_contamination


def least_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edited(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + "z" + text[i:], text[:i] + "q" + text[i + 1:]])
    return text


def test_same_as_brute_force():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 6)))
    items = [(n, " ".join(word() for _ in range(rng.randint(8, 40)))) for n in range(12)]
    match = Matcher(items, 0.1, 20)
    for _ in range(60):
        n, item = rng.choice(items)
        budget = int(len(item) * 0.1)
        text = " ".join(word() for _ in range(30)) + " " + edited(rng, item, rng.randint(0, budget + 3)) + " " + word()
        found = {h["item_id"]: h for h in match(text)}
        for m, other in items:
            best = least_distance(normalised(other), normalised(text))
            assert (m in found) == (best <= int(len(normalised(other)) * 0.1))
            if m in found:
                hit = found[m]
                assert hit["distance"] == best
                assert least_distance(normalised(other), normalised(text)[hit["start"]:hit["end"]]) == best


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "A quick  brown\nFOX jumps over it", "x"),
                                  (3, "a quick brown fox jumps over it", "x")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, "a quick brown fox jumps over it"), (8, None), (9, ""), (10, "fox")], "item_id long, text string")
    got = sorted((str(r[0]), r[1], r[2]) for r in find_contamination(docs, bench).collect())
    assert got == [("3", 7, 0), ("3", 10, 0), ("None", 7, 0), ("None", 10, 0)]
    assert find_contamination(docs, bench.limit(0)).count() == 0
    assert sorted(r[0] for r in without_contamination(docs, bench).collect()) == [1, 2]


def test_short_items_at_word_borders():
    """Items of every length on both sides of the limit, with and without an edit, alone, in quotes and inside longer words."""
    match = Matcher([(1, "Who wrote Hamlet?"), (2, "ox"), (3, "to be or not to be, that"), (4, "!")], 0.1, 20)
    ids = lambda text: {h["item_id"]: (h["distance"], normalised(text)[h["start"]:h["end"]]) for h in match(text)}
    assert ids('they asked "who  wrote hamlet?" and left') == {1: (0, "who wrote hamlet?")}
    assert ids("who wrote hamlets? it was")[1][0] == 1 and ids("who wrotte hamlett? it was") == {}
    assert ids("foxes and oxen") == {} and ids("an ox, two") == {2: (0, "ox")} and ids("ox") == {2: (0, "ox")}
    assert ids("xto be or not to be, thaty") == {3: (0, "to be or not to be, that")}
    assert ids("well !") == {4: (0, "!")} and ids("") == {}
