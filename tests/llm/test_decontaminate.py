"""Leak search against windows compared one by one."""

import random
import unicodedata

from quire.llm import decontaminate
from quire.llm.decontaminate import leaked, without_leaks, word_spans, words

DOCS, ITEMS = "doc_id bigint, text string, body string, item_id string", "item_id bigint, text string, doc_id string"


def plain_words(t):
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.category(c).startswith("M")).lower()
    out, word = [], ""
    for c in t + " ":
        if unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(docs, items, n):
    found = set()
    for d, t in docs:
        w = plain_words(t or "")
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for k, x in items:
            v = plain_words(x or "")
            if any(tuple(v[i : i + n]) in grams for i in range(len(v) - n + 1)):
                found.add((d, k))
    return found


def cases():
    rng = random.Random(2)
    vocabulary = ["fièvre", "Dose", "un", "deux", "x1", "été", "ﬁn", "Ωmega"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(2, 20))) for i in range(20)] + [(50, None), (51, ""), (0, text(8))]
    docs = []
    for d in range(120):
        t = text(rng.randint(0, 15))
        if rng.random() < 0.5:
            v = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(v) - 4))
            t += rng.choice(["\n", " - 3 - ", ", "]).join([" ", " ".join(v[a : a + rng.randint(3, 9)]).upper(), text(3)])
        docs.append((d, rng.choice([t, unicodedata.normalize("NFD", t)])))
    return [*docs, docs[0], (900, None), (901, "")], items


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, "x", "y") for d, t in docs], DOCS), "doc_id", "text",
        spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS), "item_id", "text",
    )


def test_in_one_part_and_many_like_brute_force(spark):
    docs, items = cases()
    args = tables(spark, docs, items)
    expected = brute(docs, items, 5)
    assert expected
    assert {tuple(r) for r in leaked(*args, n=5).collect()} == expected
    assert {tuple(r) for r in leaked(*args, n=5, part_words=60).collect()} == expected
    whole, parts = ({r["doc_id"]: (r["n_spans"], r["text"]) for r in without_leaks(*args, n=5, **more).collect()} for more in ({}, {"part_words": 60}))
    assert whole == parts and any(n for n, _ in whole.values())


def test_keys_of_any_type_and_repeated_keys(spark):
    item = "one two three four five"
    docs = spark.createDataFrame([("a", f"x {item}"), ("a", "other"), ("a", f"x {item}"), (None, f"{item} y"), ("", "z")], "k string, t string")
    items = spark.createDataFrame([("i", item), (None, item), ("i", None)], "k string, t string")
    assert sorted(map(tuple, leaked(docs, "k", "t", items, "k", "t", n=4).collect()), key=str) == [("a", "i"), (None, "i")]
    assert sorted(map(tuple, without_leaks(docs, "k", "t", items, "k", "t", n=4).collect()), key=str) == [("", 0, "z"), ("a", 0, "other"), ("a", 1, "x "), ("a", 1, "x "), (None, 1, " y")]


def test_items_longer_than_a_part(spark):
    item = " ".join(f"w{i}" for i in range(300))
    docs = [(a, " ".join(f"w{i}" for i in range(a, a + 13))) for a in range(0, 288, 7)]
    assert {tuple(r) for r in leaked(*tables(spark, docs, [(1, item)]), part_words=80).collect()} == {(a, 1) for a, _ in docs}


def test_words_like_definition():
    docs, items = cases()
    for _, t in docs + items:
        if t:
            assert words(t) == plain_words(t) and [w for w, _, _ in word_spans(t)] == plain_words(t)


def test_spans_are_cut(spark):
    item = "one two three four five six"
    docs = [(1, "Start. One, TWO three four\nfive six! End."), (2, "nothing here"), (3, None), (4, "two three four five and two three four six")]
    got = {r["doc_id"]: (r["n_spans"], r["text"]) for r in without_leaks(*tables(spark, docs, [(1, item)]), n=4).collect()}
    assert got == {1: (1, "Start. ! End."), 2: (0, "nothing here"), 3: (0, None), 4: (1, " and two three four six")}


def test_nothing(spark):
    docs, items = cases()
    assert leaked(*tables(spark, [], items)).count() == 0 and leaked(*tables(spark, docs, [])).count() == 0


def test_long_text(spark):
    item = " ".join(f"w{i}" for i in range(20))
    args = tables(spark, [(1, "a " * 200_000 + item), (2, item[:-1] + "x"), (3, " ".join(item.split()[:12]))], [(7, item)])
    assert {tuple(r) for r in leaked(*args).collect()} == {(1, 7), (2, 7)} and decontaminate.N == 13
