"""Collapsing copies against a direct reading of the rules."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from quire.llm import collapse

SHY, ZW, BOM = map(chr, (0xAD, 0x200B, 0xFEFF))
BLOCKS = "id bigint, text string, kind string, digest string, body string"


def leaf(t):
    out = []
    for i, c in enumerate(t):
        if c.isspace() and not "\x1c" <= c <= "\x1f" or c in SHY + ZW + BOM:
            continue
        if unicodedata.category(c).startswith("P") and not (c in ".,/:" and 0 < i < len(t) - 1 and unicodedata.category(t[i - 1]) == "Nd" and unicodedata.category(t[i + 1]) == "Nd"):
            continue
        out.append(c)
    return "".join(out).lower()


def canon(text, kind):
    if kind == "kv":
        return ("f", tuple(sorted(x for x in map(leaf, re.split("[;|\n\r\x0b\x0c\x85  ]", text)) if x)))
    return ("t", leaf(text))


def table(spark, rows):
    return spark.createDataFrame([(i, t, k, "x", "y") for i, t, k in rows], BLOCKS)


def node(unordered=None):
    return collapse.text_or_fields(F.col("text"), F.lit(False) if unordered is None else F.coalesce(unordered, F.lit(False)))


def classes(rows, least):
    held = {}
    for i, t, k in rows:
        if t is not None and i is not None and sum(unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd" for c in t) >= least:
            held.setdefault(canon(t, k), set()).add(i)
    return held.values()


def cases():
    rng = random.Random(7)
    base = ["Take 4.7 mg, twice; daily.", "Take 47 mg twice daily", "Dose: 3 | Route: mouth | Who: adults", "Ratio 3:4 or 3/4, then 1,000.5!", "", " . ", "ÉTÉ", "x"]
    rows = []
    for i in range(400):
        t = rng.choice(base)
        if rng.random() < 0.5:
            t = rng.choice([t.upper(), t.replace(" ", f" {ZW}"), f"“{t}”", t.replace(" ", "\r\n"), t.replace("a", f"a{SHY}"), " ".join(reversed(t.split("|"))), "|".join(reversed(t.split("|")))])
        rows.append((i, t, rng.choice(["text", "kv"])))
    return [*rows, *rows[:30], (900, None, "text"), (None, "Take 47 mg twice daily", "text"), (901, "Take 47 mg twice daily", None)]


def test_copies_like_direct_reading(spark):
    rows = cases()
    df = table(spark, rows)
    for least in (0, 12):
        got = {tuple(r) for r in collapse.copies(df, "id", "text", node(F.col("kind") == "kv"), collapse.has_alnum(F.col("text"), least) if least else None).collect()}
        assert got == {(min(c), i) for c in classes(rows, least) for i in c if i != min(c)}


def test_passages(spark):
    rows = cases()
    got = {r["first_id"]: r["n_items"] for r in collapse.collapse(table(spark, rows), "id", "text", node(F.col("kind") == "kv")).collect()}
    assert got == {min(c): len(c) for c in classes(rows, 0)}


def test_one_class_holds_most_rows(spark):
    rows = [(i, "Same Passage" if i % 3 else f"other {i}", "text") for i in range(3000)]
    got = collapse.copies(table(spark, rows), "id", "text", node())
    assert got.count() == 1999 and got.select("first_id").distinct().count() == 1


def test_digests_that_collide_are_told_apart(spark):
    rows = [(1, "ab", "t"), (2, "AB", "t"), (3, "ac", "t"), (4, "a c", "t"), (5, "zz", "t"), (5, "Z z", "t"), (6, "ad", "t")]
    df = table(spark, rows)
    poor = node()._replace(digest=F.md5(F.substr(collapse.leaf(F.col("text")), F.lit(1), F.lit(1))))
    assert {tuple(r) for r in collapse.copies(df, "id", "text", poor).collect()} == {(1, 2), (3, 4)}
    got = {r["first_id"]: (r["n_items"], r["passage"]) for r in collapse.collapse(df, "id", "text", poor).collect()}
    assert got == {1: (2, "ab"), 3: (2, "ac"), 5: (1, "Z z"), 6: (1, "ad")}


def test_separators_within_fields(spark):
    """A field that holds U+0000 or digits like a length is still one field."""
    rows = [(1, "alpha beta\0delta", "kv"), (2, "delta; alpha beta", "kv"), (3, "Delta;; ALPHA-beta", "kv"), (4, "deltaalphabeta", "kv"), (5, "delta alpha beta", "t")]
    got = {tuple(r) for r in collapse.copies(table(spark, rows), "id", "text", node(F.col("kind") == "kv")).collect()}
    assert got == {(2, 3)}


def test_nested_records(spark):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("id string, r struct<name: string, tags: array<string>, more: map<string, struct<v: double, w: array<string>>>>")
    rows = [
        ("a", ("One, two", ["x", "Y"], {"k": (1.5, ["p"]), "l": (None, [])})),
        ("b", ("ONE TWO", ["Y ", "x"], {"L": (None, []), "k": (1.5, ["P."])})),
        ("c", ("one two", ["x", "y"], {"k": (15.0, ["p"]), "l": (None, [])})),
        ("d", ("one two", ["x", "y"], {"k": (1.5, ["p"]), "l": (None, None)})),
        ("e", ("onetwo", ["xy"], {"k": (1.5, ["p"]), "l": (None, [])})),
        ("f", (None, None, None)), ("g", (None, None, None)), ("h", ("", None, None)), ("i", None),
    ]
    df = spark.createDataFrame(rows, schema)

    def got(ordered):
        return {tuple(r) for r in collapse.copies(df, "id", "r", collapse.tree(F.col("r"), schema["r"].dataType, ordered)).collect()}

    assert got(ordered=False) == {("a", "b"), ("f", "g")} and got(ordered=True) == {("f", "g")}


def test_nothing_and_long(spark):
    assert collapse.copies(table(spark, []), "id", "text", node()).count() == 0
    assert collapse.collapse(table(spark, []), "id", "text", node()).count() == 0
    long = "word " * 200_000
    assert [tuple(r) for r in collapse.copies(table(spark, [(1, long, "t"), (2, long.upper(), "t")]), "id", "text", node()).collect()] == [(1, 2)]


def test_many_shared_digests(spark, monkeypatch):
    """What is no longer broadcast gives the same rows by bitmap and shuffle."""
    rows = cases()
    df = table(spark, rows)
    frames = lambda: [collapse.copies(df, "id", "text", node(F.col("kind") == "kv")), collapse.collapse(df, "id", "text", node(F.col("kind") == "kv"))]
    expected = [sorted(map(tuple, f.collect())) for f in frames()]
    monkeypatch.setattr(collapse, "small_enough", lambda *a: False)
    assert [sorted(map(tuple, f.collect())) for f in frames()] == expected
