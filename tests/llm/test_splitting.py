"""Splitting: nothing lost, limits and overlaps kept, cuts of least cost."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.functions.whitespace import TOKEN_RE
from quire.llm import splitting
from quire.llm.splitting import IMBALANCE_WEIGHT, PENALTY, boundary_kinds, plan_cuts, split_oversized, split_text

NBSP = chr(0xA0)
PARTS = ["word ", "end. ", "line\n", "par\n\n", f"x{NBSP}", "clause, ", "\t", "| cell |\r\n"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=120), st.integers(3, 15), st.integers(0, 2))
def test_pieces(parts, most, overlap):
    text = "".join(parts)
    pieces = split_text(text, most, overlap)
    assert "".join(text[a + r : b] for a, b, r, _, _ in pieces) == text
    tokens = TOKEN_RE.findall
    for k, (a, b, repeated, n, _) in enumerate(pieces):
        assert n == len(tokens(text[a:b])) <= max(most, 0)
        if k:
                again, before = tokens(text[a : a + repeated]), tokens(text[pieces[k - 1][0] : pieces[k - 1][1]])
                assert again == before[max(0, len(before) - overlap) :]


def cost(cuts, kinds, n, most, overlap):
    edges = [0, *cuts, n]
    share = n / -(-(n - overlap) // (most - overlap))
    total = sum(PENALTY[kinds[c - 1]] for c in cuts)
    for k, (a, b) in enumerate(zip(edges, edges[1:])):  # noqa: B905
        if b - a > (most if k == 0 else most - overlap):
            return float("inf")
        total += IMBALANCE_WEIGHT * ((b - a - share) / share) ** 2
    return total


def test_plan_is_cheapest():
    rng = random.Random(1)
    for _ in range(60):
        n, most, overlap = rng.randint(6, 12), rng.randint(3, 6), rng.randint(0, 1)
        kinds = np.array([rng.choice([0, 1, 2]) for _ in range(n - 1)], dtype=np.int8)
        if n <= most:
            continue
        best = min(cost(c, kinds, n, most, overlap) for r in range(1, n) for c in itertools.combinations(range(1, n), r))
        assert abs(cost(plan_cuts(kinds, n, most, overlap), kinds, n, most, overlap) - best) < 1e-9


def test_cuts_where_there_are_boundaries():
    text = "\n\n".join(" ".join(["w"] * 40) + "." for _ in range(10))
    assert {p[4] for p in split_text(text, 100, 10)} == {"paragraph", "end"}
    assert {p[4] for p in split_text(" ".join(["w"] * 400), 100, 10)} == {"word", "end"}


def test_kinds():
    spans = [m.span() for m in TOKEN_RE.finditer("a b. c, d\ne\n\nf\r\n\r\ng")]
    text = "a b. c, d\ne\n\nf\r\n\r\ng"
    assert boundary_kinds(text, [a for a, _ in spans], [b for _, b in spans]).tolist() == [4, 2, 3, 1, 0, 0]


def test_operator(spark):
    long, longer = "w " * 30, "s. " * 100_000
    rows = [(1, long, "x"), (1, long, "x"), (2, "short", "x"), (3, None, "x"), (4, "", "x"), (None, long, None), (5, longer, "x"), (6, "a" * 10_000, "x")]
    df = spark.createDataFrame(rows, "id bigint, body string, k0 string")
    out = split_oversized(df, ["id"], "body", 20, 5).collect()
    by = {}
    for r in out:
        by.setdefault(r["id"], []).append(r)
    assert set(by) == {1, 5, None} and len(by[1]) == 2 == by[1][0]["n_pieces"]
    for k, text in ((1, long), (5, longer), (None, long)):
        assert "".join(r["piece"][r["overlap_chars"] :] for r in sorted(by[k], key=lambda r: r["piece_no"])) == text
    assert split_oversized(df.limit(0), ["id"], "body", 20).count() == 0
    with pytest.raises(ValueError, match="overlap"):
        split_oversized(df, ["id"], "body", 20, 20)


def test_counts_alike(spark):
    text = "a" + "".join(map(chr, range(1, 0x3100))) + "b"
    from pyspark.sql import functions as F

    from quire.functions.whitespace import count_ws_tokens

    got = spark.createDataFrame([(text,)], "t string").select(count_ws_tokens(F.col("t"))).first()[0]
    assert got == len(TOKEN_RE.findall(text))
    assert splitting.KINDS[0] == "paragraph"
