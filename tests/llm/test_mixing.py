"""Mixing: shares, repeats and the order of the keys."""

import math

import pytest

from public_tokenizers import path

from quire.llm.mixing import budgets, measured, mix, mix_shares, read_targets, select_mix

DOCS, TARGETS = "doc_id bigint, text string, src string, w double, bucket int", "source string, target_share double, max_repeats int"


def test_budgets():
    targets = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4), ("d", 0.0, 9)]
    free = budgets(targets, {"a": 100, "b": 50, "c": 10})
    assert free == pytest.approx({"a": 100, "b": 60, "c": 40, "d": 0})
    held = {"a": 100, "b": 1000, "c": 10}
    assert budgets(targets, held, 400) == pytest.approx({"a": 100, "b": 120, "c": 40, "d": 0})
    assert budgets(targets, held, 400, fill=True) == pytest.approx({"a": 100, "b": 260, "c": 40, "d": 0})
    # a source without repeats takes nothing and bounds nothing
    assert budgets([("a", 0.5, 0), ("b", 0.5, 1)], held) == pytest.approx({"a": 0, "b": 1000}) == budgets([("a", 0.5, 0), ("b", 0.5, 1)], held, 2000)
    assert budgets(targets, {}, 400) == dict.fromkeys("abcd", 0.0) == budgets(targets, {})
    assert budgets([("a", 0.5, 1), ("x", 0.5, 1)], {"a": 10}, 100) == pytest.approx({"a": 10, "x": 0})


def tables(spark):
    rows = [(i, "alpha beta " * (1 + i % 7), "Big Source") for i in range(900)] + [(1000 + i, "gamma delta", " small_SOURCE ") for i in range(20)]
    rows += [(2000, None, "big_source"), (2001, "", "big_source"), (2002, "x y z", "unlisted"), (2003, "x", None), (5000, "alpha", "big-source")]
    docs = spark.createDataFrame([(*r, 1.0, 2) for r in rows], DOCS)
    targets = spark.createDataFrame([("big_source", 0.6, 1), ("small source", 0.3, 3), ("nowhere", 0.1, 5)], TARGETS)
    return docs, "doc_id", "text", "src", targets, path("byte_bpe_50k.tiktoken")


def test_shares(spark):
    out = {r["source"]: r for r in mix_shares(*tables(spark), total=None).collect()}
    assert out["nowhere"]["selected_tokens"] == 0 and out["small_source"]["most_repeats"] == 3 and out["big_source"]["most_repeats"] == 1
    assert out["big_source"]["actual_share"] == pytest.approx(2 / 3, abs=0.02) and out["small_source"]["actual_share"] == pytest.approx(1 / 3, abs=0.02)


def test_fixed_total(spark):
    rows = mix(*tables(spark), total=3000, fill=True).collect()
    held = {}
    for r in rows:
        held.setdefault(r["source"], []).append(r)
    assert {r["repeats"] for r in held["small_source"]} == {3} and len(held["small_source"]) == 20
    assert len({r["doc_id"] for r in rows}) == len(rows)
    small = sum(r["n_tokens"] * r["repeats"] for r in held["small_source"])
    assert abs(sum(r["n_tokens"] for r in held["big_source"]) - (3000 - small)) <= 20


def test_each_source_as_near_to_its_share_as_its_repeats_allow(spark):
    out = {r["source"]: r for r in mix_shares(*tables(spark)).collect()}
    total = sum(r["available_tokens"] for r in out.values())
    for r in out.values():
        aim = min(r["target_share"] * total, r["max_repeats"] * r["available_tokens"])
        assert abs(r["selected_tokens"] - aim) <= 20 and r["most_repeats"] <= r["max_repeats"]


def test_targets_with_nulls_and_spellings(spark):
    docs, *names, _, ranks = tables(spark)
    targets = spark.createDataFrame([("Big Source", 0.2, None), ("big-source", 0.2, 1), ("small_source", 0.3, None), ("nowhere", None, 2), (None, 0.1, 1)], TARGETS)
    assert read_targets(targets) == [("big_source", 0.4, 1), ("nowhere", 0.0, 2), ("small_source", 0.3, 0)]
    for total in (None, "available"):
        out = {r["source"]: r for r in mix_shares(docs, *names, targets, ranks, total).collect()}
        assert set(out) == {"big_source", "nowhere", "small_source"} and out["big_source"]["selected_tokens"] > 0 and out["small_source"]["selected_tokens"] == 0


def test_weights(spark):
    rows = [(f"d{i}", "Clean words of a text" if i % 3 else "<<||>> {} \ufffd\ufffd x", "s", 0.0, 0) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS.replace("bigint", "string"))
    got = {r["doc_id"]: r["w"] for r in measured(docs, "doc_id", "text", "src", [("s", 1.0, 1)], path("byte_bpe_50k.tiktoken")).collect()}
    assert all((got[f"d{i}"] == 1.0) == bool(i % 3) and got[f"d{i}"] > 0 for i in range(300))
    from pyspark.sql import functions as F

    given = measured(docs, "doc_id", "text", "src", [("s", 1.0, 1)], path("byte_bpe_50k.tiktoken"), F.when(F.col("doc_id") == "d1", 0.5))
    assert {r["doc_id"]: r["w"] > 0.1 for r in given.filter("doc_id IN ('d0', 'd1', 'd10')").collect()} == {"d0": False, "d1": True, "d10": False}


def test_order_of_keys_like_one_sort(spark):
    """The records taken are the first by key; the weights shift the draw."""
    from pyspark.sql import functions as F

    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.25).alias("w"), (1 + F.col("id") % 5).alias("n_tokens"))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(20240)), 11).cast("double") + 0.5) / float(1 << 53)
    keyed = sorted((r["k"], r["doc_id"], r["n_tokens"]) for r in rows.select((-F.log(u) / F.col("w")).alias("k"), "doc_id", "n_tokens").collect())
    budget, taken, total = 2000.0, set(), 0
    for _, d, n in keyed:
        if total + n / 2 > budget:
            break
        taken.add(d)
        total += n
    for edge_rows in (200_000, 2, 0):  # one cut into cells, several, and as many as the keys have bits for
        got = {r["doc_id"] for r in select_mix(rows, [("s", 1.0, 1)], budget, edge_rows=edge_rows).collect()}
        assert got == taken
    even = sum(d % 2 == 0 for d in got) / len(got)
    assert 0.65 < even < 0.95


def test_epochs_before_the_fraction(spark):
    from pyspark.sql import functions as F

    rows = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(1.0).alias("w"), F.lit(10).cast("bigint").alias("n_tokens"))
    repeats = [r["repeats"] for r in select_mix(rows, [("s", 1.0, 5)], 2500.0).collect()]
    assert len(repeats) == 100 and sorted(set(repeats)) == [2, 3] and math.isclose(sum(repeats), 250)


def test_nothing(spark):
    docs, *rest = tables(spark)
    assert mix(docs.limit(0), *rest).count() == 0
    assert mix(docs, *rest[:-2], rest[-2].limit(0), rest[-1]).count() == 0
