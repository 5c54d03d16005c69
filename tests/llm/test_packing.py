"""Packing: each item once, containers within capacity, little room left."""

import random

import numpy as np
from pyspark.sql import functions as F

from quire.llm.packing import fill_report, nnls, pack, plan_patterns, shallow_patterns


def test_nnls_like_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a, b = rng.random((5, 4)), rng.random(5)
        x = nnls(a, b)
        best = np.inf
        for mask in range(16):
            held = [j for j in range(4) if mask >> j & 1]
            z = np.linalg.lstsq(a[:, held], b, rcond=None)[0] if held else np.empty(0)
            if (z >= 0).all():
                best = min(best, np.linalg.norm(a[:, held] @ z - b) if held else np.linalg.norm(b))
        assert (x >= 0).all() and np.linalg.norm(a @ x - b) < best + 1e-7


def test_patterns_fill_exactly():
    found = shallow_patterns(10, [1, 2, 4, 5, 6, 10])
    assert set(found) == {(10,), (4, 6), (5, 5), (1, 4, 5), (2, 2, 6), (2, 4, 4)} and all(sum(p) == 10 for p in found)


def test_nnls_goes_on_until_nothing_improves():
    rng = np.random.default_rng(3)
    a, x = rng.random((200, 180)), rng.random(180)
    assert np.abs(nnls(a, a @ x) - x).max() < 1e-6


def test_window_takes_what_exact_combinations_leave():
    assert plan_patterns({12: 10, 11: 10}, 24, 1) == [({12: 2}, 5), ({11: 2}, 5)] and plan_patterns({12: 10, 11: 10}, 23, 0) == [({11: 1, 12: 1}, 10)]
    assert sum(times for _, times in plan_patterns({12: 10, 11: 10}, 25, 2)) == 10


def test_plan_places_all():
    rng = random.Random(2)
    for _ in range(60):
        histogram = {rng.randint(1, 25): rng.randint(1, 300) for _ in range(rng.randint(0, 12))}
        plan = plan_patterns(histogram, 25, rng.randint(0, 3))
        placed = {}
        for need, times in plan:
            assert times > 0 and sum(s * k for s, k in need.items()) <= 25
            for s, k in need.items():
                placed[s] = placed.get(s, 0) + k * times
        assert placed == histogram


def packed_of(spark, rows, **options):
    return pack(spark.createDataFrame(rows, "id bigint, text string, item_id string, bin int"), "id", "text", **options)


def test_pack(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([3, 7, 11, 30, 61, 90, 99]), "x", 1) for i in range(600)]
    rows += [rows[0], (900, None, "x", 1), (901, "", "x", 1), (902, "w " * 250, "x", 1), (None, "w w", "x", 1)]
    out = packed_of(spark, rows, capacity=100, grid=4)
    held = out.collect()
    used, seen = {}, {}
    for r in held:
        used[r["container_id"]] = used.get(r["container_id"], 0) + r["n_tokens"]
        key = (r["item_id"], r["piece_no"])
        seen[key] = seen.get(key, 0) + 1
    assert max(used.values()) <= 100 and set(seen.values()) == {1}
    assert {k for k, p in seen if p == 0} == {r[0] for r in rows} - {900, 902}
    assert sum(r["n_tokens"] for r in held if r["item_id"] == 902) == 250
    report = fill_report(out, 100).first()
    assert report["n_containers"] <= 1.08 * report["least_possible"]


def test_equal_lengths(spark):
    """All items in one bin, as if one length held all rows."""
    held = packed_of(spark, [(i, "w " * 60, "x", 1) for i in range(301)], capacity=120, grid=4)
    sizes = sorted(r["n"] for r in held.groupBy("container_id").agg(F.count("*").alias("n")).collect())
    assert sizes == [1] + [2] * 150


def test_nothing(spark):
    assert packed_of(spark, []).count() == 0
