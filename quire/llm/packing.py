"""Filling containers of fixed capacity with whole items.

Lengths are rounded up to a grid, so the histogram has a bounded number of bins however many items there are.
All combinations of up to three bins that fill a container, and then those within a small window below, are
enumerated, the number of times each is used is the non-negative least squares fit to the histogram, rounded down,
and what is left is packed greedily, again by histogram: the largest length left, then the largest that still fits,
the pattern repeated as often as its lengths last.  Only the histogram and the plan pass through the driver; both are bounded by the grid.
Items are numbered within their bin in two levels, so a bin that holds a third of all rows is still spread over
many tasks, and number ranges tell each item its container.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.whitespace import count_ws_tokens
from quire.llm.splitting import split_oversized
from quire.plans.materialize import join_checked, materialize, small_enough, spread

#: Units of the grid that a fitted combination may leave free.
WINDOW = 2
#: Parts of a bin whose items are numbered apart; the table of their sizes has a row per bin and part.
MOST_PARTS = 4096

def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min ||ax - b|| over x >= 0 by the active set method, until no column improves the fit."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    error, stalled = np.inf, 0
    while stalled < 10:  # the fit gets better with every column; rounding errors alone could make it go round
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        enter = int(np.argmax(gradient))
        if gradient[enter] <= tolerance:
            break
        active[enter] = True
        while active.any():
            held = np.flatnonzero(active)
            z, *_ = np.linalg.lstsq(a[:, held], b, rcond=None)
            if z.min() > 0:
                x[:] = 0.0
                x[held] = z
                break
            falling = z <= 0
            step = np.min(x[held][falling] / np.maximum(x[held][falling] - z[falling], 1e-300))
            x[held] += step * (z - x[held])
            x[held[x[held] <= 1e-12]] = 0.0
            active &= x > 0
        now = float(np.square(b - a @ x).sum())
        error, stalled = (now, 0) if now < error * (1 - 1e-12) else (error, stalled + 1)
    return x


def shallow_patterns(filled: int, present: list[int]) -> list[tuple[int, ...]]:
    """Combinations of one to three of the present bins whose sizes add up to ``filled`` exactly."""
    have = set(present)
    out: list[tuple[int, ...]] = [(filled,)] if filled in have else []
    sizes = sorted(have)
    for i, a in enumerate(sizes):
        if a <= filled - a and filled - a in have:
            out.append((a, filled - a))
        for b in sizes[i:]:
            c = filled - a - b
            if c < b:
                break
            if c in have:
                out.append((a, b, c))
    return out


def fit_patterns(left: dict[int, int], patterns: list[tuple[int, ...]]) -> list[tuple[dict[int, int], int]]:
    """(bin -> items per container, containers) by non-negative least squares, rounded down; what they take goes from ``left``."""
    row = {s: i for i, s in enumerate(left)}
    a, b = np.zeros((len(row), len(patterns))), np.array(list(left.values()), dtype=float)
    for j, p in enumerate(patterns):
        for s in p:
            a[row[s], j] += 1
    x = nnls(a, b)
    plan = []
    for j in np.argsort(-x, kind="stable"):
        need = {s: patterns[j].count(s) for s in patterns[j]}
        times = min(int(x[j] + 1e-9), *(left[s] // k for s, k in need.items()))
        if times > 0:
            plan.append((need, times))
            for s, k in need.items():
                left[s] -= k * times
    return plan


def plan_patterns(histogram: dict[int, int], units: int, window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """(bin -> items per container, containers) so that every item of the histogram has a place.

    Combinations that fill a container are fitted first, then those that leave one unit of room, up to ``window``.
    """
    left = {s: n for s, n in sorted(histogram.items()) if n > 0}
    plan: list[tuple[dict[int, int], int]] = []
    for room in range(window + 1):
        if left and (patterns := shallow_patterns(units - room, list(left))):
            plan += fit_patterns(left, patterns)
            left = {s: n for s, n in left.items() if n}
    while left:
        room, need = units, {}
        for s in sorted(left, reverse=True):
            k = min(left[s], room // s)
            if k:
                need[s] = k
                room -= k * s
        times = min(left[s] // k for s, k in need.items())
        plan.append((need, times))
        for s, k in need.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]
    return plan


def measured_items(df: DataFrame, key: str, text: str, capacity: int) -> DataFrame:
    """item_id, piece_no, n_tokens: whole items (piece_no 0), and the pieces of those larger than the capacity.

    Texts are counted once; the sizes are written before anything is asked of them, and only the texts that turn
    out too large are read again.
    """
    rows = df.select(F.col(key).alias("item_id"), F.col(text).alias("body")).filter(F.col("body").isNotNull())
    sizes = materialize(rows.select("item_id", F.xxhash64("body").alias("h"), count_ws_tokens(F.col("body")).alias("n_tokens")).distinct())
    whole = sizes.filter(F.col("n_tokens") <= capacity).select("item_id", F.lit(0).alias("piece_no"), "n_tokens")
    large = sizes.filter(F.col("n_tokens") > capacity).select(F.col("item_id").alias("k"), "h").distinct()
    same = (F.xxhash64("body") == F.col("h")) & F.col("item_id").eqNullSafe(F.col("k"))
    few = F.broadcast(large) if small_enough(large, 64, 16 << 20) else large
    cut = split_oversized(rows.filter(F.length("body") > 2 * capacity).join(few, same, "left_semi"), ["item_id"], "body", capacity, 0)
    return whole.unionByName(cut.select("item_id", "piece_no", "n_tokens"))


def pack(df: DataFrame, key: str, text: str, capacity: int = 2000, grid: int = 8) -> DataFrame:
    """container_id, item_id, piece_no, n_tokens: every item of ``df`` in exactly one container.

    Items longer than the capacity are first cut (piece_no 1, 2, ...).  Null texts have no size and get no row;
    empty ones count as the smallest length.  An item repeated exactly (same key and text) is placed once.
    ``grid`` is the step to which lengths are rounded up for planning: capacity / grid bins at most.
    """
    units = capacity // grid
    items = materialize(
        measured_items(df, key, text, capacity)
        .withColumn("bin", F.least(F.greatest(F.ceil(F.col("n_tokens") / grid), F.lit(1)), F.lit(units)).cast("int"))
    )
    spark = df.sparkSession
    groups = min(MOST_PARTS, max(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "piece_no", "n_tokens"), F.lit(groups)).cast("int"))
    counts = items.groupBy("bin", "part").agg(F.count("*").alias("n"))
    # at most (capacity / grid) x groups rows, so this window stays small
    before = counts.select("bin", "part", (F.sum("n").over(Window.partitionBy("bin").orderBy("part")) - F.col("n")).alias("before"))
    histogram = {r["bin"]: r["n"] for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    ranges, taken, first = [], dict.fromkeys(histogram, 0), 0
    for need, times in plan_patterns(histogram, units):
        for s, k in need.items():
            ranges.append((s, taken[s], taken[s] + k * times, first, k))
            taken[s] += k * times
        first += times
    # one row per bin with its ranges in order: an item finds its own by counting those that begin at or before its place
    plan = spark.createDataFrame(ranges, "bin int, lo long, hi long, first long, per long")
    plan = plan.groupBy("bin").agg(F.array_sort(F.collect_list(F.struct("lo", "first", "per"))).alias("ranges"))
    numbered = items.withColumn("place", F.row_number().over(Window.partitionBy("bin", "part").orderBy("item_id", "piece_no", "n_tokens")).cast("long") - 1)
    placed = join_checked(numbered, before, ["bin", "part"], "inner", 48).withColumn("place", F.col("place") + F.col("before")).join(F.broadcast(plan), "bin")
    mine = F.get("ranges", F.size(F.filter("ranges", lambda r: r["lo"] <= F.col("place"))) - 1)
    placed = placed.withColumn("mine", mine)
    return placed.select((F.col("mine.first") + F.floor((F.col("place") - F.col("mine.lo")) / F.col("mine.per"))).cast("long").alias("container_id"), "item_id", "piece_no", "n_tokens")


def fill_report(packed: DataFrame, capacity: int = 2000) -> DataFrame:
    """One row: containers, items, tokens, the least number of containers possible, share of room used."""
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("n"))
    return per.agg(
        F.count("*").alias("n_containers"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_items"),
        F.coalesce(F.sum("used"), F.lit(0)).alias("n_tokens"),
        F.max("used").alias("fullest"),
        F.ceil(F.coalesce(F.sum("used"), F.lit(0)) / capacity).alias("least_possible"),
        F.round(F.sum("used") / (F.count("*") * capacity), 4).alias("fill"),
    )


def chunks_packed(spark, sf_dir: str) -> DataFrame:
    from quire.sources.tables import read_table

    return pack(spread(read_table(spark, sf_dir, "parent_chunks").select("id", "content")), "id", "content")
