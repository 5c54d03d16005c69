"""Mixing sources to target weights.

Every record gets an exponential key -ln(u) / w, u from a hash of its id and w its quality weight (sampling
without replacement by Efraimidis and Spirakis).  A source whose budget is more than its tokens is first taken
whole as many times as fit; the rest of its budget is filled in the order of the keys, up to the budget.

The order is never established in one task: keys fall into cells by a monotone function, tokens are summed per
source and cell, the running sums of these few rows name the one cell in which the budget ends, and that cell is cut
into cells again while it holds more records than one task should sort.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.tokens import encoder
from quire.functions.whitespace import UNICODE_WS
from quire.plans.materialize import materialize, spread

#: Keys are mapped to integers of so many bits, each cut into cells takes some of them.
KEY_BITS, CELL_BITS = 48, 12
#: Records that one task sorts where a budget ends.
EDGE_ROWS = 200_000
#: A table of targets is read by the driver; more rows than this raise ValueError.
MOST_SOURCES = 10_000
SEED = 20240

Target = tuple[str, float, int]


def source_name(col: Column) -> Column:
    """One spelling of a source: lower case, words joined by '_', nothing around."""
    return F.lower(F.regexp_replace(F.regexp_replace(col, f"^[{UNICODE_WS}_-]+|[{UNICODE_WS}_-]+$", ""), f"[{UNICODE_WS}_-]+", "_"))


def legible(text: Column) -> Column:
    """Share of letters, marks and digits of any script among the visible characters; damage, markup and noise lower it."""
    letters, visible = (F.length(F.regexp_replace(text, other, "")) for other in (r"[^\p{L}\p{M}\p{Nd}]++", r"(?U)\s++"))
    return letters / F.greatest(visible, F.lit(1))


def with_tokens(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, source, legible, n_tokens of doc_id, source, legible, body."""

    def run(batches):
        encode = encoder(path).encode_ordinary
        for batch in batches:
            counts = [len(encode(body.as_py())) for body in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int64())], names=["doc_id", "source", "legible", "n_tokens"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, source string, legible double, n_tokens long")


def read_targets(targets: DataFrame) -> list[Target]:
    """(source, share, repeats) of every listed source, in the order of their names.

    Spellings of one source are one: their shares add up and the largest number of repeats holds.  A null or negative
    share or number of repeats counts as 0, and such a source takes nothing.
    """
    if targets.limit(MOST_SOURCES + 1).count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    out: dict[str, tuple[float, int]] = {}
    for s, share, repeats in targets.filter(F.col("source").isNotNull()).select(source_name(F.col("source")), "target_share", "max_repeats").collect():
        a, b = out.get(s, (0.0, 0))
        out[s] = (a + max(0.0, float(share or 0)), max(b, int(repeats or 0), 0))
    return [(s, *out[s]) for s in sorted(out)]


def budgets(targets: list[Target], available: dict[str, int], total: float | None = None, fill: bool = False) -> dict[str, float]:
    """Tokens to take of each source.

    With ``total`` each source takes its share of it, or all that its repeats allow if that is less.  With ``fill`` the
    other sources then make up for what such a source lacks, in proportion to their shares and within their repeats.
    Without ``total`` it is the largest mix in which every source that has records and repeats reaches its share.
    """
    open_ = {s: p for s, p, r in targets if p > 0 and r > 0 and available.get(s)}
    most = {s: float(r) * available.get(s, 0) for s, _, r in targets}
    out = {s: 0.0 for s, _, _ in targets}
    if not open_:
        return out
    if total is None:
        scale = min(most[s] / p for s, p in open_.items())
        return out | {s: p * scale for s, p in open_.items()}
    if not fill:
        whole = sum(p for _, p, _ in targets)
        return out | {s: min(most[s], p / whole * total) for s, p in open_.items()}
    rest = float(total)
    while open_:
        weight = sum(open_.values())
        full = [s for s, p in open_.items() if p / weight * rest >= most[s]]
        if not full:
            return out | {s: p / weight * rest for s, p in open_.items()}
        for s in full:
            out[s] = most[s]
            rest -= most[s]
            del open_[s]
    return out


def measured(docs: DataFrame, key: str, text: str, source: str, targets: list[Target], path: str, weight: Column | None = None) -> DataFrame:
    """doc_id, source, w, n_tokens of the records of the listed sources, written once.

    ``weight`` is the quality weight of a record; without one it is 1 for a record that is as legible as the average of
    all records or more so, and halves with every standard deviation below it.  A null or non-positive weight counts as
    one that is taken last.
    """
    rows = docs.select(F.col(key).alias("doc_id"), source_name(F.col(source)).alias("source"), (legible(F.col(text)) if weight is None else weight.cast("double")).alias("legible"), F.col(text).alias("body"))
    rows = rows.filter(F.col("source").isin([s for s, _, _ in targets]) & (F.length("body") > 0))
    rows = materialize(with_tokens(rows, path).filter("n_tokens > 0"))
    w = F.col("legible")
    if weight is None:
        mean, sd = rows.agg(F.avg("legible"), F.stddev_pop("legible")).first()
        w = F.pow(F.lit(2.0), -F.greatest(F.lit(0.0), (F.lit(mean or 0.0) - F.col("legible")) / F.lit(max(sd or 0.0, 1e-9))))
    return rows.select("doc_id", "source", F.when(w > 1e-300, w).otherwise(1e-300).alias("w"), "n_tokens")


def select_mix(rows: DataFrame, targets: list[Target], total: float | str | None = "available", fill: bool = False, seed: int = SEED, edge_rows: int = EDGE_ROWS) -> DataFrame:
    """doc_id, source, n_tokens, repeats of measured(); a ``total`` of 'available' is the tokens of all listed sources."""
    spark = rows.sparkSession
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    rows = rows.withColumn("sort_key", -F.log(u) / F.col("w"))
    rows = rows.withColumn("spot", F.least(F.floor(float(1 << KEY_BITS) * (1 - 1 / (1 + F.col("sort_key")))), F.lit((1 << KEY_BITS) - 1)).cast("long"))
    available = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}  # one row per listed source
    if total == "available":
        total = float(sum(available.values()))
    plan = {}
    for s, budget in budgets(targets, available, total, fill).items():
        if have := available.get(s, 0):
            whole = int(budget / have + 1e-9)
            plan[s] = (whole, max(0.0, budget - whole * have))
    # (cell that holds the end of the budget, tokens before it) per source
    ends = dict.fromkeys(plan, (0, 0.0))
    shift, crowded = KEY_BITS, bool(plan)
    while crowded and shift > 0:
        shift -= CELL_BITS
        state = spark.createDataFrame([(s, plan[s][1], *ends[s]) for s in plan], "source string, rest double, cell long, before double")
        inside = rows.join(F.broadcast(state), "source").filter(F.shiftright("spot", shift + CELL_BITS) == F.col("cell"))
        cells = inside.groupBy("source", "rest", "before", F.shiftright("spot", shift).alias("cell")).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows"))  # at most sources x 2^CELL_BITS rows
        upto = F.col("before") + F.sum("n").over(Window.partitionBy("source").orderBy("cell"))
        first = cells.withColumn("upto", upto).filter("upto >= rest").groupBy("source").agg(F.min(F.struct("cell", (F.col("upto") - F.col("n")).alias("before"), "rows")).alias("c"))
        found = {r["source"]: r["c"] for r in first.collect()}
        ends = {s: (found[s]["cell"], found[s]["before"]) if s in found else (1 << KEY_BITS, 0.0) for s in plan}
        crowded = any(c["rows"] > edge_rows for c in found.values())
    state = spark.createDataFrame([(s, *plan[s], *ends[s]) for s in plan], "source string, epochs int, rest double, cell long, before double")
    rows = rows.join(F.broadcast(state), "source").withColumn("mine", F.shiftright("spot", shift))  # one row per source
    certain = rows.filter("mine <> cell").withColumn("extra", F.when(F.col("mine") < F.col("cell"), 1).otherwise(0))
    # of the cell in which the budget ends: the record that crosses it is taken if that comes nearer
    sorted_ = Window.partitionBy("source").orderBy("sort_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    edge = rows.filter("mine = cell").withColumn("upto", F.col("before") + F.sum("n_tokens").over(sorted_))
    edge = edge.withColumn("extra", F.when(F.col("upto") - F.col("n_tokens") / 2 <= F.col("rest"), 1).otherwise(0)).drop("upto")
    return (
        certain.unionByName(edge)
        .select("doc_id", "source", "n_tokens", (F.col("epochs") + F.col("extra")).cast("int").alias("repeats"))
        .filter("repeats > 0")
    )


def mix(docs: DataFrame, key: str, text: str, source: str, targets: DataFrame, path: str, total: float | str | None = "available", fill: bool = False, weight: Column | None = None) -> DataFrame:
    """doc_id, source, n_tokens, repeats: the selected records and how often each is used.

    Tokens are those of the rank file ``path``.  Records with a null or empty text, or of a source that is not listed,
    are not selected; rows repeated in ``docs`` are records of their own.  A listed source without records, share or
    repeats takes nothing.  ``repeats`` never exceeds the source's max_repeats.
    """
    wanted = read_targets(targets)
    return select_mix(measured(docs, key, text, source, wanted, path, weight), wanted, total, fill)


def mix_shares(docs: DataFrame, key: str, text: str, source: str, targets: DataFrame, path: str, total: float | str | None = "available", fill: bool = False, weight: Column | None = None) -> DataFrame:
    """source, target_share, max_repeats, available_tokens, selected_docs, selected_tokens, actual_share, most_repeats of every listed source."""
    wanted = read_targets(targets)
    rows = measured(docs, key, text, source, wanted, path, weight)
    have = rows.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    took = select_mix(rows, wanted, total, fill).groupBy("source").agg(
        F.count("*").alias("selected_docs"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("selected_tokens"), F.max("repeats").alias("most_repeats")
    )
    listed = docs.sparkSession.createDataFrame(wanted, "source string, target_share double, max_repeats int")
    out = listed.join(have, "source", "left").join(took, "source", "left").fillna(0, ["available_tokens", "selected_docs", "selected_tokens", "most_repeats"])
    # one row per source, so the window over all of them is small
    return out.withColumn("actual_share", F.round(F.col("selected_tokens") / F.sum("selected_tokens").over(Window.partitionBy(F.lit(1))), 6))


def _tables(spark, sf_dir: str):
    from public_tokenizers import path

    from quire.sources.tables import read_table

    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return docs, "doc_id", "text", "source", read_table(spark, sf_dir, "mix_targets"), path("byte_bpe_50k.tiktoken")


def document_mix(spark, sf_dir: str) -> DataFrame:
    """A mix as large as the listed sources together: each takes its share of that, or all that its repeats allow."""
    return mix(*_tables(spark, sf_dir))


def document_mix_shares(spark, sf_dir: str) -> DataFrame:
    return mix_shares(*_tables(spark, sf_dir))


def document_exact_shares(spark, sf_dir: str) -> DataFrame:
    """The shares of the largest mix in which every source that has documents reaches its share."""
    return mix_shares(*_tables(spark, sf_dir), total=None)


def document_full_shares(spark, sf_dir: str) -> DataFrame:
    """The shares of a mix in which the large sources make up for what the small ones lack."""
    return mix_shares(*_tables(spark, sf_dir), fill=True)
