"""Splitting oversized items at natural boundaries.

An item is measured in tokens, maximal runs of characters that are not Unicode white space.  Dynamic
programming over the boundary positions of an item finds the cuts of least total cost: every cut costs by the
kind of its boundary (paragraph < line or row < sentence < clause < word) and every piece by its squared
relative distance from an even share, subject to the maximum length including the repeated part.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.whitespace import LINE_ENDS, TOKEN_RE, count_ws_tokens
from quire.plans.materialize import spread

KINDS = ("paragraph", "line", "sentence", "clause", "word")
PENALTY = np.array([0.0, 1.0, 2.0, 8.0, 16.0])
IMBALANCE_WEIGHT = 4.0

_LINE_END = re.compile(f"\r\n|[{LINE_ENDS}]")
_SENTENCE_END = re.compile("[.!?…。！？][\"'”’»)\\]*_]*$")
_CLAUSE_END = re.compile("[,;:|][\"'”’»)\\]*_]*$")

PIECE_FIELDS = (
    T.StructField("piece_no", T.IntegerType()),
    T.StructField("n_pieces", T.IntegerType()),
    T.StructField("start_char", T.LongType()),
    T.StructField("end_char", T.LongType()),
    T.StructField("overlap_chars", T.LongType()),
    T.StructField("n_tokens", T.IntegerType()),
    T.StructField("cut", T.StringType()),
    T.StructField("piece", T.StringType()),
)


def boundary_kinds(text: str, starts: list[int], ends: list[int]) -> np.ndarray:
    """Kind (index into KINDS) of the boundary before token k, for k = 1 .. n-1."""
    kinds = np.empty(max(0, len(starts) - 1), dtype=np.int8)
    for k in range(1, len(starts)):
        gap = text[ends[k - 1] : starts[k]]
        if gap == " " and text[ends[k - 1] - 1].isalnum():
            kinds[k - 1] = 4
            continue
        breaks = 0 if gap == " " else len(_LINE_END.findall(gap))
        if breaks:
            kinds[k - 1] = 0 if breaks > 1 else 1
            continue
        tail = text[max(starts[k - 1], ends[k - 1] - 8) : ends[k - 1]]
        kinds[k - 1] = 2 if _SENTENCE_END.search(tail) else 3 if _CLAUSE_END.search(tail) else 4
    return kinds


def plan_cuts(kinds: np.ndarray, n_tokens: int, max_tokens: int, overlap: int) -> list[int]:
    """Token indexes at which new content of pieces 2, 3, ... begins.

    Candidates are all natural boundaries; where two of them lie further apart than a piece can reach, every
    word and clause boundary between them joins in, so a plan always exists.
    """
    if n_tokens <= max_tokens:
        return []
    room = max_tokens - overlap
    natural = np.flatnonzero(kinds <= 2) + 1
    marks = np.concatenate(([0], natural, [n_tokens]))
    wide = [np.arange(a + 1, b) for a, b in zip(marks[:-1], marks[1:], strict=True) if b - a > room]
    at = np.unique(np.concatenate([marks, *wide]))
    penalty = np.concatenate(([0.0], PENALTY[kinds[at[1:-1] - 1]], [0.0]))
    share = n_tokens / -(-(n_tokens - overlap) // room)
    cost, back = np.full(len(at), np.inf), np.zeros(len(at), dtype=np.int64)
    cost[0] = 0.0
    lowest = np.searchsorted(at, at - room, side="left")
    for j in range(1, len(at)):
        first = max(1, int(lowest[j]))
        best, source = np.inf, 0
        if at[j] <= max_tokens:
            best = IMBALANCE_WEIGHT * ((at[j] - share) / share) ** 2
        if first < j:
            total = cost[first:j] + IMBALANCE_WEIGHT * ((at[j] - at[first:j] - share) / share) ** 2
            k = int(total.argmin())
            if total[k] < best:
                best, source = float(total[k]), first + k
        cost[j], back[j] = best + penalty[j], source
    cuts, j = [], int(back[-1])
    while j > 0:
        cuts.append(int(at[j]))
        j = int(back[j])
    return cuts[::-1]


def split_text(text: str, max_tokens: int, overlap: int) -> list[tuple[int, int, int, int, str]]:
    """Pieces as (start, end, repeated characters, tokens, kind of the cut at their end).

    White space between two pieces stays with the earlier one and leading white space with the first, so the
    pieces without their repeated parts, joined, are the text.
    """
    spans = [m.span() for m in TOKEN_RE.finditer(text)]
    starts, ends = [s for s, _ in spans], [e for _, e in spans]
    n = len(spans)
    if n <= max_tokens:
        return [(0, len(text), 0, n, "end")] if text else []
    kinds = boundary_kinds(text, starts, ends)
    edges = [0, *plan_cuts(kinds, n, max_tokens, overlap), n]
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        first = max(0, a - overlap) if a else 0
        fresh = starts[a] if a else 0
        begin = starts[first] if a else 0
        end = starts[b] if b < n else len(text)
        out.append((begin, end, fresh - begin, b - first, KINDS[kinds[b - 1]] if b < n else "end"))
    return out


def split_oversized(df: DataFrame, keys: list[str], text: str | Column, max_tokens: int = 2000, overlap: int = 0) -> DataFrame:
    """One row per piece of every item longer than ``max_tokens``; shorter items give no row.

    Each piece has at most ``max_tokens`` tokens and repeats the last ``overlap`` tokens of its predecessor
    (all of a first piece that has fewer).
    Null and empty texts are not oversized.  Rows that repeat an item exactly are split once.  Other columns of
    ``df`` are ignored, whatever their names.  Raises ValueError unless 0 <= overlap < max_tokens.

    The length test runs in the JVM, and only oversized texts reach Python.
    """
    if not 0 <= overlap < max_tokens:
        raise ValueError("overlap must be at least 0 and less than max_tokens")
    body = F.col(text) if isinstance(text, str) else text
    # an item of n tokens has at least 2n-1 characters, so most rows are settled without counting
    large = (
        df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], body.alias("body"))
        .filter((F.length("body") > 2 * max_tokens) & (count_ws_tokens(F.col("body")) > max_tokens))
        .dropDuplicates()
    )
    # few rows that cost much each: as many tasks as the session has, not as few as their bytes would fill
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return _split_rows(large.repartition(tasks), keys, max_tokens, overlap)


def _split_rows(large: DataFrame, keys: list[str], max_tokens: int, overlap: int) -> DataFrame:
    schema = T.StructType([T.StructField(k, large.schema[f"k{i}"].dataType) for i, k in enumerate(keys)] + list(PIECE_FIELDS))
    n_keys = len(keys)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            columns: list[list] = [[] for _ in arrow]
            held = [c.to_pylist() for c in batch.columns[:n_keys]]
            for r, body in enumerate(batch.column(n_keys)):
                body = body.as_py()
                pieces = split_text(body, max_tokens, overlap)
                for no, (begin, end, repeated, tokens, cut) in enumerate(pieces, 1):
                    row = [h[r] for h in held] + [no, len(pieces), begin, end, repeated, tokens, cut, body[begin:end]]
                    for c, v in zip(columns, row, strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return large.mapInArrow(run, schema)


def oversized_items(spark, sf_dir: str) -> DataFrame:
    """Both tables' fields under one set of columns: item_table, item_id, body."""
    from quire.sources.tables import read_table

    a = read_table(spark, sf_dir, "parent_chunks").select(F.lit("parent_chunks").alias("item_table"), F.col("id").alias("item_id"), F.col("content").alias("body"))
    b = read_table(spark, sf_dir, "raw_blocks").select(F.lit("raw_blocks").alias("item_table"), F.col("id").alias("item_id"), F.col("markdown_content").alias("body"))
    return spread(a).unionByName(spread(b))
