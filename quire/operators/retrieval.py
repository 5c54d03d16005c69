"""Nearest neighbours over embeddings, exact."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.config import Settings

#: Queries of one block: their matrix is what each task holds beside a batch of vectors.
QUERY_BLOCK = 4096


def l2(a: Column, b: Column) -> Column:
    """Euclidean distance of two float arrays, summed in double precision."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def knn(queries: DataFrame, vectors: DataFrame, k: int, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, chunk_id, distance, rank: the k nearest vectors of each query, ties by smaller id.

    ``queries`` (query_id, embedding) go out in blocks of at most ``block`` (a matrix of some tens of MB on the driver and in
    each task), with one scan of the vectors each; every task keeps the best k of its own vectors per query, and only
    those are shuffled.  Vectors or queries that are null have no neighbours.
    """
    from pyspark.sql.window import Window

    q = queries.filter("embedding IS NOT NULL").select(F.col("query_id").cast("long"), "embedding")
    n = q.count()
    parts = max(1, -(-n // block))
    # queries share one row per block, at most ``block`` vectors each
    blocks = q.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)))
    best: DataFrame | None = None
    for p in range(parts):
        held = blocks.filter(F.col("part") == p).drop("part").toPandas()
        if held.empty:
            continue
        found = _nearest(vectors, held["query_id"].to_numpy(), np.stack(held["embedding"].to_numpy()).astype(np.float64), k)
        best = found if best is None else best.unionByName(found)
    if best is None:
        return queries.sparkSession.createDataFrame([], "query_id long, chunk_id long, distance double, rank int")
    order = Window.partitionBy("query_id").orderBy("distance", "chunk_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _nearest(vectors: DataFrame, ids: np.ndarray, matrix: np.ndarray, k: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast((ids, matrix))

    def run(batches):
        query_ids, queries = shared.value
        norms = (queries**2).sum(1)
        # the best k so far of every query, in the order of distance and id; inf where there are fewer
        best_d = np.full((len(queries), k), np.inf)
        best_i = np.full((len(queries), k), np.iinfo(np.int64).max)
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False)
            m = np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype(np.float64) if len(v) else np.empty((0, queries.shape[1]))
            for a in range(0, len(v), 2048):
                part, part_ids = m[a : a + 2048], v[a : a + 2048]
                near = norms[:, None] + (part**2).sum(1)[None, :] - 2 * queries @ part.T
                # all that may be nearer than the last of the best; equals are settled below, by exact distance and id
                worst = best_d[:, -1] ** 2
                if near.shape[1] > k:
                    worst = np.minimum(worst, np.maximum(np.partition(near, k - 1, axis=1)[:, k - 1], 0.0))
                qi, vi = np.nonzero(near <= (worst + 1e-9 * (1 + np.where(np.isfinite(worst), worst, 0.0)))[:, None])
                for q in np.unique(qi):
                    some = vi[qi == q] if len(qi) < 50_000 else vi[np.searchsorted(qi, q) : np.searchsorted(qi, q, "right")]
                    d = np.concatenate([best_d[q], np.sqrt(((queries[q] - part[some]) ** 2).sum(1))])
                    i = np.concatenate([best_i[q], part_ids[some]])
                    first = np.lexsort((i, d))[:k]
                    best_d[q], best_i[q] = d[first], i[first]
        held = np.isfinite(best_d)
        rows_q = np.repeat(query_ids, held.sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(rows_q), pa.array(best_i[held]), pa.array(best_d[held])], names=["query_id", "chunk_id", "distance"])

    return vectors.filter("embedding IS NOT NULL").select(F.col("chunk_id").cast("long"), "embedding").mapInArrow(run, "query_id long, chunk_id long, distance double")


def expand_parents(neighbours: DataFrame, chunk_parents: DataFrame) -> DataFrame:
    """query_id, parent_id, distance, n_chunks: each parent once with its nearest child."""
    return neighbours.join(chunk_parents, "chunk_id").groupBy("query_id", "parent_id").agg(F.min("distance").alias("distance"), F.count("*").alias("n_chunks"))


Client = Callable[[list[str]], list[list[float]]]


def embed(chunks: DataFrame, key: str, content: str, client: Client, settings: Settings = Settings()) -> DataFrame:
    """chunk_id, embedding by an injected client, in batches, each tried again with growing pauses."""
    size, retries, pause = settings.embed_batch, settings.retries, settings.first_backoff

    def call(texts: list[str]) -> list[list[float]]:
        import time

        for attempt in range(retries + 1):
            try:
                return client(texts)
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(pause * 2**attempt)
        raise AssertionError

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for a in range(0, len(part), size):
                some = part.iloc[a : a + size]
                yield pd.DataFrame({"chunk_id": some["chunk_id"], "embedding": call(some["content"].tolist())})

    rows = chunks.select(F.col(key).cast("long").alias("chunk_id"), F.col(content).alias("content")).filter(F.length("content") > 0)
    return rows.mapInPandas(run, "chunk_id long, embedding array<float>")
