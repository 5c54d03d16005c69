"""Cutting lineage so that a lost executor does not repeat the whole job.

``checkpoint()`` writes to the folder that the cluster names in ``spark.checkpoint.dir``.  Only a session on one
machine (tests, a laptop) gets a folder of our own where that setting is absent; a cluster without it is refused,
since a folder of each machine would be lost with the machine.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.errors import ConfigurationError


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder in force; sets one only where a session on one machine names none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not named and not sc.master.startswith("local"):
        raise ConfigurationError("spark.checkpoint.dir must name a folder that all machines share")
    sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "quire-checkpoints"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and go on from the copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of fewer splits than there are cores one split per core.

    Large inputs have many splits already and pass through without a shuffle; one small file would otherwise
    keep a single Python worker busy while the others wait.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def small_enough(df: DataFrame, row_bytes: int, limit_bytes: int) -> bool:
    """Whether ``df`` may be broadcast: its counted rows times ``row_bytes`` stay within ``limit_bytes``."""
    return df.limit(limit_bytes // row_bytes + 1).count() * row_bytes <= limit_bytes


def once(df: DataFrame, key: str) -> DataFrame:
    """Rows without exact repetitions, where most keys have one row: only keys are shuffled, and the rows of keys that have several."""
    k = F.col(key)
    several = materialize(df.groupBy(k).agg(F.count("*").alias("n")).filter("n > 1").select(k.alias("repeated")))
    keys = F.broadcast(several) if small_enough(several, 32, 32 << 20) else several
    same = k.eqNullSafe(F.col("repeated"))
    return df.join(keys, same, "left_anti").unionByName(df.join(keys, same, "left_semi").dropDuplicates())


def may_be_in(column: str, keys: DataFrame, most_bits: int = 28) -> Column:
    """Whether the long ``column`` may be among those of ``keys``, by a bitmap: true for all that are, and for few others.

    The bitmap has eight bits per key and 2^most_bits at most (32 MB), so it is broadcast whatever the number of keys; beyond
    that it lets more through.  It is for taking rows out before a join by shuffle, not for deciding.
    """
    spark = keys.sparkSession
    bits = min(most_bits, max(16, (8 * max(1, keys.count())).bit_length()))
    width = min(1 << bits, 1 << 23)
    place = F.pmod(F.col(column), F.lit(1 << bits))
    rows = keys.select(place.alias("i")).withColumn("slice", F.floor(F.col("i") / width).cast("int")).repartition((1 << bits) // width, "slice")

    def slices(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            i, part = (c.to_numpy() for c in batch.columns)
            for p in np.unique(part):
                at = i[part == p] - int(p) * width
                np.bitwise_or.at(held.setdefault(int(p), np.zeros(width // 8, np.uint8)), at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([h.tobytes() for h in held.values()], pa.binary())], names=["slice", "bitmap"])

    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows.mapInArrow(slices, "slice int, bitmap binary").collect():  # the bitmap, in slices
        a = r["slice"] * width // 8
        bitmap[a : a + width // 8] |= np.frombuffer(r["bitmap"], np.uint8)
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def member(values: pd.Series) -> pd.Series:
        i = values.to_numpy() & ((1 << bits) - 1)
        return pd.Series((shared.value[i >> 3] >> (i & 7)) & 1 == 1)

    return member(F.col(column))


def join_checked(left: DataFrame, right: DataFrame, on: list[str], how: str, row_bytes: int, limit_bytes: int = 32 << 20) -> DataFrame:
    """Broadcast ``right`` when it is counted small, otherwise join by shuffle (AQE splits hot keys)."""
    return left.join(F.broadcast(right) if small_enough(right, row_bytes, limit_bytes) else right, on, how)
