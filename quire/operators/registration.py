"""Registering sources once, by checksum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.errors import RegistrationError


def scan_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, content, checksum_sha256, n_bytes of the files of a folder.

    Files of zero length hold nothing to register and have no row; a file that can't be read fails the scan.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content", F.sha2("content", 256).alias("checksum_sha256"), F.col("length").alias("n_bytes"))


def document_key(checksum: Column) -> Column:
    """An id that depends on nothing but the content."""
    return F.concat_ws("-", *[F.substring(checksum, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def stem(path: Column) -> Column:
    """File name without folder and last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)\z", 1), r"(?<=.)\.[^.]*\z", "")


def known(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows whose checksum is registered."""
    return incoming.join(existing.select("checksum_sha256").distinct(), "checksum_sha256", "left_semi")


def unknown(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows whose checksum is not registered; rows without a checksum count as unknown."""
    return incoming.join(existing.select("checksum_sha256").distinct(), "checksum_sha256", "left_anti")


def register(incoming: DataFrame, existing: DataFrame, order: str) -> DataFrame:
    """One row per new checksum, the one smallest by ``order``.  Rows without a checksum are not registered."""
    fresh = unknown(incoming.filter("checksum_sha256 IS NOT NULL"), existing)
    columns = [c for c in fresh.columns if c != "checksum_sha256"]
    first = fresh.groupBy("checksum_sha256").agg(F.min_by(F.struct(*columns), F.col(order)).alias("row"))
    return first.select("checksum_sha256", "row.*")


def register_models(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of embedding_metadata to add: one for each incoming model_name that is not there yet, of several the smallest by dimension and version."""
    fresh = incoming.filter("model_name IS NOT NULL").join(existing.select("model_name").distinct(), "model_name", "left_anti")
    return fresh.groupBy("model_name").agg(F.min(F.struct("dimension", "docling_version")).alias("row")).select("model_name", "row.*")


def sole_document(docs: DataFrame, key: str) -> str | None:
    """The id if there is exactly one document."""
    rows = docs.select(key).limit(2).collect()
    return rows[0][0] if len(rows) == 1 else None


def require(docs: DataFrame, key: str, value) -> DataFrame:
    """The document of an id; raises if there is none."""
    out = docs.filter(F.col(key) == value)
    if not out.limit(1).count():
        raise RegistrationError(f"no document {value!r}")
    return out
