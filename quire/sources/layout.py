"""Parser output as a data source, and the interface a parser must have.

``spark.read.format("layout_json").load(folder)`` gives one row per file: its name, checksum and text.  Files
are read in Python tasks, one partition per group of files, and nothing of them passes through the driver but
their names.  The folder may be a path or the URI of any storage that Arrow reads (file, hdfs, s3, gs).
``read_layouts`` gives the same rows through Spark's own file source, whatever storage the cluster is set up for.
"""

from __future__ import annotations

import hashlib
import os
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


@dataclass(frozen=True)
class ParseResult:
    """What a parser gives for one document."""

    document: dict
    markdown: str
    num_pages: int
    parser_version: str

    def __post_init__(self) -> None:
        if not isinstance(self.document, dict) or not isinstance(self.markdown, str):
            raise TypeError("document must be a dict and markdown a text")
        if self.num_pages < 1 or not self.parser_version.strip():
            raise ValueError("a result has at least one page and names its parser's version")


class Parser(ABC):
    """Where a document parser is plugged in."""

    @abstractmethod
    def parse(self, path: str) -> ParseResult: ...


def _storage(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder))


class FileGroup(InputPartition):
    def __init__(self, paths: tuple[str, ...]):
        self.paths = paths


class LayoutReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.group = int(options.get("filesPerTask", "64"))

    def partitions(self) -> list[FileGroup]:
        storage, folder = _storage(self.folder)
        paths = sorted(f.path for f in storage.get_file_info(fs.FileSelector(folder)) if f.is_file and f.path.endswith(".json"))
        return [FileGroup(tuple(paths[i : i + self.group])) for i in range(0, len(paths), self.group)]

    def read(self, partition: FileGroup) -> Iterator[tuple]:
        storage, _ = _storage(self.folder)
        for path in partition.paths:
            with storage.open_input_stream(path) as f:
                data = f.read()
            yield os.path.basename(path), hashlib.sha256(data).hexdigest(), data.decode("utf-8", "replace")


class LayoutJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "layout_json"

    def schema(self) -> str:
        return "file_name string, checksum_sha256 string, docling_json string"

    def reader(self, schema) -> LayoutReader:
        return LayoutReader(self.options)


def enable(spark: SparkSession) -> None:
    spark.dataSource.register(LayoutJson)


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """file_name, checksum_sha256, docling_json of the .json files of a folder, by Spark's file source."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)\z", 1).alias("file_name"), F.sha2("content", 256).alias("checksum_sha256"), F.decode("content", "UTF-8").alias("docling_json"))
