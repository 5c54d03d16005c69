"""Constraints, cascades and writes of the store's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.errors import SchemaError

_BOX = T.StructType([T.StructField(c, T.DoubleType()) for c in "ltrb"])
_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "binary": T.BinaryType(),
    "timestamp": T.TimestampType(), "box": _BOX, "vector": T.ArrayType(T.FloatType()),
}


def _schema(spec: str) -> T.StructType:
    """A schema written as 'name type, name type'; it needs no running session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (x.split() for x in spec.split(","))])


SCHEMAS: dict[str, T.StructType] = {
    "documents": _schema("id string, title string, version_label string, source_url string, checksum_sha256 string, pdf_bytes binary, docling_json string, created_at timestamp"),
    "embedding_metadata": _schema("id bigint, model_name string, dimension int, docling_version string, created_at timestamp"),
    "sections": _schema("id bigint, document_id string, level int, heading string, heading_path string, order_index int, page_start int, page_end int, metadata string, created_at timestamp"),
    "raw_blocks": _schema(
        "id bigint, document_id string, section_id bigint, block_type string, text_content string, markdown_content string, page_number int, page_range string, docling_level int, bbox box, is_continuation boolean, element_id string, metadata string, created_at timestamp"
    ),
    "parent_chunks": _schema("id bigint, section_id bigint, content string, token_count int, page_start int, page_end int, metadata string, created_at timestamp"),
    "child_chunks": _schema("id bigint, parent_id bigint, section_id bigint, content string, token_count int, chunk_index int, page_start int, page_end int, metadata string, created_at timestamp"),
    "vec_child_chunks": _schema("chunk_id bigint, embedding vector"),
}

#: What a row must fulfil: name and SQL condition.
CHECKS: dict[str, tuple[tuple[str, str], ...]] = {
    "documents": (("id", "id IS NOT NULL"), ("title", "title IS NOT NULL"), ("checksum", "checksum_sha256 IS NOT NULL")),
    "embedding_metadata": (("dimension", "dimension > 0"),),
    "sections": (("level", "level >= 1"), ("heading", "heading IS NOT NULL"), ("order", "order_index IS NOT NULL")),
    "raw_blocks": (("content", "text_content IS NOT NULL OR markdown_content IS NOT NULL"), ("type", "block_type IS NOT NULL"), ("page", "page_number IS NOT NULL")),
    "parent_chunks": (("tokens", "token_count > 0"), ("content", "length(content) > 0")),
    "child_chunks": (("tokens", "token_count > 0"), ("content", "length(content) > 0"), ("index", "chunk_index >= 0")),
    "vec_child_chunks": (("id", "chunk_id IS NOT NULL"),),
}


def violations(table: str) -> Column:
    """Names of the conditions that a row breaks; a null condition is broken."""
    names = [F.when(F.coalesce(F.expr(sql), F.lit(False)), F.lit(None)).otherwise(F.lit(name)) for name, sql in CHECKS[table]]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def split_rejects(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows to write, rejected rows with ``broken``)."""
    marked = df.withColumn("broken", violations(table))
    return marked.filter(F.size("broken") == 0).drop("broken"), marked.filter(F.size("broken") > 0)


def insert(rows: DataFrame, folder: str, table: str) -> tuple[int, int]:
    """Appends the rows that fulfil the table's conditions; (written, rejected).  Raises SchemaError if none does, also for no rows at all."""
    counts = rows.select(F.size(violations(table)).alias("n")).agg(F.count_if(F.col("n") == 0), F.count_if(F.col("n") > 0)).first()
    if not counts[0]:
        raise SchemaError(f"none of {counts[1]} rows can be written to {table}")
    split_rejects(rows, table)[0].write.mode("append").parquet(f"{folder}/{table}.parquet")
    return counts[0], counts[1]


def validate(df: DataFrame, table: str) -> None:
    """Raises SchemaError if a column is missing or of another type; further columns are allowed."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = [f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[table] if have.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise SchemaError(f"{table} lacks {', '.join(wrong)}")


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Columns that the table should have; the difference of two small sets."""
    return sorted({f.name for f in SCHEMAS[table]} - set(df.columns))


def create_all(spark: SparkSession, folder: str) -> None:
    """Empty tables where there are none."""
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{folder}/{name}.parquet")


def drop_all(spark: SparkSession, folder: str) -> list[str]:
    """Deletes the tables of a store; the names of those that were there."""
    jvm = spark._jvm.org.apache.hadoop.fs
    gone = []
    for name in SCHEMAS:
        path = jvm.Path(f"{folder}/{name}.parquet")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            gone.append(name)
    return gone


def schema_info(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, column_name, data_type, expected: what the tables hold, and what the store's schema asks of them and they lack (data_type null)."""
    rows = []
    for name, df in sorted(tables.items()):
        wanted = {f.name: f.dataType.simpleString() for f in SCHEMAS.get(name, T.StructType())}
        have = {f.name: f.dataType.simpleString() for f in df.schema}
        rows += [(name, c, have.get(c), c in wanted) for c in sorted(wanted.keys() | have.keys())]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, expected boolean")


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, n_rows of every table."""
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in sorted(tables.items())]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def delete_document(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """The tables without the documents of ``gone`` (id) and all that hangs on them."""
    out = dict(tables)
    out["documents"] = tables["documents"].join(gone.select("id"), "id", "left_anti")
    out["raw_blocks"] = tables["raw_blocks"].join(gone.select(F.col("id").alias("document_id")), "document_id", "left_anti")
    dead = tables["sections"].join(gone.select(F.col("id").alias("document_id")), "document_id", "left_semi").select("id")
    return out | delete_sections({k: out[k] for k in ("raw_blocks", "sections", "parent_chunks") if k in out}, dead)


def delete_sections(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Without the sections of ``gone`` (id): their chunks go, their blocks stay without a section."""
    ids = gone.select(F.col("id").alias("section_id"), F.lit(True).alias("dead")).distinct()
    out = dict(tables)
    out["sections"] = tables["sections"].join(gone.select("id").distinct(), "id", "left_anti")
    if "parent_chunks" in tables:
        out["parent_chunks"] = tables["parent_chunks"].join(ids, "section_id", "left_anti")
    if "raw_blocks" in tables:
        cut = tables["raw_blocks"].join(ids, "section_id", "left")
        out["raw_blocks"] = cut.withColumn("section_id", F.when(F.col("dead").isNull(), F.col("section_id"))).drop("dead").select(*tables["raw_blocks"].columns)
    return out


def set_sections(blocks: DataFrame, assigned: DataFrame) -> DataFrame:
    """Blocks with the section_id of ``assigned`` (document_id, id, section_id), null for the others."""
    return blocks.drop("section_id").join(assigned.select("document_id", "id", "section_id"), ["document_id", "id"], "left").select(*blocks.columns)


def clear_sections(tables: dict[str, DataFrame], documents: DataFrame) -> dict[str, DataFrame]:
    """Before sections of ``documents`` (id) are rebuilt: theirs and their chunks go, their blocks lose the section."""
    old = tables["sections"].join(documents.select(F.col("id").alias("document_id")).distinct(), "document_id", "left_semi").select("id")
    return delete_sections(tables, old)


def update_json(docs: DataFrame, updates: DataFrame) -> DataFrame:
    """Documents with the docling_json of ``updates`` (id, docling_json), the others as they are.

    Raises SchemaError if an id is unknown.  An id with several updates takes the largest text.
    """
    new = updates.groupBy("id").agg(F.max(F.struct("docling_json")).alias("new"))
    if new.join(docs.select("id"), "id", "left_anti").limit(1).count():
        raise SchemaError("an update names a document that is not there")
    both = docs.join(new, "id", "left")
    return both.withColumn("docling_json", F.when(F.col("new").isNotNull(), F.col("new.docling_json")).otherwise(F.col("docling_json"))).select(*docs.columns)


def list_stores(spark: SparkSession, folder: str) -> DataFrame:
    """store, n_bytes, n_documents of the stores (folders named *_rag.db) of a folder; sizes from a listing of files, no file is read for them."""
    name = F.regexp_extract("path", r"/([^/]*_rag\.db)/", 1).alias("store")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/*_rag.db").select("path", "length")
    sizes = files.groupBy(name).agg(F.sum("length").alias("n_bytes"))
    docs = spark.read.schema(SCHEMAS["documents"]).parquet(f"{folder}/*_rag.db/documents.parquet").select(F.col("_metadata.file_path").alias("path"))
    counts = docs.groupBy(name).agg(F.count("*").alias("n_documents"))
    return sizes.join(counts, "store", "left").select("store", "n_bytes", F.coalesce("n_documents", F.lit(0)).alias("n_documents"))


def append_new(spark: SparkSession, rows: DataFrame, folder: str, table: str, key: str) -> int:
    """Appends the rows whose key the stored table lacks; returns how many.  A second call writes nothing."""
    path = f"{folder}/{table}.parquet"
    fresh = rows.dropDuplicates([key]).join(spark.read.parquet(path).select(key), key, "left_anti").select(*rows.columns)
    before = spark.read.parquet(path).count()
    fresh.write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path).count() - before
