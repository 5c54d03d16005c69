"""Navigation in the section tree and joins between its tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SEPARATOR = " > "


def parent_path(path: Column) -> Column:
    """The path without its last heading; null at the top."""
    return F.when(path.contains(SEPARATOR), F.regexp_replace(path, r"(?s)^(.*) > .*$", "$1"))


def ancestor_paths(path: Column) -> Column:
    """All paths above a path, so that descendants can be found by an equality join."""
    parts = F.split(path, SEPARATOR)
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), SEPARATOR))).otherwise(F.array().cast("array<string>"))


def descendants(sections: DataFrame) -> DataFrame:
    """id, descendant_id, depth: every section with all sections below it in its document.

    Each section is joined by the paths above it, not by a prefix comparison of all pairs.
    """
    below = sections.select("document_id", F.col("id").alias("descendant_id"), F.col("level").alias("l"), F.explode(ancestor_paths(F.col("heading_path"))).alias("heading_path"))
    return sections.select("document_id", "id", "level", "heading_path").join(below, ["document_id", "heading_path"]).filter("l > level").select("id", "descendant_id", (F.col("l") - F.col("level")).alias("depth"))


def parents(sections: DataFrame) -> DataFrame:
    """id, parent_id: the section whose path is this one's without the last heading, the smallest id of several."""
    up = sections.select("document_id", "id", parent_path(F.col("heading_path")).alias("path")).filter("path IS NOT NULL")
    heads = sections.groupBy("document_id", F.col("heading_path").alias("path")).agg(F.min("id").alias("parent_id"))
    return up.join(heads, ["document_id", "path"]).select("id", "parent_id")


def siblings(sections: DataFrame, reach: int = 5) -> DataFrame:
    """id, sibling_id: other sections of the same level and parent within ``reach`` places in the order.

    The band is cut into cells of its width, so the join is by equality and a cell holds few sections.
    """
    rows = sections.select("document_id", "id", "level", F.coalesce(parent_path(F.col("heading_path")), F.lit("")).alias("up"), "order_index", F.floor(F.col("order_index") / (reach + 1)).alias("cell"))
    other = rows.select("document_id", "level", "up", F.col("id").alias("sibling_id"), F.col("order_index").alias("o"), F.explode(F.array(F.col("cell") - 1, "cell", F.col("cell") + 1)).alias("cell"))
    near = F.col("o").between(F.col("order_index") - reach, F.col("order_index") + reach)
    return rows.join(other, ["document_id", "level", "up", "cell"]).filter(near & (F.col("id") != F.col("sibling_id"))).select("id", "sibling_id")


def children(sections: DataFrame, blocks: DataFrame) -> DataFrame:
    """id, child_id, n_blocks: sections one level below in the same branch, with their blocks counted."""
    direct = descendants(sections).filter("depth = 1").select("id", F.col("descendant_id").alias("child_id"))
    counts = blocks.filter("section_id IS NOT NULL").groupBy(F.col("section_id").alias("child_id")).agg(F.count("*").alias("n_blocks"))
    return direct.join(counts, "child_id", "left").select("id", "child_id", F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"))


def chunks_with_sections(chunks: DataFrame, sections: DataFrame) -> DataFrame:
    """Chunks that have a section, with its heading, path and place."""
    heads = sections.select(F.col("id").alias("section_id"), "heading", "heading_path", F.col("order_index").alias("section_order"), "level")
    return chunks.join(heads, "section_id")


def reading_order(blocks: DataFrame) -> DataFrame:
    """document_id, id, pos: blocks numbered by page and id within their document.

    Blocks are numbered within their page, and pages by the blocks before them, so a long document is spread over
    its pages.
    """
    page = Window.partitionBy("document_id", "page_number")
    before = Window.partitionBy("document_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("document_id", "page_number").agg(F.count("*").alias("n"))
    sizes = sizes.select(F.col("document_id").alias("d"), F.col("page_number").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = blocks.withColumn("within", F.row_number().over(page.orderBy("id")))
    same = F.col("document_id").eqNullSafe(F.col("d")) & F.col("page_number").eqNullSafe(F.col("p"))
    return rows.join(sizes, same).select("document_id", "id", (F.col("before") + F.col("within")).cast("int").alias("pos"))


def search(chunks: DataFrame, sections: DataFrame, keyword: str, limit: int) -> DataFrame:
    """The first chunks by id that contain the keyword in any case; its wildcards are plain characters."""
    hit = F.lower("content").contains(keyword.lower())
    rows = chunks_with_sections(chunks.filter(hit), sections)
    return rows.orderBy("id").limit(limit)
