"""Counts and reports over blocks, sections and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Upper bounds and names of the size classes, in order.
BUCKETS = ((500, "< 500"), (1000, "500-999"), (1500, "1000-1499"), (2000, "1500-1999"), (None, ">= 2000"))


def bucket(tokens: Column) -> tuple[Column, Column]:
    """Name and rank of a size class; a null size has neither."""
    name, rank = F.lit(BUCKETS[-1][1]), F.lit(len(BUCKETS))
    for i, (bound, label) in reversed(list(enumerate(BUCKETS[:-1], 1))):
        name, rank = F.when(tokens < bound, label).otherwise(name), F.when(tokens < bound, i).otherwise(rank)
    return F.when(tokens.isNotNull(), name), F.when(tokens.isNotNull(), rank)


def type_counts(blocks: DataFrame) -> DataFrame:
    """block_type, n, pct of all blocks, most frequent first."""
    # one row per type, so the window over all of them is small
    counts = blocks.groupBy("block_type").agg(F.count("*").alias("n"))
    share = F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 4)
    return counts.select("block_type", "n", share.alias("pct")).orderBy(F.desc("n"), "block_type")


def page_span(blocks: DataFrame) -> DataFrame:
    """document_id, first_page, last_page, n_pages: 0 pages if a document has a block without page."""
    span = blocks.groupBy("document_id").agg(F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"))
    known = (F.col("first_page") != 0) & (F.col("last_page") != 0)
    return span.withColumn("n_pages", F.when(known, F.col("last_page") - F.col("first_page") + 1).otherwise(0))


def content_counts(blocks: DataFrame) -> DataFrame:
    """document_id, n_blocks, with_text, with_markdown, with_neither, in_section."""
    text, markdown = F.col("text_content").isNotNull(), F.col("markdown_content").isNotNull()
    return blocks.groupBy("document_id").agg(
        F.count("*").alias("n_blocks"), F.count_if(text).alias("with_text"), F.count_if(markdown).alias("with_markdown"), F.count_if(~text & ~markdown).alias("with_neither"), F.count_if(F.col("section_id").isNotNull()).alias("in_section")
    )


def missing_ranges(blocks: DataFrame) -> DataFrame:
    """document_id, first_page, last_page: the gaps between pages that hold blocks; one row per gap, however wide a wild page number makes it."""
    pages = blocks.filter("page_number > 0").select("document_id", "page_number").distinct()
    following = F.lead("page_number").over(Window.partitionBy("document_id").orderBy("page_number"))
    gaps = pages.select("document_id", (F.col("page_number") + 1).alias("first_page"), (following - 1).alias("last_page"))
    return gaps.filter("last_page >= first_page")


def missing_pages(blocks: DataFrame) -> DataFrame:
    """document_id, page_number: pages between the first and the last that hold no block, one by one; where page numbers can't be trusted take missing_ranges()."""
    return missing_ranges(blocks).select("document_id", F.explode(F.sequence("first_page", "last_page")).alias("page_number"))


def token_stats(chunks: DataFrame) -> DataFrame:
    """One row: n, least, most, mean, total, median and number over the limit of token_count."""
    t = F.col("token_count")
    return chunks.agg(
        F.count("*").alias("n"), F.min(t).alias("least"), F.max(t).alias("most"), F.round(F.avg(t), 6).alias("mean"), F.sum(t).cast("bigint").alias("total"), F.median(t).alias("median"), F.count_if(t > 2000).alias("over_limit")
    )


def histogram(chunks: DataFrame) -> DataFrame:
    """bucket, rank, n in the order of the sizes."""
    name, rank = bucket(F.col("token_count"))
    return chunks.groupBy(name.alias("bucket"), rank.alias("rank")).agg(F.count("*").alias("n")).orderBy("rank")


def coverage(sections: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: level-2 sections, those with chunks, chunks per section."""
    ids = chunks.groupBy("section_id").agg(F.count("id").alias("n"))  # joined after counting: one row per section
    level2 = sections.filter("level = 2").select(F.col("id").alias("section_id"))
    joined = level2.join(ids, "section_id", "left")
    return joined.agg(
        F.countDistinct("section_id").alias("total_sections"), F.countDistinct(F.when(F.col("n") > 0, F.col("section_id"))).alias("with_chunks"),
        F.round(F.coalesce(F.sum("n"), F.lit(0)).cast("double") / F.countDistinct("section_id"), 6).alias("chunks_per_section"),
    )


def section_rollup(sections: DataFrame, chunks: DataFrame, level: int = 2) -> DataFrame:
    """section_id, heading, order_index, chunk_count, total_tokens, min_tokens, max_tokens of each section."""
    sums = chunks.groupBy("section_id").agg(
        F.count("id").alias("chunk_count"), F.sum("token_count").cast("bigint").alias("total_tokens"), F.min("token_count").alias("min_tokens"), F.max("token_count").alias("max_tokens"),
    )
    heads = sections.filter(F.col("level") == level).select(F.col("id").alias("section_id"), "heading", "order_index")
    return heads.join(sums, "section_id", "left").withColumn("chunk_count", F.coalesce("chunk_count", F.lit(0)))


def section_chunks(sections: DataFrame, chunks: DataFrame, level: int = 2) -> DataFrame:
    """section_id, id, shown: the chunks of each section as rows, 'id(tokens)'; rows, so that no section is too long for a list."""
    heads = sections.filter(F.col("level") == level).select(F.col("id").alias("section_id"))
    shown = F.concat(F.col("id").cast("string"), F.lit("("), F.coalesce("token_count", F.lit(0)).cast("string"), F.lit(")"))
    return chunks.select("section_id", "id", shown.alias("shown")).join(heads, "section_id")


def level_counts(sections: DataFrame) -> DataFrame:
    return sections.groupBy("level").agg(F.count("*").alias("n"), F.countDistinct("document_id").alias("n_documents"))


def report(sections: DataFrame, chunks: DataFrame) -> DataFrame:
    """The statistics report as rows of measure and value."""

    def rows(one: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in one.columns]
        return one.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")

    measures = rows(token_stats(chunks)).unionByName(rows(coverage(sections, chunks)))
    sizes = histogram(chunks).filter("bucket IS NOT NULL").select(F.concat(F.lit("bucket "), "bucket").alias("measure"), F.col("n").cast("double").alias("value"))
    return measures.unionByName(sizes)
