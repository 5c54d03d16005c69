"""Blocks to sections.

Every join has the document, and where it helps the page, as an equality key, so the longest document spreads
over tasks by its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.text import heading_key

FURNITURE = ("page_header", "page_footer")


def chapters(sections: DataFrame) -> DataFrame:
    """document_id, chapter, chapter_pos, page_start, page_end, next_chapter of the level-1 sections.

    The next chapter is the first one in reading order (pos) of a larger order_index.
    """
    tops = sections.filter("level = 1").select("document_id", F.col("order_index").alias("chapter"), F.col("pos").alias("chapter_pos"), "page_start", "page_end")
    larger = Window.partitionBy("document_id").orderBy(F.desc("chapter")).rowsBetween(Window.unboundedPreceding, -1)
    return tops.withColumn("next_chapter", F.min(F.struct("chapter_pos", "chapter")).over(larger)["chapter"])


def chapter_sections(sections: DataFrame, tops: DataFrame) -> DataFrame:
    """Sections with their chapter; those before the first chapter belong to none."""
    ends = sections.groupBy("document_id").agg(F.max("order_index").alias("last"))
    until = F.coalesce(F.col("next_chapter") - 1, F.col("last"))
    places = tops.join(ends, "document_id").select("document_id", "chapter", "chapter_pos", F.explode(F.sequence("chapter", until)).alias("order_index"))
    return sections.join(places, ["document_id", "order_index"])


def pages_within(ranges: DataFrame, blocks: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``ranges`` with each page_number from page_start to page_end that holds a block of the document.

    The pages of a document that hold blocks are numbered, and a range becomes one of these numbers, so a wild page number
    costs no more than its block.  Bounds find their numbers in one pass over a document's pages and ranges.
    """
    pages = blocks.filter("page_number IS NOT NULL").select("document_id", "page_number").distinct()
    bounds = ranges.filter("page_end >= page_start").withColumn("bounds", F.struct(*columns))
    low = bounds.select("document_id", (F.col("page_start").cast("long") - 1).alias("at"), F.lit(True).alias("low"), "bounds", "page_start", "page_end")
    high = bounds.select("document_id", F.col("page_end").cast("long").alias("at"), F.lit(False).alias("low"), "bounds", "page_start", "page_end")
    marks = low.unionByName(high).unionByName(pages.select("document_id", F.col("page_number").cast("long").alias("at"), F.col("page_number")), allowMissingColumns=True)
    # pages come before the bounds of their number
    upto = F.count("page_number").over(Window.partitionBy("document_id").orderBy("at", F.col("page_number").isNull()).rowsBetween(Window.unboundedPreceding, 0))
    numbered = marks.withColumn("upto", upto)
    spans = numbered.filter("low IS NOT NULL").groupBy("document_id", "bounds", "page_start", "page_end").agg(F.min("upto").alias("a"), F.max("upto").alias("b")).filter("b > a")
    inside = spans.select("document_id", "bounds", F.explode(F.sequence(F.col("a") + 1, "b")).alias("upto"))
    held = numbered.filter("low IS NULL").select("document_id", "upto", "page_number")
    rows = inside.join(held, ["document_id", "upto"])
    return rows.select(*[F.col("document_id") if c == "document_id" else F.col(f"bounds.{c}").alias(c) for c in columns], "page_number")


def chapter_blocks(blocks: DataFrame, tops: DataFrame) -> DataFrame:
    """document_id, chapter, chapter_pos, id, page_number, block_type, text_content: blocks on the pages of each chapter."""
    return blocks.join(pages_within(tops, blocks, "document_id", "chapter", "chapter_pos"), ["document_id", "page_number"])


def header_matches(members: DataFrame, inside: DataFrame) -> DataFrame:
    """document_id, chapter, order_index, header_id: the first header block, by page and id, near a section that reads like it."""
    heads = inside.filter("block_type = 'section_header'").select("document_id", "chapter", "page_number", F.col("id").alias("header_id"), heading_key(F.coalesce("text_content", F.lit(""))).alias("theirs"))
    near = members.select("document_id", "chapter", "order_index", heading_key(F.col("heading")).alias("ours"), F.explode(F.sequence(F.col("page_start") - 1, F.col("page_start") + 1)).alias("page_number"))
    alike = F.col("ours").contains(F.col("theirs")) | F.col("theirs").contains(F.col("ours"))
    return (
        near.join(heads, ["document_id", "chapter", "page_number"]).filter(alike)
        .groupBy("document_id", "chapter", "order_index").agg(F.min_by("header_id", F.struct("page_number", "header_id")).alias("header_id"))
    )


def assign(blocks: DataFrame, sections: DataFrame, preset: Column | None = None) -> DataFrame:
    """document_id, id, order_index: the section of every block that has one.

    Within each chapter a block belongs to the last section whose header is not after it, if its page lies in that
    section; otherwise to the most specific section that covers its page.  A block on a page of two chapters
    goes with the later one.  Headers and footers are left out.  ``preset`` names a header block outright.
    """
    blocks = blocks.select("document_id", "id", "page_number", "block_type", "text_content").dropDuplicates(["document_id", "id"])
    tops = chapters(sections)
    members = chapter_sections(sections, tops)
    inside = chapter_blocks(blocks, tops)
    found = header_matches(members, inside)
    keys = ["document_id", "chapter"]
    bounds = members.join(found, [*keys, "order_index"], "left")
    if preset is not None:
        bounds = bounds.withColumn("header_id", F.coalesce(F.nullif(preset, F.lit(0)), F.col("header_id")))
    bounds = bounds.filter("header_id IS NOT NULL").groupBy(*keys, "header_id").agg(F.max(F.struct("order_index", "page_start", "page_end")).alias("s"))
    body = inside.filter(~F.coalesce("block_type", F.lit("")).isin(*FURNITURE)).select(*keys, "chapter_pos", "id", "page_number")
    # backward as-of join: boundaries and blocks in one order, each block sees the last boundary before it
    marks = bounds.select(*keys, F.lit(None).cast("int").alias("chapter_pos"), F.col("header_id").alias("id"), F.lit(None).cast("int").alias("page_number"), "s")
    order = Window.partitionBy(*keys).orderBy("id", F.col("s").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    placed = marks.unionByName(body.withColumn("s", F.lit(None).cast(marks.schema["s"].dataType))).withColumn("near", F.last("s", ignorenulls=True).over(order)).filter("chapter_pos IS NOT NULL")
    # the most specific section of every page of a chapter
    covered = pages_within(members, blocks, *keys, "level", "page_start", "order_index")
    best = covered.groupBy(*keys, "page_number").agg(F.min_by("order_index", F.struct(-F.col("level"), -F.col("page_start"), "order_index")).alias("covering"))
    fits = F.col("page_number").between(F.col("near.page_start"), F.col("near.page_end"))
    chosen = placed.join(best, [*keys, "page_number"], "left").withColumn("order_index", F.coalesce(F.when(fits, F.col("near.order_index")), F.col("covering")))
    return (
        chosen.filter("order_index IS NOT NULL").groupBy("document_id", "id").agg(F.max_by("order_index", "chapter_pos").alias("order_index"))
    )
