"""Section trees from headings.

All passes are windows over the headings of one document, about a twentieth of its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.errors import SegmentationError
from quire.functions.predicates import is_front_matter, is_subsection, numbering_level
from quire.functions.text import pystrip
from quire.plans.materialize import materialize

MAX_INFERRED = 5
#: Pages that the last section is given when the document's length is unknown.
UNKNOWN_TAIL = 20


def headings(blocks: DataFrame) -> DataFrame:
    """document_id, order_index, block_id, heading, native_level, page_start of the section headers in id order.

    A blank heading is left out but keeps its order_index; a missing page is 0.  A block repeated in identical
    rows counts once.
    """
    heads = blocks.filter(F.col("block_type") == "section_header").select("document_id", "id", "text_content", "docling_level", "page_number").dropDuplicates(["document_id", "id"])
    order = Window.partitionBy("document_id").orderBy("id")
    heads = heads.withColumn("order_index", F.row_number().over(order) - 1)
    return heads.select(
        "document_id", "order_index", F.col("id").alias("block_id"), pystrip(F.col("text_content")).alias("heading"),
        F.col("docling_level").alias("native_level"), F.coalesce("page_number", F.lit(0)).alias("page_start"),
    ).filter(F.col("heading") != "")


def with_levels(heads: DataFrame) -> DataFrame:
    """Adds ``level``: numbering, front matter, subsection pattern, native level, else one below the last.

    A native level 1 inside a chapter is not believed.  Only numbering, front matter and a native level that is
    believed move the state.
    """
    heading, native = F.col("heading"), F.col("native_level")
    number, sub = numbering_level(heading), is_subsection(heading)
    fixed = F.coalesce(number, F.when(is_front_matter(heading), 1), F.when(~sub & (native >= 2), native))
    before = Window.partitionBy("document_id").orderBy("order_index").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("fixed", fixed)
    last = F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(1))
    heads = heads.withColumn("last", last)
    level = F.coalesce("fixed", F.when((native == 1) & (F.col("last") < 2) & ~sub, 1), F.least(F.col("last") + 1, F.lit(MAX_INFERRED)))
    return heads.withColumn("level", level).drop("fixed", "last")


def with_positions(sections: DataFrame) -> DataFrame:
    """Adds ``pos``, the place in the order of page and order_index in which later steps read the sections."""
    return sections.withColumn("pos", F.row_number().over(Window.partitionBy("document_id").orderBy("page_start", "order_index")))


def deepest(sections: DataFrame) -> int:
    return sections.agg(F.max("level")).first()[0] or 1


def with_page_ends(sections: DataFrame, levels: int, last_page: Column | None = None) -> DataFrame:
    """Adds ``page_end``: the page before the next section of the same or a higher rank, at least its own start.

    The last of a rank ends with ``last_page``, or 20 pages after the last start if that is null or 0.
    """
    # from the end, so that the frame only grows: what follows is found in one pass over a document
    after = Window.partitionBy("document_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    nexts = [F.last(F.when(F.col("level") <= k, F.col("page_start")), ignorenulls=True).over(after) for k in range(1, levels + 1)]
    sections = sections.withColumn("next_start", F.element_at(F.array(*nexts), F.col("level")))
    guess = F.max("page_start").over(Window.partitionBy("document_id")) + UNKNOWN_TAIL
    end = F.coalesce(F.when(last_page > 0, last_page), guess) if last_page is not None else guess
    page_end = F.when(F.col("next_start").isNotNull(), F.greatest(F.col("page_start"), F.col("next_start") - 1)).otherwise(end)
    return sections.withColumn("page_end", page_end).drop("next_start")


def with_paths(sections: DataFrame, levels: int) -> DataFrame:
    """Adds ``heading_path``: the headings of the levels above that are still open, then the own one."""
    before = Window.partitionBy("document_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    parts = []
    for k in range(1, levels):
        last = F.last(F.when(F.col("level") == k, F.struct("pos", "heading")), ignorenulls=True).over(before)
        cut = F.coalesce(F.max(F.when(F.col("level") < k, F.col("pos"))).over(before), F.lit(0))
        parts.append(F.when((F.col("level") > k) & (last["pos"] > cut), last["heading"]))
    return sections.withColumn("heading_path", F.concat_ws(" > ", *parts, F.col("heading")))


def build_sections(blocks: DataFrame, page_counts: DataFrame | None = None) -> DataFrame:
    """The section tree of every document that has headings: the columns of sections, and pos.

    ``page_counts`` (document_id, last_page, one row per document) are the known page counts; a document without one, or with
    0, ends 20 pages after its last heading.  Null document ids form one document of their own.
    """
    leveled = with_positions(with_levels(headings(blocks)))
    if page_counts is not None:
        leveled = leveled.join(page_counts.select("document_id", "last_page"), "document_id", "left")
    leveled = materialize(leveled)  # read twice: for the deepest level and for the tree
    levels = deepest(leveled)
    tree = with_paths(with_page_ends(leveled, levels, F.col("last_page") if page_counts is not None else None), levels)
    return tree.select("document_id", "order_index", "pos", "level", "heading", "heading_path", "page_start", "page_end", "native_level", "block_id")


def issues(sections: DataFrame, widest: int = 200) -> DataFrame:
    """Per document the number of sections without page, with start after end, too wide, and whether level 1 or 2 is missing."""
    wide = (F.col("level") > 1) & (F.col("page_end") - F.col("page_start") > widest)
    return sections.groupBy("document_id").agg(
        F.count_if(F.col("page_start") == 0).alias("without_page"), F.count_if(F.col("page_start") > F.col("page_end")).alias("reversed"), F.count_if(wide).alias("too_wide"),
        (F.count_if(F.col("level") == 1) == 0).alias("no_chapter"), (F.count_if(F.col("level") == 2) == 0).alias("no_section"),
    )


def without_chapter(sections: DataFrame) -> DataFrame:
    """document_id of the documents that have sections, but none of level 1."""
    return sections.groupBy("document_id").agg(F.count_if(F.col("level") == 1).alias("n")).filter("n = 0").select("document_id")


def require_chapters(sections: DataFrame) -> DataFrame:
    """The sections; raises SegmentationError if a document has none of level 1."""
    bad = without_chapter(sections).limit(3).collect()
    if bad:
        raise SegmentationError(f"no chapter in {', '.join(str(r[0]) for r in bad)}")
    return sections


def summary(sections: DataFrame) -> DataFrame:
    """Sections per level and the span of their known pages."""
    known = F.when(F.col("page_start") > 0, F.col("page_start"))
    return sections.groupBy("document_id", "level").agg(F.count("*").alias("n_sections"), F.min(known).alias("first_page"), F.max("page_end").alias("last_page"))
