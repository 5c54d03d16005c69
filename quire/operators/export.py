"""Markdown reports as rows of text, and their sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_note(start: Column, end: Column) -> Column:
    """'(page N)' or '(pages A-B)'."""
    return F.when(start == end, F.concat(F.lit("(page "), start.cast("string"), F.lit(")"))).otherwise(F.concat(F.lit("(pages "), start.cast("string"), F.lit("-"), end.cast("string"), F.lit(")")))


def tree_lines(sections: DataFrame) -> DataFrame:
    """document_id, order_index, line: the section tree, two spaces per level."""
    indent = F.repeat(F.lit("  "), F.col("level") - 1)
    note = F.coalesce(F.concat(F.lit(" "), page_note(F.col("page_start"), F.col("page_end"))), F.lit(""))
    return sections.select("document_id", "order_index", "id", F.concat(indent, F.lit("- "), F.col("heading"), note).alias("line"))


def tree_document(sections: DataFrame) -> DataFrame:
    """document_id, text: the whole section tree of a document as Markdown: title, number of sections and of those per level 1-5, then the tree."""
    lines = tree_lines(sections).groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order_index", "id", "line"))), lambda x: x["line"]), "\n").alias("tree"))
    levels = [F.concat(F.lit(f"- Level {k}: "), F.count_if(F.col("level") == k).cast("string")) for k in range(1, 6)]
    head = F.concat_ws("\n", F.concat(F.lit("Total sections: "), F.count("*").cast("string")), *levels).alias("head")
    counts = sections.groupBy("document_id").agg(head)
    title = F.concat(F.lit("# Section hierarchy of "), F.col("document_id"), F.lit("\n\n"))
    return counts.join(lines, "document_id").select("document_id", F.concat(title, "head", F.lit("\n\n"), "tree", F.lit("\n")).alias("text"))


def section_samples(sections: DataFrame, blocks: DataFrame, reach: int = 10) -> DataFrame:
    """document_id, id, text: every section as Markdown with its parent, siblings, children and blocks.

    Siblings are those within ``reach`` places.  Blocks are listed with page, id and type, and the first 80 characters of their text.
    """
    from quire.operators import relations

    named = sections.select("id", "heading")

    def listed(pairs: DataFrame, other: str, title: str) -> DataFrame:
        rows = pairs.select("id", F.col(other).alias("other")).join(named.select(F.col("id").alias("other"), F.col("heading").alias("name")), "other")
        items = F.transform(F.array_sort(F.collect_list(F.struct("other", "name"))), lambda x: F.concat(F.lit("- "), x["name"], F.lit(" ("), x["other"].cast("string"), F.lit(")")))
        return rows.groupBy("id").agg(F.concat(F.lit(f"\n\n## {title}\n\n"), F.array_join(items, "\n")).alias(other))

    parts = [
        listed(relations.parents(sections), "parent_id", "Parent"),
        listed(relations.siblings(sections, reach), "sibling_id", "Siblings"),
        listed(relations.descendants(sections).filter("depth = 1"), "descendant_id", "Children"),
    ]
    own = blocks.filter("section_id IS NOT NULL").select(F.col("section_id").alias("id"), F.col("id").alias("block"), "page_number", "block_type", F.coalesce("text_content", "markdown_content", F.lit("")).alias("body"))
    line = lambda x: F.concat(F.lit("- p. "), _page(x["page_number"]), F.lit(", "), x["block"].cast("string"), F.lit(" ["), F.coalesce(x["block_type"], F.lit("?")), F.lit("] "), x["start"])
    start = F.translate(F.left("body", F.lit(80)), "\n", " ")
    parts.append(own.groupBy("id").agg(F.concat(F.lit("\n\n## Blocks\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "block", "block_type", start.alias("start")))), line), "\n")).alias("blocks")))
    rows = sections
    for part in parts:
        rows = rows.join(part, "id", "left")
    note = F.concat_ws("", F.lit("# "), F.col("heading"), F.lit("\n\nLevel "), F.col("level").cast("string"), F.lit(", pages "), _page(F.col("page_start")), F.lit("-"), _page(F.col("page_end")), F.lit("\n\nPath: "), F.col("heading_path"))
    return rows.select("document_id", "id", F.concat_ws("", note, "parent_id", "sibling_id", "descendant_id", "blocks", F.lit("\n")).alias("text"))


def _page(c: Column) -> Column:
    return F.when(c.isNull() | (c == 0), F.lit("?")).otherwise(c.cast("string"))


def chunk_markdown(chunks: DataFrame, sections: DataFrame) -> DataFrame:
    """section_order, id, text: every chunk with its heading; unknown pages are '?'."""
    heads = sections.select(F.col("id").alias("section_id"), "heading_path", F.col("order_index").alias("section_order"))
    c = chunks.join(heads, "section_id")
    title = F.concat(F.lit("## Chunk "), F.col("id").cast("string"), F.lit("\n\n**"), F.col("heading_path"), F.lit("** (pages "), _page(F.col("page_start")), F.lit("-"), _page(F.col("page_end")), F.lit(", "))
    size = F.concat(F.coalesce(F.col("token_count").cast("string"), F.lit("?")), F.lit(" tokens)\n\n"))
    return c.select("section_order", "id", F.concat(title, size, F.coalesce("content", F.lit(""))).alias("text"))


def write_text(lines: DataFrame, column: str, order: list[str], path: str) -> None:
    """One text file of a report in order; for reports that a person reads, hence one partition."""
    lines.orderBy(*order).select(column).coalesce(1).write.mode("overwrite").text(path)


def write_partitioned(df: DataFrame, by: str, path: str) -> None:
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, n_rows, checksum: a sum of row hashes, whatever the order of the rows."""
    parts = [
        df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum")).select(F.lit(name).alias("table_name"), "n_rows", "checksum")
        for name, df in sorted(tables.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_parser_outputs(docs: DataFrame, name: str, markdown: str, document: str, path: str) -> None:
    """The Markdown and the JSON of every document, one text row each, in folders by document name."""
    docs.select(F.col(name).alias("name"), F.col(markdown).alias("value")).filter("value IS NOT NULL").write.mode("overwrite").partitionBy("name").text(f"{path}/markdown")
    docs.select(F.col(name).alias("name"), F.col(document).alias("value")).filter("value IS NOT NULL").write.mode("overwrite").partitionBy("name").text(f"{path}/json")
