"""Markdown tables as sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.config import TableSettings
from quire.functions.text import pystrip


def cells(line: Column) -> Column:
    """The stripped cells of one row."""
    inner = F.regexp_replace(pystrip(line), r"\A\||\|\z", "")
    return F.transform(F.split(inner, r"\|"), pystrip)


def table_rows(markdown: Column) -> Column:
    """Rows of cells of a Markdown table, without the rule under the header."""
    lines = F.filter(F.split(markdown, r"\r\n|\r|\n"), lambda x: pystrip(x).startswith("|"))
    return F.transform(F.filter(lines, lambda x: ~x.rlike(r"^[\s|:-]+$")), cells)


def linearize(blocks: DataFrame, key: str, markdown: str, settings: TableSettings = TableSettings()) -> DataFrame:
    """id, row_no, n_rows, n_cols, is_large, text: 'header: value; ...' for each row below the first.

    Empty cells are left out.  A table of one row gives none.
    """
    rows = blocks.select(F.col(key).alias("id"), table_rows(F.col(markdown)).alias("rows")).filter(F.size("rows") > 1)
    head, body = F.element_at("rows", 1), F.slice("rows", 2, F.size("rows"))
    flat = rows.select("id", head.alias("head"), (F.size("rows") - 1).alias("n_rows"), F.size(head).alias("n_cols"), F.posexplode(body).alias("row_no", "row"))
    pairs = F.zip_with("head", "row", lambda h, v: F.when((v != "") & v.isNotNull(), F.concat(F.coalesce(h, F.lit("")), F.lit(": "), v)))
    large = (F.col("n_rows") > settings.large_rows) | (F.col("n_cols") > settings.large_cols)
    return flat.select("id", "row_no", "n_rows", "n_cols", large.alias("is_large"), F.array_join(pairs, "; ").alias("text"))
