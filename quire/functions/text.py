"""String functions whose results equal those of Python's str and re.

Java's \\s is ASCII only and its ^ and $ also break at other line ends, hence the explicit classes and (?md).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.whitespace import UNICODE_WS, WS_RANGES, char_class

#: What Python's \s and str.strip() mean: Unicode white space and the four separators.
PY_WS = UNICODE_WS + char_class(((0x1C, 0x1F),))
PY_WS_CHARS = "".join(chr(c) for a, b in (*WS_RANGES, (0x1C, 0x1F)) for c in range(a, b + 1))

#: Characters that are bullets at the start of a line, in the order in which they are replaced.
BULLETS = "•◦–—∙●○■□▪▸▹►▻"


def pystrip(c: Column) -> Column:
    """str.strip()."""
    return F.btrim(c, F.lit(PY_WS_CHARS))


def bullets(c: Column) -> Column:
    """Bullets at line starts become '- ', one character after the other; the indent stays."""
    replaced = reduce(lambda x, b: F.regexp_replace(x, f"(?md)^([{PY_WS}]*){b}[{PY_WS}]*", "$1- "), BULLETS, c)
    return F.when(c.rlike(f"[{BULLETS}]"), replaced).otherwise(c)


def squeeze_lines(c: Column) -> Column:
    """At most one blank line in a row, no blanks at line ends, LF only, stripped; in this order."""
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    c = F.regexp_replace(c, r"(?md)[ \t]+$", "")
    return pystrip(F.regexp_replace(c, r"\r\n?", "\n"))


def normalize_markdown(c: Column) -> Column:
    """Bullets, then lines; null becomes ''."""
    return F.coalesce(squeeze_lines(bullets(c)), F.lit(""))


def table_fence(c: Column) -> Column:
    return F.concat(F.lit("\n\n[TABLE]\n"), pystrip(c), F.lit("\n[/TABLE]\n\n"))


def figure_placeholder(caption: Column) -> Column:
    """With the caption if it is not blank."""
    plain = pystrip(caption)
    return F.when(plain != "", F.concat(F.lit("\n\n[FIGURE: "), plain, F.lit("]\n\n"))).otherwise(F.lit("\n\n[FIGURE]\n\n"))


def clean_block(block_type: Column, text: Column, markdown: Column) -> Column:
    """The content of one block as Markdown; null for running headers and footers and for blank content."""
    content = F.coalesce(F.when(markdown != "", markdown), text)
    blank = content.isNull() | (pystrip(content) == "")
    short = F.when(F.length(pystrip(content)) < 200, content)
    return (
        F.when(block_type.isin("page_header", "page_footer") | blank, F.lit(None).cast("string"))
        .when(block_type == "table", table_fence(content))
        .when(block_type.isin("figure", "picture"), figure_placeholder(short))
        .otherwise(normalize_markdown(content))
    )


def heading_key(c: Column) -> Column:
    """A heading for comparison: single spaces, stripped, lower case."""
    return pystrip(F.regexp_replace(F.lower(c), f"[{PY_WS}]+", " "))


def preview(c: Column, first: int = 150, shown: int = 120) -> Column:
    """The beginning of a text on one line."""
    return F.substring(F.translate(F.substring(c, 1, first), "\n", " "), 1, shown)


def human_size(n: Column) -> Column:
    """Bytes with one decimal, halves to even, in the largest of B, KB, MB, GB, TB that keeps them under 1024; null stays null."""
    shown = lambda power, unit: F.format_string(f"%.1f {unit}", F.bround(n / 1024.0**power, 1))
    out = shown(4, "TB")
    for unit, power in (("GB", 3), ("MB", 2), ("KB", 1), ("B", 0)):
        out = F.when(n < 1024.0 ** (power + 1), shown(power, unit)).otherwise(out)
    return F.when(n.isNotNull(), out)


def output_name(name: Column) -> Column:
    """Name of the store that belongs to a source file; only a literal .pdf at the end is dropped."""
    return F.concat(F.regexp_replace(name, r"\.pdf\z", ""), F.lit("_rag.db"))
