"""Layout elements (nested JSON) as typed blocks.

The JSON is parsed to a variant in the JVM, so fields that are a number here and a string there need no common
schema.  A text that is not complete JSON gives no elements; an element that could not be read by the rules
below is dropped and can be counted with ``rejected``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import pystrip

ARRAYS = ("texts", "tables", "pictures", "groups", "key_value_items", "form_items")


def parsed(text: Column) -> Column:
    """The variant of a JSON text; JSON that was encoded twice counts as its content."""
    v = F.try_parse_json(text)
    return F.when(F.schema_of_variant(v) == "STRING", F.try_parse_json(F.try_variant_get(v, "$", "string"))).otherwise(v)


def _list(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "array<variant>")


def _text(e: Column, key: str) -> Column:
    return F.try_variant_get(e, f"$.{key}", "string")


def _has(e: Column, path: str) -> Column:
    """Whether a key is present, be it null."""
    return F.try_variant_get(e, path, "variant").isNotNull()


def _null(e: Column, path: str) -> Column:
    return F.is_variant_null(F.try_variant_get(e, path, "variant"))


def dispatch(v: Column) -> Column:
    """All elements of a document, whichever of the known layouts it has."""
    none = F.array().cast("array<variant>")
    joined = F.concat(*[F.coalesce(_list(v, f"$.{a}"), none) for a in ARRAYS])
    pages = F.flatten(F.transform(F.coalesce(_list(v, "$.pages"), F.array().cast("array<variant>")), lambda p: F.coalesce(F.try_variant_get(p, "$.elements", "array<variant>"), F.array().cast("array<variant>"))))
    return (
        F.when(_has(v, "$.texts") | _has(v, "$.tables"), joined)
        .when(_has(v, "$.elements"), _list(v, "$.elements"))
        .when(_has(v, "$.body"), F.coalesce(_list(v, "$.body"), _list(v, "$.body.elements")))
        .when(_has(v, "$.pages"), pages)
        .otherwise(F.try_variant_get(v, "$", "array<variant>"))
    )


def elements(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, pos, e: the elements in reading order of the arrays."""
    # the generator keeps the optimizer from parsing the text once per use of the variant
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("doc_id"), F.explode(F.array(parsed(F.col(text)))).alias("v")).filter(F.col("v").isNotNull())
    return rows.select("doc_id", F.posexplode(dispatch(F.col("v"))).alias("pos", "e"))


def page_no(e: Column) -> Column:
    """Of the first provenance, else of the element; the first key that is present decides."""
    first = "$.prov[0]"
    return (
        F.when(_has(e, f"{first}.page_no"), F.try_variant_get(e, f"{first}.page_no", "int"))
        .when(_has(e, f"{first}.page"), F.try_variant_get(e, f"{first}.page", "int"))
        .otherwise(F.try_variant_get(e, "$.page_no", "int"))
    )


def page_range(e: Column) -> Column:
    """'min-max' if the provenances name more than one page."""
    prov = _list(e, "$.prov")
    page = lambda p: F.coalesce(F.nullif(F.try_variant_get(p, "$.page_no", "int"), F.lit(0)), F.nullif(F.try_variant_get(p, "$.page", "int"), F.lit(0)))
    pages = F.array_distinct(F.filter(F.transform(prov, page), lambda x: x.isNotNull()))
    return F.when((F.size(prov) > 1) & (F.size(pages) > 1), F.concat(F.array_min(pages).cast("string"), F.lit("-"), F.array_max(pages).cast("string")))


def block_type(e: Column) -> Column:
    return F.coalesce(F.nullif(_text(e, "type"), F.lit("")), F.nullif(_text(e, "label"), F.lit("")), F.lit("unknown"))


def heading_level(e: Column) -> Column:
    return F.when(block_type(e).isin("section_header", "heading", "title"), F.try_variant_get(e, "$.level", "int"))


def bbox(e: Column) -> Column:
    """JSON of the element's own box."""
    box = F.try_variant_get(e, "$.bbox", "variant")
    return F.when(box.isNotNull() & ~F.is_variant_null(box), F.to_json(box))


def is_table(e: Column) -> Column:
    return F.coalesce(F.lower(_text(e, "label")).contains("table"), F.lit(False)) | F.coalesce(F.lower(_text(e, "type")).contains("table"), F.lit(False))


def _stripped(e: Column, key: str) -> Column:
    return F.nullif(pystrip(_text(e, key)), F.lit(""))


def text_content(e: Column) -> Column:
    """Text, else original text, stripped; null for tables, whose content is their Markdown."""
    return F.when(~is_table(e), F.coalesce(_stripped(e, "text"), _stripped(e, "orig")))


def unreadable(e: Column) -> Column:
    """A text field that is looked at and holds null."""
    return ~is_table(e) & (_null(e, "$.text") | (_stripped(e, "text").isNull() & _null(e, "$.orig"))) | _null(e, "$.label") | _null(e, "$.type")


def markdown_content(e: Column) -> Column:
    return _stripped(e, "markdown")


def element_id(e: Column) -> Column:
    return F.coalesce(F.nullif(_text(e, "id"), F.lit("")), _text(e, "element_id"))


def metadata(e: Column) -> Column:
    """Type and label always, four optional fields if present."""
    base = F.create_map(F.lit("docling_type"), _text(e, "type"), F.lit("docling_label"), _text(e, "label"))
    more = [F.when(_has(e, f"$.{k}"), F.create_map(F.lit(k), _text(e, k))).otherwise(F.create_map().cast("map<string,string>")) for k in ("name", "marker", "enumeration", "style")]
    return F.map_concat(base, *more)


def blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per element with content: the columns of raw_blocks.  Page defaults to 0, continuation to false."""
    e = F.col("e")
    rows = elements(docs, key, text).select(
        "doc_id", "pos", unreadable(e).alias("bad"), block_type(e).alias("block_type"), text_content(e).alias("text_content"), markdown_content(e).alias("markdown_content"),
        F.coalesce(page_no(e), F.lit(0)).alias("page_number"), page_range(e).alias("page_range"), heading_level(e).alias("docling_level"), bbox(e).alias("bbox"),
        F.coalesce(F.try_variant_get(e, "$.is_continuation", "boolean"), F.lit(False)).alias("is_continuation"), element_id(e).alias("element_id"), F.to_json(metadata(e), {"ignoreNullFields": "false"}).alias("metadata"),
    )
    return rows.filter(~F.col("bad") & (F.col("text_content").isNotNull() | F.col("markdown_content").isNotNull())).drop("bad")


def rejected(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, elements, unreadable, empty: what blocks() leaves out."""
    e = F.col("e")
    empty = text_content(e).isNull() & markdown_content(e).isNull()
    return elements(docs, key, text).groupBy("doc_id").agg(
        F.count("*").alias("elements"), F.count_if(unreadable(e)).alias("unreadable"), F.count_if(~unreadable(e) & empty).alias("empty")
    )


def page_count(v: Column) -> Column:
    """Pages of a document: the length of the list or object of pages, else the number it names, else 0; the first key that is present decides."""
    pages = F.coalesce(F.size(_list(v, "$.pages")), F.size(F.try_variant_get(v, "$.pages", "map<string,variant>")))
    named = F.when(_has(v, "$.page_count"), F.try_variant_get(v, "$.page_count", "int")).otherwise(F.try_variant_get(v, "$.num_pages", "int"))
    return F.coalesce(F.when(_has(v, "$.pages"), pages).otherwise(named), F.lit(0))


def header_blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """document_id, id, block_type, text_content, docling_level, page_number, last_page: the section headers of layout texts as blocks.

    Headers are looked for in ``texts``, else in ``elements``, and nowhere else; ``id`` is the place among the headers, which
    blank ones count in; ``last_page`` is the page count of the document, 0 if it names none.
    """
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("document_id"), F.explode(F.array(parsed(F.col(text)))).alias("v")).filter(F.col("v").isNotNull())
    found = F.when(_has(F.col("v"), "$.texts"), _list(F.col("v"), "$.texts")).otherwise(_list(F.col("v"), "$.elements"))
    heads = F.filter(found, lambda e: block_type(e) == "section_header")
    e = F.col("e")
    flat = rows.select("document_id", page_count(F.col("v")).alias("last_page"), F.posexplode(heads).alias("id", "e"))
    return flat.select("document_id", "id", block_type(e).alias("block_type"), text_content(e).alias("text_content"), heading_level(e).alias("docling_level"), page_no(e).alias("page_number"), "last_page")
