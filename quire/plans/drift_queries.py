"""Queries over the layout texts: nested records and drifting schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import drift, nested
from quire.plans.materialize import materialize
from quire.plans.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

query("p4_found")(drift.layout_changes)
query("p4_table")(drift.layout_elements)


READ = """once AS (SELECT doc_id, docling_json AS j FROM documents WHERE json_valid(docling_json)),
    twice AS (SELECT doc_id, CASE WHEN json_type(j) = 'VARCHAR' THEN json_extract_string(j, '$') ELSE j END AS j FROM once),
    d AS (SELECT doc_id, j::JSON AS j FROM twice WHERE json_valid(j))"""

#: Paths and types of every value of every document, by its release.
PATHS = f"""{READ}, r AS (SELECT doc_id, parser_version AS release FROM documents WHERE parser_version IS NOT NULL), v AS (SELECT DISTINCT release FROM r JOIN d USING (doc_id)),
    numbers AS (SELECT release, row_number() OVER (ORDER BY list_transform(string_split(release, '.'), lambda x: x::INTEGER)) AS no FROM v),
    t AS (SELECT DISTINCT release, regexp_replace(substr(x.fullkey, 3), '\\[\\d+\\]', '[]', 'g') AS path,
          CASE x.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind
          FROM d JOIN r USING (doc_id), json_tree(d.j) x WHERE x.fullkey <> '$')"""

query(
    "p4_lifespans",
    f"""WITH {PATHS}, n AS (SELECT path, kind, no, release, no - row_number() OVER (PARTITION BY path, kind ORDER BY no) AS island FROM t JOIN numbers USING (release) WHERE kind <> 'null')
    SELECT path, kind, arg_min(release, no) AS first, arg_max(release, no) AS last FROM n GROUP BY path, kind, island""",
)(drift.layout_lifespans)


#: The same columns by the names that a reader of all releases would look for.
_E = {
    "id": "coalesce(e->>'$.id', e->>'$.element_id')", "label": "e->>'$.label'", "text": "e->>'$.text'", "orig": "e->>'$.orig'", "level": "e->>'$.level'", "marker": "e->>'$.marker'", "style": "e->>'$.style'",
    "is_continuation": "(e->>'$.is_continuation')::BOOLEAN", "confidence": "(e->>'$.confidence')::DOUBLE", "name": "e->>'$.name'",
    "caption_text": "coalesce(e->>'$.caption.text', CASE WHEN json_type(e, '$.caption') = 'VARCHAR' THEN e->>'$.caption' END)", "caption_lang": "e->>'$.caption.lang'", "md": "coalesce(e->>'$.md', e->>'$.markdown')",
    "data_num_rows": "(e->>'$.data.num_rows')::BIGINT", "data_num_cols": "(e->>'$.data.num_cols')::BIGINT",
    "page_no": "coalesce(e->>'$.prov[0].page_no', e->>'$.prov[0].page')::BIGINT",
    **{f"bbox_{c}": f"CASE json_type(e, '$.prov[0].bbox') WHEN 'ARRAY' THEN e->>'$.prov[0].bbox[{i}]' ELSE e->>'$.prov[0].bbox.{c}' END::DOUBLE" for i, c in enumerate("ltrb")},
    "n_prov": "coalesce(json_array_length(e, '$.prov'), 0)::INTEGER", "last_page": "coalesce(e->>'$.prov[#-1].page_no', e->>'$.prov[#-1].page')::BIGINT",
    "n_cells": "coalesce(json_array_length(e, '$.data.table_cells'), 0)::INTEGER", "cell_rows": "(SELECT sum(coalesce(c->>'$.start_row', c->>'$.row')::BIGINT) FROM (SELECT unnest(json_extract(e, '$.data.table_cells[*]')) AS c))::BIGINT",
    "cell_chars": "(SELECT sum(length(c->>'$.text')) FROM (SELECT unnest(json_extract(e, '$.data.table_cells[*]')) AS c))::BIGINT", "n_children": "coalesce(json_array_length(e, '$.children'), 0)::INTEGER",
    "first_child": "coalesce(e->>'$.children[0].cref', e->>'$.children[0].ref')", "n_pairs": "coalesce(json_array_length(e, '$.cells'), 0)::INTEGER", "pair_text": "e->>'$.cells[0].text'", "n_links": "coalesce(json_array_length(e, '$.links'), 0)::INTEGER",
}
_ARRAYS = ("elements", "texts", "tables", "pictures", "groups", "key_value_items", "form_items")


@query(
    "p4_elements",
    f"""WITH {READ}, a AS ("""
    + " UNION ALL ".join(f"SELECT doc_id, '{'texts' if a == 'elements' else a}' AS \"array\", generate_subscripts(json_extract(j, '$.{a}[*]'), 1) - 1 AS ordinal, unnest(json_extract(j, '$.{a}[*]')) AS e FROM d" for a in _ARRAYS)
    + f""") SELECT doc_id, parser_version AS release, "array", ordinal::INTEGER AS ordinal, {", ".join(f"{sql} AS {name}" for name, sql in _E.items())}, 0 AS n_others FROM a JOIN documents USING (doc_id)""",
)
def p4_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one table of elements: all its plain columns, and of its lists their lengths and some of their entries."""
    rows = drift.layout_elements(spark, sf_dir)
    types = {f.name: f.dataType for f in rows.schema}

    def column(name: str, kind: str):
        return F.col(name).cast(kind) if name in types else F.lit(None).cast(kind)

    def entries(name: str, field: str, kind: str):
        there = name in types and field in types[name].elementType.names
        return F.transform(name, lambda x: x[field].cast(kind)) if there else F.array().cast(f"array<{kind}>")

    def length(name: str):
        return F.coalesce(F.size(F.col(name)), F.lit(0)) if name in types else F.lit(0)

    def total(values):
        return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + x))

    kinds = dict.fromkeys(("id", "label", "text", "orig", "level", "marker", "style", "name", "caption_text", "caption_lang", "md"), "string") | {"is_continuation": "boolean", "confidence": "double", "data_num_rows": "long", "data_num_cols": "long"}
    lists = {"page_no": F.get(entries("prov", "page_no", "long"), F.lit(0)), "last_page": F.get(F.reverse(entries("prov", "page_no", "long")), F.lit(0)), **{f"bbox_{c}": F.get(entries("prov", f"bbox_{c}", "double"), F.lit(0)) for c in "ltrb"}}
    lists |= {"n_prov": length("prov"), "n_cells": length("data_table_cells"), "n_children": length("children"), "n_pairs": length("cells"), "n_links": length("links")}
    lists |= {"cell_rows": total(entries("data_table_cells", "start_row", "long")), "cell_chars": total(F.transform(entries("data_table_cells", "text", "string"), F.length))}
    lists |= {"first_child": F.get(entries("children", "cref", "string"), F.lit(0)), "pair_text": F.get(entries("cells", "text", "string"), F.lit(0)), "n_others": F.size("others") + F.size("rest")}
    return rows.select("doc_id", "release", "array", "ordinal", *[column(n, k).alias(n) for n, k in kinds.items()], *[c.alias(n) for n, c in lists.items()])



@query(
    "p6_found",
    f"""WITH {READ}, t AS (SELECT doc_id, replace(regexp_replace(substr(x.fullkey, 2), '\\[(\\d+)\\]', '/\\1', 'g'), '.', '/') AS child_path FROM d, json_tree(d.j) x WHERE x.type = 'OBJECT' AND regexp_matches(x.fullkey, '\\]$'))
    SELECT doc_id, regexp_extract(child_path, '^(.*/\\d+)/.+$', 1) AS parent_path, child_path FROM t""",
)
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nested object with its parent."""
    rows = nested.flatten(nested.layout_documents(spark, sf_dir), "doc_id", "docling_json")
    return rows.filter("child_path <> ''").select("doc_id", "parent_path", "child_path")


#: Fields by the paths of a tree of values: scalars, arrays that hold nothing but scalars, and empty objects.
FIELDS = f"""WITH {READ}, t AS (SELECT regexp_replace(substr(x.fullkey, 3), '\\[\\d+\\]', '[]', 'g') AS p, x.type, x.value FROM d, json_tree(d.j) x),
    f AS (SELECT p, CASE WHEN type = 'VARCHAR' THEN 's' WHEN type IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 'i' WHEN type = 'DOUBLE' THEN 'n' WHEN type = 'BOOLEAN' THEN 'b' WHEN type = 'NULL' THEN '0' WHEN type = 'ARRAY' THEN 'a' ELSE 'o' END AS kind
          FROM t WHERE NOT ends_with(p, ']') AND p <> '' AND CASE type WHEN 'OBJECT' THEN value::VARCHAR = '{{}}' WHEN 'ARRAY' THEN NOT list_bool_or(coalesce(list_transform(json_extract(value, '$[*]'), lambda e: json_type(e) IN ('OBJECT', 'ARRAY')), []) || [false]) ELSE true END)
    SELECT regexp_extract(p, '^(.*\\[\\])\\.[^\\[\\]]+$', 1) AS table_path, regexp_extract(p, '^(?:.*\\[\\]\\.)?([^\\[\\]]+)$', 1) AS field, kind, count(*) AS n_values FROM f GROUP BY ALL"""


@query("p6_fields", FIELDS)
def p6_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of the flat tables: their fields and the types of these."""
    return nested.table_fields(nested.flatten(nested.layout_documents(spark, sf_dir), "doc_id", "docling_json"))


@query(
    "p6_tables",
    f"""WITH {READ}, t AS (SELECT doc_id, x.fullkey, regexp_replace(substr(x.fullkey, 3), '\\[\\d+\\]', '[]', 'g') AS p FROM d, json_tree(d.j) x WHERE x.type = 'OBJECT' AND (regexp_matches(x.fullkey, '\\]$') OR x.fullkey = '$'))
    SELECT p AS table_path, count(*) AS n_rows, count(DISTINCT doc_id) AS n_records FROM t GROUP BY p""",
)
def p6_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and records of each flat table, counted over the tables themselves."""
    nodes = materialize(nested.flatten(nested.layout_documents(spark, sf_dir), "doc_id", "docling_json"))
    parts = [t.agg(F.count("*").alias("n_rows"), F.countDistinct("doc_id").alias("n_records")).select(F.lit(path).alias("table_path"), "n_rows", "n_records") for path, t in nested.flat_tables(nodes).items()]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], "table_path string, n_rows long, n_records long"))


@query(
    "p6_provenance",
    f"""WITH {READ}, e AS (SELECT doc_id, i, json_extract(j, '$.texts[' || i || ']') AS e FROM (SELECT doc_id, j, unnest(range(json_array_length(j, '$.texts')::BIGINT)) AS i FROM d)),
    p AS (SELECT doc_id, i, k, json_extract(e, '$.prov[' || k || ']') AS p FROM (SELECT *, unnest(range(json_array_length(e, '$.prov')::BIGINT)) AS k FROM e))
    SELECT doc_id, '/texts/' || i || '/prov/' || k AS child_path, '/texts/' || i AS parent_path, k::INTEGER AS ordinal, coalesce(p->>'$.page_no', p->>'$.page')::BIGINT AS page, try_cast(p->>'$.bbox.l' AS DOUBLE) AS bbox_l FROM p WHERE json_type(p) = 'OBJECT'""",
)
def p6_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the flat tables whose columns come from the catalogue, two levels below the record."""
    nodes = materialize(nested.flatten(nested.layout_documents(spark, sf_dir), "doc_id", "docling_json"))
    path = "texts[].prov[]"
    rows = nested.flat_tables(nodes).get(path, nested.flat_table(nodes, path, {}))
    page, left = (F.coalesce(*[F.col(c) for c in names if c in rows.columns], F.lit(None).cast(kind)) for names, kind in ((("page_no", "page"), "long"), (("bbox_l",), "double")))
    return rows.select("doc_id", "child_path", "parent_path", "ordinal", page.alias("page"), left.alias("bbox_l"))


@query(
    "p6_texts",
    f"""
    WITH {READ},
    t AS (SELECT doc_id, unnest(json_extract(j, '$.texts[*]')) AS e, generate_subscripts(json_extract(j, '$.texts[*]'), 1) - 1 AS i FROM d)
    SELECT doc_id, '/texts/' || i AS child_path, '' AS parent_path, i::INTEGER AS ordinal, e->>'$.label' AS label, e->>'$.text' AS text,
           try_cast(e->>'$.level' AS INTEGER) AS level, e->>'$.marker' AS marker, try_cast(e->>'$.confidence' AS DOUBLE) AS confidence
    FROM t
    """,
)
def p6_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the flat tables."""
    rows = nested.flatten(nested.layout_documents(spark, sf_dir), "doc_id", "docling_json")
    return nested.table(rows, "texts[]", {"label": "string", "text": "string", "level": "int", "marker": "string", "confidence": "double"})
