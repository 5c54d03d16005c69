"""Queries over documents: registration, checksums and the mapping of layout elements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import human_size, output_name, preview
from quire.operators import mapping, registration, store
from quire.plans.materialize import spread
from quire.plans.registry import Registry, sql_strip
from quire.sources.tables import read_table

REGISTRY = Registry()
query = REGISTRY.query


def docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*columns)


def layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(docs(spark, sf_dir, "doc_id", "docling_json"))


@query("s04_sha256", "SELECT doc_id, sha256(text) AS text_sha256, strlen(text) AS n_bytes FROM documents")
def s04_sha256(spark, sf_dir):
    return docs(spark, sf_dir, "doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"), F.octet_length("text").cast("bigint").alias("n_bytes"))


#: Documents before this id count as registered in the queries on registration.
EARLIER = "(SELECT max(doc_id) FROM documents) / 2"


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = docs(spark, sf_dir, "doc_id", "id", "checksum_sha256", "source_url", "title")
    middle = docs(spark, sf_dir, "doc_id").agg(F.max("doc_id") / 2).scalar()
    return rows.filter(F.col("doc_id") > middle), rows.filter(F.col("doc_id") <= middle)


@query("s05_known", f"SELECT doc_id FROM documents WHERE doc_id > {EARLIER} AND checksum_sha256 IN (SELECT checksum_sha256 FROM documents WHERE doc_id <= {EARLIER})")
def s05_known(spark, sf_dir):
    return registration.known(*_halves(spark, sf_dir)).select("doc_id")


@query("s05_unknown", f"SELECT doc_id FROM documents d WHERE doc_id > {EARLIER} AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id <= {EARLIER} AND e.checksum_sha256 = d.checksum_sha256)")
def s05_unknown(spark, sf_dir):
    return registration.unknown(*_halves(spark, sf_dir)).select("doc_id")


@query(
    "s06_register",
    f"""
    SELECT checksum_sha256, min(doc_id) AS doc_id, arg_min(id, doc_id) AS id, arg_min(regexp_replace(regexp_extract(title, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1'), doc_id) AS title
    FROM documents d WHERE checksum_sha256 IS NOT NULL AND doc_id > {EARLIER}
      AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id <= {EARLIER} AND e.checksum_sha256 = d.checksum_sha256)
    GROUP BY checksum_sha256
    """,
)
def s06_register(spark, sf_dir):
    incoming, existing = _halves(spark, sf_dir)
    return registration.register(incoming, existing, "doc_id").select("checksum_sha256", "doc_id", "id", registration.stem(F.col("title")).alias("title"))


@query("s09_json", "SELECT doc_id, length(docling_json) AS n_chars_json, json_valid(docling_json) AS complete FROM documents WHERE docling_json IS NOT NULL")
def s09_json(spark, sf_dir):
    rows = docs(spark, sf_dir, "doc_id", "docling_json").filter("docling_json IS NOT NULL")
    return rows.select("doc_id", F.length("docling_json").cast("bigint").alias("n_chars_json"), F.try_parse_json("docling_json").isNotNull().alias("complete"))


@query("s10_info", "SELECT doc_id, id, title, docling_json IS NOT NULL AS has_json FROM documents")
def s10_info(spark, sf_dir):
    return docs(spark, sf_dir, "doc_id", "id", "title", F.col("docling_json").isNotNull().alias("has_json"))


@query("s11_latest", "SELECT title, arg_max(id, (epoch_us(created_at), doc_id)) AS id FROM documents WHERE created_at IS NOT NULL GROUP BY title")
def s11_latest(spark, sf_dir):
    """The latest registration of every title."""
    rows = docs(spark, sf_dir, "title", "id", "created_at", "doc_id").filter("created_at IS NOT NULL")
    return rows.groupBy("title").agg(F.max_by("id", F.struct("created_at", "doc_id")).alias("id"))


@query("s12_sole", "SELECT checksum_sha256, min(id) AS id FROM documents GROUP BY checksum_sha256 HAVING count(*) = 1")
def s12_sole(spark, sf_dir):
    """The document of every checksum that has exactly one."""
    return docs(spark, sf_dir, "checksum_sha256", "id").groupBy("checksum_sha256").agg(F.min("id").alias("id"), F.count("*").alias("n")).filter("n = 1").drop("n")


@query("s29_name", "SELECT doc_id, regexp_replace(title || '.pdf', '\\.pdf$', '') || '_rag.db' AS store, regexp_replace(title || '.PDF', '\\.pdf$', '') || '_rag.db' AS other FROM documents")
def s29_name(spark, sf_dir):
    return docs(spark, sf_dir, "doc_id", output_name(F.concat("title", F.lit(".pdf"))).alias("store"), output_name(F.concat("title", F.lit(".PDF"))).alias("other"))


@query("t09_preview", "SELECT doc_id, left(replace(left(text, 150), chr(10), ' '), 120) AS preview FROM documents")
def t09_preview(spark, sf_dir):
    return docs(spark, sf_dir, "doc_id", preview(F.col("text")).alias("preview"))


@query(
    "t10_size",
    "SELECT doc_id, CASE WHEN n < 1024 THEN printf('%.1f B', n) WHEN n < 1048576 THEN printf('%.1f KB', n / 1024) WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576) ELSE printf('%.1f GB', n / 1073741824) END AS size"
    " FROM (SELECT doc_id, (strlen(text) * 1000)::DOUBLE AS n FROM documents)",
)
def t10_size(spark, sf_dir):
    return docs(spark, sf_dir, "doc_id", human_size((F.octet_length("text") * 1000).cast("double")).alias("size"))


# --- layout elements --------------------------------------------------------------------------------------------

ELEMENTS = """
WITH once AS (SELECT doc_id, docling_json AS j FROM documents WHERE json_valid(docling_json)),
twice AS (SELECT doc_id, CASE WHEN json_type(j) = 'VARCHAR' THEN json_extract_string(j, '$') ELSE j END AS j FROM once),
d AS (SELECT doc_id, j::JSON AS j FROM twice WHERE json_valid(j)),
lists AS (SELECT doc_id, CASE
    WHEN json_exists(j, '$.texts') OR json_exists(j, '$.tables') THEN
        coalesce(json_extract(j, '$.texts[*]'), []) || coalesce(json_extract(j, '$.tables[*]'), []) || coalesce(json_extract(j, '$.pictures[*]'), [])
        || coalesce(json_extract(j, '$.groups[*]'), []) || coalesce(json_extract(j, '$.key_value_items[*]'), []) || coalesce(json_extract(j, '$.form_items[*]'), [])
    WHEN json_exists(j, '$.elements') THEN json_extract(j, '$.elements[*]')
    WHEN json_exists(j, '$.body') THEN CASE WHEN json_type(j, '$.body') = 'ARRAY' THEN json_extract(j, '$.body[*]') ELSE json_extract(j, '$.body.elements[*]') END
    WHEN json_exists(j, '$.pages') THEN json_extract(j, '$.pages[*].elements[*]')
    WHEN json_type(j) = 'ARRAY' THEN json_extract(j, '$[*]') END AS es FROM d),
elements AS (SELECT doc_id, (generate_subscripts(es, 1) - 1)::INTEGER AS pos, unnest(es) AS e FROM lists)
"""
TYPE = "coalesce(nullif(e->>'$.type', ''), nullif(e->>'$.label', ''), 'unknown')"
PAGE = "CASE WHEN json_exists(e, '$.prov[0].page_no') THEN try_cast(e->>'$.prov[0].page_no' AS INTEGER) WHEN json_exists(e, '$.prov[0].page') THEN try_cast(e->>'$.prov[0].page' AS INTEGER) ELSE try_cast(e->>'$.page_no' AS INTEGER) END"
TABLE = "(coalesce(lower(e->>'$.label') LIKE '%table%', false) OR coalesce(lower(e->>'$.type') LIKE '%table%', false))"
STRIPPED = {k: f"nullif({sql_strip(f'''(e->>'$.{k}')''')}, '')" for k in ("text", "orig", "markdown")}
TEXT = f"CASE WHEN NOT {TABLE} THEN coalesce({STRIPPED['text']}, {STRIPPED['orig']}) END"
PAGES = "list_distinct(list_filter(list_transform(coalesce(json_extract(e, '$.prov[*]'), []), lambda p: coalesce(nullif(try_cast(p->>'$.page_no' AS INTEGER), 0), nullif(try_cast(p->>'$.page' AS INTEGER), 0))), lambda x: x IS NOT NULL))"
RANGE = f"CASE WHEN len({PAGES}) > 1 THEN list_min({PAGES}) || '-' || list_max({PAGES}) END"
LEVEL = f"CASE WHEN {TYPE} IN ('section_header', 'heading', 'title') THEN try_cast(e->>'$.level' AS INTEGER) END"
ID = "coalesce(nullif(e->>'$.id', ''), e->>'$.element_id')"
BAD = f"(NOT {TABLE} AND (coalesce(json_type(e, '$.text') = 'NULL', false) OR ({STRIPPED['text']} IS NULL AND coalesce(json_type(e, '$.orig') = 'NULL', false)))) OR coalesce(json_type(e, '$.label') = 'NULL', false) OR coalesce(json_type(e, '$.type') = 'NULL', false)"


def _element(name: str, sql: str, column):
    @query(name, f"{ELEMENTS} SELECT doc_id, pos, {sql} AS value FROM elements")
    def run(spark, sf_dir):
        return mapping.elements(layouts(spark, sf_dir), "doc_id", "docling_json").select("doc_id", "pos", column(F.col("e")).alias("value"))

    return run


_element("m01_page_no", PAGE, mapping.page_no)
_element("m02_page_range", RANGE, mapping.page_range)
_element("m03_level", LEVEL, mapping.heading_level)
_element("m05_text", TEXT, mapping.text_content)
_element("m06_markdown", STRIPPED["markdown"], mapping.markdown_content)
_element("m07_element_id", ID, mapping.element_id)
_element("m08_type", TYPE, mapping.block_type)


_SIDES = ", ".join(f"coalesce(b->>'$.{c}', b->>'$[{i}]')::DOUBLE AS {c}" for i, c in enumerate("ltrb"))


@query(
    "m04_bbox",
    f"""{ELEMENTS}, p AS (SELECT doc_id, pos, (generate_subscripts(json_extract(e, '$.prov[*]'), 1) - 1)::INTEGER AS k, unnest(json_extract(e, '$.prov[*]')) AS p FROM elements),
    boxes AS (SELECT doc_id, pos, -1 AS k, json_extract(e, '$.bbox') AS b FROM elements UNION ALL SELECT doc_id, pos, k, json_extract(p, '$.bbox') FROM p)
    SELECT doc_id, pos, k, {_SIDES} FROM boxes WHERE json_type(b) <> 'NULL'""",
)
def m04_bbox(spark, sf_dir):
    """The boxes of elements (k -1), which few layouts have, and of their provenances, by the same rule."""
    rows = mapping.elements(layouts(spark, sf_dir), "doc_id", "docling_json")
    own = rows.select("doc_id", "pos", F.lit(-1).alias("k"), mapping.bbox(F.col("e")).alias("box"))
    inner = rows.select("doc_id", "pos", F.posexplode(F.try_variant_get("e", "$.prov", "array<variant>")).alias("k", "p")).select("doc_id", "pos", "k", mapping.bbox(F.col("p")).alias("box"))
    side = lambda c, i: F.coalesce(F.get_json_object("box", f"$.{c}"), F.get_json_object("box", f"$[{i}]")).cast("double").alias(c)
    return own.unionByName(inner).filter("box IS NOT NULL").select("doc_id", "pos", "k", *[side(c, i) for i, c in enumerate("ltrb")])


@query(
    "m09_metadata",
    f"{ELEMENTS} SELECT doc_id, pos, e->>'$.label' AS docling_label, e->>'$.marker' AS marker, e->>'$.style' AS style, json_exists(e, '$.style') AS has_style FROM elements",
)
def m09_metadata(spark, sf_dir):
    rows = mapping.elements(layouts(spark, sf_dir), "doc_id", "docling_json").select("doc_id", "pos", mapping.metadata(F.col("e")).alias("m"))
    item = lambda k: F.try_element_at("m", F.lit(k)).alias(k)
    return rows.select("doc_id", "pos", item("docling_label"), item("marker"), item("style"), F.map_contains_key("m", "style").alias("has_style"))


@query(
    "m10_blocks",
    f"""{ELEMENTS}, b AS (SELECT doc_id, pos, {TYPE} AS block_type, {TEXT} AS text_content, {STRIPPED["markdown"]} AS markdown_content, coalesce({PAGE}, 0) AS page_number, {RANGE} AS page_range,
        {LEVEL} AS docling_level, coalesce(try_cast(e->>'$.is_continuation' AS BOOLEAN), false) AS is_continuation, {ID} AS element_id, {BAD} AS bad FROM elements)
    SELECT * EXCLUDE (bad) FROM b WHERE NOT bad AND (text_content IS NOT NULL OR markdown_content IS NOT NULL)""",
)
def m10_blocks(spark, sf_dir):
    return mapping.blocks(layouts(spark, sf_dir), "doc_id", "docling_json").drop("bbox", "metadata")


@query("m11_dispatch", f"{ELEMENTS} SELECT doc_id, count(*) AS n_elements, max(pos) AS last_pos FROM elements GROUP BY doc_id")
def m11_dispatch(spark, sf_dir):
    return mapping.elements(layouts(spark, sf_dir), "doc_id", "docling_json").groupBy("doc_id").agg(F.count("*").alias("n_elements"), F.max("pos").alias("last_pos"))


@query(
    "m12_rejected",
    f"{ELEMENTS} SELECT doc_id, count(*) AS elements, count(*) FILTER (WHERE {BAD}) AS unreadable, count(*) FILTER (WHERE NOT ({BAD}) AND ({TEXT}) IS NULL AND {STRIPPED['markdown']} IS NULL) AS empty FROM elements GROUP BY doc_id",
)
def m12_rejected(spark, sf_dir):
    return mapping.rejected(layouts(spark, sf_dir), "doc_id", "docling_json")


#: The first key that is present decides.
PAGE_COUNT = """coalesce(CASE WHEN json_exists(j, '$.pages') THEN CASE json_type(j, '$.pages') WHEN 'ARRAY' THEN json_array_length(j, '$.pages') WHEN 'OBJECT' THEN len(json_keys(j, '$.pages')) END
    WHEN json_exists(j, '$.page_count') THEN try_cast(j->>'$.page_count' AS BIGINT) ELSE try_cast(j->>'$.num_pages' AS BIGINT) END, 0)::INTEGER"""


@query(
    "h08_page_count",
    f"{ELEMENTS} SELECT doc_id, {PAGE_COUNT} AS n_pages FROM d",
)
def h08_page_count(spark, sf_dir):
    rows = docs(spark, sf_dir, "doc_id", mapping.parsed(F.col("docling_json")).alias("v")).filter("v IS NOT NULL")
    return rows.select("doc_id", mapping.page_count(F.col("v")).alias("n_pages"))


#: Headers of texts, else of elements, numbered in their order, with the page count of their document.
HEADERS = f"""{ELEMENTS}, found AS (SELECT doc_id, {PAGE_COUNT} AS last_page, CASE WHEN json_exists(j, '$.texts') THEN json_extract(j, '$.texts[*]') ELSE json_extract(j, '$.elements[*]') END AS es FROM d),
each AS (SELECT doc_id, last_page, generate_subscripts(es, 1) AS i, unnest(es) AS e FROM found),
headers AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS id, {LEVEL} AS level, {TEXT} AS text, {PAGE} AS page, last_page FROM each WHERE {TYPE} = 'section_header')"""


@query("p05_headers", f"{HEADERS} SELECT doc_id AS document_id, id, level AS docling_level, text AS text_content, page AS page_number, last_page FROM headers")
def p05_headers(spark, sf_dir):
    return mapping.header_blocks(layouts(spark, sf_dir), "doc_id", "docling_json").drop("block_type")


@query(
    "s06_models",
    f"""SELECT parser_version AS model_name, min(strlen(title))::INTEGER AS dimension, arg_min(lang, (strlen(title), lang)) AS docling_version FROM documents d WHERE parser_version IS NOT NULL AND doc_id > {EARLIER}
        AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.parser_version < '2' AND e.parser_version = d.parser_version) AND lang IS NOT NULL GROUP BY parser_version""",
)
def s06_models(spark, sf_dir):
    """Rows for models that are not registered; releases stand for models, those before 2 for the registered ones."""
    rows = docs(spark, sf_dir, "doc_id", F.col("parser_version").alias("model_name"), F.octet_length("title").alias("dimension"), F.col("lang").alias("docling_version"))
    middle = docs(spark, sf_dir, "doc_id").agg(F.max("doc_id") / 2).scalar()
    return registration.register_models(rows.filter((F.col("doc_id") > middle) & F.col("docling_version").isNotNull()), rows.filter("model_name < '2'"))


@query("v07_manifest")
def v07_manifest(spark, sf_dir):
    from quire.operators.export import manifest

    return manifest({t: read_table(spark, sf_dir, t) for t in ("documents", "sections", "raw_blocks", "parent_chunks")})


@query("p11_documents", "SELECT doc_id FROM documents WHERE id IS NULL OR title IS NULL OR checksum_sha256 IS NULL")
def p11_documents(spark, sf_dir):
    return store.split_rejects(read_table(spark, sf_dir, "documents"), "documents")[1].select("doc_id")
