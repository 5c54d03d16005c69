"""Queries over the stored tables: navigation, statistics, constraints, reports and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import export, hierarchy, qa, registration, relations, retrieval, statistics, store, tables
from quire.plans.materialize import once
from quire.plans.registry import Registry, sql_strip
from quire.sources.tables import read_table

REGISTRY = Registry()
query = REGISTRY.query

#: Rows that repeat a section or chunk exactly are dropped before tables are joined.
S = "s AS (SELECT DISTINCT id, document_id, level, heading, heading_path, order_index, page_start, page_end FROM sections)"
C = "c AS (SELECT DISTINCT id, section_id, content, token_count, page_start, page_end FROM parent_chunks)"
B = "b AS (SELECT DISTINCT id, document_id, section_id, block_type, text_content, markdown_content, page_number FROM raw_blocks)"


def sections(spark, sf_dir):
    return read_table(spark, sf_dir, "sections").select("id", "document_id", "level", "heading", "heading_path", "order_index", "page_start", "page_end").distinct()


def chunks(spark, sf_dir):
    return once(read_table(spark, sf_dir, "parent_chunks").select("id", "section_id", "content", "token_count", "page_start", "page_end"), "id")


def blocks(spark, sf_dir):
    return once(read_table(spark, sf_dir, "raw_blocks").select("id", "document_id", "section_id", "block_type", "text_content", "markdown_content", "page_number"), "id")


@query("h17_no_chapter", f"WITH {S} SELECT document_id FROM s GROUP BY document_id HAVING count(*) FILTER (WHERE level = 1) = 0")
def h17_no_chapter(spark, sf_dir):
    return hierarchy.without_chapter(sections(spark, sf_dir))


# --- scans and writes -------------------------------------------------------------------------------------------


@query("s07_reading_order", f"WITH {B} SELECT document_id, id, row_number() OVER (PARTITION BY document_id ORDER BY page_number NULLS FIRST, id)::INTEGER AS pos FROM b")
def s07_reading_order(spark, sf_dir):
    return relations.reading_order(blocks(spark, sf_dir))


@query("s08_headers", "SELECT DISTINCT id, document_id, page_number, text_content, metadata->>'$.docling_label' AS docling_label, len(json_keys(metadata)) AS n_keys FROM raw_blocks WHERE block_type = 'section_header'")
def s08_headers(spark, sf_dir):
    """Header blocks with decoded metadata."""
    rows = read_table(spark, sf_dir, "raw_blocks").filter("block_type = 'section_header'").select("id", "document_id", "page_number", "text_content", F.from_json("metadata", "map<string,string>").alias("m"))
    return rows.select("id", "document_id", "page_number", "text_content", F.try_element_at("m", F.lit("docling_label")).alias("docling_label"), F.when(F.col("m").isNotNull(), F.size("m")).cast("bigint").alias("n_keys")).distinct()


@query("s13_rejects", "SELECT count(*) FILTER (WHERE ok) AS written, count(*) FILTER (WHERE NOT ok) AS rejected FROM (SELECT coalesce(text_content IS NOT NULL OR markdown_content IS NOT NULL, false) AND block_type IS NOT NULL AND page_number IS NOT NULL AS ok FROM raw_blocks)")
def s13_rejects(spark, sf_dir):
    rows = read_table(spark, sf_dir, "raw_blocks").select(F.size(store.violations("raw_blocks")).alias("n"))
    return rows.agg(F.count_if(F.col("n") == 0).alias("written"), F.count_if(F.col("n") > 0).alias("rejected"))


@query("s14_sections", "SELECT id, level >= 1 AND heading IS NOT NULL AND order_index IS NOT NULL AS ok FROM sections")
def s14_sections(spark, sf_dir):
    return read_table(spark, sf_dir, "sections").select("id", (F.size(store.violations("sections")) == 0).alias("ok"))


@query("s15_metadata", f"WITH {S}, {C} SELECT c.id, '{{\"heading_path\":' || to_json(s.heading_path) || ',\"order_index\":' || s.order_index || '}}' AS metadata FROM c JOIN s ON s.id = c.section_id")
def s15_metadata(spark, sf_dir):
    rows = relations.chunks_with_sections(chunks(spark, sf_dir), sections(spark, sf_dir))
    return rows.select("id", F.to_json(F.struct("heading_path", F.col("section_order").alias("order_index"))).alias("metadata"))


@query("s16_update_json", "SELECT id, left(CASE WHEN source = 'leaflet' THEN '{}' ELSE docling_json END, 30) AS head FROM documents")
def s16_update_json(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("id", "source", "docling_json")
    updates = docs.filter("source = 'leaflet'").select("id", F.lit("{}").alias("docling_json"))
    return store.update_json(docs, updates).select("id", F.left("docling_json", F.lit(30)).alias("head"))


@query("s16_update_whole", "SELECT id, length(j) AS n, md5(j) AS digest FROM (SELECT id, CASE WHEN source = 'leaflet' THEN '{}' ELSE docling_json END AS j FROM documents)")
def s16_update_whole(spark, sf_dir):
    """Length and digest of the whole texts of which s16_update_json has the heads."""
    docs = read_table(spark, sf_dir, "documents").select("id", "source", "docling_json")
    updates = docs.filter("source = 'leaflet'").select("id", F.lit("{}").alias("docling_json"))
    return store.update_json(docs, updates).select("id", F.length("docling_json").alias("n"), F.md5(F.col("docling_json").cast("binary")).alias("digest"))


@query(
    "s18_clear_sections",
    f"WITH {S}, {C}, {B}, gone AS (SELECT id FROM documents WHERE source = 'guideline'), dead AS (SELECT id FROM s WHERE document_id IN (SELECT id FROM gone)) "
    "SELECT (SELECT count(*) FROM s WHERE id NOT IN (SELECT id FROM dead)) AS n_sections, (SELECT count(*) FROM c WHERE section_id IS NULL OR section_id NOT IN (SELECT id FROM dead)) AS n_chunks, "
    "(SELECT count(*) FROM b WHERE section_id NOT IN (SELECT id FROM dead)) AS n_placed_blocks",
)
def s18_clear_sections(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").filter("source = 'guideline'").select("id")
    left = store.clear_sections({"sections": sections(spark, sf_dir), "parent_chunks": chunks(spark, sf_dir), "raw_blocks": blocks(spark, sf_dir)}, docs)
    placed = left["raw_blocks"].filter("section_id IS NOT NULL")
    counts = [left["sections"].agg(F.count("*").alias("n_sections")), left["parent_chunks"].agg(F.count("*").alias("n_chunks")), placed.agg(F.count("*").alias("n_placed_blocks"))]
    return counts[0].select("n_sections", counts[1].scalar().alias("n_chunks"), counts[2].scalar().alias("n_placed_blocks"))


@query("s17_set_sections", f"WITH {B}, last AS (SELECT document_id, id, max(section_id) AS section_id FROM b WHERE section_id IS NOT NULL GROUP BY ALL) SELECT b.id, l.section_id FROM b LEFT JOIN last l ON l.document_id = b.document_id AND l.id = b.id")
def s17_set_sections(spark, sf_dir):
    rows = blocks(spark, sf_dir)
    assigned = rows.filter("section_id IS NOT NULL").groupBy("document_id", "id").agg(F.max("section_id").alias("section_id"))
    return store.set_sections(rows, assigned).select("id", "section_id")


@query("s19_delete_chunks", f"WITH {S}, {C} SELECT id FROM c WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = c.section_id AND s.level = 2)")
def s19_delete_chunks(spark, sf_dir):
    gone = sections(spark, sf_dir).filter("level = 2").select("id")
    return store.delete_sections({"sections": sections(spark, sf_dir), "parent_chunks": chunks(spark, sf_dir)}, gone)["parent_chunks"].select("id")


GONE = "gone AS (SELECT id FROM documents WHERE source = 'guideline')"


@query(
    "s20_cascade",
    f"WITH {S}, {C}, {B}, {GONE}, dead AS (SELECT id FROM s WHERE document_id IN (SELECT id FROM gone)) "
    "SELECT 'documents' AS table_name, count(*) AS n_rows FROM documents WHERE id NOT IN (SELECT id FROM gone) UNION ALL SELECT 'sections', count(*) FROM s WHERE id NOT IN (SELECT id FROM dead) "
    "UNION ALL SELECT 'parent_chunks', count(*) FROM c WHERE section_id IS NULL OR section_id NOT IN (SELECT id FROM dead) UNION ALL SELECT 'raw_blocks', count(*) FROM b WHERE document_id NOT IN (SELECT id FROM gone)",
)
def s20_cascade(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("id", "source")
    held = {"documents": docs, "sections": sections(spark, sf_dir), "parent_chunks": chunks(spark, sf_dir), "raw_blocks": blocks(spark, sf_dir)}
    return store.table_stats(store.delete_document(held, docs.filter("source = 'guideline'")))


@query("s20_set_null", f"WITH {S}, {B} SELECT b.id, CASE WHEN s.id IS NULL THEN b.section_id END AS section_id FROM b LEFT JOIN s ON s.id = b.section_id AND s.level = 3")
def s20_set_null(spark, sf_dir):
    gone = sections(spark, sf_dir).filter("level = 3").select("id")
    return store.delete_sections({"sections": sections(spark, sf_dir), "raw_blocks": blocks(spark, sf_dir)}, gone)["raw_blocks"].select("id", "section_id")


@query("s21_tree", f"WITH {S} SELECT document_id, order_index, id, repeat('  ', level - 1) || '- ' || heading || coalesce(CASE WHEN page_start = page_end THEN ' (page ' || page_start || ')' ELSE ' (pages ' || page_start || '-' || page_end || ')' END, '') AS line FROM s")
def s21_tree(spark, sf_dir):
    return export.tree_lines(sections(spark, sf_dir))


@query(
    "s21_report",
    f"""WITH {S}, l AS (SELECT document_id, order_index, id, repeat('  ', level - 1) || '- ' || heading || coalesce(CASE WHEN page_start = page_end THEN ' (page ' || page_start || ')' ELSE ' (pages ' || page_start || '-' || page_end || ')' END, '') AS line, level FROM s)
    SELECT document_id, '# Section hierarchy of ' || document_id || chr(10) || chr(10) || 'Total sections: ' || count(*) || chr(10) || {" || chr(10) || ".join(f"'- Level {k}: ' || count(*) FILTER (WHERE level = {k})" for k in range(1, 6))}
        || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY order_index, id) || chr(10) AS text FROM l GROUP BY document_id""",
)
def s21_report(spark, sf_dir):
    return export.tree_document(sections(spark, sf_dir))


@query(
    "s22_markdown",
    f"WITH {S}, {C} SELECT s.order_index AS section_order, c.id, '## Chunk ' || c.id || chr(10) || chr(10) || '**' || s.heading_path || '** (pages ' || coalesce(nullif(c.page_start, 0)::VARCHAR, '?') || '-' || coalesce(nullif(c.page_end, 0)::VARCHAR, '?') || ', ' "
    "|| coalesce(c.token_count::VARCHAR, '?') || ' tokens)' || chr(10) || chr(10) || coalesce(c.content, '') AS text FROM c JOIN s ON s.id = c.section_id",
)
def s22_markdown(spark, sf_dir):
    return export.chunk_markdown(chunks(spark, sf_dir), sections(spark, sf_dir))


#: DuckDB's names of the types; the schema of a store asks for the columns that are listed.
_TYPES = "CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' WHEN 'BLOB' THEN 'binary' WHEN 'STRUCT(l DOUBLE, t DOUBLE, r DOUBLE, b DOUBLE)' THEN 'struct<l:double,t:double,r:double,b:double>' END"
_ASKED = {
    "documents": "id title version_label source_url checksum_sha256 pdf_bytes docling_json created_at",
    "parent_chunks": "id section_id content token_count page_start page_end metadata created_at",
    "raw_blocks": "id document_id section_id block_type text_content markdown_content page_number page_range docling_level bbox is_continuation element_id metadata created_at",
    "sections": "id document_id level heading heading_path order_index page_start page_end metadata created_at",
}


@query(
    "s26_schema",
    f"SELECT table_name, column_name, {_TYPES} AS data_type, "
    + " OR ".join(f"(table_name = '{t}' AND column_name IN ({', '.join(repr(c) for c in names.split())}))" for t, names in _ASKED.items())
    + f" AS expected FROM information_schema.columns WHERE table_name IN ({', '.join(repr(t) for t in _ASKED)})",
)
def s26_schema(spark, sf_dir):
    """Columns and types of the stored tables against the schema of a store."""
    return store.schema_info({t: read_table(spark, sf_dir, t) for t in _ASKED})


STATS = ("documents", "embeddings", "parent_chunks", "raw_blocks", "sections")


@query("s27_table_stats", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in STATS))
def s27_table_stats(spark, sf_dir):
    return store.table_stats({t: read_table(spark, sf_dir, t) for t in STATS})


@query("p11_chunks", "SELECT id, list_filter([CASE WHEN NOT coalesce(token_count > 0, false) THEN 'tokens' END, CASE WHEN NOT coalesce(length(content) > 0, false) THEN 'content' END], lambda x: x IS NOT NULL)::VARCHAR AS broken FROM parent_chunks WHERE NOT coalesce(token_count > 0, false) OR NOT coalesce(length(content) > 0, false)")
def p11_chunks(spark, sf_dir):
    bad = store.split_rejects(read_table(spark, sf_dir, "parent_chunks"), "parent_chunks")[1]
    return bad.select("id", F.concat(F.lit("["), F.array_join("broken", ", "), F.lit("]")).alias("broken"))


# --- predicates and joins ---------------------------------------------------------------------------------------


@query("p06_levels", "SELECT id, level FROM sections WHERE level >= 3")
def p06_levels(spark, sf_dir):
    return read_table(spark, sf_dir, "sections").filter("level >= 3").select("id", "level")


@query("p08_search", f"WITH {S}, {C} SELECT c.id, s.heading, left(replace(left(c.content, 150), chr(10), ' '), 120) AS preview FROM c JOIN s ON s.id = c.section_id WHERE contains(lower(c.content), 'fever') ORDER BY c.id LIMIT 20")
def p08_search(spark, sf_dir):
    from quire.functions.text import preview

    rows = relations.search(chunks(spark, sf_dir), sections(spark, sf_dir), "fever", 20)
    return rows.select("id", "heading", preview(F.col("content")).alias("preview"))


@query("p10_nulls", "SELECT id, CASE WHEN text_content IS NULL AND markdown_content IS NULL THEN 'none' WHEN text_content IS NULL THEN 'markdown' WHEN markdown_content IS NULL THEN 'text' ELSE 'both' END AS content FROM raw_blocks")
def p10_nulls(spark, sf_dir):
    text, markdown = F.col("text_content"), F.col("markdown_content")
    kind = F.when(text.isNull() & markdown.isNull(), "none").when(text.isNull(), "markdown").when(markdown.isNull(), "text").otherwise("both")
    return read_table(spark, sf_dir, "raw_blocks").select("id", kind.alias("content"))


@query("j01_chunks_sections", f"WITH {S}, {C} SELECT c.id, c.section_id, s.heading, s.heading_path, s.order_index AS section_order FROM c JOIN s ON s.id = c.section_id")
def j01_chunks_sections(spark, sf_dir):
    return relations.chunks_with_sections(chunks(spark, sf_dir), sections(spark, sf_dir)).select("id", "section_id", "heading", "heading_path", "section_order")


@query("j03_descendants", f"WITH {S} SELECT a.id, d.id AS descendant_id, d.level - a.level AS depth FROM s a JOIN s d ON d.document_id = a.document_id AND d.level > a.level AND starts_with(d.heading_path, a.heading_path || ' > ')")
def j03_descendants(spark, sf_dir):
    return relations.descendants(sections(spark, sf_dir))


@query("j04_section_blocks", f"WITH {S}, {B} SELECT b.id, b.section_id FROM b WHERE b.section_id IN (SELECT id FROM s WHERE level = 2)")
def j04_section_blocks(spark, sf_dir):
    ids = sections(spark, sf_dir).filter("level = 2").select(F.col("id").alias("section_id"))
    return blocks(spark, sf_dir).join(ids, "section_id", "left_semi").select("id", "section_id")


UP = "CASE WHEN contains(heading_path, ' > ') THEN regexp_replace(heading_path, '(?s)^(.*) > .*$', '\\1') END"


@query("j05_parents", f"WITH {S}, up AS (SELECT id, document_id, {UP} AS path FROM s) SELECT u.id, min(p.id) AS parent_id FROM up u JOIN s p ON p.document_id = u.document_id AND p.heading_path = u.path GROUP BY u.id, u.path")
def j05_parents(spark, sf_dir):
    return relations.parents(sections(spark, sf_dir))


@query("j06_siblings", f"WITH {S}, k AS (SELECT *, coalesce({UP}, '') AS up FROM s) SELECT a.id, b.id AS sibling_id FROM k a JOIN k b ON a.document_id = b.document_id AND a.level = b.level AND a.up = b.up AND b.order_index BETWEEN a.order_index - 5 AND a.order_index + 5 AND a.id <> b.id")
def j06_siblings(spark, sf_dir):
    return relations.siblings(sections(spark, sf_dir))


@query("j07_children", f"WITH {S}, {B} SELECT a.id, d.id AS child_id, (SELECT count(*) FROM b WHERE b.section_id = d.id) AS n_blocks FROM s a JOIN s d ON d.document_id = a.document_id AND d.level = a.level + 1 AND starts_with(d.heading_path, a.heading_path || ' > ')")
def j07_children(spark, sf_dir):
    return relations.children(sections(spark, sf_dir), blocks(spark, sf_dir))


@query("j12_with_blocks", "SELECT id FROM documents d WHERE EXISTS (SELECT 1 FROM raw_blocks b WHERE b.document_id = d.id)")
def j12_with_blocks(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("id").join(read_table(spark, sf_dir, "raw_blocks").select(F.col("document_id").alias("id")), "id", "left_semi")


# --- statistics -------------------------------------------------------------------------------------------------


@query("a01_blocks", "SELECT document_id, count(*) AS n_blocks, count(text_content) AS with_text, count(markdown_content) AS with_markdown, count(*) FILTER (WHERE text_content IS NULL AND markdown_content IS NULL) AS with_neither, count(section_id) AS in_section FROM raw_blocks GROUP BY document_id")
def a01_blocks(spark, sf_dir):
    return statistics.content_counts(read_table(spark, sf_dir, "raw_blocks"))


@query("a02_types", "SELECT block_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM raw_blocks GROUP BY block_type")
def a02_types(spark, sf_dir):
    return statistics.type_counts(read_table(spark, sf_dir, "raw_blocks"))


@query("a03_pages", "SELECT document_id, min(page_number) AS first_page, max(page_number) AS last_page, CASE WHEN min(page_number) <> 0 AND max(page_number) <> 0 THEN max(page_number) - min(page_number) + 1 ELSE 0 END AS n_pages FROM raw_blocks GROUP BY document_id")
def a03_pages(spark, sf_dir):
    return statistics.page_span(read_table(spark, sf_dir, "raw_blocks"))


@query("a05_gaps", "WITH p AS (SELECT DISTINCT document_id, page_number FROM raw_blocks WHERE page_number > 0), e AS (SELECT document_id, unnest(range(min(page_number), max(page_number) + 1))::INTEGER AS page_number FROM p GROUP BY document_id) SELECT * FROM e EXCEPT SELECT * FROM p")
def a05_gaps(spark, sf_dir):
    return statistics.missing_pages(read_table(spark, sf_dir, "raw_blocks"))


@query(
    "a05_ranges",
    "WITH p AS (SELECT DISTINCT document_id, page_number FROM raw_blocks WHERE page_number > 0) SELECT a.document_id, a.page_number + 1 AS first_page, (min(b.page_number) - 1)::INTEGER AS last_page FROM p a JOIN p b ON a.document_id IS NOT DISTINCT FROM b.document_id AND b.page_number > a.page_number GROUP BY a.document_id, a.page_number HAVING min(b.page_number) > a.page_number + 1",
)
def a05_ranges(spark, sf_dir):
    return statistics.missing_ranges(read_table(spark, sf_dir, "raw_blocks"))


TOKEN_STATS = "count(*) AS n, min(token_count) AS least, max(token_count) AS most, round(avg(token_count), 6) AS mean, sum(token_count)::BIGINT AS total, median(token_count) AS median, count(*) FILTER (WHERE token_count > 2000) AS over_limit"


@query("a06_tokens", f"SELECT {TOKEN_STATS} FROM parent_chunks")
def a06_tokens(spark, sf_dir):
    return statistics.token_stats(read_table(spark, sf_dir, "parent_chunks"))


BUCKET = "CASE WHEN token_count < 500 THEN 1 WHEN token_count < 1000 THEN 2 WHEN token_count < 1500 THEN 3 WHEN token_count < 2000 THEN 4 WHEN token_count IS NOT NULL THEN 5 END"


@query("a07_histogram", f"SELECT ['< 500', '500-999', '1000-1499', '1500-1999', '>= 2000'][rank] AS bucket, rank, n FROM (SELECT {BUCKET} AS rank, count(*) AS n FROM parent_chunks GROUP BY 1)")
def a07_histogram(spark, sf_dir):
    return statistics.histogram(read_table(spark, sf_dir, "parent_chunks"))


COVERAGE = "SELECT count(DISTINCT s.id) AS total_sections, count(DISTINCT c.section_id) AS with_chunks, round(count(c.id)::DOUBLE / count(DISTINCT s.id), 6) AS chunks_per_section FROM s LEFT JOIN c ON c.section_id = s.id WHERE s.level = 2"


@query("a08_coverage", f"WITH {S}, {C} {COVERAGE}")
def a08_coverage(spark, sf_dir):
    return statistics.coverage(sections(spark, sf_dir), chunks(spark, sf_dir))


@query("a10_section_medians", f"WITH {C} SELECT section_id, median(token_count) AS median, round(avg(token_count), 6) AS mean, count(*) FILTER (WHERE token_count > 2000) AS over_limit FROM c GROUP BY section_id")
def a10_section_medians(spark, sf_dir):
    t = F.col("token_count")
    return chunks(spark, sf_dir).groupBy("section_id").agg(F.median(t).alias("median"), F.round(F.avg(t), 6).alias("mean"), F.count_if(t > 2000).alias("over_limit"))


@query("a12_levels", f"WITH {S} SELECT level, count(*) AS n, count(DISTINCT document_id) AS n_documents FROM s GROUP BY level")
def a12_levels(spark, sf_dir):
    return statistics.level_counts(sections(spark, sf_dir))


# --- reports ----------------------------------------------------------------------------------------------------


@query(
    "q01_stats",
    f"WITH {S}, {C}, t AS (SELECT {TOKEN_STATS} FROM c), v AS ({COVERAGE}), w AS (SELECT * FROM t, v) "
    + " UNION ALL ".join(f"SELECT '{m}' AS measure, {m}::DOUBLE AS value FROM w" for m in ("n", "least", "most", "mean", "total", "median", "over_limit", "total_sections", "with_chunks", "chunks_per_section"))
    + f" UNION ALL SELECT 'bucket ' || ['< 500', '500-999', '1000-1499', '1500-1999', '>= 2000'][rank], n FROM (SELECT {BUCKET} AS rank, count(*)::DOUBLE AS n FROM c GROUP BY 1) WHERE rank IS NOT NULL",
)
def q01_stats(spark, sf_dir):
    return statistics.report(sections(spark, sf_dir), chunks(spark, sf_dir))


@query(
    "q02_list",
    f"WITH {S}, {C} SELECT s.id AS section_id, any_value(s.heading) AS heading, any_value(s.order_index) AS order_index, count(c.id) AS chunk_count, sum(c.token_count)::BIGINT AS total_tokens, min(c.token_count) AS min_tokens, max(c.token_count) AS max_tokens FROM s LEFT JOIN c ON c.section_id = s.id WHERE s.level = 2 GROUP BY s.id",
)
def q02_list(spark, sf_dir):
    return statistics.section_rollup(sections(spark, sf_dir), chunks(spark, sf_dir))


@query("q02_chunks", f"WITH {S}, {C} SELECT c.section_id, c.id, c.id || '(' || coalesce(c.token_count, 0) || ')' AS shown FROM c JOIN s ON s.id = c.section_id WHERE s.level = 2")
def q02_chunks(spark, sf_dir):
    return statistics.section_chunks(sections(spark, sf_dir), chunks(spark, sf_dir))


@query("q03_view", f"WITH {S}, {C} SELECT c.id, s.heading_path, c.content, c.token_count FROM c JOIN s ON s.id = c.section_id WHERE c.id = (SELECT max(id) FROM c WHERE section_id IN (SELECT id FROM s))")
def q03_view(spark, sf_dir):
    """The newest chunk that has a section."""
    rows = relations.chunks_with_sections(chunks(spark, sf_dir), sections(spark, sf_dir)).select("id", "heading_path", "content", "token_count")
    return rows.orderBy(F.desc("id")).limit(1)


@query("q04_section", f"WITH {S}, {C} SELECT s.id AS section_id, s.heading, c.id, c.token_count, left(replace(left(c.content, 150), chr(10), ' '), 120) AS preview FROM s JOIN c ON c.section_id = s.id")
def q04_section(spark, sf_dir):
    from quire.functions.text import preview

    rows = relations.chunks_with_sections(chunks(spark, sf_dir), sections(spark, sf_dir))
    return rows.select("section_id", "heading", "id", "token_count", preview(F.col("content")).alias("preview"))


@query("q06_sections", f"WITH {S} SELECT document_id, id, level, heading FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY order_index, id) AS n FROM s) WHERE n <= 10")
def q06_sections(spark, sf_dir):
    """The first ten sections of every document."""
    from pyspark.sql.window import Window

    first = F.row_number().over(Window.partitionBy("document_id").orderBy("order_index", "id"))
    return sections(spark, sf_dir).withColumn("n", first).filter("n <= 10").select("document_id", "id", "level", "heading")


def _listed(pairs: str, other: str, title: str) -> str:
    return f"SELECT x.id, chr(10) || chr(10) || '## {title}' || chr(10) || chr(10) || string_agg('- ' || o.heading || ' (' || o.id || ')', chr(10) ORDER BY o.id, o.heading) AS {other} FROM ({pairs}) x JOIN s o ON o.id = x.other GROUP BY x.id"


def _p(x: str) -> str:
    return f"coalesce(nullif({x}, 0)::VARCHAR, '?')"


@query(
    "s24_markdown",
    f"""WITH {S}, {B}, k AS (SELECT *, coalesce({UP}, '') AS up FROM s),
    parent AS ({_listed("SELECT u.id, min(p.id) AS other FROM k u JOIN s p ON p.document_id = u.document_id AND p.heading_path = nullif(u.up, '') GROUP BY u.id", "parent", "Parent")}),
    sibling AS ({_listed("SELECT a.id, b.id AS other FROM k a JOIN k b ON a.document_id = b.document_id AND a.level = b.level AND a.up = b.up AND b.order_index BETWEEN a.order_index - 10 AND a.order_index + 10 AND a.id <> b.id", "sibling", "Siblings")}),
    child AS ({_listed("SELECT a.id, d.id AS other FROM s a JOIN s d ON d.document_id = a.document_id AND d.level = a.level + 1 AND starts_with(d.heading_path, a.heading_path || ' > ')", "child", "Children")}),
    own AS (SELECT section_id AS id, chr(10) || chr(10) || '## Blocks' || chr(10) || chr(10) || string_agg('- p. ' || {_p("page_number")} || ', ' || id || ' [' || coalesce(block_type, '?') || '] ' || replace(left(coalesce(text_content, markdown_content, ''), 80), chr(10), ' '), chr(10) ORDER BY page_number, id) AS own
        FROM b WHERE section_id IS NOT NULL GROUP BY section_id)
    SELECT document_id, id, '# ' || heading || chr(10) || chr(10) || 'Level ' || level || ', pages ' || {_p("page_start")} || '-' || {_p("page_end")} || chr(10) || chr(10) || 'Path: ' || heading_path
        || coalesce(parent, '') || coalesce(sibling, '') || coalesce(child, '') || coalesce(own, '') || chr(10) AS text FROM s LEFT JOIN parent USING (id) LEFT JOIN sibling USING (id) LEFT JOIN child USING (id) LEFT JOIN own USING (id)""",
)
def s24_markdown(spark, sf_dir):
    """Every section as Markdown with its parent, siblings, children and blocks."""
    return export.section_samples(sections(spark, sf_dir), blocks(spark, sf_dir))


@query("s24_sample", f"WITH {S}, {B}, k AS (SELECT *, coalesce({UP}, '') AS up FROM s) SELECT a.id, (SELECT count(*) FROM k b WHERE b.document_id = a.document_id AND b.level = a.level AND b.up = a.up AND b.order_index BETWEEN a.order_index - 10 AND a.order_index + 10 AND b.id <> a.id) AS n_siblings, (SELECT count(*) FROM b WHERE b.section_id = a.id) AS n_blocks FROM k a")
def s24_sample(spark, sf_dir):
    rows = sections(spark, sf_dir)
    near = relations.siblings(rows, 10).groupBy("id").agg(F.count("*").alias("n_siblings"))
    own = blocks(spark, sf_dir).filter("section_id IS NOT NULL").groupBy(F.col("section_id").alias("id")).agg(F.count("*").alias("n_blocks"))
    return rows.select("id").join(near, "id", "left").join(own, "id", "left").fillna(0, ["n_siblings", "n_blocks"])


# --- retrieval, tables, review ----------------------------------------------------------------------------------

PAIRS = "d AS (SELECT q.vec_id AS query_id, v.vec_id AS chunk_id, v.label, sqrt(list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ** 2))) AS distance FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0)"
NEAREST = f"{PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM d)"


def _vectors(spark, sf_dir):
    v = read_table(spark, sf_dir, "embeddings")
    queries = v.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return queries, v.select(F.col("vec_id").alias("chunk_id"), "embedding"), v.select(F.col("vec_id").alias("chunk_id"), F.col("label").alias("parent_id"))


@query("v01_knn", f"WITH {NEAREST} SELECT query_id, chunk_id, round(distance, 6) AS distance, rank::INTEGER AS rank FROM r WHERE rank <= 10")
def v01_knn(spark, sf_dir):
    queries, vectors, _ = _vectors(spark, sf_dir)
    return retrieval.knn(queries, vectors, 10).withColumn("distance", F.round("distance", 6))


@query("v02_parents", f"WITH {NEAREST} SELECT query_id, label AS parent_id, round(min(distance), 6) AS distance, count(*) AS n_chunks FROM r WHERE rank <= 10 GROUP BY query_id, label")
def v02_parents(spark, sf_dir):
    queries, vectors, parents = _vectors(spark, sf_dir)
    return retrieval.expand_parents(retrieval.knn(queries, vectors, 10), parents).withColumn("distance", F.round("distance", 6))


CELL = f"list_transform(string_split(regexp_replace({sql_strip('x')}, '\\A\\||\\|\\z', '', 'g'), '|'), lambda y: {sql_strip('y')})"


@query(
    "v04_tables",
    f"""
    WITH {B}, t AS (SELECT id, list_transform(list_filter(regexp_split_to_array(markdown_content, '\\r\\n|\\r|\\n'), lambda x: starts_with({sql_strip('x')}, '|') AND NOT regexp_matches(x, '^[\\s|:-]+$')), lambda x: {CELL}) AS rows FROM b WHERE markdown_content IS NOT NULL),
    f AS (SELECT id, rows[1] AS head, len(rows) - 1 AS n_rows, len(rows[1]) AS n_cols, unnest(rows[2:]) AS row, generate_subscripts(rows[2:], 1) - 1 AS row_no FROM t WHERE len(rows) > 1)
    SELECT id, row_no::INTEGER AS row_no, n_rows::INTEGER AS n_rows, n_cols::INTEGER AS n_cols, n_rows > 50 OR n_cols > 10 AS is_large,
           array_to_string(list_filter(list_transform(list_zip(head, row), lambda p: CASE WHEN p[2] <> '' THEN coalesce(p[1], '') || ': ' || p[2] END), lambda z: z IS NOT NULL), '; ') AS text FROM f
    """,
)
def v04_tables(spark, sf_dir):
    return tables.linearize(blocks(spark, sf_dir), "id", "markdown_content")


@query("v05_review", f"WITH {S}, {C} SELECT * FROM (SELECT c.id, c.section_id, CASE WHEN regexp_matches(lower(s.heading_path), 'emergenc|vaccin') THEN 'always' WHEN ('0x' || left(md5(c.id::VARCHAR), 8))::BIGINT::DOUBLE / 4294967296 < 0.2 THEN 'sample' END AS reason FROM c JOIN s ON s.id = c.section_id) WHERE reason IS NOT NULL")
def v05_review(spark, sf_dir):
    return qa.review_sample(chunks(spark, sf_dir), sections(spark, sf_dir))


@query("v03_models", "SELECT 'text-embedding-3-small' AS model_name, len(embedding)::INTEGER AS dimension, count(*) AS n, min(vec_id) AS first_id, round(sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE))), 3) AS total FROM embeddings WHERE embedding IS NOT NULL GROUP BY len(embedding)")
def v03_models(spark, sf_dir):
    """What embedding metadata says of the stored vectors: one row per dimension."""
    v = read_table(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    rows = v.groupBy(F.size("embedding").alias("dimension")).agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.round(F.sum(total), 3).alias("total"))
    return rows.select(F.lit("text-embedding-3-small").alias("model_name"), "dimension", "n", "first_id", "total")


def document_key_of(spark, sf_dir):
    """Ids by content: the same checksum always gives the same id."""
    return read_table(spark, sf_dir, "documents").select("checksum_sha256", registration.document_key(F.col("checksum_sha256")).alias("key")).distinct()


query("s06_keys", "SELECT DISTINCT checksum_sha256, concat_ws('-', substring(checksum_sha256, 1, 8), substring(checksum_sha256, 9, 4), substring(checksum_sha256, 13, 4), substring(checksum_sha256, 17, 4), substring(checksum_sha256, 21, 12)) AS key FROM documents")(document_key_of)
