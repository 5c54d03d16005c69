"""Queries over blocks: text rules, headings, section trees, assignment and chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import predicates, text
from quire.operators import assign as asg
from quire.operators import chunking, hierarchy, mapping
from quire.plans.document_queries import HEADERS, layouts
from quire.plans.materialize import materialize, spread
from quire.plans.registry import SQL_PY_WS, Registry, sql_strip, sql_tokens
from quire.sources.tables import read_table

REGISTRY = Registry()
query = REGISTRY.query

BLOCK_COLUMNS = ("id", "document_id", "block_type", "text_content", "markdown_content", "page_number", "docling_level")
ONCE = f"once AS (SELECT DISTINCT {', '.join(BLOCK_COLUMNS)} FROM raw_blocks)"


def blocks(spark, sf_dir, *columns):
    return spread(read_table(spark, sf_dir, "raw_blocks").select(*(columns or BLOCK_COLUMNS)))


# --- text -------------------------------------------------------------------------------------------------------


def _chain(sql: str) -> str:
    for b in text.BULLETS:
        sql = f"regexp_replace({sql}, '(?m)^([{SQL_PY_WS}]*){b}[{SQL_PY_WS}]*', '\\1- ', 'g')"
    return sql


def _squeeze(sql: str) -> str:
    sql = rf"regexp_replace({sql}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    sql = rf"regexp_replace({sql}, '(?m)[ \t]+$', '', 'g')"
    return sql_strip(rf"regexp_replace({sql}, '\r\n?', chr(10), 'g')")


CONTENT = "coalesce(nullif(markdown_content, ''), text_content)"
FENCE = f"chr(10) || chr(10) || '[TABLE]' || chr(10) || {sql_strip(CONTENT)} || chr(10) || '[/TABLE]' || chr(10) || chr(10)"
CLEAN = f"""CASE WHEN block_type IN ('page_header', 'page_footer') OR {CONTENT} IS NULL OR {sql_strip(CONTENT)} = '' THEN NULL
    WHEN block_type = 'table' THEN {FENCE}
    WHEN block_type IN ('figure', 'picture') THEN chr(10) || chr(10) || CASE WHEN length({sql_strip(CONTENT)}) < 200 THEN '[FIGURE: ' || {sql_strip(CONTENT)} || ']' ELSE '[FIGURE]' END || chr(10) || chr(10)
    ELSE {_squeeze(_chain(CONTENT))} END"""


@query("t01_bullets", f"SELECT id, {_chain('text_content')} AS value FROM raw_blocks WHERE text_content IS NOT NULL")
def t01_bullets(spark, sf_dir):
    return blocks(spark, sf_dir, "id", "text_content").filter("text_content IS NOT NULL").select("id", text.bullets(F.col("text_content")).alias("value"))


@query("t02_lines", f"SELECT id, {_squeeze('text_content')} AS value FROM raw_blocks WHERE text_content IS NOT NULL")
def t02_lines(spark, sf_dir):
    return blocks(spark, sf_dir, "id", "text_content").filter("text_content IS NOT NULL").select("id", text.squeeze_lines(F.col("text_content")).alias("value"))


@query("t03_markdown", f"SELECT id, coalesce({_squeeze(_chain('markdown_content'))}, '') AS value FROM raw_blocks")
def t03_markdown(spark, sf_dir):
    return blocks(spark, sf_dir, "id", "markdown_content").select("id", text.normalize_markdown(F.col("markdown_content")).alias("value"))


@query("t04_fence", f"SELECT id, {FENCE} AS value FROM raw_blocks WHERE block_type = 'table'")
def t04_fence(spark, sf_dir):
    rows = blocks(spark, sf_dir, "id", "block_type", "markdown_content", "text_content").filter("block_type = 'table'")
    return rows.select("id", text.table_fence(F.coalesce(F.nullif("markdown_content", F.lit("")), "text_content")).alias("value"))


@query("t05_figure", f"SELECT id, chr(10) || chr(10) || CASE WHEN {sql_strip('text_content')} <> '' THEN '[FIGURE: ' || {sql_strip('text_content')} || ']' ELSE '[FIGURE]' END || chr(10) || chr(10) AS value FROM raw_blocks WHERE block_type IN ('caption', 'table')")
def t05_figure(spark, sf_dir):
    rows = blocks(spark, sf_dir, "id", "block_type", "text_content").filter("block_type IN ('caption', 'table')")
    return rows.select("id", text.figure_placeholder(F.col("text_content")).alias("value"))


@query("t06_clean", f"SELECT id, {CLEAN} AS value FROM raw_blocks")
def t06_clean(spark, sf_dir):
    return blocks(spark, sf_dir).select("id", text.clean_block(F.col("block_type"), F.col("text_content"), F.col("markdown_content")).alias("value"))


def _key(x: str) -> str:
    return sql_strip(f"regexp_replace(lower({x}), '[{SQL_PY_WS}]+', ' ', 'g')")


@query("t07_heading_key", f"SELECT id, {_key('text_content')} AS value FROM raw_blocks WHERE block_type = 'section_header'")
def t07_heading_key(spark, sf_dir):
    rows = blocks(spark, sf_dir, "id", "block_type", "text_content").filter("block_type = 'section_header'")
    return rows.select("id", text.heading_key(F.col("text_content")).alias("value"))


@query("t08_tokens", f"SELECT id, {sql_tokens('content')} AS n_tokens FROM parent_chunks")
def t08_tokens(spark, sf_dir):
    from quire.functions.tokens import words

    return read_table(spark, sf_dir, "parent_chunks").select("id", words(F.col("content")).cast("bigint").alias("n_tokens"))


# --- headings ---------------------------------------------------------------------------------------------------

END = "|".join(predicates.END_MATTER)
FRONT = "|".join(predicates.FRONT_MATTER)
SUB = f"^(?:{'|'.join(predicates.SUBSECTION)})"


def _matches(pattern: str, x: str) -> str:
    return f"regexp_matches(lower({x}), '{pattern}')"


def _number(x: str) -> str:
    n = rf"regexp_extract({x}, '^(\d+(?:\.\d+)*)', 1)"
    return f"CASE WHEN {_matches(END, x)} THEN 1 WHEN {n} <> '' THEN least(len(string_split({n}, '.')), 5) END"


def _heading_query(name: str, sql: str, column):
    @query(name, f"SELECT id, {sql} AS value FROM sections")
    def run(spark, sf_dir):
        return read_table(spark, sf_dir, "sections").select("id", column(F.col("heading")).alias("value"))


_heading_query("p01_end_matter", _matches(END, "heading"), predicates.is_end_matter)
_heading_query("p02_front_matter", _matches(FRONT, "heading"), predicates.is_front_matter)
_heading_query("p03_subsection", _matches(SUB, "heading"), predicates.is_subsection)
_heading_query("p04_numbering", f"({_number('heading')})::INTEGER", predicates.numbering_level)

HEADS = f"""{ONCE}, heads AS (SELECT * FROM (
    SELECT document_id, (row_number() OVER (PARTITION BY document_id ORDER BY id) - 1)::INTEGER AS order_index, id AS block_id, {sql_strip('text_content')} AS heading, docling_level AS native_level, coalesce(page_number, 0) AS page_start
    FROM once WHERE block_type = 'section_header') WHERE heading <> '')"""
LEVELS = f"""{HEADS}, fixed AS (SELECT *, {_matches(SUB, 'heading')} AS sub,
      coalesce({_number('heading')}, CASE WHEN {_matches(FRONT, 'heading')} THEN 1 END, CASE WHEN NOT {_matches(SUB, 'heading')} AND native_level >= 2 THEN native_level END) AS fixed FROM heads),
  state AS (SELECT *, coalesce(last_value(fixed IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY order_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS last FROM fixed),
  leveled AS (SELECT document_id, order_index, block_id, heading, native_level, page_start, row_number() OVER (PARTITION BY document_id ORDER BY page_start, order_index)::INTEGER AS pos,
      coalesce(fixed, CASE WHEN native_level = 1 AND last < 2 AND NOT sub THEN 1 END, least(last + 1, 5))::INTEGER AS level FROM state)"""
# written as joins over all later and earlier headings of the document, not as the windows of the operator
ENDS = f"""{LEVELS}, nexts AS (SELECT a.document_id, a.pos, arg_min(b.page_start, b.pos) AS next_start FROM leveled a JOIN leveled b ON a.document_id IS NOT DISTINCT FROM b.document_id AND b.pos > a.pos AND b.level <= a.level GROUP BY ALL),
  lasts AS (SELECT document_id, max(page_start) + 20 AS last_page FROM leveled GROUP BY document_id),
  ended AS (SELECT a.*, coalesce(CASE WHEN n.next_start IS NOT NULL THEN greatest(a.page_start, n.next_start - 1) END, l.last_page)::INTEGER AS page_end FROM leveled a JOIN lasts l ON a.document_id IS NOT DISTINCT FROM l.document_id LEFT JOIN nexts n ON a.document_id IS NOT DISTINCT FROM n.document_id AND a.pos = n.pos)"""
PATHS = f"""{ENDS}, above AS (SELECT a.document_id, a.pos, b.level, max(b.pos) AS up FROM leveled a JOIN leveled b ON a.document_id IS NOT DISTINCT FROM b.document_id AND b.pos < a.pos AND b.level < a.level GROUP BY ALL),
  open AS (SELECT x.* FROM above x WHERE NOT EXISTS (SELECT 1 FROM above y WHERE y.document_id IS NOT DISTINCT FROM x.document_id AND y.pos = x.pos AND y.level < x.level AND y.up > x.up)),
  named AS (SELECT o.document_id, o.pos, string_agg(b.heading, ' > ' ORDER BY o.level) AS prefix FROM open o JOIN leveled b ON b.document_id IS NOT DISTINCT FROM o.document_id AND b.pos = o.up GROUP BY ALL),
  tree AS (SELECT e.document_id, e.order_index, e.pos, e.level, e.heading, coalesce(n.prefix || ' > ', '') || e.heading AS heading_path, e.page_start, e.page_end, e.native_level, e.block_id
      FROM ended e LEFT JOIN named n ON n.document_id IS NOT DISTINCT FROM e.document_id AND n.pos = e.pos)"""


@query("h01_headings", f"WITH {HEADS} SELECT * FROM heads")
def h01_headings(spark, sf_dir):
    return hierarchy.headings(blocks(spark, sf_dir))


@query("h02_levels", f"WITH {LEVELS} SELECT document_id, order_index, level FROM leveled")
def h02_levels(spark, sf_dir):
    return hierarchy.with_levels(hierarchy.headings(blocks(spark, sf_dir))).select("document_id", "order_index", "level")


@query("h05_order", f"WITH {LEVELS} SELECT document_id, order_index, pos FROM leveled")
def h05_order(spark, sf_dir):
    return hierarchy.with_positions(hierarchy.with_levels(hierarchy.headings(blocks(spark, sf_dir)))).select("document_id", "order_index", "pos")


@query("h06_page_end", f"WITH {ENDS} SELECT document_id, order_index, page_start, page_end FROM ended")
def h06_page_end(spark, sf_dir):
    return hierarchy.build_sections(blocks(spark, sf_dir)).select("document_id", "order_index", "page_start", "page_end")


LAYOUT_ENDS = ENDS.replace(ONCE, "headers_once AS (SELECT doc_id AS document_id, id, 'section_header' AS block_type, text AS text_content, level AS docling_level, page AS page_number, last_page FROM headers)").replace("FROM once", "FROM headers_once").replace(
    "SELECT document_id, max(page_start) + 20 AS last_page FROM leveled", "SELECT document_id, coalesce(nullif((SELECT any_value(h.last_page) FROM headers h WHERE h.doc_id = document_id), 0), max(page_start) + 20) AS last_page FROM leveled"
)


@query("h06_layout_ends", f"{HEADERS}, {LAYOUT_ENDS} SELECT document_id, order_index, level, page_start, page_end FROM ended")
def h06_layout_ends(spark, sf_dir):
    """Sections from the headers of layout texts: documents that name their page count end with it."""
    heads = materialize(mapping.header_blocks(layouts(spark, sf_dir), "doc_id", "docling_json"))
    tree = hierarchy.build_sections(heads, heads.select("document_id", "last_page").distinct())
    return tree.select("document_id", "order_index", "level", "page_start", "page_end")


@query("h07_paths", f"WITH {PATHS} SELECT document_id, order_index, level, heading_path FROM tree")
def h07_paths(spark, sf_dir):
    return hierarchy.build_sections(blocks(spark, sf_dir)).select("document_id", "order_index", "level", "heading_path")


@query("h15_issues", "SELECT document_id, count(*) FILTER (WHERE page_start = 0) AS without_page, count(*) FILTER (WHERE page_start > page_end) AS reversed, count(*) FILTER (WHERE level > 1 AND page_end - page_start > 200) AS too_wide, count(*) FILTER (WHERE level = 1) = 0 AS no_chapter, count(*) FILTER (WHERE level = 2) = 0 AS no_section FROM sections GROUP BY document_id")
def h15_issues(spark, sf_dir):
    return hierarchy.issues(read_table(spark, sf_dir, "sections"))


@query("h16_summary", "SELECT document_id, level, count(*) AS n_sections, min(CASE WHEN page_start > 0 THEN page_start END) AS first_page, max(page_end) AS last_page FROM sections GROUP BY document_id, level")
def h16_summary(spark, sf_dir):
    return hierarchy.summary(read_table(spark, sf_dir, "sections"))


# --- assignment -------------------------------------------------------------------------------------------------

CHAPTERS = f"""{PATHS}, tops AS (SELECT a.document_id, a.order_index AS chapter, a.pos AS chapter_pos, a.page_start, a.page_end,
      (SELECT arg_min(b.order_index, b.pos) FROM tree b WHERE b.document_id IS NOT DISTINCT FROM a.document_id AND b.level = 1 AND b.order_index > a.order_index) AS next_chapter FROM tree a WHERE a.level = 1)"""
ASSIGNED = f"""{CHAPTERS}, members AS (SELECT s.*, t.chapter, t.chapter_pos FROM tree s JOIN tops t ON s.document_id = t.document_id AND s.order_index >= t.chapter AND (t.next_chapter IS NULL OR s.order_index < t.next_chapter)),
  inside AS (SELECT b.*, t.chapter, t.chapter_pos FROM once b JOIN tops t ON b.document_id = t.document_id AND b.page_number BETWEEN t.page_start AND t.page_end),
  matched AS (SELECT m.document_id, m.chapter, m.order_index, arg_min(b.id, (b.page_number, b.id)) AS header_id FROM members m JOIN inside b ON m.document_id = b.document_id AND m.chapter = b.chapter
      AND b.block_type = 'section_header' AND b.page_number BETWEEN m.page_start - 1 AND m.page_start + 1
      AND (contains({_key('m.heading')}, {_key("coalesce(b.text_content, '')")}) OR contains({_key("coalesce(b.text_content, '')")}, {_key('m.heading')})) GROUP BY ALL),
  bounds AS (SELECT f.document_id, f.chapter, f.header_id, max(f.order_index) AS order_index FROM matched f GROUP BY ALL),
  body AS (SELECT document_id, chapter, chapter_pos, id, page_number FROM inside WHERE coalesce(block_type, '') NOT IN ('page_header', 'page_footer')),
  near AS (SELECT b.*, x.order_index AS near FROM body b ASOF LEFT JOIN bounds x ON b.document_id = x.document_id AND b.chapter = x.chapter AND b.id >= x.header_id),
  fits AS (SELECT n.*, CASE WHEN n.page_number BETWEEN m.page_start AND m.page_end THEN m.order_index END AS fit FROM near n LEFT JOIN members m ON m.document_id = n.document_id AND m.chapter = n.chapter AND m.order_index = n.near),
  covering AS (SELECT f.document_id, f.chapter, f.id, arg_min(m.order_index, (-m.level, -m.page_start, m.order_index)) AS cover FROM fits f JOIN members m ON m.document_id = f.document_id AND m.chapter = f.chapter AND f.page_number BETWEEN m.page_start AND m.page_end WHERE f.fit IS NULL GROUP BY ALL),
  chosen AS (SELECT f.document_id, f.id, f.chapter_pos, coalesce(f.fit, c.cover) AS order_index FROM fits f LEFT JOIN covering c ON c.document_id = f.document_id AND c.chapter = f.chapter AND c.id = f.id),
  assigned AS (SELECT document_id, id, arg_max(order_index, chapter_pos) AS order_index FROM chosen WHERE order_index IS NOT NULL GROUP BY ALL)"""


@query("h09_chapters", f"WITH {CHAPTERS} SELECT document_id, chapter, chapter_pos, page_start, page_end, next_chapter FROM tops")
def h09_chapters(spark, sf_dir):
    return asg.chapters(hierarchy.build_sections(blocks(spark, sf_dir)))


@query("h10_chapter_blocks", f"WITH {ASSIGNED} SELECT document_id, chapter, count(*) AS n_blocks, min(id) AS first_id, max(id) AS last_id FROM inside GROUP BY ALL")
def h10_chapter_blocks(spark, sf_dir):
    rows = blocks(spark, sf_dir).dropDuplicates(["document_id", "id"])
    inside = asg.chapter_blocks(rows, asg.chapters(hierarchy.build_sections(rows)))
    return inside.groupBy("document_id", "chapter").agg(F.count("*").alias("n_blocks"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("h11_header_match", f"WITH {ASSIGNED} SELECT document_id, chapter, order_index, header_id FROM matched")
def h11_header_match(spark, sf_dir):
    rows = blocks(spark, sf_dir).dropDuplicates(["document_id", "id"])
    sections = materialize(hierarchy.build_sections(rows))
    tops = asg.chapters(sections)
    return asg.header_matches(asg.chapter_sections(sections, tops), asg.chapter_blocks(rows, tops))


@query("h12_assign", f"WITH {ASSIGNED} SELECT document_id, id, order_index FROM assigned")
def h12_assign(spark, sf_dir):
    rows = blocks(spark, sf_dir)
    return asg.assign(rows, materialize(hierarchy.build_sections(rows)))


# --- chunking ---------------------------------------------------------------------------------------------------

UNITS = f"""{ASSIGNED}, bodies AS (SELECT a.document_id, a.order_index, coalesce(string_agg(c.value, chr(10) || chr(10) ORDER BY c.page_number, c.id) FILTER (WHERE c.value <> ''), '') AS body
      FROM assigned a JOIN (SELECT *, {CLEAN} AS value FROM once) c ON c.document_id = a.document_id AND c.id = a.id GROUP BY ALL),
  scopes AS (SELECT * FROM (SELECT document_id, order_index AS scope, level, lead(order_index) OVER (PARTITION BY document_id ORDER BY order_index) AS until FROM tree WHERE level <= 2) WHERE level = 2),
  units AS (SELECT * FROM (SELECT s.document_id, s.scope, t.order_index, CASE WHEN t.order_index = s.scope THEN b.body WHEN b.body = '' THEN repeat('#', least(t.level, 6)) || ' ' || t.heading
        ELSE repeat('#', least(t.level, 6)) || ' ' || t.heading || chr(10) || chr(10) || b.body END AS content
      FROM scopes s JOIN tree t ON t.document_id = s.document_id AND t.order_index >= s.scope AND (s.until IS NULL OR t.order_index < s.until)
      JOIN bodies b ON b.document_id = t.document_id AND b.order_index = t.order_index) WHERE content <> '')"""


def _units(spark, sf_dir):
    rows = blocks(spark, sf_dir)
    sections = materialize(hierarchy.build_sections(rows))
    return sections, asg.assign(rows, sections), rows


@query("c01_level2", f"WITH {PATHS} SELECT document_id, order_index, heading FROM tree WHERE level = 2")
def c01_level2(spark, sf_dir):
    return hierarchy.build_sections(blocks(spark, sf_dir)).filter("level = 2").select("document_id", "order_index", "heading")


@query("c02_units", f"WITH {UNITS} SELECT document_id, scope, order_index, content FROM units")
def c02_units(spark, sf_dir):
    return chunking.units(*_units(spark, sf_dir))


@query("c03_unchunked", f"WITH {UNITS} SELECT a.document_id, count(*) AS n_blocks FROM assigned a WHERE NOT EXISTS (SELECT 1 FROM scopes s WHERE s.document_id = a.document_id AND a.order_index >= s.scope AND (s.until IS NULL OR a.order_index < s.until)) GROUP BY ALL")
def c03_unchunked(spark, sf_dir):
    sections, assigned, _ = _units(spark, sf_dir)
    return chunking.unchunked_blocks(sections, assigned)


@query(
    "c05_split",
    f"""WITH c AS (SELECT DISTINCT id, content FROM parent_chunks), l AS (SELECT id, max({sql_tokens('x')}) AS longest FROM (SELECT id, unnest(string_split(content, chr(10))) AS x FROM c) GROUP BY id)
    SELECT id, {sql_tokens('content')} AS n_tokens, true AS within_limit, {sql_tokens('content')} > 300 AND longest <= 300 AS must_split, CASE WHEN {sql_tokens('content')} > 300 AND longest <= 300 THEN true END AS was_split FROM c LEFT JOIN l USING (id)""",
)
def c05_split(spark, sf_dir):
    """Of all pieces of a chunk cut to 300: their tokens, none of which is lost; whether each is within the limit or one line; and, where no line is longer, that it was cut."""
    from quire.functions.tokens import words

    rows = read_table(spark, sf_dir, "parent_chunks").select("id", "content").distinct()
    longest = F.array_max(F.transform(F.split("content", "\n"), words))
    must = (words(F.col("content")) > 300) & (longest <= 300)
    pieces = rows.select("id", must.alias("must_split"), F.explode_outer(chunking.split_unit(F.col("content"), 300)).alias("p"))
    n = F.coalesce(words(F.col("p.content")), F.lit(0))
    fits = (n <= 300) | ~F.coalesce(F.col("p.content"), F.lit("")).contains("\n")
    return pieces.groupBy("id").agg(
        F.sum(n).cast("bigint").alias("n_tokens"), F.bool_and(fits).alias("within_limit"), F.any_value("must_split").alias("must_split"), F.any_value(F.when(F.col("must_split"), F.lit(True))).alias("m"), F.count("*").alias("n")
    ).select("id", "n_tokens", "within_limit", "must_split", F.when(F.col("m"), F.col("n") > 1).alias("was_split"))


@query(
    "c06_pack",
    f"""
    WITH RECURSIVE u AS (SELECT section_id, row_number() OVER (PARTITION BY section_id ORDER BY id) AS n, {sql_tokens('content')} AS t FROM (SELECT DISTINCT id, section_id, content FROM parent_chunks WHERE content IS NOT NULL AND section_id IS NOT NULL)),
    walk AS (
        SELECT section_id, n, t, 0 AS chunk, t AS held, t >= 1500 AS closed FROM u WHERE n = 1
        UNION ALL
        SELECT u.section_id, u.n, u.t, w.chunk + CASE WHEN w.closed OR w.held + u.t > 2000 THEN 1 ELSE 0 END,
               CASE WHEN w.closed OR w.held + u.t > 2000 THEN u.t ELSE w.held + u.t END,
               CASE WHEN w.closed OR w.held + u.t > 2000 THEN u.t ELSE w.held + u.t END >= 1500
        FROM walk w JOIN u ON u.section_id = w.section_id AND u.n = w.n + 1)
    SELECT section_id, chunk::INTEGER AS order_index, sum(t)::INTEGER AS token_count FROM walk GROUP BY section_id, chunk
    """,
)
def c06_pack(spark, sf_dir):
    """The stored chunks of every section as units, packed."""
    from quire.functions.tokens import words

    rows = read_table(spark, sf_dir, "parent_chunks").select("id", "section_id", "content").distinct().filter("content IS NOT NULL AND section_id IS NOT NULL")
    unit = F.struct("content", words(F.col("content")).cast("int").alias("tokens"))
    ordered = rows.groupBy("section_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("id", unit.alias("u")))), lambda x: x["u"]).alias("parts"))
    chunks = ordered.select("section_id", F.posexplode(chunking.pack_units(F.col("parts"), 1500, 2000)).alias("order_index", "c"))
    return chunks.select("section_id", "order_index", F.col("c.tokens").alias("token_count"))


@query("c08_chunks")
def c08_chunks(spark, sf_dir):
    """Blocks to parent chunks, the whole way."""
    return chunking.parent_chunks(blocks(spark, sf_dir))


@query(
    "c10_children",
    f"""WITH c AS (SELECT DISTINCT id, content FROM parent_chunks WHERE {sql_tokens('content')} > 0)
    SELECT id AS parent_id, {sql_tokens('content')} AS n_tokens, true AS within_limit, {sql_tokens('content')} <= 231 AS one_child, true AS in_order FROM c""",
)
def c10_children(spark, sf_dir):
    """Of the children of a chunk: their tokens, whether each is within the limit or one sentence, that small chunks have one, and that they are numbered from 0."""
    rows = read_table(spark, sf_dir, "parent_chunks").select("id", "content").distinct()
    kids = chunking.child_chunks(rows, "id", "content")
    alone = ~F.col("content").rlike(r"(?s)[.!?]\s+\S") & ~F.col("content").contains("\n\n")
    rows = kids.groupBy("parent_id").agg(F.sum("token_count").cast("bigint").alias("n_tokens"), F.bool_and((F.col("token_count") <= 512) | alone).alias("within_limit"), F.count("*").alias("n"), F.max("chunk_index").alias("last"))
    # a chunk of fewer tokens than the target is one child, and only such a chunk
    return rows.select("parent_id", "n_tokens", "within_limit", ((F.col("n") == 1) & (F.col("n_tokens") <= 231)).alias("one_child"), (F.col("last") == F.col("n") - 1).alias("in_order"))
