"""Queries of the training-data operators, by problem, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import collapse, decontaminate, language, mixing, ocr, packing, splitting
from quire.plans.registry import SQL_WS


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that the splitter had to cut."""
    pieces = splitting.split_oversized(splitting.oversized_items(spark, sf_dir), ["item_table", "item_id"], "body", 2000, 100)
    return pieces.filter("piece_no = 1 AND n_pieces > 1").select("item_table", "item_id").distinct()


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_oversized(splitting.oversized_items(spark, sf_dir), ["item_table", "item_id"], "body", 2000, 100)


def p1_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every cut item put together again from its pieces without their repeated parts, and whether the pieces keep within their size."""
    piece = F.struct("piece_no", F.substring("piece", F.col("overlap_chars").cast("int") + 1, F.length("piece")).alias("fresh"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["fresh"]), "")  # pieces of one text
    rows = p1_pieces(spark, sf_dir).groupBy("item_table", "item_id", "n_pieces")
    return rows.agg(F.md5(whole).alias("digest"), ((F.max("n_tokens") <= 2000) & (F.count("*") == F.col("n_pieces"))).alias("within_limit")).drop("n_pieces")


def p2_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens placed of every chunk, and whether it is whole: in one container, in one piece."""
    packed = packing.chunks_packed(spark, sf_dir)
    whole = (F.count("*") == 1) & (F.max("piece_no") == 0)
    return packed.groupBy(F.col("item_id").alias("id")).agg(F.sum("n_tokens").cast("bigint").alias("n_tokens"), whole.alias("whole"))


def p2_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: the room that all chunks need at least, tokens placed, the fullest container within the capacity, at most 2 % more containers than needed."""
    r = packing.fill_report(packing.chunks_packed(spark, sf_dir))
    return r.select("least_possible", "n_tokens", (F.col("fullest") <= 2000).alias("within_capacity"), (F.col("n_containers") <= F.col("least_possible") * 1.02 + 1).alias("well_filled"))


def p2_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(packing.chunks_packed(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_pieces": p1_pieces,
        "p1_joined": p1_joined,
        "p2_pack": packing.chunks_packed,
        "p2_placed": p2_placed,
        "p2_containers": p2_containers,
        "p2_fill": p2_fill,
        "p3_found": ocr.block_damage,
        "p3_repaired": ocr.passages_repaired,
        "p5_found": collapse.block_copies,
        "p5_passages": collapse.block_passages,
        "p7_found": decontaminate.document_leaks,
        "p7_cleaned": decontaminate.documents_without_leaks,
        "p7_spans": lambda spark, sf_dir: decontaminate.documents_without_leaks(spark, sf_dir).select("doc_id", "n_spans"),
        "p8_mix": mixing.document_mix,
        "p8_shares": mixing.document_mix_shares,
        "p8_full_shares": mixing.document_full_shares,
        "p8_exact_shares": mixing.document_exact_shares,
        "p9_found": language.documents_found,
        "p9_segments": language.document_segments,
        "p9_parts": lambda spark, sf_dir: language.document_segments(spark, sf_dir).select("doc_id", "segment_no"),
    }


def _tokens(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{SQL_WS}]+'))"


#: Items of both tables, each once.
ITEMS = "items AS (SELECT DISTINCT 'parent_chunks' AS item_table, id AS item_id, content AS body FROM parent_chunks UNION SELECT DISTINCT 'raw_blocks', id, markdown_content FROM raw_blocks)"


def _records(min_alnum: int) -> str:
    """id and canonical form of every block by regular expressions without look-around: . , / : between digits are set aside first."""
    kept = {".": "\\x{1}", ",": "\\x{2}", "/": "\\x{3}", ":": "\\x{4}"}

    def leaf(x: str) -> str:
        for _ in range(2):  # neighbours share a digit
            for c, code in enumerate(kept, 1):
                x = f"regexp_replace({x}, '(\\p{{Nd}})[{code}](\\p{{Nd}})', '\\1' || chr({c}) || '\\2', 'g')"
        return f"lower(regexp_replace({x}, '[{SQL_WS}\\x{{200b}}\\x{{feff}}\\x{{ad}}]|\\p{{P}}', '', 'g'))"

    split = "regexp_split_to_array(text_content, '[;|\\n\\r\\x{0b}\\x{0c}\\x{85}\\x{2028}\\x{2029}]')"
    fields = f"list_sort(list_filter(list_transform({split}, lambda x: {leaf('x')}), lambda y: y <> ''))"
    canon = f"CASE WHEN block_type = 'key_value_item' THEN 'f' || array_to_string({fields}, chr(5)) ELSE 't' || {leaf('text_content')} END"
    enough = f"AND len(regexp_extract_all(text_content, '[\\p{{L}}\\p{{Nd}}]')) >= {min_alnum}" if min_alnum else ""
    return f"records AS (SELECT DISTINCT id, text_content, {canon} AS canon FROM raw_blocks WHERE text_content IS NOT NULL {enough})"


#: Windows of 13 words of documents and items; the words by the accents that SQL can strip, which are those of these texts.
WINDOWS = """words AS (SELECT 'd' AS side, doc_id AS k, regexp_extract_all(lower(strip_accents(text)), '[\\p{L}\\p{Nd}]+') AS w FROM documents UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(strip_accents(text)), '[\\p{L}\\p{Nd}]+') FROM eval_items),
    places AS (SELECT side, k, w, unnest(range(len(w) - 12)) AS i FROM words WHERE len(w) > 12), windows AS (SELECT side, k, i, array_to_string(w[i + 1 : i + 13], ' ') AS g FROM places),
    hits AS (SELECT DISTINCT d.k AS doc_id, e.k AS item_id, d.i FROM windows d JOIN windows e ON d.g = e.g WHERE d.side = 'd' AND e.side = 'i')"""


CHUNKS = f"SELECT DISTINCT id, content, {_tokens('content')} AS n_tokens FROM parent_chunks WHERE content IS NOT NULL"


def oracle_sql() -> dict[str, str]:
    return {
        "p9_parts": f"""WITH a AS (SELECT doc_id, regexp_split_to_array(text, '\\r?\\n') AS a FROM documents WHERE text IS NOT NULL), l AS (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS i FROM a),
            g AS (SELECT *, count(*) FILTER (WHERE NOT regexp_matches(line, '[^{SQL_WS}]')) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM l),
            p AS (SELECT doc_id, run, bool_or(regexp_matches(line, '\\p{{L}}')) AS letters FROM g WHERE regexp_matches(line, '[^{SQL_WS}]') GROUP BY doc_id, run),
            n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY run) AS segment_no, letters FROM p) SELECT doc_id, segment_no FROM n WHERE letters UNION ALL SELECT doc_id, 0 FROM a""",
        "p7_found": f"WITH {WINDOWS} SELECT DISTINCT doc_id, item_id FROM hits",
        "p7_spans": f"""WITH {WINDOWS}, steps AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM (SELECT DISTINCT doc_id, i FROM hits)),
            spans AS (SELECT doc_id, count(*) FILTER (WHERE before IS NULL OR i - before > 12) AS n FROM steps GROUP BY doc_id) SELECT d.doc_id, coalesce(n, 0)::INTEGER AS n_spans FROM documents d LEFT JOIN spans s USING (doc_id)""",
        "p1_found": f"WITH {ITEMS} SELECT item_table, item_id FROM items WHERE {_tokens('body')} > 2000",
        "p1_joined": f"WITH {ITEMS} SELECT item_table, item_id, md5(body) AS digest, true AS within_limit FROM items WHERE {_tokens('body')} > 2000",
        "p2_placed": f"SELECT id, sum(n_tokens)::BIGINT AS n_tokens, count(*) = 1 AND max(n_tokens) <= 2000 AS whole FROM ({CHUNKS}) GROUP BY id",
        "p2_containers": f"SELECT ceil(sum(n_tokens) / 2000)::BIGINT AS least_possible, sum(n_tokens)::BIGINT AS n_tokens, true AS within_capacity, true AS well_filled FROM ({CHUNKS})",
        "p5_found": f"WITH {_records(50)}, k AS (SELECT DISTINCT id, canon FROM records), c AS (SELECT canon, min(id) AS first_id FROM k GROUP BY canon) SELECT c.first_id, k.id AS copy_id FROM k JOIN c ON k.canon = c.canon WHERE k.id > c.first_id",
        "p5_passages": f"WITH {_records(0)} SELECT min(id) AS first_id, count(DISTINCT id) AS n_items, arg_min(text_content, (id, text_content)) AS passage FROM records GROUP BY canon",
    }
