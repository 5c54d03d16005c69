"""Section trees, assignment and chunking against sequential models."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.config import ChunkSettings, Settings
from quire.errors import ChunkingError, ConfigurationError
from quire.functions.tokens import words
from quire.operators import assign, chunking, hierarchy

BLOCKS = "id bigint, document_id string, block_type string, text_content string, markdown_content string, page_number int, docling_level int"


def model(heads):
    """(order_index, level, page_start, page_end, path) by one pass per rule over (i, heading, native, page)."""
    last, rows = 1, []
    for i, heading, native, page in heads:
        low = heading.lower()
        number = 1 if re.match(r"annex\b", low) else None
        m = re.match(r"(\d+(?:\.\d+)*)", heading)
        if number is None and m:
            number = min(5, m.group(1).count(".") + 1)
        if number:
            level = last = number
        elif "contents" in low:
            level = last = 1
        elif re.match(r"step\s+\d+[:.]|[a-z]\)", low):
            level = min(last + 1, 5)
        elif native and native > 0 and not (native == 1 and last >= 2):
            level = last = native
        else:
            level = min(last + 1, 5)
        rows.append([i, level, page or 0, None, heading])
    rows.sort(key=lambda r: (r[2], r[0]))
    end = max((r[2] for r in rows), default=0) + 20
    path = {}
    for k, r in enumerate(rows):
        following = next((x for x in rows[k + 1 :] if x[1] <= r[1]), None)
        r[3] = max(r[2], following[2] - 1) if following else end
        path = {k: v for k, v in path.items() if k < r[1]} | {r[1]: r[4]}
        r[4] = " > ".join(path[k] for k in sorted(path))
    return sorted(map(tuple, rows))


def test_tree_like_model(spark):
    rng, rows, expected, n = random.Random(5), [], {}, 0
    names = ["1 A", "1.1 B", "1.2.3 C", "Annex 1", "Contents", "Step 2: x", "a) y", "Fever", "Signs", "2023 report", "3.1 D", " "]
    for d in range(60):
        heads = []
        for i in range(rng.randint(1, 14)):
            h, native, page = rng.choice(names), rng.choice([None, 1, 1, 2, 3, 7]), rng.choice([None, 0, 1, 2, 3, 5, 9])
            n += 1
            rows.append((n, f"d{d}", "section_header", h, None, page, native))
            if h.strip():
                heads.append((i, h, native, page))
        expected[f"d{d}"] = model(heads)
    rows.append(rows[0])  # a repeated row
    tree = hierarchy.build_sections(spark.createDataFrame(rows, BLOCKS)).collect()
    got = {}
    for r in tree:
        got.setdefault(r["document_id"], []).append((r["order_index"], r["level"], r["page_start"], r["page_end"], r["heading_path"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in expected.items() if v}


def test_no_headings(spark):
    assert hierarchy.build_sections(spark.createDataFrame([], BLOCKS)).count() == 0


def test_assign_most_specific(spark):
    sections = spark.createDataFrame([("d", 0, 1, 1, "1 A", 10, 30), ("d", 1, 2, 2, "1.1 B", 15, 20), ("d", 2, 3, 3, "1.1.1 C", 16, 17)], "document_id string, order_index int, pos int, level int, heading string, page_start int, page_end int")
    blocks = spark.createDataFrame([(1, "d", "text", "x", None, 16, None), (2, "d", "page_header", "h", None, 16, None), (3, "d", "text", "y", None, 25, None), (4, "d", "text", "z", None, 99, None)], BLOCKS)
    got = {r["id"]: r["order_index"] for r in assign.assign(blocks, sections).collect()}
    assert got == {1: 2, 3: 0}


def test_assign_by_header(spark):
    sections = spark.createDataFrame([("d", 0, 1, 1, "1 A", 1, 9), ("d", 1, 2, 2, "1.1 B", 2, 3), ("d", 2, 3, 2, "1.2 C", 2, 9)], "document_id string, order_index int, pos int, level int, heading string, page_start int, page_end int")
    rows = [(10, "d", "section_header", "1 A", None, 1, 1), (20, "d", "section_header", "1.1  B", None, 2, 2), (21, "d", "text", "in b", None, 2, None), (30, "d", "section_header", "1.2 c", None, 2, 2), (31, "d", "text", "in c", None, 3, None), (5, "d", "text", "before", None, 1, None)]
    got = {r["id"]: r["order_index"] for r in assign.assign(spark.createDataFrame(rows, BLOCKS), sections).collect()}
    assert got == {10: 0, 5: 0, 20: 1, 21: 1, 30: 2, 31: 2}


def pack_model(units, target, limit):
    out, held, n = [], [], 0
    for text, t in units:
        if n + t > limit and held:
            out.append(("\n\n".join(held), n))
            held, n = [], 0
        held.append(text)
        n += t
        if n >= target:
            out.append(("\n\n".join(held), n))
            held, n = [], 0
    return [*out, ("\n\n".join(held), n)] if held else out


def test_pack_like_model(spark):
    rng = random.Random(1)
    cases = [[(f"u{i}", rng.choice([1, 7, 10, 14, 15, 20, 25])) for i in range(rng.randint(0, 9))] for _ in range(200)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, parts array<struct<content:string,tokens:int>>")
    for i, chunks in df.select("i", chunking.pack_units(F.col("parts"), 15, 20)).collect():
        assert [tuple(c) for c in chunks] == pack_model(cases[i], 15, 20)


def split_model(content, limit):
    count, out, held, n = lambda t: len(t.split()), [], [], 0
    for p in re.split(r"\n\n+", content):
        p = p.strip()
        if not p:
            continue
        if count(p) > limit:
            if held:
                out.append("\n\n".join(held))
                held, n = [], 0
            lines, m = [], 0
            for line in p.split("\n"):
                if m + count(line) > limit and lines:
                    out.append("\n".join(lines))
                    lines, m = [], 0
                lines.append(line)
                m += count(line)
            out.append("\n".join(lines))
            continue
        if n + count(p) > limit and held:
            out.append("\n\n".join(held))
            held, n = [], 0
        held.append(p)
        n += count(p)
    return [*out, "\n\n".join(held)] if held else out


def test_split_like_model(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a ", "b ", "c\n", "\n\n", "d\n\n\n"]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for i, parts in df.select("i", chunking.split_unit(F.col("t"), 6)).collect():
        assert [p["content"] for p in parts] == split_model(texts[i], 6)


def test_whole_way(spark):
    rows = [(1, "d", "section_header", "1 A", None, 1, 1), (2, "d", "section_header", "1.1 B", None, 1, 2), (3, "d", "text", "own text", None, 1, None), (4, "d", "section_header", "1.1.1 C", None, 2, 3), (5, "d", "page_footer", "9", None, 2, None), (6, "d", "text", "deep", None, 2, None)]
    (chunk,) = chunking.parent_chunks(spark.createDataFrame(rows, BLOCKS)).collect()
    assert chunk["content"] == "1.1 B\n\nown text\n\n### 1.1.1 C\n\n1.1.1 C\n\ndeep"
    assert chunk["heading_path"] == "1 A > 1.1 B" and chunk["token_count"] == len(chunk["content"].split())


def test_children_cover(spark):
    text = " ".join(f"Word {i} ends here." for i in range(900))
    kids = chunking.child_chunks(spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string"), "id", "t").collect()
    assert {k["parent_id"] for k in kids} == {1} and max(k["token_count"] for k in kids) <= 512
    assert " ".join(" ".join(k["content"].split()) for k in sorted(kids, key=lambda k: k["chunk_index"])) == text


def test_guard_and_settings(spark):
    with pytest.raises(ChunkingError):
        chunking.guard_overwrite(spark.range(1), overwrite=False)
    chunking.guard_overwrite(spark.range(1), overwrite=True)
    assert ChunkSettings().child_range == (231, 281) and ChunkSettings().parent_range == (1000, 1500)
    with pytest.raises(ConfigurationError):
        ChunkSettings(parent_target=3000)
    with pytest.raises(ConfigurationError):
        Settings(embedding_dimension=0)


def test_words_counts_null(spark):
    assert spark.range(1).select(words(F.lit(None).cast("string"))).first()[0] == 0


def test_known_page_counts_end_a_document(spark):
    rows = [(1, "a", "section_header", "1 A", None, 2, None), (2, "a", "section_header", "2 B", None, 5, None), (3, "b", "section_header", "1 A", None, 2, None), (4, "c", "section_header", "1 A", None, 3, None)]
    counts = spark.createDataFrame([("a", 40), ("b", 0)], "document_id string, last_page int")
    got = {(r["document_id"], r["order_index"]): r["page_end"] for r in hierarchy.build_sections(spark.createDataFrame(rows, BLOCKS), counts).collect()}
    assert got == {("a", 0): 4, ("a", 1): 40, ("b", 0): 22, ("c", 0): 23}


def test_wild_page_numbers_cost_nothing(spark):
    rows = [(1, "d", "section_header", "1 A", None, 1, None), (2, "d", "text", "x", None, 2_000_000_000, None), (3, "d", "section_header", "1.1 B", None, 2, None), (4, "d", "text", "y", None, 2, None), (5, "d", "section_header", "2 C", None, 2_000_000_001, None)]
    df = spark.createDataFrame(rows, BLOCKS)
    got = {r["id"]: r["order_index"] for r in assign.assign(df, hierarchy.build_sections(df)).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1, 5: 2}


def test_preset_headers_win(spark):
    rows = [(1, "d", "section_header", "1 A", None, 1, None), (2, "d", "text", "x", None, 1, None), (3, "d", "section_header", "1.1 B", None, 1, None), (4, "d", "text", "y", None, 1, None)]
    df = spark.createDataFrame(rows, BLOCKS)
    sections = hierarchy.build_sections(df)
    assert {r["id"]: r["order_index"] for r in assign.assign(df, sections).collect()} == {1: 0, 2: 0, 3: 1, 4: 1}
    named = sections.withColumn("named", F.when(F.col("order_index") == 1, F.lit(2).cast("bigint")))
    assert {r["id"]: r["order_index"] for r in assign.assign(df, named, F.col("named")).collect()} == {1: 0, 2: 1, 3: 1, 4: 1}


def test_strict_chunking_refuses_equal_paths(spark):
    heads = [("1 A", 1), ("1.1 B", 1), ("1.1 B", 2)]
    rows = [(i, "d", "section_header", h, None, page, None) for i, (h, page) in enumerate(heads)] + [(10, "d", "text", "some words", None, 1, None)]
    df = spark.createDataFrame(rows, BLOCKS)
    assert [tuple(r) for r in chunking.duplicate_paths(hierarchy.build_sections(df)).collect()] == [("d", "1 A > 1.1 B", 2)]
    assert chunking.parent_chunks(df).count() >= 1
    with pytest.raises(ChunkingError, match="1.1 B"):
        chunking.parent_chunks(df, strict=True)


def test_two_small_chunks_never_end_a_section(spark):
    """The merge of a small last chunk with a small one before it can't occur: a chunk is closed at the target, or before a unit that would pass the limit."""
    rng = random.Random(8)
    rows = [(i, [("w " * n, n) for n in (rng.randint(1, 2000) for _ in range(rng.randint(1, 12)))]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, parts array<struct<content:string,tokens:int>>")
    for r in df.select("parts", chunking.pack_units(F.col("parts"), 1500, 2000).alias("c")).collect():
        sizes = [c["tokens"] for c in r["c"]]
        assert sum(sizes) == sum(p["tokens"] for p in r["parts"]) and max(sizes) <= 2000
        assert len(sizes) < 2 or sizes[-1] + sizes[-2] > 2000 or sizes[-2] >= 1500
