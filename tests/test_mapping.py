"""Layout elements, case by case."""

import json

import pytest
from pyspark.sql import functions as F

from quire.operators import mapping


def value(spark, element, f):
    df = spark.createDataFrame([(json.dumps(element),)], "j string")
    return df.select(f(F.parse_json("j"))).first()[0]


CASES = [
    ({"prov": [{"page_no": 42}]}, mapping.page_no, 42),
    ({"prov": [{"page": 15}]}, mapping.page_no, 15),
    ({"page_no": 99}, mapping.page_no, 99),
    ({"prov": []}, mapping.page_no, None),
    ({"prov": [{"page_no": None, "page": 3}], "page_no": 4}, mapping.page_no, None),
    ({"prov": [{"page_no": p} for p in (12, 13, 14)]}, mapping.page_range, "12-14"),
    ({"prov": [{"page": p} for p in (10, 15, 12)]}, mapping.page_range, "10-15"),
    ({"prov": [{"page_no": 5}]}, mapping.page_range, None),
    ({"prov": [{"page_no": 5}, {"page_no": 5}]}, mapping.page_range, None),
    ({"text": " ", "orig": "Original"}, mapping.text_content, "Original"),
    ({"text": "38.5°C ± 0.5°C, 100μg"}, mapping.text_content, "38.5°C ± 0.5°C, 100μg"),
    ({"text": "   "}, mapping.text_content, None),
    ({"label": "Table", "text": "cells"}, mapping.text_content, None),
    ({"type": "paragraph", "label": "x"}, mapping.block_type, "paragraph"),
    ({"label": "x", "type": ""}, mapping.block_type, "x"),
    ({}, mapping.block_type, "unknown"),
    ({"label": "section_header", "level": 2}, mapping.heading_level, 2),
    ({"label": "section_header", "level": "3"}, mapping.heading_level, 3),
    ({"label": "text", "level": 2}, mapping.heading_level, None),
    ({"bbox": {"l": 1}}, mapping.bbox, '{"l":1}'),
    ({"bbox": None}, mapping.bbox, None),
    ({"id": "a", "element_id": "b"}, mapping.element_id, "a"),
    ({"element_id": "b"}, mapping.element_id, "b"),
    ({"markdown": "  # Heading  "}, mapping.markdown_content, "# Heading"),
    ({"markdown": " "}, mapping.markdown_content, None),
    ({"text": None}, mapping.unreadable, True),
    ({"label": "table", "text": None}, mapping.unreadable, False),
]


@pytest.mark.parametrize("case", CASES, ids=range(len(CASES)))
def test_field(spark, case):
    element, f, expected = case
    assert value(spark, element, f) == expected


def test_metadata_keeps_present_keys(spark):
    assert value(spark, {"type": "text", "name": "p5", "marker": None}, mapping.metadata) == {"docling_type": "text", "docling_label": None, "name": "p5", "marker": None}


def test_layouts(spark):
    e = {"label": "text", "text": "x"}
    docs = [
        {"texts": [e], "tables": [e], "groups": [e], "elements": [e] * 9},
        {"elements": [e, e]},
        {"body": [e]},
        {"body": {"elements": [e, e]}},
        {"pages": [{"elements": [e]}, {"elements": [e, e]}, {}]},
        [e, e],
        {"other": 1},
    ]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(7, json.dumps(json.dumps({"elements": [e]}))), (8, '{"texts": ['), (9, None), (10, "")]
    got = {r[0]: r[1] for r in mapping.elements(spark.createDataFrame(rows, "id int, j string"), "id", "j").groupBy("doc_id").count().collect()}
    assert got == {0: 3, 1: 2, 2: 1, 3: 2, 4: 3, 5: 2, 7: 1}


def test_blocks_and_rejects(spark):
    doc = {"texts": [{"label": "text", "text": "a"}, {"label": "text", "text": None}, {"label": "text", "text": ""}], "tables": [{"label": "table", "markdown": "|x|"}]}
    df = spark.createDataFrame([(1, json.dumps(doc))], "id int, j string")
    assert [(r["pos"], r["text_content"], r["markdown_content"], r["page_number"]) for r in mapping.blocks(df, "id", "j").orderBy("pos").collect()] == [(0, "a", None, 0), (3, None, "|x|", 0)]
    assert tuple(mapping.rejected(df, "id", "j").first()) == (1, 4, 1, 1)
