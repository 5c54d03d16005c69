"""Language by compression: held-out accuracy, labels and paragraphs."""

import pytest

from quire.llm import language
from tests.conftest import DATA

DOCS = "doc_id bigint, text string, lang string, label string, segment_no int"


@pytest.fixture(scope="module")
def halves(spark):
    rows = spark.read.parquet(f"{DATA}/lang_samples.parquet")
    return language.fit(rows.filter("sample_id % 2 = 0"), "lang", "text", "sample_id"), rows.filter("sample_id % 2 = 1").collect()


def test_held_out_accuracy(halves):
    samples, held = halves
    classify = language.Classifier(samples)
    right = sum(classify(language.normal(r["text"]))[0] == r["lang"] for r in held)
    assert right / len(held) >= 0.98
    bare = sum(classify(language.normal(r["text"].upper()))[0] == r["lang"] for r in held)
    assert bare / len(held) >= 0.98


def test_labels():
    for label, code in {"EN": "en", "en-GB": "en", "en_UG": "en", "Français": "fr", "fre": "fr", "pt-BR": "pt", "Kiswahili": "sw", "Deutsch": "de", "": None, None: None, "--": None, "n/a": "n/a", "zu": "zu", "und": "und"}.items():
        assert language.label_language(label) == code, label


def test_paragraphs():
    assert language.paragraphs("a\nb\r\n \t\r\nc\n\n\n\nd\n") == ["a\nb", "c", "d"]
    assert language.paragraphs(" \n\n") == []


def test_segments(spark, halves):
    samples, held = halves
    by = {}
    for r in held:
        by.setdefault(r["lang"], []).append(r["text"])
    english, french = by["en"][:3], by["fr"][0]
    rows = [
        (1, "\n\n".join([*english, french]), "fr", "x", 1),
        (2, "\r\n\r\n".join(by["sw"][:2]), "Swahili", "x", 1),
        (3, by["de"][0], None, "x", 1),
        (4, None, "en", "x", 1),
        (5, "", "en", "x", 1),
        (6, "123 - 456\n\n!!", "en", "x", 1),
        (7, by["es"][0] * 3000, "es-MX", "x", 1),
        (2, "\r\n\r\n".join(by["sw"][:2]), "Swahili", "x", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    segments = language.segments(df, "doc_id", "text", "lang", samples)
    assert {r["doc_id"] for r in segments.filter("segment_no = 0").collect()} == {1, 2, 3, 5, 6, 7}
    assert {(r["doc_id"], r["segment_no"], r["confidence"]) for r in segments.filter("lang IS NULL").collect()} == {(5, 0, 0.0), (6, 0, 0.0)}
    assert {(r["doc_id"], r["segment_no"], r["lang"]) for r in language.mislabelled(segments).collect()} == {(1, 0, "en"), (1, 4, "fr"), (3, 0, "de")}
    assert all(0 < r["confidence"] <= 1 for r in segments.filter("lang IS NOT NULL").collect())


def test_narrow_margins_are_rejected(spark, halves):
    samples, _ = halves
    df = spark.createDataFrame([(1, "zzz qqq", "en", "x", 1)], DOCS)
    rows = language.segments(df, "doc_id", "text", "lang", samples, min_margin=0.9).collect()
    assert [(r["segment_no"], r["lang"], r["n_words"]) for r in rows] == [(1, None, 2), (0, None, 2)] and all(0 <= r["confidence"] < 0.9 for r in rows)
    assert language.mislabelled(language.segments(df, "doc_id", "text", "lang", samples, min_margin=0.9)).count() == 0


def test_whole_text_decides_where_its_paragraphs_are_too_short(spark, halves):
    samples, held = halves
    text = next(r["text"] for r in held if r["lang"] == "de")
    short = "\n\n".join(text.split()[:60])
    df = spark.createDataFrame([("k", short, "de")], "key string, text string, lang string")
    rows = language.segments(df, "key", "text", "lang", samples, min_margin=0.12).collect()
    assert [(r["doc_id"], r["lang"]) for r in rows if r["segment_no"] == 0] == [("k", "de")]


def test_sample_bounds(spark):
    rows = spark.createDataFrame([(i, "en", "some words here") for i in range(50)] + [(99, None, "x"), (98, "fr", None)], "i int, lang string, text string")
    fitted = language.fit(rows, "lang", "text", "i", sample_rows=2)
    assert fitted == {"en": "some words here some words here"}
    assert len(language.fit(rows, "lang", "text", "i", sample_bytes=10)["en"]) == 10
    greek = language.fit(rows.limit(1).selectExpr("i", "lang", "'αβγδε' AS text"), "lang", "text", "i", sample_bytes=5)
    assert greek == {"en": "αβ"}


def test_nothing(spark, halves):
    assert language.segments(spark.createDataFrame([], DOCS), "doc_id", "text", "lang", halves[0]).count() == 0
    rows = language.segments(spark.createDataFrame([(1, "some words", "en", "x", 1)], DOCS), "doc_id", "text", "lang", {}).collect()
    assert [(r["segment_no"], r["lang"], r["confidence"]) for r in rows] == [(1, None, 0.0), (0, None, 0.0)]
