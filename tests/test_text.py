"""Text functions give what Python's str and re give."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import predicates, text

ODD = "".join(map(chr, (0x20, 0x09, 0x0A, 0x0D, 0x0B, 0x1C, 0x85, 0xA0, 0x2028, 0x3000)))
STRINGS = st.lists(st.text(alphabet=ODD + text.BULLETS + "ab-.|", max_size=24), min_size=1, max_size=40)
ONCE = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_bullets(t):
    for b in text.BULLETS:
        t = re.sub(rf"^(\s*){re.escape(b)}(\s*)", r"\1- ", t, flags=re.MULTILINE)
    return t


def py_lines(t):
    t = re.sub(r"\n{3,}", "\n\n", t)
    t = re.sub(r"[ \t]+$", "", t, flags=re.MULTILINE)
    return t.replace("\r\n", "\n").replace("\r", "\n").strip()


@ONCE
@given(STRINGS)
def test_like_python(spark, strings):
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    c = F.col("s")
    got = df.select("s", text.pystrip(c), text.bullets(c), text.squeeze_lines(c), text.normalize_markdown(c)).collect()
    for s, stripped, bullets, lines, both in got:
        assert (stripped, bullets, lines, both) == (s.strip(), py_bullets(s), py_lines(s), py_lines(py_bullets(s)))


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "s string").select(f(F.col("s"))).first()[0]


def test_bullet_after_bullet(spark):
    assert one(spark, "•\n◦ x", text.bullets) == py_bullets("•\n◦ x")


def test_numbering(spark):
    cases = {"1 X": 1, "1.1 X": 2, "1.1.1.1.1.1 X": 5, "Annex 1": 1, "Terms of Reference": None, "2023 report": 1, "1.5 mg": 2, "Step 2: x": None, "": None}
    for heading, level in cases.items():
        assert one(spark, heading, predicates.numbering_level) == level, heading


def test_subsection(spark):
    for heading, yes in {"Step 2: x": True, "a) x": True, "(b) x": True, "iv) x": True, "a. x": True, "a.1 x": False, "a.": True, "Intro": False}.items():
        assert one(spark, heading, predicates.is_subsection) is yes, heading


def test_front_matter(spark):
    assert one(spark, "Table of Contents", predicates.is_front_matter) and not one(spark, "Fever", predicates.is_front_matter)


def test_clean_block(spark):
    rows = [("page_header", "x", None), ("table", None, " |a| "), ("figure", "cap", None), ("picture", "c" * 200, None), ("text", " ", None), ("text", None, None), (None, "• a  ", "")]
    df = spark.createDataFrame(rows, "t string, x string, m string")
    got = [r[0] for r in df.select(text.clean_block(F.col("t"), F.col("x"), F.col("m"))).collect()]
    assert got == [None, "\n\n[TABLE]\n|a|\n[/TABLE]\n\n", "\n\n[FIGURE: cap]\n\n", "\n\n[FIGURE]\n\n", None, None, "- a"]


def test_sizes(spark):
    df = spark.createDataFrame([(0.0,), (1023.0,), (1536.0,), (3.0 * 1024**3,), (None,)], "n double")
    assert [r[0] for r in df.select(text.human_size(F.col("n"))).collect()] == ["0.0 B", "1023.0 B", "1.5 KB", "3.0 GB", None]


def test_token_counters(spark):
    from quire.functions.tokens import bpe, words

    assert one(spark, " a b c ", words) == 3 and one(spark, None, words) == 0
    assert one(spark, "hello world", bpe("/opt/tokenizers/byte_bpe_50k.tiktoken")) == 2
