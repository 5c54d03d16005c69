"""Scan repair on planted damage."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import ocr

PAIRS = [("the patient was seen at the maternity ward", "and given a second dose of medicine"), ("keep the syrup below ten degrees", "and away from strong light"), ("ask the mother about recent fever", "before the treatment is started")]
BLOCKS = "id bigint, document_id string, block_type string, text_content string, page_number int, keys string, kind string"


def clean_rows(n=400):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        a, b = rng.choice(PAIRS)
        rows.append((i, f"d{i % 20}", "text", f"{a} {rng.randint(100, 400)} times\n{b}.", 1, "x", "y"))
    for d in range(20):
        rows.append((5000 + d, f"d{d}", "page_header", f"Village{d} Health Guide 2007", 1, "x", "y"))
    return rows


DAMAGED = [
    (9001, "d1", "text", "the patient was seen at the mater-\nnity ward and given a second dose of medicine.", 1, "x", "y"),
    (9002, "d1", "text", "the patient was seen at the matem¬\nity ward.", 1, "x", "y"),
    (9003, "d1", "text", "ask the mother ab\nout recent fever before the treatment is started.", 1, "x", "y"),
    (9004, "d1", "text", "keep the 5yrup below ten clegrees and away from strong light.", 1, "x", "y"),
    (9005, "d1", "text", "keep the syrup below\nVillage1 Health Guide 2007\nten degrees and away from strong light.", 1, "x", "y"),
    (9006, "d1", "text", "keep the syrup below\n- 17 -\nten degrees and away from strong light.", 1, "x", "y"),
    (9007, "d1", "paragraph", "VILLAGE1 HEALTH GUIDE 2007", 1, "x", "y"),
    (9008, "d1", "list_item", "Page l7", 1, "x", "y"),
    (9009, "d1", "paragraph", "3 | Vlllage1 Health Guide 2007", 1, "x", "y"),
    (9010, "d1", "text", None, 1, "x", "y"),
    (9011, "d1", "text", "", 1, "x", "y"),
    (9012, "d1", "paragraph", "Another Short Title", 1, "x", "y"),
    (9013, "d1", "text", "ask the mother about recent fever 2l7 times before the treatment is started.", 1, "x", "y"),
    (9014, None, "text", "keep the syrup below ten degrees", None, "x", "y"),
]
EXPECTED = {(9001, "hyphen"), (9002, "hyphen"), (9003, "hyphen"), (9004, "misread"), (9005, "inline"), (9006, "inline"), (9007, "furniture"), (9008, "furniture"), (9009, "furniture"), (9013, "misread")}


@pytest.fixture(scope="module")
def blocks(spark):
    return spark.createDataFrame(clean_rows() + DAMAGED + DAMAGED[:3], BLOCKS)


def test_found(blocks):
    got = {tuple(r) for r in ocr.damage(blocks).collect()}
    assert got - {(9002, "misread")} == EXPECTED


def test_lines_like_headers_are_judged(spark):
    lines = [
        (9101, "d1", "text", "14 Days of Feoer\nthe patient was seen at the maternity ward.", 1, "x", "y"),
        (9102, "d1", "text", "the patient was seen at the\n14 Maternity Warcl\nand given a second dose of medicine.", 1, "x", "y"),
        (9103, "d1", "text", "Ask The Mother Ab\nout recent fever before the treatment is started.", 1, "x", "y"),
        (9104, "d1", "text", "the patient was seen at the mater-\nVlllage1 Health Guide 2007\nnity ward.", 1, "x", "y"),
        (9105, "d1", "text", "Keep The Syrup Below\nten degrees and away from strong light.", 1, "x", "y"),
    ]
    got = {tuple(r) for r in ocr.damage(spark.createDataFrame(clean_rows() + lines, BLOCKS)).filter("block_id > 9100").collect()}
    assert got == {(9102, "misread"), (9103, "hyphen"), (9104, "hyphen"), (9104, "inline")}


def test_headers_seen_in_passages(spark):
    a, b = "the patient was seen at the maternity ward", "and given a second dose of medicine."
    c, d = "keep the syrup below ten degrees", "away from strong light."
    texts = {
        "once as a block": [("text", f"{a}\nClinic Manual 2011\n{b}"), ("paragraph", "Clinic Manual 2011")],
        "in passages": [("text", f"{a}\nClinic Manual 2011 4\n{b}"), ("text", f"{c}\nClinic Manual 2011 5\n{d}")],
        "as a heading": [("text", f"{a}\nClinic Manual 2011\n{b}"), ("section_header", "Clinic Manual 2011")],
        "copies": [("text", f"{a}\nClinic Manual 2011\n{b}"), ("text", f"{a}\nCLINIC MANUAL 2011\n{b}")],
        "headings": [("section_header", "Clinic Manual 2011"), ("section_header", "Clinic Manual 2011")],
        "fields": [("key_value_item", "Drug: syrup\nDose: 2.5 mg\nroute: by mouth."), ("key_value_item", "Drug: tablet\nDose: 2.5 mg\nage: adults.")],
    }
    rows = [(9200 + 10 * i + k, doc, kind, text, 1, "x", "y") for i, (doc, blocks) in enumerate(texts.items()) for k, (kind, text) in enumerate(blocks)]
    got = {tuple(r) for r in ocr.damage(spark.createDataFrame(clean_rows() + rows, BLOCKS)).filter("block_id >= 9200 AND kind IN ('inline', 'furniture')").collect()}
    assert got == {(9200, "inline"), (9201, "furniture"), (9210, "inline"), (9211, "inline"), (9220, "inline"), (9221, "furniture")}


def test_repaired(blocks):
    got = {r["block_id"]: r["passage"] for r in ocr.repaired(blocks).filter("block_id > 9000").collect()}
    assert got[9001] == "the patient was seen at the maternity ward and given a second dose of medicine."
    assert got[9003] == "ask the mother about recent fever before the treatment is started."
    assert got[9004] == "keep the syrup below ten degrees and away from strong light."
    assert got[9005] == got[9006] == "keep the syrup below ten degrees and away from strong light."
    assert got[9013] == "ask the mother about recent fever 217 times before the treatment is started."
    assert not {9007, 9008, 9010, 9011} & set(got) and got[9012] == "Another Short Title"


def test_clean_text_stays(blocks):
    got = {r["block_id"]: r["passage"] for r in ocr.repaired(blocks).filter("block_id < 400").collect()}
    for i, _, _, text, *_ in clean_rows()[:400]:
        assert got[i] == " ".join(text.split())


def test_nothing(spark):
    none = spark.createDataFrame([], BLOCKS)
    assert ocr.damage(none).count() == 0 and ocr.repaired(none).count() == 0


def exact(counts, total, numbers=0.0, unit=1.0):
    """A model of given counts by key."""
    import xxhash

    keys = np.array([xxhash.xxh64_intdigest(k) for k in counts], np.uint64)
    return ocr.Model(ocr.table_of(keys, np.array(list(counts.values()), float)) | {"total": total, "numbers": numbers, "unit": unit, "channel": None})


def test_counts_are_exact(spark):
    rng = random.Random(5)
    words = [f"w{rng.randint(0, 3000)}" for _ in range(20_000)]
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)] + ["a b c\nd e f", "a b c"]
    rows = spark.createDataFrame([(t, None) for t in texts], "body string, block_type string")
    model = ocr.Model(ocr.learn(rows))
    held = {w: words.count(w) for w in set(words)}
    assert all(model.word(w) == n for w, n in held.items()) and [model.word(w) for w in "abcdefg"] == [2, 2, 1, 0, 1, 1, 0]
    assert model.pair("a", "b") == 2 and model.pair("c", "d") == 0 and model.total == len(words) + 7
    assert model.count("s" + "w12".translate(ocr.SKELETON)) == sum(n for w, n in held.items() if w.translate(ocr.SKELETON) == "w12".translate(ocr.SKELETON))


def test_table_of_many_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 64, 300_000, np.uint64, endpoint=False))
    table = ocr.table_of(keys, np.arange(len(keys), dtype=float) % 1000)
    assert (np.diff(table["keys"].astype(float)) >= 0).all() and table["starts"][-1] == len(keys)
    first = (table["keys"] >> np.uint64(table["shift"])).astype(int)
    at = np.arange(len(keys))
    assert (table["starts"][first] <= at).all() and (at < table["starts"][first + 1]).all()
    assert exact({}, 0.0).word("x") == 0.0


def test_rare_words_count_as_unseen_at_any_size():
    """Counts and their bound grow together, so the same text is read the same way."""
    counts = {"wward": 900, "wwarcl": 1, "sviarei": 0, "pthe ward": 300, "wthe": 5000}
    counts["s" + "ward".translate(ocr.SKELETON)] = 901
    small = exact(counts, 1e5)
    large = exact({k: n * 1000 for k, n in counts.items() if n * 1000 >= 2000}, 1e8, unit=2000.0)
    for model in (small, large):
        assert model.suspicious("warcl") and model.decode(["the", "warcl"]) == ["the", "ward"] and not model.suspicious("ward")


def test_rows_do_not_depend_on_partitions(blocks):
    found = [{tuple(r) for r in ocr.damage(blocks.repartition(k)).collect()} for k in (1, 4, 64)]
    assert found[0] == found[1] == found[2]


def test_confusions_are_learned(spark):
    clean = [(i, "d", "text", "the cold dinner was sold under the old elder tree near the dusty road and the child said hello", 1, "x", "y") for i in range(400)]
    noisy = [(1000 + i, "d", "text", clean[0][3].replace(*pair, 1), 1, "x", "y") for i, pair in enumerate([("cold", "colcl"), ("road", "roacl"), ("child", "chilcl"), ("old", "olcl")] * 5 + [("elder", "eider")])]
    chances = ocr.learn(ocr.text_blocks(spark.createDataFrame(clean + noisy, BLOCKS)))["channel"]
    by = dict(zip(ocr.ALL_CONFUSIONS, chances, strict=True))
    assert by["cl", "d"] > ocr.P_CONFUSION > by["c", "e"] and max(chances) <= ocr.P_CONFUSION * ocr.FARTHEST


def test_compounds_stay():
    model = exact({"wtwelve-month": 50, "wmonth": 5, "wtwelve": 5, "wtogether": 40, "wto": 900}, 10_000)
    assert model.cut("-", "twelve-", "month") is None
    assert model.cut("-", "to-", "gether") == "together" and model.cut("o", "to", "gether") == "together"
    assert model.cut(".", "to", "gether") is None


def test_cuts_do_not_depend_on_words_judged_before():
    fresh, used = (exact({"wto": 5, "wgether": 5, "wtogether": 90_000, "sto": 5, "sgetiier": 5}, 1_000_000) for _ in range(2))
    assert not used.suspicious("to") and not used.suspicious("gether")
    assert fresh.cut("o", "to", "gether") == used.cut("o", "to", "gether") == "together"


def test_page_numbers():
    for yes in ("3", "- 3 -", "[12]", "Page 4", "Page 4 of 9", "p. 7", "xii", "Page l5"):
        assert ocr.is_page_number(yes), yes
    for no in ("", "so", "mix", "3 mg", "Fever", "4.5", "Dose: 3"):
        assert not ocr.is_page_number(no), no


def test_skeletons_agree():
    for seen, true in ocr.CONFUSIONS:
        assert seen.translate(ocr.SKELETON) == true.translate(ocr.SKELETON), (seen, true)


def test_long_text(spark):
    text = "the patient was seen at the ward\n" * 20_000
    df = spark.createDataFrame([(1, "d", "text", text, 1, "x", "y")], BLOCKS)
    assert ocr.damage(df).count() == 0
    assert ocr.repaired(df).select(F.length("passage")).first()[0] == len(text) - 1
