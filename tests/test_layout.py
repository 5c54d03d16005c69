"""Nested records and drifting schemas on planted cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quire.functions.jsontext import OPEN, RETRACT, _decode_deep, read_json, triples
from quire.operators import drift, nested

DOCS = "doc_id bigint, j string, fields string, child_path string"


def brute(value, place="", parent=""):
    """(parent, child) of every object that is an element of an array."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from brute(v, f"{place}/{k.replace('~', '~0').replace('/', '~1')}", parent)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            at = f"{place}/{i}"
            if isinstance(v, dict):
                yield parent, at
                yield from brute(v, at, at)
            else:
                yield from brute(v, at, parent)


def grow(rng, depth=0):
    kind = rng.random()
    if depth > 4 or kind < 0.3:
        return rng.choice([1, 2.5, "x", True, None, "", "é"])
    if kind < 0.65:
        return {rng.choice("abcd~/."): grow(rng, depth + 1) for _ in range(rng.randint(0, 4))}
    return [grow(rng, depth + 1) for _ in range(rng.randint(0, 4))]


def rows(values):
    return [(i, v, "clash", "clash") for i, v in enumerate(values)]


def test_nested_like_brute_force(spark):
    rng = random.Random(4)
    values = [grow(rng) for _ in range(400)]
    df = spark.createDataFrame(rows([json.dumps(v) for v in values]), DOCS)
    got = {}
    for r in nested.flatten(df, "doc_id", "j").filter("child_path <> ''").collect():
        got.setdefault(r["doc_id"], []).append((r["parent_path"], r["child_path"]))
    for i, v in enumerate(values):
        assert sorted(got.get(i, [])) == sorted(brute(v)), v


def test_fields_come_back(spark):
    doc = {"title": "t", "page": {"w": 1}, "texts": [{"id": "a", "prov": [{"n": 1, "box": [1, 2]}]}, {}, "loose", {"id": None, "deep": {"x": True}}]}
    df = spark.createDataFrame(rows([json.dumps(doc)]), DOCS)
    got = {r["child_path"]: (r["table_path"], r["parent_path"], r["ordinal"], r["fields"]) for r in nested.flatten(df, "doc_id", "j").collect()}
    assert got == {
        "": ("", None, None, {"title": "t", "page.w": "1", "texts[2]": "loose"}),
        "/texts/0": ("texts[]", "", 0, {"id": "a"}),
        "/texts/0/prov/0": ("texts[].prov[]", "/texts/0", 0, {"n": "1", "box": "[1, 2]"}),
        "/texts/1": ("texts[]", "", 1, {}),
        "/texts/3": ("texts[]", "", 3, {"id": None, "deep.x": "true"}),
    }
    nodes = nested.flatten(df, "doc_id", "j")
    assert {r["child_path"]: r["kinds"] for r in nodes.collect()} == {"": "sis", "/texts/0": "s", "/texts/0/prov/0": "ia", "/texts/1": "", "/texts/3": "0b"}
    typed = nested.table(nodes, "texts[].prov[]", {"n": "int", "box": "string", "none": "double"}).first()
    assert (typed["parent_path"], typed["n"], typed["none"]) == ("/texts/0", 1, None)
    assert {tuple(r) for r in nested.table_fields(nodes).filter("table_path = 'texts[]'").collect()} == {("texts[]", "id", "s", 1), ("texts[]", "id", "0", 1), ("texts[]", "deep.x", "b", 1)}
    tables = nested.flat_tables(nodes)
    assert set(tables) == {"", "texts[]", "texts[].prov[]"}
    assert dict(tables["texts[].prov[]"].dtypes) == {"doc_id": "bigint", "child_path": "string", "parent_path": "string", "ordinal": "int", "n": "bigint", "box": "string", "rest": "map<string,string>"}
    assert [(r["id"], r["deep_x"], r["rest"]) for r in tables["texts[]"].orderBy("ordinal").collect()] == [("a", None, {}), (None, None, {}), (None, True, {})]
    assert nested.links(tables).count() == 4


def test_columns_of_flat_tables(spark):
    docs = [{"a": [{"x": 1, "X": "u", "doc_id": 5, "y.z": 1.5, "y": {"z": 2}, f"rare {i}": i} for i in range(3)]}, {"a": [{"x": 2.5, "doc_id": "s"}]}]
    nodes = nested.flatten(spark.createDataFrame(rows([json.dumps(d) for d in docs]), DOCS), "doc_id", "j")
    t = nested.flat_tables(nodes, least=0.5)["a[]"]
    types = dict(t.dtypes)
    assert types == {"doc_id": "bigint", "child_path": "string", "parent_path": "string", "ordinal": "int", "X": "string", "doc_id_2": "string", "x_2": "double", "y_z": "double", "y_z_": "bigint", "rest": "map<string,string>"}
    assert {(r["doc_id"], r["child_path"]): (r["X"], r["x_2"], r["doc_id_2"], r["y_z"], r["y_z_"], r["rest"]) for r in t.collect()} == {
        **{(0, f"/a/{i}"): ("u", 1.0, "5", 1.5, 2, {f"rare {i}": f"{i}"}) for i in range(3)}, (1, "/a/0"): (None, 2.5, "s", None, None, {}),
    }


def test_streamed_triples():
    out = list(triples('{"a": {"k": [1, {"v": [2, [3, {"w": null}]]}, "s"]}, "b": {}, "c": []}'))
    assert [t for t in out if t[4] == OPEN] == [("", "", "", None, OPEN, None), ("a.k[]", "/a/k/1", "", 1, OPEN, ""), ("a.k[].v[][]", "/a/k/1/v/1/1", "", 1, OPEN, "/a/k/1")]
    assert [t[1:] for t in out if t[4] != OPEN] == [
        ("", "a.k[0]", 0, "i", "1"), ("/a/k/1", "v[0]", 0, "i", "2"), ("/a/k/1", "v[1][0]", 0, "i", "3"), ("/a/k/1/v/1/1", "w", None, "0", None), ("", "a.k[2]", 2, "s", "s"), ("", "b", None, "o", "{}"), ("", "c", None, "a", "[]"),
    ]


def test_repeated_keys_and_lone_surrogates(spark):
    values = ['{"a": [{"x": 1}, {}], "b": 1, "a": [{"y": "\\ud800z"}], "b": {"c": 2}, "b": 3}', '["\\ud83d\\ude00", "\\ud83d"]']
    df = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(values)], "key string, j string")
    got = {(r["doc_id"], r["child_path"]): r["fields"] for r in nested.flatten(df, "key", "j").collect()}
    assert got == {("k0", ""): {"b": "3"}, ("k0", "/a/0"): {"y": "\ufffdz"}, ("k1", ""): {"[]": values[1]}}


@pytest.mark.parametrize("seed", range(4))
def test_stream_agrees_with_the_tree(seed):
    rng = random.Random(seed)
    for _ in range(500):
        text = json.dumps(grow(rng), indent=rng.choice([None, 1]))
        cut = rng.randint(0, len(text))
        for whole in (text, json.dumps(text), text[:cut], text[:cut] + rng.choice('[]{},:"0\\ ') + text[cut + rng.randint(0, 1) :]):
            tree = read_json(whole)
            try:
                found = list(triples(whole))
            except ValueError:
                assert tree is None, whole
            else:
                assert tree is not None, whole
                if not any(t[4] == RETRACT for t in found):
                    assert sorted((t[5], t[1]) for t in found if t[4] == OPEN and t[1]) == sorted(brute(tree))


def test_texts_that_are_not_json(spark):
    values = [None, "", "x", '{"a": [{}', '{"a": NaN}', "3", '"text"', json.dumps(json.dumps([{"a": 1}])), "[" * 5000]
    got = [r["doc_id"] for r in nested.flatten(spark.createDataFrame(rows(values), DOCS), "doc_id", "j").collect()]
    assert got == [7, 7]  # the list and its object
    assert nested.flatten(spark.createDataFrame([], DOCS), "doc_id", "j").count() == 0
    assert read_json("null") is None


def test_records_of_any_depth(spark):
    deep = '{"a":' * 50_000 + "1" + "}" * 50_000
    whole = '{"texts": [{"text": "x", "deep": ' + deep + '}, {"text": "y"}]}'
    rng = random.Random(5)
    for _ in range(300):
        value = grow(rng)
        text = json.dumps(value, indent=rng.choice([None, 1]))
        assert _decode_deep(text) == value
        cut = text[: rng.randint(0, len(text) - 1)] + rng.choice(["", "]", "}", ",", " x"])
        try:
            expected = json.loads(cut)
        except ValueError:
            with pytest.raises(ValueError):
                _decode_deep(cut)
        else:
            assert _decode_deep(cut) == expected
    df = spark.createDataFrame(rows([whole, whole[:-1], json.dumps(whole)]), DOCS)
    got = sorted((r["doc_id"], r["child_path"]) for r in nested.flatten(df, "doc_id", "j").select("doc_id", "child_path").collect())
    assert got == [(i, path) for i in (0, 2) for path in ("", "/texts/0", "/texts/1")]


def release(version, n, build):
    rng = random.Random(version)
    return [(i, version, json.dumps(build(rng, i)), None) for i in range(n)]


def planted():
    word = lambda rng: rng.choice(["fever", "cough", "pain"]) + " lasted " + str(rng.randint(1, 90)) + " days in the ward"

    def one(rng, i):
        return {"elements": [{"key": f"{i}-{k}", "page": rng.randint(1, 9), "body": word(rng), "gone": rng.random(), "box": [1.5, 2.5]} for k in range(3)], "seconds": rng.random() * 50}

    def two(rng, i):
        return {"elements": [{"key": f"{i}-{k}", "page_no": rng.randint(1, 9), "body": word(rng), "box": {"l": 1.5}, "fresh": {"a": 1}} for k in range(3)], "seconds": None if i % 2 else 3.5}

    def ten(rng, i):
        return {"elements": [{"key": f"{i}-{k}", "page_no": str(rng.randint(1, 9)), "body": word(rng), "box": {"l": 1.5}, "fresh": {"a": 1}} for k in range(3)], "seconds": 1}

    return release("1.2.0", 40, one) + release("1.10.0", 40, two) + release("1.9.0", 40, two) + release("2.0", 40, ten)


CHANGES = {
    ("1.9.0", "renamed", "elements[].page", "elements[].page_no"),
    ("1.9.0", "removed", "elements[].gone", ""),
    ("1.9.0", "retyped", "elements[].box", "elements[].box"),
    ("1.9.0", "added", "", "elements[].fresh"),
    ("2.0", "retyped", "elements[].page_no", "elements[].page_no"),
}


def test_changes(spark):
    df = spark.createDataFrame([*planted(), (1, "2.0", "{", None), (2, None, "{}", None), (3, "2.0", None, None)], "doc_id bigint, v string, j string, path string")
    cat = drift.catalogue(df, "v", "j")
    assert {tuple(r) for r in drift.changes(cat).collect()} == CHANGES
    spans = {(r["path"], r["kind"]): (r["first"], r["last"]) for r in drift.lifespans(cat).collect()}
    assert spans["elements[].page", "number"] == ("1.2.0", "1.2.0") and spans["elements[].page_no", "number"] == ("1.9.0", "1.10.0")


def test_profiles_count_all_values(spark):
    doc = {"a": [{"x": i % 3, "t": "b" * 70 + "-1" * (i % 2)} for i in range(300)]}
    cat = drift.catalogue(spark.createDataFrame([("1", json.dumps(doc))], "v string, j string"), "v", "j")
    got = {(r["path"], r["feature"]): r["n"] for r in cat.filter("feature IS NOT NULL").collect()}
    assert [got["a[].x", f"i{i}"] for i in range(3)] == [100] * 3 and got["a", "kx"] == got["a[]", "kx"] == 300
    assert got["a[].t", "a~7"] == 150 and got["a[].t", "-9a~7"] == 150


def test_no_releases(spark):
    df = spark.createDataFrame([], "v string, j string")
    assert drift.changes(drift.catalogue(df, "v", "j")).count() == 0


def test_alias_chains(spark):
    log = spark.createDataFrame([("10", "renamed", "b[].x", "b[].y"), ("2", "renamed", "a", "b"), ("3", "added", "", "x"), ("11", "renamed", "b", "a"), ("11", "renamed", "c", "b")], "parser_version string, change string, old_path string, new_path string")
    aliases = drift.alias_table(log)
    assert aliases == [("2", "a", "b"), ("10", "b[].x", "b[].y"), ("11", "b", "a"), ("11", "c", "b")]
    releases = ["1", "2", "10", "11"]
    # names come back and pass from one field to another, so each release is read by the renamings after it
    assert [drift.canonical(p, r, releases, aliases) for p, r in (("a[].x", "1"), ("b[].x", "2"), ("b[].x", "10"), ("c", "10"), ("a", "11"), ("ab", "1"), ("a", None), ("a", "zz"))] == ["a[].y", "a[].y", "a[].x", "b", "a", "ab", "a", "a"]


def drifting():
    """Documents of four releases whose elements hold the same things under other names and shapes."""
    out = []
    for i in range(40):
        text = {"element_id": f"e{i}", "prov": [{"page": i, "bbox": [1.5, 2, 3, 4]}, {"page": i + 1, "bbox": [5, 6, 7, 8]}], "text": f"words of text {i}", "level": 2, "caption": f"a picture of thing {i}"}
        new = {"id": f"e{i}", "prov": [{"page_no": i, "bbox": {"l": 1.5, "t": 2, "r": 3, "b": 4}}, {"page_no": i + 1, "bbox": {"l": 5, "t": 6, "r": 7, "b": 8}}], "text": f"words of text {i}", "level": "2", "caption": {"lang": "en", "text": f"a picture of thing {i}"}}
        out += [("0.9", {"elements": [text]}), ("1.10", {"texts": [new], "groups": [{"children": [{"ref": f"#/{i}"}]}]})]
    return [(n, v, json.dumps(d), "x") for n, (v, d) in enumerate(out)]


def test_casts_follow_from_the_catalogue(spark):
    odd = [(900, None, json.dumps({"texts": [{"id": "late", "prov": [{"page_no": 1}], "never seen": {"a": [1, {"b": 2}]}}]}), "x"), (901, "1.10", "{", "x"), (902, "1.10", None, "x")]
    df = spark.createDataFrame([*drifting(), *odd], "doc_id bigint, v string, j string, release string")
    table = drift.element_table(df, "doc_id", "v", "j", least=0.05)
    types = dict(table.dtypes)
    assert {c: types[c] for c in ("id", "text", "level", "caption_lang", "caption_text")} == dict.fromkeys(("id", "text", "level", "caption_lang", "caption_text"), "string") and "element_id" not in types
    assert types["prov"] == "array<struct<at:string,page_no:bigint,bbox_l:double,bbox_t:bigint,bbox_r:bigint,bbox_b:bigint,rest:map<string,string>>>" and types["children"].startswith("array<struct<at:string,ref:string")
    rows = {(r["doc_id"], r["array"]): r for r in table.collect()}
    assert len(rows) == 40 * 3 + 1
    for i in range(40):
        old, new = rows[2 * i, "texts"], rows[2 * i + 1, "texts"]
        assert [old[c] for c in ("id", "text", "level", "caption_text")] == [new[c] for c in ("id", "text", "level", "caption_text")] == [f"e{i}", f"words of text {i}", "2", f"a picture of thing {i}"]
        assert old["prov"] == new["prov"] and [(p["at"], p["page_no"], p["bbox_l"], p["bbox_b"]) for p in old["prov"]] == [("prov/0", i, 1.5, 4), ("prov/1", i + 1, 5.0, 8)]
        assert old["rest"] == new["rest"] == {} and old["others"] == []
    late = rows[900, "texts"]
    assert (late["id"], late["prov"][0]["page_no"], late["rest"]) == ("late", 1, {"never seen.a[0]": "1"})
    assert [(o["path"], o["at"], o["fields"]) for o in late["others"]] == [("never seen.a[]", "never seen/a/1", {"b": "2"})]


def test_every_layout_gives_its_elements(spark):
    docs = [
        {"texts": [{"text": "a"}], "groups": [{"label": "list", "name": "g", "children": [{"ref": "#/texts/0"}]}], "form_items": [{"text": "f"}], "pages": [{"page_no": 1}]},
        {"elements": [{"text": "b"}, "no element", {"text": "b2"}]},
        {"body": [{"text": "c"}]},
        {"body": {"elements": [{"text": "d"}]}},
        {"pages": [{"elements": [{"text": "e"}]}, {}, {"elements": [{"text": "f"}]}]},
        [{"text": "g"}, {"text": "h"}],
        {"groups": [{"text": "i"}]},
    ]
    df = spark.createDataFrame([(f"k{i}", "1", json.dumps(d)) for i, d in enumerate(docs)], "key string, v string, j string")
    got = drift.element_table(df, "key", "v", "j").collect()
    assert sorted((r["doc_id"], r["array"], r["ordinal"], r["text"] or r["name"]) for r in got) == [
        ("k0", "form_items", 0, "f"), ("k0", "groups", 0, "g"), ("k0", "texts", 0, "a"), ("k1", "elements", 0, "b"), ("k1", "elements", 2, "b2"), ("k2", "body", 0, "c"), ("k3", "body.elements", 0, "d"),
        ("k4", "pages[].elements", 0, "e"), ("k4", "pages[].elements", 0, "f"), ("k5", "[]", 0, "g"), ("k5", "[]", 1, "h"), ("k6", "groups", 0, "i"),
    ]
    assert drift.element_table(df.limit(0), "key", "v", "j").count() == 0


def test_nothing_is_lost(spark):
    """Every scalar of every element is in a column, in rest or in others, whatever its name means in other releases."""
    rng = random.Random(9)
    names = ["a", "b", "c", "a.b"]

    def scalar():
        return rng.choice([lambda: rng.randint(10**6, 10**9) + 0.5, lambda: f"s{rng.random()}", lambda: rng.random()])()

    def build(depth=0):
        out = {}
        for n in rng.sample(names, rng.randint(1, 4)):
            kind = rng.random()
            out[n] = scalar() if kind < 0.5 or depth > 2 else build(depth + 1) if kind < 0.7 else [build(depth + 1) for _ in range(rng.randint(1, 2))] if kind < 0.9 else [scalar() for _ in range(2)]
        return out

    def scalars(v):
        return [x for y in (v.values() if isinstance(v, dict) else v) for x in scalars(y)] if isinstance(v, (dict, list)) else [str(v)]

    docs = [(i, str(i % 3), {"texts": [build()], "tables": [build()]}) for i in range(60)]
    df = spark.createDataFrame([(i, v, json.dumps(d)) for i, v, d in docs], "doc_id bigint, v string, j string")
    for least in (0.0, 0.3):
        held = {}
        for r in drift.element_table(df, "doc_id", "v", "j", least).collect():
            held[r["doc_id"]] = held.get(r["doc_id"], "") + json.dumps(r.asDict(recursive=True))
        for i, _, d in docs:
            for x in scalars(d):
                assert x in held[i], (least, i, x, json.dumps(d), held[i])


def test_release_order(spark):
    df = spark.createDataFrame([("2.10.0",), ("2.3.1",), ("0.9.2",), ("2.3",)], "r string")
    assert [r[0] for r in df.orderBy(drift.release_order(F.col("r"))).collect()] == ["0.9.2", "2.3", "2.3.1", "2.10.0"]
