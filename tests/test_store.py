"""Registration, constraints, cascades, reports, retrieval and tables."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from quire.config import Settings
from quire.errors import RegistrationError, SchemaError
from quire.operators import export, qa, registration, relations, retrieval, statistics, store, tables

SECTIONS = "id bigint, document_id string, level int, heading string, heading_path string, order_index int, page_start int, page_end int"


def tree(spark):
    rows = [(1, "d", 1, "A", "A", 0, 1, 9), (2, "d", 2, "B", "A > B", 1, 2, 2), (3, "d", 2, "C", "A > C", 2, 3, 4), (4, "d", 3, "E", "A > C > E", 3, 4, 4), (5, "x", 2, "B", "A > B", 1, 1, 1)]
    return spark.createDataFrame(rows, SECTIONS)


def test_files(spark, tmp_path):
    for name, data in (("a.pdf", b"Hello, World!"), ("b.pdf", b""), ("c.pdf", b"X" * 100_000)):
        (tmp_path / name).write_bytes(data)
    got = {r["path"].rsplit("/", 1)[1]: r["checksum_sha256"] for r in registration.scan_files(spark, str(tmp_path)).collect()}
    assert got == {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in ("a.pdf", "c.pdf")}


def test_register_is_idempotent(spark):
    incoming = spark.createDataFrame([("h1", 1, "x"), ("h1", 2, "y"), ("h2", 3, "z"), (None, 4, "w")], "checksum_sha256 string, n int, title string")
    first = registration.register(incoming, incoming.limit(0), "n")
    assert sorted(map(tuple, first.collect())) == [("h1", 1, "x"), ("h2", 3, "z")]
    assert registration.register(incoming, first, "n").count() == 0


def test_sole_and_require(spark):
    one = spark.createDataFrame([("a",)], "id string")
    assert registration.sole_document(one, "id") == "a" and registration.sole_document(one.union(one), "id") is None
    assert registration.require(one, "id", "a").count() == 1
    with pytest.raises(RegistrationError):
        registration.require(one, "id", "b")


def test_stem(spark):
    df = spark.createDataFrame([("/x/y/a.b.pdf",), ("plain",), (".hidden",)], "p string")
    assert [r[0] for r in df.select(registration.stem(F.col("p"))).collect()] == ["a.b", "plain", ".hidden"]


def test_navigation(spark):
    s = tree(spark)
    assert sorted(map(tuple, relations.descendants(s).collect())) == [(1, 2, 1), (1, 3, 1), (1, 4, 2), (3, 4, 1)]
    assert sorted(map(tuple, relations.parents(s).collect())) == [(2, 1), (3, 1), (4, 3)]
    assert sorted(map(tuple, relations.siblings(s, 1).collect())) == [(2, 3), (3, 2)]
    blocks = spark.createDataFrame([(2,), (2,), (4,), (None,)], "section_id bigint")
    assert sorted(map(tuple, relations.children(s, blocks).collect())) == [(1, 2, 2), (1, 3, 0), (3, 4, 1)]


def test_paths_with_pattern_characters(spark):
    rows = [(1, "d", 1, "100%", "100%", 0, 1, 1), (2, "d", 2, "a_b", "100% > a_b", 1, 1, 1), (3, "d", 1, "100x", "100x", 2, 1, 1), (4, "d", 2, "y", "100x > y", 3, 1, 1)]
    assert sorted(map(tuple, relations.descendants(spark.createDataFrame(rows, SECTIONS)).collect())) == [(1, 2, 1), (3, 4, 1)]


def test_rejects(spark):
    good, bad = store.split_rejects(spark.createDataFrame([(1, 5, "a"), (2, 0, "a"), (3, None, ""), (4, 1, None)], "id bigint, token_count int, content string"), "parent_chunks")
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["id"]: r["broken"] for r in bad.collect()} == {2: ["tokens"], 3: ["tokens", "content"], 4: ["content"]}


def test_schemas_and_append(spark, tmp_path):
    store.create_all(spark, str(tmp_path))
    empty = spark.read.parquet(f"{tmp_path}/sections.parquet")
    store.validate(empty, "sections")
    with pytest.raises(SchemaError):
        store.validate(empty.drop("level"), "sections")
    assert store.missing_columns(empty.drop("level"), "sections") == ["level"]
    rows = spark.createDataFrame([(1, "m", 3, None, None)], store.SCHEMAS["embedding_metadata"])
    assert store.append_new(spark, rows, str(tmp_path), "embedding_metadata", "model_name") == 1
    assert store.append_new(spark, rows, str(tmp_path), "embedding_metadata", "model_name") == 0


def test_cascade(spark):
    docs = spark.createDataFrame([("d",), ("x",)], "id string")
    blocks = spark.createDataFrame([(1, "d", 2), (2, "x", 5), (3, "x", None)], "id bigint, document_id string, section_id bigint")
    chunks = spark.createDataFrame([(1, 2), (2, 5)], "id bigint, section_id bigint")
    held = {"documents": docs, "sections": tree(spark), "raw_blocks": blocks, "parent_chunks": chunks}
    left = {k: v.count() for k, v in store.delete_document(held, docs.filter("id = 'd'")).items()}
    assert left == {"documents": 1, "sections": 1, "raw_blocks": 2, "parent_chunks": 1}
    unset = store.delete_sections(held, tree(spark).filter("id = 2").select("id"))
    assert {r["id"]: r["section_id"] for r in unset["raw_blocks"].collect()} == {1: None, 2: 5, 3: None}


def test_statistics_of_nothing(spark):
    none = spark.createDataFrame([], "id bigint, section_id bigint, token_count int")
    assert statistics.token_stats(none).first()["n"] == 0
    assert statistics.histogram(none).count() == 0
    assert statistics.coverage(tree(spark), none).first()["with_chunks"] == 0


def test_pages(spark):
    df = spark.createDataFrame([("a", 2), ("a", 5), ("a", 4), ("b", 0), ("b", 3)], "document_id string, page_number int")
    assert {r[0]: r["n_pages"] for r in statistics.page_span(df).collect()} == {"a": 4, "b": 0}
    assert [tuple(r) for r in statistics.missing_pages(df).collect()] == [("a", 3)]


def test_export(spark, tmp_path):
    lines = export.tree_lines(tree(spark).filter("document_id = 'd'"))
    export.write_text(lines, "line", ["order_index"], str(tmp_path / "tree"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "tree")).collect()] == ["- A (pages 1-9)", "  - B (page 2)", "  - C (pages 3-4)", "    - E (page 4)"]
    a, b = tree(spark), tree(spark).orderBy(F.desc("id"))
    assert export.manifest({"s": a}).collect() == export.manifest({"s": b}).collect()
    export.write_partitioned(a, "document_id", str(tmp_path / "parts"))
    assert spark.read.parquet(str(tmp_path / "parts")).count() == 5


def test_knn_like_brute_force(spark):
    rng = __import__("random").Random(3)
    vectors = [(i, [float(rng.randint(0, 3)) for _ in range(4)]) for i in range(60)]
    v = spark.createDataFrame([*vectors, (99, None)], "chunk_id bigint, embedding array<float>")
    q = v.select(F.col("chunk_id").alias("query_id"), "embedding").filter("chunk_id % 10 = 0 OR chunk_id = 99")
    got = {}
    for r in retrieval.knn(q, v, 5, block=2).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["chunk_id"], round(r["distance"], 6)))
    for query, own in [x for x in vectors if x[0] % 10 == 0]:
        best = sorted((round(math.dist(own, w), 6), i) for i, w in vectors)[:5]
        assert sorted(got[query]) == [(k, i, d) for k, (d, i) in enumerate(best, 1)]
    assert 99 not in got
    nearest = retrieval.knn(q, v, 5)
    parents = v.select("chunk_id", (F.col("chunk_id") % 3).alias("parent_id"))
    assert retrieval.expand_parents(nearest, parents).agg(F.sum("n_chunks")).first()[0] == 30
    assert retrieval.knn(q.limit(0), v, 5).count() == 0


def test_distance(spark):
    df = spark.createDataFrame([([0.0, 3.0], [4.0, 0.0])], "a array<float>, b array<float>")
    assert df.select(retrieval.l2(F.col("a"), F.col("b"))).first()[0] == 5.0


def test_embed_tries_again(spark):
    def client(texts, failed=[]):  # noqa: B006
        if not failed:
            failed.append(1)
            raise OSError
        return [[float(len(t))] for t in texts]

    df = spark.createDataFrame([(1, "abc"), (2, ""), (3, None), (4, "x")], "id bigint, t string").coalesce(1)
    got = retrieval.embed(df, "id", "t", client, Settings(embed_batch=1, first_backoff=0.0)).collect()
    assert sorted((r[0], r[1]) for r in got) == [(1, [3.0]), (4, [1.0])]


def test_tables(spark):
    md = "| Drug | Dose |\n| --- | --- |\n| A | 1 |\n| B | |\ntext\n| C | 3 | 4 |"
    rows = tables.linearize(spark.createDataFrame([(1, md), (2, "no table"), (3, None), (4, "| only |")], "id int, m string"), "id", "m").orderBy("row_no").collect()
    assert [r["text"] for r in rows] == ["Drug: A; Dose: 1", "Drug: B", "Drug: C; Dose: 3; : 4"]
    assert not rows[0]["is_large"] and rows[0]["n_rows"] == 3


def test_review_sample(spark):
    chunks = spark.range(2000).select("id", F.lit(2).cast("bigint").alias("section_id")).unionByName(spark.createDataFrame([(9000, 7)], "id bigint, section_id bigint"))
    sections = tree(spark).select("id", "heading_path").unionByName(spark.createDataFrame([(7, "Vaccination")], "id bigint, heading_path string"))
    reasons = {r[0]: r[1] for r in qa.review_sample(chunks, sections).groupBy("reason").count().collect()}
    assert reasons["always"] == 1 and 320 < reasons["sample"] < 480


def test_update_json(spark):
    docs = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3")], "id string, docling_json string")
    updates = spark.createDataFrame([("a", None), ("b", "2")], "id string, docling_json string")
    assert sorted(map(tuple, store.update_json(docs, updates).collect())) == [("a", None), ("b", "2"), ("c", "3")]
    with pytest.raises(SchemaError):
        store.update_json(docs, spark.createDataFrame([("z", "2")], "id string, docling_json string"))


def test_chapters_required(spark):
    from quire.errors import SegmentationError
    from quire.operators import hierarchy

    assert hierarchy.require_chapters(tree(spark).filter("document_id = 'd'")).count() == 4
    with pytest.raises(SegmentationError, match="x"):
        hierarchy.require_chapters(tree(spark))


def test_stores_and_parser_outputs(spark, tmp_path):
    store.create_all(spark, str(tmp_path / "a_rag.db"))
    (row,) = store.list_stores(spark, str(tmp_path)).collect()
    assert row["store"] == "a_rag.db" and row["n_documents"] == 0 and row["n_bytes"] > 0
    docs = spark.createDataFrame([("d1", "# x", "{}"), ("d2", None, "[]")], "n string, m string, j string")
    export.write_parser_outputs(docs, "n", "m", "j", str(tmp_path / "out"))
    assert [tuple(r) for r in spark.read.text(str(tmp_path / "out" / "markdown")).collect()] == [("# x", "d1")]
    assert spark.read.text(str(tmp_path / "out" / "json")).count() == 2


def test_insert_drop_and_info(spark, tmp_path):
    folder = str(tmp_path / "s")
    store.create_all(spark, folder)
    chunks = spark.createDataFrame([(1, 1, "text", 3), (2, 1, "", 3), (3, 1, "x", 0)], "id bigint, section_id bigint, content string, token_count int")
    assert store.insert(chunks, folder, "parent_chunks") == (1, 2)
    for bad in (chunks.filter("id > 1"), chunks.limit(0)):
        with pytest.raises(SchemaError):
            store.insert(bad, folder, "parent_chunks")
    info = {r["column_name"]: (r["data_type"], r["expected"]) for r in store.schema_info({"sections": spark.createDataFrame([(1, "x")], "id bigint, more string")}).collect()}
    assert info["id"] == ("bigint", True) and info["more"] == ("string", False) and info["level"] == (None, True)
    assert store.drop_all(spark, folder) == list(store.SCHEMAS) and store.drop_all(spark, folder) == []


def test_models_are_registered_once(spark):
    from quire.operators.registration import register_models

    rows = spark.createDataFrame([("a", 3, "1"), ("b", 4, "2"), ("b", 3, "9"), (None, 1, "1")], "model_name string, dimension int, docling_version string")
    have = spark.createDataFrame([("a",)], "model_name string")
    assert [tuple(r) for r in register_models(rows, have).collect()] == [("b", 3, "9")]


def test_nearest_with_many_equal_vectors(spark):
    """A third of the vectors are one and the same; ties go to the smaller id, across batches and tasks."""
    import numpy as np

    from quire.operators.retrieval import knn

    rng = np.random.default_rng(2)
    v = [[0.5, 0.5] if i % 3 == 0 else [float(x) for x in rng.random(2)] for i in range(6000)]
    vectors = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "chunk_id bigint, embedding array<float>").repartition(3)
    q = [(0, [0.5, 0.5]), (1, [0.1, 0.9]), (2, [0.5, 0.52])]
    got = {}
    for r in knn(spark.createDataFrame(q, "query_id bigint, embedding array<float>"), vectors, 7, block=2).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["chunk_id"]))
    a = np.array(v, dtype=np.float32).astype(float)
    for i, x in q:
        d = np.sqrt(((a - np.array(x, dtype=np.float32).astype(float)) ** 2).sum(1))
        assert [c for _, c in sorted(got[i])] == np.lexsort((np.arange(len(v)), d))[:7].tolist()


def test_once(spark):
    from quire.plans.materialize import once

    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "d"), (None, None)]
    got = once(spark.createDataFrame(rows, "id int, t string"), "id")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(set(rows), key=str)
    assert once(got.limit(0), "id").count() == 0


def test_may_be_in(spark):
    from quire.plans.materialize import may_be_in

    keys = spark.range(0, 30_000, 3).select(F.xxhash64("id").alias("k"))
    rows = spark.range(30_000).select("id", F.xxhash64("id").alias("k"))
    for most_bits in (16, 28):
        got = {r["id"] for r in rows.filter(may_be_in("k", keys, most_bits)).collect()}
        assert set(range(0, 30_000, 3)) <= got and len(got) < (30_000 if most_bits == 16 else 13_000)
    assert rows.filter(may_be_in("k", keys.limit(0))).count() == 0
