"""The layout source, the parser interface and the streaming front door."""

import hashlib

import pytest

from quire.sources.layout import Parser, ParseResult, enable
from quire.streaming.registration import register_stream

TABLE = "checksum_sha256 string, id string, n int"


def test_layout_source(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(f'{{"n": {i}}}')
    (tmp_path / "other.txt").write_text("x")
    enable(spark)
    got = {r["file_name"]: r for r in spark.read.format("layout_json").option("filesPerTask", "2").load(str(tmp_path)).collect()}
    assert set(got) == {f"{i}.json" for i in range(5)}
    assert got["3.json"]["checksum_sha256"] == hashlib.sha256(b'{"n": 3}').hexdigest() and got["3.json"]["docling_json"] == '{"n": 3}'


def test_parse_result():
    ParseResult({}, "", 1, "1.0")
    with pytest.raises(ValueError, match="page"):
        ParseResult({}, "", 0, "1.0")
    with pytest.raises(ValueError, match="version"):
        ParseResult({}, "", 1, " ")
    with pytest.raises(TypeError):
        Parser()


def test_stream_registers_once(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "documents"
    frame = lambda rows: spark.createDataFrame(rows, TABLE)
    frame([("h0", "old", 0)]).write.parquet(str(table))
    frame([("h0", "again", 1), ("h1", "a", 2), ("h1", "b", 3)]).write.parquet(str(source))
    for k in (1, 2):
        stream = spark.readStream.schema(TABLE).parquet(str(source))
        query = register_stream(stream, str(table), "n", str(tmp_path / f"checkpoint{k}"))
        query.awaitTermination(120)
        assert query.exception() is None
        assert sorted(map(tuple, spark.read.parquet(str(table)).collect())) == [("h0", "old", 0), ("h1", "a", 2)]


def test_layouts_by_file_source_and_uri(spark, tmp_path):
    from quire.sources.layout import read_layouts

    (tmp_path / "a.json").write_text('{"é": 1}')
    (tmp_path / "b.txt").write_text("x")
    enable(spark)
    frames = [read_layouts(spark, str(tmp_path)), spark.read.format("layout_json").load(tmp_path.as_uri())]
    digest = hashlib.sha256('{"é": 1}'.encode()).hexdigest()
    assert [[tuple(r) for r in f.collect()] for f in frames] == [[("a.json", digest, '{"é": 1}')]] * 2


def test_a_cluster_without_checkpoint_folder_is_refused(monkeypatch):
    from types import SimpleNamespace

    from quire.errors import ConfigurationError
    from quire.plans.materialize import ensure_checkpoint_dir

    unset = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getConf=lambda: unset, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ConfigurationError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=unset))
