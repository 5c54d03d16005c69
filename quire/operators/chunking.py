"""Cleaned sections packed into chunks of bounded size.

Splitting and packing are folds over the ordered units of one section, tens of units at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.config import ChunkSettings
from quire.errors import ChunkingError
from quire.functions.text import PY_WS, clean_block, pystrip
from quire.functions.tokens import TokenCounter, words

UNIT = "struct<content:string,tokens:int>"


def in_scopes(sections: DataFrame) -> DataFrame:
    """Sections that are or lie below a level-2 section, with its order_index as ``scope``.

    A scope ends where the next section of level 1 or 2 begins, so the last such section decides.
    """
    upto = Window.partitionBy("document_id").orderBy("order_index").rowsBetween(Window.unboundedPreceding, 0)
    top = F.last(F.when(F.col("level") <= 2, F.struct("level", "order_index")), ignorenulls=True).over(upto)
    return sections.withColumn("top", top).filter("top.level = 2").withColumn("scope", F.col("top.order_index")).drop("top")


def duplicate_paths(sections: DataFrame) -> DataFrame:
    """document_id, heading_path, n: level-2 paths that several sections of one document share."""
    return sections.filter("level = 2").groupBy("document_id", "heading_path").agg(F.count("*").alias("n")).filter("n > 1")


def require_distinct_paths(sections: DataFrame) -> DataFrame:
    """The sections; raises ChunkingError if two level-2 sections of a document share a path, so that their texts can't be told apart by it."""
    bad = duplicate_paths(sections).limit(3).collect()
    if bad:
        raise ChunkingError(f"several sections of the path {', '.join(repr(r['heading_path']) for r in bad)}")
    return sections


def units(sections: DataFrame, assigned: DataFrame, blocks: DataFrame) -> DataFrame:
    """document_id, scope, order_index, content: the units of every level-2 section, in the order of their sections.

    The section's own blocks are a unit without a heading, if any survive cleaning.  Every section below it that
    has blocks is a unit with its heading in front, even if its blocks all clean to nothing.
    """
    ids = blocks.select("document_id", "id", "page_number", clean_block(F.col("block_type"), F.col("text_content"), F.col("markdown_content")).alias("body")).dropDuplicates(["document_id", "id"])
    placed = assigned.join(ids, ["document_id", "id"])
    kept = F.when(F.col("body").isNotNull() & (F.col("body") != ""), F.struct("page_number", "id", "body"))
    bodies = placed.groupBy("document_id", "order_index").agg(F.array_join(F.transform(F.sort_array(F.collect_list(kept)), lambda x: x["body"]), "\n\n").alias("body"))
    rows = in_scopes(sections.select("document_id", "order_index", "level", "heading")).join(bodies, ["document_id", "order_index"])
    title = F.concat(F.repeat(F.lit("#"), F.least("level", F.lit(6))), F.lit(" "), F.col("heading"))
    content = F.when(F.col("order_index") == F.col("scope"), F.col("body")).otherwise(F.when(F.col("body") == "", title).otherwise(F.concat(title, F.lit("\n\n"), F.col("body"))))
    return rows.select("document_id", "scope", "order_index", content.alias("content")).filter("content <> ''")


def _fold(parts: Column, limit: int, joiner: str) -> Column:
    """Greedy: a new text whenever the sum would pass the limit; parts are struct<content, tokens>."""
    start = F.struct(F.array().cast(f"array<{UNIT}>").alias("done"), F.array().cast("array<string>").alias("held"), F.lit(0).alias("tokens"))

    def close(acc):
        text = F.struct(F.array_join(acc["held"], joiner).alias("content"), acc["tokens"].alias("tokens")).cast(UNIT)
        return F.when(F.size(acc["held"]) > 0, F.concat(acc["done"], F.array(text))).otherwise(acc["done"])

    def step(acc, x):
        full = (acc["tokens"] + x["tokens"] > limit) & (F.size(acc["held"]) > 0)
        return F.struct(
            F.when(full, close(acc)).otherwise(acc["done"]).alias("done"),
            F.concat(F.when(full, F.array().cast("array<string>")).otherwise(acc["held"]), F.array(x["content"])).alias("held"),
            (F.when(full, 0).otherwise(acc["tokens"]) + x["tokens"]).cast("int").alias("tokens"),
        )

    return F.aggregate(parts, start, step, close)


def split_unit(content: Column, limit: int, count: TokenCounter = words) -> Column:
    """A text as units of at most ``limit`` tokens: paragraphs packed greedily, long paragraphs by lines.

    A single line beyond the limit stays whole.  ``count`` must be a JVM expression.
    """
    unit = lambda text, tokens: F.struct(text.alias("content"), tokens.cast("int").alias("tokens"))
    paragraphs = F.filter(F.transform(F.split(content, r"\n\n+"), pystrip), lambda p: p != "")
    sized = F.transform(paragraphs, lambda p: unit(p, count(p)))
    lines = lambda p: _fold(F.transform(F.split(p, "\n"), lambda x: unit(x, count(x))), limit, "\n")
    empty = F.array().cast(f"array<{UNIT}>")
    start = F.struct(empty.alias("done"), empty.alias("held"))

    def flush(acc):
        return F.concat(acc["done"], _fold(acc["held"], limit, "\n\n"))

    def step(acc, p):
        long = p["tokens"] > limit
        return F.struct(
            F.when(long, F.concat(flush(acc), lines(p["content"]))).otherwise(acc["done"]).alias("done"),
            F.when(long, empty).otherwise(F.concat(acc["held"], F.array(p))).alias("held"),
        )

    return F.aggregate(sized, start, step, flush)


def pack_units(parts: Column, target: int, limit: int) -> Column:
    """Ordered units as chunks: closed when the next would pass the limit, and when the target is reached.

    Tokens of a chunk are the sum of its units'; a unit beyond the limit is a chunk by itself.
    """
    empty = F.array().cast(f"array<{UNIT}>")
    start = F.struct(empty.alias("done"), F.array().cast("array<string>").alias("held"), F.lit(0).alias("tokens"))

    def chunk(held, tokens):
        return F.array(F.struct(F.array_join(held, "\n\n").alias("content"), tokens.cast("int").alias("tokens")))

    def step(acc, x):
        full = (acc["tokens"] + x["tokens"] > limit) & (F.size(acc["held"]) > 0)
        done = F.when(full, F.concat(acc["done"], chunk(acc["held"], acc["tokens"]))).otherwise(acc["done"])
        held = F.concat(F.when(full, F.array().cast("array<string>")).otherwise(acc["held"]), F.array(x["content"]))
        tokens = F.when(full, 0).otherwise(acc["tokens"]) + x["tokens"]
        reached = tokens >= target
        return F.struct(
            F.when(reached, F.concat(done, chunk(held, tokens))).otherwise(done).alias("done"),
            F.when(reached, F.array().cast("array<string>")).otherwise(held).alias("held"),
            F.when(reached, 0).otherwise(tokens).cast("int").alias("tokens"),
        )

    return F.aggregate(parts, start, step, lambda acc: F.when(F.size(acc["held"]) > 0, F.concat(acc["done"], chunk(acc["held"], acc["tokens"]))).otherwise(acc["done"]))


def chunk_units(rows: DataFrame, settings: ChunkSettings = ChunkSettings(), count: TokenCounter = words) -> DataFrame:
    """document_id, scope, order_index, content, token_count: units() packed into parent chunks."""
    pieces = rows.withColumn("tokens", count(F.col("content"))).withColumn(
        "parts", F.when(F.col("tokens") > settings.parent_max, split_unit(F.col("content"), settings.parent_max, count)).otherwise(F.array(F.struct("content", F.col("tokens").cast("int").alias("tokens"))))
    )
    ordered = pieces.groupBy("document_id", "scope").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("order_index", "parts"))), lambda x: x["parts"])).alias("parts"))
    chunks = ordered.select("document_id", "scope", F.posexplode(pack_units(F.col("parts"), settings.parent_target, settings.parent_max)).alias("order_index", "c"))
    return chunks.select("document_id", "scope", "order_index", F.col("c.content").alias("content"), F.col("c.tokens").alias("token_count"))


def parent_chunks(blocks: DataFrame, settings: ChunkSettings = ChunkSettings(), count: TokenCounter = words, strict: bool = False) -> DataFrame:
    """Blocks to parent chunks, with the path and the pages of the level-2 section they come from.

    Sections are told apart by their place, so equal paths do no harm; with ``strict`` they raise ChunkingError.
    """
    from quire.operators.assign import assign
    from quire.operators.hierarchy import build_sections
    from quire.plans.materialize import materialize

    sections = materialize(build_sections(blocks))
    if strict:
        require_distinct_paths(sections)
    chunks = chunk_units(units(sections, assign(blocks, sections), blocks), settings, count)
    heads = sections.select("document_id", F.col("order_index").alias("scope"), "heading_path", "page_start", "page_end")
    return chunks.join(heads, ["document_id", "scope"])


def child_chunks(chunks: DataFrame, key: str, content: str, settings: ChunkSettings = ChunkSettings(), count: TokenCounter = words) -> DataFrame:
    """parent_id, chunk_index, content, token_count: the same folds with the child sizes, sentence by sentence."""
    target, limit = settings.child_target, settings.child_max
    sentences = F.filter(F.split(F.col(content), rf"(?<=[.!?])[{PY_WS}]+|\n\n+"), lambda s: pystrip(s) != "")
    parts = F.transform(sentences, lambda s: F.struct(pystrip(s).alias("content"), count(s).cast("int").alias("tokens")))
    out = chunks.select(F.col(key).alias("parent_id"), F.posexplode(pack_units(parts, target, limit)).alias("chunk_index", "c"))
    return out.select("parent_id", "chunk_index", F.col("c.content").alias("content"), F.col("c.tokens").alias("token_count"))


def guard_overwrite(existing: DataFrame, overwrite: bool) -> None:
    """Refuses to build chunks that exist already."""
    if not overwrite and existing.limit(1).count():
        raise ChunkingError("chunks exist already; pass overwrite=True to replace them")


def unchunked_blocks(sections: DataFrame, assigned: DataFrame) -> DataFrame:
    """document_id, n_blocks: blocks of sections that no level-2 section reaches, which are never chunked."""
    reached = in_scopes(sections).select("document_id", "order_index")
    return assigned.join(reached, ["document_id", "order_index"], "left_anti").groupBy("document_id").agg(F.count("*").alias("n_blocks"))
