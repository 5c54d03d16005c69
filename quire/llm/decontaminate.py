"""Evaluation texts that leaked into training text.

Words are maximal runs of letters and digits after compatibility decomposition, removal of combining marks and
lower-casing.  Every run of ``n`` consecutive words of a test item goes into a hash set, which is broadcast; training
texts are scanned for windows of words that the test items use at all, windows are looked up by hash, and a hit is
verified word by word.

The set is broadcast in parts of a bounded number of words, whatever the size of the test items: a part that is full
is followed by another, with one more scan of the training texts each.  The training texts are never shuffled; what
is shuffled are the hits, and for cutting spans they are joined back to the texts.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.plans.materialize import join_checked, materialize, spread

N = 13
#: Test words of one part of the set: about 20 bytes each in a worker, and its vocabulary.
PART_WORDS = 4_000_000
#: Longer items are taken in pieces that overlap by a window, so that parts can be filled evenly.
PIECE_WORDS = 100_000

_ASCII = re.compile("[a-z0-9]+")
_ANY = regex.compile(r"[\p{L}\p{Nd}]+")
_MARKS = regex.compile(r"\p{M}+")


def words(text: str) -> list[str]:
    """The words of a text, normalised."""
    if text.isascii():
        return _ASCII.findall(text.lower())
    plain = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower()
    return _ASCII.findall(plain) if plain.isascii() else _ANY.findall(plain)


def word_spans(text: str) -> list[tuple[str, int, int]]:
    """Words with the places in the original text where they begin and end."""
    plain, origin = [], []
    for i, c in enumerate(text):
        for d in c.lower() if c.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", c)).lower():
            plain.append(d)
            origin.append(i)
    return [(m.group(), origin[m.start()], origin[m.end() - 1] + 1) for m in _ANY.finditer("".join(plain))]


class Grams:
    """A part of the test items as a hash set of word windows: the words as codes, and places of windows sorted by hash."""

    def __init__(self, pieces: list[tuple[object, str]], n: int = N):
        self.n = n
        self.number: dict[str, int] = {}
        self.items = [item for item, _ in pieces]
        # a zero after each piece, so that no window reaches over its end
        coded = [[*(self.number.setdefault(w, len(self.number) + 1) for w in text.split()), 0] for _, text in pieces]
        self.begins = np.cumsum([0, *map(len, coded)])[:-1]
        self.codes = np.fromiter((c for piece in coded for c in piece), np.uint32, sum(map(len, coded)))
        places, hashes = self.windows(self.codes)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.places = hashes[order], places[order].astype(np.uint32)

    def windows(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of all windows of ``n`` known words."""
        n = self.n
        unknown = np.concatenate(([0], np.cumsum(codes == 0)))
        at = np.flatnonzero(unknown[n:] == unknown[:-n]) if len(codes) >= n else np.empty(0, np.int64)
        hashes = np.zeros(len(at), np.uint64)
        for j, factor in enumerate(np.random.default_rng(n).integers(1, 1 << 63, n, np.uint64)):
            hashes += codes[at + j].astype(np.uint64) * (factor | np.uint64(1))
        return at, hashes

    def hits(self, texts: list[list[str]]) -> list[tuple[int, object, list[int]]]:
        """(number of the text, item, places of its windows that the item contains) for every text with hits."""
        get, flat = self.number.get, []
        for tokens in texts:
            flat.extend([get(w, 0) for w in tokens])
            flat.append(0)
        codes = np.array(flat, np.uint32)
        at, hashes = self.windows(codes)
        low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        held = high - low
        if not held.any():
            return []
        mine = np.repeat(at, held)
        theirs = self.places[np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held) + np.repeat(low, held)]
        same = np.ones(len(mine), bool)
        for j in range(self.n):
            same &= codes[mine + j] == self.codes[theirs + j]
        mine, theirs = mine[same], theirs[same]
        ends = np.cumsum([len(tokens) + 1 for tokens in texts])
        of_text, piece = np.searchsorted(ends, mine, "right"), np.searchsorted(self.begins, theirs, "right") - 1
        out: dict[tuple, set[int]] = {}
        for t, p, place in zip(of_text.tolist(), piece.tolist(), mine.tolist(), strict=True):
            out.setdefault((t, self.items[p]), set()).add(place - int(ends[t]) + len(texts[t]) + 1)
        return [(t, item, sorted(places)) for (t, item), places in out.items()]


def _pieces(items: DataFrame, item_key: str, item_text: str, n: int, piece_words: int) -> DataFrame:
    """item_id, words, n_words: the normalised words of every item, long ones in overlapping pieces."""
    rows = items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("body")).filter("item_id IS NOT NULL AND length(body) > 0")

    def run(batches):
        for batch in batches:
            kept, texts, sizes = [], [], []
            for r, body in enumerate(batch.column(1)):
                tokens = words(body.as_py())
                for a in range(0, max(1, len(tokens) - n + 1), piece_words):
                    some = tokens[a : a + piece_words + n - 1]
                    if len(some) >= n:
                        kept.append(r)
                        texts.append(" ".join(some))
                        sizes.append(len(some))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], names=["item_id", "words", "n_words"])

    return rows.mapInArrow(run, f"item_id {rows.schema['item_id'].dataType.simpleString()}, words string, n_words long").distinct()


def found(docs: DataFrame, doc_key: str, text: str, items: DataFrame, item_key: str, item_text: str, n: int = N, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, h, item_id, places: for every text and item that share windows, the numbers of the words at which those begin.

    ``h`` is the hash of the text, which tells apart several texts under one key.
    """
    rows = docs.select(F.col(doc_key).alias("doc_id"), F.xxhash64(text).alias("h"), F.col(text).alias("body")).filter("length(body) > 0")
    pieces = materialize(_pieces(items, item_key, item_text, n, min(PIECE_WORDS, max(1, part_words // 4))))
    n_words = pieces.agg(F.sum("n_words")).first()[0] or 0
    parts = 1 if n_words <= part_words else -(-2 * n_words // part_words)  # half full, since hashing fills them unevenly
    numbered = pieces.withColumn("part", F.pmod(F.xxhash64("item_id", "words"), F.lit(parts)))
    keys, ids = rows.schema["doc_id"].dataType.simpleString(), pieces.schema["item_id"].dataType.simpleString()
    out = []
    for p in range(parts):
        held = numbered.filter(F.col("part") == p).select("item_id", "words").toArrow()  # a part, bounded by part_words
        grams = Grams(list(zip(held.column(0).to_pylist(), held.column(1).to_pylist(), strict=True)), n)
        out.append(_scan(rows, docs.sparkSession.sparkContext.broadcast(grams), f"doc_id {keys}, h long, item_id {ids}, places array<int>", held.schema.field("item_id").type))
    return reduce(DataFrame.unionByName, out)


def _scan(rows: DataFrame, shared, schema: str, item_type: pa.DataType) -> DataFrame:
    def run(batches):
        grams = shared.value
        for whole in batches:
            for a in range(0, len(whole), 256):
                batch = whole.slice(a, 256)
                hits = grams.hits([words(body.as_py()) for body in batch.column(2)])
                at = pa.array([t for t, _, _ in hits], pa.int64())
                columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array([i for _, i, _ in hits], item_type), pa.array([p for _, _, p in hits], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "h", "item_id", "places"])

    return rows.mapInArrow(run, schema)


def leaked(docs: DataFrame, doc_key: str, text: str, items: DataFrame, item_key: str, item_text: str, n: int = N, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, item_id: the texts that contain at least ``n`` consecutive words of an item as consecutive words.

    Null or empty texts and texts or items of fewer than ``n`` words have no rows, nor have items without a key; a
    document repeated under the same key is reported once per item, and so is an item.  Keys keep their types.
    """
    return found(docs, doc_key, text, items, item_key, item_text, n, part_words).select("doc_id", "item_id").distinct()


def without_leaks(docs: DataFrame, doc_key: str, text: str, items: DataFrame, item_key: str, item_text: str, n: int = N, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, n_spans, text: every document with the spans covered by hits removed.

    Documents without hits keep their text, null texts stay null, repeated rows stay repeated.
    """
    hits = found(docs, doc_key, text, items, item_key, item_text, n, part_words)
    # one row per text: the windows of one text are bounded by its words
    places = materialize(hits.groupBy("doc_id", "h").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places")))
    rows = docs.select(F.col(doc_key).alias("doc_id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    size = int(places.agg(F.max(F.size("places"))).first()[0] or 0) * 4 + 64
    marked = join_checked(rows.withColumn("k", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), places.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k"), "h", "places"), ["k", "h"], "left", size).drop("k", "h")

    def run(batches):
        for batch in batches:
            bodies, counts = [], []
            for body, at in zip(batch.column(1), batch.column(2), strict=True):
                text, n_spans = cut(body.as_py(), at.as_py(), n)
                bodies.append(text)
                counts.append(n_spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int32()), pa.array(bodies, pa.string())], names=["doc_id", "n_spans", "text"])

    clean = marked.filter("places IS NULL").select("doc_id", F.lit(0).alias("n_spans"), "text")
    keys = rows.schema["doc_id"].dataType.simpleString()
    return clean.unionByName(marked.filter("places IS NOT NULL").select("doc_id", "text", "places").mapInArrow(run, f"doc_id {keys}, n_spans int, text string"))


def cut(body: str, windows: list[int], n: int) -> tuple[str, int]:
    """The text without the words of the windows that begin at the given words, and the number of spans that went."""
    places = word_spans(body)
    spans: list[list[int]] = []
    for i in windows:
        a, b = places[i][1], places[i + n - 1][2]
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    for a, b in reversed(spans):
        body = body[:a] + body[b:]
    return body, len(spans)


def _tables(spark, sf_dir: str):
    from quire.sources.tables import read_table

    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text", read_table(spark, sf_dir, "eval_items"), "item_id", "text"


def document_leaks(spark, sf_dir: str) -> DataFrame:
    return leaked(*_tables(spark, sf_dir))


def documents_without_leaks(spark, sf_dir: str) -> DataFrame:
    return without_leaks(*_tables(spark, sf_dir))
