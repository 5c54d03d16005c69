"""Collapsing records that differ only in formatting.

A record is a tree whose leaves are texts: a plain text is one leaf, a key-value block an unordered node whose
leaves are its fields, and structs, arrays and maps are nodes of any depth.  Leaves are normalised and digested
bottom-up, a node's digest covers its kind and its children's digests, sorted where their order doesn't count.
Records are grouped by root digest; where a digest has more than one record, their whole normalised structures are
compared, and structures that share a digest without being equal are kept apart.

Texts are normalised once and only ids and digests are shuffled, combined per task before.  Whole structures are
built and shuffled only for records whose digest is shared, each different one once per task; other records are told
by a bitmap of bounded size and stay where they are.  Everything is built
from JVM expressions.  Classes that hold a thousandth of all rows (a thousand classes at most, by counting) are
joined by broadcast where copies are listed, the others by shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.whitespace import LINE_ENDS, char_class
from quire.plans.materialize import join_checked, materialize, may_be_in, small_enough, spread

HOT_SHARE = 0.001

#: Invisible characters that count as nothing: zero width space, byte order mark, soft hyphen.
INVISIBLE = char_class(((0x200B, 0x200B), (0xFEFF, 0xFEFF), (0xAD, 0xAD)))
#: Removed from a leaf: white space, invisible characters, and punctuation but for . , / : between two digits.
DROPPED = rf"(?U)[\s\p{{P}}{INVISIBLE}&&[^.,/:]]++|(?<!\p{{Nd}})[.,/:]|[.,/:](?!\p{{Nd}})"
FIELD_END = f"[;|{LINE_ENDS}]"
ALNUM = r"[\p{L}\p{Nd}]"


class Node(NamedTuple):
    """Two views of a record or a part of one: its whole normalised structure, and its digest as hex digits."""

    whole: Column
    digest: Column


def leaf(text: Column) -> Column:
    """The normalised form of one leaf."""
    return F.lower(F.regexp_replace(text, DROPPED, ""))


def text_or_fields(text: Column, unordered: Column) -> Node:
    """A text as one leaf, or as the unordered node of its non-empty fields."""
    fields = F.array_sort(F.filter(F.transform(F.split(text, FIELD_END), leaf), lambda x: x != ""))
    kind = F.when(unordered, "u").otherwise("t")
    leaves = F.when(unordered, fields).otherwise(F.array(leaf(text)))
    return Node(F.struct(kind.alias("kind"), leaves.alias("leaves")), F.md5(F.concat(kind, F.array_join(F.array_sort(F.transform(leaves, F.md5)), ""))))


def tree(value: Column, kind: T.DataType, ordered: bool = True) -> Node:
    """A nested value as a node: structs by the names of their fields, maps by their keys, arrays in order unless ``ordered`` is false.

    Null and empty are different leaves; numbers and other scalars are leaves by their text.
    """
    if isinstance(kind, T.StructType):
        parts = {f.name: tree(value.getField(f.name), f.dataType, ordered) for f in sorted(kind, key=lambda f: f.name)}
        whole = F.struct(*[p.whole.alias(f"f{i}") for i, p in enumerate(parts.values())])
        digest = F.md5(F.concat(F.lit("s"), *[x for name, p in parts.items() for x in (F.md5(F.lit(name)), p.digest)]))
    elif isinstance(kind, T.ArrayType):
        wholes, digests = F.transform(value, lambda x: tree(x, kind.elementType, ordered).whole), F.transform(value, lambda x: tree(x, kind.elementType, ordered).digest)
        whole = wholes if ordered else F.array_sort(wholes)
        digest = F.md5(F.concat(F.lit("o" if ordered else "u"), F.array_join(digests if ordered else F.array_sort(digests), "")))
    elif isinstance(kind, T.MapType):
        pair = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return tree(F.map_entries(value), T.ArrayType(pair), ordered=False)
    else:
        whole = leaf(value.cast("string"))
        digest = F.md5(F.concat(F.lit("t"), whole))
    return Node(F.when(value.isNotNull(), whole), F.when(value.isNotNull(), digest).otherwise(F.md5(F.lit("n"))))


def has_alnum(text: Column, least: int) -> Column:
    """Whether a text has at least so many letters and digits; looks no further than it must."""
    if least > 200:  # the matcher's stack grows with the repetitions
        return F.regexp_count(text, F.lit(ALNUM)) >= least
    return (F.length(text) >= least) & text.rlike(rf"\A(?:[^\p{{L}}\p{{Nd}}]*+{ALNUM}){{{least}}}")


class Records(NamedTuple):
    """What the classes are made from."""

    #: item_id, h (hash of the record as it is) and body of every row that counts
    rows: DataFrame
    #: item_id, h, class_key of the rows whose digest another row has, too
    shared: DataFrame


def looked_up(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``rows`` joined with ``keys`` by item_id and h ('inner' or 'left'): by broadcast if the keys are few.

    Otherwise only rows that a bitmap doesn't rule out are shuffled, so that the texts of records without copies stay
    where they are.
    """
    on = ["item_id", "h"]
    if small_enough(keys, 96, 32 << 20):
        return rows.join(F.broadcast(keys), on, how)
    marked = rows.withColumn("maybe", may_be_in("h", keys))
    some = marked.filter("maybe").drop("maybe").join(keys, on, how)
    return some if how == "inner" else some.unionByName(marked.filter("NOT maybe").drop("maybe"), allowMissingColumns=True)


def classes(df: DataFrame, key: str, body: str, node: Node, counts: Column | None = None) -> Records:
    """Digests of all records, and classes of those whose digest occurs more than once.

    ``class_key`` is the digest; where the comparison of whole structures finds several behind one digest, it is
    the digest with a number for each structure.
    """
    flat = isinstance(df.schema[body].dataType, T.AtomicType)
    raw = F.xxhash64(F.col(body) if flat else F.to_json(F.struct(body)))  # tells apart the rows of one id
    rows = df.select(F.col(key).alias("item_id"), raw.alias("h"), F.col(body).alias("body"), node.whole.alias("whole"), F.unhex(node.digest).alias("digest"), (counts if counts is not None else F.lit(True)).alias("counts"))
    rows = rows.filter("body IS NOT NULL AND item_id IS NOT NULL AND counts").drop("counts")
    ids = materialize(rows.select("item_id", "h", "digest"))
    several = materialize(ids.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"))
    same = materialize(join_checked(ids, several, ["digest"], "inner", 48).select("item_id", "h", "digest").distinct())
    # whole structures, of the rows in question only
    asked = looked_up(rows.drop("digest"), same, "inner")
    structures = asked.groupBy("digest", "whole").agg(F.lit(1).alias("one")).groupBy("digest").agg(F.count("*").alias("n"))
    apart = materialize(structures.filter("n > 1").select("digest"))
    shared = same.withColumn("class_key", F.col("digest"))
    if apart.limit(1).count():
        # digests that collided: their structures are numbered, whatever these rows cost
        few = asked.join(apart, "digest", "left_semi")
        number = few.select("digest", "whole").distinct().groupBy("digest").agg(F.array_sort(F.collect_set("whole")).alias("all"))  # structures of one digest that collide
        keys = few.join(number, "digest").select("item_id", "h", "digest", F.concat("digest", F.encode(F.array_position("all", F.col("whole")).cast("string"), "UTF-8")).alias("key")).distinct()
        shared = same.join(keys, ["item_id", "h", "digest"], "left").select("item_id", "h", "digest", F.coalesce("key", "digest").alias("class_key"))
    return Records(rows.select("item_id", "h", "body"), shared.select("item_id", "h", "class_key"))


def collapse(df: DataFrame, key: str, body: str, node: Node, counts: Column | None = None) -> DataFrame:
    """first_id, n_items, passage: one row per distinct record with the number of different ids that hold it.

    ``passage`` is the ``body`` of the record's smallest id (the smallest body of several).  Null bodies and null keys
    give no row; texts that are empty or of white space and punctuation only are equal to each other.  An id in several
    rows counts once per record.  Records that no other row shares pass through without a shuffle.
    """
    held = classes(df, key, body, node, counts)
    marked = looked_up(held.rows, held.shared, "left")
    alone = marked.filter("class_key IS NULL").select(F.col("item_id").alias("first_id"), F.lit(1).cast("long").alias("n_items"), F.col("body").alias("passage"))
    numbers = held.shared.select("class_key", "item_id").distinct().groupBy("class_key").agg(F.count("*").alias("n_items"))
    first = marked.filter("class_key IS NOT NULL").groupBy("class_key").agg(F.min(F.struct("item_id", "body")).alias("first"))
    return alone.unionByName(first.join(numbers, "class_key").select(F.col("first.item_id").alias("first_id"), "n_items", F.col("first.body").alias("passage")))


def copies(df: DataFrame, key: str, body: str, node: Node, counts: Column | None = None) -> DataFrame:
    """first_id, copy_id: for every class of equal records its smallest id with each other id.

    Rows for which ``counts`` is not true don't count, nor do null bodies and null keys.  An id in several rows
    counts once.
    """
    held = classes(df, key, body, node, counts)
    ids = materialize(held.shared.select("item_id", "class_key").distinct())
    firsts = materialize(ids.groupBy("class_key").agg(F.min("item_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1"))
    hot = max(2, int(HOT_SHARE * ids.count()))
    few, many = firsts.filter(F.col("n") >= hot), firsts.filter(F.col("n") < hot)
    pairs = ids.join(F.broadcast(few), "class_key").unionByName(ids.join(many, "class_key"))
    return pairs.filter("item_id > first_id").select("first_id", F.col("item_id").alias("copy_id"))


def _blocks(spark, sf_dir: str) -> tuple[DataFrame, str, str, Node]:
    from quire.sources.tables import read_table

    blocks = spread(read_table(spark, sf_dir, "raw_blocks").select("id", "text_content", "block_type"))
    return blocks, "id", "text_content", text_or_fields(F.col("text_content"), F.coalesce(F.col("block_type") == "key_value_item", F.lit(False)))


def block_copies(spark, sf_dir: str) -> DataFrame:
    return copies(*_blocks(spark, sf_dir), has_alnum(F.col("text_content"), 50))


def block_passages(spark, sf_dir: str) -> DataFrame:
    return collapse(*_blocks(spark, sf_dir))
