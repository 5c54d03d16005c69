"""Schemas that drift between releases of a producer.

The layout texts are read once into a catalogue: which path has which type in how many documents of a release,
and a profile of its values.  Runs of consecutive releases (islands) of each path and type are found with lag(),
their starts and endings are the log of changes: an ending and a start of one path in one release is a change of
type, other starts and endings are additions and removals, and an addition whose values carry on those of a
removal in the same place is a renaming.  The renamings are the alias table by which every release's elements
are read into one table.

The catalogue has a row per release, path, type and value feature, so it grows with the schema, not the data.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from functools import reduce
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.jsontext import OPEN, RETRACT, SAME, kind_of, read_json, triples
from quire.operators.mapping import ARRAYS
from quire.plans.materialize import materialize

#: A renaming needs this agreement: of the values, of their kinds (which few samples show already) and of the names.
RENAMED = 0.45
WEIGHTS = (0.5, 0.25, 0.25)
#: Values of a batch of elements that goes back to the JVM.
VALUES = 50_000
#: Entries of the catalogue that a task holds before it sends them on.
ENTRIES = 200_000
#: A field of fewer of the elements than this share has no column of its own.
LEAST_SHARE = 0.0005


def feature(value) -> str:
    """A coarse description of a value, alike for values of one kind."""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        if value == int(value) and abs(value) <= 20:
            return f"i{int(value)}"
        return f"{'f' if value != int(value) else 'n'}{math.copysign(round(math.log10(abs(value)) * 2), value):g}"
    if len(value) <= 12 and value.isalpha():
        return f"v{zlib.crc32(value.encode()) % 256}"
    kinds = {"9" if c.isdigit() else "a" if c.isalpha() else c for c in set(value)}
    return f"{''.join(sorted(kinds)) if len(kinds) <= 4 else '*'}~{len(value).bit_length()}"


def survey(root, seen: dict, profile: Counter) -> None:
    """Adds the paths and types of one document to ``seen`` and the features of its values to ``profile``."""
    stack = [(root, "")]
    while stack:
        value, path = stack.pop()
        kind = kind_of(value)
        if path and kind != "null":
            seen[path, kind] = 1
        if kind == "object":
            if path:
                for k in value:
                    profile[path, kind, f"k{k}"] += 1
            stack.extend((v, f"{path}.{k}" if path else k) for k, v in value.items())
        elif kind == "array":
            if path:
                profile[path, kind, f"l{len(value).bit_length()}"] += 1
                for x in value:
                    if isinstance(x, dict):
                        for k in x:
                            profile[path, kind, f"k{k}"] += 1
            stack.extend((x, f"{path}[]") for x in value)
        elif kind != "null":
            profile[path, kind, feature(value)] += 1


CATALOGUE = "release string, path string, kind string, feature string, n long"


def catalogue(df: DataFrame, release: str, text: str) -> DataFrame:
    """release, path, kind, feature, n: documents per path and type (feature null), values per feature.

    Texts that are null or not complete JSON and rows without a release do not count.
    """

    def entries(docs: dict[str, Counter], profiles: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(v, p, k, None, n) for v, c in docs.items() for (p, k), n in c.items()]
        rows += [(v, p, k, f, n) for v, c in profiles.items() for (p, k, f), n in c.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["release", "path", "kind", "feature", "n"])

    def run(batches):
        docs: dict[str, Counter] = defaultdict(Counter)
        profiles: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for version, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                root = read_json(body.as_py())
                if root is None:
                    continue
                seen: dict = {}
                survey(root, seen, profiles[version])
                docs[version].update(seen)
                if len(profiles[version]) > ENTRIES:
                    yield entries(docs, profiles)
                    docs.clear()
                    profiles.clear()
        yield entries(docs, profiles)

    rows = df.select(F.col(release).cast("string"), F.col(text)).filter(F.col(release).isNotNull() & F.col(text).isNotNull())
    return rows.mapInArrow(run, CATALOGUE).groupBy("release", "path", "kind", "feature").agg(F.sum("n").alias("n"))


def release_order(release: Column) -> Column:
    """Sorts releases by their numbers, part by part."""
    return F.transform(F.split(release, r"[^0-9]+"), lambda x: F.coalesce(x.try_cast("long"), F.lit(0)))


def parent_of(path: Column) -> Column:
    """The path around a field; '' at the top."""
    return F.regexp_replace(path, r"(?:^|\.)[^.]*$", "")


def ancestors_of(path: Column) -> Column:
    """All paths around a path: cut before each '.' and before each '[]'."""
    parts = F.split(F.regexp_replace(path, r"\[\]", ".[]"), r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.regexp_replace(F.array_join(F.slice(parts, 1, i), "."), r"\.\[\]", "[]"))
    return F.when(F.size(parts) > 1, prefixes).otherwise(F.array().cast("array<string>"))


def numbered(cat: DataFrame) -> DataFrame:
    """release, no: the releases in the order of their numbers; one row per release."""
    return cat.select("release").distinct().withColumn("no", F.row_number().over(Window.orderBy(release_order(F.col("release")), "release")))


def lifespans(cat: DataFrame) -> DataFrame:
    """path, kind, first, last, first_no, last_no, n_releases: the islands of consecutive releases."""
    present = cat.filter("feature IS NULL").select("release", "path", "kind").join(numbered(cat), "release")
    order = Window.partitionBy("path", "kind").orderBy("no")
    islands = present.withColumn("island", F.sum(F.when(F.col("no") - F.lag("no").over(order) == 1, 0).otherwise(1)).over(order))
    span = islands.groupBy("path", "kind", "island").agg(F.min("no").alias("first_no"), F.max("no").alias("last_no"), F.min_by("release", "no").alias("first"), F.max_by("release", "no").alias("last"))
    return span.withColumn("n_releases", F.max("last_no").over(Window.partitionBy(F.lit(1)))).drop("island")


def changes(cat: DataFrame) -> DataFrame:
    """parser_version, change, old_path, new_path of a catalogue(): each release against the one before it."""
    releases = materialize(numbered(cat))
    spans = materialize(lifespans(cat))
    starts = spans.filter("first_no > 1").select(F.col("first_no").alias("no"), "path", "kind")
    ends = spans.filter("last_no < n_releases").select((F.col("last_no") + 1).alias("no"), "path", "kind")
    now = materialize(cat.filter("feature IS NULL").join(releases, "release").select("no", "path").distinct())
    before = now.select((F.col("no") + 1).alias("no"), "path")
    moved = starts.select("no", "path").unionByName(ends.select("no", "path")).distinct()
    both = now.join(before, ["no", "path"], "left_semi")
    retyped = moved.join(both, ["no", "path"], "left_semi").withColumn("change", F.lit("retyped"))
    # an array's element is no field of its own, though its type may change
    field = ~F.col("path").endswith("[]")
    added = starts.select("no", "path").distinct().join(before, ["no", "path"], "left_anti").withColumn("change", F.lit("added")).filter(field)
    removed = ends.select("no", "path").distinct().join(now, ["no", "path"], "left_anti").withColumn("change", F.lit("removed")).filter(field)
    log = materialize(retyped.unionByName(added).unionByName(removed))
    below = log.select("no", "path", "change", F.explode(ancestors_of(F.col("path"))).alias("above"))
    hidden = below.join(log.select("no", F.col("path").alias("above")), ["no", "above"], "left_semi").select("no", "path", "change").distinct()
    top = materialize(log.join(hidden, ["no", "path", "change"], "left_anti"))
    pairs = materialize(renamings(top, cat, releases))
    renamed = pairs.select("no", F.lit("renamed").alias("change"), "old_path", "new_path")
    gone, come = pairs.select("no", F.col("old_path").alias("path")), pairs.select("no", F.col("new_path").alias("path"))
    rest = (
        top.filter("change = 'retyped'").select("no", "change", F.col("path").alias("old_path"), F.col("path").alias("new_path"))
        .unionByName(top.filter("change = 'removed'").join(gone, ["no", "path"], "left_anti").select("no", "change", F.col("path").alias("old_path"), F.lit("").alias("new_path")))
        .unionByName(top.filter("change = 'added'").join(come, ["no", "path"], "left_anti").select("no", "change", F.lit("").alias("old_path"), F.col("path").alias("new_path")))
    )
    return renamed.unionByName(rest).join(releases, "no").select(F.col("release").alias("parser_version"), "change", "old_path", "new_path")


def renamings(top: DataFrame, cat: DataFrame, releases: DataFrame) -> DataFrame:
    """no, old_path, new_path: removals and additions of one place whose values agree, best pairs first."""
    old = top.filter("change = 'removed'").select("no", F.col("path").alias("old_path"), parent_of(F.col("path")).alias("place"))
    new = top.filter("change = 'added'").select("no", F.col("path").alias("new_path"), parent_of(F.col("path")).alias("place"))
    pairs = materialize(old.join(new, ["no", "place"]))
    # only the profiles of these pairs are compared
    asked = pairs.select(F.explode(F.array(F.struct((F.col("no") - 1).alias("no"), F.col("old_path").alias("path")), F.struct("no", F.col("new_path").alias("path")))).alias("p")).select("p.*").distinct()
    features = cat.filter("feature IS NOT NULL").join(releases, "release").join(asked, ["no", "path"], "left_semi")
    share = features.withColumn("q", F.col("n") / F.sum("n").over(Window.partitionBy("release", "path", "kind"))).select("no", "path", "kind", "feature", "q")
    a = share.select((F.col("no") + 1).alias("no"), F.col("path").alias("old_path"), "kind", "feature", F.col("q").alias("qa"))
    b = share.select("no", F.col("path").alias("new_path"), "kind", "feature", F.col("q").alias("qb"))
    coarse = F.when(F.col("feature").contains("~"), F.substring_index("feature", "~", 1)).when(F.col("feature").rlike("^[ifnlv]"), F.substring("feature", 1, 1)).otherwise(F.col("feature"))
    a, b = a.withColumn("coarse", coarse), b.withColumn("coarse", coarse)
    def overlap(by: str) -> DataFrame:
        left = a.groupBy("no", "old_path", "kind", by).agg(F.sum("qa").alias("qa"))
        right = b.groupBy("no", "new_path", "kind", by).agg(F.sum("qb").alias("qb"))
        both = pairs.join(left, ["no", "old_path"]).join(right, ["no", "new_path", "kind", by])
        return both.groupBy("no", "old_path", "new_path").agg(F.sum(F.least("qa", "qb")).alias(f"by_{by}"))

    # pairs of different types share nothing; numbers and texts that only share their kind stay below the bound
    agree = overlap("coarse").join(overlap("feature"), ["no", "old_path", "new_path"], "left").fillna(0.0, ["by_feature"])
    x, y = F.regexp_extract("old_path", r"([^.]*)$", 1), F.regexp_extract("new_path", r"([^.]*)$", 1)
    names = F.when(x.contains(y) | y.contains(x), 1.0).otherwise(1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y)))
    score = WEIGHTS[0] * F.col("by_feature") + WEIGHTS[1] * F.col("by_coarse") + WEIGHTS[2] * names
    scored = agree.withColumn("score", score).filter(F.col("score") >= RENAMED)
    best = scored.withColumn("i", F.row_number().over(Window.partitionBy("no", "old_path").orderBy(F.desc("score"), "new_path")))
    best = best.withColumn("j", F.row_number().over(Window.partitionBy("no", "new_path").orderBy(F.desc("score"), "old_path")))
    return best.filter("i = 1 AND j = 1").select("no", "old_path", "new_path")


#: Where the elements of a layout stand: arrays of the document, and the other places that mapping.dispatch knows.
PLACES = (*(f"{name}[]" for name in ARRAYS), "elements[]", "body[]", "body.elements[]", "pages[].elements[]", "[]")
#: What the other places hold is named as in this array where no alias says otherwise.
LIKE = "texts[]"
ELEMENT = "array string, ordinal int, fields map<string,string>, kinds string, parts array<struct<path:string,at:string,fields:map<string,string>,kinds:string>>"

Aliases = list[tuple[str, str, str]]


def alias_table(log: DataFrame) -> Aliases:
    """(release, old path, new path) of the renamings of changes(), releases in the order of their numbers."""
    rows = log.filter("change = 'renamed'").orderBy(release_order(F.col("parser_version")), "parser_version", "old_path").collect()
    return [(r["parser_version"], r["old_path"], r["new_path"]) for r in rows]


def canonical(path: str, release: str | None, releases: list[str], aliases: Aliases) -> str:
    """The newest name of a path of one release: the renamings of all later releases, one after the other.

    A release that is null or not listed has no later ones.
    """
    after = set(releases[releases.index(release) + 1 :]) if release in releases else set()
    for version, old, new in aliases:
        if version in after and path.startswith(old) and path[len(old) : len(old) + 1] in ("", ".", "["):
            path = new + path[len(old) :]
    return path


def renamed(cat: DataFrame, releases: list[str], aliases: Aliases) -> DataFrame:
    """The catalogue with the newest name of every path, as canonical() gives it."""

    @F.pandas_udf("string")
    def newest(release: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([canonical(p, r, releases, aliases) for r, p in zip(release, path, strict=True)], dtype=object)

    return cat.withColumn("path", newest("release", "path")).groupBy("release", "path", "kind", "feature").agg(F.sum("n").alias("n"))


def all_aliases(cat: DataFrame, releases: list[str]) -> Aliases:
    """The alias table, with the renamings below renamed fields, which changes() doesn't list: round by round, from the top down."""
    aliases = alias_table(changes(cat))
    more = aliases
    while more:
        more = alias_table(changes(materialize(renamed(cat, releases, aliases))))
        more = [a for a in more if a not in aliases]
        aliases = aliases + more
    return aliases


def elements(df: DataFrame, key: str, release: str, text: str, places: list[str]) -> DataFrame:
    """doc_id, release and ELEMENT: every object of the arrays ``places`` (table paths as written) with all that it holds.

    ``fields`` and ``kinds`` are as in nested.flatten; ``parts`` has the objects of the arrays within the element, with
    their path and their place in it.  Scalars in these arrays are no elements.
    """
    wanted = set(places)

    def rows_of(text: str) -> list[tuple]:
        out: dict[str, tuple] = {}
        within: dict[str, tuple[str, tuple]] = {}  # place of an object -> the element around it and its own fields
        for table, place, field, ordinal, kind, value in triples(text):
            if kind == OPEN:
                above = within.get(value) if value is not None else None
                if above is not None:
                    element = above[0]
                    fields: dict = {}
                    out[element][3].append((table[len(out[element][0]) + 1 :], place[len(element) + 1 :], fields))
                    within[place] = (element, fields)
                elif table in wanted:
                    out[place] = (table, ordinal, {}, [])
                    within[place] = (place, out[place][2])
            elif kind == RETRACT:
                gone = value + "/"
                for p in [p for p in within if p.startswith(gone)]:
                    del within[p]
                for p in [p for p in out if p.startswith(gone)]:
                    del out[p]
                if (held := within.get(place)) is not None:
                    parts = out[held[0]][3]
                    parts[:] = [x for x in parts if not f"{held[0]}/{x[1]}".startswith(gone)]
                    for f in [f for f in held[1] if f == field or f.startswith((field + ".", field + "[", field + SAME))]:
                        del held[1][f]
            elif (held := within.get(place)) is not None:
                while field in held[1]:  # the path of another field reads the same
                    field += SAME
                held[1][field] = (kind, value)
        return list(out.values())

    def pairs(fields: dict) -> tuple[list, str]:
        return [(f, v) for f, (_, v) in fields.items()], "".join(k for k, _ in fields.values())

    def run(batches):
        names = ["doc_id", "release", "array", "ordinal", "fields", "kinds", "parts"]
        texts = pa.map_(pa.string(), pa.string())
        part = pa.struct([("path", pa.string()), ("at", pa.string()), ("fields", texts), ("kinds", pa.string())])
        columns: list[list] = [[] for _ in names]
        held, types = 0, None
        for batch in batches:
            types = types or (batch.schema.field(0).type, pa.string(), pa.string(), pa.int32(), texts, pa.string(), pa.list_(part))
            for doc, version, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                try:
                    found = rows_of(body.as_py())
                except ValueError:
                    continue
                for table, ordinal, fields, inner in found:
                    parts = [(path, at, *pairs(f)) for path, at, f in inner]
                    for c, v in zip(columns, (doc, version, table, ordinal, *pairs(fields), parts), strict=True):
                        c.append(v)
                    held += 1 + len(fields) + sum(1 + len(f) for _, _, f in inner)
                if held >= VALUES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
                    columns, held = [[] for _ in names], 0
        if types:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    rows = df.select(F.col(key).alias("doc_id"), F.col(release).cast("string").alias("release"), F.col(text)).filter(F.col(text).isNotNull())
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, release string, {ELEMENT}")


class Source(NamedTuple):
    """Where a column's values come from in some releases: field ``name``, whole or the ``index``-th value of an array of ``size``."""

    releases: tuple[str | None, ...]
    array: str
    name: str
    index: int | None = None
    size: int | None = None
    #: whether the field stands for something else in further releases of the array
    partial: bool = False


def element_catalogue(rows: DataFrame) -> DataFrame:
    """release, array, path ('' for the element itself), field, kind, n, pos: what elements() holds; pos is the mean place among the fields."""
    own = F.struct(F.lit("").alias("path"), "fields", "kinds")
    parts = F.transform("parts", lambda p: F.struct(p["path"].alias("path"), p["fields"].alias("fields"), p["kinds"].alias("kinds")))
    flat = rows.select("release", "array", F.explode(F.concat(F.array(own), parts)).alias("p")).select("release", "array", "p.path", "p.kinds", F.posexplode(F.map_entries("p.fields")).alias("i", "e"))
    flat = flat.select("release", "array", "path", F.col("e.key").alias("field"), F.substr("kinds", F.col("i") + 1, F.lit(1)).alias("kind"), "i")
    return flat.groupBy("release", "array", "path", "field", "kind").agg(F.count("*").alias("n"), F.avg("i").alias("pos"))


def element_columns(catalogue: DataFrame, sizes: dict[str, int], releases: list[str], aliases: Aliases, cat: DataFrame, least: float = LEAST_SHARE) -> dict[tuple[str, str], tuple[str, list[Source]]]:
    """(path, newest field) -> (column type, its sources): the casts that bring the elements of every release to one set of columns.

    Sources follow from the alias table.  The type is one that the values of all releases fit.  Where a scalar or an array
    of scalars of one release is an object in others, its values become those of the object's fields: the i-th value that of
    the i-th field, a single value that of the field of its kind whose values are most alike.  A field of fewer than
    ``least`` of the rows of its array and path has no column.
    """
    often = catalogue.groupBy("array", "path", "field").agg(F.sum("n").alias("n"))
    rows_of = catalogue.sparkSession.createDataFrame(list(sizes.items()) or [("", 0)], "array string, size long")
    often = often.join(rows_of, "array").filter(F.col("n") >= least * F.col("size")).select("array", "path", "field")
    facts = [tuple(r) for r in catalogue.join(often, ["array", "path", "field"]).select("release", "array", "path", "field", "kind", "n", "pos").orderBy("array", "path", "field", "release", "kind").collect()]
    kinds: dict[tuple[str, str], set] = {}
    places: dict[tuple[str, str], list] = {}
    sources: dict[tuple[str, str], dict[tuple[str, str], set]] = {}
    solid: dict[tuple[str, str], set] = {}  # releases and arrays in which a column has values
    for release, array, path, field, kind, n, pos in facts:
        column = canonical_field(array, path, field, release, releases, aliases)
        kinds.setdefault(column, set()).add(kind)
        places.setdefault(column, []).append((pos, n))
        sources.setdefault(column, {}).setdefault((array, field), set()).add(release)
        if kind not in ("0", "o"):
            solid.setdefault(column, set()).add((release, array))
    order = {c: sum(p * n for p, n in x) / sum(n for _, n in x) for c, x in places.items()}
    # what was a scalar or an array of scalars and is an object now
    moved: dict[tuple[str, str], list] = {}
    for path, field in sorted(kinds):
        inner = sorted((c for c in kinds if c[0] == path and c[1].startswith(field + ".") and "." not in c[1][len(field) + 1 :]), key=lambda c: order[c])
        found = kinds[path, field] - {"0", "o"}
        # in some releases the one, in others the other
        if not inner or not found or solid[path, field] & set().union(*(solid.get(c, set()) for c in inner)):
            continue
        if found == {"a"}:
            moved[path, field] = [(c, i) for i, c in enumerate(inner)]
        elif "a" not in found:
            alike = [c for c in inner if kinds[c] & found] or inner
            if len(alike) > 1:
                alike = [most_alike(cat, (path, field), alike, sources)]
            moved[path, field] = [(alike[0], None)]
    out: dict[tuple[str, str], tuple[str, list[Source]]] = {}
    lists = {p for p, _ in kinds}
    for column in sorted(kinds, key=lambda c: (c[0], order[c], c[1])):
        # an array that holds objects elsewhere is a list of these; where it is empty there is nothing to tell
        if column in moved or f"{column[0]}.{column[1]}[]".lstrip(".") in lists:
            continue
        held, used = [], set()
        for (a, f), r in sorted(sources[column].items(), key=lambda x: (x[0][1] != column[1], x[0])):
            # of two fields of one release that lead to one column, the one of its name is taken
            mine = {x for x in r if (x, a) not in used}
            used |= {(x, a) for x in r}
            held.append(Source(tuple(sorted(mine, key=str)), a, f, partial=mine != r))
        found = kinds[column] - {"0", "o"}
        for old, targets in moved.items():
            for target, i in targets:
                if target == column:
                    held += [Source(tuple(sorted(r, key=str)), a, f, i, len(targets)) for (a, f), r in sorted(sources[old].items())]
                    found |= kinds[old] - {"0", "o", "a"}
        out[column] = ("bigint" if found == {"i"} else "double" if found and found <= {"i", "n"} else "boolean" if found == {"b"} else "string", held)
    return out


def canonical_field(array: str, path: str, field: str, release: str | None, releases: list[str], aliases: Aliases) -> tuple[str, str]:
    """(path, field) of the newest release for a field of an element."""
    new_array = canonical(array[:-2], release, releases, aliases) + "[]" if array != "[]" else array
    base = array if new_array[:-2] in ARRAYS else LIKE
    newest = new_array if new_array[:-2] in ARRAYS else LIKE
    whole = canonical(f"{base}.{path}.{field}" if path else f"{base}.{field}", release, releases, aliases)
    inner = whole[len(newest) + 1 :] if whole.startswith(newest + ".") else whole
    at = inner.rfind("[].") + 2 if path and "[]." in inner else 0
    return inner[:at], inner[at + 1 :] if at else inner


def most_alike(cat: DataFrame, old: tuple[str, str], fields: list[tuple[str, str]], sources: dict) -> tuple[str, str]:
    """Of the fields of an object the one whose values resemble those of what the object replaced."""

    def profile(column: tuple[str, str]) -> Counter:
        paths = sorted({f"{array}.{column[0]}.{field}" if column[0] else f"{array}.{field}" for array, field in sources[column]})
        rows = cat.filter(F.col("path").isin(paths) & F.col("feature").isNotNull() & ~F.col("kind").isin("object", "array")).groupBy("feature").agg(F.sum("n").alias("n"))
        held = Counter({r["feature"]: r["n"] for r in rows.collect()})
        return Counter({f: n / sum(held.values()) for f, n in held.items()})

    before = profile(old)
    scores = [sum(min(before[f], q) for f, q in profile(c).items()) for c in fields]
    return fields[scores.index(max(scores))]


def unified_elements(rows: DataFrame, columns: dict[tuple[str, str], tuple[str, list[Source]]], releases: list[str], aliases: Aliases) -> DataFrame:
    """One row per layout element of every release: doc_id, release, array, ordinal, a column per field, ``rest`` and ``others``.

    ``array`` is the newest name of the array that holds the element.  A field is a column named by its path; objects of an
    array within elements are one column named by that array, a list of structs of their place in the element, their
    fields and their ``rest``.  ``rest`` and ``others`` have the fields and the inner objects that no column takes, so
    no value is lost.  Texts that are null or not complete JSON have no rows.
    """
    from quire.operators.nested import column_names

    def expression(fields: Column, path: str, field: str) -> Column:
        kind, held = columns[path, field]
        values = []
        for name, index, size, many in _by_name(path, held):
            value = F.try_element_at(fields, F.lit(name))
            if index is not None:
                many = many & fitting(path, name, size, value)
                value = F.get(scalars_of(value), F.lit(index))
            if many is not None:
                value = F.when(many, value)
            values.append(value)
        return F.coalesce(*values).try_cast(kind)

    def meanings(path: str) -> dict[tuple[str, int | None], int]:
        """How many columns of a path a name (and index) stands for."""
        return Counter((name, i) for (p, _), (_, held) in columns.items() if p == path for name, i in {(s.name, s.index) for s in held})

    meant = {path: meanings(path) for path in {p for p, _ in columns}}

    def fitting(path: str, name: str, size: int, value: Column) -> Column:
        """Whether an array has a value for each of the fields that take its values, and each is of its field's type."""
        values = scalars_of(value)
        takers = {i: kind for (p, _), (kind, held) in columns.items() if p == path for i in {s.index for s in held if s.name == name and s.index is not None}}
        casts = [F.get(values, F.lit(i)).isNull() | F.get(values, F.lit(i)).try_cast(kind).isNotNull() for i, kind in sorted(takers.items()) if kind != "string"]
        return F.coalesce(reduce(Column.__and__, casts, F.size(values) == size), F.lit(False))

    def _by_name(path: str, held: list[Source]):
        """(field name, index, size, condition on release and array) of a column's sources; no condition where the name means nothing else."""
        groups: dict[tuple[str, int | None], list[Source]] = {}
        for s in held:
            groups.setdefault((s.name, s.index), []).append(s)
        for key, some in sorted(groups.items(), key=str):
            yield *key, some[0].size, reduce(Column.__or__, [conditions(s) for s in some]) if ambiguous(path, key[0]) else None

    def ambiguous(path: str, name: str) -> bool:
        """Whether it depends on release, array or size what a name is read for."""
        uses = {i: n for (other, i), n in meant[path].items() if other == name}
        partial = any(s.partial for (p, _), (_, held) in columns.items() if p == path for s in held if s.name == name)
        return partial or any(n > 1 for n in uses.values()) or any(i is not None for i in uses)

    def scalars_of(value: Column) -> Column:
        return F.from_json(value, "array<string>")

    def conditions(s: Source) -> Column:
        named = [r for r in s.releases if r is not None]
        listed = F.col("release").isin(named) if named else F.lit(False)
        return (F.col("holder") == s.array) & (listed | (F.col("release").isNull() if None in s.releases else F.lit(False)))

    def rest(fields: Column, path: str) -> Column:
        held = [s for (p, _), (_, some) in columns.items() if p == path for s in some]
        always = sorted({s.name for s in held if not ambiguous(path, s.name)})
        sometimes = [s for s in held if ambiguous(path, s.name)]

        def kept(k: Column, v: Column) -> Column:
            gone = k.isin(always) if always else F.lit(False)
            for s in sometimes:
                fits = F.lit(True) if s.index is None else fitting(path, s.name, s.size, v)
                gone = gone | ((k == s.name) & F.coalesce(conditions(s) & fits, F.lit(False)))
            return v.isNotNull() & ~v.isin("[]", "{}") & ~gone

        return F.map_filter(fields, kept)

    arrays = {(r, a): canonical(a[:-2], r, releases, aliases) for r in [None, *releases] for a in PLACES if a != "[]"}
    # another name, since a lambda would take the new column of the old name
    rows = rows.withColumnRenamed("array", "holder")
    array = F.col("holder")
    newest = F.when(array == "[]", "[]")
    for (r, a), name in arrays.items():
        if name != a[:-2]:
            newest = newest.when((F.col("release") == r) & (array == a), name)
    newest = newest.otherwise(F.substring(array, 1, F.length(array) - 2))
    paths = sorted({p for p, _ in columns if p})

    def entries(path: str) -> Column:
        """The inner objects of one array as structs."""
        fields = column_names([f for p, f in columns if p == path], ("at", "rest"))
        named = sorted({path, *_old_paths(path, releases, aliases)})
        some = F.filter("parts", lambda p: p["path"].isin(named))
        return F.transform(some, lambda p: F.struct(p["at"].alias("at"), *[expression(p["fields"], path, f).alias(n) for f, n in fields.items()], rest(p["fields"], path).alias("rest")))

    # names of a path's fields in the order of the catalogue
    names = column_names([f for p, f in columns if not p] + [p[:-2] for p in paths], ("doc_id", "release", "array", "ordinal", "rest", "others"))
    own = [expression(F.col("fields"), *c).alias(names[c[1]]) for c in columns if not c[0]]
    inner = []
    for path in paths:
        inner.append(entries(path).alias(names[path[:-2]]))
    known = sorted({old for path in paths for old in (path, *_old_paths(path, releases, aliases))})
    others = F.transform(F.filter("parts", lambda p: ~p["path"].isin(known)) if known else F.col("parts"), lambda p: F.struct(p["path"].alias("path"), p["at"].alias("at"), p["fields"].alias("fields")))
    return rows.select("doc_id", "release", newest.alias("array"), "ordinal", *own, *inner, rest(F.col("fields"), "").alias("rest"), others.alias("others"))


def _old_paths(path: str, releases: list[str], aliases: Aliases) -> list[str]:
    """Names that the array ``path`` within an element had in earlier releases."""
    out = {path}
    for _, old, new in reversed(aliases):
        (a, _, x), (b, _, y) = old.partition("[]."), new.partition("[].")
        if x and y and a.split(".")[0] in (*ARRAYS, "elements") and b:
            out |= {x + p[len(y) :] for p in out if p == y or p.startswith((y + "[", y + "."))}
    return sorted(out - {path})


def layout_changes(spark, sf_dir: str) -> DataFrame:
    from quire.operators.nested import layout_documents

    docs = layout_documents(spark, sf_dir, "parser_version")
    return changes(materialize(catalogue(docs, "parser_version", "docling_json")))


def layout_elements(spark, sf_dir: str) -> DataFrame:
    from quire.operators.nested import layout_documents

    docs = layout_documents(spark, sf_dir, "parser_version")
    return element_table(docs, "doc_id", "parser_version", "docling_json")


def element_table(docs: DataFrame, key: str, release: str, text: str, least: float = LEAST_SHARE) -> DataFrame:
    """The whole way: catalogue, changes, aliases, generated casts and the one table of unified_elements()."""
    cat = materialize(catalogue(docs, release, text))
    releases = [r[0] for r in cat.select("release").distinct().orderBy(release_order(F.col("release")), "release").collect()]
    aliases = all_aliases(cat, releases)
    olds = {f"{old}[]" for _, old, new in aliases if new in ARRAYS}
    rows = materialize(elements(docs, key, release, text, sorted({*PLACES, *olds})))
    sizes = {r["array"]: r["n"] for r in rows.groupBy("array").agg(F.count("*").alias("n")).collect()}
    columns = element_columns(materialize(element_catalogue(rows)), sizes, releases, aliases, cat, least)
    return unified_elements(rows, columns, releases, aliases)


def layout_lifespans(spark, sf_dir: str) -> DataFrame:
    from quire.operators.nested import layout_documents

    docs = layout_documents(spark, sf_dir, "parser_version")
    return lifespans(materialize(catalogue(docs, "parser_version", "docling_json"))).select("path", "kind", "first", "last")
