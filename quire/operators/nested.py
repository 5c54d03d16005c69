"""Deeply nested records as flat tables with links between parent and child.

Each record is read as a stream of tokens, without building its tree, into triples of path, ordinal and value.
Paths are grouped by their repeated ancestor, the innermost object that is an element of an array, and each group
of triples becomes one row: the fields of that object and of the plain objects inside it.  A record's triples come
one after the other, so the grouping needs no shuffle.  Rows of one kind share their ``table_path``; the catalogue of
fields and types says which columns the flat table of each path has, and ``flat_table`` pivots its rows into them.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.jsontext import OPEN, RETRACT, SAME, triples
from quire.plans.materialize import spread

#: Rows and fields of a batch that goes back to the JVM.
CELLS = 100_000
#: A field of fewer of a table's rows than this share has no column of its own and stays in ``rest``.
LEAST_SHARE = 0.001
#: Letters for the types of values in ``kinds``, and the column type of fields of one type.
KINDS = {"i": "bigint", "n": "double", "b": "boolean", "s": "string", "a": "string", "o": "string", "0": "string"}


class _Rows:
    """Columns of the rows to send, filled record by record."""

    def __init__(self, key_type: pa.DataType):
        self.key_type = key_type
        self.clear()

    def clear(self) -> None:
        self.keys: list = []
        self.tables: list = []
        self.places: list = []
        self.parents: list = []
        self.ordinals: list = []
        self.kinds: list = []
        self.offsets = [0]
        self.names: list = []
        self.values: list = []

    def add(self, key, text: str | None) -> bool:
        """Pivots the triples of one record into a row per repeated object; False if the text is not complete JSON."""
        rows: dict[str, tuple] = {}
        owner = held = None
        try:
            for table, place, field, ordinal, kind, value in triples(text):
                if place is not owner:
                    owner, held = place, rows.get(place)
                if kind == OPEN:
                    owner, held = place, (table, value, ordinal, {})
                    rows[place] = held
                elif kind == RETRACT:
                    self.retract(rows, place, field, value)
                    owner, held = place, rows[place]
                else:
                    while field in held[3]:  # the path of another field reads the same
                        field += SAME
                    held[3][field] = (kind, value)
        except ValueError:
            return False
        for place, (table, parent, ordinal, fields) in rows.items():
            self.keys.append(key)
            self.tables.append(table)
            self.places.append(place)
            self.parents.append(parent)
            self.ordinals.append(ordinal)
            self.names.extend(fields)
            kinds, values = zip(*fields.values(), strict=True) if fields else ((), ())
            self.kinds.append("".join(kinds))
            self.values.extend(values)
            self.offsets.append(len(self.names))
        return True

    @staticmethod
    def retract(rows: dict, place: str, field: str, member: str) -> None:
        """A key that is repeated in its object: what its earlier value gave is taken back."""
        for p in [p for p in rows if p.startswith(member + "/")]:
            del rows[p]
        held = rows[place][3]
        for f in [f for f in held if f == field or f.startswith((field + ".", field + "[", field + SAME))]:
            del held[f]

    def batch(self) -> pa.RecordBatch:
        fields = pa.MapArray.from_arrays(pa.array(self.offsets, pa.int32()), pa.array(self.names, pa.string()), pa.array(self.values, pa.string()))
        columns = [pa.array(self.keys, self.key_type), *(pa.array(c, pa.string()) for c in (self.tables, self.places, self.parents)), pa.array(self.ordinals, pa.int32()), fields, pa.array(self.kinds, pa.string())]
        out = pa.RecordBatch.from_arrays(columns, names=["doc_id", "table_path", "child_path", "parent_path", "ordinal", "fields", "kinds"])
        self.clear()
        return out


def flatten(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per record and per object that is an element of an array, at any depth.

    ``child_path`` is the object's JSON pointer ('' for the record itself), ``parent_path`` that of the innermost
    such object around it ('' for the record, null for the record's own row), ``table_path`` the pointer without
    ordinals, ``ordinal`` its place in the array, ``fields`` its fields as text, ``kinds`` a letter for the type of
    each (see KINDS).  An array of scalars is one field, its JSON as written; an empty object or array is a field, too.
    Of a key repeated within an object the last value counts.  Texts that are null or not complete JSON have no rows;
    rows repeated in the input are repeated here; ``doc_id`` has the type of ``key``.
    """
    kept = df.schema[key].dataType

    def run(batches):
        rows = None
        for batch in batches:
            rows = rows or _Rows(batch.schema.field(0).type)
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows.add(doc, body.as_py())
                if len(rows.keys) + len(rows.names) >= CELLS:
                    yield rows.batch()
        if rows is not None:
            yield rows.batch()

    schema = f"doc_id {kept.simpleString()}, table_path string, child_path string, parent_path string, ordinal int, fields map<string,string>, kinds string"
    return df.select(F.col(key), F.col(text)).filter(F.col(text).isNotNull()).mapInArrow(run, schema)


def table(nodes: DataFrame, table_path: str, columns: dict[str, str]) -> DataFrame:
    """One flat table of flatten(): doc_id, child_path, parent_path, ordinal and the named fields in their types.

    A field that a record lacks, or that does not fit its type, is null.
    """
    typed = [F.try_element_at("fields", F.lit(name)).try_cast(kind).alias(name.replace(".", "_")) for name, kind in columns.items()]
    return nodes.filter(F.col("table_path") == table_path).select("doc_id", "child_path", "parent_path", "ordinal", *typed)


def table_fields(nodes: DataFrame) -> DataFrame:
    """table_path, field, kind, n_values: the catalogue of what each table holds; nulls and empty texts have the kinds '0' and 's'.

    It grows with the names of fields, not with the rows.
    """
    at = F.posexplode(F.map_entries("fields")).alias("pos", "e")
    fields = nodes.select("table_path", "kinds", at).select("table_path", F.col("e.key").alias("field"), F.substr("kinds", F.col("pos") + 1, F.lit(1)).alias("kind"))
    return fields.groupBy("table_path", "field", "kind").agg(F.count("*").alias("n_values"))


def column_plan(catalogue: DataFrame, sizes: DataFrame, least: float = LEAST_SHARE) -> dict[str, dict[str, str]]:
    """table_path -> field -> column type, from table_fields() and the rows of each table (table_path, n_rows).

    Fields of fewer than ``least`` of a table's rows have no column, so there are at most (fields of a row) / least
    columns, however many names objects used as dictionaries bring.
    """
    kinds = catalogue.groupBy("table_path", "field").agg(F.array_sort(F.collect_set(F.when(F.col("kind") != "0", F.col("kind")))).alias("kinds"), F.sum("n_values").alias("n"))
    often = kinds.join(sizes, "table_path").filter(F.col("n") >= least * F.col("n_rows")).select("table_path", "field", "kinds")
    plan: dict[str, dict[str, str]] = {}
    for path, field, found in sorted(map(tuple, often.collect())):
        kind = KINDS[found[0]] if len(found) == 1 else "double" if found == ["i", "n"] else "string"
        plan.setdefault(path, {})[field] = kind
    return plan


def column_names(fields: list[str], taken: tuple[str, ...] = ("doc_id", "child_path", "parent_path", "ordinal", "rest")) -> dict[str, str]:
    """Names of columns for field paths: '_' for every other sign, with a number where two would be the same in any case."""
    out: dict[str, str] = {}
    used = {*taken}
    for field in fields:
        base = "".join(c if c.isalnum() else "_" for c in field) or "_"
        name, n = base, 2
        while name.lower() in used:
            name, n = f"{base}_{n}", n + 1
        used.add(name.lower())
        out[field] = name
    return out


def flat_table(nodes: DataFrame, table_path: str, columns: dict[str, str]) -> DataFrame:
    """The flat table of one path of column_plan(): doc_id, child_path, parent_path, ordinal, a typed column per field and ``rest``.

    ``rest`` has the fields that no column takes.
    """
    names = column_names(list(columns))
    typed = [F.try_element_at("fields", F.lit(f)).try_cast(kind).alias(names[f]) for f, kind in columns.items()]
    rest = F.map_filter("fields", lambda k, v: ~k.isin(list(columns))) if columns else F.col("fields")
    return nodes.filter(F.col("table_path") == table_path).select("doc_id", "child_path", "parent_path", "ordinal", *typed, rest.alias("rest"))


def flat_tables(nodes: DataFrame, least: float = LEAST_SHARE) -> dict[str, DataFrame]:
    """All flat tables of flatten() by path; doc_id and parent_path of a row lead to the row around it in the table above."""
    plan = column_plan(table_fields(nodes), nodes.groupBy("table_path").agg(F.count("*").alias("n_rows")), least)
    return {path: flat_table(nodes, path, columns) for path, columns in plan.items()}


def links(tables: dict[str, DataFrame]) -> DataFrame:
    """doc_id, parent_path, child_path of all rows of all flat tables but the records themselves."""
    return reduce(DataFrame.unionByName, [t.select("doc_id", "parent_path", "child_path").filter("child_path <> ''") for t in tables.values()])


def layout_documents(spark, sf_dir: str, *more: str) -> DataFrame:
    from quire.sources.tables import read_table

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "docling_json", *more).filter(F.col("docling_json").isNotNull())
    return spread(docs)
