"""Rows of a Spark query against rows of SQL, in any order."""

import math


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{round(float(value), 5):g}"
    if hasattr(value, "as_tuple"):
        return f"{round(float(value), 5):g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def assert_same(spark_df, relation):
    assert sorted(spark_df.columns) == sorted(relation.columns)
    assert rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()]) == rows_of(relation.columns, relation.fetchall())
