"""Where queries are entered together with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def enter(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"{name} is entered twice")
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return enter


#: White space in the regular expressions of the checking SQL; Unicode's, and with Python's separators.
SQL_WS = r"\x{09}-\x{0d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SQL_PY_WS = SQL_WS + r"\x{1c}-\x{1f}"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A[{SQL_PY_WS}]+|[{SQL_PY_WS}]+\z', '', 'g')"


def sql_tokens(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{SQL_WS}]+'))"
