"""Queries by name, with the SQL that each is held against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def same_rounding(sql: str) -> str:
    """Every round(x, n) as the arithmetic that functions.clean.half_up does, in SQL: the engines' own functions differ in the
    last bit of a tie."""
    out, at = "", 0
    for m in re.finditer(r"\bround\(", sql):
        if m.start() < at:
            continue
        depth, i, comma = 1, m.end(), -1
        while depth:
            depth += (sql[i] == "(") - (sql[i] == ")")
            comma = i if sql[i] == "," and depth == 1 else comma
            i += 1
        x, n = same_rounding(sql[m.end() : comma]), sql[comma + 1 : i - 1].strip()
        out += sql[at : m.start()] + f"(floor(({x}) * 1e{n} + 0.5) / 1e{n})"
        at = i
    return out + sql[at:]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is there twice")
        QUERIES[name] = f
        if sql:
            SQL[name] = same_rounding(sql)
        return f

    return add
