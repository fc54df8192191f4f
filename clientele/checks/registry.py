"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clientele.sources.tables import RetailTables, derive_retail

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# The two engines round exact halves differently. Both sides are moved off the
# half by far less than the digits that are compared.
NUDGE = 1e-9


def _calls(sql: str, function: str):
    """Start, comma and end of each ``function(x, n)`` call, innermost last."""
    at = sql.find(function + "(")
    while at >= 0:
        depth, comma, i = 0, None, at + len(function)
        while True:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            if sql[i] == "," and depth == 1:
                comma = i
            if depth == 0:
                break
            i += 1
        yield at, comma, i
        at = sql.find(function + "(", at + 1)


def without_rounding(sql: str) -> str:
    """The SQL with every ``round(x, n)`` replaced by ``x``."""
    while found := next(_calls(sql, "round"), None):
        start, comma, end = found
        sql = sql[:start] + "(" + sql[start + 6:comma] + ")" + sql[end + 1:]
    return sql


def away_from_ties(sql: str) -> str:
    for start, comma, end in sorted(_calls(sql, "round"), reverse=True):
        x = sql[start + 6:comma]
        sql = f"{sql[:start]}round(({x}) + sign({x}) * {NUDGE}{sql[comma:]}"
    return sql


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = away_from_ties(sql)
        return fn
    return register


def retail(name: str, sql: str | None = None):
    """Register ``fn(tables)`` over the retail tables of the sample data."""
    def register(fn):
        query(name, sql)(lambda spark, sf_dir: fn(derive_retail(spark, sf_dir)))
        return fn
    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles and decimals as rounded doubles, integers as long."""
    from pyspark.sql import functions as F

    columns = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        c = F.col(f"`{field.name}`")
        if kind in ("double", "float", "decimal"):
            c = c.cast("double")
            c = F.round(c + F.signum(c) * NUDGE, digits)
        elif kind in ("integer", "short", "byte"):
            c = c.cast("long")
        columns.append(c.alias(field.name))
    return df.select(*columns)


__all__ = ["QUERIES", "ORACLES", "RetailTables", "query", "retail", "rounded"]
