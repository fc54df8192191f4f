"""Checks of the declared constraints; each returns the violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.sources.schema import Table


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("count")).filter("count > 1")


def missing_required(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing) for required columns, in one pass."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("missing")) for c in columns
    ])
    return df.agg(cells.alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def orphans(child: DataFrame, columns: list[str], parent: DataFrame, parent_columns: list[str]) -> DataFrame:
    """Child rows whose complete reference has no parent row.

    Both sides are reduced to distinct keys first; a popular missing key is
    looked up once, and comes back with the number of its rows.
    """
    keys = child.dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias("count"))
    known = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns)]).distinct()
    return keys.join(known, columns, "left_anti")


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(~F.col(column).between(low, high))


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(column, count) of texts longer than declared, in one pass."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.count_if(F.length(c) > n).alias("count")) for c, n in limits.items()
    ])
    return df.agg(cells.alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def misfit_decimals(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(column, count) of values that do not fit the declared decimal type."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(k).isNull()).alias("count"))
        for c, k in kinds.items()
    ])
    return df.agg(cells.alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def check_table(df: DataFrame, table: Table, parents: dict[str, DataFrame]) -> DataFrame:
    """(table, rule, detail, count) of all broken rules of one table."""
    found = []

    def add(frame: DataFrame, rule: str, detail, count: str) -> None:
        found.append(frame.select(F.lit(table.name).alias("table"), F.lit(rule).alias("rule"),
                                  detail.alias("detail"), F.col(count).cast("long").alias("count")))

    if table.key:
        extra = duplicate_keys(df, list(table.key)).agg(F.count("*").alias("count"))
        add(extra, "primary_key", F.lit(",".join(table.key)), "count")
    required = [f.name for f in table.fields if f.required and f.name in df.columns]
    if required:
        add(missing_required(df, required), "not_null", F.col("column"), "missing")
    lengths = {f.name: f.length for f in table.fields if f.length and f.name in df.columns}
    if lengths:
        add(too_long(df, lengths), "length", F.col("column"), "count")
    for column, low, high in table.ranges:
        add(out_of_range(df, column, low, high).agg(F.count("*").alias("count")), "range", F.lit(column), "count")
    for key in table.foreign_keys:
        if key.parent in parents:
            missing = orphans(df, list(key.columns), parents[key.parent], list(key.parent_columns))
            add(missing.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count")), "foreign_key",
                F.lit(f"{','.join(key.columns)} -> {key.parent}"), "count")
    result = found[0]
    for frame in found[1:]:
        result = result.unionByName(frame)
    return result.filter("count > 0")


def term_index(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Inverted index (term, id, tf) of lower-cased words and numbers."""
    words = F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+", " ")), " ")
    return (
        df.select(F.col(id_col), F.explode(words).alias("term")).filter("term <> ''")
        .groupBy("term", id_col).agg(F.count("*").alias("tf"))
    )


def filled_columns(tables: dict) -> DataFrame:
    """(table, column, declared, present, filled, rows) of every declared column of {name: (frame, declaration)}.

    ``filled`` counts the values of a column, null if the frame has no such
    column. Each table is read once.
    """
    result = None
    for name, (df, declared) in tables.items():
        counts = df.agg(F.count("*").alias("rows"), F.array(*[
            F.struct(
                F.lit(f.name).alias("column"), F.lit(f.kind).alias("declared"), F.lit(f.name in df.columns).alias("present"),
                (F.count(f.name) if f.name in df.columns else F.lit(None)).cast("long").alias("filled"))
            for f in declared.fields]).alias("c"))
        part = counts.select(F.lit(name).alias("table"), "rows", F.inline("c"))
        result = part if result is None else result.unionByName(part)
    return result
