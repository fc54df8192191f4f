"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.session import truncate


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(*ids: str) -> list[F.Column]:
    """Ids as text: next to nulls, pandas would hold them as floats, which blurs ids beyond 2^53."""
    return [F.col(c).cast("string").alias(c) for c in ids]


def with_long(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("long"))


def map_texts(df: DataFrame, columns: list[str | F.Column], schema: str,
              row: Callable[..., tuple]) -> DataFrame:
    """``row`` applied to the named columns of each row, in Arrow batches.

    Only the named columns leave the JVM, so other columns may have any name.
    """
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [row(*values) for values in zip(*(frame[c] for c in frame.columns))]
            yield pd.DataFrame(out, columns=names, dtype=object)

    return df.select(*columns).mapInPandas(batches, schema)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (node, component), the
    component being its smallest node. Only nodes with an edge appear.

    Alternating star rounds on tables: each node points to the smallest
    neighbour it knows, until every tree is a star. A node with very many
    neighbours is an aggregated minimum and a join that adaptive execution can
    split; no list of neighbours is ever built.
    """
    e = truncate(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while not _all_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = truncate(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                         .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = truncate(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    roots = e.select(F.col("v").alias("node")).distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))


def _all_stars(e: DataFrame) -> bool:
    sides = e.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    odd = sides.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return odd.where("up > 1 or (up = 1 and down = 1)").limit(1).count() == 0
