from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.functions import semantics as sm
from clientele.operators import rank
from clientele.operators import segments as sg


def one(df, column):
    return df.select(column.alias("v")).first()["v"]


def test_floor_days(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 00:00' a, TIMESTAMP_NTZ'2024-01-02 12:00' b, "
                   "TIMESTAMP_NTZ'2024-01-02 01:00' c, TIMESTAMP_NTZ'2024-01-01 23:00' d")
    assert one(df, sm.floor_days(F.col("a"), F.col("b"))) == -1
    assert one(df, sm.floor_days(F.col("c"), F.col("d"))) == 0


def test_mode_and_ratio(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 2), (None, 9)], "v string, n long")
    assert df.agg(sm.smallest_mode(F.col("v"), F.col("n")).alias("m")).first()["m"] == "a"
    empty = df.filter("v is null").agg(F.coalesce(sm.smallest_mode(F.col("v"), F.col("n")), F.lit("unknown")).alias("m"))
    assert empty.first()["m"] == "unknown"
    assert one(spark.range(1), sm.ratio(F.lit(1), F.lit(0))) is None


@pytest.mark.parametrize("values", [[5], [3, 3, 3], [100000001, 100000002, 100000003], [1, 2, 2, 9, 40]])
def test_exact_stddev(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    row = df.agg(sm.exact_stddev(F.count("v"), F.sum("v"), F.sum(F.col("v") * F.col("v"))).alias("a"),
                 F.stddev_samp("v").alias("b")).first()
    assert row.a == (pytest.approx(row.b, rel=1e-12) if row.b is not None else None)
    if len(values) == 3 and len(set(values)) == 1:
        assert row.a == 0.0


def cells(spark):
    return spark.createDataFrame(list(product(range(1, 6), repeat=3)), "r int, f int, m int")


def test_marketing_truth_table(spark):
    names = cells(spark).select(sg.marketing_segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert Counter(r.s for r in names) == {
        "At Risk": 38, "Loyal Customers": 22, "Potential Loyalists": 16, "Recent Customers": 10, "Champions": 8,
        "Price Sensitive": 8, "Hibernating": 7, "About to Sleep": 3, "Need Attention": 3, "Promising": 8, "Lost": 2}


def test_exploration_truth_table(spark):
    names = cells(spark).select(sg.exploration_segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert Counter(r.s for r in names) == {
        "Loyal Customers": 22, "Need Attention": 22, "At Risk": 20, "New Customers": 20, "Hibernating": 16,
        "Potential Loyalists": 9, "Champions": 8, "Lost": 8}


@pytest.mark.parametrize("n,expected,reverse", [
    (7, [1, 1, 2, 3, 4, 5, 5], False), (6, [1, 1, 2, 3, 4, 5], False), (6, [5, 4, 3, 2, 1, 1], True), (1, [1], False)])
def test_quintiles(spark, n, expected, reverse):
    df = spark.createDataFrame([(i, 10) for i in range(n)], "id long, x long").repartition(3)  # all values tied
    cuts = rank.quintile_cuts(df, "id", ["x"], ("x",) if reverse else ())
    got = df.select("id", rank.quintile_score("x", "id", cuts["x"], reverse).alias("s")).orderBy("id").collect()
    assert [r.s for r in got] == expected


def test_tied_recency_edges(spark):
    df = spark.createDataFrame([(i, r, 1, 1) for i, r in enumerate([1, 1, 1, 1, 2, 3])],
                               "customer_unique_id long, recency long, frequency long, monetary long")
    with pytest.raises(ValueError):
        sg.exploration_rfm_scores(df)
    assert sg.exploration_rfm_scores(df, on_tied_edges="rank").count() == 6


def test_global_rank_and_quantiles(spark):
    rows = [(i, float((i * 37) % 50), None if i % 7 == 0 else float(i % 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, x double, y double").repartition(6)
    ranked = rank.global_rank(df, ["x", "id"]).collect()
    want = {r[0]: k for k, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), 1)}
    assert {r.id: r["rank"] for r in ranked} == want
    p = [0.0, 0.25, 0.5, 0.77, 1.0]
    sliced = rank.exact_quantiles(df, ["x", "y"], p)
    for i, c in ((1, "x"), (2, "y")):
        assert sliced[c] == pytest.approx(list(np.quantile([r[i] for r in rows if r[i] is not None], p)))
    small = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert rank.exact_quantiles(small, ["v"], [0.25, 0.5, 0.75])["v"] == [1.75, 2.5, 4.75]
