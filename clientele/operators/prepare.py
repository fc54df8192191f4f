"""Encoding, imputation and scaling of customer features.

Each step is a *fit*, which returns a small parameter table, and an *apply*,
which uses it. Parameter tables are ordinary frames and can be saved as
Parquet and applied to other customers later.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.semantics import ratio
from clientele.operators.rank import exact_quantiles, global_rank
from clientele.session import truncate

CATEGORICAL = ["favorite_category", "primary_payment_method", "preferred_time_of_day", "state", "region"]

# The features used for clustering, in order.
CLUSTERING_FEATURES = [
    "recency", "frequency", "monetary", "avg_order_value", "avg_items_per_order", "tenure_days",
    "purchase_frequency_monthly", "distinct_categories", "category_concentration", "distinct_products",
    "avg_item_price", "price_std", "max_item_price", "freight_ratio", "distinct_sellers",
    "payment_method_diversity", "avg_installments", "credit_card_rate", "avg_review_score", "review_rate",
    "text_review_rate", "sentiment_ratio", "weekend_shopping_rate", "avg_delivery_days", "is_major_city",
    "region_freq",
]

# What replaces a missing feature; "median" is that of the column.
FILL_VALUES = {
    "avg_inter_purchase_days": "median", "avg_review_score": 0, "review_score_std": 0, "avg_review_length": 0,
    "sentiment_ratio": 0, "avg_delivery_days": "median", "avg_delivery_delay": 0, "category_concentration": 1,
    "price_std": 0, "avg_product_weight": "median", "avg_product_photos": "median",
}
MISSING_CLASS = "unknown"

# One fitting pass evaluates this many exponents per column; an optimum farther out than the largest bracket is its end.
POWER_STEPS = 7
LARGEST_BRACKET = 4096


def present(names: list[str], df: DataFrame) -> list[str]:
    """The names that are columns of ``df``, in the given order."""
    return [n for n in names if n in df.columns]


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Names of the numeric or of the text columns."""
    wanted = {"numeric": T.NumericType, "text": T.StringType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


# ---- encoding -----------------------------------------------------------------

def fit_encoding(df: DataFrame, columns: list[str] = CATEGORICAL) -> DataFrame:
    """Classes per column: (column, class, code, freq).

    ``code`` numbers the classes in text order with missing values as
    'unknown'; ``freq`` is the share among non-missing values (null for
    'unknown' unless it really occurs). All columns are counted in one pass.
    """
    columns = present(columns, df)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    counts = df.select(pairs.alias("p")).select("p.*").groupBy("column", "value").agg(F.count("*").alias("n"))
    totals = Window.partitionBy("column")
    share = ratio(F.col("n"), F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).over(totals))
    classes = (
        counts.withColumn("freq", F.when(F.col("value").isNotNull(), share))
        .groupBy("column", F.coalesce("value", F.lit(MISSING_CLASS)).alias("class"))
        .agg(F.max("freq").alias("freq"))
    )
    ranked = global_rank(classes, ["column", "class"])
    first = ranked.groupBy("column").agg(F.min("rank").alias("first"))  # one row per column
    return truncate(ranked.join(F.broadcast(first), "column").select(
        "column", "class", (F.col("rank") - F.col("first")).alias("code"), "freq"
    ))  # as a table it has a known size, so the look-ups need not move the customers


def apply_encoding(df: DataFrame, encoding: DataFrame, columns: list[str] = CATEGORICAL) -> DataFrame:
    """Add ``<column>_freq`` and ``<column>_encoded`` by look-up; the join strategy follows the measured sizes."""
    for c in present(columns, df):
        table = encoding.filter(F.col("column") == c).select(
            F.col("class").alias("_class"), F.col("code").alias(f"{c}_encoded"), F.col("freq").alias("_freq")
        )
        df = (
            df.withColumn("_key", F.coalesce(c, F.lit(MISSING_CLASS)))
            .join(table, F.col("_key") == F.col("_class"), "left")
            .withColumn(f"{c}_freq", F.when(F.col(c).isNotNull(), F.col("_freq")))
            .drop("_key", "_class", "_freq")
        )
    return df


def encode(df: DataFrame, columns: list[str] = CATEGORICAL) -> DataFrame:
    """Encoded rows as a table, since later steps read them in many passes."""
    return truncate(apply_encoding(df, fit_encoding(df, columns), columns))


# ---- missing values -------------------------------------------------------------

def missing_report(df: DataFrame) -> DataFrame:
    """(column, missing) for the columns that have missing values."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]))
    return counts.select(rows.alias("r")).select("r.*").filter("missing > 0")


def fit_imputation(df: DataFrame, skip: tuple[str, ...] = ("customer_unique_id",)) -> DataFrame:
    """(column, number, text): the replacement of each column."""
    numeric = [c for c in columns_of_kind(df, "numeric") if c not in skip]
    text = [c for c in columns_of_kind(df, "text") if c not in skip]
    by_median = [c for c in numeric if FILL_VALUES.get(c, "median") == "median"]
    medians = exact_quantiles(df, by_median, [0.5]) if by_median else {}
    rows = [(c, medians[c][0] if c in medians else float(FILL_VALUES[c]), None) for c in numeric]
    rows += [(c, None, MISSING_CLASS) for c in text]
    return df.sparkSession.createDataFrame(rows, "column string, number double, text string")


def apply_imputation(df: DataFrame, imputation: DataFrame) -> DataFrame:
    """Replace missing values; a column without any value stays missing."""
    fills = {}
    for row in imputation.collect():  # one row per column
        value = row.text if row.text is not None else row.number
        if row.column in df.columns and value is not None:
            kind = df.schema[row.column].dataType
            if isinstance(kind, T.IntegralType) and row.text is None and value != int(value):
                kind = T.DoubleType()
            fills[row.column] = F.coalesce(F.col(row.column).cast(kind), F.lit(value).cast(kind))
    return df.withColumns(fills)


def impute(df: DataFrame) -> DataFrame:
    return apply_imputation(df, fit_imputation(df))


# ---- scaling --------------------------------------------------------------------

_SCALING = "column string, position int, lambda double, center double, scale double"


def fit_scaling(df: DataFrame, columns: list[str], method: str = "robust") -> DataFrame:
    """(column, position, lambda, center, scale) for 'robust', 'standard' or 'power'.

    A column without spread keeps scale 1.
    """
    if method == "robust":
        quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        rows = [(c, i, None, q[1], None if q[0] is None else (q[2] - q[0]) or 1.0)
                for i, (c, q) in enumerate(quartiles.items())]
    elif method == "standard":
        rows = _moments(df, {c: F.col(c).cast("double") for c in columns}, {})
    elif method == "power":
        exponents = fit_power(df, columns)
        rows = _moments(df, {c: yeo_johnson(F.col(c).cast("double"), F.lit(exponents[c])) for c in columns}, exponents)
    else:
        raise ValueError(f"unknown scaling method: {method!r}")
    return df.sparkSession.createDataFrame(rows, _SCALING)


def _moments(df: DataFrame, values: dict[str, Column], exponents: dict[str, float]) -> list[tuple]:
    row = df.agg(*[F.struct(F.avg(v).alias("m"), F.stddev_pop(v).alias("s")).alias(c) for c, v in values.items()]).first()
    return [(c, i, exponents.get(c), row[c].m, row[c].s or 1.0) for i, c in enumerate(values)]


def apply_scaling(df: DataFrame, scaling: DataFrame) -> DataFrame:
    """Scale the listed columns in place, as doubles."""
    scaled = {}
    for row in scaling.collect():  # one row per column
        value = F.col(row.column).cast("double")
        if row["lambda"] is not None:
            value = yeo_johnson(value, F.lit(row["lambda"]))
        scaled[row.column] = (value - F.lit(row.center)) / F.lit(row.scale)
    return df.withColumns(scaled)


def scale(df: DataFrame, columns: list[str], method: str = "robust") -> DataFrame:
    return apply_scaling(df, fit_scaling(df, columns, method))


def yeo_johnson(x: Column, exponent: Column) -> Column:
    """The Yeo-Johnson power transform (Yeo and Johnson, 2000)."""
    mirrored = F.lit(2.0) - exponent
    # try_divide keeps the branch that is not taken from failing on a zero divisor.
    positive = F.when(F.abs(exponent) < 1e-12, F.log1p(x)).otherwise(F.try_divide(F.pow(x + 1, exponent) - 1, exponent))
    negative = F.when(F.abs(mirrored) < 1e-12, -F.log1p(-x)).otherwise(
        F.try_divide(1 - F.pow(1 - x, mirrored), mirrored))
    return F.when(x >= 0, positive).otherwise(negative)


def fit_power(df: DataFrame, columns: list[str], low: float = -2.0, high: float = 2.0, rounds: int = 7) -> dict[str, float]:
    """Exponent of largest likelihood per column.

    A round evaluates ``POWER_STEPS`` exponents of every column in one scan. A
    bracket whose best exponent is its end is moved there and doubled, any other
    one shrinks to the neighbours of the best; the last three points are joined
    by a parabola. A column without spread gets 1.
    """
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    brackets = {i: (low, high, 0) for i in range(len(columns))}
    best: dict[int, float] = {}
    while open_ := [i for i in range(len(columns)) if i not in best]:
        grid = {i: [a + (b - a) * k / (POWER_STEPS - 1) for k in range(POWER_STEPS)] for i, (a, b, _) in brackets.items() if i in open_}
        found = _power_likelihoods(values, grid)
        for i in open_:
            a, b, shrunk = brackets[i]
            likelihood = [found.get((i, k), -math.inf) for k in range(POWER_STEPS)]
            k = likelihood.index(max(likelihood))
            if likelihood[k] == -math.inf:
                best[i] = 1.0
            elif k in (0, POWER_STEPS - 1) and b - a < LARGEST_BRACKET:
                brackets[i] = (grid[i][k] - (b - a), grid[i][k] + (b - a), shrunk)
            elif shrunk + 1 < rounds:
                brackets[i] = (grid[i][max(k - 1, 0)], grid[i][min(k + 1, POWER_STEPS - 1)], shrunk + 1)
            else:
                best[i] = _vertex(grid[i], likelihood, k)
    return {c: best[i] for i, c in enumerate(columns)}


def _power_likelihoods(values: DataFrame, grid: dict[int, list[float]]) -> dict[tuple[int, int], float]:
    """Likelihood per (column, place in its grid).

    A batch gives number, mean and squared deviation per exponent; they are
    merged around the common mean, so nearly constant transforms keep their digits.
    """
    def batches(frames):
        for frame in frames:
            out = []
            for i, exponents in grid.items():
                x = frame[f"c{i}"].to_numpy("float64")
                x = x[~np.isnan(x)]
                if not len(x):
                    continue
                logs = float((np.sign(x) * np.log1p(np.abs(x))).sum())
                for k, e in enumerate(exponents):
                    with np.errstate(all="ignore"):
                        y = _transformed(x, e)
                        mean = y.mean()
                        out.append((i, k, len(x), mean, ((y - mean) ** 2).sum(), logs))
            yield pd.DataFrame(out, columns=["i", "k", "n", "mean", "deviation", "logs"])

    parts = truncate(values.select(*[f"c{i}" for i in grid]).mapInPandas(
        batches, "i int, k int, n long, mean double, deviation double, logs double"))
    centre = parts.groupBy("i", "k").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))  # one row per exponent
    rows = parts.join(F.broadcast(centre), ["i", "k"]).groupBy("i", "k").agg(
        F.sum("n").alias("n"), F.sum("logs").alias("logs"), F.max("centre").alias("centre"),
        F.sum(F.col("deviation") + F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2)).alias("deviation")).collect()
    return {(r.i, r.k): -r.n / 2 * math.log(r.deviation / r.n) + (grid[r.i][r.k] - 1) * r.logs
            for r in rows if r.deviation is not None and r.deviation < math.inf
            and math.sqrt(r.deviation / r.n) > 1e-13 * abs(r.centre)}  # more than rounding


def _transformed(x: np.ndarray, e: float) -> np.ndarray:
    """``yeo_johnson`` of an array."""
    up, down = x >= 0, x < 0
    out = np.empty_like(x)
    out[up] = np.log1p(x[up]) if abs(e) < 1e-12 else ((x[up] + 1) ** e - 1) / e
    out[down] = -np.log1p(-x[down]) if abs(2 - e) < 1e-12 else (1 - (1 - x[down]) ** (2 - e)) / (2 - e)
    return out


def _vertex(x: list[float], y: list[float], k: int) -> float:
    """Where the parabola through the largest point and its neighbours is largest."""
    if not 0 < k < len(x) - 1 or -math.inf in (y[k - 1], y[k + 1]):
        return x[k]
    bend = y[k - 1] - 2 * y[k] + y[k + 1]
    return x[k] if bend >= 0 else x[k] + (x[k + 1] - x[k]) * (y[k - 1] - y[k + 1]) / (2 * bend)
