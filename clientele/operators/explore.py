"""Profiles, distributions and the order-grain RFM of the exploration report."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.semantics import clip_upper, floor_days, ratio, zero_if_null
from clientele.operators.features import CUSTOMER
from clientele.operators.rank import exact_quantiles
from clientele.session import truncate
from clientele.sources.tables import RetailTables, with_english_category

# Clip bound and number of bins of the report's histograms.
HISTOGRAMS = {
    "orders_per_customer": (10, 10),
    "order_value": (500, 50),
    "text_length": (500, 50),
    "recency": (365, 50),
    "frequency": (10, 10),
    "monetary": (2000, 50),
}


def table_profile(name: str, df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and their share, in one pass."""
    missing = F.lit(0)
    for c in df.columns:
        missing = missing + F.when(F.col(c).isNull(), 1).otherwise(0)
    cells = F.count("*") * len(df.columns)
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        zero_if_null(F.sum(missing.cast("long"))).alias("missing_cells"),
        (ratio(zero_if_null(F.sum(missing.cast("long"))), cells) * 100).alias("missing_pct"),
    ).select(F.lit(name).alias("table"), "*")


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([table_profile(name, df) for name, df in tables.items()])


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def describe(df: DataFrame, columns: list[str], stored: bool = False) -> DataFrame:
    """(column, stat, value): count, mean, std, min, quartiles, max, exactly.

    The quartiles take several passes, so the columns are stored first unless ``df`` is ``stored``.
    """
    if not stored:
        df = truncate(df.select(*columns))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    row_of = {}
    for c in columns:
        x = F.col(c).cast("double")
        q = [F.lit(v).cast("double") for v in quartiles[c]]
        row_of[c] = {"count": F.count(x).cast("double"), "mean": F.avg(x), "std": F.stddev_samp(x),
                     "min": F.min(x), "25%": q[0], "50%": q[1], "75%": q[2], "max": F.max(x)}
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"), value.alias("value"))
        for c, stats in row_of.items() for stat, value in stats.items()
    ])
    return df.agg(cells.alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def feature_summary(df: DataFrame) -> DataFrame:
    """One row per numeric column: statistics, missing count and type."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    stats = describe(df, columns).groupBy("column").pivot(
        "stat", ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]).agg(F.first("value"))
    missing = df.agg(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("missing"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("dtype")) for c in columns
    ])).alias("m")).select("m.*")
    return stats.join(F.broadcast(missing), "column")  # one row per column


# ---- frequencies ----------------------------------------------------------------

def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count) of the non-missing values, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("count")).orderBy(F.desc("count"), "value")
    )


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    return value_counts(df, column).limit(k)


def counts_by_value(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """(value, count) in the order of the values, optionally the first k."""
    counts = value_counts(df, column).orderBy("value")
    return counts if k is None else counts.limit(k)


def histogram(df: DataFrame, column: str, bound: float, bins: int) -> DataFrame:
    """Equal-width bins over [min, max] of the values clipped at ``bound``.

    The last bin is closed. Values that are all equal fall into one bin.
    """
    values = df.select(clip_upper(F.col(column).cast("double"), float(bound)).alias("x")).filter("x is not null")
    limits = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("limits")).scalar()
    lo, hi = limits["lo"], limits["hi"]
    width = (hi - lo) / bins
    position = F.least(F.floor(F.try_divide(F.col("x") - lo, width)), F.lit(bins - 1))
    return (
        values.select(F.when(width > 0, position).otherwise(0).cast("int").alias("bin"))
        .groupBy("bin").agg(F.count("*").alias("count"))
        .select("bin", (lo + F.col("bin") * width).alias("from"), "count").orderBy("bin")
    )


# ---- customers --------------------------------------------------------------------

def orders_per_customer(t: RetailTables) -> DataFrame:
    linked = t.customers.select("customer_id", CUSTOMER).join(t.orders.select("customer_id", "order_id"), "customer_id")
    return linked.filter(F.col(CUSTOMER).isNotNull()).groupBy(CUSTOMER).agg(F.count("*").alias("orders"))


def repeat_purchase_rate(per_customer: DataFrame) -> DataFrame:
    """Share of customers with more than one order, in percent."""
    return per_customer.agg((F.avg((F.col("orders") > 1).cast("double")) * 100).alias("repeat_purchase_rate"))


def distinct_counts(t: RetailTables) -> DataFrame:
    products = with_english_category(t.products, t.product_category_translation)
    return _union([
        t.customers.agg(F.count_distinct("customer_id").alias("value")).select(F.lit("total_customers").alias("metric"), "value"),
        t.customers.agg(F.count_distinct(CUSTOMER).alias("value")).select(F.lit("unique_customers").alias("metric"), "value"),
        products.agg(F.count_distinct("product_category_name_english").alias("value"))
        .select(F.lit("categories").alias("metric"), "value"),
    ])


# ---- orders -----------------------------------------------------------------------

def order_overview(orders: DataFrame) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    return orders.agg(F.count("*").alias("total_orders"), F.min(ts).alias("first_order"), F.max(ts).alias("last_order"))


def order_values(items: DataFrame) -> DataFrame:
    """Price, freight, item count and total per order."""
    return (
        items.filter(F.col("order_id").isNotNull()).groupBy("order_id")
        .agg(zero_if_null(F.sum("price")).alias("price"), zero_if_null(F.sum("freight_value")).alias("freight_value"),
             F.count("order_item_id").alias("item_count"))
        .withColumn("total_value", F.col("price") + F.col("freight_value"))
    )


def orders_by(orders: DataFrame, part: str) -> DataFrame:
    """Orders per 'month' (yyyy-MM), 'weekday' (Monday = 0) or 'hour'."""
    ts = F.col("order_purchase_timestamp")
    value = {"month": F.date_format(ts, "yyyy-MM"), "weekday": F.weekday(ts), "hour": F.hour(ts)}[part]
    return counts_by_value(orders.select(value.alias(part)), part)


def delivery_days(orders: DataFrame) -> DataFrame:
    """Whole days from purchase to delivery of delivered orders."""
    days = floor_days(F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp"))
    return orders.filter(F.col("order_status") == "delivered").select("order_id", days.alias("delivery_days"))


# ---- products ---------------------------------------------------------------------

def product_sales(items: DataFrame) -> DataFrame:
    """Sold rows, revenue and mean price per product."""
    return items.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count("order_id").alias("order_count"),
        zero_if_null(F.sum("price")).alias("total_revenue"),
        ratio(F.sum("price"), F.count("price")).alias("avg_price"),
    )


def category_performance(t: RetailTables) -> DataFrame:
    """Products, sold items and revenue per category, best revenue first."""
    products = with_english_category(t.products, t.product_category_translation)
    category = F.col("product_category_name_english")
    return (
        products.join(product_sales(t.order_items), "product_id", "left")
        .filter(category.isNotNull()).groupBy(category.alias("category"))
        .agg(F.count("product_id").alias("product_count"),
             zero_if_null(F.sum("order_count")).alias("order_count"),
             zero_if_null(F.sum("total_revenue")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


# ---- reviews and payments -----------------------------------------------------------

def review_summary(reviews: DataFrame) -> DataFrame:
    score, text = F.col("review_score"), F.col("review_comment_message")
    return reviews.agg(
        F.count("*").alias("total_reviews"),
        F.count(text).alias("reviews_with_text"),
        F.avg(score).alias("avg_rating"),
        F.avg(F.when(text.isNotNull(), score)).alias("avg_rating_with_text"),
        F.avg(F.when(text.isNull(), score)).alias("avg_rating_without_text"),
    )


def text_lengths(reviews: DataFrame) -> DataFrame:
    text = F.col("review_comment_message")
    return reviews.filter(text.isNotNull()).select("review_id", F.length(text).alias("text_length"))


def payments_by_type(payments: DataFrame) -> DataFrame:
    value = F.col("payment_value")
    return payments.filter(F.col("payment_type").isNotNull()).groupBy("payment_type").agg(
        zero_if_null(F.sum(value)).alias("total"), ratio(F.sum(value), F.count(value)).alias("mean"),
        F.count(value).alias("count"),
    )


def card_installments(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("payment_type") == "credit_card").select("payment_installments")


# ---- order-grain RFM and correlations -------------------------------------------------

def order_grain_rfm(t: RetailTables) -> DataFrame:
    """Recency, frequency, monetary and mean order value without repeats.

    Items are summed per order before any join; orders without items drop out.
    """
    values = order_values(t.order_items).select("order_id", "total_value")
    orders = (
        t.orders.select("order_id", "customer_id", "order_purchase_timestamp").join(values, "order_id")
        .join(t.customers.select("customer_id", CUSTOMER), "customer_id")
        .filter(F.col(CUSTOMER).isNotNull())
    )
    now = orders.agg((F.max("order_purchase_timestamp") + F.expr("INTERVAL '1' DAY")).alias("now")).scalar()
    return (
        orders.groupBy(CUSTOMER)
        .agg(F.max("order_purchase_timestamp").alias("last"), F.count_distinct("order_id").alias("frequency"),
             F.sum("total_value").alias("monetary"))
        .select(CUSTOMER, floor_days(now, F.col("last")).alias("recency"), "frequency", "monetary",
                ratio(F.col("monetary"), F.col("frequency")).alias("avg_order_value"))
    )


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of all pairs as (a, b, corr), from one aggregation."""
    def corr(a: str, b: str) -> Column:
        return F.corr(F.col(a).cast("double"), F.col(b).cast("double"))

    cells = []
    for a, b in combinations_with_replacement(columns, 2):
        cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), corr(a, b).alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), corr(a, b).alias("corr")))
    return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")
