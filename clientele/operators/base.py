"""Joined facts: the wide base fact and the one-row-per-order fact.

The wide fact repeats an item once per payment and per review of its order.
Every sum, mean and count over it is therefore a *weighted* sum over items,
payments or reviews, with weights known per order. ``order_facts`` carries
those weights, so the feature builders get the same numbers without ever
writing out the repeated rows, and a de-duplicated grain by setting them to 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.semantics import floor_days, zero_if_null
from clientele.sources.tables import RetailTables

GRAINS = ("base", "order")

# The order in which facts are moved to their customers. Columns that vary little lie side by side, where a block
# is compressed best; ids, times and amounts come after them.
MOVED = ["paid_by", "paid_in", "n_payments", "arrived", "n_reviews", "n_scores", "score_sum", "score_sq", "n_positive", "n_negative",
         "n_texts", "text_length", "n_items", "delay_days", "delivery_days", "order_purchase_timestamp", "order_id", "customer_id",
         "price_max", "price_sum", "freight_sum", "cents", "cents_sq"]


def base_fact(t: RetailTables) -> DataFrame:
    """Item x payment x review rows with customer, order and product columns."""
    payments = t.order_payments.select("order_id", "payment_type", "payment_installments", "payment_value")
    message = F.col("review_comment_message")
    reviews = t.order_reviews.select(
        "order_id",
        "review_score",
        F.when(message.isNotNull(), 1).otherwise(0).alias("has_review_text"),
        F.coalesce(F.length(message), F.lit(0)).alias("review_text_length"),
    )
    return (
        customer_orders(t)
        .join(item_lines(t), "order_id")
        .join(payments, "order_id", "left")
        .join(reviews, "order_id", "left")
    )


def customer_orders(t: RetailTables) -> DataFrame:
    return _places(t).join(t.orders, "customer_id").drop("customer_id")


def _places(t: RetailTables) -> DataFrame:
    return t.customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"
    )


def with_category(t: RetailTables, lines: DataFrame) -> DataFrame:
    """Lines with the attributes of their product and its English category."""
    categories = t.product_category_translation.select(
        "product_category_name", F.col("product_category_name_english").alias("category_english")
    )
    products = t.products.select(
        "product_id", "product_category_name", "product_weight_g", "product_photos_qty"
    ).join(categories, "product_category_name", "left")
    return lines.join(products, "product_id", "left")


def item_lines(t: RetailTables) -> DataFrame:
    """Order items with product attributes and the English category."""
    return with_category(t, t.order_items.select("order_id", "product_id", "seller_id", "price", "freight_value"))


def _named(columns: list[str]) -> list[Column]:
    """Columns by names that may hold dots or other signs."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def purchases(t: RetailTables) -> DataFrame:
    """Orders of known customers that have items; no other columns are read."""
    return (
        t.orders.select("order_id", "customer_id", "order_purchase_timestamp")
        .join(t.customers.select("customer_id"), "customer_id", "left_semi")
        .join(t.order_items.select("order_id"), "order_id", "left_semi")
    )


def reference_date(facts: DataFrame) -> Column:
    """One day after the last purchase, as a scalar subquery."""
    last = F.max("order_purchase_timestamp") + F.expr("INTERVAL '1' DAY")
    return facts.agg(last.alias("reference_date")).scalar()


def order_facts(t: RetailTables, grain: str = "base") -> DataFrame:
    """One row per order with items: its customer, its totals and its weights.

    ``w_item``, ``w_payment`` and ``w_review`` say how often one item, payment
    or review of the order counts, ``w_visit`` how often the order itself does.
    ``paid_by`` and ``paid_in`` list type and installments of its payments, so that these are not joined to their
    customers a second time.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    cents = (F.col("price") * 100).cast("decimal(12,0)")
    kind = t.order_items.schema["price"].dataType
    whole_cents = isinstance(kind, T.DecimalType) and kind.scale <= 2 and kind.precision - kind.scale <= 10
    # Six exact sums are wider than a line, so lines are moved and not sums of a few of them.
    lines = t.order_items.select("price", "freight_value", "order_id").filter(F.col("order_id").isNotNull()).repartition("order_id")
    items = lines.groupBy("order_id").agg(
        F.count("*").alias("n_items"),
        F.sum("price").cast("decimal(38,2)").alias("price_sum"),
        F.sum("freight_value").cast("decimal(38,2)").alias("freight_sum"),
        F.max("price").alias("price_max"),
        F.sum(cents).cast("decimal(38,0)").alias("cents"),
        F.sum(cents * cents).cast("decimal(38,0)").alias("cents_sq"),
    )
    payments = t.order_payments.groupBy("order_id").agg(
        F.count("*").alias("n_payments"),
        F.collect_list(F.struct("payment_type", "payment_installments")).alias("paid"),
    ).select("order_id", "n_payments", F.col("paid.payment_type").alias("paid_by"), F.col("paid.payment_installments").alias("paid_in"))
    score, length = F.col("review_score"), F.col("review_length")
    written = t.reviews_with(F.length, "review_length").select("order_id", score, length)
    # Eight sums are wider than a review, too.
    reviews = written.filter(F.col("order_id").isNotNull()).repartition("order_id").groupBy("order_id").agg(
        F.count("*").alias("n_reviews"),
        F.count(score).alias("n_scores"),
        F.sum(score).alias("score_sum"),
        F.sum(score * score).alias("score_sq"),
        F.count_if(score >= 4).alias("n_positive"),
        F.count_if(score <= 2).alias("n_negative"),
        F.count_if(length.isNotNull()).alias("n_texts"),
        F.sum(F.coalesce(length, F.lit(0))).alias("text_length"),
    )
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    arrived = (F.col("order_status") == "delivered") & delivered.isNotNull()
    orders = t.orders.withColumns({  # whole days are narrower than the dates
        "arrived": arrived,
        "delivery_days": F.when(arrived, floor_days(delivered, F.col("order_purchase_timestamp"))),
        "delay_days": F.when(arrived, floor_days(delivered, estimated)),
    })
    # The customers come last: what is stored then lies by customer, and a task sums up most of a customer's orders
    # before anything is moved.
    wide = orders.join(items, "order_id").join(payments, "order_id", "left").join(reviews, "order_id", "left")
    moved = wide.select(_named(sorted(wide.columns, key=lambda c: MOVED.index(c) if c in MOVED else -1)))
    joined = moved.join(_places(t), "customer_id")
    joined = joined.select(_named([*wide.columns, *joined.columns[len(wide.columns):]])).drop("customer_id")
    if whole_cents:  # then they need not be moved beside the price
        joined = joined.withColumn("cents", (F.col("price_sum") * 100).cast("decimal(38,0)"))
    one = F.lit(1).cast("long")
    if grain == "base":
        per_payment = F.greatest(zero_if_null(F.col("n_payments")), one)
        per_review = F.greatest(zero_if_null(F.col("n_reviews")), one)
        weights = {
            "w_item": per_payment * per_review,
            "w_payment": F.col("n_items") * per_review,
            "w_review": F.col("n_items") * per_payment,
            "w_visit": F.col("n_items") * per_payment * per_review,
        }
    else:
        weights = {name: one for name in ("w_item", "w_payment", "w_review", "w_visit")}
    return joined.withColumns(weights)
