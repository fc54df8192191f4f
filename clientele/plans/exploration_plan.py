"""The exploration report as one result frame per section."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.semantics import ratio
from clientele.operators import explore as ex
from clientele.operators import segments as sg
from clientele.session import truncate
from clientele.sources.tables import TABLE_NAMES, RetailTables, with_english_category


def key_insights(t: RetailTables) -> DataFrame:
    """(metric, number, text): the headline figures of the report."""
    def metric(df: DataFrame, name: str, number, text=None) -> DataFrame:
        return df.select(F.lit(name).alias("metric"), number.cast("double").alias("number"),
                         (F.lit(None) if text is None else text).cast("string").alias("text"))

    text = F.col("review_comment_message")
    share = t.order_reviews.agg((ratio(F.count(text), F.count("*")) * 100).alias("share"))
    return (
        metric(ex.repeat_purchase_rate(ex.orders_per_customer(t)), "repeat_purchase_rate", F.col("repeat_purchase_rate"))
        .unionByName(metric(ex.delivery_days(t.orders).agg(F.avg("delivery_days").alias("d")), "avg_delivery_days", F.col("d")))
        .unionByName(metric(share, "reviews_with_text_pct", F.col("share")))
        .unionByName(metric(ex.top_values(t.customers, "customer_state", 1), "top_state", F.col("count"), F.col("value")))
        .unionByName(metric(ex.top_values(t.order_payments, "payment_type", 1), "top_payment_type", F.col("count"), F.col("value")))
    )


def exploration_report(t: RetailTables, on_tied_edges: str = "raise") -> dict[str, DataFrame]:
    """All sections. Frames that several sections read are stored first: reviews, the RFM frame and what is described and drawn."""
    t = replace(t, order_reviews=truncate(t.order_reviews))
    rfm = truncate(ex.order_grain_rfm(t))
    scored = sg.exploration_rfm_scores(rfm, on_tied_edges=on_tied_edges).withColumn(
        "segment", sg.exploration_segment(F.col("R_score"), F.col("F_score"), F.col("M_score")))
    per_customer = truncate(ex.orders_per_customer(t))
    values = truncate(ex.order_values(t.order_items))
    lengths = truncate(ex.text_lengths(t.order_reviews))
    products = with_english_category(t.products, t.product_category_translation)
    named = {name: getattr(t, name) for name in TABLE_NAMES if name != "geolocation" and getattr(t, name) is not None}
    frames = {
        "orders_per_customer": (per_customer, "orders"), "order_value": (values, "total_value"),
        "text_length": (lengths, "text_length"), "recency": (rfm, "recency"),
        "frequency": (rfm, "frequency"), "monetary": (rfm, "monetary"),
    }
    return {
        "table_profile": ex.profile_tables(named),
        "distinct_counts": ex.distinct_counts(t),
        "repeat_customers": ex.value_counts(t.customers, "customer_unique_id"),
        "customers_by_state": ex.value_counts(t.customers, "customer_state"),
        "top_cities": ex.top_values(t.customers, "customer_city", 20),
        "orders_per_customer_stats": ex.describe(per_customer, ["orders"], stored=True),
        "order_overview": ex.order_overview(t.orders),
        "order_status": ex.value_counts(t.orders, "order_status"),
        "order_value_stats": ex.describe(values, ["total_value", "item_count"], stored=True),
        "orders_by_month": ex.orders_by(t.orders, "month"),
        "orders_by_weekday": ex.orders_by(t.orders, "weekday"),
        "orders_by_hour": ex.orders_by(t.orders, "hour"),
        "delivery_time_stats": ex.describe(ex.delivery_days(t.orders), ["delivery_days"]),
        "category_distribution": ex.value_counts(products, "product_category_name_english"),
        "category_performance": ex.category_performance(t),
        "product_sales_stats": ex.describe(ex.product_sales(t.order_items), ["order_count"]),
        "review_summary": ex.review_summary(t.order_reviews),
        "rating_distribution": ex.counts_by_value(t.order_reviews, "review_score"),
        "rating_stats": ex.describe(t.order_reviews, ["review_score"], stored=True),
        "text_length_stats": ex.describe(lengths, ["text_length"], stored=True),
        "payment_types": ex.value_counts(t.order_payments, "payment_type"),
        "payments_by_type": ex.payments_by_type(t.order_payments),
        "card_installments": ex.counts_by_value(ex.card_installments(t.order_payments), "payment_installments", 12),
        "installment_stats": ex.describe(ex.card_installments(t.order_payments), ["payment_installments"]),
        "rfm": scored,
        "rfm_stats": ex.describe(rfm, ["recency", "frequency", "monetary", "avg_order_value"], stored=True),
        "segment_distribution": ex.value_counts(scored, "segment"),
        "heat_map": sg.heat_map(scored),
        "correlations": ex.correlations(rfm, ["recency", "frequency", "monetary", "avg_order_value"]),
        "key_insights": key_insights(t),
        **{f"histogram_{n}": ex.histogram(df, c, *ex.HISTOGRAMS[n]) for n, (df, c) in frames.items()},
    }


# What names an entry of a section; sections of counts by value are not listed.
SECTION_KEYS = {
    "table_profile": ["table"], "distinct_counts": ["metric"], "order_overview": [], "category_performance": ["category"],
    "review_summary": [], "payments_by_type": ["payment_type"], "rfm": ["customer_unique_id"], "heat_map": ["R_score"],
    "correlations": ["a", "b"], "key_insights": ["metric"],
}


def section_keys(section: str) -> list[str]:
    if section.endswith("_stats"):
        return ["column", "stat"]
    return ["bin"] if section.startswith("histogram_") else SECTION_KEYS.get(section, ["value"])


def _cells(section: str, df: DataFrame) -> DataFrame:
    keys, cells = section_keys(section), []
    for field in df.schema.fields:
        if field.name in keys:
            continue
        kind, value = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind.startswith("timestamp"):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        textual = kind == "string" or kind.startswith("timestamp")
        cells.append(F.struct(
            F.lit(field.name).alias("measure"), (F.lit(None) if textual else value).cast("double").alias("number"),
            (value if textual else F.lit(None)).cast("string").alias("text")))
    entry = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.select(F.lit(section).alias("section"), entry.alias("entry"), F.inline(F.array(*cells)))


def report_table(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, entry, measure, number, text): the whole report as one table, to be stored or compared between loads.

    A value is in ``number``, or in ``text`` if it is a string or a time; the other one is null.
    """
    return reduce(DataFrame.unionByName, [_cells(name, df) for name, df in sections.items()])
