"""Customer features, one row per ``customer_unique_id``.

Plain aggregates come out of a single grouping of the order facts. Category,
product, seller and payment features group by (customer, value) first, so one
very active customer is spread over many tasks before it becomes one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.semantics import (
    exact_stddev, first_peak, floor_days, ratio, smallest_mode, zero_if_null,
)
from clientele.operators.base import order_facts, reference_date, with_category
from clientele.operators.rank import exact_quantiles
from clientele.session import truncate
from clientele.sources.tables import RetailTables

CUSTOMER = "customer_unique_id"

# State to region, and the cities that count as major.
REGION_BY_STATE = {
    "AC": "Norte", "AP": "Norte", "AM": "Norte", "PA": "Norte", "RO": "Norte", "RR": "Norte", "TO": "Norte",
    "AL": "Nordeste", "BA": "Nordeste", "CE": "Nordeste", "MA": "Nordeste", "PB": "Nordeste",
    "PE": "Nordeste", "PI": "Nordeste", "RN": "Nordeste", "SE": "Nordeste",
    "DF": "Centro-Oeste", "GO": "Centro-Oeste", "MT": "Centro-Oeste", "MS": "Centro-Oeste",
    "ES": "Sudeste", "MG": "Sudeste", "RJ": "Sudeste", "SP": "Sudeste",
    "PR": "Sul", "RS": "Sul", "SC": "Sul",
}
SELLER_GROUPS = 8  # Fixed value: more groups share a customer among more tasks
MAJOR_CITIES = ["sao paulo", "rio de janeiro", "belo horizonte", "brasilia", "curitiba"]

RFM_FEATURES = ["recency", "frequency", "monetary", "avg_order_value", "avg_items_per_order",
                "tenure_days", "purchase_frequency_monthly", "avg_inter_purchase_days"]
BEHAVIORAL_FEATURES = ["distinct_categories", "favorite_category", "category_concentration",
                       "distinct_products", "avg_product_weight", "avg_product_photos",
                       "avg_item_price", "price_std", "max_item_price", "freight_ratio", "distinct_sellers"]
PAYMENT_FEATURES = ["primary_payment_method", "payment_method_diversity", "avg_installments",
                    "max_installments", "credit_card_rate", "boleto_rate"]
ENGAGEMENT_FEATURES = ["avg_review_score", "review_score_std", "review_rate", "text_review_rate",
                       "avg_review_length", "sentiment_ratio"]
TEMPORAL_FEATURES = ["preferred_dow", "preferred_hour", "weekend_shopping_rate",
                     "preferred_time_of_day", "avg_delivery_days", "avg_delivery_delay"]
GEOGRAPHIC_FEATURES = ["state", "region", "is_major_city", "state_customer_count", "state_avg_price"]
ALL_FEATURES = (RFM_FEATURES + BEHAVIORAL_FEATURES + PAYMENT_FEATURES + ENGAGEMENT_FEATURES
                + TEMPORAL_FEATURES + GEOGRAPHIC_FEATURES)


def _wsum(value, weight: str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(value * F.col(weight))


def _by_customer(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col(CUSTOMER).isNotNull()).groupBy(CUSTOMER)


# ---- one grouping of the order facts ---------------------------------------

def rfm_levels(facts: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Recency, frequency, monetary value and what follows from them.

    The reference date comes from ``dates`` (``base.purchases``) if given, which
    spares a second evaluation of facts that are not stored.
    """
    now = reference_date(facts if dates is None else dates)
    spend = (F.col("price_sum") + F.col("freight_sum")).cast("decimal(38,2)")
    sums = _by_customer(facts).agg(
        F.max("order_purchase_timestamp").alias("last_purchase"),
        F.min("order_purchase_timestamp").alias("first_purchase"),
        F.count("*").alias("frequency"),
        _wsum(spend, "w_item").alias("monetary"),
        _wsum("n_items", "w_item").alias("n_rows"),
    )
    tenure = F.col("tenure_days")
    return (
        sums.withColumns({
            "recency": floor_days(now, F.col("last_purchase")),
            "tenure_days": floor_days(now, F.col("first_purchase")),
            "avg_order_value": ratio(F.col("monetary"), F.col("frequency")),
            "avg_items_per_order": ratio(F.col("n_rows"), F.col("frequency")),
        })
        .withColumn("purchase_frequency_monthly",
                    F.col("frequency") / F.greatest(tenure / F.lit(30.0), F.lit(1.0)))
        .select(CUSTOMER, *RFM_FEATURES[:-1])
    )


def rfm_features(facts: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """``rfm_levels`` and the mean gap between purchases."""
    return rfm_levels(facts, dates).join(purchase_gaps(facts), CUSTOMER, "left").select(CUSTOMER, *RFM_FEATURES)


def purchase_gaps(facts: DataFrame) -> DataFrame:
    """Mean of whole days between consecutive purchases, in time order.

    Two purchases on one calendar day are less than 24 hours apart and give 0,
    so only the gap from one purchase day to the next counts. Orders are moved
    by (customer, year) and grouped by day, which bounds the window to the days
    of a year; the gaps between years follow from one row per customer and year.
    """
    ts = F.col("order_purchase_timestamp")
    days = (
        facts.filter(F.col(CUSTOMER).isNotNull() & ts.isNotNull())
        .select(CUSTOMER, ts, "w_visit")
        .repartition(CUSTOMER, F.year(ts)).withColumn("year", F.year(ts))  # serves the days, their window and the years
        .groupBy(CUSTOMER, "year", F.to_date(ts).alias("day"))
        .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.sum("w_visit").alias("n_rows"))
    )
    day_before = F.lag("last_ts").over(Window.partitionBy(CUSTOMER, "year").orderBy("day"))
    years = (
        days.withColumn("gap", floor_days(F.col("first_ts"), day_before))
        .groupBy(CUSTOMER, "year")
        .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
             zero_if_null(F.sum("gap")).alias("gap_days"), F.sum("n_rows").alias("n_rows"))
    )
    year_before = F.lag("last_ts").over(Window.partitionBy(CUSTOMER).orderBy("year"))
    return (
        years.withColumn("gap", floor_days(F.col("first_ts"), year_before))
        .groupBy(CUSTOMER)
        .agg(F.sum(F.col("gap_days") + zero_if_null(F.col("gap"))).alias("gap_days"), F.sum("n_rows").alias("n_rows"))
        .select(CUSTOMER, ratio(F.col("gap_days"), F.nullif(F.col("n_rows") - 1, F.lit(0)))
                .alias("avg_inter_purchase_days"))
    )


def price_features(facts: DataFrame) -> DataFrame:
    """Item price level and spread, freight share."""
    sums = _by_customer(facts).agg(
        _wsum("n_items", "w_item").alias("n"),
        _wsum("price_sum", "w_item").alias("price"),
        _wsum("freight_sum", "w_item").alias("freight"),
        F.max("price_max").alias("max_item_price"),
        _wsum("cents", "w_item").alias("cents"),
        _wsum("cents_sq", "w_item").alias("cents_sq"),
    )
    return sums.select(
        CUSTOMER,
        ratio(F.col("price"), F.col("n")).alias("avg_item_price"),
        (exact_stddev(F.col("n"), F.col("cents"), F.col("cents_sq")) / 100).alias("price_std"),
        "max_item_price",
        ratio(F.col("freight"), F.col("freight") + F.col("price")).alias("freight_ratio"),
    )


def engagement_features(facts: DataFrame, with_reviewer_type: bool = False) -> DataFrame:
    """Review behaviour (A26-A31), optionally the reviewer label."""
    sums = _by_customer(facts).agg(
        F.count("*").alias("orders"),
        *[zero_if_null(_wsum(c, "w_review")).alias(c) for c in (
            "n_reviews", "n_scores", "score_sum", "score_sq", "n_positive", "n_negative",
            "n_texts", "text_length")],
    )
    scores = F.col("n_scores")
    mean, text_rate = ratio(F.col("score_sum"), scores), ratio(F.col("n_texts"), scores)
    columns = {
        "avg_review_score": zero_if_null(mean),
        "review_score_std": zero_if_null(exact_stddev(scores, F.col("score_sum"), F.col("score_sq"))),
        "review_rate": ratio(scores, F.col("orders")),
        "text_review_rate": zero_if_null(text_rate),
        "avg_review_length": zero_if_null(ratio(F.col("text_length"), F.col("n_reviews"))),
        "sentiment_ratio": zero_if_null(ratio(F.col("n_positive") - F.col("n_negative"), scores)),
    }
    if with_reviewer_type:
        columns["reviewer_type"] = (
            F.when(mean.isNull(), "non_reviewer")
            .when(text_rate > 0.5, "detailed_reviewer")
            .when(mean >= 4, "positive_reviewer")
            .when(mean <= 2, "critical_reviewer")
            .otherwise("neutral_reviewer")
        )
    return sums.select(CUSTOMER, *[c.alias(name) for name, c in columns.items()])


def temporal_features(facts: DataFrame) -> DataFrame:
    """Preferred weekday, hour and time of day, weekend share, delivery.

    Hours and weekdays are few, so each gets one conditional sum and the mode
    is the first largest of them: one aggregation without extra shuffles.
    ``avg_delivery_days`` stays null where nothing was delivered; ``assemble``
    fills it with the median over customers.
    """
    ts, weight = F.col("order_purchase_timestamp"), F.col("w_visit")
    arrived, delay = F.col("arrived"), F.col("delay_days")

    def count_where(condition):
        return F.sum(F.when(condition, weight).otherwise(0))

    counts = _by_customer(facts).agg(
        *[count_where(F.weekday(ts) == d).alias(f"dow{d}") for d in range(7)],
        *[count_where(F.hour(ts) == h).alias(f"hour{h}") for h in range(24)],
        _wsum("delivery_days", "w_visit").alias("delivery_days"),
        F.sum(F.when(arrived, weight)).alias("n_delivered"),
        _wsum(delay, "w_visit").alias("delay_days"),
        F.sum(F.when(delay.isNotNull(), weight)).alias("n_delay"),
    )
    dow = [F.col(f"dow{d}") for d in range(7)]
    hour = [F.col(f"hour{h}") for h in range(24)]

    def total(columns):
        result = columns[0]
        for c in columns[1:]:
            result = result + c
        return result

    day_parts = {"afternoon": hour[12:18], "evening": hour[18:22], "morning": hour[6:12],
                 "night": hour[22:] + hour[:6]}
    return counts.select(
        CUSTOMER,
        F.coalesce(first_peak(dow, [F.lit(d) for d in range(7)]), F.lit(-1)).alias("preferred_dow"),
        F.coalesce(first_peak(hour, [F.lit(h) for h in range(24)]), F.lit(-1)).alias("preferred_hour"),
        ratio(dow[5] + dow[6], total(dow)).alias("weekend_shopping_rate"),
        F.coalesce(first_peak([total(c) for c in day_parts.values()], [F.lit(n) for n in day_parts]),
                   F.lit("unknown")).alias("preferred_time_of_day"),
        ratio(F.col("delivery_days"), F.col("n_delivered")).alias("avg_delivery_days"),
        zero_if_null(ratio(F.col("delay_days"), F.col("n_delay"))).alias("avg_delivery_delay"),
    )


def geographic_features(facts: DataFrame) -> DataFrame:
    """State, region, major-city flag and statistics of the state.

    The location is that of the customer's earliest order.
    """
    order = F.struct("order_purchase_timestamp", "order_id")
    first = _by_customer(facts).agg(
        F.min_by(F.struct("customer_state", "customer_city"), order).alias("place")
    )
    region = F.create_map(*[F.lit(x) for pair in REGION_BY_STATE.items() for x in pair])
    located = first.select(
        CUSTOMER,
        F.col("place.customer_state").alias("state"),
        region[F.col("place.customer_state")].alias("region"),
        F.lower("place.customer_city").isin(MAJOR_CITIES).cast("int").alias("is_major_city"),
    )
    return located.join(state_statistics(facts), "state", "left").select(CUSTOMER, *GEOGRAPHIC_FEATURES)


def state_statistics(facts: DataFrame) -> DataFrame:
    """Customers and mean item price per state, over all rows of the state."""
    return (
        facts.filter(F.col("customer_state").isNotNull())
        .groupBy(F.col("customer_state").alias("state"), CUSTOMER)
        .agg(_wsum("price_sum", "w_item").alias("price"), _wsum("n_items", "w_item").alias("n"))
        .groupBy("state")
        .agg(F.count(CUSTOMER).alias("state_customer_count"),
             ratio(F.sum("price"), F.sum("n")).alias("state_avg_price"))
    )


# ---- (customer, value) groupings --------------------------------------------

def customer_lines(t: RetailTables, facts: DataFrame) -> DataFrame:
    """Product and seller of each order item with the customer and the weight of its order."""
    owners = facts.filter(F.col(CUSTOMER).isNotNull()).select("order_id", CUSTOMER, "w_item")
    return t.order_items.select("product_id", "seller_id", "order_id").join(owners, "order_id").drop("order_id")


def category_counts(t: RetailTables, facts: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Rows, products and product attributes per customer and category.

    ``lines`` are stored ``customer_lines``, if there are any. Products are joined last, so their attributes
    are moved with a line once.
    """
    lines = customer_lines(t, facts) if lines is None else lines
    weight, photos = F.col("product_weight_g"), F.col("product_photos_qty")
    per_product = (
        # In this order, what varies little first, they compress best.
        with_category(t, lines.select(CUSTOMER, "product_id", "w_item")).select(
            "category_english", "product_photos_qty", "product_weight_g", "product_id", "w_item", CUSTOMER)
        .repartition(CUSTOMER, "category_english")  # serves both groupings
        .groupBy(CUSTOMER, "product_id", "category_english", "product_weight_g", "product_photos_qty")
        .agg(F.sum("w_item").alias("n"))
    )
    return per_product.groupBy(CUSTOMER, "category_english").agg(
        F.sum("n").alias("n"),
        F.count("product_id").alias("products"),
        F.sum(weight * F.col("n")).alias("weight"),
        F.sum(F.when(weight.isNotNull(), F.col("n"))).alias("n_weight"),
        F.sum(photos * F.col("n")).alias("photos"),
        F.sum(F.when(photos.isNotNull(), F.col("n"))).alias("n_photos"),
    )


def basket_features(t: RetailTables, facts: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Categories, products and product attributes per customer."""
    known = F.col("category_english").isNotNull()
    n = F.when(known, F.col("n"))
    totals = category_counts(t, facts, lines).groupBy(CUSTOMER).agg(
        F.count("category_english").alias("distinct_categories"),
        smallest_mode(F.col("category_english"), F.col("n")).alias("favorite_category"),
        F.sum(n.cast("double") * n.cast("double")).alias("squares"),
        F.sum(n).alias("n"),
        F.sum("products").alias("distinct_products"),
        *[F.sum(c).alias(c) for c in ("weight", "n_weight", "photos", "n_photos")],
    )
    return totals.select(
        CUSTOMER,
        "distinct_categories",
        F.coalesce("favorite_category", F.lit("unknown")).alias("favorite_category"),
        F.coalesce(ratio(F.col("squares"), F.col("n").cast("double") * F.col("n")), F.lit(0.0))
        .alias("category_concentration"),
        "distinct_products",
        ratio(F.col("weight"), F.col("n_weight")).alias("avg_product_weight"),
        ratio(F.col("photos"), F.col("n_photos")).alias("avg_product_photos"),
    )


def seller_features(t: RetailTables, facts: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Distinct sellers per customer.

    Sellers are dealt to a few groups, which share a customer with very many
    lines among tasks and leave few counts per customer to add up.
    """
    lines = customer_lines(t, facts) if lines is None else lines
    group = F.pmod(F.xxhash64("seller_id"), F.lit(SELLER_GROUPS))
    return (
        lines.select(CUSTOMER, "seller_id")
        .repartition(CUSTOMER, group)
        .withColumn("seller_group", group).distinct()
        .groupBy(CUSTOMER).agg(F.count("seller_id").alias("distinct_sellers"))
    )


def behavioral_features(t: RetailTables, facts: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    return (
        basket_features(t, facts, lines)
        .join(price_features(facts), CUSTOMER, "left")
        .join(seller_features(t, facts, lines), CUSTOMER, "left")
        .select(CUSTOMER, *BEHAVIORAL_FEATURES)
    )


def payment_features(t: RetailTables, facts: DataFrame) -> DataFrame:
    """Payment method, installments and method shares."""
    installments = F.col("paid_in")
    payments = facts.filter(F.col(CUSTOMER).isNotNull()).select(
        CUSTOMER, "w_payment", F.explode_outer(F.arrays_zip("paid_by", "paid_in")).alias("p"))
    by_kind = payments.select(CUSTOMER, "w_payment", F.col("p.paid_by").alias("payment_type"), "p.paid_in").groupBy(CUSTOMER, "payment_type").agg(
        F.sum("w_payment").alias("n"),
        F.sum(F.when(installments.isNotNull(), F.col("w_payment")).otherwise(0)).alias("n_inst"),
        _wsum(installments, "w_payment").alias("inst"),
        F.max(installments).alias("max_inst"),
    )
    kind = F.col("payment_type")
    n, card = F.when(kind.isNotNull(), F.col("n")), kind == "credit_card"
    return by_kind.groupBy(CUSTOMER).agg(
        F.coalesce(smallest_mode(kind, n), F.lit("unknown")).alias("primary_payment_method"),
        F.count(kind).alias("payment_method_diversity"),
        zero_if_null(ratio(F.sum(F.when(card, F.col("inst"))), F.sum(F.when(card, F.col("n_inst")))))
        .alias("avg_installments"),
        zero_if_null(F.max(F.when(card, F.col("max_inst")))).alias("max_installments"),
        ratio(zero_if_null(F.sum(F.when(card, n))), F.sum(n)).alias("credit_card_rate"),
        ratio(zero_if_null(F.sum(F.when(kind == "boleto", n))), F.sum(n)).alias("boleto_rate"),
    )


# ---- assembly -----------------------------------------------------------------

def assemble(t: RetailTables, grain: str = "base", materialize: bool = False) -> DataFrame:
    """All 42 features per customer.

    With ``materialize`` the order facts, which seven branches read, are
    stored once, without columns that no branch reads, instead of being joined again for each branch;
    so are the lines of the customers, which two branches read.
    """
    facts, lines = order_facts(t, grain), None
    if materialize:
        facts = truncate(facts.drop(
            "order_status", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
            "order_estimated_delivery_date", "customer_zip_code_prefix", "n_payments"))
        lines = truncate(customer_lines(t, facts))
    features = rfm_features(facts)
    for part in (
        behavioral_features(t, facts, lines),
        payment_features(t, facts),
        engagement_features(facts),
        temporal_features(facts),
        geographic_features(facts),
    ):
        features = features.join(part, CUSTOMER, "left")
    if materialize:
        features = truncate(features)
    return fill_delivery_days(features).select(CUSTOMER, *ALL_FEATURES)


def fill_delivery_days(features: DataFrame) -> DataFrame:
    """Customers without a delivery get the median over customers."""
    median = exact_quantiles(features, ["avg_delivery_days"], [0.5])["avg_delivery_days"][0]
    return features.withColumn(
        "avg_delivery_days", F.coalesce(F.col("avg_delivery_days"), F.lit(median).cast("double"))
    )
