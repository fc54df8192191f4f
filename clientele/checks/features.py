"""Checks of the base fact and of each customer feature."""

from pyspark.sql import functions as F

from clientele.checks.ctes import BASE, TABLES, base, days
from clientele.checks.registry import retail, rounded, without_rounding
from clientele.operators import base as facts_ops
from clientele.operators import features as fe

ID = fe.CUSTOMER
_DELIVERED = "FILTER (WHERE order_status = 'delivered')"
_CARD = "FILTER (WHERE payment_type = 'credit_card')"


def _grouped(expr: str, name: str) -> str:
    return base(f"SELECT customer_unique_id, {expr} AS {name} FROM base, ref GROUP BY customer_unique_id, d")


def _mode(value: str, name: str, missing: str) -> str:
    return base(f"""
SELECT u.customer_unique_id, coalesce(m.v, {missing}) AS {name}
FROM (SELECT DISTINCT customer_unique_id FROM base) u LEFT JOIN (
  SELECT customer_unique_id, v, row_number() OVER (PARTITION BY customer_unique_id ORDER BY n DESC, v) AS k
  FROM (SELECT customer_unique_id, {value} AS v, count(*) AS n FROM base WHERE {value} IS NOT NULL GROUP BY 1, 2) x) m
ON u.customer_unique_id = m.customer_unique_id AND m.k = 1""")


_GAPS = base("""
SELECT customer_unique_id, round(CASE WHEN count(*) > 1 THEN sum(gap) / (count(*) - 1.0) END, 6) AS avg_inter_purchase_days
FROM (SELECT customer_unique_id, floor((epoch_us(order_purchase_timestamp) - epoch_us(lag(order_purchase_timestamp)
    OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp))) / 86400000000.0) AS gap FROM base) g
GROUP BY customer_unique_id""")

_CONCENTRATION = base("""
SELECT u.customer_unique_id, round(coalesce(c.v, 0), 6) AS category_concentration
FROM (SELECT DISTINCT customer_unique_id FROM base) u LEFT JOIN (
  SELECT customer_unique_id, sum(n * n) / (sum(n) * sum(n)) AS v FROM (
    SELECT customer_unique_id, category_english, CAST(count(*) AS DOUBLE) AS n FROM base
    WHERE category_english IS NOT NULL GROUP BY 1, 2) x GROUP BY 1) c
ON u.customer_unique_id = c.customer_unique_id""")

_FIRST = """first_place AS (
  SELECT customer_unique_id, customer_state AS state, customer_city AS city FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS k FROM base) x WHERE k = 1)"""


def _placed(expr: str, name: str) -> str:
    return f"WITH {BASE}, {_FIRST} SELECT customer_unique_id, {expr} AS {name} FROM first_place"


_REGION = "CASE " + " ".join(
    f"WHEN state = '{s}' THEN '{r}'" for s, r in fe.REGION_BY_STATE.items()) + " END"
_CITY = "CASE WHEN lower(city) IN ('sao paulo','rio de janeiro','belo horizonte','brasilia','curitiba') THEN 1 ELSE 0 END"
_STATE = base("""
SELECT f.customer_unique_id, {col} FROM (
  SELECT customer_unique_id, customer_state AS state FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS k FROM base) x WHERE k = 1) f
LEFT JOIN (SELECT customer_state AS state, count(DISTINCT customer_unique_id) AS state_customer_count,
  CAST(sum(price) AS DOUBLE) / count(*) AS avg_price FROM base GROUP BY 1) s ON f.state = s.state""")
_DAYPART = """CASE WHEN hour(order_purchase_timestamp) BETWEEN 6 AND 11 THEN 'morning'
  WHEN hour(order_purchase_timestamp) BETWEEN 12 AND 17 THEN 'afternoon'
  WHEN hour(order_purchase_timestamp) BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END"""
_TO_DELIVERY = "floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0)"
_DELAY = "floor((epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date)) / 86400000000.0)"

_RFM = [
    ("a01_recency", "recency", _grouped(days("d", "max(order_purchase_timestamp)"), "recency")),
    ("a02_frequency", "frequency", _grouped("count(DISTINCT order_id)", "frequency")),
    ("a03_monetary", "monetary", _grouped("round(CAST(sum(price) + sum(freight_value) AS DOUBLE), 2)", "monetary")),
    ("a04_avg_order_value", "avg_order_value",
     _grouped("round(CAST(sum(price) + sum(freight_value) AS DOUBLE) / count(DISTINCT order_id), 6)", "avg_order_value")),
    ("a05_avg_items_per_order", "avg_items_per_order", base("""
SELECT customer_unique_id, round(avg(n), 6) AS avg_items_per_order FROM (
  SELECT customer_unique_id, order_id, CAST(count(*) AS DOUBLE) AS n FROM base GROUP BY 1, 2) x GROUP BY 1""")),
    ("a06_tenure_days", "tenure_days", _grouped(days("d", "min(order_purchase_timestamp)"), "tenure_days")),
    ("a07_purchase_frequency_monthly", "purchase_frequency_monthly", _grouped(
        f"round(count(DISTINCT order_id) / greatest({days('d', 'min(order_purchase_timestamp)')} / 30.0, 1.0), 6)",
        "purchase_frequency_monthly")),
    ("a08_avg_inter_purchase_days", "avg_inter_purchase_days", _GAPS),
]
_BASKET = [
    ("a09_distinct_categories", "distinct_categories", _grouped("count(DISTINCT category_english)", "distinct_categories")),
    ("a10_favorite_category", "favorite_category", _mode("category_english", "favorite_category", "'unknown'")),
    ("a11_category_concentration", "category_concentration", _CONCENTRATION),
    ("a12_distinct_products", "distinct_products", _grouped("count(DISTINCT product_id)", "distinct_products")),
    ("a13_avg_product_weight", "avg_product_weight", _grouped("round(avg(product_weight_g), 6)", "avg_product_weight")),
    ("a14_avg_product_photos", "avg_product_photos", _grouped("round(avg(product_photos_qty), 6)", "avg_product_photos")),
]
_PRICE = [
    ("a15_avg_item_price", "avg_item_price", _grouped("round(CAST(sum(price) AS DOUBLE) / count(*), 6)", "avg_item_price")),
    ("a16_price_std", "price_std", _grouped("round(stddev_samp(CAST(price AS DOUBLE)), 3)", "price_std")),
    ("a17_max_item_price", "max_item_price", _grouped("round(CAST(max(price) AS DOUBLE), 6)", "max_item_price")),
    ("a18_freight_ratio", "freight_ratio", _grouped(
        "round(CAST(sum(freight_value) AS DOUBLE) / nullif(CAST(sum(freight_value) + sum(price) AS DOUBLE), 0), 6)",
        "freight_ratio")),
]
_PAYMENT = [
    ("a20_primary_payment_method", "primary_payment_method", _mode("payment_type", "primary_payment_method", "'unknown'")),
    ("a21_payment_method_diversity", "payment_method_diversity", _grouped("count(DISTINCT payment_type)", "payment_method_diversity")),
    ("a22_avg_installments", "avg_installments", _grouped(f"round(coalesce(avg(payment_installments) {_CARD}, 0), 6)", "avg_installments")),
    ("a23_max_installments", "max_installments", _grouped(f"CAST(coalesce(max(payment_installments) {_CARD}, 0) AS BIGINT)", "max_installments")),
    ("a24_credit_card_rate", "credit_card_rate", _grouped(
        f"round(count(*) {_CARD} / nullif(CAST(count(payment_type) AS DOUBLE), 0), 6)", "credit_card_rate")),
    ("a25_boleto_rate", "boleto_rate", _grouped(
        "round(count(*) FILTER (WHERE payment_type = 'boleto') / nullif(CAST(count(payment_type) AS DOUBLE), 0), 6)", "boleto_rate")),
]
_ENGAGEMENT = [
    ("a26_avg_review_score", "avg_review_score", _grouped("round(coalesce(avg(review_score), 0), 6)", "avg_review_score")),
    ("a27_review_score_std", "review_score_std", _grouped("round(coalesce(stddev_samp(review_score), 0), 6)", "review_score_std")),
    ("a28_review_rate", "review_rate", _grouped("round(count(review_score) / CAST(count(DISTINCT order_id) AS DOUBLE), 6)", "review_rate")),
    ("a29_text_review_rate", "text_review_rate", _grouped(
        "round(coalesce(sum(has_review_text) / nullif(CAST(count(review_score) AS DOUBLE), 0), 0), 6)", "text_review_rate")),
    ("a30_avg_review_length", "avg_review_length", _grouped("round(coalesce(avg(review_text_length), 0), 6)", "avg_review_length")),
    ("a31_sentiment_ratio", "sentiment_ratio", _grouped(
        "round(coalesce((count(*) FILTER (WHERE review_score >= 4) - count(*) FILTER (WHERE review_score <= 2)) / nullif(CAST(count(review_score) AS DOUBLE), 0), 0), 6)",
        "sentiment_ratio")),
    ("a32_reviewer_type", "reviewer_type", _grouped("""CASE WHEN avg(review_score) IS NULL THEN 'non_reviewer'
    WHEN sum(has_review_text) / CAST(count(review_score) AS DOUBLE) > 0.5 THEN 'detailed_reviewer'
    WHEN avg(review_score) >= 4 THEN 'positive_reviewer' WHEN avg(review_score) <= 2 THEN 'critical_reviewer'
    ELSE 'neutral_reviewer' END""", "reviewer_type")),
]
_TEMPORAL = [
    ("a33_preferred_dow", "preferred_dow", _mode("isodow(order_purchase_timestamp) - 1", "preferred_dow", "-1")),
    ("a34_preferred_hour", "preferred_hour", _mode("hour(order_purchase_timestamp)", "preferred_hour", "-1")),
    ("a35_weekend_shopping_rate", "weekend_shopping_rate", _grouped(
        "round(avg(CASE WHEN isodow(order_purchase_timestamp) >= 6 THEN 1.0 ELSE 0.0 END), 6)", "weekend_shopping_rate")),
    ("a36_preferred_time_of_day", "preferred_time_of_day", _mode(_DAYPART, "preferred_time_of_day", "'unknown'")),
    ("a38_avg_delivery_delay", "avg_delivery_delay", _grouped(
        f"round(coalesce(avg({_DELAY}) {_DELIVERED}, 0), 6)", "avg_delivery_delay")),
]
_GEO = [
    ("a39_state", "state", _placed("state", "state")),
    ("a40_region", "region", _placed(_REGION, "region")),
    ("a41_is_major_city", "is_major_city", _placed(_CITY, "is_major_city")),
    ("a42_state_customer_count", "state_customer_count", _STATE.format(col="state_customer_count")),
    ("a43_state_avg_price", "state_avg_price", _STATE.format(col="round(avg_price, 6) AS state_avg_price")),
]


def _register(entries, build):
    for name, column, sql in entries:
        retail(name, sql)(lambda t, column=column: _shown(build(t).select(ID, column)))


def _shown(df):
    """Six digits; three for the price deviation, whose magnitude is 10^4."""
    if "price_std" in df.columns:
        df = df.withColumn("price_std", F.round("price_std", 3))
    return rounded(df)


_register(_RFM[:-1], lambda t: fe.rfm_levels(facts_ops.order_facts(t), facts_ops.purchases(t)))
_register(_RFM[-1:], lambda t: fe.purchase_gaps(facts_ops.order_facts(t)))
_register(_BASKET, lambda t: fe.basket_features(t, facts_ops.order_facts(t)))
_register(_PRICE, lambda t: fe.price_features(facts_ops.order_facts(t)))
_register([("a19_distinct_sellers", "distinct_sellers", _grouped("count(DISTINCT seller_id)", "distinct_sellers"))],
          lambda t: fe.seller_features(t, facts_ops.order_facts(t)))
_register(_PAYMENT, lambda t: fe.payment_features(t, facts_ops.order_facts(t)))
_register(_ENGAGEMENT, lambda t: fe.engagement_features(facts_ops.order_facts(t), with_reviewer_type=True))
_register(_TEMPORAL, lambda t: fe.temporal_features(facts_ops.order_facts(t)))
_register(_GEO, lambda t: fe.geographic_features(facts_ops.order_facts(t)))


_DELIVERY_DAYS = f"""WITH {BASE},
x AS (SELECT customer_unique_id, avg({_TO_DELIVERY}) {_DELIVERED} AS avg_days FROM base GROUP BY 1)
SELECT customer_unique_id, round(coalesce(avg_days, (SELECT median(avg_days) FROM x)), 6) AS avg_delivery_days FROM x"""


@retail("a37_avg_delivery_days", _DELIVERY_DAYS)
def _delivery_days(t):
    return rounded(fe.fill_delivery_days(fe.temporal_features(facts_ops.order_facts(t))).select(ID, "avg_delivery_days"))


_FACT_COLUMNS = """customer_unique_id, customer_city, customer_state, customer_zip_code_prefix, order_id, order_status,
  order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
  order_estimated_delivery_date, product_id, seller_id, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
  product_category_name, category_english, CAST(product_weight_g AS BIGINT) AS product_weight_g,
  CAST(product_photos_qty AS BIGINT) AS product_photos_qty, payment_type, CAST(payment_installments AS BIGINT) AS payment_installments,
  CAST(payment_value AS DOUBLE) AS payment_value, CAST(review_score AS BIGINT) AS review_score,
  CAST(has_review_text AS BIGINT) AS has_review_text, CAST(review_text_length AS BIGINT) AS review_text_length"""


@retail("s17_base_fact", base(f"SELECT {_FACT_COLUMNS} FROM base"))
def _base_fact(t):
    return rounded(facts_ops.base_fact(t))


@retail("s18_reference_date", base("SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS reference_date FROM ref"))
def _reference(t):
    last = F.max("order_purchase_timestamp") + F.expr("INTERVAL '1' DAY")
    return facts_ops.purchases(t).agg(F.date_format(last, "yyyy-MM-dd HH:mm:ss").alias("reference_date"))


# The assembled frame is checked against an oracle that joins the single ones.
_PARTS = {}
for _name, _column, _sql in _RFM + _BASKET + _PRICE + [
        ("a19", "distinct_sellers", _grouped("count(DISTINCT seller_id)", "distinct_sellers"))
] + _PAYMENT + _ENGAGEMENT[:6] + _TEMPORAL + _GEO:
    _PARTS[_column] = _sql


def assembled_sql() -> str:
    """One SQL text with all 42 features, for the assembly and later steps."""
    parts = {**_PARTS, "avg_delivery_days": _DELIVERY_DAYS}
    ctes = [BASE]
    for column, sql in parts.items():
        body = sql.split(BASE, 1)[1].lstrip(" ,\n")
        ctes.append(f"f_{column} AS (WITH {body})" if body.startswith(("x AS", "first_place AS")) else f"f_{column} AS ({body})")
    columns = ", ".join(f"f_{c}.{c}" for c in fe.ALL_FEATURES)
    joins = " ".join(f"LEFT JOIN f_{c} USING (customer_unique_id)" for c in fe.ALL_FEATURES[1:])
    ctes.append(f"features AS (SELECT customer_unique_id, {columns} FROM f_recency {joins})")
    return ",\n".join(ctes)


FEATURES = without_rounding(assembled_sql())


@retail("a44_customer_features", f"WITH {assembled_sql()} SELECT * FROM features")
def _assembled(t):
    return _shown(fe.assemble(t, materialize=True))


@retail("a45_order_grain_rfm", "WITH " + """{tables}, o AS (
  SELECT c.customer_unique_id, o.order_id, o.order_purchase_timestamp, v.n, v.total FROM customers c
  JOIN shop_orders o USING (customer_id) JOIN (SELECT order_id, count(*) AS n, sum(price) + sum(freight_value) AS total
    FROM order_items GROUP BY 1) v USING (order_id))
SELECT customer_unique_id, count(*) AS frequency, round(CAST(sum(total) AS DOUBLE), 2) AS monetary,
  round(avg(CAST(n AS DOUBLE)), 6) AS avg_items_per_order FROM o GROUP BY 1""".replace(
    "{tables}", TABLES))
def _order_grain(t):
    facts = facts_ops.order_facts(t, grain="order")
    return rounded(fe.rfm_levels(facts).select(ID, "frequency", "monetary", "avg_items_per_order"))
