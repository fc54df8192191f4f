"""Checks of profiles and distributions."""

from pyspark.sql import functions as F

from clientele.checks.ctes import TABLES, tables
from clientele.checks.registry import query, retail, rounded
from clientele.checks.segments import ORDER_RFM
from clientele.operators import explore as ex
from clientele.operators import features as fe
from clientele.sources.tables import read_sample, with_english_category

_STATS = {"count": "CAST(count(x) AS DOUBLE)", "mean": "avg(x)", "std": "stddev_samp(x)", "min": "min(x)",
          "25%": "quantile_cont(x, 0.25)", "50%": "quantile_cont(x, 0.5)", "75%": "quantile_cont(x, 0.75)", "max": "max(x)"}


def described(column: str, source: str, digits: int = 6) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS column, '{stat}' AS stat, round({e}, {digits}) AS value FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source}) d"
        for stat, e in _STATS.items())


_SAMPLE_TABLES = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "labels": ["doc_id", "quality", "toxic"],
}


def _profile_sql(name, source, columns):
    missing = " + ".join(f"(count(*) - count({c}))" for c in columns)
    return (f"SELECT '{name}' AS \"table\", count(*) AS rows, {len(columns)} AS columns, CAST({missing} AS BIGINT) AS missing_cells, "
            f"round(({missing}) * 100.0 / (count(*) * {len(columns)}), 6) AS missing_pct FROM {source}")


_RETAIL_COLUMNS = {
    "products": ["product_id", "product_category_name", "product_name_length", "product_weight_g", "product_photos_qty"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_creation_date", "review_comment_message"],
}


@retail("e01_table_profile", tables(" UNION ALL ".join(
    _profile_sql(n, "shop_orders" if n == "orders" else n, c) for n, c in _RETAIL_COLUMNS.items())))
def _profile(t):
    frames = {"products": t.products, "orders": t.orders, "order_reviews": t.order_reviews}
    return rounded(ex.profile_tables(frames))


@retail("e02_describe_order_value", tables(described("total_value", "(SELECT sum(price) + sum(freight_value) AS total_value FROM order_items GROUP BY order_id) v", 2)
        + " UNION ALL " + described("item_count", "(SELECT count(*) AS item_count FROM order_items GROUP BY order_id) v", 2)))
def _describe(t):
    return rounded(ex.describe(ex.order_values(t.order_items), ["total_value", "item_count"]), 2)


_SUMMARY = ["recency", "frequency", "avg_order_value"]


@retail("e03_feature_summary", f"""WITH {ORDER_RFM}, x AS (SELECT recency, frequency, CAST(monetary AS DOUBLE) / frequency AS avg_order_value FROM rfm)
{' UNION ALL '.join(f'''SELECT '{c}' AS column, {', '.join(f'round({e.replace("x)", f"CAST({c} AS DOUBLE))").replace("x,", f"CAST({c} AS DOUBLE),")}, 3) AS "{s}"' for s, e in _STATS.items())},
 count(*) - count({c}) AS missing, '{"double" if c == "avg_order_value" else "bigint"}' AS dtype FROM x''' for c in _SUMMARY)}""")
def _summary(t):
    return rounded(ex.feature_summary(ex.order_grain_rfm(t).select(*_SUMMARY)), 3)


@retail("e04_distinct_counts", tables("""SELECT 'total_customers' AS metric, count(DISTINCT customer_id) AS value FROM customers
UNION ALL SELECT 'unique_customers', count(DISTINCT customer_unique_id) FROM customers
UNION ALL SELECT 'categories', count(DISTINCT product_category_name_english) FROM products JOIN translation USING (product_category_name)"""))
def _distinct(t):
    return ex.distinct_counts(t)


def _counts_sql(column, source, tail=""):
    return tables(f"SELECT {column} AS value, count(*) AS count FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 {tail}")


retail("e05_order_status_counts", _counts_sql("order_status", "shop_orders"))(
    lambda t: ex.value_counts(t.orders, "order_status"))
retail("e05_state_counts", _counts_sql("customer_state", "customers"))(
    lambda t: ex.value_counts(t.customers, "customer_state"))
retail("e05_category_counts", _counts_sql("product_category_name_english", "products JOIN translation USING (product_category_name)"))(
    lambda t: ex.value_counts(with_english_category(t.products, t.product_category_translation), "product_category_name_english"))
retail("e05_payment_type_counts", _counts_sql("payment_type", "order_payments"))(
    lambda t: ex.value_counts(t.order_payments, "payment_type"))
retail("e06_top_states", _counts_sql("customer_state", "customers", "ORDER BY count DESC, value LIMIT 10"))(
    lambda t: ex.top_values(t.customers, "customer_state", 10))
retail("e06_top_cities", _counts_sql("customer_city", "customers", "ORDER BY count DESC, value LIMIT 20"))(
    lambda t: ex.top_values(t.customers, "customer_city", 20))
retail("e07_rating_counts", _counts_sql("CAST(review_score AS BIGINT)", "order_reviews"))(
    lambda t: rounded(ex.counts_by_value(t.order_reviews, "review_score")))


@retail("e08_repeat_purchase_rate", tables("""SELECT round(avg(CASE WHEN n > 1 THEN 100.0 ELSE 0.0 END), 6) AS repeat_purchase_rate
FROM (SELECT customer_unique_id, count(*) AS n FROM customers JOIN shop_orders USING (customer_id) GROUP BY 1) x"""))
def _repeat(t):
    return rounded(ex.repeat_purchase_rate(ex.orders_per_customer(t)))


@retail("j07_orders_per_customer", tables("""SELECT customer_unique_id, count(*) AS orders
FROM customers JOIN shop_orders USING (customer_id) GROUP BY 1"""))
def _per_customer(t):
    return ex.orders_per_customer(t)


@retail("e09_order_overview", tables("""SELECT count(*) AS total_orders, strftime(min(order_purchase_timestamp), '%Y-%m-%d %H') AS first_order,
strftime(max(order_purchase_timestamp), '%Y-%m-%d %H') AS last_order FROM shop_orders"""))
def _overview(t):
    df = ex.order_overview(t.orders)
    return df.select("total_orders", *[F.date_format(c, "yyyy-MM-dd HH").alias(c) for c in ("first_order", "last_order")])


@retail("e10_order_values", tables("""SELECT order_id, round(CAST(sum(price) AS DOUBLE), 2) AS price, round(CAST(sum(freight_value) AS DOUBLE), 2) AS freight_value,
count(*) AS item_count, round(CAST(sum(price) + sum(freight_value) AS DOUBLE), 2) AS total_value FROM order_items GROUP BY 1"""))
def _values(t):
    return rounded(ex.order_values(t.order_items), 2)


for _part, _expr in {"month": "strftime(order_purchase_timestamp, '%Y-%m')", "weekday": "isodow(order_purchase_timestamp) - 1",
                     "hour": "hour(order_purchase_timestamp)"}.items():
    retail(f"e11_orders_by_{_part}", tables(f"SELECT {_expr} AS value, count(*) AS count FROM shop_orders GROUP BY 1"))(
        lambda t, part=_part: rounded(ex.orders_by(t.orders, part)))

_DAYS = "(SELECT floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS delivery_days FROM shop_orders WHERE order_status = 'delivered') v"


@retail("e12_delivery_days", tables(described("delivery_days", _DAYS)))
def _delivery(t):
    return rounded(ex.describe(ex.delivery_days(t.orders), ["delivery_days"]))


@retail("e13_product_sales", tables("""SELECT product_id, count(*) AS order_count, round(CAST(sum(price) AS DOUBLE), 2) AS total_revenue,
round(CAST(sum(price) AS DOUBLE) / count(*), 4) AS avg_price FROM order_items GROUP BY 1"""))
def _sales(t):
    return rounded(ex.product_sales(t.order_items), 4)


_PERF = """SELECT product_category_name_english AS category, count(*) AS product_count, CAST(coalesce(sum(n), 0) AS BIGINT) AS order_count,
round(CAST(coalesce(sum(v), 0) AS DOUBLE), 2) AS total_revenue FROM products JOIN translation USING (product_category_name)
LEFT JOIN (SELECT product_id, count(*) AS n, sum(price) AS v FROM order_items GROUP BY 1) s USING (product_id) GROUP BY 1"""


@retail("e14_category_performance", tables(_PERF))
def _performance(t):
    return rounded(ex.category_performance(t), 2)


@retail("e15_review_summary", tables("""SELECT count(*) AS total_reviews, count(review_comment_message) AS reviews_with_text,
round(avg(review_score), 6) AS avg_rating, round(avg(review_score) FILTER (WHERE review_comment_message IS NOT NULL), 6) AS avg_rating_with_text,
round(avg(review_score) FILTER (WHERE review_comment_message IS NULL), 6) AS avg_rating_without_text FROM order_reviews"""))
def _reviews(t):
    return rounded(ex.review_summary(t.order_reviews))


@retail("e16_text_length", tables(described("text_length", "(SELECT length(review_comment_message) AS text_length FROM order_reviews WHERE review_comment_message IS NOT NULL) v")))
def _lengths(t):
    return rounded(ex.describe(ex.text_lengths(t.order_reviews), ["text_length"]))


@retail("e17_payments_by_type", tables("""SELECT payment_type, round(CAST(sum(payment_value) AS DOUBLE), 2) AS total,
round(CAST(sum(payment_value) AS DOUBLE) / count(payment_value), 4) AS mean, count(payment_value) AS count FROM order_payments GROUP BY 1"""))
def _payments(t):
    return rounded(ex.payments_by_type(t.order_payments), 4)


@retail("e18_card_installments", tables("""SELECT CAST(payment_installments AS BIGINT) AS value, count(*) AS count FROM order_payments
WHERE payment_type = 'credit_card' GROUP BY 1 ORDER BY 1 LIMIT 12"""))
def _installments(t):
    return rounded(ex.counts_by_value(ex.card_installments(t.order_payments), "payment_installments", 12))


def _histogram_sql(source, column, bound, bins):
    return f"""v AS (SELECT least(CAST({column} AS DOUBLE), {bound}) AS x FROM {source}),
l AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS w FROM v)
SELECT b AS bin, round(lo + b * w, 6) AS "from", count(*) AS count FROM (
  SELECT lo, w, CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((x - lo) / w), {bins - 1}) END AS BIGINT) AS b FROM v, l) y GROUP BY b, lo, w"""


_OPC = "(SELECT count(*) AS orders FROM customers JOIN shop_orders USING (customer_id) GROUP BY customer_unique_id) q"
_OV = "(SELECT sum(price) + sum(freight_value) AS total_value FROM order_items GROUP BY order_id) q"
_TL = "(SELECT length(review_comment_message) AS text_length FROM order_reviews WHERE review_comment_message IS NOT NULL) q"
# The sample's prices are about a thousand times those the bounds are made for.
_LIMITS = {**ex.HISTOGRAMS, "order_value_wide": (500_000, 50), "monetary_wide": (2_000_000, 50)}
for _slug, _prefix, _source, _column, _frame in [
    ("orders_per_customer", TABLES, _OPC, "orders", ex.orders_per_customer),
    ("order_value", TABLES, _OV, "total_value", lambda t: ex.order_values(t.order_items)),
    ("order_value_wide", TABLES, _OV, "total_value", lambda t: ex.order_values(t.order_items)),
    ("monetary_wide", ORDER_RFM, "rfm", "monetary", ex.order_grain_rfm),
    ("text_length", TABLES, _TL, "text_length", lambda t: ex.text_lengths(t.order_reviews)),
    ("recency", ORDER_RFM, "rfm", "recency", ex.order_grain_rfm),
    ("frequency", ORDER_RFM, "rfm", "frequency", ex.order_grain_rfm),
    ("monetary", ORDER_RFM, "rfm", "monetary", ex.order_grain_rfm),
]:
    _bound, _bins = _LIMITS[_slug]
    retail(f"e24_histogram_{_slug}", f"WITH {_prefix}, {_histogram_sql(_source, _column, _bound, _bins)}")(
        lambda t, frame=_frame, column=_column, limits=(_bound, _bins): rounded(ex.histogram(frame(t), column, *limits)))


@query("e11_events_by_hour", "SELECT hour(ts) AS value, count(*) AS count FROM events GROUP BY 1")
def _events(spark, sf_dir):
    events = read_sample(spark, sf_dir, "events").select(F.col("ts").alias("order_purchase_timestamp"))
    return rounded(ex.orders_by(events, "hour"))


@retail("e25_key_insights", tables(f"""
SELECT 'repeat_purchase_rate' AS metric, round(avg(CASE WHEN n > 1 THEN 100.0 ELSE 0.0 END), 6) AS number, CAST(NULL AS VARCHAR) AS text
  FROM (SELECT customer_unique_id, count(*) AS n FROM customers JOIN shop_orders USING (customer_id) GROUP BY 1) x
UNION ALL SELECT 'avg_delivery_days', round(avg(delivery_days), 6), NULL FROM {_DAYS}
UNION ALL SELECT 'reviews_with_text_pct', round(count(review_comment_message) * 100.0 / count(*), 6), NULL FROM order_reviews
UNION ALL SELECT * FROM (SELECT 'top_state', count(*), customer_state FROM customers GROUP BY customer_state ORDER BY 2 DESC, 3 LIMIT 1) s
UNION ALL SELECT * FROM (SELECT 'top_payment_type', count(*), payment_type FROM order_payments GROUP BY payment_type ORDER BY 2 DESC, 3 LIMIT 1) p"""))
def _insights(t):
    from clientele.plans.exploration_plan import key_insights
    return rounded(key_insights(t))
