"""Checks of the single joins, filters and window steps the builders are made of."""

from pyspark.sql import functions as F

from clientele.checks.ctes import BASE, base, tables
from clientele.checks.registry import query, retail, rounded
from clientele.functions import semantics as sm
from clientele.operators import base as facts_ops
from clientele.operators import conversation as cv
from clientele.operators import explore as ex
from clientele.operators import features as fe
from clientele.operators import prepare as pr
from clientele.operators import quality as q
from clientele.operators.rank import global_rank
from clientele.sources.tables import read_sample, with_english_category

ID = fe.CUSTOMER


@retail("p01_delivered_orders", tables("SELECT order_id, order_status FROM shop_orders WHERE order_status = 'delivered'"))
def _delivered(t):
    return t.orders.filter(F.col("order_status") == "delivered").select("order_id", "order_status")


@retail("p02_card_payments", tables("SELECT order_id, CAST(payment_installments AS BIGINT) AS payment_installments FROM order_payments WHERE payment_type = 'credit_card'"))
def _cards(t):
    return rounded(t.order_payments.filter(F.col("payment_type") == "credit_card").select("order_id", "payment_installments"))


@retail("p03_null_counts", tables("""SELECT count(review_comment_message) AS with_text, count(*) - count(review_comment_message) AS without_text FROM order_reviews"""))
def _nulls(t):
    text = F.col("review_comment_message")
    return t.order_reviews.agg(F.count_if(text.isNotNull()).alias("with_text"), F.count_if(text.isNull()).alias("without_text"))


@retail("p04_major_cities", tables("SELECT customer_id, customer_city FROM customers WHERE lower(customer_city) IN ('sao paulo','rio de janeiro','belo horizonte','brasilia','curitiba')"))
def _cities(t):
    return t.customers.filter(F.lower("customer_city").isin(fe.MAJOR_CITIES)).select("customer_id", "customer_city")


@query("p05_contains_ignoring_case", "SELECT doc_id FROM documents WHERE contains(lower(text), 'the on')")
def _contains(spark, sf_dir):
    return read_sample(spark, sf_dir, "documents").filter(sm.contains_ci(F.col("text"), F.lit("The ON"))).select("doc_id")


@retail("p06_review_text_columns", tables("""SELECT review_id, CASE WHEN review_comment_message IS NOT NULL THEN 1 ELSE 0 END AS has_review_text,
  coalesce(length(review_comment_message), 0) AS review_text_length FROM order_reviews"""))
def _text_columns(t):
    text = F.col("review_comment_message")
    return rounded(t.order_reviews.select("review_id", F.when(text.isNotNull(), 1).otherwise(0).alias("has_review_text"),
                                          F.coalesce(F.length(text), F.lit(0)).alias("review_text_length")))


@retail("p10_clipped_values", tables("""SELECT order_id, round(least(CAST(sum(price) + sum(freight_value) AS DOUBLE), 50000), 2) AS clipped FROM order_items GROUP BY 1"""))
def _clipped(t):
    values = ex.order_values(t.order_items)
    return rounded(values.select("order_id", sm.clip_upper(F.col("total_value").cast("double"), 50000.0).alias("clipped")), 2)


@retail("j01_customer_orders", tables("SELECT customer_unique_id, order_id, customer_state FROM customers JOIN shop_orders USING (customer_id)"))
def _customer_orders(t):
    return facts_ops.customer_orders(t).select(ID, "order_id", "customer_state")


@retail("j02_order_lines", tables("""SELECT order_id, product_id, seller_id, order_status FROM shop_orders JOIN order_items USING (order_id)"""))
def _lines(t):
    return t.orders.join(t.order_items, "order_id").select("order_id", "product_id", "seller_id", "order_status")


@retail("j03_item_products", tables("""SELECT order_id, i.product_id, category AS category_english, CAST(product_weight_g AS BIGINT) AS product_weight_g
  FROM order_items i LEFT JOIN (SELECT p.*, t.product_category_name_english AS category FROM products p LEFT JOIN translation t USING (product_category_name)) p ON i.product_id = p.product_id"""))
def _item_products(t):
    return rounded(facts_ops.item_lines(t).select("order_id", "product_id", "category_english", "product_weight_g"))


@retail("j04_translated_products", tables("SELECT product_id, product_category_name_english FROM products LEFT JOIN translation USING (product_category_name)"))
def _translated(t):
    return with_english_category(t.products, t.product_category_translation).select("product_id", "product_category_name_english")


@retail("j05_order_payment_rows", tables("SELECT order_id, payment_type FROM shop_orders LEFT JOIN order_payments USING (order_id)"))
def _payment_rows(t):
    return t.orders.select("order_id").join(t.order_payments.select("order_id", "payment_type"), "order_id", "left")


@retail("j06_order_review_rows", tables("SELECT order_id, CAST(review_score AS BIGINT) AS review_score FROM shop_orders LEFT JOIN order_reviews USING (order_id)"))
def _review_rows(t):
    return rounded(t.orders.select("order_id").join(t.order_reviews.select("order_id", "review_score"), "order_id", "left"))


@retail("j08_product_performance", tables("""SELECT product_id, coalesce(n, 0) AS order_count, round(CAST(v AS DOUBLE), 2) AS total_revenue
  FROM products LEFT JOIN (SELECT product_id, count(*) AS n, sum(price) AS v FROM order_items GROUP BY 1) s USING (product_id)"""))
def _product_performance(t):
    joined = t.products.select("product_id").join(ex.product_sales(t.order_items), "product_id", "left")
    return rounded(joined.select("product_id", sm.zero_if_null(F.col("order_count")).alias("order_count"), "total_revenue"), 2)


@retail("j09_valued_orders", tables("""SELECT order_id, round(CAST(total AS DOUBLE), 2) AS total_value, customer_unique_id FROM shop_orders
  JOIN (SELECT order_id, sum(price) + sum(freight_value) AS total FROM order_items GROUP BY 1) v USING (order_id) JOIN customers USING (customer_id)"""))
def _valued(t):
    values = ex.order_values(t.order_items).select("order_id", "total_value")
    joined = t.orders.select("order_id", "customer_id").join(values, "order_id").join(t.customers.select("customer_id", ID), "customer_id")
    return rounded(joined.select("order_id", "total_value", ID), 2)


@retail("j12_state_statistics", base("""SELECT customer_state AS state, count(DISTINCT customer_unique_id) AS state_customer_count,
  round(CAST(sum(price) AS DOUBLE) / count(*), 6) AS state_avg_price FROM base GROUP BY 1"""))
def _states(t):
    return rounded(fe.state_statistics(facts_ops.order_facts(t)))


@retail("w02_purchase_gaps", "WITH " + BASE + """, d AS (SELECT customer_unique_id, order_purchase_timestamp AS ts, count(*) AS n FROM base GROUP BY 1, 2),
g AS (SELECT customer_unique_id, n, floor((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY customer_unique_id ORDER BY ts))) / 86400000000.0) AS gap FROM d)
SELECT customer_unique_id, round(CASE WHEN sum(n) > 1 THEN coalesce(sum(gap), 0) / (sum(n) - 1) END, 6) AS avg_inter_purchase_days FROM g GROUP BY 1""")
def _gaps(t):
    return rounded(fe.purchase_gaps(facts_ops.order_facts(t)))


@retail("w02_gaps_order_grain", tables("""SELECT customer_unique_id, round(CASE WHEN count(*) > 1 THEN coalesce(sum(gap), 0) / (count(*) - 1) END, 6) AS avg_inter_purchase_days FROM (
  SELECT customer_unique_id, floor((epoch_us(order_purchase_timestamp) - epoch_us(lag(order_purchase_timestamp) OVER (
    PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp))) / 86400000000.0) AS gap
  FROM shop_orders JOIN customers USING (customer_id) WHERE order_id IN (SELECT order_id FROM order_items)) x GROUP BY 1"""))
def _order_gaps(t):
    return rounded(fe.purchase_gaps(facts_ops.order_facts(t, "order")))


@query("w11_array_tail", """SELECT user_id, array_to_string(l[greatest(len(l) - 4, 1):len(l)], ',') AS tail FROM (
  SELECT user_id, list(DISTINCT event_type ORDER BY event_type) AS l FROM events GROUP BY 1) x""")
def _tail(spark, sf_dir):
    kinds = read_sample(spark, sf_dir, "events").groupBy("user_id").agg(F.sort_array(F.collect_set("event_type")).alias("l"))
    return kinds.select("user_id", F.array_join(cv.tail(F.col("l"), 5), ",").alias("tail"))


@query("w12_distinct_union", """SELECT doc_id, lang || CASE WHEN source <> lang AND source <> '' THEN ',' || source ELSE '' END AS names FROM documents""")
def _union(spark, sf_dir):
    df = read_sample(spark, sf_dir, "documents")
    merged = cv.add_distinct(F.array("lang"), F.array(F.col("source"), F.col("lang"), F.lit(""), F.lit(None).cast("string")))
    return df.select("doc_id", F.array_join(merged, ",").alias("names"))


@query("w01_event_rank", "SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS rank FROM events")
def _event_rank(spark, sf_dir):
    return global_rank(read_sample(spark, sf_dir, "events").select("event_id", "value"), ["value", "event_id"]).drop("value")


@query("q07_review_terms", r"""SELECT term, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest(string_split(lower(
  regexp_replace(text, '[^\p{L}\p{N}]+', ' ', 'g')), ' ')) AS term FROM documents) x WHERE term <> '' GROUP BY 1""")
def _terms(spark, sf_dir):
    index = q.term_index(read_sample(spark, sf_dir, "documents"), "doc_id", "text")
    return index.groupBy("term").agg(F.count("*").alias("docs"))


@retail("p08_columns_by_kind", tables("""SELECT 'numeric' AS kind, count(*) AS values_present FROM products WHERE product_weight_g IS NOT NULL
  UNION ALL SELECT 'text', count(*) FROM products WHERE product_category_name IS NOT NULL"""))
def _kinds(t):
    df = t.products.select("product_category_name", "product_weight_g")
    parts = [df.agg(F.count(pr.columns_of_kind(df, kind)[0]).alias("values_present")).select(F.lit(kind).alias("kind"), "values_present")
             for kind in ("numeric", "text")]
    return parts[0].unionByName(parts[1])


@retail("s17_review_texts", "SELECT count(DISTINCT text) AS texts, sum(DISTINCT length(text)) AS lengths FROM documents")
def _review_texts(t):
    """Every document is the text of a review."""
    text = F.col("review_comment_message")
    return t.order_reviews.agg(F.countDistinct(text).alias("texts"), F.sum_distinct(F.length(text)).cast("long").alias("lengths"))
