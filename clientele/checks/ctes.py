"""The derivation of ``sources.tables`` again, as plain SQL for the oracle."""

TABLES = """
customers AS (
  SELECT c_custkey AS customer_id, CAST(floor(c_custkey / 2) AS BIGINT) AS customer_unique_id,
    lpad(CAST(c_custkey % 99999 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
    (['sao paulo','Rio de Janeiro','campinas','curitiba','salvador','BRASILIA','recife'])[CAST(c_custkey % 7 + 1 AS INTEGER)] AS customer_city,
    (['AC','AP','AM','PA','RO','RR','TO','AL','BA','CE','MA','PB','PE','PI','RN','SE','DF','GO','MT','MS','ES','MG','RJ','SP','XX'])[c_nationkey + 1] AS customer_state
  FROM customer),
shop_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END AS order_status,
    o_orderdate + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER) AS order_purchase_timestamp,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 1 HOUR * CAST(o_orderkey % 24 + 1 AS INTEGER) END AS order_approved_at,
    o_orderdate + INTERVAL 1 HOUR * CAST(o_orderkey % 24 + 48 AS INTEGER) AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 29 <> 0 THEN o_orderdate + INTERVAL 1 HOUR * CAST(60 + (o_orderkey * 13) % 900 AS INTEGER) END AS order_delivered_customer_date,
    o_orderdate + INTERVAL 480 HOUR AS order_estimated_delivery_date
  FROM orders),
order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
    l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS DECIMAL(10,2)) AS freight_value
  FROM lineitem),
products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS product_category_name,
    CASE WHEN p_partkey % 50 <> 0 THEN length(p_name) END AS product_name_length,
    CASE WHEN p_partkey % 50 <> 0 THEN p_size * 100 END AS product_weight_g,
    CASE WHEN p_partkey % 50 <> 0 THEN 1 + p_partkey % 6 END AS product_photos_qty
  FROM part),
translation AS (
  SELECT * FROM (SELECT DISTINCT p_type AS product_category_name,
    CASE p_type WHEN 'ECONOMY' THEN 'electronics' WHEN 'STANDARD' THEN 'home' WHEN 'PROMO' THEN 'beauty' WHEN 'SMALL' THEN 'fashion' WHEN 'LARGE' THEN 'furniture' END AS product_category_name_english
    FROM part) x WHERE product_category_name_english IS NOT NULL),
methods AS (
  SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'credit_card' WHEN '3-MEDIUM' THEN 'boleto' WHEN '4-NOT SPECIFIED' THEN 'voucher' WHEN '5-LOW' THEN 'debit_card' END AS method
  FROM orders),
order_payments AS (
  SELECT o_orderkey AS order_id, 1 AS payment_sequential, method AS payment_type,
    CASE WHEN method = 'credit_card' THEN 1 + o_orderkey % 10 ELSE 1 END AS payment_installments, CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value
  FROM methods WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
  UNION ALL SELECT o_orderkey, 2, 'voucher', 1, CAST(10 AS DECIMAL(10,2)) FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'),
order_reviews AS (
  SELECT r.review_id, r.order_id, r.review_score, r.review_creation_date, d.text AS review_comment_message
  FROM (SELECT o_orderkey * 2 AS review_id, o_orderkey AS order_id, 1 + (o_orderkey * 7) % 5 AS review_score, o_orderdate + INTERVAL 240 HOUR AS review_creation_date FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey * 2 + 1, o_orderkey, 1 + (o_orderkey * 3) % 5, o_orderdate + INTERVAL 264 HOUR FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH') r
  LEFT JOIN documents d ON d.doc_id = r.order_id
  UNION ALL SELECT -d.doc_id - 1, o.o_orderkey, 1 + (d.doc_id * 7) % 5, o.o_orderdate + INTERVAL 240 HOUR, d.text
  FROM documents d LEFT JOIN orders o ON o.o_orderkey = d.doc_id
  WHERE d.doc_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')),
sellers AS (
  SELECT s_suppkey AS seller_id, lpad(CAST(s_suppkey % 99999 AS VARCHAR), 5, '0') AS seller_zip_code_prefix FROM supplier)
"""

BASE = TABLES + """,
base AS (
  SELECT c.customer_unique_id, c.customer_city, c.customer_state, c.customer_zip_code_prefix,
    o.order_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
    o.order_delivered_customer_date, o.order_estimated_delivery_date,
    i.product_id, i.seller_id, i.price, i.freight_value, p.product_category_name, t.product_category_name_english AS category_english,
    p.product_weight_g, p.product_photos_qty, y.payment_type, y.payment_installments, y.payment_value, v.review_score,
    CASE WHEN v.order_id IS NULL THEN NULL WHEN v.review_comment_message IS NOT NULL THEN 1 ELSE 0 END AS has_review_text,
    CASE WHEN v.order_id IS NULL THEN NULL ELSE coalesce(length(v.review_comment_message), 0) END AS review_text_length
  FROM customers c JOIN shop_orders o ON c.customer_id = o.customer_id
  JOIN order_items i ON o.order_id = i.order_id
  LEFT JOIN products p ON i.product_id = p.product_id
  LEFT JOIN translation t ON p.product_category_name = t.product_category_name
  LEFT JOIN order_payments y ON o.order_id = y.order_id
  LEFT JOIN order_reviews v ON o.order_id = v.order_id),
ref AS (SELECT max(order_purchase_timestamp) + INTERVAL 1 DAY AS d FROM base)
"""


def tables(sql: str) -> str:
    return f"WITH {TABLES}\n{sql}"


def base(sql: str) -> str:
    return f"WITH {BASE}\n{sql}"


def days(later: str, earlier: str) -> str:
    """Whole days between two timestamps, rounded down."""
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"
