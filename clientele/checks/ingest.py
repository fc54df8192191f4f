"""Checks of column rules, loads and constraints."""

from pyspark.sql import functions as F

from clientele.checks.ctes import tables
from clientele.checks.registry import query, retail, rounded
from clientele.operators import quality as q
from clientele.sources import ingest as ing
from clientele.sources import results as res
from clientele.sources.schema import TABLES as DECLARED
from clientele.sources.tables import derive_retail, read_sample, with_english_category

# Expressions that turn given columns into the texts a CSV file would hold.
_SIZE_TEXT = ("CASE WHEN p_partkey % 5 = 0 THEN 'abc' WHEN p_partkey % 5 = 1 THEN concat(cast(p_size as varchar(10)), '.0') "
              "WHEN p_partkey % 5 = 2 THEN concat(cast(p_size as varchar(10)), '.7') WHEN p_partkey % 5 = 3 THEN 'NaN' "
              "ELSE cast(p_size as varchar(10)) END")


@query("s02_missing_texts", f"SELECT p_partkey, CASE WHEN p_partkey % 5 <> 3 THEN {_SIZE_TEXT} END AS size FROM part")
def _missing_texts(spark, sf_dir):
    raw = read_sample(spark, sf_dir, "part").selectExpr("p_partkey", f"{_SIZE_TEXT} AS size")
    return raw.select("p_partkey", ing.missing_to_null(F.col("size")).alias("size"))


@query("s03_timestamps", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y/%m/%d %H') END AS parsed FROM orders""")
def _timestamps(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    raw = read_sample(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return raw.select("o_orderkey", F.date_format(ing.to_timestamp(F.col("t")), "yyyy/MM/dd HH").alias("parsed"))


@query("s04_rename", "SELECT p_partkey AS product_id, p_size AS product_weight_g FROM part")
def _rename(spark, sf_dir):
    df = read_sample(spark, sf_dir, "part").select("p_partkey", "p_size")
    return ing.rename_columns(df, {"p_partkey": "product_id", "p_size": "product_weight_g", "absent": "other"})


@query("s05_keep_columns", "SELECT p_size, p_partkey FROM part")
def _keep(spark, sf_dir):
    return ing.keep_columns(read_sample(spark, sf_dir, "part"), ["p_size", "absent", "p_partkey"])


@query("s06_integers", "SELECT p_partkey, CASE WHEN p_partkey % 5 IN (1, 4) THEN CAST(p_size AS BIGINT) END AS size FROM part")
def _integers(spark, sf_dir):
    raw = read_sample(spark, sf_dir, "part").selectExpr("p_partkey", f"{_SIZE_TEXT} AS size")
    return rounded(raw.select("p_partkey", ing.to_integer(F.col("size")).alias("size")))


@query("s07_nan_to_null", "SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS balance FROM customer")
def _nan(spark, sf_dir):
    value = F.when(F.col("c_nationkey") == 3, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return read_sample(spark, sf_dir, "customer").select("c_custkey", ing.nan_to_null(value).alias("balance"))


_LINE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("s08_keep_first", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE)}) AS k FROM lineitem) x WHERE k = 1""")
def _first(spark, sf_dir):
    df = read_sample(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_LINE)
    return ing.keep_first(df, ["l_orderkey", "l_linenumber"], _LINE).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


_EXPECTED = ["orders.parquet", "lineitem.parquet", "customer.parquet", "part.parquet", "supplier.parquet",
             "documents.parquet", "conversations.parquet", "geolocation.parquet"]


@query("s13_manifest", "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{'missing' if n == 'geolocation.parquet' else 'found'}')" for n in _EXPECTED) + ") v(file, status)")
def _manifest(spark, sf_dir):
    return ing.manifest_check(spark, sf_dir, _EXPECTED)


@query("s13_manifest_rows", " UNION ALL ".join(
    f"SELECT '{n}' AS file, 'found' AS status, count(*) AS rows FROM {n.removesuffix('.parquet')}" if n != "geolocation.parquet"
    else f"SELECT '{n}', 'missing', NULL" for n in _EXPECTED))
def _manifest_rows(spark, sf_dir):
    return ing.manifest_rows(spark, sf_dir, _EXPECTED)


_NAMES = ["customers", "orders", "order_items", "products", "order_payments", "order_reviews", "sellers"]


@retail("s15_row_counts", tables(" UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {'shop_orders' if n == 'orders' else n}" for n in _NAMES)))
def _counts(t):
    return ing.row_counts({n: getattr(t, n) for n in _NAMES})


@retail("s16_products_scan", tables("""SELECT product_id, product_category_name, product_category_name_english,
  CAST(product_weight_g AS BIGINT) AS product_weight_g, CAST(product_photos_qty AS BIGINT) AS product_photos_qty
  FROM products LEFT JOIN translation USING (product_category_name)"""))
def _scan(t):
    return rounded(with_english_category(t.products, t.product_category_translation).drop("product_name_length"))


@retail("s20_nested_json", tables("""SELECT order_id, '[' || string_agg('"' || payment_type || '"', ',' ORDER BY payment_type) || ']' AS methods
FROM (SELECT DISTINCT order_id, payment_type FROM order_payments) x GROUP BY 1"""))
def _json(t):
    grouped = t.order_payments.groupBy("order_id").agg(F.sort_array(F.collect_set("payment_type")).alias("methods"))
    return res.nested_to_json(grouped)


@retail("s26_parameterised_query", tables("""SELECT customer_unique_id, customer_state AS state FROM customers
  WHERE customer_state IN ('SP', 'RJ')"""))
def _params(t):
    t.customers.createOrReplaceTempView("clientele_customers")
    sql = "SELECT customer_unique_id, customer_state AS STATE FROM clientele_customers WHERE customer_state IN (:a, :b)"
    return res.run_query(t.customers.sparkSession, sql, {"a": "SP", "b": "RJ"})


@query("q01_duplicate_keys", """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _duplicates(spark, sf_dir):
    return q.duplicate_keys(read_sample(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_REQUIRED = ["product_id", "product_category_name", "product_weight_g"]


@retail("q02_missing_required", tables(" UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) - count({c}) AS missing FROM products" for c in _REQUIRED)))
def _required(t):
    return q.missing_required(t.products, _REQUIRED)


@retail("q03_orphans", tables("""SELECT product_category_name, count(*) AS count FROM products
  WHERE product_category_name IS NOT NULL AND product_category_name NOT IN (SELECT product_category_name FROM translation) GROUP BY 1"""))
def _orphans(t):
    return q.orphans(t.products, ["product_category_name"], t.product_category_translation, ["product_category_name"])


@retail("q03_orders_without_items", tables("""SELECT order_id, 1 AS count FROM shop_orders
  WHERE order_id NOT IN (SELECT order_id FROM order_items)"""))
def _empty_orders(t):
    return q.orphans(t.orders, ["order_id"], t.order_items, ["order_id"])


@query("q04_out_of_range", "SELECT event_id, round(value, 6) AS value FROM events WHERE NOT value BETWEEN 1 AND 50")
def _range(spark, sf_dir):
    return rounded(q.out_of_range(read_sample(spark, sf_dir, "events").select("event_id", "value"), "value", 1, 50))


@query("q05_too_long", """SELECT 'text' AS column, count(*) FILTER (WHERE length(text) > 500) AS count FROM documents
  UNION ALL SELECT 'lang', count(*) FILTER (WHERE length(lang) > 2) FROM documents""")
def _long(spark, sf_dir):
    return q.too_long(read_sample(spark, sf_dir, "documents"), {"text": 500, "lang": 2})


@query("q05_misfit_decimals", """SELECT 'o_totalprice' AS column, count(*) FILTER (WHERE abs(round(o_totalprice, 2)) >= 100000) AS count FROM orders""")
def _misfit(spark, sf_dir):
    return q.misfit_decimals(read_sample(spark, sf_dir, "orders"), {"o_totalprice": "decimal(7,2)"})


@query("q06_load_stamp", "SELECT c_custkey, '2024-01-01' AS created_at FROM customer")
def _stamp(spark, sf_dir):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = ing.stamp(read_sample(spark, sf_dir, "customer").select("c_custkey"), at)
    return df.select("c_custkey", F.date_format("created_at", "yyyy-MM-dd").alias("created_at"))


@query("q07_term_index", r"""SELECT term, doc_id, count(*) AS tf FROM (
  SELECT doc_id, unnest(string_split(lower(regexp_replace(text, '[^\p{L}\p{N}]+', ' ', 'g')), ' ')) AS term FROM documents) x
  WHERE term <> '' GROUP BY 1, 2""")
def _terms(spark, sf_dir):
    return q.term_index(read_sample(spark, sf_dir, "documents"), "doc_id", "text")


@retail("q08_constraint_report", tables("""SELECT * FROM (
  SELECT 'order_items' AS "table", 'primary_key' AS rule, 'order_id,order_item_id' AS detail, count(*) AS count
    FROM (SELECT 1 FROM order_items GROUP BY order_id, order_item_id HAVING count(*) > 1) d
  UNION ALL SELECT 'order_items', 'foreign_key', 'order_id -> orders', count(*) FROM order_items WHERE order_id NOT IN (SELECT order_id FROM shop_orders)
  UNION ALL SELECT 'order_items', 'foreign_key', 'product_id -> products', count(*) FROM order_items WHERE product_id NOT IN (SELECT product_id FROM products)
  UNION ALL SELECT 'order_items', 'foreign_key', 'seller_id -> sellers', count(*) FROM order_items WHERE seller_id NOT IN (SELECT seller_id FROM sellers)
) r WHERE count > 0"""))
def _report(t):
    parents = {"orders": t.orders, "products": t.products, "sellers": t.sellers}
    return q.check_table(t.order_items, DECLARED["order_items"], parents)


# The declared columns that the sample tables hold; the SQL counts their values.
_HELD = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "products": ["product_id", "product_category_name", "product_name_length", "product_photos_qty", "product_weight_g"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_comment_message", "review_creation_date"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
}
# a column of a seller is null where the one it is derived from is
SELLERS = ("(SELECT s_suppkey AS seller_id, s_suppkey AS seller_zip_code_prefix, s_suppkey AS seller_city, s_nationkey AS seller_state "
           "FROM supplier) z")


def _filled_sql(table, field):
    held = field.name in _HELD[table]
    source = {"orders": "shop_orders", "sellers": SELLERS}.get(table, table)
    return (f"SELECT '{table}' AS \"table\", '{field.name}' AS column, '{field.kind}' AS declared, {held} AS present, "
            f"{f'count({field.name})' if held else 'NULL'} AS filled, count(*) AS rows FROM {source}")


@retail("s01_declared_columns", tables(" UNION ALL ".join(
    _filled_sql(n, f) for n in _NAMES for f in DECLARED[n].fields)))
def _declared_columns(t):
    """Every declared column: whether the table has it, and how many of its rows hold a value."""
    return q.filled_columns({n: (getattr(t, n), DECLARED[n]) for n in _NAMES})


@query("s01_declared_types")
def _declared(spark, sf_dir):
    """Given tables against the declared columns: which exist and with which type."""
    t = derive_retail(spark, sf_dir)
    present = {n: dict(getattr(t, n).dtypes) for n in _NAMES}
    rows = [(n, f.name, f.kind, present[n].get(f.name)) for n in _NAMES for f in DECLARED[n].fields]
    declared = spark.createDataFrame(rows, "table string, column string, declared string, found string")
    return declared.join(ing.row_counts({n: getattr(t, n) for n in _NAMES}), "table")


