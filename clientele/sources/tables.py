"""The retail tables the operators read, and a derivation of them.

``RetailTables`` is the set of frames every builder takes. ``open_tables``
reads it from a folder of Parquet tables (the output of ``ingest``).
``derive_retail`` builds the same shapes from the star-schema sample tables,
so that all queries run on whole given tables at any scale factor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RetailTables:
    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    product_category_translation: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    sellers: DataFrame | None = None
    geolocation: DataFrame | None = None
    #: For reviews that are joined from texts: these reviews, and what builds them around a value of the texts.
    joined_reviews: tuple[DataFrame, Callable[[Column, str], DataFrame]] | None = None

    def reviews_with(self, value: Callable[[Column], Column], name: str) -> DataFrame:
        """``order_reviews`` with ``value(text)`` as ``name`` instead of the text; ``value`` of a missing text must be missing.

        Where texts are joined to reviews, the value is taken before, so that it is moved and not the text.
        """
        text = F.col("review_comment_message")
        if self.joined_reviews and self.joined_reviews[0] is self.order_reviews:
            return self.joined_reviews[1](value(text), name)
        return self.order_reviews.withColumn(name, value(text)).drop("review_comment_message")


TABLE_NAMES = [name for name in RetailTables.__dataclass_fields__ if name != "joined_reviews"]


def open_tables(spark: SparkSession, folder: str) -> RetailTables:
    """Read ingested tables; products carry their English category too."""
    return RetailTables(**{name: spark.read.parquet(f"{folder}/{name}") for name in TABLE_NAMES})


def with_english_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their translated category, unmatched ones kept."""
    return products.join(
        translation.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        "left",
    )


def read_sample(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed values of the derivation: one state per nation key, one city per residue.
STATES = ["AC", "AP", "AM", "PA", "RO", "RR", "TO", "AL", "BA", "CE", "MA", "PB", "PE",
          "PI", "RN", "SE", "DF", "GO", "MT", "MS", "ES", "MG", "RJ", "SP", "XX"]
CITIES = ["sao paulo", "Rio de Janeiro", "campinas", "curitiba", "salvador", "BRASILIA", "recife"]
CATEGORY_NAMES = {"ECONOMY": "electronics", "STANDARD": "home", "PROMO": "beauty",
                  "SMALL": "fashion", "LARGE": "furniture"}
PAYMENT_BY_PRIORITY = {"1-URGENT": "credit_card", "2-HIGH": "credit_card", "3-MEDIUM": "boleto",
                       "4-NOT SPECIFIED": "voucher", "5-LOW": "debit_card"}


def _pick(values: list[str], index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _case(mapping: dict[str, str], column):
    branches = None
    for key, value in mapping.items():
        branches = F.when(column == key, value) if branches is None else branches.when(column == key, value)
    return branches


def derive_retail(spark: SparkSession, sf_dir: str) -> RetailTables:
    customer = read_sample(spark, sf_dir, "customer")
    raw_orders = read_sample(spark, sf_dir, "orders")
    lineitem = read_sample(spark, sf_dir, "lineitem")
    part = read_sample(spark, sf_dir, "part")
    supplier = read_sample(spark, sf_dir, "supplier")
    documents = read_sample(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("order_id"), F.col("text").alias("review_comment_message")
    )

    key, cust = F.col("o_orderkey"), F.col("c_custkey")

    def hours_after(n):
        return F.col("o_orderdate") + F.make_dt_interval(hours=(F.lit(n) if isinstance(n, int) else n).cast("int"))

    customers = customer.select(
        cust.alias("customer_id"),
        F.floor(cust / 2).cast("long").alias("customer_unique_id"),
        F.lpad((cust % 99999).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        _pick(CITIES, cust % 7).alias("customer_city"),
        _pick(STATES, F.col("c_nationkey")).alias("customer_state"),
    )
    orders = raw_orders.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _case({"F": "delivered", "O": "shipped", "P": "canceled"}, F.col("o_orderstatus")).alias("order_status"),
        hours_after(key % 24).alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "P", hours_after(key % 24 + 1)).alias("order_approved_at"),
        hours_after(key % 24 + 48).alias("order_delivered_carrier_date"),
        F.when((F.col("o_orderstatus") == "F") & (key % 29 != 0), hours_after(60 + (key * 13) % 900))
        .alias("order_delivered_customer_date"),
        hours_after(480).alias("order_estimated_delivery_date"),
    )
    items = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"),
    )
    unlabelled = F.col("p_partkey") % 50 == 0
    products = part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(~unlabelled, F.col("p_type")).alias("product_category_name"),
        F.when(~unlabelled, F.length("p_name")).cast("int").alias("product_name_length"),
        F.when(~unlabelled, F.col("p_size") * 100).cast("int").alias("product_weight_g"),
        F.when(~unlabelled, 1 + F.col("p_partkey") % 6).cast("int").alias("product_photos_qty"),
    )
    # One name per observed product type; types without a translation stay out.
    translation = (
        part.select(F.col("p_type").alias("product_category_name")).distinct()
        .withColumn("product_category_name_english", _case(CATEGORY_NAMES, F.col("product_category_name")))
        .filter(F.col("product_category_name_english").isNotNull())
    )
    method = _case(PAYMENT_BY_PRIORITY, F.col("o_orderpriority"))
    total = F.col("o_totalprice").cast("decimal(10,2)")
    unpaid = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    split_payment = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")
    payments = raw_orders.filter(~unpaid).select(
        key.alias("order_id"), F.lit(1).alias("payment_sequential"), method.alias("payment_type"),
        F.when(method == "credit_card", 1 + key % 10).otherwise(1).cast("int").alias("payment_installments"),
        total.alias("payment_value"),
    ).unionByName(raw_orders.filter(split_payment).select(
        key.alias("order_id"), F.lit(2).alias("payment_sequential"), F.lit("voucher").alias("payment_type"),
        F.lit(1).alias("payment_installments"), F.lit(10).cast("decimal(10,2)").alias("payment_value"),
    ))
    second_review = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    reviews = raw_orders.filter(F.col("o_orderstatus") != "P").select(
        (key * 2).alias("review_id"), key.alias("order_id"),
        (1 + (key * 7) % 5).cast("int").alias("review_score"),
        hours_after(240).alias("review_creation_date"),
    ).unionByName(raw_orders.filter(second_review).select(
        (key * 2 + 1).alias("review_id"), key.alias("order_id"),
        (1 + (key * 3) % 5).cast("int").alias("review_score"),
        hours_after(264).alias("review_creation_date"),
    ))
    # A document whose number is not that of a reviewed order is a review too: of the order with its number, if there is one.
    # Texts are long, so each is moved once: both joins are on its number, and reviews without a text stay out of them.
    unreviewed = raw_orders.filter(F.coalesce(F.col("o_orderstatus") == "P", F.lit(True))).select(
        key.alias("_order"), hours_after(240).alias("_date"))
    doc, found = F.col("_doc"), F.col("order_id").isNotNull()

    def reviews_around(value: Column, name: str) -> DataFrame:
        valued = documents.select(F.col("order_id").alias("_doc"), value.alias(name))
        written = (
            valued.join(reviews, doc == F.col("order_id"), "left")
            .join(unreviewed, (doc == F.col("_order")) & ~found, "left")
            .select(
                F.when(found, F.col("review_id")).otherwise(-doc - 1).alias("review_id"),
                F.coalesce("order_id", "_order").alias("order_id"),
                F.when(found, F.col("review_score")).otherwise((1 + (doc * 7) % 5).cast("int")).alias("review_score"),
                F.when(found, F.col("review_creation_date")).otherwise(F.col("_date")).alias("review_creation_date"),
                name)
        )
        return written.unionByName(reviews.join(documents.select("order_id"), "order_id", "left_anti").select(
            "review_id", "order_id", "review_score", "review_creation_date", F.lit(None).cast(valued.schema[name].dataType).alias(name)))

    order_reviews = reviews_around(F.col("review_comment_message"), "review_comment_message")
    sellers = supplier.select(
        F.col("s_suppkey").alias("seller_id"),
        F.lpad((F.col("s_suppkey") % 99999).cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        _pick(CITIES, F.col("s_suppkey") % 7).alias("seller_city"),
        _pick(STATES, F.col("s_nationkey")).alias("seller_state"),
    )
    return RetailTables(customers, orders, items, products, translation, payments, order_reviews, sellers,
                        joined_reviews=(order_reviews, reviews_around))
