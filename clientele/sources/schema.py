"""Declared shape of the nine source tables and of their CSV files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # string, int, timestamp or decimal(p,s)
    required: bool = False
    length: int | None = None
    header: str | None = None  # name in the CSV file where it differs

    @property
    def csv_name(self) -> str:
        return self.header or self.name


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    file_suffix: str  # the file is <anything><file_suffix>
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    ranges: tuple[tuple[str, int, int], ...] = ()
    free_text: bool = False  # quoted values may hold line breaks
    keep_first: bool = False  # repeated keys occur in the file

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T._parse_datatype_string(f.kind), True) for f in self.fields])


def _text(name, length=None, required=False, header=None):
    return Field(name, "string", required, length, header)


def _number(name, required=False, header=None):
    return Field(name, "int", required, None, header)


def _time(name, required=False):
    return Field(name, "timestamp", required)


def _refers(column, parent):
    return ForeignKey((column,), parent, (column,))


# Tables in load order, with types, lengths, keys and references.
TABLES = {t.name: t for t in (
    Table("customers", "customers_dataset.csv", (
        _text("customer_id", 32, True), _text("customer_unique_id", 32, True),
        _text("customer_zip_code_prefix", 5, True), _text("customer_city", 100, True), _text("customer_state", 2, True),
    ), ("customer_id",)),
    Table("geolocation", "geolocation_dataset.csv", (
        _text("geolocation_zip_code_prefix", 5, True), Field("geolocation_lat", "decimal(10,8)", True),
        Field("geolocation_lng", "decimal(11,8)", True), _text("geolocation_city", 100, True),
        _text("geolocation_state", 2, True),
    ), ()),
    Table("sellers", "sellers_dataset.csv", (
        _text("seller_id", 32, True), _text("seller_zip_code_prefix", 5, True), _text("seller_city", 100, True),
        _text("seller_state", 2, True),
    ), ("seller_id",)),
    Table("product_category_translation", "product_category_name_translation.csv", (
        _text("product_category_name", 100, True), _text("product_category_name_english", 100, True),
    ), ("product_category_name",)),
    Table("products", "products_dataset.csv", (
        _text("product_id", 32, True), _text("product_category_name", 100),
        _number("product_name_length", header="product_name_lenght"),
        _number("product_description_length", header="product_description_lenght"),
        _number("product_photos_qty"), _number("product_weight_g"), _number("product_length_cm"),
        _number("product_height_cm"), _number("product_width_cm"),
    ), ("product_id",), (_refers("product_category_name", "product_category_translation"),)),
    Table("orders", "orders_dataset.csv", (
        _text("order_id", 32, True), _text("customer_id", 32, True), _text("order_status", 20, True),
        _time("order_purchase_timestamp", True), _time("order_approved_at"), _time("order_delivered_carrier_date"),
        _time("order_delivered_customer_date"), _time("order_estimated_delivery_date"),
    ), ("order_id",), (_refers("customer_id", "customers"),)),
    Table("order_items", "order_items_dataset.csv", (
        _text("order_id", 32, True), _number("order_item_id", True), _text("product_id", 32, True),
        _text("seller_id", 32, True), _time("shipping_limit_date", True), Field("price", "decimal(10,2)", True),
        Field("freight_value", "decimal(10,2)", True),
    ), ("order_id", "order_item_id"),
        (_refers("order_id", "orders"), _refers("product_id", "products"), _refers("seller_id", "sellers"))),
    Table("order_payments", "order_payments_dataset.csv", (
        _text("order_id", 32, True), _number("payment_sequential", True), _text("payment_type", 20, True),
        _number("payment_installments", True), Field("payment_value", "decimal(10,2)", True),
    ), ("order_id", "payment_sequential"), (_refers("order_id", "orders"),)),
    Table("order_reviews", "order_reviews_dataset.csv", (
        _text("review_id", 32, True), _text("order_id", 32, True), _number("review_score", True),
        _text("review_comment_title", 500), _text("review_comment_message"), _time("review_creation_date", True),
        _time("review_answer_timestamp"),
    ), ("review_id",), (_refers("order_id", "orders"),), (("review_score", 1, 5),), free_text=True, keep_first=True),
)}

# Texts that mean "missing" in a CSV file.
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                 "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
