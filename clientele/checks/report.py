"""Check of the whole exploration report, all sections in one table.

The SQL puts together the SQL of the sections, each of which has a query of
its own, without their rounding.
"""

from clientele.checks.ctes import tables
from clientele.checks.explore import _DAYS, _OPC, _RETAIL_COLUMNS, _TL, _counts_sql, _profile_sql, described
from clientele.checks.ingest import SELLERS
from clientele.checks.registry import ORACLES, retail, rounded, without_rounding
from clientele.checks.segments import ORDER_RFM, _COLS
from clientele.plans.exploration_plan import exploration_report, report_table, section_keys

_COLUMNS = _RETAIL_COLUMNS | {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "product_category_translation": ["product_category_name", "product_category_name_english"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
}
_SOURCE = {"orders": "shop_orders", "sellers": SELLERS, "product_category_translation": "translation"}
_COUNT, _VALUE, _BINS = ["count"], ["value"], ["from", "count"]
_TIMES = ", ".join(f"strftime({f}(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS {n}" for n, f in (("first_order", "min"), ("last_order", "max")))
_OWN_RFM = "(SELECT *, CAST(monetary AS DOUBLE) / frequency AS avg_order_value FROM rfm) x"

# section: its SQL, the measures that are numbers and those that are texts
_SECTIONS = {
    "table_profile": (tables(" UNION ALL ".join(_profile_sql(n, _SOURCE.get(n, n), c) for n, c in _COLUMNS.items())),
                      ["rows", "columns", "missing_cells", "missing_pct"], []),
    "distinct_counts": (ORACLES["e04_distinct_counts"], _VALUE, []),
    "repeat_customers": (_counts_sql("customer_unique_id", "customers"), _COUNT, []),
    "customers_by_state": (ORACLES["e05_state_counts"], _COUNT, []),
    "top_cities": (ORACLES["e06_top_cities"], _COUNT, []),
    "orders_per_customer_stats": (tables(described("orders", _OPC)), _VALUE, []),
    "order_overview": (tables(f"SELECT count(*) AS total_orders, {_TIMES} FROM shop_orders"), ["total_orders"], ["first_order", "last_order"]),
    "order_status": (ORACLES["e05_order_status_counts"], _COUNT, []),
    "order_value_stats": (ORACLES["e02_describe_order_value"], _VALUE, []),
    "orders_by_month": (ORACLES["e11_orders_by_month"], _COUNT, []),
    "orders_by_weekday": (ORACLES["e11_orders_by_weekday"], _COUNT, []),
    "orders_by_hour": (ORACLES["e11_orders_by_hour"], _COUNT, []),
    "delivery_time_stats": (ORACLES["e12_delivery_days"], _VALUE, []),
    "category_distribution": (ORACLES["e05_category_counts"], _COUNT, []),
    "category_performance": (ORACLES["e14_category_performance"], ["product_count", "order_count", "total_revenue"], []),
    "product_sales_stats": (tables(described("order_count", "(SELECT count(*) AS order_count FROM order_items GROUP BY product_id) v")), _VALUE, []),
    "review_summary": (ORACLES["e15_review_summary"], ["total_reviews", "reviews_with_text", "avg_rating", "avg_rating_with_text",
                                                       "avg_rating_without_text"], []),
    "rating_distribution": (ORACLES["e07_rating_counts"], _COUNT, []),
    "rating_stats": (tables(described("review_score", "order_reviews")), _VALUE, []),
    "text_length_stats": (tables(described("text_length", _TL)), _VALUE, []),
    "payment_types": (ORACLES["e05_payment_type_counts"], _COUNT, []),
    "payments_by_type": (ORACLES["e17_payments_by_type"], ["total", "mean", "count"], []),
    "card_installments": (ORACLES["e18_card_installments"], _COUNT, []),
    "installment_stats": (tables(described("payment_installments", "(SELECT * FROM order_payments WHERE payment_type = 'credit_card') v")), _VALUE, []),
    "rfm_stats": (f"WITH {ORDER_RFM} " + " UNION ALL ".join(described(c, _OWN_RFM) for c in _COLS), _VALUE, []),
    "segment_distribution": (f"SELECT segment AS value, count FROM ({ORACLES['e21_exploration_segments']}) e", _COUNT, []),
    "heat_map": (ORACLES["e22_heat_map"], ["1", "2", "3", "4", "5"], []),
    "correlations": (ORACLES["e23_correlations"], ["corr"], []),
    "key_insights": (ORACLES["e25_key_insights"], ["number"], ["text"]),
    **{f"histogram_{n}": (ORACLES[f"e24_histogram_{n}"], _BINS, [])
       for n in ("orders_per_customer", "order_value", "text_length", "recency", "frequency", "monetary")},
}


def _section_sql(section: str, sql: str, numbers: list[str], texts: list[str]) -> str:
    keys = ", ".join(f'CAST("{k}" AS VARCHAR)' for k in section_keys(section))
    cells = [(c, f'round(CAST("{c}" AS DOUBLE), 2)', "CAST(NULL AS VARCHAR)") for c in numbers]
    cells += [(c, "CAST(NULL AS DOUBLE)", f'CAST("{c}" AS VARCHAR)') for c in texts]
    entry = f"concat_ws('|', {keys})" if keys else "''"
    return " UNION ALL ".join(f"SELECT '{section}' AS section, {entry} AS entry, '{c}' AS measure, {number} AS number, {text} AS text "
                              f"FROM ({without_rounding(sql)}) s" for c, number, text in cells)


@retail("e25_exploration_report", " UNION ALL ".join(_section_sql(n, *parts) for n, parts in _SECTIONS.items()))
def _report(t):
    """All sections but the scored customers, who have the query e20_exploration_scores."""
    sections = exploration_report(t, on_tied_edges="rank")
    del sections["rfm"]
    return rounded(report_table(sections), 2)
