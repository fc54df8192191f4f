"""Checks of ranks, scores and rule-based segments."""

from pyspark.sql import functions as F

from clientele.checks.ctes import BASE, TABLES
from clientele.checks.registry import retail, rounded
from clientele.operators import explore as ex
from clientele.operators import features as fe
from clientele.operators import segments as sg
from clientele.operators.base import order_facts, purchases
from clientele.operators.rank import global_rank
from clientele.session import truncate

ID = fe.CUSTOMER

RFM = BASE + """,
rfm AS (SELECT customer_unique_id,
    CAST(floor((epoch_us(d) - epoch_us(max(order_purchase_timestamp))) / 86400000000.0) AS BIGINT) AS recency,
    count(DISTINCT order_id) AS frequency, sum(price) + sum(freight_value) AS monetary
  FROM base, ref GROUP BY customer_unique_id, d)"""


def quintile(metric: str, reverse: bool = False) -> str:
    k = f"row_number() OVER (ORDER BY {metric}, customer_unique_id)"
    n = "count(*) OVER ()"
    top = f"({n} - {k})" if reverse else f"({k} - 1)"
    return f"greatest(1, CAST(ceil(5.0 * {top} / greatest({n} - 1, 1)) AS BIGINT))"


SCORED = RFM + f""",
scored AS (SELECT *, CAST(R_score AS VARCHAR) || CAST(F_score AS VARCHAR) || CAST(M_score AS VARCHAR) AS RFM_score,
    R_score + F_score + M_score AS RFM_total
  FROM (SELECT *, {quintile('recency', True)} AS R_score, {quintile('frequency')} AS F_score, {quintile('monetary')} AS M_score FROM rfm) s)"""

MARKETING_CASE = """CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Champions'
  WHEN F_score >= 4 AND R_score >= 3 THEN 'Loyal Customers'
  WHEN R_score <= 2 AND (F_score >= 3 OR M_score >= 4) THEN 'At Risk'
  WHEN R_score = 2 AND F_score >= 2 THEN 'About to Sleep'
  WHEN R_score >= 4 AND F_score IN (2, 3) AND M_score >= 2 THEN 'Potential Loyalists'
  WHEN R_score >= 4 AND F_score = 1 THEN 'Recent Customers'
  WHEN R_score = 3 AND F_score >= 3 AND M_score >= 3 THEN 'Need Attention'
  WHEN R_score >= 3 AND F_score >= 2 AND M_score >= 3 THEN 'Promising'
  WHEN F_score >= 2 AND M_score <= 2 AND R_score >= 2 THEN 'Price Sensitive'
  WHEN R_score <= 2 AND F_score <= 2 AND M_score >= 2 THEN 'Hibernating'
  WHEN R_score = 1 AND F_score <= 2 AND M_score <= 2 THEN 'Lost'
  WHEN R_score >= 3 THEN 'Promising' WHEN R_score = 2 THEN 'Hibernating' ELSE 'Lost' END"""
_IDS = "CASE cohort_name " + " ".join(f"WHEN '{s['name']}' THEN {i}" for i, s in enumerate(sg.SEGMENTS, 1)) + " END"
_PRIORITIES = "CASE cohort_name " + " ".join(f"WHEN '{s['name']}' THEN {s['priority']}" for s in sg.SEGMENTS) + " END"
SEGMENTED = SCORED + f""",
segmented AS (SELECT *, {_IDS} AS cohort_id, {_PRIORITIES} AS priority FROM (SELECT *, {MARKETING_CASE} AS cohort_name FROM scored) n)"""


def customer_rfm(t):
    return truncate(fe.rfm_levels(order_facts(t), purchases(t)).select(ID, "recency", "frequency", "monetary"))


def scored(t):
    return sg.rfm_scores(customer_rfm(t))


def segmented(t):
    return sg.assign_segments(scored(t))


@retail("w01_global_rank", f"""WITH {RFM} SELECT customer_unique_id, round(CAST(monetary AS DOUBLE), 2) AS monetary,
  row_number() OVER (ORDER BY monetary, customer_unique_id) AS rank FROM rfm""")
def _rank(t):
    return rounded(global_rank(customer_rfm(t).select(ID, "monetary"), ["monetary", ID]))


@retail("w03_rfm_scores", f"""WITH {SCORED} SELECT customer_unique_id, R_score, F_score, M_score, RFM_score, RFM_total FROM scored""")
def _scores(t):
    return rounded(scored(t).select(ID, "R_score", "F_score", "M_score", "RFM_score", "RFM_total"))


@retail("g01_segments", f"WITH {SEGMENTED} SELECT customer_unique_id, RFM_score, cohort_name FROM segmented")
def _segments(t):
    return segmented(t).select(ID, "RFM_score", "cohort_name")


_LIST = ", ".join(
    "('{name}', {priority}, '{description}', '{marketing_goal}', '{budget_allocation}', {n_actions}, {n_kpis})".format(
        n_actions=len(s["actions"]), n_kpis=len(s["kpis"]),
        **{k: str(v).replace("'", "''") for k, v in s.items() if k not in ("actions", "kpis")})
    for s in sg.SEGMENTS)


@retail("g02_segment_attributes", f"""WITH {SEGMENTED},
a(cohort_name, prio, description, marketing_goal, budget_allocation, n_actions, n_kpis) AS (VALUES {_LIST})
SELECT customer_unique_id, cohort_name, description, marketing_goal, budget_allocation, CAST(n_actions AS BIGINT) AS n_actions,
  CAST(n_kpis AS BIGINT) AS n_kpis FROM segmented LEFT JOIN a USING (cohort_name)""")
def _attributes(t):
    df = sg.with_segment_attributes(segmented(t).select(ID, "cohort_name"))
    return df.select(ID, "cohort_name", "description", "marketing_goal", "budget_allocation",
                     F.size("recommended_actions").cast("long").alias("n_actions"),
                     F.size("kpis").cast("long").alias("n_kpis"))


# The same with the texts of the lists.
ATTRIBUTES = "cohort_name, prio, description, marketing_goal, budget_allocation, actions, kpis"
ATTRIBUTE_ROWS = ", ".join(
    "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in (
        s["name"], s["priority"], s["description"], s["marketing_goal"], s["budget_allocation"], " | ".join(s["actions"]),
        " | ".join(s["kpis"]))) + ")"
    for s in sg.SEGMENTS)


@retail("g02_segment_texts", f"""WITH {SEGMENTED}, a({ATTRIBUTES}) AS (VALUES {ATTRIBUTE_ROWS})
SELECT customer_unique_id, cohort_name, actions, kpis FROM segmented LEFT JOIN a USING (cohort_name)""")
def _attribute_texts(t):
    df = sg.with_segment_attributes(segmented(t).select(ID, "cohort_name"))
    return df.select(ID, "cohort_name", F.array_join("recommended_actions", " | ").alias("actions"), F.array_join("kpis", " | ").alias("kpis"))


@retail("g03_cohort_priority", f"WITH {SEGMENTED} SELECT customer_unique_id, cohort_id, priority FROM segmented")
def _priority(t):
    return rounded(segmented(t).select(ID, "cohort_id", "priority"))


@retail("g04_segment_distribution", f"""WITH {SEGMENTED} SELECT cohort_id, cohort_name, priority, count(*) AS customer_count,
  round(CAST(sum(monetary) AS DOUBLE), 2) AS total_revenue,
  round(count(*) * 100.0 / (SELECT count(*) FROM segmented), 6) AS percentage FROM segmented GROUP BY 1, 2, 3""")
def _distribution(t):
    return rounded(sg.segment_distribution(segmented(t)))


ORDER_RFM = TABLES + """,
o AS (SELECT c.customer_unique_id, o.order_id, o.order_purchase_timestamp, v.total FROM customers c
  JOIN shop_orders o USING (customer_id)
  JOIN (SELECT order_id, sum(price) + sum(freight_value) AS total FROM order_items GROUP BY 1) v USING (order_id)),
rfm AS (SELECT customer_unique_id,
    CAST(floor((epoch_us((SELECT max(order_purchase_timestamp) + INTERVAL 1 DAY FROM o)) - epoch_us(max(order_purchase_timestamp))) / 86400000000.0) AS BIGINT) AS recency,
    count(DISTINCT order_id) AS frequency, sum(total) AS monetary FROM o GROUP BY 1)"""

EXPLORED = ORDER_RFM + f""",
edges AS (SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS e FROM rfm),
scored AS (SELECT *, CAST(R_score AS VARCHAR) || CAST(F_score AS VARCHAR) || CAST(M_score AS VARCHAR) AS RFM_score FROM (
  SELECT rfm.*, CASE WHEN recency <= e[1] THEN 5 WHEN recency <= e[2] THEN 4 WHEN recency <= e[3] THEN 3 WHEN recency <= e[4] THEN 2 ELSE 1 END AS R_score,
  {quintile('frequency')} AS F_score, {quintile('monetary')} AS M_score FROM rfm, edges) s),
explored AS (SELECT *, CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Champions' WHEN R_score >= 4 AND F_score >= 3 THEN 'Loyal Customers'
  WHEN R_score >= 4 AND F_score <= 2 THEN 'New Customers' WHEN R_score >= 3 AND F_score >= 3 AND M_score >= 3 THEN 'Potential Loyalists'
  WHEN R_score <= 2 AND F_score >= 4 THEN 'At Risk' WHEN R_score <= 2 AND F_score <= 2 AND M_score <= 2 THEN 'Lost'
  WHEN R_score <= 2 AND F_score >= 2 THEN 'Hibernating' ELSE 'Need Attention' END AS segment FROM scored)"""


def explored(t):
    df = sg.exploration_rfm_scores(truncate(ex.order_grain_rfm(t)), on_tied_edges="rank")
    return df.withColumn("segment", sg.exploration_segment(F.col("R_score"), F.col("F_score"), F.col("M_score")))


@retail("e19_order_grain_rfm", f"""WITH {ORDER_RFM} SELECT customer_unique_id, recency, frequency, round(CAST(monetary AS DOUBLE), 2) AS monetary,
  round(CAST(monetary AS DOUBLE) / frequency, 6) AS avg_order_value FROM rfm""")
def _order_rfm(t):
    return rounded(ex.order_grain_rfm(t))


@retail("e20_exploration_scores", f"WITH {EXPLORED} SELECT customer_unique_id, R_score, F_score, M_score, RFM_score FROM explored")
def _explored_scores(t):
    return rounded(explored(t).select(ID, "R_score", "F_score", "M_score", "RFM_score"))


@retail("e21_exploration_segments", f"WITH {EXPLORED} SELECT segment, count(*) AS count FROM explored GROUP BY 1")
def _explored_segments(t):
    return ex.value_counts(explored(t), "segment").withColumnRenamed("value", "segment")


@retail("e22_heat_map", f"""WITH {EXPLORED} SELECT R_score, {', '.join(
    f'count(*) FILTER (WHERE F_score = {i}) AS "{i}"' for i in range(1, 6))} FROM explored GROUP BY 1""")
def _heat(t):
    return rounded(sg.heat_map(explored(t)))


_COLS = ["recency", "frequency", "monetary", "avg_order_value"]


@retail("e23_correlations", f"""WITH {ORDER_RFM}, x AS (SELECT CAST(recency AS DOUBLE) AS recency, CAST(frequency AS DOUBLE) AS frequency,
  CAST(monetary AS DOUBLE) AS monetary, CAST(monetary AS DOUBLE) / frequency AS avg_order_value FROM rfm)
{' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM x" for a in _COLS for b in _COLS)}""")
def _corr(t):
    return rounded(ex.correlations(ex.order_grain_rfm(t), _COLS))
