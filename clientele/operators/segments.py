"""RFM scores and rule-based segments: two rule sets, kept apart by name.

``marketing_segment`` is the 11-segment set behind campaigns,
``exploration_segment`` the 8-segment set of the exploration report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.semantics import ratio
from clientele.operators.rank import exact_quantiles, quintile_cuts, quintile_score

CUSTOMER = "customer_unique_id"

# The marketing segments, in the order in which rules are tried.
SEGMENTS = [
    {
        "name": "Champions", "priority": 10, "budget_allocation": "20%",
        "description": "Best customers - recent, frequent, high-value buyers",
        "marketing_goal": "Retain and grow",
        "actions": ["VIP loyalty program enrollment", "Early access to new products", "Exclusive discounts (15-20%)",
                    "Personal account manager", "Referral program with premium rewards"],
        "kpis": ["Retention rate", "Lifetime value growth", "Referral rate"],
    },
    {
        "name": "Loyal Customers", "priority": 9, "budget_allocation": "15%",
        "description": "Regular buyers with strong engagement",
        "marketing_goal": "Increase basket size",
        "actions": ["Cross-sell recommendations", "Bundle offers", "Loyalty points program",
                    "Birthday/anniversary rewards", "Category expansion campaigns"],
        "kpis": ["Average order value", "Items per order", "Category penetration"],
    },
    {
        "name": "At Risk", "priority": 9, "budget_allocation": "5%",
        "description": "Were valuable, now disengaging - high priority save",
        "marketing_goal": "Win back immediately",
        "actions": ["Aggressive win-back offer (30-40%)", "Personal outreach call/email",
                    '"We want you back" campaign', "Competitor comparison content", "Free shipping for 3 months"],
        "kpis": ["Win-back rate", "Revenue recovered", "Response rate"],
    },
    {
        "name": "About to Sleep", "priority": 8, "budget_allocation": "7%",
        "description": "Declining engagement - last chance for retention",
        "marketing_goal": "Prevent churn",
        "actions": ["Urgent reactivation campaign", "Strong discount (25-30%)", '"Last chance" messaging',
                    "Product updates showcase", "Easy return/exchange reminder"],
        "kpis": ["Reactivation rate", "Days to next purchase", "Offer redemption"],
    },
    {
        "name": "Potential Loyalists", "priority": 8, "budget_allocation": "15%",
        "description": "Recent buyers showing promise - need nurturing",
        "marketing_goal": "Convert to loyal",
        "actions": ["Onboarding email series", "Second/third purchase incentive", "Product education content",
                    "Community invitation", "Feedback collection"],
        "kpis": ["Repeat purchase rate", "Time to second purchase", "Engagement rate"],
    },
    {
        "name": "Recent Customers", "priority": 7, "budget_allocation": "10%",
        "description": "Just made first purchase - critical nurturing window",
        "marketing_goal": "Drive second purchase",
        "actions": ["Welcome email sequence", "How-to guides for purchased products",
                    "Complementary product suggestions", "10% off next purchase", "Mobile app download incentive"],
        "kpis": ["30-day repeat rate", "Email engagement", "App adoption"],
    },
    {
        "name": "Need Attention", "priority": 7, "budget_allocation": "8%",
        "description": "Above average but slowing down - intervention needed",
        "marketing_goal": "Re-engage before decline",
        "actions": ["Personal check-in email", '"We miss you" campaign', "Exclusive comeback offer",
                    "Feedback survey", "New product announcements"],
        "kpis": ["Response rate", "Return rate", "Feedback completion"],
    },
    {
        "name": "Promising", "priority": 6, "budget_allocation": "10%",
        "description": "Moderate engagement with growth potential",
        "marketing_goal": "Increase engagement",
        "actions": ["Personalized recommendations", "Limited-time offers", "Gamification program",
                    "Social proof campaigns", "User-generated content requests"],
        "kpis": ["Purchase frequency", "Email click rate", "Site visits"],
    },
    {
        "name": "Price Sensitive", "priority": 5, "budget_allocation": "5%",
        "description": "Buy mainly during sales - value seekers",
        "marketing_goal": "Increase value per transaction",
        "actions": ["Bundle deals", "Bulk purchase discounts", "Clearance alerts", "Price drop notifications",
                    "Value-focused messaging"],
        "kpis": ["Average order value", "Sale vs regular purchases", "Bundle adoption"],
    },
    {
        "name": "Hibernating", "priority": 4, "budget_allocation": "3%",
        "description": "Low recent activity but have purchase history",
        "marketing_goal": "Reawaken interest",
        "actions": ["Re-engagement email series", "Major sale announcements", "New category introductions",
                    "Brand story content", "Social media retargeting"],
        "kpis": ["Email open rate", "Site return rate", "Offer redemption"],
    },
    {
        "name": "Lost", "priority": 2, "budget_allocation": "2%",
        "description": "No activity for extended period - lowest priority",
        "marketing_goal": "Last attempt or sunset",
        "actions": ["Final win-back attempt (one email)", "Exit survey invitation", "Account deactivation notice",
                    "Referral request", "Remove from active campaigns"],
        "kpis": ["Final response rate", "Survey completion", "Referral conversion"],
    },
]

_DIMENSION = ("cohort_id int, cohort_name string, priority int, description string, marketing_goal string, "
              "recommended_actions array<string>, kpis array<string>, budget_allocation string")


def segment_dimension(spark: SparkSession) -> DataFrame:
    """The 11 segments with their attributes; ``cohort_id`` is the rule position."""
    rows = [(i, s["name"], s["priority"], s["description"], s["marketing_goal"], s["actions"], s["kpis"],
             s["budget_allocation"]) for i, s in enumerate(SEGMENTS, 1)]
    return spark.createDataFrame(rows, _DIMENSION)


def with_segment_attributes(df: DataFrame, key: str = "cohort_name") -> DataFrame:
    dimension = segment_dimension(df.sparkSession).withColumnRenamed("cohort_name", key)
    return df.join(F.broadcast(dimension), key, "left")  # 11 rows


# Score ranges (recency, frequency, monetary), both ends included.
# The first row that holds a customer's scores names the segment.
MARKETING_RULES = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (4, 5), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
    ("At Risk", (1, 2), (1, 5), (4, 5)),
    ("About to Sleep", (2, 2), (2, 5), (1, 5)),
    ("Potential Loyalists", (4, 5), (2, 3), (2, 5)),
    ("Recent Customers", (4, 5), (1, 1), (1, 5)),
    ("Need Attention", (3, 3), (3, 5), (3, 5)),
    ("Promising", (3, 5), (2, 5), (3, 5)),
    ("Price Sensitive", (2, 5), (2, 5), (1, 2)),
    ("Hibernating", (1, 2), (1, 2), (2, 5)),
    ("Lost", (1, 1), (1, 2), (1, 2)),
    ("Promising", (3, 5), (1, 5), (1, 5)),
    ("Hibernating", (2, 2), (1, 5), (1, 5)),
    ("Lost", (1, 1), (1, 5), (1, 5)),
]
EXPLORATION_RULES = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (4, 5), (3, 5), (1, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("Potential Loyalists", (3, 5), (3, 5), (3, 5)),
    ("At Risk", (1, 2), (4, 5), (1, 5)),
    ("Lost", (1, 2), (1, 2), (1, 2)),
    ("Hibernating", (1, 2), (2, 5), (1, 5)),
    ("Need Attention", (1, 5), (1, 5), (1, 5)),
]


def _cells(rules: list[tuple]) -> dict[int, str]:
    """Segment of each of the 125 cells, numbered like 543 for R=5, F=4, M=3."""
    scores = range(1, 6)
    return {
        100 * r + 10 * f + m: next(
            name for name, *ranges in rules
            if all(low <= x <= high for x, (low, high) in zip((r, f, m), ranges)))
        for r in scores for f in scores for m in scores
    }


def _by_cell(values: dict, r: Column, f: Column, m: Column) -> Column:
    """Look a cell up in a constant map; the scores enter the plan only once."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return table[r * 100 + f * 10 + m]


def marketing_segment(r: Column, f: Column, m: Column) -> Column:
    """One of 11 segments from the three scores."""
    return _by_cell(_cells(MARKETING_RULES), r, f, m)


def exploration_segment(r: Column, f: Column, m: Column) -> Column:
    """One of the 8 segments of the exploration report."""
    return _by_cell(_cells(EXPLORATION_RULES), r, f, m)


def _with_scores(df: DataFrame, scores: dict[str, Column]) -> DataFrame:
    r, f, m = F.col("R_score"), F.col("F_score"), F.col("M_score")
    return df.withColumns(scores).withColumns({
        "RFM_score": F.concat(r.cast("string"), f.cast("string"), m.cast("string")),
        "RFM_total": r + f + m,
    })


def rfm_scores(df: DataFrame, id_col: str = CUSTOMER) -> DataFrame:
    """Quintile scores by unique rank, 5 = best; recent customers score high."""
    cuts = quintile_cuts(df, id_col, ["recency", "frequency", "monetary"], reverse=("recency",))
    return _with_scores(df, {
        "R_score": quintile_score("recency", id_col, cuts["recency"], reverse=True),
        "F_score": quintile_score("frequency", id_col, cuts["frequency"]),
        "M_score": quintile_score("monetary", id_col, cuts["monetary"]),
    })


def exploration_rfm_scores(df: DataFrame, id_col: str = CUSTOMER, on_tied_edges: str = "raise") -> DataFrame:
    """Scores of the exploration report: recency binned on its raw quintiles.

    When two recency quintiles coincide there are fewer than five bins. Then
    this raises, or with ``on_tied_edges='rank'`` scores recency by rank.
    """
    edges = exact_quantiles(df, ["recency"], [i / 5 for i in range(6)])["recency"]
    tied = len(set(edges)) < len(edges)
    if tied and on_tied_edges != "rank":
        raise ValueError(f"recency quintiles coincide: {edges}")
    cuts = quintile_cuts(df, id_col, ["recency", "frequency", "monetary"], reverse=("recency",))
    if tied:
        recency = quintile_score("recency", id_col, cuts["recency"], reverse=True)
    else:
        recency = F.lit(5)
        for edge in edges[1:5]:
            recency = recency - F.when(F.col("recency") > F.lit(edge), 1).otherwise(0)
        recency = recency.cast("int")
    return _with_scores(df, {
        "R_score": recency,
        "F_score": quintile_score("frequency", id_col, cuts["frequency"]),
        "M_score": quintile_score("monetary", id_col, cuts["monetary"]),
    })


def assign_segments(scored: DataFrame) -> DataFrame:
    """Segment name, its rule position and its priority per customer."""
    scores = F.col("R_score"), F.col("F_score"), F.col("M_score")
    cells = _cells(MARKETING_RULES)
    position = {s["name"]: i for i, s in enumerate(SEGMENTS, 1)}
    priority = {s["name"]: s["priority"] for s in SEGMENTS}
    return scored.withColumns({
        "cohort_name": _by_cell(cells, *scores),
        "cohort_id": _by_cell({cell: position[name] for cell, name in cells.items()}, *scores),
        "priority": _by_cell({cell: priority[name] for cell, name in cells.items()}, *scores),
    })


def segment_distribution(segmented: DataFrame) -> DataFrame:
    """Customers, share and revenue per segment, in rule order."""
    total = segmented.agg(F.count("*").alias("n")).scalar()
    return (
        segmented.groupBy("cohort_id", "cohort_name", "priority")
        .agg(F.count("*").alias("customer_count"), F.sum("monetary").alias("total_revenue"))
        .withColumn("percentage", ratio(F.col("customer_count"), total) * 100)
        .orderBy("cohort_id")
    )


def heat_map(scored: DataFrame) -> DataFrame:
    """Customers per (recency score, frequency score), missing cells as 0."""
    return (
        scored.groupBy("R_score").pivot("F_score", [1, 2, 3, 4, 5]).count().fillna(0).orderBy("R_score")
    )
