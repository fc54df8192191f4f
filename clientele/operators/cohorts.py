"""Profiles of segments and clusters, and the customer output table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.semantics import ratio, smallest_mode
from clientele.operators.segments import with_segment_attributes

NOISE = -1
OUTPUT = ["customer_unique_id", "cluster", "cohort_id", "cohort_name", "priority", "cluster_probability", "recency",
          "frequency", "monetary", "R_score", "F_score", "M_score", "RFM_score", "RFM_total"]
OPTIONAL_OUTPUT = ["avg_order_value", "customer_state", "top_category"]

# Message hints by main category, by mean spend and by mean orders.
CATEGORY_HINTS = [
    (["electronics", "computers"], "Tech-focused messaging, feature comparisons"),
    (["fashion", "clothing"], "Style guides, trend updates, lookbooks"),
    (["home", "furniture"], "Home improvement tips, room inspiration"),
    (["beauty", "health"], "Tutorial content, routine builders"),
]
HIGH_SPEND, HIGH_SPEND_HINT = 500, "Premium product recommendations"
LOW_SPEND, LOW_SPEND_HINT = 100, "Value bundles, budget-friendly options"
OFTEN, OFTEN_HINT = 3, "Subscription/auto-replenish offers"
ONCE, ONCE_HINT = 1, "Discovery content, category expansion"
DEFAULT_HINT = "General personalization"


def _mean(total: str, n: str, digits: int) -> Column:
    return F.round(ratio(F.col(total), F.col(n)), digits)


def cohort_clusters(df: DataFrame) -> DataFrame:
    """(cohort_id, cohort_name, cluster, customers, share): one row per segment and cluster, noise left out.

    ``share`` is the part of the segment's customers, in percent.
    """
    parts = df.groupBy("cohort_name", "cluster").agg(F.count("*").alias("customers"))
    totals = parts.groupBy("cohort_name").agg(F.sum("customers").alias("_all"))  # 11 segments
    return with_segment_attributes(parts.filter(F.col("cluster") != NOISE).join(F.broadcast(totals), "cohort_name")).select(
        "cohort_id", "cohort_name", "cluster", "customers",
        F.round(ratio(F.col("customers"), F.col("_all")) * 100, 2).alias("share"))


def cohort_profiles(df: DataFrame, list_clusters: bool = True) -> DataFrame:
    """One row per segment with its size, averages, attributes and clusters.

    With very many clusters, ``list_clusters=False`` leaves ``cluster_ids``
    null, and ``cohort_clusters`` has them as rows.
    """
    real = F.col("cluster") != NOISE
    parts = df.groupBy("cohort_name", "cluster").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("recency", "frequency", "monetary")])
    total = df.agg(F.count("*").alias("n")).scalar()
    grouped = parts.groupBy("cohort_name").agg(
        F.sum("n").alias("customer_count"),
        *[F.sum(c).alias(c) for c in ("recency", "frequency", "monetary")],
        (F.sort_array(F.collect_set(F.when(real, F.col("cluster")))) if list_clusters
         else F.lit(None).cast(T.ArrayType(df.schema["cluster"].dataType))).alias("cluster_ids"),
        F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)).alias("includes_noise_points"),
    )
    return with_segment_attributes(grouped).select(
        "cohort_id", "cohort_name", "description", "customer_count",
        F.round(ratio(F.col("customer_count"), total) * 100, 2).alias("percentage"),
        _mean("recency", "customer_count", 1).alias("avg_recency"),
        _mean("frequency", "customer_count", 2).alias("avg_frequency"),
        _mean("monetary", "customer_count", 2).alias("avg_monetary"),
        F.round(F.col("monetary").cast("double"), 2).alias("total_revenue"),
        "priority", "marketing_goal", "recommended_actions", "kpis", "budget_allocation", "cluster_ids",
        "includes_noise_points",
    ).orderBy(F.desc("priority"), "cohort_id")


def cluster_profiles(df: DataFrame, category: str | None = None, state: str | None = None) -> DataFrame:
    """One row per cluster (noise left out) with segments, averages and a hint.

    ``category`` and ``state`` name the columns whose three most frequent
    values are added.
    """
    members = df.filter(F.col("cluster") != NOISE)
    parts = members.groupBy("cluster", "cohort_name").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("recency", "frequency", "monetary", "RFM_total")])
    named = F.sort_array(F.collect_list(F.struct(F.col("cohort_name"), F.col("n"))))  # at most 11 segments
    profiles = parts.groupBy("cluster").agg(
        F.sum("n").alias("size"), smallest_mode(F.col("cohort_name"), F.col("n")).alias("primary_cohort"),
        F.map_from_entries(named).alias("cohort_distribution"),
        *[F.sum(c).alias(c) for c in ("recency", "frequency", "monetary", "RFM_total")],
    ).select(
        F.col("cluster").alias("cluster_id"), "size", "primary_cohort", "cohort_distribution",
        _mean("recency", "size", 1).alias("avg_recency"), _mean("frequency", "size", 2).alias("avg_frequency"),
        _mean("monetary", "size", 2).alias("avg_monetary"), _mean("RFM_total", "size", 2).alias("avg_rfm_total"))
    if category:
        top = top_values_per_cluster(members, category).select(
            F.col("cluster").alias("cluster_id"), F.map_from_entries("top").alias("top_categories"),
            F.coalesce(F.get("top", F.lit(0))["value"], F.lit("various")).alias("primary_category"))
        profiles = profiles.join(top, "cluster_id", "left")
    if state:
        top = top_values_per_cluster(members, state).select(
            F.col("cluster").alias("cluster_id"), F.map_from_entries("top").alias("top_states"))
        profiles = profiles.join(top, "cluster_id", "left")
    main = F.col("primary_category") if category else F.lit(None).cast("string")
    return profiles.withColumn(
        "personalization_hint", personalization_hint(main, F.col("avg_monetary"), F.col("avg_frequency")))


def top_values_per_cluster(df: DataFrame, column: str, k: int = 3) -> DataFrame:
    """(cluster, top): the ``k`` most frequent values as (value, count) entries."""
    counts = df.filter(F.col(column).isNotNull()).groupBy("cluster", F.col(column).alias("value")).agg(
        F.count("*").alias("count"))
    place = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("count"), "value"))
    entry = F.struct("place", "value", "count")
    return counts.withColumn("place", place).filter(F.col("place") <= k).groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["value"].alias("value"), e["count"].alias("count")))
        .alias("top"))


def personalization_hint(category: Column, spend: Column, orders: Column) -> Column:
    by_category = F.coalesce(*[F.when(category.isin(names), hint) for names, hint in CATEGORY_HINTS])
    by_spend = F.when(spend > HIGH_SPEND, HIGH_SPEND_HINT).when(spend < LOW_SPEND, LOW_SPEND_HINT)
    by_orders = F.when(orders > OFTEN, OFTEN_HINT).when(orders == ONCE, ONCE_HINT)
    hints = F.array_compact(F.array(by_category, by_spend, by_orders))
    return F.when(F.size(hints) > 0, F.array_join(hints, "; ")).otherwise(DEFAULT_HINT)


def customer_output(df: DataFrame) -> DataFrame:
    return df.select(*OUTPUT, *[c for c in OPTIONAL_OUTPUT if c in df.columns])


def run_summary(df: DataFrame) -> DataFrame:
    """Customers, segments, clustered customers, clusters and noise."""
    real = F.col("cluster") != NOISE
    return df.agg(
        F.count("*").alias("customers"), F.count_distinct("cohort_name").alias("segments"),
        F.count_if(real).alias("clustered"), F.count_distinct(F.when(real, F.col("cluster"))).alias("clusters"),
        F.count_if(~real).alias("noise"))


def value_behaviour_anomalies(df: DataFrame) -> DataFrame:
    """Customers of the valuable segments that fit no cluster."""
    valuable = ["Champions", "Loyal Customers", "At Risk"]
    return df.filter(F.col("cohort_name").isin(valuable) & (F.col("cluster") == NOISE)).select(
        "customer_unique_id", F.col("cohort_name").alias("rfm_segment"), F.col("cluster").alias("hdbscan_cluster"), "monetary")


def clusters_by_hint(profiles: DataFrame, category: str) -> DataFrame:
    """Clusters whose hint contains the text, largest first."""
    return profiles.filter(F.contains(F.lower("personalization_hint"), F.lit(category.lower()))).select(
        "cluster_id", "size", "primary_cohort", "personalization_hint", F.round("avg_monetary", 2).alias("avg_monetary")
    ).orderBy(F.desc("size"), "cluster_id")
