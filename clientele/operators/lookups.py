"""Answers from the playbook and the profiles, for tables of requests.

The playbook has at most 11 segments. It is one array value here (a scalar
subquery), so looking a request up needs no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.semantics import contains_ci
from clientele.operators import intent
from clientele.operators.segments import SEGMENTS

DEFAULT_TOP_N = 5
DEFAULT_CATEGORY = "electronics"
# What to do about an anomaly.
ANOMALY_ACTIONS = ["Review purchase history for pattern changes", "Personal outreach to understand behavior",
                   "Consider for VIP intervention program"]
ANOMALY_TYPE = "Value-Behavior Mismatch"
DETECTION_LOGIC = "High RFM value + HDBSCAN noise"
ROUTED = ["type", "data_source", "reasoning", "segments", "total_segments", "category", "total_clusters", "anomaly_type",
          "detection_logic", "total_anomalies", "recommended_actions"]


def rule_position(segment: Column) -> Column:
    """Place of a segment in the rule order, which decides among equal priorities; unknown names come last."""
    names = [s["name"] for s in SEGMENTS]
    at = F.array_position(F.array(*[F.lit(n) for n in names]), segment)
    return F.when(at > 0, at).otherwise(len(names) + 1)


def segment_list(playbook: DataFrame, top_n: int | None = None) -> DataFrame:
    """Segments with defaults for missing fields, highest priority first."""
    rows = playbook.select(
        F.col("cohort_name").alias("rfm_segment"),
        F.coalesce("customer_count", F.lit(0)).alias("customer_count"),
        F.coalesce("percentage", F.lit(0.0)).alias("percentage"),
        F.coalesce("avg_customer_value", F.lit(0.0)).alias("avg_monetary"),
        F.coalesce("priority", F.lit(5)).alias("priority"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("marketing_goal", "description", "budget_allocation")],
        F.coalesce("actions", F.array().cast("array<string>")).alias("recommended_actions"),
        F.coalesce("kpis", F.array().cast("array<string>")).alias("kpis"),
    ).orderBy(F.desc("priority"), rule_position(F.col("rfm_segment")), "rfm_segment")
    return rows if top_n is None else rows.limit(top_n)


def segment_array(segments: DataFrame) -> Column:
    """All segments in look-up order as one array value."""
    key = F.struct((-F.col("priority")).alias("order"), rule_position(F.col("rfm_segment")).alias("place"), "rfm_segment")
    row = F.struct(*segments.columns)
    ordered = F.array_sort(F.collect_list(F.struct(key.alias("key"), row.alias("segment"))))
    return segments.agg(F.transform(ordered, lambda e: e["segment"]).alias("segments")).scalar()


def find_segment(segments: Column, name: Column) -> Column:
    """First segment whose name contains the text; null if there is none."""
    return F.get(F.filter(segments, lambda s: contains_ci(s["rfm_segment"], name)), F.lit(0))


def segment_details(requests: DataFrame, segments: Column, name: str = "segment_name") -> DataFrame:
    """Add ``segment`` and ``error`` for the requested names."""
    found = requests.withColumn("_all", segments).withColumn("segment", find_segment(F.col("_all"), F.col(name)))
    found = found.drop("_all")
    return found.withColumn("error", F.when(
        F.col("segment").isNull(), F.format_string("Segment '%s' not found", F.col(name))))


def compare_segments(requests: DataFrame, segments: Column, names: str = "segment_names") -> DataFrame:
    """Add ``segments`` (those found), ``insights`` and ``error`` per request."""
    wanted = F.filter(F.transform(F.col(names), lambda n: find_segment(F.col("_all"), n)), lambda s: s.isNotNull())
    found = requests.withColumn("_all", segments).withColumn("segments", wanted).drop("_all")
    first, second = F.get("segments", F.lit(0)), F.get("segments", F.lit(1))
    times = F.try_divide(first["avg_monetary"], second["avg_monetary"])
    spend = F.when((first["avg_monetary"] > second["avg_monetary"]) & (second["avg_monetary"] > 0),
                   F.format_string("%s has %.1fx higher average spend", first["rfm_segment"], times))
    higher = F.when(first["priority"] > second["priority"], first["rfm_segment"]).when(
        first["priority"] < second["priority"], second["rfm_segment"])
    priority = F.when(higher.isNotNull(), F.concat(higher, F.lit(" has higher marketing priority")))
    empty = F.coalesce(F.size(F.col(names)), F.lit(0)) == 0
    return found.withColumns({
        "insights": F.array_compact(F.array(spend, priority)),
        "error": F.when(empty, F.lit("No segments provided for comparison")),
    })


def category_clusters(clusters: DataFrame, categories: DataFrame) -> DataFrame:
    """(category, cluster record): one row per requested category and cluster whose hint contains it.

    ``categories`` has one row per distinct requested category. The rows stay
    apart: a category may match any number of clusters.
    """
    hits = categories.join(F.broadcast(_hints(clusters)), contains_ci(F.col("hint"), F.col("category")))
    # at most one row per known category and hint text
    return clusters.withColumnRenamed("personalization_hint", "hint").join(F.broadcast(hits), "hint").select(
        "category", "cluster_id", "size", "primary_cohort", F.col("hint").alias("personalization_hint"),
        F.round("avg_monetary", 2).alias("avg_monetary"))


def known_categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in intent.CATEGORIES], "category string")


def _hints(clusters: DataFrame) -> DataFrame:
    """Distinct hint texts: combinations of a few fixed phrases, so few rows."""
    return clusters.select(F.col("personalization_hint").alias("hint")).distinct()


def route(requests: DataFrame, segments: Column, clusters: DataFrame, anomalies: DataFrame,
          text: str = "text") -> DataFrame:
    """Answer each request by its intent.

    Adds type, data_source, reasoning and, depending on the type, ``segments``
    (whole records) with ``total_segments``, ``category`` with
    ``total_clusters``, or ``total_anomalies`` with ``anomaly_type``,
    ``detection_logic`` and ``recommended_actions``. The clusters of a category
    are the rows of ``category_clusters`` with that category and the anomalies
    those of ``anomalies``; no request carries a copy of either.
    """
    asked = intent.analyse(requests, text).withColumn("_all", segments)
    target = F.col("analysis.column_selection")
    total = anomalies.agg(F.count("*").alias("n")).scalar()
    top_n = F.coalesce("params.top_n", F.lit(DEFAULT_TOP_N))
    overview, targeting, both = target == "rfm_segment", target == "hdbscan_cluster", target == "both"
    asked = asked.withColumns({
        "type": F.when(overview, "segment_overview").when(targeting, "behavioral_targeting").otherwise("anomaly_detection"),
        "data_source": F.when(both, "both_rfm_and_hdbscan").otherwise(target),
        "reasoning": F.col("analysis.reasoning"),
        "segments": F.when(overview, F.slice("_all", 1, F.greatest(top_n, F.lit(0)))),
        "category": F.when(targeting, F.coalesce("params.category", F.lit(DEFAULT_CATEGORY))),
        "anomaly_type": F.when(both, ANOMALY_TYPE),
        "detection_logic": F.when(both, DETECTION_LOGIC),
        "total_anomalies": F.when(both, total),
        "recommended_actions": F.when(both, F.array(*[F.lit(a) for a in ANOMALY_ACTIONS])),
    }).withColumn("total_segments", F.when(overview, F.size("segments"))).drop("_all")
    counts = category_clusters(clusters, known_categories(requests.sparkSession)).groupBy("category").agg(
        F.count("*").alias("_n"))
    # at most one row per known category
    return asked.join(F.broadcast(counts), "category", "left").withColumn(
        "total_clusters", F.when(targeting, F.coalesce("_n", F.lit(0)))).drop("_n")


def dispatch(requests: DataFrame, segments: Column, clusters: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Each tool request (request_id, tool) with the fields of its answer and the same as JSON in ``result``.

    ``requests`` has request_id, tool, query, segment_name, category and
    segment_names. A missing argument or an unknown tool gives an error. A
    field that an answer does not have is null, and absent from the JSON.
    """
    tool = F.col("tool")
    blank = F.trim(F.coalesce("category", F.lit(""))) == ""
    smart = {
        "smart_customer_query": F.coalesce("query", F.lit("")),
        "find_behavioral_cluster": F.concat(F.lit("find "), F.col("category"), F.lit(" buyers for campaign")),
        "detect_customer_anomalies": F.lit("high-value customers acting weirdly"),
    }
    asks = requests.filter(tool.isin(list(smart)) & ~((tool == "find_behavioral_cluster") & blank)).select(
        "request_id", "tool", F.coalesce(*[F.when(tool == n, t) for n, t in smart.items()]).alias("text"))
    routed = route(asks, segments, clusters, anomalies)
    details = segment_details(requests.filter(tool == "get_segment_details").withColumn(
        "segment_name", F.coalesce("segment_name", F.lit("Champions"))), segments)
    comparisons = compare_segments(requests.filter(tool == "compare_segments"), segments)
    known = list(smart) + ["get_segment_details", "compare_segments"]
    is_known = F.coalesce(tool.isin(known), F.lit(False))
    errors = requests.filter(~is_known | ((tool == "find_behavioral_cluster") & blank)).withColumn(
        "error", F.when(is_known, F.lit("Missing parameter: 'category'. Please ask the user which product "
                                                "category they are interested in."))
        .otherwise(F.concat(F.lit("Unknown tool: "), F.coalesce(tool, F.lit("")))))

    def found(df: DataFrame, kind: str, *columns: str) -> DataFrame:
        right = F.col("error").isNull()
        return df.withColumns({"type": F.when(right, kind), "data_source": F.when(right, "rfm_segment")}).select(
            "request_id", "tool", "type", "data_source", "error", *[F.when(right, F.col(c)).alias(c) for c in columns])

    answers = (
        routed.select("request_id", "tool", *ROUTED)
        .unionByName(found(details, "segment_details", "segment"), allowMissingColumns=True)
        .unionByName(found(comparisons, "segment_comparison", "segments", "insights"), allowMissingColumns=True)
        .unionByName(errors.select("request_id", "tool", "error"), allowMissingColumns=True)
    )
    return answers.withColumn("result", F.to_json(F.struct(*[c for c in answers.columns if c not in ("request_id", "tool")])))
