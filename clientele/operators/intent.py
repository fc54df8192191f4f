"""Keyword intent, parameters and entities of request texts, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords per intent, matched as substrings of the lower-cased text.
STRATEGIC = ["best", "top", "overview", "summary", "report", "dashboard", "performing", "valuable", "important",
             "priority", "show me", "how many", "total", "all segments", "cohorts", "breakdown", "revenue", "health",
             "status", "kpis", "metrics"]
TARGETING = ["campaign", "target", "personalize", "email", "marketing", "buy", "purchase", "category", "product",
             "tech", "electronics", "fashion", "behavior", "pattern", "similar", "like", "prefer", "interest",
             "segment for", "list for", "audience", "cluster"]
ANOMALY = ["weird", "unusual", "anomaly", "outlier", "strange", "different", "acting", "behavior change",
           "unexpected", "noise", "exception", "not fitting", "edge case", "investigate", "why", "dropping",
           "churning but", "high value but", "at risk", "behaving strangely", "strangely"]
VALUE = ["high value", "high-value", "valuable", "vip", "premium", "big spender", "frequent", "loyal", "champions",
         "top", "best"]
CATEGORIES = ["tech", "electronics", "fashion", "home", "beauty", "health", "sports", "computers"]
STATES = ["sp", "rj", "mg", "rs", "pr", "sc", "ba"]
COHORTS = ["champions", "loyal", "at risk", "about to sleep", "potential loyalist", "recent", "need attention",
           "promising", "hibernating", "lost", "price sensitive"]
METRICS = ["revenue", "monetary", "frequency", "recency", "rfm", "count", "average", "total", "priority", "value"]
COMPARISON = ["compare", "versus", "vs", "difference between", "comparison"]
PRONOUNS = [("first one", 0), ("the first", 0), ("second one", 1), ("the second", 1), ("third one", 2),
            ("the third", 2), ("that one", 0), ("this one", 0), ("that segment", 0), ("this segment", 0),
            ("tell me more", 0), ("more about it", 0), ("more details", 0), ("expand on", 0), ("elaborate", 0)]
PRIORITY = ["prioritize", "priority", "focus on", "should we", "recommend", "suggestion"]
PRIORITY_QUERY = "top priority segments with actions"
REASONS = {
    "anomaly_value": "Anomaly + value indicators → Use both RFM and HDBSCAN",
    "targeting_category": "Targeting with category → Use HDBSCAN clusters",
    "anomaly": "Anomaly detection → Use both RFM and HDBSCAN",
    "targeting": "Campaign targeting → Use HDBSCAN clusters",
    "strategic": "Strategic/overview query → Use RFM segments (100% coverage)",
}


def keyword_score(text: Column, keywords: list[str]) -> Column:
    """How many of the keywords occur in the text."""
    low = F.lower(text)
    score = F.lit(0)
    for word in keywords:
        score = score + F.contains(low, F.lit(word)).cast("int")
    return score


def mentions_any(text: Column, words: list[str]) -> Column:
    return keyword_score(text, words) > 0


def scores(text: Column) -> Column:
    return F.struct(
        keyword_score(text, STRATEGIC).alias("strategic"), keyword_score(text, TARGETING).alias("targeting"),
        keyword_score(text, ANOMALY).alias("anomaly"), keyword_score(text, VALUE).alias("value"))


def parameters(text: Column) -> Column:
    """struct(top_n, category, state); null where the text names none."""
    low = F.lower(text)
    padded = F.concat(F.lit(" "), low, F.lit(" "))
    return F.struct(
        F.nullif(F.regexp_extract(low, r"top\s*(\d+)", 1), F.lit("")).try_cast("int").alias("top_n"),
        F.coalesce(*[F.when(F.contains(low, F.lit(c)), c) for c in CATEGORIES]).alias("category"),
        F.coalesce(*[F.when(F.contains(padded, F.lit(f" {s} ")), s.upper()) for s in STATES]).alias("state"))


def classify(score: Column, params: Column) -> Column:
    """struct(intent, column_selection, confidence, reasoning) by ordered rules."""
    strategic, targeting = score["strategic"], score["targeting"]
    anomaly, value = score["anomaly"], score["value"]
    total = strategic + targeting + anomaly + 1

    def outcome(intent, column, confidence, reason):
        return F.struct(F.lit(intent).alias("intent"), F.lit(column).alias("column_selection"),
                        confidence.cast("double").alias("confidence"), F.lit(REASONS[reason]).alias("reasoning"))

    return (
        F.when((anomaly > 0) & (value > 0),
               outcome("anomaly", "both", F.least(F.lit(0.9), (anomaly + value) / 4), "anomaly_value"))
        .when((targeting > 0) & params["category"].isNotNull(),
              outcome("targeting", "hdbscan_cluster", F.least(F.lit(0.9), targeting / 3), "targeting_category"))
        .when(anomaly > 0, outcome("anomaly", "both", anomaly / total, "anomaly"))
        .when(targeting > strategic, outcome("targeting", "hdbscan_cluster", targeting / total, "targeting"))
        .otherwise(outcome("strategic", "rfm_segment", F.greatest(F.lit(0.5), strategic / total), "strategic"))
    )


def analyse(df, text: str = "text"):
    """Add ``scores``, ``params`` and ``analysis`` of a text column."""
    return df.withColumns({"scores": scores(F.col(text)), "params": parameters(F.col(text))}).withColumn(
        "analysis", classify(F.col("scores"), F.col("params")))


def tokens(text: Column) -> Column:
    """Words of the lower-cased text, punctuation as separator."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"(?U)[^\w]+", " ")), " ")


def cohort_mentions(text: Column) -> Column:
    """Segment names in the text: phrases anywhere, single words as whole words."""
    low, words = F.lower(text), tokens(text)
    return F.array_compact(F.array(*[
        F.when(F.contains(low, F.lit(k)) if " " in k else F.array_contains(words, k), k.title()) for k in COHORTS
    ]))


def metric_mentions(text: Column) -> Column:
    words = tokens(text)
    return F.array_compact(F.array(*[F.when(F.array_contains(words, k), k) for k in METRICS]))


def resolve(text: Column, discussed: Column) -> Column:
    """struct(tool, segment, segment_names, query) for requests that need no model.

    ``discussed`` holds the segments of the conversation before this request.
    All fields are null when nothing can be resolved.
    """
    low = F.lower(text)
    named = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(k)), k.title()) for k in COHORTS]))
    referred = F.coalesce(*[
        F.when(F.contains(low, F.lit(phrase)), F.get(discussed, F.lit(i))) for phrase, i in PRONOUNS])

    def outcome(tool=None, segment=None, names=None, query=None):
        none = F.lit(None)
        return F.struct(
            F.lit(tool).cast("string").alias("tool"), (none if segment is None else segment).cast("string").alias("segment"),
            (none if names is None else names).cast("array<string>").alias("segment_names"),
            F.lit(query).cast("string").alias("query"))

    return (
        F.when(mentions_any(text, COMPARISON) & (F.size(named) >= 2), outcome("compare_segments", names=named))
        .when(referred.isNotNull(), outcome("get_segment_details", segment=referred))
        .when(mentions_any(text, PRIORITY), outcome("smart_customer_query", query=PRIORITY_QUERY))
        .otherwise(outcome())
    )
