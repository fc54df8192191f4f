"""Conversation context and memory over tables of messages.

A message has conv_id, turn, role and text. The context of a conversation is
kept as the first turn of each of the 11 segments, which is an aggregation
that does not depend on the order of arrival. A conversation with very many
messages therefore needs no window over its rows, duplicates change nothing,
and batch and stream share one definition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientele.operators import intent
from clientele.session import truncate

SUMMARY_SEGMENTS, PROMPT_SEGMENTS, PROMPT_FACTS, PROMPT_MEMORIES = 3, 5, 3, 2
DEFAULT_SUMMARY = "General cohort discussion"


def analysed_messages(messages: DataFrame) -> DataFrame:
    """Messages with the mentioned segments and, for users, the intent."""
    asked = intent.analyse(messages.withColumn("cohorts", intent.cohort_mentions(F.col("text"))))
    user = F.col("role") == "user"
    return asked.select(
        "conv_id", "turn", "role", "cohorts", F.when(user, F.col("analysis.intent")).alias("intent"),
        F.when(user, F.col("analysis.column_selection")).alias("data_source"))


def running_context(messages: DataFrame) -> DataFrame:
    """(conv_id, mentions, segments_discussed, last_intent, last_data_source).

    ``mentions`` holds (turn, position, name) of the first mention of each
    segment, in order. Works on batch and on streaming messages.
    """
    spoken = analysed_messages(messages.filter(F.col("role").isin("user", "assistant")))
    names = [k.title() for k in intent.COHORTS]
    firsts = [F.min(F.when(F.array_contains("cohorts", n), F.col("turn"))).alias(f"first_{i}") for i, n in enumerate(names)]
    asked_at = F.when(F.col("intent").isNotNull(), F.col("turn"))
    grouped = spoken.groupBy("conv_id").agg(
        *firsts, F.max_by("intent", asked_at).alias("last_intent"),
        F.max_by("data_source", asked_at).alias("last_data_source"))
    return context_rows(grouped.withColumn("firsts", F.array(*[f"first_{i}" for i in range(len(names))])))


def context_rows(kept: DataFrame) -> DataFrame:
    """The context from the kept turns: ``firsts``, in the order of the segment names, last_intent and last_data_source."""
    firsts = F.col("firsts")
    mention = [
        F.when(firsts[i].isNotNull(), F.struct(firsts[i].alias("turn"), F.lit(i).alias("position"), F.lit(k.title()).alias("name")))
        for i, k in enumerate(intent.COHORTS)
    ]
    ordered = F.array_sort(F.array_compact(F.array(*mention)))
    return kept.select(
        "conv_id", ordered.alias("mentions"),
        F.transform(ordered, lambda m: m["name"]).alias("segments_discussed"), "last_intent", "last_data_source")


def with_context_before(messages: DataFrame) -> DataFrame:
    """Messages with the segments discussed before each of them."""
    context = running_context(messages).select("conv_id", "mentions")
    return messages.join(context, "conv_id", "left").withColumn("discussed", F.transform(
        F.filter(F.coalesce("mentions", F.array().cast("array<struct<turn:bigint,position:int,name:string>>")),
                 lambda m: m["turn"] < F.col("turn")),
        lambda m: m["name"])).drop("mentions")


def resolve_requests(messages: DataFrame) -> DataFrame:
    """Resolution of every user message from the context before it."""
    users = with_context_before(messages).filter("role = 'user'")
    return users.select("conv_id", "turn", intent.resolve(F.col("text"), F.col("discussed")).alias("r")).select(
        "conv_id", "turn", "r.*")


def last_messages(messages: DataFrame, n: int, role: str | None = None) -> DataFrame:
    """The last ``n`` messages of each conversation with their place, oldest first."""
    chosen = messages if role is None else messages.filter(F.col("role") == role)
    newest = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    oldest = Window.partitionBy("conv_id").orderBy("turn")
    kept = chosen.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= n).drop("_back")
    return kept.withColumn("place", F.row_number().over(oldest))


def known_conversations(requests: DataFrame, conversations: DataFrame) -> DataFrame:
    return requests.join(conversations.select("conv_id").distinct(), "conv_id", "left_semi")


def append_messages(log: DataFrame, new: DataFrame) -> DataFrame:
    """The log with new messages after the last turn of their conversation."""
    last = log.groupBy("conv_id").agg(F.max("turn").alias("last"))
    placed = new.join(last, "conv_id", "left").withColumn(
        "turn", F.coalesce(F.col("last") + 1, F.lit(0)) + F.col("turn")).drop("last")
    return log.unionByName(placed)


def upsert(current: DataFrame, changes: DataFrame, key: list[str], version: str) -> DataFrame:
    """One row per key: the one with the latest ``version``."""
    rows = current.unionByName(changes)
    row = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(*key).agg(F.max_by(row, F.col(version)).alias("_row")).select("_row.*")


def merge_into(spark: SparkSession, path: str, changes: DataFrame, key: list[str],
               merged: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64) -> None:
    """Merge ``changes`` into the table at ``path``, which is stored by bucket of its key.

    Only the buckets that hold a changed key are read and replaced; all others keep their
    files. ``merged(current, changes)`` must give the same rows when the same changes
    come again. The number of buckets belongs to the table and must not change; choose it
    so that a bucket is a few hundred megabytes.
    """
    columns = changes.columns
    placed = truncate(changes.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")))
    touched = [r[0] for r in placed.select("_bucket").distinct().collect()]  # at most ``buckets`` rows
    if not touched:
        return
    try:
        current = spark.read.schema(placed.schema).parquet(path).filter(F.col("_bucket").isin(touched)).select(*columns)
        rows = merged(current, placed.select(*columns))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = merged(placed.select(*columns).limit(0), placed.select(*columns))
    rows = truncate(rows.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")))
    rows.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)


def upsert_table(spark: SparkSession, path: str, changes: DataFrame, key: list[str], version: str, buckets: int = 64) -> None:
    """``upsert`` into a stored table: the row with the latest ``version`` per key stays."""
    merge_into(spark, path, changes, key, lambda current, new: upsert(current, new, key, version), buckets)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_bucket")


def add_distinct(current: Column, new: Column) -> Column:
    """Array union that keeps the order of first occurrence and drops blanks."""
    return F.array_distinct(F.concat(current, F.filter(new, lambda v: v.isNotNull() & (v != ""))))


def tail(values: Column, n: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - (n - 1), F.lit(1)), n)


def summary(segments: Column) -> Column:
    listed = F.concat(F.lit("Discussed: "), F.array_join(F.slice(segments, 1, SUMMARY_SEGMENTS), ", "))
    return F.when(F.size(segments) > 0, listed).otherwise(DEFAULT_SUMMARY)


def context_prompt(segments: Column, facts: Column, memories: Column) -> Column:
    """The context block of a prompt; empty when nothing is known."""
    past = F.transform(
        F.filter(F.slice(memories, 1, PROMPT_MEMORIES), lambda m: m.isNotNull() & (m != "")),
        lambda m: F.concat(F.lit("Past: "), m))
    parts = F.concat(
        F.array_compact(F.array(
            F.when(F.size(segments) > 0, F.concat(
                F.lit("Segments discussed: "), F.array_join(tail(segments, PROMPT_SEGMENTS), ", "))),
            F.when(F.size(facts) > 0, F.concat(F.lit("Facts: "), F.array_join(tail(facts, PROMPT_FACTS), "; "))))),
        past)
    return F.when(F.size(parts) > 0, F.concat(F.lit("\n## Context\n"), F.array_join(parts, "\n"))).otherwise("")


def memories(messages: DataFrame, users: DataFrame) -> DataFrame:
    """(user_id, conv_id, summary, key_facts, updated_at) to be saved per conversation.

    ``users`` gives the user of each conversation; the last turn is the version.
    """
    last = messages.groupBy("conv_id").agg(F.max("turn").alias("updated_at"))
    return running_context(messages).join(users, "conv_id").join(last, "conv_id").select(
        "user_id", "conv_id", summary(F.col("segments_discussed")).alias("summary"),
        F.array().cast("array<string>").alias("key_facts"), "updated_at")


def last_memories(saved: DataFrame, n: int = 5) -> DataFrame:
    newest = Window.partitionBy("user_id").orderBy(F.desc("updated_at"), "conv_id")
    return saved.withColumn("place", F.row_number().over(newest)).filter(F.col("place") <= n)


def complete_comparisons(requests: DataFrame) -> DataFrame:
    """Complete a comparison of one segment with the last one looked at.

    ``requests`` has conv_id, turn, tool, segment_name and segment_names. The
    rows are range-partitioned on (conv_id, turn): a long conversation is cut
    into slices, and each slice takes over the last value of those before it.
    """
    slices = truncate(
        requests.repartitionByRange("conv_id", "turn").withColumn("_slice", F.spark_partition_id()))
    looked = F.when(F.col("tool") == "get_segment_details", F.col("segment_name"))
    rows = slices.withColumn("_looked", looked)
    ends = rows.groupBy("conv_id", "_slice").agg(
        F.max_by("_looked", F.when(F.col("_looked").isNotNull(), F.col("turn"))).alias("_end"))
    earlier = Window.partitionBy("conv_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("conv_id", "_slice", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    inside = Window.partitionBy("conv_id", "_slice").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    last = F.coalesce(F.last("_looked", ignorenulls=True).over(inside), F.col("_carried"))
    names = F.col("segment_names")
    single = (F.col("tool") == "compare_segments") & (F.size(names) == 1)
    return (
        rows.join(carried, ["conv_id", "_slice"]).withColumn("_last", last)
        .withColumn("segment_names", F.when(
            single & F.col("_last").isNotNull() & ~F.array_contains(names, F.col("_last")),
            F.concat(F.array("_last"), names)).otherwise(names))
        .drop("_slice", "_looked", "_carried", "_last")
    )
