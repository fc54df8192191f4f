"""The running conversation context as a Structured Streaming job."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clientele.operators import intent
from clientele.operators.conversation import analysed_messages, context_rows, merge_into, read_table

MESSAGE_SCHEMA = "conv_id long, turn long, role string, text string"
#: What is kept of a conversation: the first turn of each segment, and the last question.
KEPT = "conv_id long, firsts array<long>, asked long, last_intent string, last_data_source string"
_STATE = "firsts array<long>, asked long, last_intent string, last_data_source string"
IDLE_SECONDS = 3600


def message_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages from Parquet files as they appear in a folder."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def _take_in(idle_seconds: float):
    """The stateful step of one conversation: least first turns and the latest question."""
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        firsts, asked, last_intent, source = state.get if state.exists else ([None] * len(intent.COHORTS), None, None, None)
        firsts = [None if f is None or f != f else int(f) for f in firsts]
        seen = state.getCurrentWatermarkMs()
        for frame in frames:
            seen = max(seen, frame["seen"].max().value // 1_000_000)
            for turn, cohorts, said, data_source in zip(frame["turn"], frame["cohorts"], frame["intent"], frame["data_source"]):
                if turn is None or turn != turn:
                    continue
                for i, name in enumerate(intent.COHORTS):
                    if name.title() in cohorts and (firsts[i] is None or turn < firsts[i]):
                        firsts[i] = int(turn)
                if said is not None and (asked is None or turn >= asked):
                    asked, last_intent, source = int(turn), said, data_source
        state.update((firsts, asked, last_intent, source))
        state.setTimeoutTimestamp(seen + int(idle_seconds * 1000) + 1)
        yield pd.DataFrame({"conv_id": [key[0]], "firsts": [firsts], "asked": pd.array([asked], "Int64"),
                            "last_intent": [last_intent], "last_data_source": [source]})
    return step


def merged_contexts(current: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per conversation. What is kept only ever falls or grows, so it does not matter in which order
    rows come, whether one comes twice, or whether a state was forgotten between them."""
    rows = current.unionByName(changes)
    firsts = F.array(*[F.min(F.col("firsts")[i]) for i in range(len(intent.COHORTS))])
    return rows.groupBy("conv_id").agg(
        firsts.alias("firsts"), F.max("asked").alias("asked"), F.max_by("last_intent", "asked").alias("last_intent"),
        F.max_by("last_data_source", "asked").alias("last_data_source"))


def start_context_stream(messages: DataFrame, out: str, checkpoint: str, idle_seconds: float = IDLE_SECONDS, buckets: int = 64,
                         **trigger) -> StreamingQuery:
    """Keep the table ``out`` of contexts up to date.

    The state of a conversation is bounded and leaves the store with the first messages
    that come ``idle_seconds`` after its last one; if it goes on later, its new state is
    merged with its row in the table. Time is that of arrival, one instant per batch, so
    no message is late. A batch that is run again changes nothing.
    """
    spoken = analysed_messages(messages.filter(F.col("role").isin("user", "assistant")))
    arrived = spoken.select("conv_id", "turn", "cohorts", "intent", "data_source", F.current_timestamp().alias("seen"))
    kept = arrived.withWatermark("seen", "0 seconds").groupBy("conv_id").applyInPandasWithState(
        _take_in(idle_seconds), KEPT, _STATE, "update", GroupStateTimeout.EventTimeTimeout)

    def save(batch: DataFrame, batch_id: int) -> None:
        merge_into(batch.sparkSession, out, batch, ["conv_id"], merged_contexts, buckets)

    writer = kept.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(save).trigger(**(trigger or {"availableNow": True})).start()


def latest_context(spark: SparkSession, out: str) -> DataFrame:
    """The context per conversation."""
    return context_rows(read_table(spark, out))
