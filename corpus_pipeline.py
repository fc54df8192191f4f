"""From documents to training tokens: drop toxic texts, keep one of near copies, redact personal data, mix sources, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import bpe, mixing, pii, simhash, toxicity
from clientele.llm.common import table
from clientele.session import truncate


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; a null text is clean."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    # the row travels as one value, so its columns may have any name
    scored = toxicity.score(docs.select("text", F.struct(*docs.columns).alias("row")), machine, ["row"])
    return scored.where(toxicity.rejected(F.col("_score")) == 0).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group, once per text; documents without an id stay.

    Different texts under one id are different documents: all of them stay with
    their id, equal ones become one.
    """
    groups = simhash.near_duplicates(docs)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct().alias("kept")
    named = docs.alias("docs").join(kept, F.col("docs.doc_id") == F.col("kept.kept_id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets, n_chars counted anew."""
    clean = pii.redacted(docs)
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    return clean if kind is None else clean.withColumn("n_chars", F.length("text").cast(kind))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target of its source takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text per document."""
    return bpe.encode_texts(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The models and hashes have no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = truncate(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
