"""The registered queries of this subpackage: one per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import (bpe, conversation_repair, html_text, license_scan, mixing, multi_index, packing, pii, simhash, spelling, suffix_dedup,
                           toxicity, tree_forest)
from clientele.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
        toxicity.rejected(F.col("_score")).alias("predicted"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_dedup, op2_embedding_near_dedup, op3_nearest_neighbours, op4_license_scan, op5_toxicity, op6_bpe, op7_source_mixing,
        op8_html_extraction, op9_simhash, op10_pii, op11_spelling_variants, op12_conversation_repair, op13_best_fit_packing)}

_OP7 = f"""SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken FROM ({mixing.oracle()})"""

_OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  AND list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.9),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id)::BIGINT AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a"""

ORACLES: dict[str, str] = {"op7_source_mixing": _OP7, "op2_embedding_near_dedup": _OP2}
