"""Saving and re-reading results: flat files, parameters, playbook, queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.ArrayType, T.MapType, T.StructType)

PLAYBOOK_SCHEMA = (
    "generated_at string, total_customers long, segments map<string, struct<customer_count: long, percentage: double, "
    "description: string, marketing_goal: string, priority: int, budget_allocation: string, actions: array<string>, "
    "kpis: array<string>, avg_customer_value: double>>"
)


def nested_to_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, other columns unchanged."""
    return df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, NESTED) else F.col(f.name) for f in df.schema.fields
    ])


def write_csv(df: DataFrame, path: str) -> None:
    nested_to_json(df).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_feature_list(spark: SparkSession, columns: list[str], path: str) -> None:
    spark.createDataFrame(list(enumerate(columns)), "position int, name string").write.mode("overwrite").parquet(path)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    return [r.name for r in spark.read.parquet(path).orderBy("position").collect()]  # one row per feature


def playbook(profiles: DataFrame, generated_at: str) -> DataFrame:
    """One-row document of the cohort profiles, keyed by segment (at most 11)."""
    entry = F.struct(
        "cohort_name",
        F.struct(
            "customer_count", "percentage", "description", "marketing_goal", "priority", "budget_allocation",
            F.col("recommended_actions").alias("actions"), "kpis", F.col("avg_monetary").alias("avg_customer_value"),
        ),
    )
    ordered = F.array_sort(F.collect_list(F.struct(-F.col("priority"), "cohort_id", entry.alias("entry"))))
    return profiles.agg(
        F.lit(generated_at).alias("generated_at"),
        F.coalesce(F.sum("customer_count"), F.lit(0)).alias("total_customers"),
        F.map_from_entries(F.transform(ordered, lambda e: e["entry"])).alias("segments"),
    )


def write_playbook(document: DataFrame, path: str) -> None:
    document.write.mode("overwrite").json(path)


def read_playbook(spark: SparkSession, path: str) -> DataFrame:
    """The document as one row per segment; no or no valid document gives no rows."""
    try:
        document = spark.read.schema(PLAYBOOK_SCHEMA).json(path, multiLine=True, mode="DROPMALFORMED")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        document = spark.createDataFrame([], PLAYBOOK_SCHEMA)
    return playbook_rows(document)


def playbook_rows(document: DataFrame) -> DataFrame:
    return document.select(F.explode("segments").alias("cohort_name", "s")).select("cohort_name", "s.*")


def run_query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """A SQL text with named parameters over registered views; lower-case names."""
    result = spark.sql(sql, args=params or {})
    return result.toDF(*[c.lower() for c in result.columns])


