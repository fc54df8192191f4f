"""From retail tables to segments, clusters, profiles and playbook."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.operators import cohorts as co
from clientele.operators import segments as sg
from clientele.operators.density import SETTINGS, DensityClustering
from clientele.operators.features import CUSTOMER
from clientele.plans.feature_plan import FeatureResult, run_features
from clientele.session import truncate
from clientele.sources import results as res
from clientele.sources.tables import RetailTables


@dataclass(frozen=True)
class SegmentationResult:
    customers: DataFrame
    cohort_profiles: DataFrame
    cluster_profiles: DataFrame
    tried_settings: DataFrame
    features: FeatureResult


def run_segmentation(t: RetailTables, settings: list[tuple[int, int]] = SETTINGS, grain: str = "base",
                     out: str | None = None, generated_at: str | None = None, probes: int | None = None) -> SegmentationResult:
    """Features, RFM segments, density clusters and both profiles.

    ``probes`` makes the clusters approximate, for tables of many millions of customers.

    With ``out`` all results are also saved there, the parameters of the
    feature steps included, so that they can be applied to other customers.
    """
    f = run_features(t, grain)
    features = truncate(f.features)
    segmented = sg.assign_segments(sg.rfm_scores(features))
    points = f.scaled.select(CUSTOMER, F.array(*[F.col(c).cast("double") for c in f.columns]).alias("vector"))
    model = DensityClustering(points, CUSTOMER, "vector", max(s for _, s in settings), probes=probes)
    labels, tried = model.search(settings)
    customers = truncate(segmented.join(
        labels.withColumnRenamed("probability", "cluster_probability"), CUSTOMER))
    cohorts = co.cohort_profiles(customers)
    clusters = co.cluster_profiles(customers, "favorite_category", "state")
    output = co.customer_output(customers)
    if out:
        res.write_table(output, f"{out}/customer_cohorts")
        res.write_table(features, f"{out}/customer_features")
        res.write_table(f.scaled, f"{out}/customer_features_scaled")
        res.write_feature_list(features.sparkSession, f.columns, f"{out}/feature_columns")
        for name in ("encoding", "imputation", "scaling"):
            res.write_table(getattr(f, name), f"{out}/{name}")
        res.write_csv(cohorts, f"{out}/cohort_profiles_csv")
        res.write_csv(clusters, f"{out}/cluster_profiles_csv")
        res.write_table(cohorts, f"{out}/cohort_profiles")
        res.write_table(clusters, f"{out}/cluster_profiles")
        stamp = generated_at or features.sparkSession.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
        res.write_playbook(res.playbook(cohorts, stamp), f"{out}/marketing_playbook")
    return SegmentationResult(output, cohorts, clusters, tried, f)
