"""From retail tables to raw and scaled customer features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from clientele.operators import features as fe
from clientele.operators import prepare as pr
from clientele.session import truncate
from clientele.sources.tables import RetailTables


@dataclass(frozen=True)
class FeatureResult:
    features: DataFrame  # imputed and encoded, not scaled
    scaled: DataFrame  # the clustering features scaled in place
    columns: list[str]  # the clustering features, in order
    encoding: DataFrame
    imputation: DataFrame
    scaling: DataFrame


def run_features(t: RetailTables, grain: str = "base", method: str = "robust") -> FeatureResult:
    """Assemble, encode, impute and scale, in that order.

    Encoding comes before imputation, so the frequency of an unmapped region
    is missing and gets the median.
    """
    raw = fe.assemble(t, grain, materialize=True)
    encoding = pr.fit_encoding(raw)
    encoded = truncate(pr.apply_encoding(raw, encoding))
    imputation = pr.fit_imputation(encoded)
    features = pr.apply_imputation(encoded, imputation)
    columns = pr.present(pr.CLUSTERING_FEATURES, features)
    scaling = pr.fit_scaling(features, columns, method)
    return FeatureResult(features, pr.apply_scaling(features, scaling), columns, encoding, imputation, scaling)
