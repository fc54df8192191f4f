"""Checks of encoding, imputation and scaling on the assembled features."""

from pyspark.sql import functions as F

from clientele.checks.features import FEATURES as _FEATURES
from clientele.checks.registry import NUDGE, retail, rounded
from clientele.operators import features as fe
from clientele.operators import prepare as pr

ID = fe.CUSTOMER


def _features(t):
    return fe.assemble(t, materialize=True)


def _freq_sql(c):
    return f"(SELECT {c}, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM features WHERE {c} IS NOT NULL GROUP BY 1) q_{c}"


_ENCODED = f"""WITH {_FEATURES}
SELECT f.customer_unique_id, {', '.join(f'round(q_{c}.share, 6) AS {c}_freq' for c in pr.CATEGORICAL)}
FROM features f {' '.join(f'LEFT JOIN {_freq_sql(c)} ON f.{c} = q_{c}.{c}' for c in pr.CATEGORICAL)}"""


@retail("x01_frequency_encoding", _ENCODED)
def _frequency(t):
    df = pr.encode(_features(t))
    return rounded(df.select(ID, *[f"{c}_freq" for c in pr.CATEGORICAL]))


@retail("x02_label_encoding", f"""WITH {_FEATURES}
SELECT customer_unique_id, {', '.join(f"dense_rank() OVER (ORDER BY coalesce({c}, 'unknown')) - 1 AS {c}_encoded" for c in pr.CATEGORICAL)}
FROM features""")
def _labels(t):
    df = pr.encode(_features(t))
    return rounded(df.select(ID, *[f"{c}_encoded" for c in pr.CATEGORICAL]))


_NUMERIC = [c for c in fe.ALL_FEATURES if c not in pr.CATEGORICAL]


def _filled(c):
    rule = pr.FILL_VALUES.get(c, "median")
    value = f"(SELECT median({c}) FROM features)" if rule == "median" else str(rule)
    return f"coalesce({c}, {value}) AS {c}"


_FILLED = f"""{_FEATURES},
filled AS (SELECT customer_unique_id, {', '.join(_filled(c) for c in _NUMERIC)},
  {', '.join(f"coalesce({c}, 'unknown') AS {c}" for c in pr.CATEGORICAL)} FROM features)"""


@retail("x03_imputation", f"""WITH {_FILLED} SELECT customer_unique_id,
  {', '.join(f'round(CAST({c} AS DOUBLE), 5) AS {c}' for c in _NUMERIC if c != 'price_std')}, round(price_std, 3) AS price_std,
  {', '.join(pr.CATEGORICAL)} FROM filled""")
def _imputed(t):
    df = pr.impute(_features(t))
    df = df.select(ID, *[F.col(c).cast("double").alias(c) for c in _NUMERIC], *pr.CATEGORICAL)
    return rounded(df.withColumn("price_std", F.round("price_std", 3)), 5)


@retail("x04_missing_report", f"""WITH {_FEATURES} SELECT * FROM (
{' UNION ALL '.join(f"SELECT '{c}' AS column, count(*) - count({c}) AS missing FROM features" for c in fe.ALL_FEATURES)}) x
WHERE missing > 0""")
def _missing(t):
    return pr.missing_report(_features(t))


_SCALED = pr.CLUSTERING_FEATURES
_CODED = f"""{_FEATURES},
share AS (SELECT region, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS region_freq FROM features WHERE region IS NOT NULL GROUP BY 1),
coded AS (SELECT f.*, s.region_freq FROM features f LEFT JOIN share s ON f.region = s.region),
ready AS (SELECT customer_unique_id, {', '.join(_filled(c).replace('FROM features', 'FROM coded') for c in _SCALED)} FROM coded)"""


def _coded(t):
    return pr.encode(_features(t))


def _digits(c):
    """The deviation of prices is a root, so fewer of its digits are equal in two engines."""
    return 3 if c == "price_std" else 5


def _compared(df, digits=_digits):
    values = {c: F.col(c).cast("double") for c in _SCALED}
    return df.select(F.col(ID).cast("long").alias(ID), *[F.round(v + F.signum(v) * NUDGE, digits(c)).alias(c) for c, v in values.items()])


_ROBUST = f"""WITH {_CODED}, q AS (SELECT {', '.join(
    f'quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.5, 0.75]) AS {c}' for c in _SCALED)} FROM ready)
SELECT customer_unique_id, {', '.join(
    f'round((ready.{c} - q.{c}[2]) / CASE WHEN q.{c}[3] = q.{c}[1] THEN 1.0 ELSE q.{c}[3] - q.{c}[1] END, {_digits(c)}) AS {c}' for c in _SCALED)}
FROM ready, q"""


@retail("x05_robust_scaling", _ROBUST)
def _robust(t):
    return _compared(pr.scale(pr.impute(_coded(t)), _SCALED, "robust"))


@retail("x06_standard_scaling", f"""WITH {_CODED}, q AS (SELECT {', '.join(
    f'avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}' for c in _SCALED)} FROM ready)
SELECT customer_unique_id, {', '.join(
    f'round((ready.{c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END, {_digits(c)}) AS {c}' for c in _SCALED)}
FROM ready, q""")
def _standard(t):
    return _compared(pr.scale(pr.impute(_coded(t)), _SCALED, "standard"))


@retail("x07_power_scaling")
def _power(t):
    df = pr.scale(pr.impute(_coded(t)), _SCALED, "power")
    return rounded(df.select(ID, *_SCALED), 4)


def _likelihood_sql(values, grid):
    """(col, e, ll): the likelihood of each exponent of a table (col, e)."""
    y = ("CASE WHEN x >= 0 THEN CASE WHEN abs(e) < 1e-12 THEN ln(1 + x) ELSE (pow(x + 1, e) - 1) / e END "
         "ELSE CASE WHEN abs(2 - e) < 1e-12 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - e) - 1) / (2 - e) END END")
    return (f"(SELECT col, e, CASE WHEN var_pop({y}) > 0 AND isfinite(var_pop({y})) THEN -count(*) / 2.0 * ln(var_pop({y})) + (e - 1) * sum(sign(x) * ln(1 + abs(x))) END AS ll "
            f"FROM {values} JOIN {grid} USING (col) GROUP BY col, e)")


# Steps of the search in SQL: each level goes a little beyond a step of the one before.
_STEPS = [2, 0.1, 0.01, 1e-3, 1e-4, 1e-5]
_LEVELS = [f"""b{k + 1} AS (SELECT col, coalesce(arg_max(e, ll), 1.0) AS e FROM {_likelihood_sql('v', f'(SELECT col, e + i * {step} AS e FROM b{k}, range(-22, 23) r(i))')} GROUP BY col)"""
           for k, step in enumerate(_STEPS)]


@retail("x07_power_exponents", f"""WITH {_CODED},
v AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS x FROM ready" for c in _SCALED)}),
b0 AS (SELECT col, coalesce(arg_max(e, ll), 1.0) AS e FROM {_likelihood_sql('v', '(SELECT col, i * 25.0 AS e FROM (SELECT DISTINCT col FROM v), range(-200, 201) r(i))')} GROUP BY col),
{', '.join(_LEVELS)}
SELECT col AS "column", CASE WHEN abs(e) < 20 THEN round(e, 2) ELSE round(e, -1) END AS exponent FROM b{len(_STEPS)}""")
def _exponents(t):
    df = pr.impute(_coded(t))
    found = [(c, round(e, 2 if abs(e) < 20 else -1)) for c, e in pr.fit_power(df, _SCALED).items()]
    return df.sparkSession.createDataFrame(found, "column string, exponent double")


@retail("x09_clustering_features", f"""WITH {_CODED} SELECT customer_unique_id, {', '.join(
    f'round(CAST({c} AS DOUBLE), {_digits(c)}) AS {c}' for c in _SCALED)} FROM coded""")
def _selected(t):
    df = _coded(t)
    assert pr.present(pr.CLUSTERING_FEATURES, df) == _SCALED
    return _compared(df)


@retail("x10_feature_pipeline", _ROBUST)
def _pipeline(t):
    from clientele.plans.feature_plan import run_features
    return _compared(run_features(t).scaled)
