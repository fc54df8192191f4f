import math

import numpy as np
import pytest

from clientele.operators import prepare as pr
from clientele.operators import rank


def values(df, c):
    return [r[c] for r in df.orderBy("id").collect()]


def test_scaling_without_spread(spark):
    df = spark.createDataFrame([(i, v, 5.0) for i, v in enumerate([5.0, 5.0, 5.0, 5.0, 9.0])], "id long, v double, w double")
    assert values(pr.scale(df, ["v"], "robust"), "v") == [0, 0, 0, 0, 4]
    assert values(pr.scale(df, ["w"], "standard"), "w") == [0] * 5
    with pytest.raises(ValueError):
        pr.scale(df, ["v"], "other")


def test_power_exponent_against_fine_grid(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.lognormal(0, 0.8, 150), -rng.lognormal(0, 0.3, 20)])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id long, x double")

    def likelihood(e):
        pos, neg = x[x >= 0], x[x < 0]
        t = np.concatenate([((pos + 1) ** e - 1) / e if e else np.log1p(pos),
                            -((1 - neg) ** (2 - e) - 1) / (2 - e) if e != 2 else -np.log1p(-neg)])
        return -len(x) / 2 * math.log(t.var()) + (e - 1) * (np.sign(x) * np.log1p(abs(x))).sum()

    found = pr.fit_power(df, ["x"])["x"]
    grid = np.arange(-2, 2, 0.001)
    assert found == pytest.approx(max(grid, key=likelihood), abs=2e-3)
    scaled = np.array(values(pr.scale(df, ["x"], "power"), "x"))
    assert abs(scaled.mean()) < 1e-9 and scaled.std() == pytest.approx(1)


def test_encoding(spark):
    rows = [(i, None if i % 11 == 0 else f"c{i % 5}") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, state string")
    by_id = {r.id: r for r in pr.encode(df, ["state"]).collect()}
    assert by_id[0].state_freq is None and by_id[0].state_encoded == 5  # 'unknown' sorts last
    assert sum({r.state: r.state_freq for r in by_id.values() if r.state}.values()) == pytest.approx(1)


def test_imputation(spark):
    df = spark.createDataFrame([(1, 1.0, None, "a", None), (2, None, None, None, None), (3, 4.0, 2.0, "b", None)],
                               "id long, x double, price_std double, t string, empty double")
    out = {r.id: r for r in pr.apply_imputation(df, pr.fit_imputation(df, skip=("id",))).collect()}
    assert out[2].x == 2.5 and out[2].price_std == 0 and out[2].t == "unknown" and out[2].empty is None
    assert {r.column: r.missing for r in pr.missing_report(df).collect()} == {"x": 1, "price_std": 2, "t": 1, "empty": 3}


def test_order_statistics_by_counting(spark, monkeypatch):
    monkeypatch.setattr(rank, "SORTED_ROWS", 20)
    monkeypatch.setattr(rank, "SKETCH_ACCURACY", 50)
    rng = np.random.default_rng(4)
    x = {"a": rng.normal(0, 1, 3000), "b": rng.integers(0, 2, 3000).astype(float), "c": np.zeros(3000),
         "d": np.round(rng.exponential(2, 3000), 1), "e": np.concatenate([np.full(2990, 5.0), rng.normal(0, 100, 10)])}
    rows = [(*[float(x[c][i]) for c in x], None, float(i) if i < 3 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*x, "empty", "few"]))
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = rank.exact_quantiles(df, df.columns, probabilities)
    for c in x:
        assert got[c] == pytest.approx(list(np.quantile(x[c], probabilities)), abs=1e-12), c
    assert got["empty"] == [None] * 7 and got["few"] == pytest.approx(list(np.quantile([0, 1, 2], probabilities)))


def test_power_exponents_far_out(spark):
    y = np.linspace(0.01, 0.99, 200)
    x = (1 + 9 * y) ** (1 / 9) - 1  # the transform with exponent 9 makes it even
    df = spark.createDataFrame([(float(a), 3.0) for a in x], "x double, same double")
    found = pr.fit_power(df, ["x", "same"])
    assert found["x"] > 5 and found["same"] == 1.0

    def likelihood(e):
        return -len(x) / 2 * math.log((((x + 1) ** e - 1) / e).var()) + (e - 1) * np.log1p(x).sum()

    assert likelihood(found["x"]) >= max(likelihood(found["x"] - 1e-3), likelihood(found["x"] + 1e-3))
