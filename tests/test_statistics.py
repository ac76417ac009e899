import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clientele.functions import quantiles
from clientele.functions.fdist import incomplete_beta
from clientele.functions.quantiles import exact_quantiles
from clientele.operators import anomaly, explore, scaling, validation
from clientele.constants import ANALYSIS_FEATURES


def frame(spark, columns):
    return spark.createDataFrame(pd.DataFrame(columns))


PROBS = [0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["skewed", "ties", "few", "negative", "constant"])
def test_quantiles_by_counting(spark, kind):
    rng = np.random.default_rng(1)
    values = {
        "skewed": np.exp(rng.normal(0, 6, 5000)),
        "ties": np.where(rng.random(5000) < 0.4, 7.0, rng.integers(0, 50, 5000)),
        "few": np.array([3.0, 1.0]),
        "negative": rng.normal(-5, 1e-7, 3000),
        "constant": np.full(50, 2.5),
    }[kind]
    df = frame(spark, {"x": values})
    wanted = np.quantile(values, PROBS)
    found = exact_quantiles(df, ["x"], PROBS)["x"]
    assert np.allclose(found, wanted, rtol=1e-12, atol=0), kind


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "x double, y double")
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [2.0], "y": [None]}


def test_quantiles_of_extreme_values(spark):
    inf = float("inf")
    values = [-inf, -1e308, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1e308, inf, inf]
    found = exact_quantiles(frame(spark, {"x": values * 100}), ["x"], [i / 999 for i in range(0, 1000, 37)])
    ordered = np.sort(np.array(values * 100))
    for p, got in zip(range(0, 1000, 37), found["x"]):
        assert got == ordered[p]
    assert exact_quantiles(frame(spark, {"x": [*range(1000), inf]}), ["x"], [0.01, 0.99])["x"] == [10.0, 990.0]


def test_summary_of_constant_and_short_columns(spark):
    df = frame(spark, {"a": [2.0] * 6, "b": [1.0, 2.0, 4.0, 8.0, 16.0, 32.0]})
    rows = {r.feature: r for r in explore.summary_statistics(df, ["a", "b"]).collect()}
    b = pd.Series([1.0, 2.0, 4.0, 8.0, 16.0, 32.0])
    assert (rows["a"].skewness, rows["a"].kurtosis) == (0.0, 0.0)
    assert math.isclose(rows["b"].skewness, b.skew())
    assert math.isclose(rows["b"].kurtosis, b.kurt())
    matrix = explore.correlation_matrix(df, ["a", "b"]).collect()
    assert {(r.feature, r.other): r.correlation for r in matrix}["a", "b"] is None
    bins = explore.feature_histogram(df, ["a"], 4).orderBy("bin").collect()
    assert [(r.bin_start, r.n) for r in bins] == [(1.5, 0), (1.75, 0), (2.0, 6), (2.25, 0)]
    assert explore.feature_kde(df, ["a"]).isEmpty()


def test_kde_integrates_to_one(spark):
    values = np.random.default_rng(2).normal(size=400)
    rows = explore.feature_kde(frame(spark, {"x": values}), ["x"], 400, cut=4.0).toPandas()
    rows = rows.sort_values("x")
    assert math.isclose(np.trapezoid(rows["density"], rows["x"]), 1.0, abs_tol=1e-3)


def test_robust_scale_of_constant(spark):
    df = frame(spark, {"CustomerID": ["a", "b"], "x": [5.0, 5.0], "y": [0.0, 2.0]})
    rows = scaling.robust_scale(df, ["x", "y"]).orderBy("CustomerID").collect()
    assert [(r.x, r.y) for r in rows] == [(0.0, -1.0), (0.0, 1.0)]


def test_forest_finds_the_far_points(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(1000, 3))
    data[:20] += 30
    df = frame(spark, {"CustomerID": [str(i) for i in range(1000)], **dict(zip("xyz", data.T))})
    scored = anomaly.isolation_forest(df, list("xyz"))
    out = {int(r.CustomerID) for r in scored.where("is_outlier").collect()}
    assert len(out) == 50 and set(range(20)) <= out
    again = anomaly.isolation_forest(df.repartition(3), list("xyz"))
    assert {int(r.CustomerID) for r in again.where("is_outlier").collect()} == out
    assert anomaly.inliers(scored).count() == 950


def test_forest_on_fewer_rows_than_a_sample(spark):
    df = frame(spark, {"CustomerID": [str(i) for i in range(40)], "x": [0.0] * 38 + [50.0, -50.0]})
    scored = anomaly.isolation_forest(df, ["x"])
    assert {r.CustomerID for r in scored.where("is_outlier").collect()} == {"38", "39"}


def test_samples_have_the_wanted_size(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("CustomerID"), F.lit(1.0).alias("x"))
    per_tree = anomaly.draw_samples(df, ["x"], 5000, 20, 256, 42).groupBy("tree").count().collect()
    assert len(per_tree) == 20 and all(256 <= r["count"] <= 700 for r in per_tree)


def test_incomplete_beta():
    # Closed forms: I_x(1, b) = 1 - (1 - x)^b and I_x(a, 1) = x^a.
    for x in (0.01, 0.3, 0.8, 0.999):
        assert math.isclose(incomplete_beta(1, 7.5, x), 1 - (1 - x) ** 7.5, rel_tol=1e-12)
        assert math.isclose(incomplete_beta(3.25, 1, x), x ** 3.25, rel_tol=1e-12)
        both = incomplete_beta(2.5, 4.5, x) + incomplete_beta(4.5, 2.5, 1 - x)
        assert math.isclose(both, 1.0, rel_tol=1e-12)


def test_anova_edges(spark):
    df = frame(spark, {
        "cluster": [1, 1, 2, 2, -1],
        "x": [1.0, 1.0, 2.0, 2.0, 99.0], "y": [3.0, 3.0, 3.0, 3.0, 99.0], "z": [1.0, 2.0, 3.0, 5.0, 0.0],
    })
    rows = {r.feature: r for r in validation.anova(df, "cluster", ["x", "y", "z"]).collect()}
    assert (rows["x"].f_statistic, rows["x"].p_value) == (math.inf, 0.0) and rows["x"].significant
    assert rows["y"].eta_squared == 0.0 and not rows["y"].significant
    assert math.isclose(rows["z"].f_statistic, 5.0)
    assert math.isclose(rows["z"].p_value, 0.15485, abs_tol=1e-5)
    empty = validation.anova_summary(validation.anova(df.limit(0), "cluster", ANALYSIS_FEATURES[:0] or ["x"]))
    assert empty.isEmpty()


@pytest.mark.parametrize("rows", [1, 2, 3, 10, 900, 20_000])
def test_quantiles_in_two_scans(spark, monkeypatch, rows):
    """A sketch brackets each rank and one counting scan finds it; small tables search on."""
    rng = np.random.default_rng(rows)
    data = pd.DataFrame({"a": rng.normal(size=rows), "b": np.round(rng.exponential(size=rows), 1)})
    data.loc[0, "b"] = np.inf if rows > 10 else data.loc[0, "b"]
    scans = []
    counted = quantiles._count_bins
    monkeypatch.setattr(quantiles, "_count_bins", lambda *a, **k: scans.append(a) or counted(*a, **k))
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 1.0]
    found = quantiles.exact_quantiles(spark.createDataFrame(data).repartition(3), ["a", "b"], probs)
    for name in ("a", "b"):
        with np.errstate(invalid="ignore"):
            wanted = np.quantile(data[name].to_numpy()[np.isfinite(data[name])], probs) if (
                name == "a") else np.sort(data[name])[np.floor((rows - 1) * np.array(probs)).astype(int)]
        if name == "a":
            assert np.allclose(found[name], wanted, rtol=1e-12)
        else:
            above = np.sort(data[name])[np.ceil((rows - 1) * np.array(probs)).astype(int)]
            assert all(w <= f <= u for w, f, u in zip(wanted, found[name], above))
    if rows == 20_000:
        assert len(scans) == 1


def test_quantiles_count_only_the_rows_of_brackets(spark, monkeypatch):
    """Rows outside every bracket stay in the scan, and odd values still have their place."""
    rng = np.random.default_rng(5)
    one = rng.lognormal(size=40_000)
    two = np.concatenate([
        rng.normal(size=20_000), [np.inf] * 300, [-np.inf] * 300, [0.0, -0.0] * 500, [np.nan] * 200,
    ])
    rows = [(float(a), None if i % 7 == 0 else float(b)) for i, (a, b) in enumerate(zip(one, two))]
    df = spark.createDataFrame(rows, "a double, b double")
    counted, count_bins = [], quantiles._count_bins

    def watched(*args):
        bins = count_bins(*args)
        counted.append(sum(n for found in bins.values() for _, n, _, _ in found))
        return bins

    monkeypatch.setattr(quantiles, "_count_bins", watched)
    probs = [0.0, 0.01, 0.4, 0.5, 0.97, 1.0]
    found = quantiles.exact_quantiles(df, ["a", "b"], probs)
    assert max(counted) < 0.25 * len(rows)
    for i, c in enumerate("ab"):
        held = np.sort([r[i] for r in rows if r[i] is not None])
        places = [(len(held) - 1) * p for p in probs]
        for h, value in zip(places, found[c]):
            low, high = held[int(np.floor(h))], held[int(np.ceil(h))]
            wanted = low if low == high or not h % 1 else low + (high - low) * (h % 1)
            assert value == wanted or (np.isnan(value) and np.isnan(wanted))
