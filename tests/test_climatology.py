import datetime

import numpy as np
import pytest
from cubes import array_of, cube_of, days

from gridspark.functions.windows import window
from gridspark.operators import climatology
from gridspark.sources.parts import time_sel


def brute_force(values, labels, period, size, weighting, scale=None):
    """Pooled weighted mean and standard deviation of every bin, value by value."""
    mean = np.full((period, values.shape[1]), np.nan)
    std = np.full_like(mean, np.nan)
    for i in range(period):
        for p in range(values.shape[1]):
            x, w = [], []
            for k, weight in window(size, weighting, scale):
                chosen = values[labels == (i + k) % period, p]
                chosen = chosen[~np.isnan(chosen)]
                x.extend(chosen)
                w.extend([weight] * chosen.size)
            x, w = np.array(x), np.array(w)
            if not x.size:
                continue
            mean[i, p] = (w * x).sum() / w.sum()
            freedom = w.sum() - (w**2).sum() / w.sum()
            if freedom > 1e-12:
                std[i, p] = np.sqrt((w * (x - mean[i, p]) ** 2).sum() / freedom)
    return mean, std


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(2)
    values = 10 * np.sin(np.arange(30) / 6 * 2 * np.pi)[:, None] + rng.standard_normal((30, 3))
    values[rng.random((30, 3)) < 0.3] = np.nan
    values[:, 2] = np.nan
    return values, cube_of(spark, ("time", "point"), values, {"time": days(30), "point": [0, 1, 2]}, "x")


@pytest.mark.parametrize(
    ("size", "weighting", "scale"),
    [(1, "constant", None), (4, "constant", None), (3, "gaussian", None), (5, "geometric", 0.5), (9, "constant", None)],
)
def test_windows_against_brute_force(series, size, weighting, scale):
    values, cube = series
    groups = climatology.compute_climatology(cube, 6, size, weighting, scale)
    mean, std = brute_force(values, np.arange(30) % 6, 6, size, weighting, scale)
    np.testing.assert_allclose(array_of(groups["climatology"], "x"), mean, rtol=1e-10)
    np.testing.assert_allclose(array_of(groups["anomaly_std"], "x"), std, rtol=1e-8)


def test_feb_29_shares_the_bin_of_feb_28(spark):
    stamps = days(1461, datetime.datetime(2019, 1, 1))
    values = np.random.default_rng(3).standard_normal((1461, 1))
    cube = cube_of(spark, ("time", "point"), values, {"time": stamps, "point": [0]}, "x")
    table = climatology.time_bins(cube, 365, "day_of_year").toPandas().sort_values("time")["bin"].to_numpy()
    date = stamps.astype("datetime64[D]")
    leap = np.flatnonzero(date == np.datetime64("2020-02-29"))[0]
    assert table[leap] == 58 and table[leap + 1] == 59 and table.max() == 364
    groups = climatology.compute_climatology(cube, 365, bins="day_of_year")
    mean, std = brute_force(values, table, 365, 1, "constant")
    np.testing.assert_allclose(array_of(groups["climatology"], "x"), mean, rtol=1e-10)
    np.testing.assert_allclose(array_of(groups["anomaly_std"], "x"), std, rtol=1e-8)


def test_bins_are_checked(spark, series):
    _, cube = series
    with pytest.raises(ValueError, match="whole number of periods"):
        climatology.time_bins(cube, 7)
    with pytest.raises(ValueError, match="365"):
        climatology.time_bins(cube, 6, "day_of_year")
    hourly = cube_of(spark, ("time",), np.zeros(30), {"time": days(30, step=datetime.timedelta(hours=1))}, "x")
    with pytest.raises(ValueError, match="at most one"):
        climatology.time_bins(hourly, 365, "day_of_year")


def test_window_weights():
    assert window(4) == [(-2, 1.0), (-1, 1.0), (0, 1.0), (1, 1.0)]
    assert dict(window(5, "geometric"))[2] == pytest.approx(0.1)
    assert dict(window(5, "gaussian"))[1] == pytest.approx(np.exp(-0.5))
    assert window(1, "gaussian") == [(0, 1.0)]
    for bad in ((3, "gaussian", 0.0), (3, "geometric", 1.5), (3, "triangle", None), (0, "constant", None)):
        with pytest.raises(ValueError):
            window(*bad)


def test_combined_statistics_are_those_of_all(series):
    _, cube = series
    whole = climatology.bin_statistics(cube, "x", 6).toPandas().sort_values(["point", "bin"]).reset_index(drop=True)
    early = climatology.bin_statistics(time_sel(cube, "2020-01-01", "2020-03-03"), "x", 6)
    late = climatology.bin_statistics(time_sel(cube, "2020-03-03", "2021-01-01"), "x", 6)
    both = climatology.combine_statistics(early, late, ["point"]).toPandas().sort_values(["point", "bin"])
    for c in ("n", "mean", "m2"):
        np.testing.assert_allclose(both[c].to_numpy(float), whole[c].to_numpy(float), atol=1e-9)


def test_anomalies_have_no_mean_and_unit_spread(series):
    values, cube = series
    table = climatology.pooled(climatology.bin_statistics(cube, "x", 6), ["point"], 6)
    out = climatology.anomalies(cube, "x", table, 6).toPandas().sort_values(["time", "point"])
    mean, _ = brute_force(values, np.arange(30) % 6, 6, 1, "constant")
    np.testing.assert_allclose(out["anomaly"].to_numpy(float).reshape(30, 3), values - mean[np.arange(30) % 6], atol=1e-10)


def test_an_empty_reference_period_is_an_error(series):
    _, cube = series
    assert climatology.reference_period(cube, "2020-02-26", "2020-03-03").frame("time", "point").count() == 18
    with pytest.raises(ValueError, match="no stamps"):
        climatology.reference_period(cube, "1990-01-01", "1991-01-01")


@pytest.mark.parametrize(("size", "weighting"), [(15, "geometric"), (13, "constant"), (6, "constant"), (7, "gaussian")])
def test_windows_longer_than_the_period(series, size, weighting):
    values, cube = series
    groups = climatology.compute_climatology(cube, 6, size, weighting)
    mean, std = brute_force(values, np.arange(30) % 6, 6, size, weighting)
    np.testing.assert_allclose(array_of(groups["climatology"], "x"), mean, rtol=1e-10)
    np.testing.assert_allclose(array_of(groups["anomaly_std"], "x"), std, rtol=1e-8)


@pytest.mark.parametrize(("size", "weighting"), [(4, "constant"), (3, "geometric")])
def test_bins_without_a_row_hold_no_values(series, size, weighting):
    _, cube = series
    whole = climatology.bin_statistics(cube, "x", 6)
    some = whole.where("bin NOT IN (0, 3) AND point < 2")
    blank = some.unionByName(whole.where("bin IN (0, 3) AND point < 2").selectExpr("point", "bin", "0L n", "NULL mean", "0D m2"))
    first, second = (
        climatology.pooled(s, ["point"], 6, size, weighting).toPandas().sort_values(["point", "bin"]).reset_index(drop=True)
        for s in (some, blank)
    )
    assert len(first) == 12
    np.testing.assert_array_equal(first.to_numpy(float), second.to_numpy(float))


def test_equal_values_have_no_spread(spark):
    cube = cube_of(spark, ("time",), np.full(24, 0.1), {"time": days(24)}, "x")
    for size in (1, 5):  # equal weights: unequal ones round the pooled mean
        rows = climatology.pooled(climatology.bin_statistics(cube, "x", 6), [], 6, size).collect()
        assert len(rows) == 6 and {r["anomaly_std"] for r in rows} == {0.0}


def test_windows_of_equal_weights_do_not_multiply_rows(spark, series):
    """Bins are expanded once, from a cell's array; offsets never are, and no window function runs."""
    _, cube = series
    statistics = climatology.bin_statistics(cube, "x", 6)
    stored = spark.createDataFrame(statistics.collect(), statistics.schema)
    table = climatology.pooled(stored, ["point"], 6, 5)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "Generate posexplode" in plan and "Window" not in plan
