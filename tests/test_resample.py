import datetime

import numpy as np
import pandas as pd
import pytest
from cubes import array_of, cube_of, days

from gridspark.operators import resample
from gridspark.sources import parts

HOUR = datetime.timedelta(hours=1)


@pytest.fixture(scope="module")
def hourly(spark):
    rng = np.random.default_rng(1)
    values = rng.standard_normal((72, 3))
    values[rng.random((72, 3)) < 0.2] = np.nan
    values[24:48, 2] = np.nan
    return values, cube_of(spark, ("time", "lat"), values, {"time": days(72, step=HOUR), "lat": [0, 1, 2]}, "v")


@pytest.mark.parametrize("reduce", ["mean", "min", "max", "median", "std", "var", "sum", "count", "first", "last"])
def test_reductions_of_days(hourly, reduce):
    values, cube = hourly
    frame = pd.DataFrame(values, index=pd.DatetimeIndex(days(72, step=HOUR)))
    bins = frame.resample("1D")
    expected = getattr(bins, reduce)(ddof=0) if reduce in ("std", "var") else getattr(bins, reduce)()
    out = array_of(resample.resample(cube, reduce, time="1D"), "v")
    np.testing.assert_allclose(out, expected.to_numpy(), rtol=1e-12)


@pytest.mark.parametrize("closed", ["left", "right"])
@pytest.mark.parametrize("label", ["left", "right"])
def test_edges_and_labels(hourly, closed, label):
    values, cube = hourly
    frame = pd.DataFrame(values, index=pd.DatetimeIndex(days(72, step=HOUR)))
    expected = frame.resample("6h", closed=closed, label=label).count()
    out = resample.resample(cube, "count", time="6h", closed=closed, label=label)
    np.testing.assert_array_equal(array_of(out, "v"), expected.to_numpy())
    stamps = [r[0] for r in out.axis("time").orderBy("idx").selectExpr("date_format(time, 'yyyy-MM-dd HH')").collect()]
    assert stamps == [t.strftime("%Y-%m-%d %H") for t in expected.index]


@pytest.mark.parametrize("frequency", ["5D", "7h", "1MS", "1W", "3MS", "ME", "2ME", "QS", "QE", "QS-FEB", "QE-JAN", "YS", "YE-MAR", "W-MON", "2W", "3W-THU", "2QS"])
def test_periods_are_anchored_like_the_first_day(spark, frequency):
    stamps = days(100, datetime.datetime(2020, 2, 5, 6), datetime.timedelta(hours=11))
    values = np.arange(100.0)
    cube = cube_of(spark, ("time",), values, {"time": stamps}, "v")
    expected = pd.Series(values, pd.DatetimeIndex(stamps)).resample(frequency).mean()
    out = resample.resample(cube, "mean", time=frequency)
    got = out.frame("time").selectExpr("date_format(time, 'yyyy-MM-dd HH:mm') AS t", "v").toPandas().sort_values("t")
    assert got["t"].tolist() == [t.strftime("%Y-%m-%d %H:%M") for t in expected.index]
    np.testing.assert_allclose(got["v"].to_numpy(float), expected.to_numpy())


@pytest.mark.parametrize("options", [{"closed": "right"}, {"label": "right"}, {"closed": "right", "label": "right"}])
@pytest.mark.parametrize("frequency", ["MS", "3MS", "2QS-MAR"])
def test_sides_of_calendar_bins(spark, frequency, options):
    stamps = days(120, datetime.datetime(2020, 1, 1), datetime.timedelta(hours=36))
    values = np.arange(120.0)
    cube = cube_of(spark, ("time",), values, {"time": stamps}, "v")
    expected = pd.Series(values, pd.DatetimeIndex(stamps)).resample(frequency, **options).mean()
    got = resample.resample(cube, "mean", time=frequency, **options).frame("time")
    got = got.selectExpr("date_format(time, 'yyyy-MM-dd HH:mm') AS t", "v").toPandas().sort_values("t")
    assert got["t"].tolist() == [t.strftime("%Y-%m-%d %H:%M") for t in expected.index]
    np.testing.assert_allclose(got["v"].to_numpy(float), expected.to_numpy())


def test_bins_without_stamps_are_missing(spark):
    stamps = np.array(["2020-01-01T00", "2020-01-04T12"], dtype="datetime64[us]")
    cube = cube_of(spark, ("time",), np.array([np.nan, 2.0]), {"time": stamps}, "v")
    np.testing.assert_array_equal(array_of(resample.resample(cube, "sum", time="1D"), "v"), [0.0, np.nan, np.nan, 2.0])
    np.testing.assert_array_equal(array_of(resample.resample(cube, "count", time="1D"), "v"), [0, 0, 0, 1])
    assert resample.resample(cube, "count", time="1D", dense=False).frame("time").count() == 2


def test_mean_over_dimensions(hourly):
    values, cube = hourly
    out = resample.mean(cube, "time")
    np.testing.assert_allclose(array_of(out, "v"), np.nanmean(values, axis=0))
    assert resample.mean(cube).frames[()].first()["v"] == pytest.approx(np.nanmean(values))
    with pytest.raises(ValueError):
        resample.mean(cube, "absent")


def test_arguments_are_checked(hourly):
    _, cube = hourly
    for bad in ({"reduce": "mode", "time": "1D"}, {"reduce": "mean"}, {"reduce": "mean", "time": "1D", "label": "up"},
                {"reduce": "mean", "absent": "1D"}, {"reduce": "mean", "time": "fortnight"}):
        with pytest.raises(ValueError):
            resample.resample(cube, **bad)


def test_offset_gives_each_day_its_own_hours(spark):
    """Hours stamped at their end: the sum of day d is that of the hours it covers."""
    stamps = days(96, step=HOUR)
    covered = np.arange(-1.0, 95.0)
    cube = cube_of(spark, ("time",), covered, {"time": stamps}, "tp")
    moved = parts.time_offset(cube, "-1h", "2020-02-27", "2020-02-29")
    out = array_of(resample.resample(moved, "sum", time="1D"), "tp")
    np.testing.assert_array_equal(out, [sum(range(24 * d, 24 * d + 24)) for d in (1, 2)])
