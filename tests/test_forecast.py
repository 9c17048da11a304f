import datetime

import numpy as np
import pytest
from cubes import cube_of, days
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.operators import forecast
from gridspark.operators.forecast import Forecast
from gridspark.plans.axes import axis_of
from gridspark.sources import runs

DAY = 86400
CONFIG = Forecast("3D", "1D", missing_after="2D")
START = "2020-02-26"


@pytest.fixture(scope="module")
def series(spark):
    """sst = the number of the day, six days."""
    values = np.tile(np.arange(6.0)[:, None], (1, 2))
    return cube_of(spark, ("time", "lat"), values, {"time": days(6), "lat": [0, 1]}, "sst")


def stamps(spark, *values):
    table = spark.createDataFrame([(v,) for v in values], "init_time string")
    return table.select(F.col("init_time").cast("timestamp").alias("init_time"))


def day(row, name="init_time"):
    return str(row[name])[:10]


def test_runs_of_an_interval(spark):
    assert [day(r) for r in CONFIG.runs(spark, START, "2020-02-28").orderBy("init_time").collect()] == [START, "2020-02-27"]
    with pytest.raises(ValueError, match="whole number of runs"):
        CONFIG.runs(spark, START, "2020-02-28T12:00:00")
    with pytest.raises(ValueError):
        Forecast("0D")


def test_a_stamp_belongs_to_every_run_that_covers_it(series):
    out = forecast.as_runs(series.frame("time", "lat"), CONFIG, START, "2020-03-01").toPandas()
    assert len(out) == 4 * 3 * 2
    init = (out["init_time"] - np.datetime64(START)).dt.days
    np.testing.assert_array_equal(out["sst"], init + out["lead_time"] // DAY)
    assert ((out["valid_time"] - out["init_time"]).dt.total_seconds() == out["lead_time"]).all()


def test_runs_as_a_cube_with_flags(spark, series):
    leads = axis_of(spark, "lead_time", [0, DAY, 2 * DAY], T.LongType())
    reports = spark.createDataFrame(
        [(START, "ocean", "f", True, False), (START, "ice", "f", True, True), (START, "air", "g", True, False),
         (START, "rivers", None, False, False)],
        "t string, dataset string, flag string, real boolean, unavailable boolean",
    ).select(F.col("t").cast("timestamp").alias("init_time"), "dataset", "flag", "real", "unavailable")
    flags = forecast.run_flags(reports, leads, CONFIG)
    cube = forecast.as_run_cube(series, CONFIG, START, "2020-02-27", flags)
    rows = cube.frame("init_time", "lead_time").orderBy("lead_time").collect()
    assert [(r["f"], r["g"]) for r in rows] == [(False, True)] * 3
    assert cube.dims_of("sst") == ("init_time", "lead_time", "lat")
    clash = flags.withColumn("flag", F.lit("sst"))
    with pytest.raises(ValueError, match="rename one"):
        forecast.as_run_cube(series, CONFIG, START, "2020-02-27", clash)


def test_a_series_that_ends_before_the_run_does_is_the_run(spark, series):
    wanted = CONFIG.runs(spark, START, "2020-03-02")
    rows = forecast.series_is_the_run(series.frame("time", "lat"), wanted, CONFIG).orderBy("init_time").collect()
    assert [r["real"] for r in rows] == [False, False, False, True, True]
    nothing = series.frame("time", "lat").where("false")
    assert not any(r["real"] for r in forecast.series_is_the_run(nothing, wanted, CONFIG).collect())


def test_stand_ins_for_missing_runs(spark, series):
    source = forecast.as_runs(series.frame("time", "lat"), CONFIG, START, "2020-02-28")
    leads = axis_of(spark, "lead_time", [0, DAY, 2 * DAY], T.LongType())
    wanted = stamps(spark, START, "2020-02-27", "2020-02-28")
    out = forecast.with_stand_ins(source, wanted, leads, {"lat": series.axis("lat")}, CONFIG).toPandas()
    assert len(out) == 3 * 3 * 2 and out["sst"].isna().sum() == 6
    with pytest.raises(ValueError, match="floating point"):
        forecast.stand_in(wanted, leads, {}, {"n": "bigint"}, CONFIG)


def test_datasets_with_other_valid_times(spark):
    rows = [(START, d, f"2020-02-{26 + k}") for d, n in (("a", 3), ("b", 2), ("c", 3)) for k in range(n)]
    rows += [(START, "e", f"2020-02-{25 + k}") for k in range(3)]
    times = spark.createDataFrame(rows, "init_time string, dataset string, time string")
    found = {r["dataset"] for r in forecast.different_valid_times(times).collect()}
    assert found == {"b", "e"}


def test_states_of_runs(spark):
    wanted = stamps(spark, *(f"2020-02-{d}" for d in range(20, 27)))
    source = stamps(spark, "2020-02-21", "2020-02-22", "2020-02-25").withColumn("complete", F.dayofmonth("init_time") == 22)
    out = forecast.run_states(wanted, source, stamps(spark, "2020-02-20"), CONFIG, now="2020-02-26T12:00:00")
    states = {day(r)[-2:]: r["state"] for r in out.collect()}
    assert states == {"20": "stored", "21": "incomplete", "22": "ready", "23": "missing", "24": "missing",
                      "25": "waiting", "26": "waiting"}


def test_the_window_keeps_the_last_runs(spark):
    table = stamps(spark, *(f"2020-02-{d}" for d in (20, 21, 22, 22, 23)))
    kept = forecast.rolling_window(table, "init_time", 2)
    assert sorted(day(r) for r in kept.collect()) == ["2020-02-22", "2020-02-22", "2020-02-23"]


def test_layout_of_a_later_run(spark):
    stored = spark.createDataFrame([(0, 1.0), (DAY, 1.0)], "lead_time bigint, v double")
    assert forecast.layout_differences(stored, stored, CONFIG).count() == 0
    run = spark.createDataFrame([(0, 1.0), (2 * DAY, 1.0)], "lead_time bigint, w double")
    found = {tuple(r) for r in forecast.layout_differences(stored, run, CONFIG).collect()}
    assert found == {("lead not in the run", str(DAY)), ("lead not stored", str(2 * DAY)), ("variable not in the run", "v")}


def test_errors_by_lead(series):
    table = forecast.as_runs(series.frame("time", "lat"), CONFIG, START, "2020-03-01")
    drift = table.withColumn("sst", F.col("sst") + F.col("lead_time") / DAY)
    out = forecast.lead_statistics(drift, series.frame("time", "lat"), ["lat"], "sst", "sst", CONFIG)
    rows = [tuple(r) for r in out.orderBy("lead_time").collect()]
    assert rows == [(k * DAY, 8, float(k), float(k), float(k)) for k in range(3)]


# -- runs as sources give them: 2t = step, tp = step squared --------------------------------------

STEPS = [0, 3, 6, 9, 12, 18, 24, 30, 36]


def run_table(spark, steps=STEPS):
    rows = [(datetime.datetime(2020, 1, 1), h, c, float(h), float(h * h)) for h in steps for c in range(2)]
    return spark.createDataFrame(rows, "init_time timestamp, step_h int, cell int, t double, tp double")


def test_accumulations_become_increments(spark):
    out = runs.deaccumulate(run_table(spark), ["tp"], ["cell"]).where("cell = 0").orderBy("step_h").collect()
    expected = [b * b - a * a for a, b in zip(STEPS, STEPS[1:], strict=False)] + [None]
    assert [r["tp"] for r in out] == expected
    valid = runs.steps_as_valid_time(run_table(spark)).where("cell = 1")
    assert valid.columns == ["time", "cell", "t", "tp"] and valid.count() == 9


@pytest.mark.parametrize(
    ("steps", "gaps"),
    [(STEPS, []), ([0, 3, 9, 12], [(3, 9)]), ([0, 3, 6, 12], [(6, 12)]), ([0, 6, 12, 24, 36], [])],
)
def test_gaps_between_steps(spark, steps, gaps):
    assert [(r["from_h"], r["to_h"]) for r in runs.step_gaps(run_table(spark, steps)).collect()] == gaps


def test_windows_of_a_run(spark):
    def status(last):
        return runs.run_status(run_table(spark), 0, last).first()["status"]

    assert (status(24), status(48), status(20)) == ("complete", "incomplete", "no step at the end")
    assert runs.run_window(run_table(spark), 6, 18).select("step_h").distinct().count() == 4


def test_lead_hours(spark):
    table = stamps(spark, "2020-01-01", "2020-01-03T12:00:00", "2020-02-01")
    out = runs.lead_hours(table, "2020-01-03", "2020-01-06").orderBy("init_time", "lead_h").collect()
    assert [(day(r), r["lead_h"]) for r in out] == [
        ("2020-01-01", 48), ("2020-01-01", 72), ("2020-01-01", 96), ("2020-01-03", 24), ("2020-01-03", 48)
    ]
