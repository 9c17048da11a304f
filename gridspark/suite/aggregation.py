"""Reductions over dimensions and time bins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators import cells, resample
from gridspark.suite.tables import Tables, query, rounded

HOURLY = ("time", "lat", "lon")

_CELLS = """cells AS (SELECT CAST(-1.75 + 0.5 * i AS DOUBLE) AS lat, CAST(0.25 + 0.5 * j AS DOUBLE) AS lon
        FROM (SELECT unnest(range(8)) AS i), (SELECT unnest(range(8)) AS j))"""

# The values of D9's field: missing where an hour's sum is above a limit, so that bins have gaps.
_GAPPY = "(SELECT time, lat, lon, CASE WHEN t2m < 60 THEN t2m END AS v FROM hourly) g"


def _dense(bin_of: str, last: str, step: str, aggregate: str, label: str = "bin") -> str:
    """Every bin from the first to the last, for every cell; ``aggregate`` over ``v`` and ``time``."""
    return f"""WITH {_CELLS},
        g AS (SELECT *, {bin_of} AS bin FROM {_GAPPY}),
        bins AS (SELECT unnest(generate_series(min(bin), {last}, {step})) AS bin FROM g),
        stamped AS (SELECT DISTINCT bin, 1 AS stamped FROM g),
        s AS (SELECT bin, lat, lon, {aggregate} AS v FROM g GROUP BY 1, 2, 3)
        SELECT {label} AS time, c.lat, c.lon, {{value}} AS v
        FROM bins CROSS JOIN cells c LEFT JOIN stamped USING (bin) LEFT JOIN s ON s.bin = bins.bin AND s.lat = c.lat AND s.lon = c.lon"""


_DAY = ("date_trunc('day', time)", "max(bin)", "INTERVAL 1 DAY")
_SIX = ("time_bucket(INTERVAL 6 HOUR, time - INTERVAL 1 SECOND)", "max(bin)", "INTERVAL 6 HOUR")


def _gappy(t: Tables):
    cube = t.hourly().with_axes("time").without(["n"])
    return cube.assign(HOURLY, v=F.when(F.col("t2m") < 60, F.col("t2m"))).without(["t2m"])


def _bins(t: Tables, reduce: str, digits: int | None = 6, **options: str) -> DataFrame:
    out = resample.resample(_gappy(t), reduce, **(options or {"time": "1D"})).frame(*HOURLY)
    return out if digits is None else rounded(out, "v", digits=digits)


@query(
    "H1_mean",
    "ocean",
    """SELECT time, depth, round(sum(CAST(thetao AS DECIMAL(18,2))) / count(thetao), 6) AS thetao FROM ocean GROUP BY 1, 2""",
)
def mean(t: Tables) -> DataFrame:
    return rounded(resample.mean(t.ocean(), ["lat", "lon"]).frame("time", "depth"), "thetao")


@query("H2_resample_mean", "hourly", _dense(*_DAY, "avg(v)").format(value="round(s.v, 6)"))
def resample_mean(t: Tables) -> DataFrame:
    return _bins(t, "mean", time="1D", label="left", closed="left")


@query(
    "H3_resample_sum",
    "hourly",
    _dense(*_DAY, "sum(v)").format(value="CASE WHEN stamped = 1 THEN round(coalesce(s.v, 0.0), 2) END"),
)
def resample_sum(t: Tables) -> DataFrame:
    return _bins(t, "sum", 2)


@query(
    "H4_resample_min",
    "hourly",
    _dense(*_SIX, "min(v)", "bin + INTERVAL 6 HOUR").format(value="s.v"),
)
def resample_min(t: Tables) -> DataFrame:
    """Six hours, closed and labelled on the right."""
    return _bins(t, "min", None, time="6h", label="right", closed="right")


@query("H5_resample_max", "hourly", _dense(*_DAY, "max(v)").format(value="s.v"))
def resample_max(t: Tables) -> DataFrame:
    return _bins(t, "max", None)


@query("H6_resample_median", "hourly", _dense(*_DAY, "median(v)").format(value="round(s.v, 6)"))
def resample_median(t: Tables) -> DataFrame:
    return _bins(t, "median")


@query("H7_resample_std", "hourly", _dense(*_DAY, "stddev_pop(v)").format(value="round(s.v, 6)"))
def resample_std(t: Tables) -> DataFrame:
    return _bins(t, "std")


@query(
    "H8_resample_var",
    "hourly",
    _dense("time_bucket(INTERVAL 5 DAY, time, TIMESTAMP '2024-01-01')", "max(bin)", "INTERVAL 5 DAY", "var_pop(v)").format(
        value="round(s.v, 6)"
    ),
)
def resample_var(t: Tables) -> DataFrame:
    """Five days from the first stamp's midnight."""
    return _bins(t, "var", time="5D")


@query(
    "H9_resample_first",
    "hourly",
    _dense(*_DAY, "arg_min(v, time) FILTER (WHERE v IS NOT NULL)").format(value="s.v"),
)
def resample_first(t: Tables) -> DataFrame:
    return _bins(t, "first", None)


@query(
    "H10_resample_last",
    "hourly",
    _dense("date_trunc('month', time)", "max(bin)", "INTERVAL 1 MONTH", "arg_max(v, time) FILTER (WHERE v IS NOT NULL)").format(
        value="s.v"
    ),
)
def resample_last(t: Tables) -> DataFrame:
    return _bins(t, "last", None, time="1MS")


_CALENDARS = {
    "3MS": """make_date(CAST((f + (m - f) // 3 * 3) // 12 AS BIGINT), CAST((f + (m - f) // 3 * 3) % 12 + 1 AS BIGINT), 1)""",
    "QE": "last_day(date_trunc('quarter', time) + INTERVAL 2 MONTH)",
    "W-MON": "CAST(time AS DATE) + CAST((8 - isodow(time)) % 7 AS INT)",
}


@query(
    "H2_calendar_bins",
    "daily",
    """WITH d AS (SELECT *, year(time) * 12 + month(time) - 1 AS m, (SELECT min(year(time) * 12 + month(time) - 1) FROM daily) AS f FROM daily)
        """
    + " UNION ALL ".join(
        f"SELECT '{name}' AS frequency, CAST({label} AS TIMESTAMP) AS time, cell, round(sum(CAST(x AS DECIMAL(18,2))) / count(x), 7) AS x FROM d GROUP BY 2, 3"
        for name, label in _CALENDARS.items()
    ),
)
def calendar_bins(t: Tables) -> DataFrame:
    """Means of three months from the first stamp's on, of quarters named by their ends, and of weeks that end on Mondays."""
    parts = [
        resample.resample(t.daily(), "mean", dense=False, time=name).frame("time", "cell").withColumn("frequency", F.lit(name))
        for name in _CALENDARS
    ]
    return rounded(reduce(DataFrame.unionByName, parts), "x", digits=7)


@query("H11_resample_count", "hourly", _dense(*_DAY, "count(v)").format(value="CAST(coalesce(s.v, 0) AS BIGINT)"))
def resample_count(t: Tables) -> DataFrame:
    return _bins(t, "count", None)


@query(
    "H12_area_weighted_total",
    "hourly",
    """SELECT time, round(sum(t2m * abs(sin(radians(lat + 0.25)) - sin(radians(lat - 0.25))) * radians(0.5)), 6) AS total
        FROM hourly GROUP BY 1""",
)
def area_weighted_total(t: Tables) -> DataFrame:
    """Totals over the square of the radius."""
    total = cells.area_weighted_total(t.hourly(), "t2m", "lat", "lon")
    return rounded(total.withColumn("total", F.col("total") / F.lit(cells.EARTH_RADIUS**2)), "total")
