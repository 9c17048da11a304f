"""Projection, selection, naming and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators import coverage, select
from gridspark.suite.tables import Tables, query

OCEAN = ("time", "depth", "lat", "lon")
HOURLY = ("time", "lat", "lon")


@query("C1_select_variables", "hourly", "SELECT time, lat, lon, n FROM hourly")
def select_variables(t: Tables) -> DataFrame:
    return select.select_variables(t.hourly(), ["n"]).frame(*HOURLY)


@query("C2_drop_vars", "hourly", "SELECT time, lat, lon, t2m FROM hourly")
def drop_vars(t: Tables) -> DataFrame:
    return select.drop_vars(t.hourly(), ["n"]).frame(*HOURLY)


@query("C3_drop_static_vars", "ocean", "SELECT 'thetao' AS variable, CAST(count(thetao) AS BIGINT) AS n FROM ocean")
def drop_static_vars(t: Tables) -> DataFrame:
    """What is left of a cube with a static field: its variables and their numbers of values."""
    cube = select.drop_static_vars(t.ocean(static=True))
    frame = cube.frame(*OCEAN)
    counts = [F.struct(F.lit(v).alias("variable"), F.count(v).alias("n")) for v in cube.variables]
    return frame.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


@query("C4_rename", "static", "SELECT lat AS latitude, lon AS longitude, deptho AS bathymetry FROM static")
def rename(t: Tables) -> DataFrame:
    names = {"lat": "latitude", "lon": "longitude", "deptho": "bathymetry"}
    return select.rename(t.static(), names).frame("latitude", "longitude")


@query(
    "C5_rename_coordinates",
    "ocean",
    """SELECT time, CAST(CASE depth WHEN 0.5 THEN 0 WHEN 2.0 THEN 1 ELSE 2 END AS BIGINT) AS level, depth, lat, lon, thetao
        FROM ocean""",
)
def rename_coordinates(t: Tables) -> DataFrame:
    """Depths numbered, the depths themselves kept on the axis."""
    cube = select.rename_coordinates(t.ocean(), {"depth": "level", "absent": "x"}, {"level": "auto"})
    return cube.frame("time", "level", "lat", "lon").join(cube.axis("level").select("level", "depth"), "level")


@query(
    "C6_sel",
    "hourly",
    """SELECT time, 7 - CAST((lat + 1.75) / 0.5 AS INT) AS k, lat, lon, t2m FROM hourly
        WHERE lat IN (1.25, 0.25, -0.75) AND lon IN (0.75, 2.25)""",
)
def sel(t: Tables) -> DataFrame:
    """Every second label of a decreasing axis, and a list of labels."""
    cube = select.flip(t.hourly().without(["n"]), "lat")
    old = cube.axis("lat").select("lat", F.col("idx").alias("k"))
    cube = select.sel(cube, lat={"start": 1.25, "stop": -1.0, "step": 2}, lon=[0.75, 2.25])
    return cube.frame(*HOURLY).join(old, "lat")


@query("C6_sel_label", "ocean", "SELECT time, lat, lon, thetao FROM ocean WHERE depth = 2.0")
def sel_label(t: Tables) -> DataFrame:
    return select.sel(t.ocean(), depth=2.0).frame("time", "lat", "lon")


@query(
    "C7_isel",
    "hourly",
    """WITH axis AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS k FROM (SELECT DISTINCT time FROM hourly) a)
        SELECT time, CAST((k - 100) // 7 AS INT) AS k, lon, t2m FROM hourly JOIN axis USING (time)
        WHERE k >= 100 AND k < 300 AND (k - 100) % 7 = 0 AND lat = 1.75 AND lon IN (0.25, 3.75)""",
)
def isel(t: Tables) -> DataFrame:
    cube = select.isel(t.hourly().without(["n"]), time={"start": 100, "stop": 300, "step": 7}, lat=-1, lon=[0, -1])
    place = cube.axis("time").select("time", F.col("idx").alias("k"))
    return cube.frame("time", "lon").join(place, "time")


@query(
    "C8_flip",
    "hourly",
    "SELECT time, 7 - CAST((lat + 1.75) / 0.5 AS INT) AS k, lon, t2m FROM hourly",
)
def flip(t: Tables) -> DataFrame:
    cube = select.flip(t.hourly().without(["n"]), "lat")
    place = cube.axis("lat").select("lat", F.col("idx").alias("k"))
    return cube.frame(*HOURLY).join(place, "lat").select("time", "k", "lon", "t2m")


@query("C9_transpose", "ocean", "SELECT lon, lat, depth, time, thetao FROM ocean")
def transpose(t: Tables) -> DataFrame:
    return select.transpose(t.ocean(), ["lon", "lat", "depth", "time"]).frame(*OCEAN)


@query("C10_squeeze", "ocean", "SELECT time, lat, lon, thetao FROM ocean WHERE depth = 5.0")
def squeeze(t: Tables) -> DataFrame:
    return select.squeeze(select.isel(t.ocean(), depth=[-1]), "depth").frame("time", "lat", "lon")


@query(
    "C11_astype",
    "hourly",
    "SELECT time, lat, lon, t2m, CAST(n AS INT) AS n FROM hourly",
)
def astype(t: Tables) -> DataFrame:
    kinds = {"t2m": {"dtype": "float64", "casting": "safe"}, "n": {"dtype": "int32", "casting": "same_kind"}}
    return select.astype(t.hourly(), **kinds).frame(*HOURLY)


@query("C12_convert_calendar", "daily", "SELECT * FROM daily WHERE NOT (month(time) = 2 AND day(time) = 29)")
def convert_calendar(t: Tables) -> DataFrame:
    return select.convert_calendar(t.daily(), "noleap").frame("time", "cell")


@query(
    "C15_coverage_attrs",
    "ocean",
    """WITH t AS (SELECT DISTINCT time FROM ocean), g AS (SELECT time, time - lag(time) OVER (ORDER BY time) AS gap FROM t),
        a AS (SELECT min(time) AS t0, max(time) AS t1, min(gap) AS g0, max(gap) AS g1 FROM g)
        SELECT 'geospatial_lat_min' AS attribute, CAST(-1.75 AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS text
        UNION ALL SELECT 'geospatial_lat_max', 1.75, NULL UNION ALL SELECT 'geospatial_lat_units', NULL, 'degrees_north'
        UNION ALL SELECT 'geospatial_lat_resolution', NULL, '0.5 degree'
        UNION ALL SELECT 'geospatial_lon_min', 0.25, NULL UNION ALL SELECT 'geospatial_lon_max', 3.75, NULL
        UNION ALL SELECT 'geospatial_lon_units', NULL, 'degrees_east'
        UNION ALL SELECT 'geospatial_lon_resolution', NULL, '0.5 degree'
        UNION ALL SELECT 'geospatial_vertical_min', min(depth), NULL FROM ocean
        UNION ALL SELECT 'geospatial_vertical_max', max(depth), NULL FROM ocean
        UNION ALL SELECT 'geospatial_vertical_positive', NULL, 'down'
        UNION ALL SELECT 'time_coverage_start', NULL, strftime(t0, '%Y-%m-%dT%H:%M:%SZ') FROM a
        UNION ALL SELECT 'time_coverage_end', NULL, strftime(t1, '%Y-%m-%dT%H:%M:%SZ') FROM a
        UNION ALL SELECT 'time_coverage_resolution', NULL, 'P' || datediff('day', TIMESTAMP '2000-01-01', TIMESTAMP '2000-01-01' + g0) || 'D'
            FROM a WHERE g0 = g1""",
)
def coverage_attrs(t: Tables) -> DataFrame:
    cube = select.assign_var_attrs(t.ocean(), depth={"positive": "down"})
    return coverage.coverage_report(cube, vertical_dim="depth")


@query(
    "C16_output_coverage",
    "hourly",
    """WITH t AS (SELECT DISTINCT time FROM hourly),
        g AS (SELECT time, time - lag(time) OVER (ORDER BY time) AS gap FROM t),
        a AS (SELECT min(time) AS t0, max(time) AS t1, min(gap) AS g0, max(gap) AS g1 FROM g)
        SELECT 'time_coverage_start' AS attribute, CAST(NULL AS DOUBLE) AS number, strftime(t0, '%Y-%m-%dT%H:%M:%SZ') AS text FROM a
        UNION ALL SELECT 'time_coverage_end', NULL, strftime(t1, '%Y-%m-%dT%H:%M:%SZ') FROM a
        UNION ALL SELECT 'time_coverage_resolution', NULL, 'PT' || CAST(epoch(g0) / 3600 AS BIGINT) || 'H' FROM a WHERE g0 = g1""",
)
def output_coverage(t: Tables) -> DataFrame:
    """Stored stamps of odd days and of the first hours of all, and a block with even days and the first half of all."""
    hours = t.table("events").select(F.date_trunc("hour", "ts").alias("time"))
    stored = hours.where((F.dayofmonth("time") % 2 == 1) | (F.hour("time") < 6))
    block = hours.where((F.dayofmonth("time") % 2 == 0) | (F.hour("time") < 12))
    return coverage.output_coverage(stored, block)


@query(
    "C16_output_coverage_whole",
    "hourly",
    """WITH t AS (SELECT DISTINCT time FROM hourly),
        g AS (SELECT time, time - lag(time) OVER (ORDER BY time) AS gap FROM t),
        a AS (SELECT min(time) AS t0, max(time) AS t1, min(gap) AS g0, max(gap) AS g1 FROM g)
        SELECT 'time_coverage_start' AS attribute, CAST(NULL AS DOUBLE) AS number, strftime(t0, '%Y-%m-%dT%H:%M:%SZ') AS text FROM a
        UNION ALL SELECT 'time_coverage_end', NULL, strftime(t1, '%Y-%m-%dT%H:%M:%SZ') FROM a
        UNION ALL SELECT 'time_coverage_resolution', NULL, 'PT' || CAST(epoch(g0) / 3600 AS BIGINT) || 'H' FROM a WHERE g0 = g1""",
)
def output_coverage_whole(t: Tables) -> DataFrame:
    """All stamps: the first half stored, the rest a block that overlaps it by a day."""
    hours = t.table("events").select(F.date_trunc("hour", "ts").alias("time"))
    seconds = F.unix_seconds(F.col("time").cast("timestamp"))
    middle = hours.agg(((F.min(seconds) + F.max(seconds)) / 2).alias("middle"))
    stored = hours.where(seconds <= middle.scalar())
    block = hours.where(seconds >= middle.scalar() - 86_400)
    return coverage.output_coverage(stored, block)
