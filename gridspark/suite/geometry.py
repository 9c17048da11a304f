"""Cells and regridding."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.cube import Cube
from gridspark.operators import cells, regrid
from gridspark.suite.tables import Tables, query, rounded

HOURLY = ("time", "lat", "lon")
OCEAN = ("time", "depth", "lat", "lon")
NESTED = {"south": -1.5, "north": 1.5, "west": 0.5, "east": 3.5, "resolution_lat": 1.0, "resolution_lon": 1.0}
STRADDLING = {**NESTED, "resolution_lat": 0.75, "resolution_lon": 0.75}
BEYOND = {"south": -2.0, "north": 2.0, "west": 0.0, "east": 4.0, "resolution_lat": 1.0, "resolution_lon": 1.0}
FINE = {"south": -1.75, "north": 1.75, "west": 0.25, "east": 3.75, "resolution_lat": 0.25, "resolution_lon": 0.25}
WHERE = {"latitude_dim": "lat", "longitude_dim": "lon"}

# Source cells and target cells of an axis as SQL: 8 cells of half a degree, and a regular target.
_SOURCE = """ys AS (SELECT -1.75 + 0.5 * i AS lat, -2.0 + 0.5 * i AS y0, -1.5 + 0.5 * i AS y1
        FROM (SELECT CAST(unnest(range(8)) AS DOUBLE) AS i)),
    xs AS (SELECT 0.25 + 0.5 * i AS lon, 0.5 * i AS x0, 0.5 + 0.5 * i AS x1
        FROM (SELECT CAST(unnest(range(8)) AS DOUBLE) AS i))"""


def _targets(grid: dict) -> str:
    ny = int((grid["north"] - grid["south"]) / grid["resolution_lat"] + 1e-9) + 1
    nx = int((grid["east"] - grid["west"]) / grid["resolution_lon"] + 1e-9) + 1
    dy, dx = grid["resolution_lat"], grid["resolution_lon"]
    return f"""yt AS (SELECT {grid['south']} + {dy} * i AS c, {grid['south']} + {dy} * (i - 0.5) AS a,
            {grid['south']} + {dy} * (i + 0.5) AS b FROM (SELECT CAST(unnest(range({ny})) AS DOUBLE) AS i)),
        xt AS (SELECT {grid['west']} + {dx} * i AS c, {grid['west']} + {dx} * (i - 0.5) AS a,
            {grid['west']} + {dx} * (i + 0.5) AS b FROM (SELECT CAST(unnest(range({nx})) AS DOUBLE) AS i))"""


def _overlaps(grid: dict) -> str:
    """Weights of source cells in target cells by overlap."""
    return f"""{_SOURCE}, {_targets(grid)},
        wy AS (SELECT lat, c AS tlat, (least(y1, b) - greatest(y0, a)) / (y1 - y0)
                * abs(sin(radians(y1)) - sin(radians(y0))) AS u
            FROM ys, yt WHERE least(y1, b) > greatest(y0, a) AND c BETWEEN -1.75 AND 1.75),
        wx AS (SELECT lon, c AS tlon, (least(x1, b) - greatest(x0, a)) / (x1 - x0) * radians(x1 - x0) AS v
            FROM xs, xt WHERE least(x1, b) > greatest(x0, a) AND c BETWEEN 0.25 AND 3.75),
        w AS (SELECT lat, lon, tlat, tlon, u * v AS w FROM wy, wx),
        total AS (SELECT tlat, tlon, sum(w) AS whole FROM w GROUP BY 1, 2)"""


def _plain_labels(df: DataFrame) -> DataFrame:
    """Target labels (32-bit) as doubles."""
    return df.withColumns({d: F.col(d).cast("double") for d in ("lat", "lon")})


@query(
    "G1_cell_bounds",
    "stock",
    """SELECT s.lat, s.lon, s.lat - 0.25 AS lat_lo, s.lat + 0.25 AS lat_hi, s.lon - 0.25 AS lon_lo, s.lon + 0.25 AS lon_hi, size
        FROM stock s""",
)
def cell_bounds(t: Tables) -> DataFrame:
    """The field with the edges of its cells."""
    cube = cells.cell_bounds(t.stock(), "lat", "lon")
    lat = cube.axis("lat").select("lat", F.col("lat_bnds_lo").alias("lat_lo"), F.col("lat_bnds_hi").alias("lat_hi"))
    lon = cube.axis("lon").select("lon", F.col("lon_bnds_lo").alias("lon_lo"), F.col("lon_bnds_hi").alias("lon_hi"))
    return cube.frame("lat", "lon").select("lat", "lon", "size").join(lat, "lat").join(lon, "lon")


@query(
    "G1_depth_bounds",
    sql="""WITH layers AS (SELECT CASE p_size % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 2.0 ELSE 5.0 END AS depth,
            CASE p_size % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 ELSE 4.0 END AS e, min(p_size) AS least
            FROM part GROUP BY 1, 2)
        SELECT CAST(depth AS DOUBLE) AS depth, CAST(sum(e) OVER o - e AS DOUBLE) AS lo, CAST(sum(e) OVER o AS DOUBLE) AS hi
        FROM layers WINDOW o AS (ORDER BY depth)""",
)
def depth_bounds(t: Tables) -> DataFrame:
    """Layers stacked by their thickness."""
    kind = F.col("p_size") % 3
    depth = F.when(kind == 0, 0.5).when(kind == 1, 2.0).otherwise(5.0)
    thickness = F.when(kind == 0, 1.0).when(kind == 1, 2.0).otherwise(4.0)
    layers = t.table("part").select(depth.alias("depth"), thickness.alias("e3t")).distinct()
    cube = Cube.of({("depth",): layers, ("lat", "lon"): t.static_frame()}, {"lat": t.lat, "lon": t.lon})
    axis = cells.cell_bounds(cube, "lat", "lon", "depth", "e3t").axis("depth")
    return axis.select("depth", F.col("depth_bnds_lo").alias("lo"), F.col("depth_bnds_hi").alias("hi"))


_AREA = "pow(6371000.0, 2) * abs(sin(radians(lat + 0.25)) - sin(radians(lat - 0.25))) * radians(0.5)"


@query(
    "G2_cell_area",
    "stock",
    f"""WITH c AS (SELECT CAST(-1.75 + 0.5 * i AS DOUBLE) AS lat, CAST(0.25 + 0.5 * j AS DOUBLE) AS lon
            FROM (SELECT unnest(range(8)) AS i), (SELECT unnest(range(8)) AS j))
        SELECT lat, lon, size, round({_AREA} / 1000000.0, 3) AS km2 FROM c LEFT JOIN stock USING (lat, lon)""",
)
def cell_area(t: Tables) -> DataFrame:
    frame = cells.cell_area(t.stock(), "area", **WHERE).frame("lat", "lon")
    km2 = F.round(F.col("area") / 1_000_000.0, 3)
    return frame.select("lat", "lon", "size", km2.alias("km2"))


@query(
    "G3_per_unit_area",
    "hourly",
    f"SELECT time, lat, lon, round(t2m * (86400000000.0 / ({_AREA})), 4) AS t2m FROM hourly",
)
def per_unit_area(t: Tables) -> DataFrame:
    cube = cells.per_unit_area(t.hourly().without(["n"]), ["t2m"], **WHERE, factor=86_400_000_000.0)
    return rounded(cube.frame(*HOURLY), "t2m", digits=4)


@query(
    "G4_regrid_conservative",
    "ocean",
    f"""WITH {_overlaps(STRADDLING)}
        SELECT time, depth, tlat AS lat, tlon AS lon, round(CASE WHEN sum(CASE WHEN thetao IS NOT NULL THEN w END)
            / max(whole) >= 0.4 - 1e-9 THEN sum(w * thetao) / sum(CASE WHEN thetao IS NOT NULL THEN w END) END, 6) AS thetao
        FROM ocean JOIN w USING (lat, lon) JOIN total USING (tlat, tlon) GROUP BY 1, 2, 3, 4""",
)
def regrid_conservative(t: Tables) -> DataFrame:
    """The mean of the valid part, where it is at least 0.4 of the cell."""
    options = {"skipna": True, "nan_threshold": 0.6}
    cube = regrid.regrid(t.ocean(), STRADDLING, method="conservative", kwargs=options, **WHERE)
    return _plain_labels(rounded(cube.frame(*OCEAN), "thetao"))


@query(
    "G4_regrid_conservative_zero",
    "ocean",
    f"""WITH {_overlaps(STRADDLING)},
        spine AS (SELECT time, depth, tlat, tlon, whole FROM (SELECT DISTINCT time FROM ocean) a,
            (VALUES (0.5), (2.0), (5.0)) d(depth), total),
        s AS (SELECT time, depth, tlat, tlon, sum(w * coalesce(thetao, 0)) AS s FROM ocean JOIN w USING (lat, lon) GROUP BY 1, 2, 3, 4)
        SELECT time, CAST(depth AS DOUBLE) AS depth, tlat AS lat, tlon AS lon, round(coalesce(s, 0) / whole, 6) AS thetao
        FROM spine LEFT JOIN s USING (time, depth, tlat, tlon)""",
)
def regrid_conservative_zero(t: Tables) -> DataFrame:
    """Missing cells count as 0; every target cell has a value."""
    cube = regrid.regrid(t.ocean(), STRADDLING, method="conservative", kwargs={"skipna": False}, **WHERE)
    return _plain_labels(rounded(cube.frame(*OCEAN), "thetao"))


_CELLS = f"""{_targets(BEYOND)},
    p AS (SELECT *, floor((lat + 2.5) / 1.0) - 2.0 AS tlat, floor((lon + 0.5) / 1.0) AS tlon FROM {{source}})"""


@query(
    "G5_regrid_stat",
    "hourly",
    f"""WITH {_CELLS.format(source='hourly')},
        s AS (SELECT time, tlat, tlon, CAST(sum(CAST(t2m AS DECIMAL(18,2))) AS DOUBLE) AS t2m FROM p GROUP BY 1, 2, 3)
        SELECT a.time, yt.c AS lat, xt.c AS lon,
            CASE WHEN yt.c BETWEEN -1.75 AND 1.75 AND xt.c BETWEEN 0.25 AND 3.75 THEN round(coalesce(t2m, 0.0), 4) ELSE -1.0 END AS t2m
        FROM (SELECT DISTINCT time FROM hourly) a CROSS JOIN yt CROSS JOIN xt
        LEFT JOIN s ON s.time = a.time AND s.tlat = yt.c AND s.tlon = xt.c""",
)
def regrid_stat(t: Tables) -> DataFrame:
    """Sums of the points in each target cell, -1 in cells without points or blank."""
    options = {"method": "sum", "skipna": True, "fill_value": -1.0}
    cube = regrid.regrid(t.hourly().without(["n"]), BEYOND, method="stat", kwargs=options, **WHERE)
    return _plain_labels(rounded(cube.frame(*HOURLY), "t2m", digits=4))


def _mode(order: str) -> str:
    return f"""WITH {_CELLS.format(source='hourly')},
        k AS (SELECT date_trunc('day', time) AS time, tlat, tlon, n, count(*) AS c FROM p GROUP BY 1, 2, 3, 4),
        r AS (SELECT *, row_number() OVER (PARTITION BY time, tlat, tlon ORDER BY c {order}, n) AS r FROM k)
        SELECT time, tlat AS lat, tlon AS lon,
            CASE WHEN tlat BETWEEN -1.75 AND 1.75 AND tlon BETWEEN 0.25 AND 3.75 THEN CAST(n AS BIGINT) END AS n FROM r WHERE r = 1"""


def _most(t: Tables, method: str) -> DataFrame:
    cube = t.hourly().without(["t2m"])
    frame = cube.frame(*HOURLY).withColumn("time", F.date_trunc("day", "time"))
    cube = replace(cube, frames={HOURLY: frame})
    out = regrid.regrid(cube, BEYOND, method=method, **WHERE)
    return _plain_labels(out.frame(*HOURLY))


@query("G6_regrid_most_common", "hourly", _mode("DESC"))
def regrid_most_common(t: Tables) -> DataFrame:
    """The most common count of a day in each target cell."""
    return _most(t, "most_common")


@query("G6_regrid_least_common", "hourly", _mode("ASC"))
def regrid_least_common(t: Tables) -> DataFrame:
    return _most(t, "least_common")


@query(
    "G7_regrid_nearest",
    "hourly",
    f"""WITH {_SOURCE}, {_targets(STRADDLING)},
        ny AS (SELECT c, min_by(lat, abs(lat - c) * 1000 + lat / 1000) AS lat FROM yt, ys GROUP BY 1),
        nx AS (SELECT c, min_by(lon, abs(lon - c) * 1000 + lon / 1000) AS lon FROM xt, xs GROUP BY 1)
        SELECT time, ny.c AS lat, nx.c AS lon, t2m FROM hourly h JOIN ny ON h.lat = ny.lat JOIN nx ON h.lon = nx.lon""",
)
def regrid_nearest(t: Tables) -> DataFrame:
    return _plain_labels(regrid.regrid(t.hourly().without(["n"]), STRADDLING, **WHERE).frame(*HOURLY))


@query(
    "G8_regrid_linear",
    "ocean",
    f"""WITH {_SOURCE}, {_targets(FINE)},
        ly AS (SELECT c, lat, 1 - abs(lat - c) / 0.5 AS u FROM yt, ys WHERE abs(lat - c) < 0.5),
        lx AS (SELECT c, lon, 1 - abs(lon - c) / 0.5 AS v FROM xt, xs WHERE abs(lon - c) < 0.5),
        ny AS (SELECT c, count(*) AS k FROM ly GROUP BY 1), nx AS (SELECT c, count(*) AS k FROM lx GROUP BY 1)
        SELECT time, depth, ly.c AS lat, lx.c AS lon,
            round(CASE WHEN count(thetao) = max(ny.k * nx.k) THEN sum(u * v * thetao) END, 6) AS thetao
        FROM ocean o JOIN ly ON o.lat = ly.lat JOIN lx ON o.lon = lx.lon
        JOIN ny ON ny.c = ly.c JOIN nx ON nx.c = lx.c GROUP BY 1, 2, 3, 4""",
)
def regrid_linear(t: Tables) -> DataFrame:
    return _plain_labels(rounded(regrid.regrid(t.ocean(), FINE, method="linear", **WHERE).frame(*OCEAN), "thetao"))


def _keys(position: str, centre: str) -> str:
    """Keys' kernel at the distance (in cells) between a point and a centre."""
    d = f"abs(({position} - {centre}) / 0.5)"
    return f"""CASE WHEN {d} <= 1 THEN 1.5 * pow({d}, 3) - 2.5 * pow({d}, 2) + 1
        WHEN {d} < 2 THEN -0.5 * pow({d}, 3) + 2.5 * pow({d}, 2) - 4 * {d} + 2 ELSE 0 END"""


@query(
    "G9_regrid_cubic",
    "hourly",
    f"""WITH {_targets(STRADDLING)},
        py AS (SELECT -1.75 + 0.5 * k AS y, -1.75 + 0.5 * least(greatest(k, 0), 7) AS lat FROM (SELECT CAST(unnest(range(-1, 9)) AS DOUBLE) AS k)),
        px AS (SELECT 0.25 + 0.5 * k AS x, 0.25 + 0.5 * least(greatest(k, 0), 7) AS lon FROM (SELECT CAST(unnest(range(-1, 9)) AS DOUBLE) AS k)),
        ky AS (SELECT c, lat, sum({_keys('y', 'c')}) AS u FROM yt, py GROUP BY 1, 2),
        kx AS (SELECT c, lon, sum({_keys('x', 'c')}) AS v FROM xt, px GROUP BY 1, 2),
        wy AS (SELECT * FROM ky WHERE abs(u) > 1e-14), wx AS (SELECT * FROM kx WHERE abs(v) > 1e-14),
        ny AS (SELECT c, count(*) AS k FROM wy GROUP BY 1), nx AS (SELECT c, count(*) AS k FROM wx GROUP BY 1)
        SELECT time, wy.c AS lat, wx.c AS lon, round(CASE WHEN count(t2m) = max(ny.k * nx.k) THEN sum(u * v * t2m) END, 10) AS t2m
        FROM hourly h JOIN wy ON h.lat = wy.lat JOIN wx ON h.lon = wx.lon
        JOIN ny ON ny.c = wy.c JOIN nx ON nx.c = wx.c GROUP BY 1, 2, 3""",
)
def regrid_cubic(t: Tables) -> DataFrame:
    cube = regrid.regrid(t.hourly().without(["n"]), STRADDLING, method="cubic", **WHERE)
    return _plain_labels(rounded(cube.frame(*HOURLY), "t2m", digits=10))


@query(
    "G13_conservation_check",
    "ocean",
    f"""WITH {_overlaps(NESTED)},
        a AS (SELECT time, depth, sum(coalesce(thetao, 0) * abs(sin(radians(lat + 0.25)) - sin(radians(lat - 0.25)))
            * radians(0.5)) AS s FROM ocean GROUP BY 1, 2),
        t AS (SELECT time, depth, tlat, tlon, sum(w * coalesce(thetao, 0)) / max(whole) AS v
            FROM ocean JOIN w USING (lat, lon) JOIN total USING (tlat, tlon) GROUP BY 1, 2, 3, 4),
        b AS (SELECT time, depth, sum(v * abs(sin(radians(tlat + 0.5)) - sin(radians(tlat - 0.5))) * radians(1.0)) AS s
            FROM t GROUP BY 1, 2),
        levels AS (SELECT time, depth FROM (SELECT DISTINCT time FROM ocean)
            CROSS JOIN (SELECT unnest([0.5::DOUBLE, 2.0::DOUBLE, 5.0::DOUBLE]) AS depth))
        SELECT time, depth, round(coalesce(a.s, 0.0), 6) AS source_total, round(coalesce(b.s, 0.0), 6) AS target_total,
            coalesce(abs(a.s - b.s) <= 1e-9 * a.s, true) AS conserved
        FROM levels LEFT JOIN a USING (time, depth) LEFT JOIN b USING (time, depth)""",
)
def conservation_check(t: Tables) -> DataFrame:
    """Totals before and after (over the square of the radius); the step fails if they differ."""
    cube = t.ocean().with_axes("time")
    options = {"method": "conservative", "kwargs": {"skipna": False}, **WHERE}
    out = regrid.regrid(cube, NESTED, **options, conservation_tolerance=1e-9)
    report = regrid.conservation_report(cube, out, "thetao", 1e-9, "lat", "lon")
    scale = F.lit(cells.EARTH_RADIUS**2)
    return report.select(
        "time",
        "depth",
        F.round(F.col("source_total") / scale, 6).alias("source_total"),
        F.round(F.col("target_total") / scale, 6).alias("target_total"),
        "conserved",
    )
