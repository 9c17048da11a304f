"""Masks and fills, arithmetic, vertical operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators import arith, masks, vertical
from gridspark.suite.tables import Tables, query, rounded

OCEAN = ("time", "depth", "lat", "lon")
HOURLY = ("time", "lat", "lon")


@query(
    "D1_apply_mask",
    "ocean static",
    """SELECT time, depth, o.lat, o.lon, CASE WHEN deptho > depth AND o.lat > 0 THEN n END AS n
        FROM (SELECT time, depth, lat, lon, coalesce(thetao, 0) AS n FROM ocean) o
        LEFT JOIN static s ON o.lat = s.lat AND o.lon = s.lon""",
)
def apply_mask(t: Tables) -> DataFrame:
    """A filled field, missing again outside the northern part of a mask on levels."""
    cube = masks.get_sea_mask(t.ocean(static=True), mask_name="sea")
    mask_dims = cube.dims_of("sea")
    cube = cube.assign(mask_dims, sea=F.col("sea") & (F.col("lat") > 0))
    cube = masks.apply_mask(masks.fillna(cube, {"thetao": 0.0}), "sea", ["thetao"])
    return cube.frame(*OCEAN).withColumnRenamed("thetao", "n")


@query(
    "D2_get_notnull_mask",
    "ocean",
    "SELECT time, depth, lat, lon, thetao, thetao IS NOT NULL AS wet FROM ocean",
)
def get_notnull_mask(t: Tables) -> DataFrame:
    return masks.get_notnull_mask(t.ocean(), "thetao", "wet").frame(*OCEAN)


@query("D3_is_positive_mask", "stock static", "SELECT lat, lon, coalesce(deptho > 0, false) AS sea FROM static")
def is_positive_mask(t: Tables) -> DataFrame:
    return masks.is_positive_mask(t.static(), "deptho", "sea").frame("lat", "lon").drop("deptho")


@query(
    "D4_get_sea_mask",
    "static",
    """SELECT depth, lat, lon, coalesce(deptho > 0.3 * top + 0.7 * bottom, false) AS sea
        FROM static, (VALUES (0.5, 0.0, 1.0), (2.0, 1.0, 3.0), (5.0, 3.0, 7.0)) l(depth, top, bottom)""",
)
def get_sea_mask(t: Tables) -> DataFrame:
    cube = t.ocean(static=True)
    out = masks.get_sea_mask(cube, threshold=0.3, mask_name="sea")
    return out.frame("depth", "lat", "lon")


@query(
    "D5_fraction_mask",
    "stock",
    """SELECT lat, lon, CASE WHEN fraction < 0.93 THEN 0.0 ELSE fraction END AS fraction,
        CASE WHEN fraction < 0.93 THEN 0.0 ELSE fraction END >= 0.96 AS mask FROM stock""",
)
def fraction_mask(t: Tables) -> DataFrame:
    cube = masks.fraction_mask(t.stock(), "fraction", "mask", 0.96, inclusive=True, tolerance=0.93)
    return cube.frame("lat", "lon").select("lat", "lon", "fraction", "mask")


@query(
    "D6_keep_where",
    "hourly stock",
    """SELECT time, h.lat, h.lon, CASE WHEN size = 50 THEN t2m ELSE -1.0 END AS t2m
        FROM hourly h LEFT JOIN stock s ON h.lat = s.lat AND h.lon = s.lon""",
)
def keep_where(t: Tables) -> DataFrame:
    cube = t.hourly().without(["n"]).add_frame(("lat", "lon"), t.stock().frame("lat", "lon"))
    return masks.keep_where(cube, ["t2m"], "size", 50, -1.0).frame(*HOURLY)


@query(
    "D7_masked_fill",
    "ocean static",
    """SELECT time, o.depth, o.lat, o.lon, CASE WHEN thetao IS NULL AND o.lat < 0 THEN deptho ELSE thetao END AS thetao
        FROM ocean o LEFT JOIN static s ON o.lat = s.lat AND o.lon = s.lon""",
)
def masked_fill(t: Tables) -> DataFrame:
    cube = t.ocean(static=True)
    cube = cube.assign(("lat", "lon"), south=F.col("lat") < 0)
    return masks.masked_fill(cube, ["thetao"], {"thetao": "deptho"}, "south").frame(*OCEAN)


@query(
    "D7_masked_fill_first_level",
    "ocean static",
    """SELECT time, h.lat, h.lon, CASE WHEN t IS NULL AND deptho > 0.5 THEN -9.0 ELSE t END AS t
        FROM (SELECT time, lat, lon, max(thetao) AS t FROM ocean GROUP BY 1, 2, 3) h
        LEFT JOIN static s ON h.lat = s.lat AND h.lon = s.lon""",
)
def masked_fill_first_level(t: Tables) -> DataFrame:
    """A field without levels under a mask on levels: the mask's first level applies."""
    cube = masks.get_sea_mask(t.ocean(static=True), mask_name="sea")
    top = cube.frame(*OCEAN).groupBy("time", "lat", "lon").agg(F.max("thetao").alias("t"))
    cube = cube.without(["thetao"]).add_frame(("time", "lat", "lon"), top)
    return masks.masked_fill(cube, ["t"], -9.0, "sea").frame("time", "lat", "lon")


@query("D8_fillna", "ocean", "SELECT time, depth, lat, lon, coalesce(thetao, -1.0) AS thetao FROM ocean")
def fillna(t: Tables) -> DataFrame:
    return masks.fillna(t.ocean(), -1.0).frame(*OCEAN)


@query(
    "D9_clip_negative",
    "hourly",
    "SELECT time, lat, lon, CASE WHEN t2m - 100 < 0 THEN 0.0 ELSE round(t2m - 100, 2) END AS t2m FROM hourly",
)
def clip_negative(t: Tables) -> DataFrame:
    cube = t.hourly().without(["n"]).assign(HOURLY, t2m=F.round(F.col("t2m") - 100, 2))
    return masks.clip_negative(cube, ["t2m"]).frame(*HOURLY)


@query("E1_rescale", "hourly", "SELECT time, lat, lon, t2m * 1000.0 AS t2m, CAST(n * 3 AS BIGINT) AS n FROM hourly")
def rescale(t: Tables) -> DataFrame:
    return arith.rescale(t.hourly(), t2m=1000.0, n=3, absent=2.0).frame(*HOURLY)


@query(
    "E2_products",
    "ocean static",
    """SELECT time, depth, o.lat, o.lon, thetao, thetao * deptho AS heat
        FROM ocean o LEFT JOIN static s ON o.lat = s.lat AND o.lon = s.lon""",
)
def products(t: Tables) -> DataFrame:
    return arith.products(t.ocean(static=True), heat=["thetao", "deptho"]).frame(*OCEAN)


@query(
    "E3_divide_by",
    "hourly static",
    """SELECT time, h.lat, h.lon, round(CASE WHEN deptho > 0 THEN t2m / deptho END, 6) AS t2m
        FROM hourly h LEFT JOIN static s ON h.lat = s.lat AND h.lon = s.lon""",
)
def divide_by(t: Tables) -> DataFrame:
    cube = t.hourly().without(["n"]).add_frame(("lat", "lon"), t.static_frame())
    return rounded(arith.divide_by(cube, ["t2m"], "deptho").frame(*HOURLY), "t2m")


@query(
    "E4_sin_cos",
    "hourly",
    """SELECT time, lat, lon, round(sin(t2m * (pi() / 180.0)), 6) AS s, round(cos(t2m * (pi() / 180.0)), 6) AS c
        FROM hourly""",
)
def sin_cos(t: Tables) -> DataFrame:
    return rounded(arith.sin_cos(t.hourly().without(["n"]), "t2m", "s", "c").frame(*HOURLY), "s", "c")


@query(
    "E5_mean_direction",
    "hourly",
    """WITH m AS (SELECT date_trunc('day', time) AS time, lat, lon, avg(sin(t2m * (pi() / 180.0))) AS s,
            avg(cos(t2m * (pi() / 180.0))) AS c FROM hourly GROUP BY 1, 2, 3)
        SELECT time, lat, lon, round(CASE WHEN atan2(s, c) < 0 THEN degrees(atan2(s, c)) + 360
            ELSE degrees(atan2(s, c)) END, 4) AS direction, round(sqrt(s * s + c * c), 6) AS steadiness FROM m""",
)
def mean_direction(t: Tables) -> DataFrame:
    pair = arith.sin_cos(t.hourly().without(["n"]), "t2m", "s", "c").frame(*HOURLY)
    days = pair.groupBy(F.date_trunc("day", "time").alias("time"), "lat", "lon").agg(
        F.avg("s").alias("s"), F.avg("c").alias("c")
    )
    direction, steadiness = arith.mean_direction(F.col("s"), F.col("c"))
    return days.select(
        "time", "lat", "lon", F.round(direction, 4).alias("direction"), F.round(steadiness, 6).alias("steadiness")
    )


@query(
    "F1_get_bottom",
    "ocean",
    """SELECT time, lat, lon, max_by(thetao, depth) FILTER (WHERE thetao IS NOT NULL) AS thetao
        FROM ocean GROUP BY 1, 2, 3""",
)
def get_bottom(t: Tables) -> DataFrame:
    return vertical.get_bottom(t.ocean(), "depth").frame("time", "lat", "lon")


@query(
    "F2_fill_from_above",
    "ocean static",
    """SELECT time, depth, lat, lon,
        CASE WHEN thetao IS NULL AND lat > 0 THEN last_value(thetao IGNORE NULLS) OVER
            (PARTITION BY time, lat, lon ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            ELSE thetao END AS thetao FROM ocean""",
)
def fill_from_above(t: Tables) -> DataFrame:
    cube = t.ocean(static=True)
    cube = cube.assign(("lat", "lon"), north=F.col("lat") > 0)
    return vertical.fill_from_above(cube, ["thetao"], "depth", "north").frame(*OCEAN)
