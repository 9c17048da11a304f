"""Data-quality reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.cube import Cube
from gridspark.functions.packing import Encoding
from gridspark.operators import checks, masks, resample, select
from gridspark.operators.blocks import blocks
from gridspark.session import workspace
from gridspark.sources.parts import time_sel
from gridspark.sources.store import Output, intervals_of
from gridspark.suite.tables import Tables, query

HOURLY = ("time", "lat", "lon")
OCEAN = ("time", "depth", "lat", "lon")


@query(
    "J1_valid_time_coordinate",
    "hourly",
    """WITH a AS (SELECT time, count(*) AS n FROM (SELECT DISTINCT time FROM hourly) d GROUP BY 1),
        e AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-02-02' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS time)
        SELECT 'missing' AS problem, time FROM e WHERE time NOT IN (SELECT time FROM a)
        UNION ALL SELECT 'unexpected', time FROM a WHERE time NOT IN (SELECT time FROM e)""",
)
def valid_time_coordinate(t: Tables) -> DataFrame:
    axis = t.hourly().axis("time")
    return checks.valid_time_coordinate(axis, "2024-01-02", "2024-02-02", "1h")


@query(
    "J1_duplicate_stamps",
    sql="""WITH a AS (SELECT event_id, date_trunc('minute', ts) AS time FROM events),
        r AS (SELECT event_id AS idx, time FROM a),
        n AS (SELECT b.time FROM r a JOIN r b ON b.idx = a.idx + 1 WHERE b.time < a.time)
        SELECT 'unsorted' AS problem, time FROM n
        UNION ALL SELECT 'duplicate', time FROM (SELECT time, count(*) AS n FROM a GROUP BY 1) WHERE n > 1
        UNION ALL SELECT 'unexpected', time FROM (SELECT DISTINCT time FROM a) WHERE time < TIMESTAMP '2024-01-03'
            OR time >= TIMESTAMP '2024-01-05' OR extract(minute FROM time) <> 0
        UNION ALL SELECT 'missing', time FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-03',
            TIMESTAMP '2024-01-04 23:00:00', INTERVAL 1 HOUR)) AS time) WHERE time NOT IN (SELECT time FROM a)""",
)
def duplicate_stamps(t: Tables) -> DataFrame:
    """The minutes of all events as an axis: out of order, duplicated, off the hourly axis."""
    axis = t.table("events").select(F.col("event_id").alias("idx"), F.date_trunc("minute", "ts").alias("time"))
    return checks.valid_time_coordinate(axis, "2024-01-03", "2024-01-05", "1h")


@query(
    "J2_valid_global_coordinates",
    "stock",
    """SELECT 'latitudes decrease' AS problem, max(lat) AS number FROM stock HAVING count(*) > 0
        UNION ALL SELECT 'longitude below 0', min(lon) - 2.0 FROM stock WHERE lon < 2.0""",
)
def valid_global_coordinates(t: Tables) -> DataFrame:
    """A field whose latitudes decrease and whose longitudes start west of 0."""
    frame = t.stock().frame("lat", "lon").withColumn("lon", F.col("lon") - 2.0)
    cube = replace(t.stock(), frames={("lat", "lon"): frame}, axes={})
    return checks.valid_global_coordinates(select.flip(cube, "lat"))


@query(
    "J3_ensure_no_nans",
    "ocean static",
    """WITH inside AS (SELECT depth, lat, lon FROM static, (VALUES (0.5), (2.0), (5.0)) l(depth)
            WHERE coalesce(deptho > 0.5 * (CASE depth WHEN 0.5 THEN 0.0 WHEN 2.0 THEN 1.0 ELSE 3.0 END
                + CASE depth WHEN 0.5 THEN 1.0 WHEN 2.0 THEN 3.0 ELSE 7.0 END), false) AND lat > 0),
        f AS (SELECT time, count(*) FILTER (WHERE thetao IS NOT NULL AND i.depth IS NOT NULL) AS found,
                count(*) FILTER (WHERE thetao IS NOT NULL AND i.depth IS NULL) AS outside
            FROM ocean o LEFT JOIN inside i ON o.depth = i.depth AND o.lat = i.lat AND o.lon = i.lon GROUP BY 1),
        w AS (SELECT count(*) AS n FROM inside), land AS (SELECT count(*) AS n FROM static WHERE deptho IS NULL)
        SELECT time, 'thetao' AS variable, 'sea' AS mask, 'missing' AS kind, CAST(w.n - found AS BIGINT) AS n
        FROM f, w WHERE w.n - found > 0
        UNION ALL SELECT time, 'thetao', 'sea', 'outside', CAST(outside AS BIGINT) FROM f WHERE outside > 0
        UNION ALL SELECT NULL, 'deptho', NULL, 'missing', CAST(n AS BIGINT) FROM land WHERE n > 0""",
)
def ensure_no_nans(t: Tables) -> DataFrame:
    """Missing inside a mask on levels, present outside it, and missing in the static field."""
    cube = masks.get_sea_mask(t.ocean(static=True), mask_name="sea")
    dims = cube.dims_of("sea")
    cube = cube.assign(dims, sea=F.col("sea") & (F.col("lat") > 0))
    return checks.missing_values(cube, exact=True, masks={"sea": ["thetao"]})


@query("J4_guard_no_nans", "ocean", "SELECT time, depth, lat, lon, thetao FROM ocean WHERE thetao IS NOT NULL")
def guard_no_nans(t: Tables) -> DataFrame:
    """Rows counted while they are written; the count must be that of the mask's cells."""
    cube = masks.get_notnull_mask(t.ocean(), "thetao", "wet")
    guarded, guards = checks.guard_no_nans(cube, exact=True, wet=["thetao"], skipped=["wet"])
    path = workspace(t.spark, "guarded")
    guarded.frame(*OCEAN).write.parquet(path)
    stored = t.spark.read.parquet(path)
    for guard in guards:
        guard.verify(replace(cube, frames={OCEAN: stored}))
    return stored.where("wet").select(*OCEAN, "thetao")


@query(
    "J5_attributes",
    sql="""WITH a AS (SELECT CAST(p_partkey AS VARCHAR) AS variable, 'long_name' AS attribute, p_name AS value FROM part
            UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'units', CASE WHEN p_size % 9 = 0 THEN '' ELSE p_brand END FROM part),
        d AS (SELECT value FROM a WHERE attribute = 'long_name' GROUP BY 1 HAVING count(*) > 1)
        SELECT 'lacking' AS problem, attribute, variable, CAST(NULL AS VARCHAR) AS value FROM a WHERE value = ''
        UNION ALL SELECT 'same', attribute, variable, value FROM a WHERE attribute = 'long_name' AND value IN (SELECT value FROM d)""",
)
def attributes(t: Tables) -> DataFrame:
    """Parts as variables: their names are long names, their brands units (some are empty)."""
    part = t.table("part").withColumn("variable", F.col("p_partkey").cast("string"))
    units = F.when(F.col("p_size") % 9 == 0, F.lit("")).otherwise(F.col("p_brand"))
    long_names = part.select("variable", F.lit("long_name").alias("attribute"), F.col("p_name").alias("value"))
    given = long_names.unionByName(part.select("variable", F.lit("units").alias("attribute"), units.alias("value")))
    return checks.attribute_report(part.select("variable"), given)


@query(
    "J6_check_static",
    "stock",
    """SELECT lat, lon, 'size' AS variable FROM stock WHERE abs(lat) > 1.5 AND lon < 1
        UNION ALL SELECT lat, lon, 'deptho' FROM stock WHERE lat = 0.25 AND lon > 0.5""",
)
def check_static(t: Tables) -> DataFrame:
    """A static table against one stored packed, then changed in some cells."""
    encoding = Encoding("smallint", 0.5, 0.0, -32768)
    cube = t.stock().without(["fraction"])
    stored = cube.frame("lat", "lon").withColumn("size", encoding.as_stored(F.col("size")))
    changed = F.when((F.abs("lat") > 1.5) & (F.col("lon") < 1), F.col("size") + 1).otherwise(F.col("size"))
    lost = F.when(F.col("lat") != 0.25, F.col("deptho"))
    computed = stored.withColumns({"size": changed, "deptho": lost})
    return checks.check_static(computed, stored, ["lat", "lon"])


_RULES = {
    "valid_time_coordinate": {"freq": "1D"},
    "valid_global_coordinates": {"latitude_dim": "lat", "longitude_dim": "lon"},
    "attributes": {},
    "ensure_no_nans": {},
}


def _counted_days(hours: Cube) -> Cube:
    """The number of hours with a value, by day."""
    days = select.rename(resample.resample(hours.without(["n"]), "count", time="1D"), {"t2m": "n"})
    return select.assign_var_attrs(days, n={"long_name": "number of hours", "units": "1"})


_COUNTED_DAYS = """SELECT d AS time, c.lat, c.lon, CAST(count(t2m) AS BIGINT) AS n
        FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS d FROM events)
        CROSS JOIN (SELECT CAST(-1.75 + 0.5 * i AS DOUBLE) AS lat, CAST(0.25 + 0.5 * j AS DOUBLE) AS lon
                FROM (SELECT unnest(range(8)) AS i), (SELECT unnest(range(8)) AS j)) c
        LEFT JOIN hourly h ON h.lat = c.lat AND h.lon = c.lon AND date_trunc('day', time) = d GROUP BY 1, 2, 3"""


def _days_in_blocks(t: Tables, step: str, apart: bool) -> DataFrame:
    """The daily counts from the table's first day to its last, in blocks; each block's days, attributes and values are checked
    before it is recorded."""
    days = _counted_days(t.hourly())
    day = F.date_trunc("day", "ts").cast("date")
    ends = t.table("events").agg(F.min(day).alias("first"), F.date_add(F.max(day), 1).alias("end")).first()
    if ends["first"] is None:
        return days.frame(*HOURLY)
    output = Output(t.spark, workspace(t.spark, "block-checks"))
    run = output.start()
    intervals = intervals_of(blocks(t.spark, ends["first"].isoformat(), ends["end"].isoformat(), step))
    for part in [[i] for i in intervals] if apart else [intervals]:
        run.write_blocks(days, part, _RULES)
    run.publish()
    return output.read().frame(*HOURLY)


@query("J7_block_checks", "hourly", _COUNTED_DAYS)
def block_checks(t: Tables) -> DataFrame:
    """Blocks of ten days, one write each."""
    return _days_in_blocks(t, "10D", apart=True)


@query("J7_block_checks_whole", "hourly", _COUNTED_DAYS)
def block_checks_whole(t: Tables) -> DataFrame:
    """Blocks of four days, all in one write."""
    return _days_in_blocks(t, "4D", apart=False)
