"""Time blocks of an output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.cube import Cube
from gridspark.operators import blocks
from gridspark.session import workspace
from gridspark.sources.store import Output, intervals_of
from gridspark.suite.tables import Tables, query

_SPAN = ("2024-01-01", "2024-01-31", "8D")
_BLOCKS = """b AS (SELECT CAST(k AS INT) AS block, TIMESTAMP '2024-01-01' + to_days(CAST(8 * k AS INT)) AS block_start,
        least(TIMESTAMP '2024-01-01' + to_days(CAST(8 * k + 8 AS INT)), TIMESTAMP '2024-01-31') AS block_end
        FROM (SELECT unnest(range(4)) AS k))"""


@query(
    "L1_blocks",
    "hourly",
    f"""WITH {_BLOCKS} SELECT block, block_start, block_end, CAST(count(t2m) AS BIGINT) AS n
        FROM b LEFT JOIN hourly ON time >= block_start AND time < block_end GROUP BY 1, 2, 3""",
)
def tiling(t: Tables) -> DataFrame:
    """The blocks of an interval and the values each holds."""
    counts = blocks.assign_block(t.hourly().frame("time", "lat", "lon"), *_SPAN).groupBy("block").agg(
        F.count("t2m").alias("n")
    )
    joined = blocks.blocks(t.spark, *_SPAN).join(counts, "block", "left")
    return joined.select("block", "block_start", "block_end", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "L2_assign_block",
    "hourly",
    f"WITH {_BLOCKS} SELECT time, lat, lon, t2m, n, block, block_start FROM hourly JOIN b ON time >= block_start AND time < block_end",
)
def assign_block(t: Tables) -> DataFrame:
    return blocks.assign_block(t.hourly().frame("time", "lat", "lon"), *_SPAN)


def _manifest(t: Tables) -> DataFrame:
    """Weeks with enough orders, as the committed blocks of an output, in the order of their keys."""
    weeks = t.table("orders").groupBy(F.date_trunc("week", "o_orderdate").alias("block_start")).agg(
        F.max("o_orderkey").alias("seq"), F.count(F.lit(1)).alias("c")
    )
    end = F.col("block_start") + F.expr("INTERVAL 7 DAYS")
    recipe = F.when(F.col("c") % 11 == 0, "b").otherwise("a").alias("recipe_id")
    return weeks.where(F.col("c") % 5 != 0).select("seq", "block_start", end.alias("block_end"), recipe)


_MANIFEST = """m AS (SELECT max(o_orderkey) AS seq, date_trunc('week', o_orderdate) AS block_start,
        date_trunc('week', o_orderdate) + INTERVAL 7 DAY AS block_end, CASE WHEN count(*) % 11 = 0 THEN 'b' ELSE 'a' END AS recipe_id
        FROM orders GROUP BY date_trunc('week', o_orderdate) HAVING count(*) % 5 <> 0),
    p AS (SELECT CAST(k AS INT) AS block, TIMESTAMP '1995-01-02' + to_days(CAST(7 * k AS INT)) AS block_start,
        TIMESTAMP '1995-01-02' + to_days(CAST(7 * k + 7 AS INT)) AS block_end FROM (SELECT unnest(range(340)) AS k))"""
_PLANNED = ("1995-01-02", "2001-07-09", "7D")


@query(
    "L3_pending_blocks",
    sql=f"""WITH {_MANIFEST} SELECT block_start, block_end, block FROM p
        WHERE (block_start, block_end) NOT IN (SELECT (block_start, block_end) FROM m)""",
)
def pending_blocks(t: Tables) -> DataFrame:
    return blocks.pending_blocks(blocks.blocks(t.spark, *_PLANNED), _manifest(t))


@query(
    "L3_not_a_prefix",
    sql=f"""WITH {_MANIFEST}, f AS (SELECT min(block_start) AS first FROM p
            WHERE block_start NOT IN (SELECT block_start FROM m))
        SELECT 'not planned' AS problem, block_start FROM m WHERE block_start NOT IN (SELECT block_start FROM p)
        UNION ALL SELECT 'after a pending block', m.block_start FROM m, f WHERE m.block_start > first AND m.block_start IN (SELECT block_start FROM p)
        UNION ALL SELECT 'another recipe', block_start FROM m WHERE recipe_id <> 'a'""",
)
def not_a_prefix(t: Tables) -> DataFrame:
    return blocks.not_a_prefix(blocks.blocks(t.spark, *_PLANNED), _manifest(t), "a")


@query("L4_extension_start", sql=f"WITH {_MANIFEST} SELECT max_by(block_end, seq) AS start FROM m")
def extension_start(t: Tables) -> DataFrame:
    return blocks.extension_start(_manifest(t))


def _versions(t: Tables) -> DataFrame:
    """Orders as the versions of their customers' outputs."""
    return t.table("orders").select(
        F.col("o_custkey").alias("output"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderdate").cast("timestamp").alias("written_at"),
    )


@query(
    "L5_retention_versions",
    sql="""SELECT output, seq, written_at FROM (SELECT o_custkey AS output, o_orderkey AS seq, o_orderdate AS written_at,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r > 4""",
)
def retention_by_number(t: Tables) -> DataFrame:
    return blocks.expired_versions(_versions(t), keep_versions=4)


@query(
    "L5_retention_history",
    sql="""WITH v AS (SELECT o_custkey AS output, CAST(epoch(o_orderdate) AS BIGINT) * 1000000 + o_orderkey % 1000000 AS seq,
            o_orderdate AS written_at FROM orders),
        k AS (SELECT *, lead(written_at) OVER (PARTITION BY output ORDER BY seq) AS replaced FROM v)
        SELECT output, seq, written_at FROM k WHERE replaced < TIMESTAMP '2001-08-01' - INTERVAL 1000 DAY""",
)
def retention_by_age(t: Tables) -> DataFrame:
    """Versions in order of their dates, expired by how long ago they were replaced."""
    seq = F.unix_seconds("written_at") * 1_000_000 + F.col("seq") % 1_000_000
    versions = _versions(t).withColumn("seq", seq)
    return blocks.expired_versions(versions, now="2001-08-01", keep_history="1000D")


_SPAN_OF_HOURS = """s AS (SELECT date_trunc('day', min(time)) AS first, date_trunc('day', max(time)) + INTERVAL 1 DAY AS last FROM hourly),
        k AS (SELECT time, lat, lon, t2m, first + to_days(CAST(8 * (date_diff('day', first, time) // 8) AS INT)) AS block_start,
            last FROM hourly, s)"""


@query(
    "L6_static_once",
    "hourly",
    f"""WITH {_SPAN_OF_HOURS} SELECT block_start, lat, lon, CAST(count(t2m) AS BIGINT) AS n,
        CASE WHEN lon > 0.5 THEN 0.5 + 2 * (lon - 0.25) END AS deptho FROM k GROUP BY 1, 2, 3""",
)
def static_once(t: Tables) -> DataFrame:
    """Hourly values in blocks of eight days, each written apart with the same static field: its one stored table beside the counts
    of every block."""
    output, cube = _in_blocks(t, {})
    start = F.to_timestamp("block", "yyyyMMdd'T'HHmmss").alias("block_start")
    stored = t.spark.read.schema(_keyed(cube)).parquet(output.folder_of("data", "root", ("time", "lat", "lon")))
    counts = stored.select(start, "lat", "lon", "t2m").groupBy("block_start", "lat", "lon").agg(F.count("t2m").alias("n"))
    return counts.join(output.read().frame("lat", "lon"), ["lat", "lon"], "left")


@query(
    "L7_last_block_guard",
    "hourly",
    f"""WITH {_SPAN_OF_HOURS} SELECT block_start, least(block_start + INTERVAL 8 DAY, last) AS block_end, CAST(1 AS BIGINT) AS committed,
        CAST(count(*) AS BIGINT) AS n FROM k GROUP BY 1, 2""",
)
def last_block_guard(t: Tables) -> DataFrame:
    """Every block written and committed twice, as by a run that lost the answer to its commit: one commit each, one copy of
    the rows."""
    output, cube = _in_blocks(t, {"twice": True})
    start = F.to_timestamp("block", "yyyyMMdd'T'HHmmss").alias("block_start")
    stored = t.spark.read.schema(_keyed(cube)).parquet(output.folder_of("data", "root", ("time", "lat", "lon")))
    rows = stored.groupBy(start).agg(F.count(F.lit(1)).alias("n"))
    commits = output.manifest().where("kind = 'block'").groupBy("block_start", "block_end").agg(F.count(F.lit(1)).alias("committed"))
    return commits.join(rows, "block_start").select("block_start", "block_end", "committed", "n")


def _keyed(cube: Cube) -> T.StructType:
    fields = cube.frame("time", "lat", "lon").schema.fields
    return T.StructType([*fields, T.StructField("run", T.StringType()), T.StructField("block", T.StringType())])


def _in_blocks(t: Tables, options: dict[str, bool]) -> tuple[Output, Cube]:
    """All hours and a static field, written block by block in one run, from the first day of the table to the last."""
    hourly = t.hourly().without(["n"])
    seen = hourly.frame("time", "lat", "lon").agg(F.min("time").alias("first"), F.max("time").alias("last"))
    day = F.expr("make_dt_interval(1)")
    ends = seen.select(
        F.date_format(F.date_trunc("day", "first"), "yyyy-MM-dd HH:mm:ss").alias("start"),
        F.date_format(F.date_trunc("day", "last") + day, "yyyy-MM-dd HH:mm:ss").alias("end"),
    ).first()
    floor = F.when(F.col("lon") > 0.5, F.lit(0.5) + 2 * (F.col("lon") - 0.25)).alias("deptho")
    cells = hourly.frame("time", "lat", "lon").select("lat", "lon").distinct().select("lat", "lon", floor)
    cube = Cube.of({("time", "lat", "lon"): hourly.frame("time", "lat", "lon"), ("lat", "lon"): cells}, {"lat": t.lat, "lon": t.lon})
    output = Output(t.spark, workspace(t.spark, "blocks"))
    run = output.start()
    for interval in intervals_of(blocks.blocks(t.spark, ends["start"], ends["end"], "8D")):
        for _ in range(2 if options.get("twice") else 1):
            run.write(cube, *interval)
    run.publish()
    return output, cube
