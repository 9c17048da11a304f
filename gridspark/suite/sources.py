"""Reading, aligning and merging; runs of forecasts; stored layouts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.cube import Cube
from gridspark.functions.bits import morton
from gridspark.functions.packing import Encoding, TimeEncoding
from gridspark.functions.times import encode_time
from gridspark.operators import climatology, resample
from gridspark.operators.blocks import blocks
from gridspark.session import workspace
from gridspark.sources import parts, runs
from gridspark.sources.layout import Layout, chunk_table
from gridspark.sources.store import Output, checkpointed, intervals_of, write_groups
from gridspark.suite.tables import Tables, query, rounded


@query(
    "A1_scan_part",
    sql="""SELECT l_orderkey AS order_key, l_linenumber AS line, l_quantity AS quantity, l_shipdate AS shipped
        FROM lineitem""",
)
def scan_part(t: Tables) -> DataFrame:
    names = {"l_orderkey": "order_key", "l_linenumber": "line", "l_quantity": "quantity", "l_shipdate": "shipped"}
    dims = ("l_orderkey", "l_linenumber")
    part = parts.scan_part(
        t.spark, t.path("lineitem"), dims, ["l_quantity", "l_shipdate", "l_tax"], ["l_tax", "l_absent"], names
    )
    return part.frame("order_key", "line")


@query(
    "A2_time_sel",
    "hourly",
    "SELECT * FROM hourly WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-12'",
)
def time_sel(t: Tables) -> DataFrame:
    cube = t.hourly("2024-01-05", "2024-01-12")
    return parts.time_sel(cube, "2024-01-05", "2024-01-12").frame("time", "lat", "lon")


@query(
    "A3_time_offset",
    "hourly",
    """SELECT date_trunc('day', time - INTERVAL 1 HOUR) AS time, lat, lon,
        CAST(sum(CAST(t2m AS DECIMAL(18,2))) AS DOUBLE) AS t2m
        FROM hourly WHERE time >= TIMESTAMP '2024-01-05 01:00:00' AND time < TIMESTAMP '2024-01-08 01:00:00'
        GROUP BY 1, 2, 3""",
)
def time_offset(t: Tables) -> DataFrame:
    """Hours stamped at their end: a day's own 24 hours."""
    cube = t.hourly("2024-01-05 01:00:00", "2024-01-08 01:00:00")
    moved = parts.time_offset(cube, "-1h", "2024-01-05", "2024-01-08")
    moved = moved.assign(("time", "lat", "lon"), t2m=F.col("t2m").cast("decimal(18,2)")).without(["n"])
    days = resample.resample(moved, "sum", time="1D", dense=False).frame("time", "lat", "lon")
    return days.withColumn("t2m", F.col("t2m").cast("double"))


@query(
    "A4_static_time",
    "hourly",
    "SELECT lat, lon, t2m, n FROM hourly WHERE time = TIMESTAMP '2024-01-10 12:00:00'",
)
def static_time(t: Tables) -> DataFrame:
    cube = t.hourly("2024-01-10 12:00:00", "2024-01-10 13:00:00")
    return parts.static_time(cube, "2024-01-10 12:00:00").frame("lat", "lon")


def _shifted(t: Tables) -> Cube:
    """The static field as another publisher gives it: labels off by 4e-12."""
    by = F.lit(4e-12)
    frame = t.stock().frame("lat", "lon").select((F.col("lat") + by).alias("lat"), (F.col("lon") - by).alias("lon"), "size")
    lat = t.lat.withColumn("lat", F.col("lat") + by)
    lon = t.lon.withColumn("lon", F.col("lon") - by)
    return Cube.of({("lat", "lon"): frame}, {"lat": lat, "lon": lon})


@query(
    "A5_snap_coordinates",
    "static stock",
    "SELECT static.lat, static.lon, deptho, size FROM static JOIN stock USING (lat, lon)",
)
def snap_coordinates(t: Tables) -> DataFrame:
    first = t.static()
    snapped = parts.snap_coordinates(_shifted(t), [first], 1e-9)
    return parts.merge_parts([first, snapped]).frame("lat", "lon")


@query("A6_merge_parts", "hourly", "SELECT time, lat, lon, t2m, n FROM hourly")
def merge_parts(t: Tables) -> DataFrame:
    cube = t.hourly().with_axes("time")
    return parts.merge_parts([cube.without(["n"]), cube.without(["t2m"])]).frame("time", "lat", "lon")


@query("A7_merge_datasets", "hourly", "SELECT time, lat, lon, t2m FROM hourly")
def merge_datasets(t: Tables) -> DataFrame:
    """Two datasets, each with gaps the other fills, agreeing where they overlap."""
    cube = t.hourly().with_axes("time").without(["n"])
    dims = ("time", "lat", "lon")
    early = F.when(F.dayofmonth("time") < 20, F.col("t2m"))
    late = F.when(F.dayofmonth("time") >= 10, F.col("t2m"))
    return parts.merge_datasets(cube.assign(dims, t2m=early), cube.assign(dims, t2m=late)).frame(*dims)


@query(
    "A8_require_days",
    sql="""SELECT d AS day
        FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS d) w
        WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
)
def require_days(t: Tables) -> DataFrame:
    orders = t.table("orders").select(F.col("o_orderdate").alias("time"))
    days = parts.missing_days(orders, "1995-01-01", "2002-01-01")
    return days.select(F.col("day").cast("timestamp").alias("day"))


@query(
    "A8_required_rows",
    sql="""WITH e AS (SELECT date_trunc('day', ts) AS day FROM events),
        lost AS (SELECT count(*) AS n, min(d) AS a, max(d) AS z
            FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS d)
            WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders))
        SELECT day, CAST(count(*) AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS refused FROM e
            WHERE day > (SELECT min(day) FROM e) GROUP BY day
        UNION ALL SELECT NULL, NULL, 'no data for ' || n || ' day(s), from ' || CAST(a AS DATE) || ' to ' || CAST(z AS DATE) || ': not published yet?'
            FROM lost WHERE n > 0""",
)
def required_rows(t: Tables) -> DataFrame:
    """The rows kept of a source that has all wanted days, and what is said of one that lacks some."""
    events = t.table("events").withColumn("time", F.col("ts").cast("timestamp"))
    day = F.to_date("time")
    ends = events.agg(F.date_add(F.min(day), 1).alias("start"), F.date_add(F.max(day), 1).alias("end")).first()
    kept = parts.require_days(events, ends["start"].isoformat(), ends["end"].isoformat())
    counts = kept.groupBy(F.date_trunc("day", "time").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    try:
        parts.require_days(t.table("orders").select(F.col("o_orderdate").alias("time")), "1995-01-01", "2002-01-01")
        said = []
    except ValueError as refused:
        said = [(str(refused),)]
    return counts.unionByName(t.spark.createDataFrame(said, "refused string"), allowMissingColumns=True)


@query(
    "A9_steps_as_valid_time",
    "runs",
    "SELECT init_time, init_time + to_hours(step_h) AS time, cell, tp FROM runs",
)
def steps_as_valid_time(t: Tables) -> DataFrame:
    return runs.steps_as_valid_time(t.runs(), keep_init=True)


@query("A10_run_window", "runs", "SELECT * FROM runs WHERE step_h BETWEEN 3 AND 18")
def run_window(t: Tables) -> DataFrame:
    return runs.run_window(t.runs(), 3, 18)


def _ragged(t: Tables) -> DataFrame:
    """Runs cut short: the run of day d ends at step 3 (d mod 8)."""
    return t.runs().where(F.col("step_h") <= 3 * (F.dayofmonth("init_time") % 8))


@query(
    "A10_run_status",
    "runs",
    """SELECT init_time, max(step_h) AS last_step,
        CASE WHEN max(step_h) < 12 THEN 'incomplete' WHEN NOT bool_or(step_h = 12) THEN 'no step at the end'
            ELSE 'complete' END AS status
        FROM runs WHERE step_h <= 3 * (dayofmonth(init_time) % 8) GROUP BY 1""",
)
def run_status(t: Tables) -> DataFrame:
    return runs.run_status(_ragged(t), 0, 12)


@query(
    "A11_step_gaps",
    "runs",
    """WITH s AS (SELECT DISTINCT init_time, step_h FROM runs WHERE (dayofmonth(init_time) + step_h // 3) % 7 <> 0),
        g AS (SELECT init_time, step_h AS from_h, lead(step_h) OVER w AS to_h,
            lead(step_h) OVER w - step_h AS gap FROM s WINDOW w AS (PARTITION BY init_time ORDER BY step_h)),
        k AS (SELECT *, lag(gap) OVER w AS before, lead(gap) OVER w AS after FROM g WHERE to_h IS NOT NULL
            WINDOW w AS (PARTITION BY init_time ORDER BY from_h))
        SELECT init_time, from_h, to_h FROM k WHERE gap > after OR (after IS NULL AND gap > before)""",
)
def step_gaps(t: Tables) -> DataFrame:
    lost = (F.dayofmonth("init_time") + F.floor(F.col("step_h") / 3)) % 7 == 0
    return runs.step_gaps(t.runs().where(~lost))


@query(
    "A12_deaccumulate",
    "runs",
    """SELECT init_time, step_h, cell, round(lead(tp) OVER (PARTITION BY init_time, cell ORDER BY step_h) - tp, 2) AS tp
        FROM runs""",
)
def deaccumulate(t: Tables) -> DataFrame:
    return rounded(runs.deaccumulate(t.runs(), ["tp"], ["cell"]), "tp", digits=2)


@query(
    "A13_lead_hours",
    "runs",
    """SELECT init_time, CAST(k * 24 AS INT) AS lead_h
        FROM (SELECT DISTINCT init_time FROM runs) r, (SELECT unnest(range(1, 60)) AS k) n
        WHERE init_time + to_hours(k * 24) >= TIMESTAMP '2024-01-12'
            AND init_time + to_hours(k * 24) < TIMESTAMP '2024-01-20'""",
)
def lead_hours(t: Tables) -> DataFrame:
    inits = t.table("events").select(F.date_trunc("day", "ts").alias("init_time"))
    return runs.lead_hours(inits, "2024-01-12", "2024-01-20")


@query("A14_read_version", "hourly", "SELECT time, lat, lon, t2m FROM hourly")
def read_version(t: Tables) -> DataFrame:
    """A version that a later one replaced."""
    output = Output(t.spark, workspace(t.spark, "read-version"))
    cube = t.hourly().without(["n"])
    first = output.start(mode="new")
    first.write(cube)
    first.publish()
    later = output.start(mode="replace")
    later.write(replace(cube, frames={d: f.where(F.hour("time") == 0) for d, f in cube.frames.items()}))
    later.publish()
    return output.read(version=1).frame("time", "lat", "lon")


@query(
    "B1_write_block",
    "hourly",
    """SELECT date_trunc('day', time) AS time, lat, lon, CAST(sum(n) AS BIGINT) AS n FROM hourly
        WHERE time >= TIMESTAMP '2024-01-01' AND time < TIMESTAMP '2024-01-31' GROUP BY 1, 2, 3""",
)
def write_block(t: Tables) -> DataFrame:
    """Blocks of eight days, one of them written twice, then an extension."""
    output = Output(t.spark, workspace(t.spark, "write-block"))
    days = resample.resample(t.hourly().without(["t2m"]), "sum", time="1D", dense=False)
    planned = intervals_of(blocks(t.spark, "2024-01-01", "2024-01-17", "8D"))
    run = output.start(mode="new")
    run.write_blocks(days, planned)
    run.write_blocks(days, planned[1:])
    run.publish()
    more = output.start(mode="extend")
    more.write_blocks(days, intervals_of(blocks(t.spark, "2024-01-17", "2024-01-31", "8D")))
    more.publish()
    return output.read().frame("time", "lat", "lon")


_LAYOUT = Layout({"time": 24, "lat": 4, "lon": 2}, {"time": 48, "lat": 8, "lon": 4}, "lexicographic")


@query(
    "B2_chunk_layout",
    "hourly",
    """WITH axis AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS k FROM (SELECT DISTINCT time FROM hourly) a),
        h AS (SELECT k, CAST((lat + 1.75) / 0.5 AS INT) AS i, CAST((lon - 0.25) / 0.5 AS INT) AS j
            FROM hourly JOIN axis USING (time))
        SELECT CAST(k // 24 AS INT) AS chunk_time, CAST(i // 4 AS INT) AS chunk_lat, CAST(j // 2 AS INT) AS chunk_lon,
            CAST(k // 48 AS INT) AS shard_time, CAST(i // 8 AS INT) AS shard_lat, CAST(j // 4 AS INT) AS shard_lon,
            CAST(count(*) AS BIGINT) AS rows FROM h GROUP BY 1, 2, 3, 4, 5, 6""",
)
def chunk_layout(t: Tables) -> DataFrame:
    return chunk_table(_LAYOUT, t.hourly().with_axes("time"), ("time", "lat", "lon"))


@query(
    "B3_shard_order",
    "hourly",
    "WITH axis AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS k FROM (SELECT DISTINCT time FROM hourly) a),"
    " h AS (SELECT DISTINCT CAST(k // 24 AS BIGINT) AS a, CAST((lat + 1.75) / 0.5 AS BIGINT) // 4 AS b,"
    " CAST((lon - 0.25) / 0.5 AS BIGINT) // 2 AS c FROM hourly JOIN axis USING (time))"
    " SELECT CAST(a AS INT) AS chunk_time, CAST(b AS INT) AS chunk_lat, CAST(c AS INT) AS chunk_lon, CAST("
    + " + ".join(
        f"((({v} >> {bit}) & 1) << {3 * bit + place})"
        for bit in range(8)
        for place, v in enumerate(("c", "b", "a"))
    )
    + " AS BIGINT) AS position FROM h",
)
def shard_order(t: Tables) -> DataFrame:
    """The place of each chunk along the interleaved-bits curve."""
    cube = t.hourly().with_axes("time")
    names = ["chunk_time", "chunk_lat", "chunk_lon"]
    chunks = chunk_table(_LAYOUT, cube, ("time", "lat", "lon")).select(*names).distinct()
    return chunks.select(*names, morton([F.col(n) for n in names], bits=8).alias("position"))


@query(
    "B4_pack_unpack",
    "ocean",
    """WITH p AS (SELECT time, depth, lat, lon, thetao,
            coalesce(CAST(round_even((thetao - 25.0) / 0.08, 0) AS SMALLINT), -32768) AS packed FROM ocean)
        SELECT time, depth, lat, lon, packed,
            round(CASE WHEN packed <> -32768 THEN packed * 0.08 + 25.0 END, 6) AS thetao FROM p""",
)
def pack_unpack(t: Tables) -> DataFrame:
    encoding = Encoding("smallint", 0.08, 25.0, -32768)
    packed = t.ocean().frame("time", "depth", "lat", "lon").withColumn("packed", encoding.pack(F.col("thetao")))
    return rounded(packed.withColumn("thetao", encoding.unpack(F.col("packed"))), "thetao")


@query(
    "B5_encode_time",
    "daily",
    """SELECT CAST(date_diff('day', TIMESTAMP '1995-01-01', time) AS BIGINT) AS days,
        CAST(date_diff('hour', TIMESTAMP '1994-12-31 12:00:00', time) AS BIGINT) AS hours, cell, x FROM daily""",
)
def encode_times(t: Tables) -> DataFrame:
    days = encode_time(F.col("time"), "days since 1995-01-01").alias("days")
    hours = encode_time(F.col("time"), "hours since 1994-12-31 12:00:00").alias("hours")
    return t.daily().frame("time", "cell").select(days, hours, "cell", "x")


@query(
    "B4_packed_output",
    "ocean",
    """WITH p AS (SELECT time, depth, lat, lon, thetao,
            coalesce(CAST(round_even((thetao - 25.0) / 0.08, 0) AS SMALLINT), -32768) AS packed FROM ocean)
        SELECT time, depth, lat, lon, packed,
            round(CASE WHEN packed <> -32768 THEN packed * 0.08 + 25.0 END, 6) AS thetao FROM p""",
)
def packed_output(t: Tables) -> DataFrame:
    """A packed variable as an output's files hold it, beside what reading the output gives."""
    output, dims = Output(t.spark, workspace(t.spark, "packed")), ("time", "depth", "lat", "lon")
    run = output.start(encodings={"thetao": Encoding("smallint", 0.08, 25.0, -32768)})
    run.write(t.ocean())
    run.publish()
    stored = t.spark.read.parquet(output.folder_of("data", "root", dims)).select(*dims, F.col("thetao").alias("packed"))
    return stored.join(rounded(output.read().frame(*dims), "thetao"), list(dims))


@query(
    "B5_encoded_output",
    "daily",
    """SELECT CAST(date_diff('hour', TIMESTAMP '1994-12-31 12:00:00', time) AS BIGINT) AS hours, time, cell, x FROM daily""",
)
def encoded_output(t: Tables) -> DataFrame:
    """Stamps as an output's files hold them, beside what reading the output gives."""
    output = Output(t.spark, workspace(t.spark, "encoded"))
    units = "hours since 1994-12-31 12:00:00"
    run = output.start(encodings={"time": TimeEncoding(units)})
    run.write(t.daily())
    run.publish()
    stored = t.spark.read.parquet(output.folder_of("data", "root", ("time", "cell")))
    back = output.read().frame("time", "cell").withColumn("hours", encode_time(F.col("time"), units))
    return back.join(stored.select(F.col("time").alias("hours"), "cell"), ["hours", "cell"])


@query(
    "B6_write_groups",
    "daily",
    """WITH b AS (SELECT cell, dayofyear(time) - 1 - CASE WHEN dayofyear(time) > 59
                AND year(time) % 4 = 0 AND month(time) > 2 THEN 1
                WHEN month(time) = 2 AND day(time) = 29 THEN 1 ELSE 0 END AS bin, x FROM daily),
        m AS (SELECT cell, CAST(bin AS INT) AS bin, avg(x) AS c, var_samp(x) AS v, count(*) AS n FROM b GROUP BY 1, 2),
        every AS (SELECT CAST(b AS INT) AS bin, CAST(c AS INT) AS cell
            FROM (SELECT unnest(range(365)) AS b) CROSS JOIN (SELECT unnest(range(16)) AS c))
        SELECT 'climatology' AS name, bin, cell, round(c, 4) AS x FROM every LEFT JOIN m USING (bin, cell)
        UNION ALL SELECT 'anomaly_std', bin, cell, round(sqrt(CASE WHEN n > 1 THEN v END), 4) FROM every LEFT JOIN m USING (bin, cell)""",
)
def write_two_groups(t: Tables) -> DataFrame:
    """Both groups of a climatology (window of one bin), published as one version and read back."""
    groups = climatology.compute_climatology(t.daily(), 365, bins="day_of_year")
    output = Output(t.spark, workspace(t.spark, "write-groups"))
    write_groups(output, groups)

    def rows(name: str) -> DataFrame:
        frame = output.read(group=name).frame("time", "cell")
        return frame.select(F.lit(name).alias("name"), F.col("time").alias("bin"), "cell", F.round("x", 4).alias("x"))

    return rows("climatology").unionByName(rows("anomaly_std"))


@query(
    "B7_checkpoint",
    "ocean",
    "SELECT time, lat, lon, CAST(count(thetao) AS BIGINT) AS levels FROM ocean GROUP BY 1, 2, 3",
)
def checkpoint(t: Tables) -> DataFrame:
    stored = checkpointed(t.ocean(), workspace(t.spark, "checkpoint"))
    return stored.frame("time", "depth", "lat", "lon").groupBy("time", "lat", "lon").agg(F.count("thetao").alias("levels"))
