"""Forecast runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators import forecast
from gridspark.operators.forecast import Forecast
from gridspark.plans.axes import axis_of
from gridspark.suite.tables import Tables, query

_THREE = Forecast("3D", "1D", missing_after="2D")
_START, _END = "2024-01-01", "2024-01-29"

_INITS = f"""i AS (SELECT unnest(generate_series(TIMESTAMP '{_START}', TIMESTAMP '{_END}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS init_time)"""
_AS_RUNS = f"""{_INITS}, r AS (SELECT init_time, CAST(epoch(time) - epoch(init_time) AS BIGINT) AS lead_time, time AS valid_time, lat, lon, t2m
        FROM hourly JOIN i ON time >= init_time AND time < init_time + INTERVAL 3 DAY)"""


def _series(t: Tables) -> DataFrame:
    return t.hourly(_START, "2024-01-31").without(["n"]).frame("time", "lat", "lon")


@query(
    "K1_runs",
    "hourly",
    f"""WITH {_INITS} SELECT init_time, init_time + INTERVAL 3 DAY AS run_end, CAST(count(t2m) AS BIGINT) AS n
        FROM i LEFT JOIN hourly ON time = init_time GROUP BY 1, 2""",
)
def runs(t: Tables) -> DataFrame:
    """The runs of an interval, with the number of cells the series has at each start."""
    inits = _THREE.runs(t.spark, _START, _END)
    cells = t.hourly(_START, _END).frame("time", "lat", "lon").groupBy("time").agg(F.count("t2m").alias("n"))
    joined = inits.join(cells, F.col("time") == F.col("init_time"), "left")
    return joined.select("init_time", "run_end", F.coalesce("n", F.lit(0)).alias("n"))


@query("K2_as_run", "hourly", f"WITH {_AS_RUNS} SELECT * FROM r")
def as_run(t: Tables) -> DataFrame:
    return forecast.as_runs(_series(t), _THREE, _START, _END)


@query(
    "K3_series_is_the_run",
    "hourly",
    f"""WITH {_INITS.replace(_END, '2024-02-05')} SELECT init_time,
        coalesce((SELECT max(time) FROM hourly WHERE time < TIMESTAMP '2024-01-31') < init_time + INTERVAL 3 DAY, false) AS real FROM i""",
)
def series_is_the_run(t: Tables) -> DataFrame:
    series = t.hourly(end="2024-01-31").frame("time", "lat", "lon")
    return forecast.series_is_the_run(series, _THREE.runs(t.spark, _START, "2024-02-05"), _THREE)


def _reports(t: Tables) -> DataFrame:
    """Event types as datasets of a run: real if it has enough of them that day, unavailable if few;
    the flag is shared by two types, and one type has none."""
    counts = t.table("events").groupBy(F.date_trunc("day", "ts").alias("init_time"), "event_type").agg(
        F.count(F.lit(1)).alias("c")
    )
    flag = F.when(F.col("event_type").isin("click", "view"), "web").when(F.col("event_type") == "purchase", "shop")
    return counts.select(
        "init_time",
        F.col("event_type").alias("dataset"),
        flag.alias("flag"),
        (F.col("c") % 5 != 0).alias("real"),
        (F.col("c") % 7 == 0).alias("unavailable"),
    )


@query(
    "K4_flags",
    sql="""WITH c AS (SELECT date_trunc('day', ts) AS init_time, event_type, count(*) AS c FROM events GROUP BY 1, 2),
        f AS (SELECT init_time, CASE WHEN event_type IN ('click', 'view') THEN 'web' WHEN event_type = 'purchase' THEN 'shop' END AS flag,
            c % 5 <> 0 AND c % 7 <> 0 AS ok FROM c)
        SELECT init_time, CAST(l AS BIGINT) AS lead_time, flag, bool_and(ok) AS value
        FROM f, (VALUES (0), (86400), (172800)) leads(l) WHERE flag IS NOT NULL GROUP BY 1, 2, 3""",
)
def flags(t: Tables) -> DataFrame:
    from pyspark.sql import types as T

    leads = axis_of(t.spark, "lead_time", [0, 86400, 172800], T.LongType())
    return forecast.run_flags(_reports(t), leads, _THREE)


@query(
    "K5_missing_dataset",
    "hourly",
    f"""WITH {_AS_RUNS}, s AS (SELECT * FROM r WHERE lead_time % 86400 = 0 AND day(init_time) % 4 <> 0),
        leads AS (SELECT DISTINCT lead_time FROM r WHERE lead_time % 86400 = 0),
        cells AS (SELECT -1.75 + 0.5 * a AS lat, 0.25 + 0.5 * b AS lon FROM (SELECT CAST(unnest(range(8)) AS DOUBLE) AS a),
            (SELECT CAST(unnest(range(8)) AS DOUBLE) AS b))
        SELECT * FROM s UNION ALL
        SELECT init_time, lead_time, init_time + to_seconds(lead_time), lat, lon, CAST(NULL AS DOUBLE) FROM i, leads, cells
        WHERE day(init_time) % 4 = 0""",
)
def missing_dataset(t: Tables) -> DataFrame:
    """A source without every fourth day's run, completed with missing values."""
    have = forecast.as_runs(_series(t), _THREE, _START, _END).where(F.col("lead_time") % 86400 == 0)
    from gridspark.plans.axes import axis_from

    leads = axis_from(have, "lead_time")
    source = have.where(F.dayofmonth("init_time") % 4 != 0)
    inits = _THREE.runs(t.spark, _START, _END)
    wanted = inits.where(F.dayofmonth("init_time") % 4 == 0).unionByName(inits.join(source, "init_time", "left_semi"))
    return forecast.with_stand_ins(source, wanted, leads, {"lat": t.lat, "lon": t.lon}, _THREE)


@query(
    "K6_same_valid_times",
    sql="""WITH d AS (SELECT DISTINCT date_trunc('day', ts) AS init_time, event_type AS dataset, date_trunc('hour', ts) AS time FROM events),
        s AS (SELECT init_time, dataset, count(*) AS n, max(time) AS last FROM d GROUP BY 1, 2),
        l AS (SELECT *, row_number() OVER (PARTITION BY init_time ORDER BY n DESC, last DESC, dataset DESC) AS r FROM s),
        m AS (SELECT init_time, dataset AS longest, n AS wanted, last AS longest_last FROM l WHERE r = 1),
        k AS (SELECT d.init_time, d.dataset, count(*) AS matched FROM d JOIN m USING (init_time)
            JOIN d b ON b.init_time = d.init_time AND b.dataset = m.longest AND b.time = d.time GROUP BY 1, 2)
        SELECT init_time, dataset, last, longest_last FROM s JOIN m USING (init_time) LEFT JOIN k USING (init_time, dataset)
        WHERE NOT (n = wanted AND coalesce(matched, 0) = wanted)""",
)
def same_valid_times(t: Tables) -> DataFrame:
    """Event types as the datasets of each day's run, their hours as valid times."""
    times = t.table("events").select(
        F.date_trunc("day", "ts").alias("init_time"),
        F.col("event_type").alias("dataset"),
        F.date_trunc("hour", "ts").alias("time"),
    )
    return forecast.different_valid_times(times)


@query(
    "K7_not_published_yet",
    "runs",
    """WITH i AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS init_time),
        s AS (SELECT init_time, max(step_h) >= 9 AS complete FROM runs WHERE step_h <= 3 * (day(init_time) % 8)
            AND init_time < TIMESTAMP '2024-01-29' GROUP BY 1)
        SELECT init_time, CASE WHEN init_time < TIMESTAMP '2024-01-06' AND init_time IN (SELECT init_time FROM runs) THEN 'stored' WHEN complete THEN 'ready'
            WHEN epoch(TIMESTAMP '2024-02-02') - epoch(init_time) < 2 * 86400 THEN 'waiting'
            WHEN complete IS NOT NULL THEN 'incomplete' ELSE 'missing' END AS state
        FROM i LEFT JOIN s USING (init_time)""",
)
def not_published_yet(t: Tables) -> DataFrame:
    table = t.runs().where(F.col("step_h") <= 3 * (F.dayofmonth("init_time") % 8))
    table = table.where(F.col("init_time") < F.lit("2024-01-29").cast("timestamp"))
    source = table.groupBy("init_time").agg((F.max("step_h") >= 9).alias("complete"))
    stored = t.runs().where(F.col("init_time") < F.lit("2024-01-06").cast("timestamp"))
    wanted = _THREE.runs(t.spark, "2024-01-01", "2024-02-06")
    return forecast.run_states(wanted, source, stored, _THREE, now="2024-02-02")


@query(
    "K8_rolling_window",
    "runs",
    "SELECT * FROM runs WHERE init_time IN (SELECT DISTINCT init_time FROM runs ORDER BY init_time DESC LIMIT 10)",
)
def rolling_window(t: Tables) -> DataFrame:
    return forecast.rolling_window(t.runs(), "init_time", 10)


@query(
    "K9_same_layout",
    "hourly",
    f"""WITH {_AS_RUNS}, a AS (SELECT DISTINCT lead_time FROM r WHERE lead_time < 200000), b AS (SELECT DISTINCT lead_time FROM r WHERE lead_time >= 7200)
        SELECT 'lead not in the run' AS problem, CAST(lead_time AS VARCHAR) AS name FROM a WHERE lead_time NOT IN (SELECT lead_time FROM b)
        UNION ALL SELECT 'lead not stored', CAST(lead_time AS VARCHAR) FROM b WHERE lead_time NOT IN (SELECT lead_time FROM a)
        UNION ALL SELECT 'variable not in the run', 't2m'""",
)
def same_layout(t: Tables) -> DataFrame:
    table = forecast.as_runs(_series(t), _THREE, _START, _END)
    stored = table.where(F.col("lead_time") < 200000)
    run = table.where(F.col("lead_time") >= 7200).withColumnRenamed("t2m", "other")
    return forecast.layout_differences(stored, run, _THREE)


@query(
    "K10_lead_statistics",
    "hourly",
    f"""WITH {_AS_RUNS}, e AS (SELECT lead_time, r.t2m * (1 + lead_time / 910800.0) - h.t2m AS e FROM r
            JOIN hourly h ON h.time = valid_time AND h.lat = r.lat AND h.lon = r.lon)
        SELECT lead_time, CAST(count(e) AS BIGINT) AS n, round(avg(e), 5) AS bias, round(avg(abs(e)), 5) AS mae,
            round(sqrt(avg(e * e)), 5) AS rmse FROM e GROUP BY 1""",
)
def lead_statistics(t: Tables) -> DataFrame:
    """A forecast that drifts with its lead, against the series."""
    table = forecast.as_runs(_series(t), _THREE, _START, _END)
    drifting = table.withColumn("t2m", F.col("t2m") * (1 + F.col("lead_time") / F.lit(910800.0)))
    out = forecast.lead_statistics(drifting, _series(t), ["lat", "lon"], "t2m", "t2m", _THREE)
    return out.withColumns({c: F.round(c, 5) for c in ("bias", "mae", "rmse")})
