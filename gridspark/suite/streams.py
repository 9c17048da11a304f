"""Arriving data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.cube import Cube
from gridspark.session import workspace
from gridspark.sources.store import Output
from gridspark.streaming.bins import stream_resample
from gridspark.streaming.extend import stream_extend
from gridspark.suite.tables import Tables, query, rounded


def _stream(t: Tables) -> DataFrame:
    schema = t.table("events").schema
    source = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    return source.withColumn("time", F.col("ts").cast("timestamp"))


@query(
    "M1_stream_extend",
    "hourly",
    """SELECT date_trunc('day', time) AS time, lat, lon, CAST(sum(n) AS BIGINT) AS n FROM hourly
        WHERE time < TIMESTAMP '2024-01-01' + to_days(CAST(4 * (date_diff('day', TIMESTAMP '2024-01-01',
            (SELECT date_trunc('second', max(ts)) FROM events)) // 4) AS INT)) GROUP BY 1, 2, 3""",
)
def extend(t: Tables) -> DataFrame:
    """Blocks of four days published from the stream of events, as daily counts."""
    output = Output(t.spark, workspace(t.spark, "stream-extend"))

    def cube_of(events: DataFrame) -> Cube:
        cube = Cube.of({("time", "lat", "lon"): t.hourly_frame(events)}, {"lat": t.lat, "lon": t.lon})
        return cube.without(["t2m"])

    steps = [{"name": "resample", "time": "1D", "reduce": "sum", "dense": False}]
    stream_extend(_stream(t), output, cube_of, "2024-01-01 00:00:00", "4D", steps).awaitTermination()
    return output.read().frame("time", "lat", "lon")


@query(
    "M1_late_rows",
    "hourly",
    """SELECT date_trunc('day', time) AS time, lat, lon, CAST(sum(n) AS BIGINT) AS n FROM hourly
        WHERE date_trunc('day', time) < (SELECT date_trunc('day', max(ts)) FROM events) GROUP BY 1, 2, 3""",
)
def late_rows(t: Tables) -> DataFrame:
    """Daily counts published from events that come out of order: two thirds, then one half of the rest, late rows only, then
    the other half; and all files once more, as a rerun."""
    output, folder = Output(t.spark, workspace(t.spark, "late")), workspace(t.spark, "arriving")
    events = t.table("events")
    third = F.pmod(F.xxhash64("event_id"), F.lit(6))

    def cube_of(rows: DataFrame) -> Cube:
        cube = Cube.of({("time", "lat", "lon"): t.hourly_frame(rows)}, {"lat": t.lat, "lon": t.lon})
        return cube.without(["t2m"])

    def take(checkpoint: str) -> None:
        source = t.spark.readStream.schema(events.schema).parquet(folder).withColumn("time", F.col("ts").cast("timestamp"))
        stream_extend(source, output, cube_of, start, "1D", steps, checkpoint=f"{output.path}/{checkpoint}").awaitTermination()

    start = events.agg(F.date_format(F.date_trunc("day", F.min("ts")), "yyyy-MM-dd HH:mm:ss")).first()[0]
    steps = [{"name": "resample", "time": "1D", "reduce": "sum", "dense": False}]
    for part in (third < 4, third == 4, third == 5):
        events.where(part).write.mode("append").parquet(folder)
        take("stream")
    take("rerun")
    return output.read().frame("time", "lat", "lon")


@query(
    "M2_stream_resample",
    sql="""SELECT date_trunc('day', ts) AS time, event_type, CAST(count(*) AS BIGINT) AS n, round(avg(value), 9) AS mean
        FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY GROUP BY 1, 2""",
)
def resample(t: Tables) -> DataFrame:
    """Daily means of the bins a watermark of two days has closed."""
    path = workspace(t.spark, "stream-bins")
    stream = _stream(t).withColumn("one", F.col("value"))
    bins = stream_resample(stream, {"value": "mean"}, ["event_type"], "mean", "1 day", "2 days")
    counts = stream_resample(stream, {"one": "n"}, ["event_type"], "count", "1 day", "2 days")
    for name, table in (("mean", bins), ("n", counts)):
        sink = table.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        sink.option("checkpointLocation", f"{path}/state-{name}").start(f"{path}/{name}").awaitTermination()
    means = t.spark.read.parquet(f"{path}/mean")
    both = means.join(t.spark.read.parquet(f"{path}/n"), ["time", "event_type"])
    return rounded(both.select("time", "event_type", "n", "mean"), "mean", digits=9)
