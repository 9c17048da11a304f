import datetime

import numpy as np
from cubes import array_of, cube_of, days
from pyspark.sql import functions as F

from gridspark.cube import Cube
from gridspark.operators.resample import resample
from gridspark.sources.store import Output
from gridspark.streaming.bins import stream_resample
from gridspark.streaming.extend import stream_extend

HOUR = datetime.timedelta(hours=1)


def arriving(spark, tmp_path, first, last):
    """Hours of a series, written as one more file."""
    values = np.arange(float(first), float(last))
    stamps = days(last - first, datetime.datetime(2020, 1, 1) + first * HOUR, HOUR)
    frame = cube_of(spark, ("time",), values, {"time": stamps}, "v").frame("time")
    frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return frame.schema


def test_an_output_is_extended_with_what_arrives(spark, tmp_path):
    output = Output(spark, f"{tmp_path}/out")
    steps = [{"name": "resample", "time": "1D", "reduce": "sum", "dense": False}]

    def take():
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        stream_extend(source, output, lambda df: Cube.of({("time",): df}), "2020-01-01 00:00:00", "1D", steps).awaitTermination()

    schema = arriving(spark, tmp_path, 0, 30)
    take()
    assert array_of(output.read(), "v").tolist() == [sum(range(24))]
    arriving(spark, tmp_path, 30, 80)
    take()
    take()
    assert array_of(output.read(), "v").tolist() == [sum(range(24 * d, 24 * d + 24)) for d in range(3)]
    assert output.current() == 2


def test_late_rows_open_their_block_again(spark, tmp_path):
    output = Output(spark, f"{tmp_path}/out")
    steps = [{"name": "resample", "time": "1D", "reduce": "sum", "dense": False}]

    def take():
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        stream_extend(source, output, lambda df: Cube.of({("time",): df}), "2020-01-01 00:00:00", "1D", steps).awaitTermination()

    schema = arriving(spark, tmp_path, 0, 20)
    arriving(spark, tmp_path, 24, 50)
    take()
    assert array_of(output.read(), "v").tolist() == [sum(range(20)), sum(range(24, 48))]
    arriving(spark, tmp_path, 20, 24)
    arriving(spark, tmp_path, 50, 75)
    take()
    assert array_of(output.read(), "v").tolist() == [sum(range(24 * d, 24 * d + 24)) for d in range(3)]
    assert array_of(output.read(1), "v").tolist() == [sum(range(20)), sum(range(24, 48))]


def test_late_rows_count_in_whatever_batch_they_come(spark, tmp_path):
    """Alone in a batch, in the newest block of a batch, and for a block that had none; then a batch runs again."""
    output = Output(spark, f"{tmp_path}/out")
    steps = [{"name": "resample", "time": "1D", "reduce": "sum", "dense": False}]
    hours = set()

    def take(*parts, checkpoint=None):
        for first, last in parts:
            arriving(spark, tmp_path, first, last)
            hours.update(range(first, last))
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        cube = lambda df: Cube.of({("time",): df})
        stream_extend(source, output, cube, "2020-01-01 00:00:00", "1D", steps, checkpoint=checkpoint).awaitTermination()
        rows = {r["time"].day - 1: r["v"] for r in output.read().frame("time").collect()}
        whole = max(hours) // 24
        assert rows == {d: sum(h for h in hours if h // 24 == d) for d in range(whole) if any(h // 24 == d for h in hours)}

    schema = arriving(spark, tmp_path, 0, 30)
    hours.update(range(30))
    take((36, 60), (96, 121))  # day 3 has no rows
    before = output.current()
    take((30, 33))
    assert output.current() == before + 1
    take((33, 36), (60, 61), (74, 75))
    take((61, 62))
    before = output.current()
    take()
    assert output.current() == before
    take(checkpoint=f"{tmp_path}/again")  # all files once more, as batch 0


def test_streamed_bins_are_those_of_the_batch(spark, tmp_path):
    schema = arriving(spark, tmp_path, 0, 100)
    source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in").withColumn("cell", F.lit(1))
    bins = stream_resample(source, ["v"], ["cell"], "mean", "1 day", "1 hour")
    sink = bins.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    sink.option("checkpointLocation", f"{tmp_path}/state").start(f"{tmp_path}/bins").awaitTermination()
    found = [r["v"] for r in spark.read.parquet(f"{tmp_path}/bins").orderBy("time").collect()]
    batch = resample(Cube.of({("time",): spark.read.parquet(f"{tmp_path}/in")}), "mean", time="1D")
    assert found == array_of(batch, "v").tolist()[: len(found)] and len(found) == 4
