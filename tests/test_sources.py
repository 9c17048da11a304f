import numpy as np
import pytest
from cubes import LAT, LON, array_of, cube_of, days
from pyspark.sql import functions as F

from gridspark.cube import Cube
from gridspark.functions import times
from gridspark.functions.bits import morton
from gridspark.functions.packing import Encoding
from gridspark.plans import axes, sizing
from gridspark.operators import select
from gridspark.sources import parts
from gridspark.sources.datasets import Part, merge_all, open_dataset
from gridspark.sources.layout import Layout, chunk_table


def test_nan_becomes_missing(spark):
    cube = cube_of(spark, ("lat",), np.array([np.nan, 1.0]), {"lat": [0, 1]}, "v")
    assert cube.frame("lat").where("v IS NULL").count() == 1
    assert cube.frame("lat").where("v > 0").count() == 1


def test_scan_renames_and_ignores_absent_drops(spark, tmp_path):
    spark.createDataFrame([(1, 2.0, 3.0)], "x int, a double, b double").write.parquet(f"{tmp_path}/part")
    cube = parts.scan_part(spark, f"{tmp_path}/part", ["x"], None, ["b", "absent"], {"x": "lat", "a": "v"})
    assert cube.dims_of("v") == ("lat",) and cube.variables == ["v"]
    with pytest.raises(ValueError, match="rename"):
        parts.scan_part(spark, f"{tmp_path}/part", ["x"], rename={"absent": "v"})


def test_intervals_are_right_open(ocean):
    out = parts.time_sel(ocean.with_axes("time"), "2020-02-27", "2020-02-29")
    assert [r["idx"] for r in out.axis("time").orderBy("idx").collect()] == [0, 1]
    assert array_of(out, "thetao").shape == (2, 3, 8, 8) and "deptho" in out.variables
    with pytest.raises(ValueError, match="UTC"):
        parts.time_sel(ocean, "2020-02-27T00:00:00+02:00", "2020-02-29")


def test_static_time_must_be_a_stamp(ocean):
    out = parts.static_time(ocean, "2020-02-29")
    assert out.dims_of("thetao") == ("depth", "lat", "lon")
    np.testing.assert_array_equal(array_of(out, "thetao"), array_of(ocean, "thetao")[3])
    with pytest.raises(ValueError, match="not a stamp"):
        parts.static_time(ocean, "2020-02-29T12:00:00")


def test_offset_filters_the_raw_stamps(ocean):
    out = parts.time_offset(ocean, "-1D", "2020-02-26", "2020-02-27")
    np.testing.assert_array_equal(array_of(out, "thetao")[0], array_of(ocean, "thetao")[1])
    with pytest.raises(ValueError, match="lacks"):
        parts.time_offset(ocean.without(["thetao"]), "1h")


def test_snapping_within_a_tolerance(spark, static):
    def shifted(by, lat=LAT):
        ldd = np.arange(float(lat.size * 8)).reshape(lat.size, 8)
        return cube_of(spark, ("lat", "lon"), ldd, {"lat": lat + by, "lon": LON}, "ldd")

    snapped = parts.snap_coordinates(shifted(4e-12), [static], 1e-9)
    both = parts.merge_parts([static, snapped])
    assert both.frame("lat", "lon").count() == 64
    np.testing.assert_array_equal(array_of(both, "ldd").ravel(), np.arange(64.0))
    with pytest.raises(ValueError, match="more than"):
        parts.snap_coordinates(shifted(1e-3), [static], 1e-9)
    with pytest.raises(ValueError, match="differs between"):
        parts.merge_parts([static, shifted(4e-12)])
    other = cube_of(spark, ("y",), np.zeros(3), {"y": [0, 1, 2]}, "v")
    with pytest.raises(ValueError, match="no coordinate"):
        parts.snap_coordinates(other, [static], 1e-9)


def test_merging_fills_gaps_and_refuses_conflicts(spark):
    ax = {"time": days(2), "lat": [0, 1]}

    def part(values):
        return cube_of(spark, ("time", "lat"), np.array(values), ax, "v")

    a, b = part([[1.0, np.nan], [3.0, 4.0]]), part([[1.0, 2.0], [np.nan, 4.0]])
    np.testing.assert_array_equal(array_of(parts.merge_datasets(a, b), "v"), [[1, 2], [3, 4]])
    wrong = part([[9.0, 2.0], [3.0, 4.0]])
    assert parts.conflicts(a.frame("time", "lat"), wrong.frame("time", "lat"), ["time", "lat"]).count() == 1
    with pytest.raises(Exception, match="conflicting values"):
        array_of(parts.merge_datasets(a, wrong), "v")
    with pytest.raises(ValueError, match="attributes differ"):
        parts.merge_datasets(Cube(a.frames, a.axes, {"title": "x"}), b)


def test_required_days(ocean):
    df = ocean.frame("time", "depth", "lat", "lon")
    assert parts.require_days(df, "2020-02-27", "2020-03-01").select("time").distinct().count() == 3
    with pytest.raises(ValueError, match="2 day"):
        parts.require_days(df, "2020-02-27", "2020-03-05")


def test_long_axes_are_ranked_without_one_task(spark, monkeypatch):
    labels = spark.range(1000).select((F.col("id") * F.col("id")).alias("x"), F.lit(1).alias("v"))
    small = {r["x"]: r["idx"] for r in axes.axis_from(labels, "x").collect()}
    monkeypatch.setattr(axes, "local_copy", lambda df: sizing.local_copy(df, 10))
    assert {r["x"]: r["idx"] for r in axes.axis_from(labels, "x").collect()} == small
    down = {r["x"]: r["idx"] for r in axes.axis_from(labels, "x", descending=True).collect()}
    assert down == {x: 999 - k for x, k in small.items()}


def test_only_counted_sides_are_broadcast(spark):
    df = spark.range(100)
    assert sizing.local_copy(df, 10) is df and sizing.broadcast_checked(df, 10) is df
    assert sizing.local_copy(df, 100) is not df


def test_packing_and_times(spark):
    encoding = Encoding("smallint", 0.01, 10.0, -32768)
    df = spark.createDataFrame([(12.34,), (None,)], "v double")
    row = df.select(encoding.pack(F.col("v")).alias("p"), encoding.as_stored(F.col("v")).alias("v")).collect()
    assert [r["p"] for r in row] == [234, -32768] and row[0]["v"] == pytest.approx(12.34) and row[1]["v"] is None
    stamps = spark.createDataFrame([("2020-01-02 06:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    hours = stamps.select(times.encode_time(F.col("t"), "hours since 2020-01-01").alias("h"))
    assert hours.first()["h"] == 30
    back = hours.select(times.decode_time(F.col("h"), "hours since 2020-01-01").alias("t")).first()["t"]
    assert str(back) == "2020-01-02 06:00:00"
    with pytest.raises(Exception, match="whole number"):
        stamps.select(times.encode_time(F.col("t"), "days since 2020-01-01")).collect()


def test_layout_sizes(spark, ocean):
    cube = ocean.with_axes("time")
    dims = ("time", "depth", "lat", "lon")
    layout = Layout({"time": 1, "depth": 1, "lat": 4}, {"time": 2, "depth": 3, "lat": 8}, "lexicographic")
    chunks, shards = layout.resolved(cube, dims)
    assert chunks == {"time": 1, "depth": 1, "lat": 4, "lon": 8} and shards["time"] == 2 and shards["lon"] == 8
    table = chunk_table(layout, cube, dims)
    assert table.count() == 6 * 3 * 2 and {r["rows"] for r in table.collect()} == {32}
    assert layout.laid_out(cube, dims).count() == 6 * 3 * 64
    for bad in ((0, None), (None, 2), ({"time": 2}, {"time": 3})):
        with pytest.raises(ValueError):
            Layout(*bad).resolved(cube, dims)
    with pytest.raises(ValueError, match="give shards"):
        Layout(1, None, "lexicographic")


def test_rows_lie_in_the_shard_order(spark, static):
    layout = Layout(1, -1, "colexicographic")
    table = layout.laid_out(static, ("lat", "lon")).coalesce(1)
    rows = [(r["lon"], r["lat"]) for r in table.collect()]
    assert rows == sorted(rows)


def test_morton_interleaves_bits(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x int, y int")
    rows = df.select("x", "y", morton([F.col("x"), F.col("y")]).alias("m")).collect()
    assert {(r["x"], r["y"]): r["m"] for r in rows}[(2, 3)] == 0b1101
    assert sorted(r["m"] for r in rows) == list(range(16))


def test_a_dataset_of_parts(spark, ocean, static, tmp_path):
    dims = ("time", "depth", "lat", "lon")
    ocean.frame(*dims).write.parquet(f"{tmp_path}/ocean")
    named = static.frame("lat", "lon").select((F.col("lat") + 1e-12).alias("y"), F.col("lon").alias("x"), "deptho")
    named.write.parquet(f"{tmp_path}/static")
    geopotential = ocean.frame(*dims).where("depth = 0.5").select("time", "lat", "lon", F.col("thetao").alias("z"))
    geopotential.write.parquet(f"{tmp_path}/z")
    members = [
        Part(f"{tmp_path}/ocean", dims),
        Part(f"{tmp_path}/static", ("y", "x"), rename={"y": "lat", "x": "lon"}, coordinate_tolerance=1e-9),
        Part(f"{tmp_path}/z", ("time", "lat", "lon"), time_offset="1D", static_time="2020-02-28"),
    ]
    steps = [{"name": "products", "heat": ["thetao", "deptho"]}]
    cube = open_dataset(spark, members, "2020-02-27", "2020-02-29", steps)
    assert set(cube.variables) == {"thetao", "deptho", "z", "heat"} and cube.dims_of("z") == ("lat", "lon")
    expected = array_of(ocean, "thetao")[1:3]
    np.testing.assert_array_equal(array_of(cube, "thetao"), expected)
    np.testing.assert_allclose(array_of(cube, "heat"), expected * array_of(static, "deptho"))
    np.testing.assert_array_equal(array_of(cube, "z"), array_of(ocean, "thetao")[1, 0])
    both = merge_all([select.select_variables(cube, ["thetao"]), select.select_variables(cube, ["z"])])
    assert set(both.variables) == {"thetao", "z"}
    chunked = select.chunk(cube, {"time": 1, "lat": -1})
    np.testing.assert_array_equal(array_of(chunked, "thetao"), expected)
