import numpy as np
import pytest
from cubes import LAT, array_of

from gridspark.operators import coverage, select
from gridspark.plans.steps import process


def test_select_drop_and_rename(ocean):
    assert select.select_variables(ocean, ["deptho"]).variables == ["deptho"]
    assert select.drop_vars(ocean, "deptho").variables == ["thetao"]
    assert select.drop_static_vars(ocean).variables == ["thetao"]
    out = select.rename(ocean, {"thetao": "t", "lat": "y"})
    assert out.dims_of("t") == ("time", "depth", "y", "lon")
    with pytest.raises(ValueError, match="neither"):
        select.rename(ocean, {"absent": "x"})
    with pytest.raises(ValueError, match="not variables"):
        select.drop_vars(ocean, ["absent"])


def test_rename_coordinates_numbers_them_and_keeps_the_labels(ocean):
    out = select.rename_coordinates(ocean, {"depth": "level", "absent": "x"}, {"level": "auto"})
    axis = out.axis("level").orderBy("idx").collect()
    assert [(r["level"], r["depth"]) for r in axis] == [(0, 0.5), (1, 2.0), (2, 5.0)]
    np.testing.assert_array_equal(array_of(out, "thetao"), array_of(ocean, "thetao"))
    given = select.rename_coordinates(ocean, {"depth": "level"}, {"level": [10.0, 20.0, 30.0]})
    assert {r[0] for r in given.frame_of("thetao").select("level").distinct().collect()} == {10.0, 20.0, 30.0}


def test_lists_keep_their_order(static):
    def order(cube):
        return [r["lat"] for r in cube.axis("lat").orderBy("idx").collect()]

    assert order(select.sel(static, lat=[0.75, -1.25, 0.25])) == [0.75, -1.25, 0.25]
    assert order(select.isel(static, lat=[3, 1])) == [LAT[3], LAT[1]]
    with pytest.raises(ValueError, match="twice"):
        select.isel(static, lat=[1, 1])


def test_open_slices_reach_the_scan(spark, tmp_path, static):
    static.frame("lat", "lon").write.parquet(f"{tmp_path}/s")
    stored = static.with_frame(("lat", "lon"), spark.read.parquet(f"{tmp_path}/s"))
    chosen = select.sel(select.flip(stored, "lat"), lat={"start": 1.0}).frame("lat", "lon")
    assert "LessThanOrEqual(lat,1.0)" in chosen._jdf.queryExecution().toString()
    assert chosen.select("lat").distinct().count() == 6


def test_sel_follows_the_direction_of_the_axis(static):
    down = select.flip(static, "lat")
    chosen = select.sel(down, lat={"start": 1.0, "stop": -1.0})
    assert [r["lat"] for r in chosen.axis("lat").orderBy("idx").collect()] == [0.75, 0.25, -0.25, -0.75]
    assert select.sel(down, lat={"start": -1.0, "stop": 1.0}).frame("lat", "lon").count() == 0
    stepped = select.sel(static, lat={"start": -1.75, "step": 3})
    assert [r["lat"] for r in stepped.axis("lat").orderBy("idx").collect()] == [-1.75, -0.25, 1.25]
    assert select.sel(static, lat=0.25).dims_of("deptho") == ("lon",)
    with pytest.raises(ValueError, match="labels"):
        select.sel(static, lat=[0.25, 0.3])


def test_isel_counts_from_either_end(static):
    out = select.isel(static, lat={"start": -3}, lon=-1)
    rows = sorted((r["lat"], r["deptho"]) for r in out.frame("lat").collect())
    assert rows == [(lat, 7.5) for lat in LAT[-3:]]
    with pytest.raises(ValueError, match="positions"):
        select.isel(static, lat=8)


def test_squeeze_and_transpose(ocean):
    one = select.isel(ocean, depth=[0])
    assert select.squeeze(one).dims_of("thetao") == ("time", "lat", "lon")
    with pytest.raises(ValueError, match="labels"):
        select.squeeze(ocean, "depth")
    assert select.transpose(ocean, ["lon", "lat"], "ignore").dims_of("deptho") == ("lon", "lat")


def test_astype_follows_the_casting_rules(ocean):
    out = select.astype(ocean, "float32", "same_kind")
    assert dict(out.frame_of("thetao").dtypes)["thetao"] == "float"
    assert select.castable("int64", "float64", "safe") and not select.castable("int64", "float32", "safe")
    assert not select.castable("float64", "int32", "same_kind")
    for bad in ({"dtype": "float32", "thetao": {"dtype": "float32"}}, {"casting": "safe"}, {"absent": {"dtype": "int8"}}):
        with pytest.raises(ValueError):
            select.astype(ocean, **bad)


def test_noleap_drops_feb_29(ocean):
    out = select.convert_calendar(ocean, "noleap")
    assert out.frame_of("thetao").select("time").distinct().count() == 5
    with pytest.raises(ValueError):
        select.convert_calendar(ocean, "360_day")


def test_attributes_are_replaced_and_dropped(ocean):
    out = select.assign_var_attrs(ocean, thetao={"units": "degC"})
    assert select.with_column_metadata(out).frame_of("thetao").schema["thetao"].metadata == {"units": "degC"}
    assert "thetao" not in select.drop_var_attrs(out, ["thetao"]).var_attrs
    assert select.drop_attrs(select.assign_attrs(out, title="x")).attrs == {}
    assert ocean.var_attrs == {}


def test_coverage_of_a_regular_cube(ocean):
    found = coverage.coverage_attrs(select.assign_var_attrs(ocean, depth={"positive": "down"}), vertical_dim="depth").attrs
    assert found["geospatial_lat_min"] == -1.75 and found["geospatial_lon_resolution"] == "0.5 degree"
    assert found["time_coverage_resolution"] == "P1D" and found["geospatial_vertical_max"] == 5.0
    assert found["time_coverage_end"] == "2020-03-02T00:00:00Z" and found["geospatial_vertical_positive"] == "down"
    assert "time_coverage_start" not in coverage.coverage_attrs(ocean, time_dim=False).attrs


def test_steps_are_checked_before_any_is_applied(ocean):
    with pytest.raises(ValueError, match="step 2"):
        process(ocean, [{"name": "flip", "dim": "lat"}, {"name": "absent"}])
    with pytest.raises(ValueError, match="step 1"):
        process(ocean, [{"name": "flip", "wrong": 1}])
    out = process(ocean, [{"name": "select_variables", "variables": ["thetao"]}, {"name": "rescale", "thetao": 2.0}])
    np.testing.assert_allclose(array_of(out, "thetao"), 2 * array_of(ocean, "thetao"))
    assert set(ocean.variables) == {"thetao", "deptho"}
