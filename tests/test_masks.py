import numpy as np
import pytest
from cubes import LAT, LON, array_of, cube_of, merged
from pyspark.sql import functions as F

from gridspark.operators import arith, masks, vertical

DEPTHO = np.tile([np.nan, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5], (8, 1))


@pytest.mark.parametrize("threshold", [0.0, 0.5, 1.0])
def test_sea_mask(ocean, threshold):
    top, bottom = np.array([0.0, 1.0, 3.0]), np.array([1.0, 3.0, 7.0])
    limit = threshold * top + (1 - threshold) * bottom
    expected = np.nan_to_num(DEPTHO, nan=-1.0)[None] > limit[:, None, None]
    out = masks.get_sea_mask(ocean, threshold=threshold, mask_name="sea")
    np.testing.assert_array_equal(array_of(out, "sea").astype(bool), expected)
    with pytest.raises(ValueError):
        masks.get_sea_mask(ocean, threshold=1.5)


def test_apply_mask_takes_the_first_level_for_flat_fields(ocean):
    cube = masks.get_sea_mask(ocean, mask_name="sea")
    out = masks.apply_mask(masks.fillna(cube, {"thetao": 0.0}), "sea")
    sea = array_of(cube, "sea").astype(bool)
    np.testing.assert_array_equal(np.isnan(array_of(out, "thetao")), np.broadcast_to(~sea, (6, 3, 8, 8)))
    np.testing.assert_array_equal(np.isnan(array_of(out, "deptho")), ~sea[0])


def test_masks_of_missing_values_are_false(static):
    cube = masks.is_positive_mask(masks.get_notnull_mask(static, "deptho", "wet"), "deptho", "sea")
    np.testing.assert_array_equal(array_of(cube, "wet"), ~np.isnan(DEPTHO))
    np.testing.assert_array_equal(array_of(cube, "sea"), ~np.isnan(DEPTHO))


def test_fraction_mask(spark):
    values = np.array([[1e-8, 0.2, 0.5, np.nan], [0.7, 1.0, -1e-9, 0.0]])
    cube = cube_of(spark, ("lat", "lon"), values, {"lat": LAT[:2], "lon": LON[:4]}, "f")
    out = masks.fraction_mask(cube, "f", "m", 0.5, inclusive=True)
    np.testing.assert_array_equal(array_of(out, "f"), np.where(values < 1e-6, 0.0, values))
    np.testing.assert_array_equal(array_of(out, "m"), np.nan_to_num(values, nan=0.0) >= 0.5)
    for bad in ({"threshold": 1.0}, {"threshold": 0.0, "inclusive": True}, {"tolerance": -1.0}):
        with pytest.raises(ValueError):
            masks.fraction_mask(cube, "f", "m", **bad)


def test_keep_where_replaces_missing_values_elsewhere(ocean):
    out = masks.keep_where(ocean, ["thetao"], "deptho", 7.5, other=-1.0)
    values = array_of(ocean, "thetao")
    expected = np.where(DEPTHO == 7.5, values, -1.0)
    np.testing.assert_array_equal(array_of(out, "thetao"), expected)


def test_masked_fill_with_numbers_and_variables(ocean):
    cube = masks.get_sea_mask(ocean, mask_name="sea")
    cube = cube.assign(("time", "depth", "lat", "lon"), thetao=F.when(F.col("lat") > 0, F.col("thetao")))
    sea = np.broadcast_to(array_of(cube, "sea").astype(bool), (6, 3, 8, 8))
    values = array_of(cube, "thetao")
    filled = array_of(masks.masked_fill(cube, ["thetao"], -5.0, "sea"), "thetao")
    np.testing.assert_array_equal(filled, np.where(np.isnan(values) & sea, -5.0, values))
    other = array_of(masks.masked_fill(cube, ["thetao"], {"thetao": "deptho"}, "sea"), "thetao")
    np.testing.assert_array_equal(other, np.where(np.isnan(values) & sea, DEPTHO, values))
    with pytest.raises(ValueError, match="does not exist"):
        masks.masked_fill(ocean, ["thetao"], 0.0, "sea")


def test_clip_negative_keeps_missing_values(spark):
    values = np.array([[-1.0, np.nan], [2.0, 0.0]])
    cube = cube_of(spark, ("lat", "lon"), values, {"lat": [0, 1], "lon": [0, 1]}, "v")
    np.testing.assert_array_equal(array_of(masks.clip_negative(cube, ["v"]), "v"), np.clip(values, 0, None))


def test_products_and_divisions_propagate_missing_values(ocean):
    out = arith.products(ocean, heat=["thetao", "deptho"])
    np.testing.assert_allclose(array_of(out, "heat"), array_of(ocean, "thetao") * DEPTHO)
    cube = ocean.assign(("lat", "lon"), deptho=F.when(F.col("lon") > 3, 0.0).otherwise(F.col("deptho")))
    divided = array_of(arith.divide_by(cube, ["thetao"], "deptho"), "thetao")
    by = np.where(LON[None, :] > 3, np.nan, DEPTHO)
    np.testing.assert_allclose(divided, array_of(ocean, "thetao") / by)
    with pytest.raises(ValueError, match="no factors"):
        arith.products(ocean, nothing=[])


def test_directions_average_on_the_circle(spark):
    cube = cube_of(spark, ("lat", "lon"), np.array([[350.0, 10.0]]), {"lat": [0], "lon": [0, 1]}, "d")
    out = arith.sin_cos(cube, "d", "s", "c")
    assert "d" not in out.variables and out.var_attrs["s"]["units"] == "1"
    direction, steadiness = arith.mean_direction(F.avg("s"), F.avg("c"))
    row = out.frame("lat", "lon").agg(direction.alias("d"), steadiness.alias("r")).first()
    assert min(row["d"], 360 - row["d"]) < 1e-9 and row["r"] == pytest.approx(np.cos(np.radians(10)))


def test_bottom_values(ocean, ocean_values):
    expected = np.full((6, 8, 8), np.nan)
    for k in range(3):
        level = ocean_values[:, k]
        expected = np.where(np.isnan(level), expected, level)
    out = vertical.get_bottom(ocean, "depth", {"thetao": "bottom"}, replace=False)
    np.testing.assert_array_equal(array_of(out, "bottom"), expected)
    assert "depth" in out.dims_of("thetao")
    assert vertical.get_bottom(ocean, "depth", ["thetao"]).dims_of("thetao") == ("time", "lat", "lon")
    with pytest.raises(ValueError):
        vertical.get_bottom(ocean, "depth", ["thetao"], replace=False)


def test_fill_from_above_inside_a_mask(spark):
    t = np.array([[1, np.nan, 3, np.nan, np.nan], [np.nan, 2, np.nan, np.nan, np.nan]])
    m = np.array([[1, 1, 1, 1, 0], [1, 1, 1, 0, 1]], dtype=bool)
    axes = {"x": [0, 1], "depth": [0.5, 1.5, 2.5, 3.5, 4.5]}
    cube = merged(cube_of(spark, ("x", "depth"), t, axes, "t"), cube_of(spark, ("x", "depth"), m, axes, "m"))
    everywhere = array_of(vertical.fill_from_above(cube, ["t"], "depth"), "t")
    np.testing.assert_array_equal(everywhere, [[1, 1, 3, 3, 3], [np.nan, 2, 2, 2, 2]])
    inside = array_of(vertical.fill_from_above(cube, ["t"], "depth", "m"), "t")
    np.testing.assert_array_equal(inside, [[1, 1, 3, 3, np.nan], [np.nan, 2, 2, np.nan, 2]])
