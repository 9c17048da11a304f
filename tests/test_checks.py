import datetime

import numpy as np
import pytest
from cubes import LAT, LON, cube_of, days, merged
from pyspark.sql import functions as F

from gridspark.functions.packing import Encoding
from gridspark.operators import checks, masks, select
from gridspark.operators.checks import CheckFailed

OCEAN = ("time", "depth", "lat", "lon")


@pytest.fixture(scope="module")
def masked(ocean):
    return masks.get_sea_mask(ocean, mask_name="sea").without(["deptho"])


def problems(axis, *args, **kwargs):
    return sorted((r[0], str(r[1])) for r in checks.valid_time_coordinate(axis, *args, **kwargs).collect())


def test_time_axes(spark, ocean):
    axis = ocean.axis("time")
    assert problems(axis, "2020-02-26", "2020-03-03") == []
    assert problems(axis, "2020-02-26", "2020-03-02", inclusive="both") == []
    assert [p for p, _ in problems(axis, "2020-02-26", "2020-03-04")] == ["missing"]
    assert [p for p, _ in problems(axis, "2020-02-27", "2020-03-03")] == ["unexpected"]
    stamps = ["2020-01-01", "2020-01-03", "2020-01-02", "2020-01-02"]
    rows = spark.createDataFrame(list(enumerate(stamps)), "idx int, time string")
    found = problems(rows.withColumn("time", F.col("time").cast("timestamp")), "2020-01-01", "2020-01-04")
    assert found == [("duplicate", "2020-01-02 00:00:00"), ("unsorted", "2020-01-02 00:00:00")]


def test_global_coordinates(spark, static):
    assert checks.valid_global_coordinates(static).count() == 0
    assert [r[0] for r in checks.valid_global_coordinates(select.flip(static, "lat")).collect()] == ["latitudes decrease"]
    axes = {"lat": [-91.0, 0.0], "lon": [-1.0, 360.0]}
    wrong = cube_of(spark, ("lat", "lon"), np.zeros((2, 2)), axes, "v")
    found = {r[0] for r in checks.valid_global_coordinates(wrong).collect()}
    assert found == {"latitude below -90", "longitude below 0", "longitude not below 360"}


def test_missing_values_inside_masks(masked):
    assert checks.missing_values(masked, exact=True, masks={"sea": ["thetao"]}).count() == 0
    everywhere = checks.missing_values(masked).toPandas()
    assert set(everywhere["variable"]) == {"thetao"} and len(everywhere) == 6
    hole = (F.col("time") == F.lit("2020-02-28").cast("timestamp")) & (F.col("lat") == LAT[2]) & (F.col("lon") == LON[7])
    holed = masked.assign(OCEAN, thetao=F.when(~hole, F.col("thetao")))
    absent = masked.with_frame(OCEAN, masked.frame(*OCEAN).where(~hole))
    for cube in (holed, absent):
        row = checks.missing_values(cube.with_axes("time"), masks={"sea": ["thetao"]}).collect()
        assert [(str(r["time"]), r["mask"], r["n"]) for r in row] == [("2020-02-28 00:00:00", "sea", 3)]
    with pytest.raises(CheckFailed, match="thetao"):
        checks.ensure_no_nans(holed, sea=["thetao"])


def test_values_outside_exact_masks(masked):
    filled = masks.fillna(masked, {"thetao": 0.0})
    report = checks.missing_values(filled, exact=["sea"], masks={"sea": ["thetao"]}).toPandas()
    assert set(report["kind"]) == {"outside"}
    errors = checks.missing_values(masked, exact=["other"], masks={"land": ["thetao"], "sea": ["absent"]}).toPandas()
    assert set(errors[errors.kind == "error"]["mask"]) == {
        "exact names 'other', under which nothing is checked",
        "no mask 'land' in the cube",
        "no variable 'absent' in the cube for mask 'sea'",
    }


def test_masks_that_vary_in_time(spark):
    values = np.array([[1.0, np.nan], [np.nan, 2.0]])
    ice = np.array([[0.5, 0.0], [0.4, np.nan]])
    axes = {"time": days(2), "lat": [0, 1]}
    cube = merged(cube_of(spark, ("time", "lat"), values, axes, "v"), cube_of(spark, ("time", "lat"), ice, axes, "ice"))
    report = checks.missing_values(cube, masks={"ice": ["v"]}).where("variable = 'v'").collect()
    assert [(str(r["time"])[:10], r["n"]) for r in report] == [("2020-02-27", 1)]
    static = cube_of(spark, ("lat",), np.zeros(2), {"lat": [0, 1]}, "s")
    errors = checks.missing_values(merged(cube, static), masks={"ice": ["s"]}).where("kind = 'error'").collect()
    assert errors[0]["mask"] == "mask 'ice' varies along 'time', 's' does not"


def test_guards_count_while_writing(masked, tmp_path):
    def written(cube, name, **rules):
        guarded, guards = checks.guard_no_nans(cube, **rules)
        for dims, df in guarded.frames.items():
            df.write.parquet(f"{tmp_path}/{name}-{len(dims)}")
        for guard in guards:
            guard.verify(cube)

    written(masked, "right", sea=["thetao"], exact=True)
    with pytest.raises(CheckFailed, match="thetao inside mask sea"):
        written(masked.assign(OCEAN, thetao=F.when(F.col("lat") > 0, F.col("thetao"))), "wrong", sea=["thetao"])
    with pytest.raises(CheckFailed, match="outside mask sea"):
        written(masks.fillna(masked, {"thetao": 0.0}), "outside", sea=["thetao"], exact=True)
    gone = masked.with_frame(OCEAN, masked.frame(*OCEAN).where(F.col("lat") > LAT[0]))
    with pytest.raises(CheckFailed, match="missing values of thetao"):
        written(gone, "absent", sea=["thetao"])
    with pytest.raises(CheckFailed, match="no mask 'land'"):
        checks.guard_no_nans(masked, land=["thetao"])


def test_attributes(spark, ocean):
    names = {"long_name": "depth", "units": "m"}
    right = select.assign_var_attrs(ocean, deptho=names, thetao={"long_name": "temperature", "units": "degC"})
    assert checks.attribute_problems(right) == []
    same = select.assign_var_attrs(ocean, deptho=names, thetao=names | {"units": ""})
    assert {p[:3] for p in checks.attribute_problems(same)} == {
        ("lacking", "units", "thetao"), ("same", "long_name", "deptho"), ("same", "long_name", "thetao")
    }
    given = spark.createDataFrame(
        [("a", "units", "m"), ("a", "long_name", "x"), ("b", "long_name", "x")],
        "variable string, attribute string, value string",
    )
    report = checks.attribute_report(given.select("variable").distinct(), given)
    assert {tuple(r)[:3] for r in report.collect()} == {
        ("lacking", "units", "b"), ("same", "long_name", "a"), ("same", "long_name", "b")
    }


def test_static_fields_are_compared_as_stored(static):
    encoding = Encoding("smallint", 0.01, 0.0, -32768)
    frame = static.frame("lat", "lon").withColumn("deptho", F.col("deptho") + 0.001)
    stored = frame.withColumn("deptho", encoding.as_stored(F.col("deptho")))
    packed = frame.withColumn("deptho", encoding.as_stored(F.col("deptho")))
    assert checks.check_static(packed, stored, ["lat", "lon"]).count() == 0
    assert checks.check_static(frame, stored, ["lat", "lon"]).count() == 56
    assert checks.check_static(frame.where("lon > 1"), frame, ["lat", "lon"]).count() == 8
    with pytest.raises(CheckFailed):
        checks.check_static(frame.withColumn("new", F.lit(1)), stored, ["lat", "lon"])


def test_stand_ins_and_what_their_masks_cover_are_not_checked(masked):
    block = datetime.datetime(2020, 2, 26), datetime.datetime(2020, 3, 3)
    empty = masked.assign(OCEAN, thetao=F.lit(None).cast("double"))
    rules = {"ensure_no_nans": {"sea": ["thetao"], "exact": ["sea"]}}
    for absent in (["thetao"], ["sea"]):
        cube, later = checks.block_checks(empty, rules, *block, absent=absent)
        assert all(rule.variable != "thetao" for guard in later.guards for rule in guard.rules)
        assert set(cube.variables) == set(empty.variables)


def test_validation_reports_everything(masked):
    config = {
        "valid_time_coordinate": {},
        "valid_global_coordinates": {},
        "attributes": {"required": ["units"], "distinct": []},
        "ensure_no_nans": {"sea": ["thetao"], "exact": True},
    }
    found = checks.validate(masked, config, "2020-02-26", "2020-03-04").toPandas()
    assert sorted(found["check"]) == ["attributes", "attributes", "valid_time_coordinate"]
    with pytest.raises(ValueError, match="start and end"):
        checks.validate(masked, config)
