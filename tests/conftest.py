"""A session, and cubes whose results are known."""

from __future__ import annotations

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cubes import DEPTH, LAT, LON, cube_of, days, merged  # noqa: E402

from gridspark.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session("local[4]", shuffle_partitions=4, memory="4g")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def static(spark):
    """deptho(lat, lon): land, then 1.5, 2.5 ... 7.5 eastwards."""
    deptho = np.tile([np.nan, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5], (8, 1))
    return cube_of(spark, ("lat", "lon"), deptho, {"lat": LAT, "lon": LON}, "deptho")


@pytest.fixture(scope="session")
def ocean_values():
    rng = np.random.default_rng(0)
    deptho = np.array([np.nan, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5])
    values = 10 + rng.standard_normal((6, 3, 8, 8))
    wet = DEPTH[:, None] < np.nan_to_num(deptho, nan=-1.0)[None, :]
    return np.where(wet[None, :, None, :], values, np.nan)


@pytest.fixture(scope="session")
def ocean(spark, static, ocean_values):
    """thetao(time, depth, lat, lon) over six days across Feb 29, and deptho."""
    axes = {"time": days(6), "depth": DEPTH, "lat": LAT, "lon": LON}
    return merged(cube_of(spark, ("time", "depth", "lat", "lon"), ocean_values, axes, "thetao"), static)
