"""Small synthetic cubes, and results as text that can be compared."""

from __future__ import annotations

import datetime

import numpy as np
import pandas as pd
import pyarrow as pa

from gridspark.cube import Cube
from gridspark.plans.axes import axis_of

LAT = np.arange(-1.75, 2.0, 0.5)
LON = np.arange(0.25, 4.0, 0.5)
DEPTH = np.array([0.5, 2.0, 5.0])
START = datetime.datetime(2020, 2, 26)
SF = "/root/testdata/sf0.001"


def cube_of(spark, dims, values, axes, name):
    """A cube of one variable from an n-d array; NaN are missing."""
    labels = [np.asarray(axes[d]) for d in dims]
    grids = np.meshgrid(*labels, indexing="ij")
    columns = {d: pa.array(g.ravel()) for d, g in zip(dims, grids, strict=True)}
    columns[name] = pa.array(np.asarray(values).ravel())
    table = pa.table(columns)
    if "time" in dims:
        stamps = table["time"].cast(pa.timestamp("us", tz="UTC"))
        table = table.set_column(table.column_names.index("time"), "time", stamps)
    tables = {d: axis_of(spark, d, list(map(float, axes[d]))) for d in dims if d != "time"}
    return Cube.of({tuple(dims): spark.createDataFrame(table)}, tables)


def merged(*cubes):
    frames, axes = {}, {}
    for cube in cubes:
        for dims, df in cube.frames.items():
            frames[dims] = frames[dims].join(df, list(dims)) if dims in frames else df
        axes |= cube.axes
    return Cube(frames, axes)


def array_of(cube, name, shape=None):
    """The values of a variable as an n-d array in label order, NaN where missing."""
    dims = cube.dims_of(name)
    pdf = cube.frame_of(name).select(*dims, name).toPandas().sort_values(list(dims))
    values = np.array([np.nan if v is None else float(v) for v in pdf[name].astype(object).where(pdf[name].notna(), None)])
    shape = shape or tuple(pdf[d].nunique() for d in dims)
    return values.reshape(shape)


def days(n, start=START, step=datetime.timedelta(days=1)):
    return np.array([np.datetime64(start + k * step, "us") for k in range(n)])


def normal(df):
    """Sorted columns and rows, values as text."""
    out = {}
    for name in sorted(df.columns):
        column = df[name]
        if pd.api.types.is_datetime64_any_dtype(column.dtype):
            out[name] = column.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(column.dtype):
            out[name] = column.map(lambda v: "NULL" if pd.isna(v) else repr(float(v) + 0.0))
        else:
            out[name] = column.map(lambda v: "NULL" if v is None or (isinstance(v, float) and np.isnan(v)) else str(v))
    return pd.DataFrame(out).sort_values(sorted(out)).reset_index(drop=True)
