"""Parts of a dataset: reading, shifting, slicing, aligning and merging them."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.cube import Cube, Dims
from gridspark.functions.times import plus, seconds, stamp
from gridspark.plans.sizing import broadcast_checked
from gridspark.plans.steps import step

Instant = str | datetime.datetime


def scan_part(
    spark: SparkSession,
    path: str,
    dims: Sequence[str],
    variables: Iterable[str] | None = None,
    drop_variables: Iterable[str] | None = None,
    rename: Mapping[str, str] | None = None,
    format: str = "parquet",
    **options: str,
) -> Cube:
    """One table as a cube: its variables (all, some, or all but some; absent ones to drop are
    ignored), renamed right after it is opened. ``dims`` are names before the renaming."""
    df = spark.read.format(format).options(**options).load(path)
    dims = tuple(dims)
    if variables is not None:
        df = df.select(*dims, *(v for v in variables if v not in dims))
    if drop_variables is not None:
        df = df.drop(*(v for v in drop_variables if v not in dims))
    names = dict(rename or {})
    if unknown := [name for name in names if name not in df.columns]:
        raise ValueError(f"rename: the part has no {unknown}")
    return Cube.of({tuple(names.get(d, d) for d in dims): df.withColumnsRenamed(names)})


@step
def time_sel(cube: Cube, start: Instant, end: Instant, time_dim: str = "time") -> Cube:
    """The stamps in ``[start, end)``; tables without time are unchanged."""
    inside = (F.col(time_dim) >= stamp(start)) & (F.col(time_dim) < stamp(end))
    frames = {dims: df.where(inside) if time_dim in dims else df for dims, df in cube.frames.items()}
    axes = {dim: _renumbered(axis.where(inside)) if dim == time_dim else axis for dim, axis in cube.axes.items()}
    return replace(cube, frames=frames, axes=axes)


def _renumbered(axis: DataFrame) -> DataFrame:
    """Positions from 0 again after a contiguous slice."""
    first = axis.agg(F.min("idx")).scalar()
    return axis.withColumn("idx", (F.col("idx") - first).cast("int"))


def time_offset(
    cube: Cube,
    offset: str | datetime.timedelta,
    start: Instant | None = None,
    end: Instant | None = None,
    time_dim: str = "time",
) -> Cube:
    """Add ``offset`` to the stamps and select ``[start, end)`` of the moved ones.

    The selection is made on the raw stamps, moved the other way, so the scan can use it.
    """
    by = seconds(offset)
    if all(time_dim not in dims for dims in cube.frames):
        raise ValueError(f"time_offset needs a {time_dim!r} dimension, which the part lacks")
    t = F.col(time_dim)
    frames = {}
    for dims, df in cube.frames.items():
        if time_dim in dims:
            df = df if start is None else df.where(t >= plus(stamp(start), -by))
            df = df if end is None else df.where(t < plus(stamp(end), -by))
            df = df.withColumn(time_dim, plus(t, by)).select(*df.columns)
        frames[dims] = df
    return replace(cube, frames=frames, axes={d: a for d, a in cube.axes.items() if d != time_dim})


def static_time(cube: Cube, instant: Instant, time_dim: str = "time") -> Cube:
    """The cube at one stamp, without the time dimension; the stamp must be one of the source's."""
    at = F.col(time_dim) == stamp(instant)
    frames: dict[Dims, DataFrame] = {}
    for dims, df in cube.frames.items():
        if time_dim not in dims:
            frames[dims] = df
            continue
        rest = tuple(d for d in dims if d != time_dim)
        chosen = df.where(at)
        if not chosen.limit(1).count():
            raise ValueError(f"static_time {instant} is not a stamp of the part")
        chosen = chosen.drop(time_dim)
        frames[rest] = frames[rest].join(chosen, list(rest), "full") if rest in frames else chosen
    return replace(cube, frames=frames, axes={d: a for d, a in cube.axes.items() if d != time_dim})


def snapped_axis(axis: DataFrame, reference: DataFrame, dim: str) -> DataFrame:
    """``(idx, dim, snapped, difference)``: the labels side by side, matched by position."""
    other = reference.select("idx", F.col(dim).alias("snapped"))
    joined = axis.select("idx", dim).join(other, "idx", "full")
    difference = F.abs(F.col(dim).cast("double") - F.col("snapped").cast("double"))
    return joined.select("idx", dim, "snapped", difference.alias("difference"))


def snap_coordinates(cube: Cube, earlier: Sequence[Cube], tolerance: float) -> Cube:
    """The cube with the labels of an earlier cube on the numeric dimensions they share (same name
    and size), if no label differs by more than ``tolerance``."""
    if tolerance <= 0:
        raise ValueError("coordinate_tolerance is positive")
    dims = list(dict.fromkeys(d for key in cube.frames for d in key))
    cube = cube.with_axes(*dims)
    matched = False
    frames, axes = dict(cube.frames), dict(cube.axes)
    for dim in dims:
        axis = axes[dim]
        size = axis.count()
        reference = next(
            (o.axis(dim) for o in earlier if any(dim in k for k in o.frames) and o.axis(dim).count() == size), None
        )
        if reference is None or not all(
            isinstance(a.schema[dim].dataType, T.NumericType) for a in (axis, reference)
        ):
            continue
        pairs = snapped_axis(axis, reference, dim)
        worst = pairs.agg(F.max("difference").alias("d"), F.count_if(F.col("difference").isNull()).alias("n")).first()
        if worst["n"]:
            raise ValueError(f"coordinate {dim!r} has missing labels where an earlier part's has values, or the reverse")
        if worst["d"] > tolerance:
            raise ValueError(
                f"coordinate {dim!r} differs from an earlier part's by {worst['d']:g}, more than the"
                f" part's coordinate_tolerance {tolerance:g}"
            )
        lookup = broadcast_checked(pairs.select(dim, "snapped"))
        for key, df in frames.items():
            if dim in key:
                moved = df.join(lookup, dim).drop(dim).withColumnRenamed("snapped", dim)
                frames[key] = moved.select(*df.columns)
        axes[dim] = pairs.select("idx", F.col("snapped").alias(dim))
        matched = True
    if not matched:
        raise ValueError("coordinate_tolerance: no coordinate of the part matches an earlier part's")
    return replace(cube, frames=frames, axes=axes)


def axis_differences(a: DataFrame, b: DataFrame, dim: str) -> DataFrame:
    """The labels on one axis only (no rows if the axes are equal)."""
    left, right = a.select(dim), b.select(dim)
    return left.exceptAll(right).unionByName(right.exceptAll(left))


def _require_equal_axes(a: Cube, b: Cube) -> None:
    shared = {d for key in a.frames for d in key} & {d for key in b.frames for d in key}
    for dim in sorted(shared):
        if axis_differences(a.axis(dim), b.axis(dim), dim).limit(1).count():
            raise ValueError(f"coordinate {dim!r} differs between the datasets: they are merged only on equal ones")


def merge_parts(parts: Sequence[Cube]) -> Cube:
    """The union of the variables of parts with equal coordinates (``join="exact"``). Values of a
    variable two parts share must agree where both have one."""
    return reduce(merge_datasets, parts)


def conflicts(a: DataFrame, b: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Cells where a variable of both tables has two different values: ``(dims, variable)``."""
    names = [c for c in a.columns if c in b.columns and c not in dims]
    left = a.select(*dims, *(F.col(n).alias(f"a_{n}") for n in names))
    right = b.select(*dims, *(F.col(n).alias(f"b_{n}") for n in names))
    differing = F.array(*(F.when(F.col(f"a_{n}") != F.col(f"b_{n}"), F.lit(n)) for n in names))
    joined = left.join(right, list(dims))
    return joined.select(*dims, F.explode(F.array_compact(differing)).alias("variable"))


def merged_frame(a: DataFrame, b: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Rows of both tables, values of the first where both have one (checked elsewhere to agree).

    The conflict test rides on the same join: a differing pair raises when it is computed.
    """
    shared = [c for c in a.columns if c in b.columns and c not in dims]
    renamed = b.withColumnsRenamed({n: f"__{n}" for n in shared})
    joined = a.join(renamed, list(dims), "full")
    made = {}
    for n in shared:
        mine, other = F.col(n), F.col(f"__{n}")
        kind = joined.schema[n].dataType
        clash = F.raise_error(F.lit(f"merge: conflicting values of {n!r}")).cast(kind)
        made[n] = F.when(mine != other, clash).otherwise(F.coalesce(mine, other))
    out = joined.withColumns(made) if made else joined
    return out.select(*a.columns, *(c for c in b.columns if c not in a.columns))


def merge_datasets(a: Cube, b: Cube) -> Cube:
    """Merge two cubes on exactly equal coordinates and identical attributes; same-named variables
    must agree where both have values, and fill each other's gaps."""
    if dict(a.attrs) != dict(b.attrs):
        raise ValueError("merge: the datasets' attributes differ")
    _require_equal_axes(a, b)
    frames = dict(a.frames)
    for dims, df in b.frames.items():
        key = next((k for k in frames if set(k) == set(dims)), None)
        frames[key or dims] = merged_frame(frames[key], df, key) if key is not None else df
    return replace(a, frames=frames, axes={**b.axes, **a.axes}, var_attrs={**b.var_attrs, **a.var_attrs})


def wanted_days(spark: SparkSession, start: Instant, end: Instant, name: str = "day") -> DataFrame:
    """The days of ``[start, end)``."""
    days = F.sequence(F.to_date(stamp(start)), F.to_date(plus(stamp(end), -1)))
    return spark.range(1).select(F.explode(days).alias(name))


def missing_days(df: DataFrame, start: Instant, end: Instant, time_dim: str = "time") -> DataFrame:
    """The wanted days without a row, one aggregation over the stamps."""
    given = df.select(F.to_date(time_dim).alias("day")).distinct()
    return wanted_days(df.sparkSession, start, end).join(given, "day", "left_anti")


def require_days(df: DataFrame, start: Instant, end: Instant, time_dim: str = "time") -> DataFrame:
    """The rows of the wanted days; days without rows are an error naming their number, first and
    last."""
    lost = missing_days(df, start, end, time_dim).agg(F.count("day"), F.min("day"), F.max("day")).first()
    if lost[0]:
        raise ValueError(f"no data for {lost[0]} day(s), from {lost[1]} to {lost[2]}: not published yet?")
    t = F.col(time_dim)
    return df.where((t >= F.date_trunc("day", stamp(start))) & (t < stamp(end)))
