"""Projection, selection and naming."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridspark.cube import Cube, Dims
from gridspark.plans.sizing import broadcast_checked
from gridspark.plans.steps import step


def _known(cube: Cube, names: Iterable[str], what: str) -> list[str]:
    names = list(names)
    if unknown := [name for name in names if name not in cube.variables]:
        raise ValueError(f"{what}: {unknown} are not variables of the cube")
    return names


@step
def select_variables(cube: Cube, variables: Iterable[str]) -> Cube:
    """Keep only the listed variables."""
    kept = set(_known(cube, variables, "select_variables"))
    return cube.without(set(cube.variables) - kept)


@step
def drop_vars(cube: Cube, names: str | Iterable[str]) -> Cube:
    """Drop the listed variables."""
    names = [names] if isinstance(names, str) else names
    return cube.without(_known(cube, names, "drop_vars"))


@step
def drop_static_vars(cube: Cube, time_dim: str = "time") -> Cube:
    """Drop the variables without the time dimension."""
    return replace(cube, frames={dims: df for dims, df in cube.frames.items() if time_dim in dims})


def _renamed_axis(axis: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return axis.withColumnsRenamed({old: new for old, new in names.items() if old in axis.columns})


def _renamed(cube: Cube, names: Mapping[str, str]) -> Cube:
    frames = {
        tuple(names.get(d, d) for d in dims): df.withColumnsRenamed(dict(names))
        for dims, df in cube.frames.items()
    }
    axes = {names.get(dim, dim): _renamed_axis(axis, names) for dim, axis in cube.axes.items()}
    attrs = {names.get(name, name): value for name, value in cube.var_attrs.items()}
    return replace(cube, frames=frames, axes=axes, var_attrs=attrs)


def _dims(cube: Cube) -> set[str]:
    return {d for dims in cube.frames for d in dims} | set(cube.axes)


@step
def rename(cube: Cube, name_dict: Mapping[str, str]) -> Cube:
    """Rename variables or dimensions; a name the cube lacks is an error."""
    known = set(cube.variables) | _dims(cube)
    if unknown := [name for name in name_dict if name not in known]:
        raise ValueError(f"rename: {unknown} are neither variables nor dimensions")
    taken = [new for old, new in name_dict.items() if new in known and new not in name_dict and new != old]
    if taken:
        raise ValueError(f"rename: {taken} are names of the cube already")
    return _renamed(cube, name_dict)


@step
def rename_coordinates(
    cube: Cube,
    name_dict: Mapping[str, str],
    set_new_coordinate: Mapping[str, str | Sequence[Any]] | None = None,
) -> Cube:
    """Rename dimensions and their labels; names the cube lacks are skipped.

    With ``set_new_coordinate = {NEW: "auto"}`` (or a list of labels), the renamed dimension is
    labelled 0..n-1 (or with those), and its axis keeps the old labels under the old name.
    """
    names = {old: new for old, new in name_dict.items() if old in _dims(cube)}
    relabelled = {
        old: (set_new_coordinate or {})[new] for old, new in names.items() if new in (set_new_coordinate or {})
    }
    cube = cube.with_axes(*relabelled)
    out = _renamed(cube, names)
    for old, labels in relabelled.items():
        new = names[old]
        axis = cube.axes[old].withColumnRenamed(old, "__old")
        if isinstance(labels, str):
            if labels != "auto":
                raise ValueError(f"rename_coordinates: {labels!r} is neither 'auto' nor a list of labels")
            axis = axis.withColumn(new, F.col("idx").cast("bigint"))
        else:
            size = axis.count()
            if len(labels) != size:
                raise ValueError(f"rename_coordinates: {len(labels)} labels for {size} of {old!r}")
            axis = axis.withColumn(new, F.array(*map(F.lit, labels))[F.col("idx")])
        lookup = axis.select(F.col("__old").alias(new), F.col(new).alias("__new"))
        frames = {
            dims: df.join(lookup, new).drop(new).withColumnRenamed("__new", new).select(*df.columns)
            if new in dims
            else df
            for dims, df in out.frames.items()
        }
        rest = [c for c in axis.columns if c not in ("idx", new, "__old")]
        axis = axis.select("idx", new, F.col("__old").alias(old), *rest)
        out = replace(out, frames=frames, axes={**out.axes, new: axis})
    return out


def _restricted(cube: Cube, dim: str, axis: DataFrame, bounds: Column | None = None) -> Cube:
    """The cube with only the labels of ``axis`` along ``dim``, renumbered. ``bounds`` is a condition
    on the label itself, which the scan of the data can use."""
    frames = {}
    for dims, df in cube.frames.items():
        if dim in dims:
            df = df if bounds is None else df.where(bounds)
            df = df.join(broadcast_checked(axis.select(dim)), dim, "left_semi").select(*df.columns)
        frames[dims] = df
    order = Window.orderBy("idx")
    numbered = axis.withColumn("idx", (F.row_number().over(order) - 1).cast("int"))
    return replace(cube, frames=frames, axes={**cube.axes, dim: numbered})


def _in_order(axis: DataFrame, column: str, wanted: Sequence[Any], values: Sequence[Column]) -> DataFrame:
    """``axis`` with the positions that its values have in a list; labels are keys, so none comes twice."""
    if len(set(wanted)) < len(wanted):
        raise ValueError(f"{list(wanted)} has an entry twice")
    if not values:
        return axis
    return axis.withColumn("idx", F.array_position(F.array(*values), F.col(column)).cast("int") - 1)


def _at(cube: Cube, dim: str, label: Column) -> Cube:
    """The cube at one label of ``dim``, without the dimension."""
    frames: dict[Dims, DataFrame] = {}
    for dims, df in cube.frames.items():
        if dim in dims:
            df, dims = df.where(F.col(dim) == label).drop(dim), tuple(d for d in dims if d != dim)
        frames[dims] = frames[dims].join(df, list(dims), "full") if dims in frames else df
    return replace(cube, frames=frames, axes={k: v for k, v in cube.axes.items() if k != dim})


def _slice(value: Mapping[str, Any]) -> tuple[Any, Any, Any]:
    if not set(value) <= {"start", "stop", "step"}:
        raise ValueError(f"a selection is a label, a list or start/stop/step, not {dict(value)}")
    return value.get("start"), value.get("stop"), value.get("step")


@step
def sel(cube: Cube, **kwargs: Any) -> Cube:
    """Select by label: a label, a list of labels, or ``{start, stop, step}`` with both ends included,
    in the direction of the axis (a decreasing latitude is selected ``start=46, stop=40``)."""
    for dim, value in kwargs.items():
        cube = cube.with_axes(dim)
        axis = cube.axes[dim]
        kind = axis.schema[dim].dataType
        if isinstance(value, Mapping):
            start, stop, every = _slice(value)
            low, high = (None if v is None else F.lit(v).cast(kind) for v in (start, stop))
            forward = axis.agg((F.min_by(dim, "idx") <= F.max_by(dim, "idx")).alias("up")).first()["up"]
            if forward is False:
                low, high = high, low
            bounds = F.lit(True)
            if low is not None:
                bounds = bounds & (F.col(dim) >= low)
            if high is not None:
                bounds = bounds & (F.col(dim) <= high)
            chosen = axis.where(bounds)
            if every is not None and every != 1:
                if every < 1:
                    raise ValueError("sel: the step of a selection is positive")
                first = chosen.agg(F.min("idx")).scalar()
                chosen = chosen.where((F.col("idx") - first) % every == 0)
            cube = _restricted(cube, dim, chosen, bounds)
        else:
            wanted = list(value) if isinstance(value, (list, tuple)) else [value]
            labels = [F.lit(v).cast(kind) for v in wanted]
            found = axis.where(F.col(dim).isin(labels))
            if found.count() != len(set(wanted)):
                raise ValueError(f"sel: not all of {wanted} are labels of {dim!r}")
            if isinstance(value, (list, tuple)):
                cube = _restricted(cube, dim, _in_order(found, dim, wanted, labels), F.col(dim).isin(labels))
            else:
                cube = _at(cube, dim, labels[0])
    return cube


@step
def isel(cube: Cube, **kwargs: Any) -> Cube:
    """Select by position: an index, a list, or a half-open ``{start, stop, step}``; negative
    positions count from the end."""
    for dim, value in kwargs.items():
        cube = cube.with_axes(dim)
        axis = cube.axes[dim]
        size = axis.count()
        if isinstance(value, Mapping):
            start, stop, every = slice(*_slice(value)).indices(size)
            if every < 1:
                raise ValueError("isel: the step of a selection is positive")
            chosen = (F.col("idx") >= start) & (F.col("idx") < stop) & ((F.col("idx") - start) % every == 0)
            cube = _restricted(cube, dim, axis.where(chosen))
            continue
        wanted = list(value) if isinstance(value, (list, tuple)) else [value]
        positions = [v + size if v < 0 else v for v in wanted]
        if any(not 0 <= p < size for p in positions):
            raise ValueError(f"isel: positions {wanted} are not all within the {size} of {dim!r}")
        if isinstance(value, (list, tuple)):
            found = axis.where(F.col("idx").isin(positions))
            cube = _restricted(cube, dim, _in_order(found, "idx", positions, [F.lit(p) for p in positions]))
        else:
            cube = _at(cube, dim, axis.where(F.col("idx") == positions[0]).select(dim).scalar())
    return cube


@step
def flip(cube: Cube, dim: str) -> Cube:
    """Reverse the order along ``dim``: only the positions of its axis change."""
    cube = cube.with_axes(dim)
    axis = cube.axes[dim]
    last = axis.agg(F.max("idx")).scalar()
    return replace(cube, axes={**cube.axes, dim: axis.withColumn("idx", (last - F.col("idx")).cast("int"))})


@step
def transpose(cube: Cube, dims: Sequence[str], missing_dims: str = "raise") -> Cube:
    """Reorder dimensions: the order of key columns, and of rows when written."""
    if missing_dims == "raise" and (unknown := set(dims) - _dims(cube)):
        raise ValueError(f"transpose: no dimensions {sorted(unknown)}")
    frames = {}
    for key, df in cube.frames.items():
        order = tuple(d for d in dims if d in key) + tuple(d for d in key if d not in dims)
        frames[order] = df.select(*order, *(c for c in df.columns if c not in order))
    return replace(cube, frames=frames)


@step
def squeeze(cube: Cube, dim: str | Sequence[str] | None = None) -> Cube:
    """Drop dimensions of size one (the given ones must be)."""
    given = [dim] if isinstance(dim, str) else dim
    for name in sorted(_dims(cube)) if given is None else given:
        cube = cube.with_axes(name)
        size = cube.axes[name].count()
        if size == 1:
            cube = _at(cube, name, cube.axes[name].select(name).scalar())
        elif given is not None:
            raise ValueError(f"squeeze: {name!r} has {size} labels")
    return cube


# Spark types of the dtype names, with their kind and width.
_DTYPES: dict[str, tuple[T.DataType, str, int]] = {
    "bool": (T.BooleanType(), "b", 1),
    "int8": (T.ByteType(), "i", 1),
    "int16": (T.ShortType(), "i", 2),
    "int32": (T.IntegerType(), "i", 4),
    "int64": (T.LongType(), "i", 8),
    "float32": (T.FloatType(), "f", 4),
    "float64": (T.DoubleType(), "f", 8),
}
_KINDS = "bif"


def _dtype_of(kind: T.DataType) -> str:
    return next((name for name, (t, _, _) in _DTYPES.items() if t == kind), kind.simpleString())


def castable(source: str, target: str, casting: str) -> bool:
    """Whether a conversion follows the casting rule: no, equiv, safe, same_kind or unsafe."""
    if casting == "unsafe" or source == target:
        return True
    if casting in ("no", "equiv"):
        return False
    (_, k0, w0), (_, k1, w1) = _DTYPES[source], _DTYPES[target]
    if k0 == k1:
        safe = w1 >= w0
    elif k0 == "i" and k1 == "f":
        safe = w1 > w0 or w1 == 8
    else:
        safe = k0 == "b"
    if casting == "safe":
        return safe
    if casting == "same_kind":
        return _KINDS.index(k1) >= _KINDS.index(k0)
    raise ValueError(f"astype: no casting rule {casting!r}")


def _converted(df: DataFrame, name: str, dtype: str, casting: str) -> Column:
    if dtype not in _DTYPES:
        raise ValueError(f"astype: no dtype {dtype!r}")
    source = _dtype_of(df.schema[name].dataType)
    if source not in _DTYPES or not castable(source, dtype, casting):
        raise ValueError(f"astype: {name!r} cannot be converted from {source} to {dtype} ({casting})")
    return F.col(name).cast(_DTYPES[dtype][0])


@step
def astype(cube: Cube, dtype: str | None = None, casting: str | None = None, **kwargs: Mapping[str, str]) -> Cube:
    """Convert all variables (``dtype``, ``casting``), or some (``VAR = {dtype, casting}``)."""
    if dtype is not None and kwargs:
        raise ValueError("astype takes `dtype` for all variables or one table per variable, not both")
    if dtype is None and casting is not None:
        raise ValueError("astype: `casting` without `dtype`")
    if dtype is not None:
        wanted = {name: {"dtype": dtype, "casting": casting or "unsafe"} for name in cube.variables}
    else:
        wanted = {name: {"casting": "unsafe", **kwargs[name]} for name in _known(cube, kwargs, "astype")}
    for dims, df in cube.frames.items():
        own = {n: _converted(df, n, **wanted[n]) for n in df.columns if n in wanted and n not in dims}
        cube = cube.with_frame(dims, df.withColumns(own)) if own else cube
    return cube


@step
def convert_calendar(cube: Cube, calendar: str, time_dim: str = "time") -> Cube:
    """To the 365-day calendar ("noleap"): Feb 29 leaves. Other calendars are refused."""
    if calendar in ("standard", "gregorian", "proleptic_gregorian"):
        return cube
    if calendar not in ("noleap", "365_day"):
        raise ValueError(f"convert_calendar: {calendar!r} is not supported")
    kept = ~((F.month(time_dim) == 2) & (F.dayofmonth(time_dim) == 29))
    frames = {dims: df.where(kept) if time_dim in dims else df for dims, df in cube.frames.items()}
    axes = {dim: axis for dim, axis in cube.axes.items() if dim != time_dim}
    return replace(cube, frames=frames, axes=axes)


@step
def chunk(cube: Cube, chunks: int | Mapping[str, int] | None = None) -> Cube:
    """Change how rows are partitioned, never their values: by ranges of the dimensions that are to be
    split (those with a size; -1 keeps a dimension whole). Spark sizes the partitions."""
    split = [d for d, size in chunks.items() if size != -1] if isinstance(chunks, Mapping) else []
    frames = {}
    for dims, df in cube.frames.items():
        own = [d for d in split if d in dims]
        frames[dims] = df.repartitionByRange(*own) if own else df
    return replace(cube, frames=frames)


@step
def assign_attrs(cube: Cube, **kwargs: Any) -> Cube:
    """Set attributes of the cube."""
    return replace(cube, attrs={**cube.attrs, **kwargs})


@step
def drop_attrs(cube: Cube, deep: bool = True) -> Cube:
    """Remove the attributes of the cube and, if ``deep``, of its variables."""
    return replace(cube, attrs={}, var_attrs={} if deep else cube.var_attrs)


def _attributable(cube: Cube, names: Iterable[str]) -> None:
    known = set(cube.variables) | _dims(cube)
    if unknown := [name for name in names if name not in known]:
        raise ValueError(f"{unknown} are neither variables nor coordinates")


@step
def assign_var_attrs(cube: Cube, **kwargs: Mapping[str, Any]) -> Cube:
    """Replace the attributes of variables or coordinates, one table per name."""
    _attributable(cube, kwargs)
    return cube.keep_attrs(**{name: dict(attrs) for name, attrs in kwargs.items()})


@step
def drop_var_attrs(cube: Cube, variables: Iterable[str]) -> Cube:
    """Remove all attributes of the listed variables or coordinates."""
    variables = list(variables)
    _attributable(cube, variables)
    return replace(cube, var_attrs={k: v for k, v in cube.var_attrs.items() if k not in variables})


def with_column_metadata(cube: Cube) -> Cube:
    """The cube whose columns carry their attributes as metadata (as written tables do)."""
    frames = {}
    for dims, df in cube.frames.items():
        for name in df.columns:
            df = df.withMetadata(name, dict(cube.var_attrs.get(name, {})))
        frames[dims] = df
    return replace(cube, frames=frames)
