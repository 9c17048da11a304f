"""Operators on the columns of a vertical dimension."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridspark.cube import Cube, Dims
from gridspark.functions.missing import holds
from gridspark.plans.steps import step


def _positioned(cube: Cube, dims: Dims, dim: str) -> DataFrame:
    """The table with the position along ``dim`` as ``__k`` (a join with a short axis)."""
    axis = cube.axis(dim).select(dim, F.col("idx").alias("__k"))
    return cube.frames[dims].join(axis, dim)


@step
def get_bottom(
    cube: Cube,
    depth_dim: str,
    variables: Iterable[str] | Mapping[str, str] | None = None,
    replace: bool = True,
) -> Cube:
    """The deepest value of each column; columns without values stay missing.

    One aggregation without a window: map tasks keep one candidate per column, so only those are
    shuffled. With ``replace=False``, ``variables`` maps each variable to its new name.
    """
    if not replace and not isinstance(variables, Mapping):
        raise ValueError("get_bottom: without replace, `variables` maps variables to new names")
    if replace and isinstance(variables, Mapping):
        warnings.warn("get_bottom: new names are ignored with replace=True", stacklevel=2)
    names = list(cube.variables if variables is None else variables)
    out = cube
    for dims in dict.fromkeys(cube.dims_of(name) for name in names):
        own = [name for name in names if cube.dims_of(name) == dims]
        if depth_dim not in dims:
            raise ValueError(f"get_bottom: {own} have no dimension {depth_dim!r}")
        rest = tuple(d for d in dims if d != depth_dim)
        target = {n: n if replace else variables[n] for n in own}
        k = F.col("__k")
        bottoms = _positioned(cube, dims, depth_dim).groupBy(*rest).agg(
            *(F.max_by(n, F.when(F.col(n).isNotNull(), k)).alias(target[n]) for n in own)
        )
        out = (out.without(own) if replace else out).add_frame(rest, bottoms)
    return out


@step
def fill_from_above(cube: Cube, variables: Iterable[str], depth_dim: str, mask_name: str | None = None) -> Cube:
    """Fill missing values with the nearest value above them in their column, inside the mask if one
    is given; where there is none above they stay missing. A task's group is one column: it holds
    at most one row per level."""
    out = cube
    names = list(variables)
    for dims in dict.fromkeys(cube.dims_of(name) for name in names):
        own = [name for name in names if cube.dims_of(name) == dims]
        columns = out.frames[dims].columns
        column = Window.partitionBy(*(d for d in dims if d != depth_dim)).orderBy("__k")
        above = column.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = _positioned(out, dims, depth_dim)
        if mask_name is None:
            filled = {n: F.last(n, ignorenulls=True).over(above) for n in own}
            df = df.withColumns(filled)
        else:
            df = df.withColumns({f"__{n}": F.last(n, ignorenulls=True).over(above) for n in own})
            joined = Cube({**out.frames, dims: df}, out.axes).attached(dims, [mask_name])
            fills = {
                n: F.when(F.col(n).isNull() & holds(F.col(mask_name)), F.col(f"__{n}")).otherwise(F.col(n))
                for n in own
            }
            df = joined.withColumns(fills)
        out = out.with_frame(dims, df.select(*columns))
    return out
