"""``Cube``: named variables on shared dimensions, as long Spark tables.

A cube holds one DataFrame per *dimension signature*: the variables on (time, lat, lon) are columns
of one table keyed by those three columns, static fields on (lat, lon) are another. Key columns hold
labels; positions live in the axis tables (see ``plans.axes``). A combination of labels without a
row is missing, the same as a row with NULL. NaN never enters: it becomes NULL on construction, so
that aggregates skip it and arithmetic propagates it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.missing import nan_to_null
from gridspark.plans.axes import axis_from, spine
from gridspark.plans.sizing import broadcast_checked

Dims = tuple[str, ...]


@dataclass(frozen=True)
class Cube:
    """Immutable: every step returns a new cube over the same lazily planned tables."""

    frames: Mapping[Dims, DataFrame]
    axes: Mapping[str, DataFrame] = field(default_factory=dict)
    attrs: Mapping[str, Any] = field(default_factory=dict)
    var_attrs: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)

    @classmethod
    def of(
        cls,
        frames: Mapping[Dims, DataFrame],
        axes: Mapping[str, DataFrame] | None = None,
        attrs: Mapping[str, Any] | None = None,
        var_attrs: Mapping[str, Mapping[str, Any]] | None = None,
    ) -> Cube:
        """A cube over ``frames``; their NaN become NULL."""
        clean = {dims: nan_to_null(df, exclude=dims) for dims, df in frames.items()}
        return cls(clean, dict(axes or {}), dict(attrs or {}), dict(var_attrs or {}))

    # -- what is in it ---------------------------------------------------------------------

    @property
    def variables(self) -> list[str]:
        return [name for dims, df in self.frames.items() for name in df.columns if name not in dims]

    def dims_of(self, variable: str) -> Dims:
        for dims, df in self.frames.items():
            if variable in df.columns and variable not in dims:
                return dims
        raise ValueError(f"{variable!r} is not a variable of the cube")

    def frame_of(self, variable: str) -> DataFrame:
        return self.frames[self.dims_of(variable)]

    def frame(self, *dims: str) -> DataFrame:
        """The table of the variables on exactly these dimensions, whatever their order."""
        return self.frames[self.signature(dims)]

    def signature(self, dims: Iterable[str]) -> Dims:
        wanted = set(dims)
        for key in self.frames:
            if set(key) == wanted:
                return key
        raise ValueError(f"the cube has no variables on {sorted(wanted)}")

    def axis(self, dim: str) -> DataFrame:
        """The axis table of ``dim``; when the cube does not store it, the labels of all tables that have
        the dimension (a row may be absent from any of them)."""
        if dim in self.axes:
            return self.axes[dim]
        having = [df.select(dim) for key, df in self.frames.items() if dim in key]
        if not having:
            raise ValueError(f"the cube has no dimension {dim!r}")
        return axis_from(reduce(DataFrame.union, having), dim)

    def with_axes(self, *dims: str) -> Cube:
        """The cube with these axes stored, each read once."""
        return replace(self, axes={**self.axes, **{d: self.axis(d) for d in dims if d not in self.axes}})

    def size(self, dim: str) -> int:
        return self.axis(dim).count()

    def first_label(self, dim: str) -> Column:
        """The label at position 0 of ``dim``, as a scalar subquery."""
        return self.axis(dim).where(F.col("idx") == 0).select(dim).scalar()

    def spine(self, *dims: str) -> DataFrame:
        """Every combination of the labels of ``dims``."""
        return spine((dim, self.axis(dim)) for dim in dims)

    # -- making new ones -------------------------------------------------------------------

    def with_frame(self, dims: Dims, df: DataFrame) -> Cube:
        """The cube whose table on ``dims`` is ``df`` (a table without variables is left out)."""
        frames: dict[Dims, DataFrame] = {}
        for key, value in self.frames.items():
            same = set(key) == set(dims)
            frames[dims if same else key] = df if same else value
        frames.setdefault(dims, df)
        if all(name in dims for name in df.columns):
            del frames[dims]
        return replace(self, frames=frames)

    def add_frame(self, dims: Dims, df: DataFrame) -> Cube:
        """The variables of ``df`` added to those on ``dims`` (outer join on the dimensions)."""
        for key, own in self.frames.items():
            if set(key) == set(dims):
                return self.with_frame(key, own.join(df, list(key), "full"))
        return replace(self, frames={**self.frames, dims: df})

    def assign(self, dims: Dims, **columns: Column) -> Cube:
        """Variables computed from other columns of the table on ``dims``."""
        return self.with_frame(dims, self.frames[dims].withColumns(columns))

    def without(self, names: Iterable[str]) -> Cube:
        gone = set(names)
        out = self
        for dims, df in self.frames.items():
            out = out.with_frame(dims, df.drop(*(gone & (set(df.columns) - set(dims)))))
        return replace(out, var_attrs={k: v for k, v in self.var_attrs.items() if k not in gone})

    def keep_attrs(self, **attrs: Mapping[str, Any]) -> Cube:
        return replace(self, var_attrs={**self.var_attrs, **attrs})

    def attached(self, dims: Dims, names: Iterable[str]) -> DataFrame:
        """The table on ``dims`` with the variables ``names`` of the other tables joined to it.

        Along a dimension the table lacks, the first index is taken (the surface level of a 3-D
        mask for a 2-D field). Rows without a partner get NULL.
        """
        out = self.frames[dims]
        wanted = [name for name in dict.fromkeys(names) if name not in out.columns]
        for other in dict.fromkeys(self.dims_of(name) for name in wanted):
            side = self.frames[other].select(*other, *(n for n in wanted if n in self.frames[other].columns))
            for dim in (d for d in other if d not in dims):
                side = side.where(F.col(dim) == self.first_label(dim)).drop(dim)
            shared = [d for d in other if d in dims]
            if shared:
                out = out.join(broadcast_checked(side), shared, "left")
            else:
                out = out.withColumns({n: side.select(n).scalar() for n in side.columns})
        return out
