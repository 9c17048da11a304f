"""Reductions over dimensions and over time bins.

Bins are keys computed from the stamp by arithmetic, so a resampling is one hash aggregation with
partial results on the map side. The dense result (every bin from the first to the last, for every
combination of the other labels) comes from rows without values added to the same aggregation: no
join, and nothing larger than the result is added to the shuffle. A bin without stamps is missing
(its count 0); a bin with stamps but only missing values has sum 0 and count 0, other reductions
missing.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridspark.cube import Cube, Dims
from gridspark.functions.times import Calendar, plus, seconds, stamp
from gridspark.plans.axes import spine
from gridspark.plans.sizing import local_copy
from gridspark.plans.steps import step

REDUCTIONS = ("mean", "sum", "min", "max", "median", "std", "var", "first", "last", "count")

def _reduced(reduce: str, name: str, time: Column) -> Column:
    value = F.col(name)
    when_valid = F.when(value.isNotNull(), time)
    return {
        "mean": lambda: F.avg(value),
        "sum": lambda: F.sum(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "median": lambda: F.median(value),
        "std": lambda: F.stddev_pop(value),
        "var": lambda: F.var_pop(value),
        "first": lambda: F.min_by(value, when_valid),
        "last": lambda: F.max_by(value, when_valid),
        "count": lambda: F.count(value),
    }[reduce]()


class Bins:
    """The time bins of a frequency: ``label(time)`` and the sequence of labels between two."""

    def __init__(self, cube: Cube, dim: str, frequency: str, label: str | None, closed: str | None,
                 offset: str | None, origin: str | None) -> None:
        for value in (label, closed):
            if value not in (None, "left", "right"):
                raise ValueError("resample: label and closed are 'left' or 'right'")
        self.calendar = Calendar.of(frequency)
        ends = self.calendar is not None and self.calendar.ends
        self.label_right = (label or ("right" if ends else "left")) == "right"
        self.closed_right = (closed or ("right" if ends else "left")) == "right"
        if self.calendar is not None:
            if offset is not None or origin is not None:
                raise ValueError("resample: offset and origin are for fixed periods")
            if ends and not self.closed_right:
                raise ValueError("resample: bins named by their ends are closed on the right")
            self.first = None
            if self.calendar.count > 1:  # counted from the first stamp
                first = cube.axis(dim).agg(F.min(dim).alias("t"))
                self.first = first.select(self.calendar.unit_of(self._inside(F.col("t")))).scalar()
            return
        self.period = seconds(frequency)
        if self.period <= 0:
            raise ValueError("resample: the period is positive")
        shift = seconds(offset) if offset is not None else 0
        self.origin = plus(self._origin(cube, dim, origin or "start_day"), shift)

    def _origin(self, cube: Cube, dim: str, origin: str) -> Column:
        if origin == "epoch" or (origin == "start_day" and 86400 % self.period == 0):
            return stamp("1970-01-01")  # any midnight: no look at the data
        if origin in ("start_day", "start"):
            first = cube.axis(dim).agg(F.min(dim).alias("t"))
            return first.select(F.date_trunc("day", "t") if origin == "start_day" else F.col("t")).scalar()
        return stamp(origin)

    def _inside(self, time: Column) -> Column:
        """A stamp on a bin's right end belongs to it; days that name bins of ends belong to them whole."""
        if not self.closed_right or (self.calendar is not None and self.calendar.ends):
            return time
        return F.timestamp_micros(F.unix_micros(time) - 1)

    def start(self, time: Column) -> Column:
        """The start of the bin holding ``time``."""
        time = self._inside(time)
        if self.calendar is not None:
            unit = self.calendar.unit_of(time)
            return self.calendar.start_of(self.calendar.bin_of(unit, self.first, self.closed_right))
        since = F.unix_micros(time) - F.unix_micros(self.origin)
        return F.timestamp_micros(F.unix_micros(time) - F.pmod(since, F.lit(self.period * 1_000_000)))

    def label(self, start: Column) -> Column:
        """The label of the bin that starts at ``start``."""
        if self.calendar is not None and self.calendar.ends:  # named by a day, the last or the one before the first
            return (self._next(start) if self.label_right else start) - F.expr("INTERVAL 1 DAY")
        return self._next(start) if self.label_right else start

    @property
    def _step(self) -> str:
        if self.calendar is None:
            return f"INTERVAL {self.period} SECONDS"
        many = self.calendar.size * self.calendar.count
        return f"INTERVAL {many} {'DAYS' if self.calendar.weekly else 'MONTHS'}"

    def _next(self, start: Column) -> Column:
        return start + F.expr(self._step)

    def between(self, first: Column, last: Column) -> Column:
        """The starts of all bins from ``first`` to ``last``."""
        return F.sequence(first, last, F.expr(self._step))


def bin_table(cube: Cube, dim: str, bins: Bins) -> DataFrame:
    """``(idx, start, label, stamped)`` of every bin between the first and the last stamp; ``stamped``
    is 0 where the axis has no stamp."""
    starts = cube.axis(dim).select(bins.start(F.col(dim)).alias("start")).distinct()
    ends = starts.agg(F.min("start").alias("a"), F.max("start").alias("b")).where("a IS NOT NULL")
    every = ends.select(F.explode(bins.between(F.col("a"), F.col("b"))).alias("start"))
    marked = every.join(starts.withColumn("stamped", F.lit(1)), "start", "left")
    table = marked.select("start", bins.label(F.col("start")).alias("label"), F.coalesce("stamped", F.lit(0)).alias("stamped"))
    order = Window.orderBy("start")
    return local_copy(table).select((F.row_number().over(order) - 1).alias("idx"), "start", "label", "stamped")


@step
def resample(
    cube: Cube,
    reduce: str,
    label: str | None = None,
    closed: str | None = None,
    offset: str | None = None,
    origin: str | None = None,
    dense: bool = True,
    **kwargs: str,
) -> Cube:
    """Reduce the bins of a dimension: ``resample(cube, "mean", time="1D")``.

    Fixed periods are anchored at the midnight of the first stamp's day (or ``origin``: "start",
    "epoch", a stamp), moved by ``offset``; calendar frequencies are weeks (W, W-MON), and starts and ends of months, quarters and
    years (MS, QE, YS-JUL), each also by several ("3MS"), counted from the first stamp's. With
    ``dense=False`` only bins with rows appear. Variables without the dimension are unchanged.
    """
    if reduce not in REDUCTIONS:
        raise ValueError(f"resample: no reduction {reduce!r}: {', '.join(REDUCTIONS)}")
    if len(kwargs) != 1:
        raise ValueError("resample: give one dimension and its frequency")
    ((dim, frequency),) = kwargs.items()
    touched = [dims for dims in cube.frames if dim in dims]
    if not touched:
        raise ValueError(f"resample: no variable has the dimension {dim!r}")
    if dense:
        cube = cube.with_axes(*dict.fromkeys(d for dims in touched for d in dims))
    bins = Bins(cube, dim, frequency, label, closed, offset, origin)
    table = bin_table(cube, dim, bins) if dense else None
    out = cube
    for dims in touched:
        out = out.with_frame(dims, _resampled(cube, dims, dim, bins, reduce, table))
    axes = {d: a for d, a in out.axes.items() if d != dim}
    if table is not None:
        axes[dim] = table.select("idx", F.col("label").alias(dim))
    return replace(out, axes=axes)


def _resampled(cube: Cube, dims: Dims, dim: str, bins: Bins, reduce: str, table: DataFrame | None) -> DataFrame:
    df = cube.frames[dims]
    names = [c for c in df.columns if c not in dims]
    rest = [d for d in dims if d != dim]
    kinds = {n: df.schema[n].dataType for n in names}
    rows = df.select(*rest, bins.start(F.col(dim)).alias("__bin"), F.col(dim).alias("__t"), *names)
    if table is None:
        stamped: Column = F.lit(1)
        rows = rows.withColumn("__stamped", stamped)
    else:
        # The bins first: they are the distributed side of the spine.
        axes = [("__bin", table.select(F.col("start").alias("__bin"), "stamped"))]
        empty = axes[0][1].select("__bin", F.col("stamped").alias("__stamped"))
        for d in rest:
            empty = empty.withColumn(d, F.explode(cube.axis(d).agg(F.collect_set(d)).scalar()))
        nothing = {n: F.lit(None).cast(kind) for n, kind in kinds.items()}
        empty = empty.withColumns({"__t": F.lit(None).cast(df.schema[dim].dataType), **nothing})
        rows = rows.withColumn("__stamped", F.lit(1)).unionByName(empty)
    time = F.col("__t")
    sums = rows.groupBy(*rest, "__bin").agg(
        *(_reduced(reduce, n, time).alias(n) for n in names), F.max("__stamped").alias("__stamped")
    )

    def finished(name: str) -> Column:
        value = F.col(name)
        if reduce == "sum":
            value = F.when(F.col("__stamped") == 1, F.coalesce(value, F.lit(0)))
        if reduce != "count" and isinstance(kinds[name], T.FloatType):
            value = value.cast("float")
        return value.alias(name)

    keys = [bins.label(F.col("__bin")).alias(d) if d == dim else F.col(d) for d in dims]
    return sums.select(*keys, *(finished(n) for n in names))


@step
def mean(cube: Cube, dim: str | Iterable[str] | None = None, keep_attrs: bool = True) -> Cube:
    """The mean over one or more dimensions (default: all), missing values skipped."""
    given = [dim] if isinstance(dim, str) else (None if dim is None else list(dim))
    known = {d for dims in cube.frames for d in dims}
    if given is not None and (unknown := set(given) - known):
        raise ValueError(f"mean: no dimensions {sorted(unknown)}")
    out = replace(cube, frames={}, axes={k: v for k, v in cube.axes.items() if given is not None and k not in given})
    for dims, df in cube.frames.items():
        over = [d for d in dims if given is None or d in given]
        if not over:
            out = out.add_frame(dims, df)
            continue
        rest = tuple(d for d in dims if d not in over)
        names = [c for c in df.columns if c not in dims]
        floats = {n for n in names if isinstance(df.schema[n].dataType, T.FloatType)}
        means = [F.avg(n).cast("float").alias(n) if n in floats else F.avg(n).alias(n) for n in names]
        averaged = df.groupBy(*rest).agg(*means)
        out = out.add_frame(rest, averaged) if rest else _with_scalars(out, averaged)
    return out if keep_attrs else replace(out, attrs={}, var_attrs={})


def _with_scalars(cube: Cube, row: DataFrame) -> Cube:
    """Variables without dimensions share one one-row table."""
    if () in cube.frames:
        row = cube.frames[()].withColumns({c: row.select(c).scalar() for c in row.columns})
    return replace(cube, frames={**cube.frames, (): row})


__all__ = ["REDUCTIONS", "Bins", "bin_table", "mean", "resample", "spine"]
