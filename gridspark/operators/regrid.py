"""Regridding to a regular latitude-longitude grid.

Every method is separable, so a grid is described by one short table per axis: per target index its
label and the source labels that contribute to it, with weights. The target is regular, so the
indices a source cell overlaps come from arithmetic on its edges, not from a range join. The axis
tables are made first (one small job, see ``local_copy``), so the data tables are joined to
relations of known size, on equality, and aggregated once. Those relations grow with the axes, never
with the data. Map-side partial sums mean that one cell, level or instant with most of the rows does
not make one task heavy.

Decisions: ``nan_threshold`` is 1 by default; nearest ties go to the lower position; cubic is Keys'
cubic convolution (a = -0.5) with the edge values repeated; ties of the most (least) common value go
to the smallest value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

from gridspark.cube import Cube, Dims
from gridspark.operators.cells import area_weighted_total, area_weighted_totals, edges
from gridspark.plans.axes import by_value, spine
from gridspark.plans.sizing import local_copy
from gridspark.plans.steps import step

_SLACK = 1e-9  # of valid fractions: weights are floats
_TINY = 2.2250738585072014e-308  # fixed value: the smallest normal double

REDUCTIONS = ("sum", "mean", "min", "max", "median", "std", "var", "count")


@dataclass(frozen=True)
class TargetAxis:
    """``size`` centres every ``resolution`` degrees from ``start``; labels are 32-bit floats."""

    dim: str
    start: float
    resolution: float
    size: int
    latitude: bool

    def centre(self, k: Column) -> Column:
        """The centre of target index ``k``: its label, as a double."""
        return (F.lit(self.start) + k * F.lit(self.resolution)).cast("float").cast("double")

    def low(self, k: Column) -> Column:
        first = 2 * self.centre(F.lit(0)) - self._middle(F.lit(0))
        return self._clip(F.when(k == 0, first).otherwise(self._middle(k - 1)))

    def high(self, k: Column) -> Column:
        last = 2 * self.centre(F.lit(self.size - 1)) - self._middle(F.lit(self.size - 2))
        return self._clip(F.when(k == self.size - 1, last).otherwise(self._middle(k)))

    def _middle(self, k: Column) -> Column:
        return (self.centre(k) + self.centre(k + 1)) / 2

    def _clip(self, edge: Column) -> Column:
        return F.least(F.greatest(edge, F.lit(-90.0)), F.lit(90.0)) if self.latitude else edge


def target_grid(grid: Mapping[str, float], latitude_dim: str, longitude_dim: str) -> tuple[TargetAxis, TargetAxis]:
    """The target axes of ``{south, north, west, east, resolution_lat, resolution_lon}``, ends included."""
    names = {"south", "north", "west", "east", "resolution_lat", "resolution_lon"}
    if set(grid) != names:
        raise ValueError(f"a grid has the keys {sorted(names)}, got {sorted(grid)}")
    axes = []
    for dim, low, high, res, latitude in (
        (latitude_dim, "south", "north", "resolution_lat", True),
        (longitude_dim, "west", "east", "resolution_lon", False),
    ):
        if grid[res] <= 0 or grid[high] < grid[low]:
            raise ValueError(f"grid: {low} <= {high} and a positive {res} are needed")
        size = int(math.floor((grid[high] - grid[low]) / grid[res] + 1e-9)) + 1
        axes.append(TargetAxis(dim, float(grid[low]), float(grid[res]), size, latitude))
    return axes[0], axes[1]


def target_axis_table(cube: Cube, target: TargetAxis) -> DataFrame:
    """The axis table of a target."""
    spark = next(iter(cube.frames.values())).sparkSession
    k = F.col("id").cast("int")
    return spark.range(target.size).select(k.alias("idx"), target.centre(k).cast("float").alias(target.dim))


# -- weights: (target index k, source label, w, inside) -------------------------------------------
# ``inside`` is whether the target's centre lies within the range of the source's centres.


def _with_ends(df: DataFrame, dim: str) -> DataFrame:
    """The axis's ends beside each label (the window is the axis)."""
    whole = Window.partitionBy()
    value = F.col(dim).cast("double")
    return df.withColumns({"first": F.min(value).over(whole), "last": F.max(value).over(whole)})


def overlap_weights(cube: Cube, target: TargetAxis) -> DataFrame:
    """The share of each source cell (in degrees) in each target cell, times its extent on the sphere
    (sine of latitude, or longitude)."""
    dim = target.dim
    lo, hi = F.least("lo", "hi"), F.greatest("lo", "hi")
    first = F.greatest(F.floor((lo - target.start) / target.resolution - 0.5) - 1, F.lit(0))
    last = F.least(F.ceil((hi - target.start) / target.resolution + 0.5) + 1, F.lit(target.size - 1))
    cells = edges(cube.axis(dim), dim, target.latitude).select(dim, lo.alias("lo"), hi.alias("hi"))
    cells = _with_ends(cells, dim)
    touched = cells.where(first <= last).withColumn("k", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    overlap = F.least(F.col("hi"), target.high(F.col("k"))) - F.greatest(F.col("lo"), target.low(F.col("k")))
    low, high = F.radians("lo"), F.radians("hi")
    extent = F.sin(high) - F.sin(low) if target.latitude else high - low
    weight = F.col("overlap") / (F.col("hi") - F.col("lo")) * extent
    inside = target.centre(F.col("k")).between(F.col("first"), F.col("last"))
    overlapping = touched.withColumn("overlap", overlap).where("overlap > 0")
    return overlapping.select("k", dim, weight.alias("w"), inside.alias("inside"))


def _gaps(cube: Cube, target: TargetAxis, around: Sequence[int] = (0, 1)) -> DataFrame:
    """``(k, c, x2, x3, p2, p3)``: per target index its centre, the source labels on both sides of it in the order of
    their values (``x2`` is the last one not above the centre, ``x3`` the next) and the positions of these two.
    With ``around`` from -2 to 2 also the labels before and after them, ``x0``, ``x1`` and ``x4``.

    A gap between two labels knows by arithmetic which centres lie in it; labels meet their neighbours by
    aggregating on the place among them, so that no task or row ever holds the axis.
    """
    dim = target.dim
    placed = by_value(cube.axis(dim), dim).select(F.col("place").alias("idx"), F.col("idx").alias("p"), F.col(dim).cast("double"))
    near = [
        F.struct((F.col("idx") - by).alias("at"), F.lit(by).alias("by"), F.col(dim).alias("x"), F.col("p"))
        for by in around
    ]
    labels = [F.max(F.when(F.col("by") == by, F.col("x"))).alias(f"x{by + 2}") for by in around]
    positions = [F.max(F.when(F.col("by") == by, F.col("p"))).alias(f"p{by + 2}") for by in (0, 1)]
    gaps = placed.select(F.inline(F.array(*near))).groupBy("at").agg(*labels, *positions)

    def place(x: str) -> Column:
        return (F.col(x) - target.start) / target.resolution

    first = F.greatest(F.coalesce(F.floor(place("x2")) - 1, F.lit(0)), F.lit(0))
    last = F.least(F.coalesce(F.ceil(place("x3")) + 1, F.lit(target.size - 1)), F.lit(target.size - 1))
    met = gaps.where(F.coalesce("x2", "x3").isNotNull() & (first <= last))
    centred = met.withColumn("k", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    centred = centred.withColumn("c", target.centre(F.col("k")))
    return centred.where("(x2 IS NULL OR x2 <= c) AND (x3 IS NULL OR c < x3)").drop("at")


_INSIDE = "x2 IS NOT NULL AND (x3 IS NOT NULL OR x2 = c)"


def nearest_weights(cube: Cube, target: TargetAxis) -> DataFrame:
    """The nearest source label of each target index; ties go to the lower position."""
    low = F.expr("x3 IS NULL OR c - x2 < x3 - c OR (c - x2 = x3 - c AND p2 < p3)")
    label = F.when(F.col("x2").isNotNull() & low, F.col("x2")).otherwise(F.col("x3"))
    return _gaps(cube, target).select("k", label.alias(target.dim), F.lit(1.0).alias("w"), F.expr(_INSIDE).alias("inside"))


def linear_weights(cube: Cube, target: TargetAxis) -> DataFrame:
    """The source labels on both sides of each target centre; none of weight 0."""
    dim = target.dim
    share = F.when(F.col("c") == F.col("x2"), F.lit(0.0)).otherwise(F.expr("(c - x2) / (x3 - x2)"))
    pair = F.array(
        F.struct(F.col("x2").alias(dim), (1 - share).alias("w")), F.struct(F.col("x3").alias(dim), share.alias("w"))
    )
    table = _gaps(cube, target).where(_INSIDE)
    return table.select("k", F.inline(F.filter(pair, lambda p: p["w"] > 0))).withColumn("inside", F.lit(True))


def cubic_weights(cube: Cube, target: TargetAxis) -> DataFrame:
    """Keys' four-point weights (a = -0.5), positions clamped to the axis; none of weight 0. Centres from the last
    label on are described by the last two labels."""
    dim = target.dim
    over = F.col("x3").isNull()
    left, right = F.when(over, F.col("x1")).otherwise(F.col("x2")), F.when(over, F.col("x2")).otherwise(F.col("x3"))
    before = F.coalesce(F.when(over, F.col("x0")).otherwise(F.col("x1")), left)
    after = F.coalesce(F.when(~over, F.col("x4")), right)
    table = _gaps(cube, target, range(-2, 3)).where(left.isNotNull() & right.isNotNull())
    table = table.withColumn("t", (F.col("c") - left) / (right - left))
    t = F.col("t")
    four = (
        (before, -0.5 * t + t * t - 0.5 * t * t * t),
        (left, 1 - 2.5 * t * t + 1.5 * t * t * t),
        (right, 0.5 * t + 2 * t * t - 1.5 * t * t * t),
        (after, -0.5 * t * t + 0.5 * t * t * t),
    )
    points = F.array(*(F.struct(label.alias(dim), value.alias("w")) for label, value in four))
    return (
        table.select("k", F.expr(_INSIDE).alias("inside"), F.inline(points))
        .groupBy("k", dim)
        .agg(F.sum("w").alias("w"), F.first("inside").alias("inside"))
        .where(F.abs("w") > 1e-14)
    )


def point_weights(cube: Cube, target: TargetAxis) -> DataFrame:
    """The target index of each source label: the cell holding its centre; an edge goes up."""
    first = target.start - target.resolution / 2
    k = F.floor((F.col(target.dim).cast("double") - F.lit(first)) / F.lit(target.resolution)).cast("int")
    keyed = _with_ends(cube.axis(target.dim), target.dim).withColumn("k", k).where(F.col("k").between(0, target.size - 1))
    inside = target.centre(F.col("k")).between(F.col("first"), F.col("last"))
    return keyed.select("k", target.dim, F.lit(1.0).alias("w"), inside.alias("inside"))


# -- applying them ------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Horizontal:
    """A target axis as applied to one table: ``targets`` has one row per target index, with its
    label, whether results there are shown, and the source labels that contribute, weighted."""

    target: TargetAxis
    key: str
    weight: str
    targets: DataFrame
    kind: DataType

    @property
    def dim(self) -> str:
        return self.target.dim

    @property
    def weights(self) -> DataFrame:
        """``(source label, key, weight)``."""
        named = self.targets.select(F.col("k").alias(self.key), F.inline("sources"))
        return named.select(self.key, F.col("source").cast(self.kind).alias(self.dim), F.col("w").alias(self.weight))

    @property
    def labels(self) -> DataFrame:
        """``(key, label, inside, total weight, number of contributions)``."""
        total = F.aggregate("sources", F.lit(0.0), lambda s, x: s + x["w"])
        return self.targets.select(
            F.col("k").alias(self.key),
            F.col("label").alias(self.dim),
            F.col("inside").alias(f"__in{self.key}"),
            total.alias(f"__W{self.key}"),
            F.size("sources").alias(f"__N{self.key}"),
        )


def axis_targets(cube: Cube, targets: Sequence[TargetAxis], method: str) -> list[DataFrame]:
    """Per target axis ``(k, label, inside, sources)``; one small job makes all of them. Targets nothing
    contributes to have no sources and are not inside."""
    parts = []
    for number, target in enumerate(targets):
        rows = _WEIGHTS[method](cube, target).withColumnRenamed(target.dim, "source")
        found = rows.select("k", F.col("source").cast("double").alias("source"), "w", "inside")
        spark = found.sparkSession
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields[1:]]
        every = found.unionByName(spark.range(target.size).select(F.col("id").cast("int").alias("k"), *nothing))
        label = target.centre(F.col("k")).cast("float").alias("label")
        parts.append(every.select(F.lit(number).alias("axis"), "k", label, "source", "w", "inside"))
    contribution = F.when(F.col("source").isNotNull(), F.struct("source", "w"))
    merged = reduce(DataFrame.unionByName, parts).groupBy("axis", "k", "label").agg(
        F.coalesce(F.bool_or("inside"), F.lit(False)).alias("inside"), F.collect_list(contribution).alias("sources")
    )
    table = local_copy(merged)
    return [table.where(F.col("axis") == number).drop("axis") for number in range(len(parts))]


def _joined(df: DataFrame, parts: list[_Horizontal]) -> DataFrame:
    for part in parts:
        df = df.join(part.weights, part.dim).drop(part.dim)
    return df


def _product(columns: list[Column]) -> Column:
    out = columns[0]
    for column in columns[1:]:
        out = out * column
    return out


def _described(df: DataFrame, parts: list[_Horizontal]) -> DataFrame:
    """Labels and totals of the targets for their indices."""
    for part in parts:
        df = df.join(part.labels, part.key)
    return df


def _shown(df: DataFrame, parts: list[_Horizontal], dims: Dims, names: list[str], blank: Column) -> DataFrame:
    """The result by label; outside the range of source centres it is ``blank``."""
    inside: Column = F.lit(True)
    for part in parts:
        inside = inside & F.col(f"__in{part.key}")
    return df.select(*dims, *(F.when(inside, F.col(n)).otherwise(blank).alias(n) for n in names))


def _empty_targets(cube: Cube, dims: Dims, parts: list[_Horizontal], columns: Mapping[str, Column]) -> DataFrame:
    """One row per target cell and index of the other dimensions, for results defined without data."""
    spark = next(iter(cube.frames.values())).sparkSession
    short = {part.dim: part for part in parts}
    axes = [(d, cube.axis(d)) for d in dims if d not in short]
    for part in parts:
        axis = spark.range(part.target.size).select(F.col("id").cast("int").alias(part.key))
        axes.append((part.key, axis))
    return spine(axes).withColumns(dict(columns))


def _weighted(
    cube: Cube, dims: Dims, names: list[str], parts: list[_Horizontal], method: str, options: Mapping[str, Any]
) -> DataFrame:
    """Weighted means (conservative) or sums (linear, cubic) of the contributions."""
    rest = [d for d in dims if d not in {p.dim for p in parts}]
    keys = [p.key for p in parts]
    w = _product([F.col(p.weight) for p in parts])
    source = _joined(cube.frames[dims].select(*dims, *names), parts).withColumn("__w", w)
    source = source.select(*rest, *keys, "__w", *names)
    skipna = bool(options.get("skipna", True))
    if method == "conservative" and not skipna:
        kinds = {n: source.schema[n].dataType for n in names}
        empty = {"__w": F.lit(0.0), **{n: F.lit(None).cast(k) for n, k in kinds.items()}}
        source = source.unionByName(_empty_targets(cube, dims, parts, empty))
    valid = {n: F.when(F.col(n).isNotNull(), F.col("__w")) for n in names}
    sums = source.groupBy(*rest, *keys).agg(
        *(F.sum(F.col("__w") * F.col(n)).alias(n) for n in names),
        *(F.sum(valid[n]).alias(f"__w_{n}") for n in names),
        *(F.count(F.col(n)).alias(f"__n_{n}") for n in names),
    )
    sums = _described(sums, parts)
    whole = _product([F.col(f"__W{p.key}") for p in parts])
    count = _product([F.col(f"__N{p.key}") for p in parts])
    results = {}
    for n in names:
        total, share = F.col(n), F.col(f"__w_{n}")
        if method != "conservative":
            results[n] = F.when(F.col(f"__n_{n}") == count, total)
        elif skipna:
            needed = 1.0 - float(options.get("nan_threshold", 1.0)) - _SLACK
            results[n] = F.when((share > 0) & (share / whole >= needed), total / share)
        else:
            results[n] = F.when(whole > 0, F.coalesce(total, F.lit(0.0)) / whole)
    return sums.withColumns(results)


def stat_aggregate(method: str, value: Column) -> Column:
    """The aggregate of a reduction over the values that are not missing (population spread)."""
    made = {
        "sum": lambda v: F.coalesce(F.sum(v), F.lit(0.0)),
        "mean": F.avg,
        "min": F.min,
        "max": F.max,
        "median": F.median,
        "std": F.stddev_pop,
        "var": F.var_pop,
        "count": lambda v: F.count(v).cast("double"),
    }
    if method not in made:
        raise ValueError(f"no reduction {method!r}: {', '.join(made)}")
    return made[method](value)


def _stat(
    cube: Cube, dims: Dims, names: list[str], parts: list[_Horizontal], options: Mapping[str, Any]
) -> DataFrame:
    method, skipna = options.get("method", "mean"), bool(options.get("skipna", False))
    fill = options.get("fill_value")
    rest = [d for d in dims if d not in {p.dim for p in parts}]
    keys = [p.key for p in parts]
    source = _joined(cube.frames[dims].select(*dims, *names), parts).select(*rest, *keys, *names)
    kinds = {n: source.schema[n].dataType for n in names}
    source = source.unionByName(
        _empty_targets(cube, dims, parts, {n: F.lit(None).cast(k) for n, k in kinds.items()})
    )
    sums = source.groupBy(*rest, *keys).agg(
        *(stat_aggregate(method, F.col(n)).alias(n) for n in names),
        *(F.count(n).alias(f"__n_{n}") for n in names),
    )
    sums = _described(sums, parts)
    points = _product([F.col(f"__N{p.key}") for p in parts])
    results = {}
    for n in names:
        value = F.col(n).cast("double")
        if not skipna:
            value = F.when(F.col(f"__n_{n}") == points, value)
        results[n] = F.when(points > 0, value).otherwise(F.lit(fill).cast("double"))
    return sums.withColumns(results)


def _common(
    cube: Cube, dims: Dims, names: list[str], parts: list[_Horizontal], least: bool
) -> DataFrame:
    """Per target cell the most (least) common value. Values are counted first, so the second
    aggregation sees one row per distinct value however many rows a cell holds."""
    rest = [d for d in dims if d not in {p.dim for p in parts}]
    keys = [*rest, *(p.key for p in parts)]
    source = _joined(cube.frames[dims].select(*dims, *names), parts)
    out = None
    for n in names:
        counts = source.where(F.col(n).isNotNull()).groupBy(*keys, n).agg(F.count(F.lit(1)).alias("__n"))
        rank = F.col("__n") if least else -F.col("__n")
        best = counts.groupBy(*keys).agg(F.min(F.struct(rank.alias("r"), F.col(n).alias("v")))["v"].alias(n))
        out = best if out is None else out.join(best, keys, "full")
    return out


_WEIGHTS = {
    "conservative": overlap_weights,
    "linear": linear_weights,
    "cubic": cubic_weights,
    "nearest": nearest_weights,
    "stat": point_weights,
    "most_common": point_weights,
    "least_common": point_weights,
}


def _regridded(cube: Cube, dims: Dims, parts: list[_Horizontal], method: str, options: Mapping[str, Any]) -> DataFrame:
    names = [c for c in cube.frames[dims].columns if c not in dims]
    parts = [part for part in parts if part.dim in dims]
    blank: Column = F.lit(None)
    if method in ("conservative", "linear", "cubic"):
        df = _weighted(cube, dims, names, parts, method, options)
    elif method == "nearest":
        df = _described(_joined(cube.frames[dims], parts), parts)
    elif method == "stat":
        df = _stat(cube, dims, names, parts, options)
        blank = F.lit(options.get("fill_value")).cast("double")
    else:
        df = _described(_common(cube, dims, names, parts, method == "least_common"), parts)
    return _shown(df, parts, dims, names, blank)


@step
def regrid(
    cube: Cube,
    grid: Mapping[str, float],
    latitude_dim: str = "latitude",
    longitude_dim: str = "longitude",
    method: str = "nearest",
    kwargs: Mapping[str, Any] | None = None,
    conservation_tolerance: float | None = None,
) -> Cube:
    """Regrid to a regular grid; variables without a horizontal dimension pass unchanged.

    ``conservative``: overlap-weighted means; ``kwargs.skipna = false`` counts missing cells as 0,
    ``true`` averages the valid part of a target cell and blanks it where that is below
    ``1 - nan_threshold``. ``stat`` (``kwargs.method``, ``skipna``, ``fill_value``): each source point
    goes to the cell containing its centre. ``linear`` and ``cubic`` need every neighbour of weight
    above 0. Target cells whose centre lies outside the range of source centres are blank.
    """
    options = {k: v for k, v in (kwargs or {}).items() if k != "output_chunks"}
    if method not in _WEIGHTS:
        raise ValueError(f"regrid: no method {method!r}: {', '.join(_WEIGHTS)}")
    if conservation_tolerance is not None and (method != "conservative" or options.get("skipna", True)):
        raise ValueError("conservation_tolerance needs method = 'conservative' and kwargs.skipna = false")
    targets = target_grid(grid, latitude_dim, longitude_dim)
    horizontal = {latitude_dim, longitude_dim}
    touched = [dims for dims in cube.frames if horizontal & set(dims)]
    used = {d for dims in touched for d in dims}
    # Results without data (missing as 0, fill values) need every label of the other dimensions.
    dense = method == "stat" or (method == "conservative" and not options.get("skipna", True))
    cube = cube.with_axes(*(d for d in used if dense or d in horizontal))
    touching = [(t, key, w) for t, key, w in zip(targets, ("__i", "__j"), ("__u", "__v"), strict=True) if t.dim in used]
    tables = axis_targets(cube, [t for t, _, _ in touching], method) if touching else []
    parts = [
        _Horizontal(t, key, w, table, cube.axis(t.dim).schema[t.dim].dataType)
        for (t, key, w), table in zip(touching, tables, strict=True)
    ]
    frames = {d: _regridded(cube, d, parts, method, options) if d in touched else df for d, df in cube.frames.items()}
    axes = {**cube.axes, **{t.dim: target_axis_table(cube, t) for t in targets}}
    out = replace(cube, frames=frames, axes=axes)
    if conservation_tolerance is not None:
        for dims in touched:
            if horizontal <= set(dims):
                out = _conserving(cube, out, dims, conservation_tolerance, latitude_dim, longitude_dim)
    return out


def conservation_report(
    source: Cube, target: Cube, variable: str, tolerance: float, latitude_dim: str, longitude_dim: str
) -> DataFrame:
    """Per index of the other dimensions, the totals before and after, their relative change and
    whether it is within ``tolerance``."""
    before = area_weighted_total(source, variable, latitude_dim, longitude_dim, "source_total")
    after = area_weighted_total(target, variable, latitude_dim, longitude_dim, "target_total")
    rest = [d for d in source.dims_of(variable) if d not in (latitude_dim, longitude_dim)]
    both = before.join(after, rest, "full") if rest else before.withColumn(
        "target_total", after.select("target_total").scalar()
    )
    # A combination without rows is missing: its total is 0.
    both = both.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("source_total", "target_total")})
    scale = F.greatest(F.abs("source_total"), F.lit(_TINY))
    change = F.abs(F.col("target_total") - F.col("source_total")) / scale
    return both.withColumn("change", change).withColumn("conserved", F.col("change") <= tolerance)


def _conserving(
    source: Cube, target: Cube, dims: Dims, tolerance: float, latitude_dim: str, longitude_dim: str
) -> Cube:
    """``target`` whose variables raise when computed if their totals differ from the source's.

    Totals are sums over each index of the other dimensions, of all variables at once: one aggregation of the source,
    one of the result itself, both with partial sums before their shuffle. They meet in a table with a row per index,
    which the result is joined with. The two readers of the result share the exchange of its aggregation.
    """
    horizontal = (latitude_dim, longitude_dim)
    rest = [d for d in dims if d not in horizontal]
    df = target.frames[dims]
    names = [c for c in df.columns if c not in dims]
    before = area_weighted_totals(source, dims, {n: f"__before_{n}" for n in names}, *horizontal)
    after = area_weighted_totals(target, dims, {n: f"__after_{n}" for n in names}, *horizontal)
    totals = _beside(after, before, rest)
    checked = totals.select(*rest, *(_check(n, tolerance).alias(f"__change_{n}") for n in names))
    joined = _beside(df, checked, rest)
    for name in names:
        message = F.concat(
            F.lit(f"regrid: the total of {name!r} changed by "),
            F.col(f"__change_{name}").cast("string"),
            F.lit(f" (relative), more than the conservation_tolerance {tolerance:g}"),
        )
        failed = F.raise_error(message).cast(df.schema[name].dataType)
        joined = joined.withColumn(name, F.when(F.col(f"__change_{name}").isNull(), F.col(name)).otherwise(failed))
    return target.with_frame(dims, joined.select(*df.columns))


def _beside(df: DataFrame, short: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the columns of ``short`` by ``keys``; without keys ``short`` is one row of totals."""
    if keys:
        return df.join(short, keys, "left")
    return df.withColumns({c: short.select(c).scalar() for c in short.columns})


def _check(name: str, tolerance: float) -> Column:
    """The relative change of a total if it is beyond the tolerance, else null."""
    before, after = (F.coalesce(f"__{when}_{name}", F.lit(0.0)) for when in ("before", "after"))
    change = F.abs(after - before) / F.greatest(F.abs(before), F.lit(_TINY))
    return F.when(~(change <= tolerance), change)


def grid_axes(cube: Cube, grid: Mapping[str, float], latitude_dim: str, longitude_dim: str) -> tuple[DataFrame, DataFrame]:
    """The axis tables of a target grid, with 32-bit labels."""
    lat, lon = target_grid(grid, latitude_dim, longitude_dim)
    return target_axis_table(cube, lat), target_axis_table(cube, lon)


__all__ = ["conservation_report", "grid_axes", "regrid", "target_grid"]
