"""Periodic climatology and the spread of its anomalies.

Values are folded into the bins of a period, per cell: count, mean and sum of squared deviations
(``n``, ``mean``, ``m2``), which merge, so that map tasks shuffle one row per cell and bin. The window
then pools neighbouring bins, wrapping around the period. The statistics of a cell become one array,
the ring of its bins (``period`` of them, whatever the length of the series), and a window of equal weights
is put together from spans of 1, 2, 4, ... bins: the ring is merged with itself, turned. Unequal weights
multiply the statistics by the window, within the partitioning by cell.

With ``V1 = sum w n`` and ``V2 = sum w^2 n`` over a window, the climatology is ``c = sum w n mean / V1``
and the variance ``sum w (n (mean - c)^2 + m2) / (V1 - V2 / V1)``: unbiased for reliability weights,
missing when the denominator is not positive. Squared deviations are taken from means, never from sums of squares.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridspark.cube import Cube, Dims
from gridspark.functions.times import day_of_year_bin, stamp
from gridspark.functions.windows import window as window_of
from gridspark.plans.axes import spine
from gridspark.plans.sizing import broadcast_checked

BIN = "bin"


def reference_period(
    cube: Cube, start: str | datetime.datetime, end: str | datetime.datetime, time_dim: str = "time"
) -> Cube:
    """The cube over ``[start, end)``; an empty period is an error."""
    from gridspark.sources.parts import time_sel

    out = time_sel(cube, start, end, time_dim)
    if all(not df.limit(1).count() for dims, df in out.frames.items() if time_dim in dims):
        raise ValueError(f"reference_period: no stamps in [{start}, {end})")
    return out


def time_bins(cube: Cube, period: int, bins: str = "position", time_dim: str = "time") -> DataFrame:
    """``(time, bin)`` of every stamp of the axis, checked.

    ``position``: step k falls in bin ``k % period``; the number of steps is a multiple of the
    period. ``day_of_year``: the day of a 365-day year (period 365, at most one step per day).
    """
    if period < 1:
        raise ValueError(f"a period has at least one bin, got {period}")
    axis = cube.axis(time_dim)
    if bins == "position":
        size = axis.count()
        if size % period:
            raise ValueError(
                f"position bins need a whole number of periods ({size} steps, period {period}):"
                " use day_of_year bins for daily data"
            )
        return axis.select(time_dim, F.pmod(F.col("idx"), F.lit(period)).cast("int").alias(BIN))
    if bins != "day_of_year":
        raise ValueError(f"bins are 'position' or 'day_of_year', not {bins!r}")
    if period != 365:
        raise ValueError(f"day_of_year bins need period = 365, got {period}")
    days = axis.groupBy(F.to_date(time_dim).alias("day")).count().where("count > 1")
    if days.limit(1).count():
        raise ValueError("day_of_year bins need at most one time step per day")
    return axis.select(time_dim, day_of_year_bin(F.col(time_dim)).alias(BIN))


def binned(cube: Cube, dims: Dims, period: int, bins: str, time_dim: str) -> DataFrame:
    """The table with its bin instead of its time. Days of the year come from the stamp itself;
    positions from a join with the axis."""
    table = time_bins(cube, period, bins, time_dim)
    df = cube.frames[dims]
    if bins == "day_of_year":
        return df.withColumn(BIN, day_of_year_bin(F.col(time_dim)))
    return df.join(broadcast_checked(table), time_dim)


def _moments(value: str) -> list[Column]:
    n = F.count(value)
    return [n.alias("n"), F.avg(value).alias("mean"), F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias("m2")]


def bin_statistics(
    cube: Cube, variable: str, period: int, bins: str = "position", time_dim: str = "time", dense: bool = True
) -> DataFrame:
    """``(cell dims, bin, n, mean, m2)`` of a variable; with ``dense`` every cell has all bins."""
    dims = cube.dims_of(variable)
    if time_dim not in dims:
        raise ValueError(f"{variable!r} has no dimension {time_dim!r}")
    cube = cube.with_axes(*(dims if dense else [time_dim]))
    cell = [d for d in dims if d != time_dim]
    value = F.col(variable).cast("double").alias(variable)
    rows = binned(cube, dims, period, bins, time_dim).select(*cell, BIN, value)
    if dense:
        rows = rows.unionByName(_every_bin(cube, cell, period).withColumn(variable, F.lit(None).cast("double")))
    return rows.groupBy(*cell, BIN).agg(*_moments(variable))


def _every_bin(cube: Cube, cell: Iterable[str], period: int) -> DataFrame:
    spark = next(iter(cube.frames.values())).sparkSession
    numbers = spark.range(period).select(F.col("id").cast("int").alias(BIN))
    return spine([(BIN, numbers), *((d, cube.axis(d)) for d in cell)])


def combine_statistics(a: DataFrame, b: DataFrame, cell: Iterable[str]) -> DataFrame:
    """The statistics of the union of two samples, bin by bin: stored statistics are refreshed with
    those of new blocks only."""
    keys = [*cell, BIN]
    left = a.select(*keys, *(F.col(c).alias(f"{c}_a") for c in ("n", "mean", "m2")))
    right = b.select(*keys, *(F.col(c).alias(f"{c}_b") for c in ("n", "mean", "m2")))
    both = left.join(right, keys, "full").select(
        *keys,
        *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_a", "n_b")),
        *(F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("mean_a", "mean_b", "m2_a", "m2_b")),
    )
    n = F.col("n_a") + F.col("n_b")
    delta = F.col("mean_b") - F.col("mean_a")
    mean = F.col("mean_a") + delta * F.col("n_b") / n
    m2 = F.col("m2_a") + F.col("m2_b") + delta * delta * F.col("n_a") * F.col("n_b") / n
    return both.select(
        *keys,
        n.alias("n"),
        F.when(n > 0, mean).alias("mean"),
        F.when(n > 0, m2).otherwise(F.lit(0.0)).alias("m2"),
    )


def pooled(
    statistics: DataFrame,
    cell: Iterable[str],
    period: int,
    window: int = 1,
    weighting: str = "constant",
    weighting_scale: float | None = None,
) -> DataFrame:
    """``(cell dims, bin, climatology, anomaly_variance, anomaly_std)`` from bin statistics, one row per
    cell and bin. Bins whose window holds no value are missing: as nulls, or, if the statistics have no row at all
    in the window, without a row where weights are unequal."""
    cell = list(cell)
    offsets = window_of(window, weighting, weighting_scale)
    if len(offsets) == 1:  # a bin pools itself, row by row
        alone = _weighed(F.struct("n", "mean", "m2"), F.lit(offsets[0][1]))
        return _spread(statistics.select(*cell, BIN, alone.alias("s")), cell)
    if len({w for _, w in offsets}) > 1:
        return _by_rows(statistics, cell, period, offsets)
    rows = F.collect_list(F.struct(BIN, "n", "mean", "m2"))
    rings = (statistics.groupBy(*cell) if cell else statistics.groupBy()).agg(rows.alias("rows"))
    rings = rings.where(F.size("rows") > 0).select(*cell, _ring(F.col("rows"), period).alias("ring"))
    folded = rings.select(*cell, _doubled(F.col("ring"), period, offsets).alias("ring"))
    return _spread(folded.select(*cell, F.posexplode("ring").alias(BIN, "s")), cell)


def _by_rows(statistics: DataFrame, cell: list[str], period: int, offsets: list[tuple[int, float]]) -> DataFrame:
    """Windows of unequal weights: each bin's statistics go to every bin whose window it lies in, within the
    partitioning by cell. Compiled row by row this takes a quarter of the time of folding arrays by lambdas."""
    by_cell = statistics.repartition(*cell) if cell else statistics
    pairs = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in offsets))
    spread = by_cell.select("*", F.explode(pairs).alias("o")).select(
        *cell,
        F.pmod(F.col(BIN) - F.col("o.k"), F.lit(period)).cast("int").alias(BIN),
        F.col("o.w").alias("w"),
        "n",
        "mean",
        "m2",
    )
    one = Window.partitionBy(*cell, BIN)
    n, w = F.col("n"), F.col("w")
    centred = spread.withColumns(
        {"V1": F.sum(w * n).over(one), "S": F.sum(F.when(n > 0, w * n * F.col("mean"))).over(one)}
    ).withColumn("c", F.when(F.col("V1") > 0, F.col("S") / F.col("V1")))
    deviation = F.col("mean") - F.col("c")
    squares = F.when(n > 0, w * (deviation * deviation * n + F.col("m2")))
    sums = centred.groupBy(*cell, BIN).agg(
        F.struct(
            F.max("V1").alias("v1"), F.sum(w * w * n).alias("v2"), F.max("c").alias("mean"), F.sum(squares).alias("q")
        ).alias("s")
    )
    return _spread(sums, cell)


def _no_values() -> list[Column]:
    """A bin without values, as statistics."""
    return [F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")]


def _ring(rows: Column, period: int) -> Column:
    """The statistics of a cell in the order of its bins, those it has no row for included."""
    absent = F.array_except(F.sequence(F.lit(0), F.lit(period - 1)), F.transform(rows, lambda r: r[BIN]))
    blank = F.transform(absent, lambda b: F.struct(b.alias(BIN), *_no_values()))
    ordered = F.array_sort(F.concat(rows, blank.cast(f"array<struct<{BIN}:int,n:bigint,mean:double,m2:double>>")))
    return F.transform(ordered, lambda r: F.struct(r["n"].alias("n"), r["mean"].alias("mean"), r["m2"].alias("m2")))


def _turned(ring: Column, k: Column, period: int) -> Column:
    """The ring from its bin ``k`` on, and the bins before it after that."""
    return F.concat(F.slice(ring, k + 1, F.lit(period) - k), F.slice(ring, F.lit(1), k))


def _weighed(bin_: Column, w: Column) -> Column:
    """A bin's statistics as sums that merge: weights, squared weights, the mean, squares around it."""
    n = bin_["n"].cast("double")
    some = n > 0
    return F.struct(
        (w * n).alias("v1"),
        (w * w * n).alias("v2"),
        F.when(some, bin_["mean"]).otherwise(0.0).alias("mean"),
        F.when(some, w * bin_["m2"]).otherwise(0.0).alias("q"),
    )


def _merged(a: Column, b: Column) -> Column:
    """The sums of two samples together. Nothing is subtracted but means, so no digits cancel."""
    total = a["v1"] + b["v1"]
    share = F.when(total > 0, b["v1"] / total).otherwise(0.0)
    delta = b["mean"] - a["mean"]
    return F.struct(
        total.alias("v1"),
        (a["v2"] + b["v2"]).alias("v2"),
        (a["mean"] + delta * share).alias("mean"),
        (a["q"] + b["q"] + delta * delta * a["v1"] * share).alias("q"),
    )


def _doubled(ring: Column, period: int, offsets: list[tuple[int, float]]) -> Column:
    """Windows of equal weights: spans of 1, 2, 4, ... bins, each from two of half the length, and the
    window put together from the spans in its size. The steps grow with the logarithm of the window."""
    first, weight = offsets[0]
    steps, taken = [], 0
    for bit in range(len(offsets).bit_length()):
        has = bool(len(offsets) >> bit & 1)
        at, on = (first + taken) % period, (1 << bit) % period
        steps.append(F.struct(F.lit(has).alias("has"), F.lit(at).alias("at"), F.lit(on).alias("on")))
        taken += has << bit
    nothing = F.transform(ring, lambda _: _weighed(F.struct(*_no_values()), F.lit(1.0)))
    state = F.struct(F.transform(ring, lambda b: _weighed(b, F.lit(weight))).alias("span"), nothing.alias("whole"))

    def further(done: Column, o: Column) -> Column:
        span, whole = done["span"], done["whole"]
        longer = F.zip_with(span, _turned(span, o["on"], period), _merged)
        more = F.zip_with(whole, _turned(span, o["at"], period), _merged)
        return F.struct(longer.alias("span"), F.when(o["has"], more).otherwise(whole).alias("whole"))

    return F.aggregate(F.array(*steps), state, further, lambda done: done["whole"])


def _spread(table: DataFrame, cell: list[str]) -> DataFrame:
    """The results from the merged sums ``s`` of each cell and bin."""
    v1, v2, q = (F.col("s")[c] for c in ("v1", "v2", "q"))
    freedom = F.when(v1 > 0, v1 - v2 / v1)
    variance = F.when(freedom > 0, q / freedom)
    return table.select(
        *cell,
        F.col(BIN).cast("int").alias(BIN),
        F.when(v1 > 0, F.col("s")["mean"]).alias("climatology"),
        variance.alias("anomaly_variance"),
        F.sqrt(F.when(variance < 0, 0.0).otherwise(variance)).alias("anomaly_std"),
    )


def compute_climatology(
    cube: Cube,
    period: int,
    window: int = 1,
    weighting: str = "constant",
    weighting_scale: float | None = None,
    bins: str = "position",
    time_dim: str = "time",
    variables: Iterable[str] | None = None,
) -> dict[str, Cube]:
    """The groups ``climatology`` and ``anomaly_std``: cubes whose ``time`` axis is the bins
    ``0 .. period - 1``. Variables without the time dimension are left out."""
    names = [n for n in (variables or cube.variables) if time_dim in cube.dims_of(n)]
    if not names:
        raise ValueError(f"no variable has the dimension {time_dim!r}")
    cube = cube.with_axes(*dict.fromkeys(d for n in names for d in cube.dims_of(n)))
    spark = next(iter(cube.frames.values())).sparkSession
    axis = spark.range(period).select(F.col("id").cast("int").alias("idx"), F.col("id").cast("int").alias(time_dim))
    axes = {**{k: v for k, v in cube.axes.items() if k != time_dim}, time_dim: axis}
    groups = {group: Cube({}, axes, cube.attrs, cube.var_attrs) for group in ("climatology", "anomaly_std")}
    for name in names:
        dims = cube.dims_of(name)
        cell = [d for d in dims if d != time_dim]
        kind = cube.frames[dims].schema[name].dataType.simpleString()
        kind = kind if kind in ("float", "double") else "double"
        table = pooled(bin_statistics(cube, name, period, bins, time_dim), cell, period, window, weighting, weighting_scale)
        for group in groups:
            columns = [F.col(BIN).alias(d) if d == time_dim else F.col(d) for d in dims]
            groups[group] = groups[group].add_frame(dims, table.select(*columns, F.col(group).cast(kind).alias(name)))
    return groups


def anomalies(
    cube: Cube,
    variable: str,
    statistics: DataFrame,
    period: int,
    bins: str = "position",
    time_dim: str = "time",
    standardized: bool = False,
) -> DataFrame:
    """Values minus their bin's ``climatology`` (over ``anomaly_std`` if ``standardized``; missing
    where that is 0). ``statistics`` is the table of ``pooled``, one row per cell and bin: an equi-join
    with a few years' rows per key, whose strategy is left to the sizes seen at run time."""
    dims = cube.dims_of(variable)
    cube = cube.with_axes(time_dim)
    cell = [d for d in dims if d != time_dim]
    rows = binned(cube, dims, period, bins, time_dim).select(*dims, BIN, variable)
    joined = rows.join(statistics, [*cell, BIN], "left")
    anomaly = F.col(variable) - F.col("climatology")
    if standardized:
        anomaly = F.when(F.col("anomaly_std") > 0, anomaly / F.col("anomaly_std"))
    return joined.select(*dims, anomaly.alias("anomaly"))


def with_bins(cube: Cube, period: int, bins: str = "position", time_dim: str = "time") -> Cube:
    """The cube with each stamp's bin as an auxiliary coordinate of the time axis."""
    axis = cube.axis(time_dim).join(time_bins(cube, period, bins, time_dim), time_dim)
    return replace(cube, axes={**cube.axes, time_dim: axis})


__all__ = ["anomalies", "bin_statistics", "combine_statistics", "compute_climatology", "pooled", "reference_period", "stamp"]
