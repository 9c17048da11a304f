"""Forecast runs: (initialization, lead time) tables built from series and from sources of runs.

Leads are whole seconds; ``valid_time = init_time + lead_time``. Runs start on a regular grid, so the
runs a stamp belongs to come from arithmetic: no range join of the series with the runs.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.cube import Cube
from gridspark.functions.times import plus, seconds, stamp
from gridspark.plans.axes import spine
from gridspark.plans.sizing import local_copy

Instant = str | datetime.datetime
Duration = str | datetime.timedelta


@dataclass(frozen=True)
class Forecast:
    """Leads ``[0, horizon)``, a run every ``every``; ``window`` runs are kept (all by default); a run
    younger than ``missing_after`` may still be published."""

    horizon: Duration
    every: Duration = "1D"
    window: int | None = None
    missing_after: Duration | None = None
    init_dim: str = "init_time"
    lead_dim: str = "lead_time"
    valid_coord: str = "valid_time"

    def __post_init__(self) -> None:
        for name in ("horizon", "every"):
            if seconds(getattr(self, name)) <= 0:
                raise ValueError(f"{name} must be positive")
        if self.window is not None and self.window < 1:
            raise ValueError("a window holds at least one run")

    def runs(self, spark: SparkSession, start: Instant, end: Instant) -> DataFrame:
        """``(init_time, run_end)`` of ``[start, end)``, which is a whole number of runs."""
        by = seconds(self.every)
        low, high = stamp(start), stamp(end)
        span = F.unix_seconds(high) - F.unix_seconds(low)
        ends = spark.range(1).select(low.alias("a"), high.alias("b"), F.pmod(span, F.lit(by)).alias("rest"))
        if ends.where("rest <> 0").count():
            raise ValueError(f"[{start}, {end}) is not a whole number of runs every {self.every}")
        inits = ends.where("a < b").select(F.explode(F.sequence("a", plus(F.col("b"), -by), F.expr(f"INTERVAL {by} SECONDS"))).alias(self.init_dim))
        return inits.select(self.init_dim, plus(F.col(self.init_dim), seconds(self.horizon)).alias("run_end"))


def as_runs(
    df: DataFrame, config: Forecast, start: Instant, end: Instant, time_dim: str = "time"
) -> DataFrame:
    """A series as the runs of ``[start, end)``: each stamp in ``[run, run + horizon)`` becomes the lead
    ``stamp - run``. A row is repeated once per run that covers it (``horizon / every`` times)."""
    horizon, every = seconds(config.horizon), seconds(config.every)
    since = F.unix_seconds(time_dim) - F.unix_seconds(stamp(start))
    span = F.unix_seconds(stamp(end)) - F.unix_seconds(stamp(start))
    first = F.greatest(F.floor((since - horizon) / every) + 1, F.lit(0))
    last = F.least(F.floor(since / every), F.ceil(span / every) - 1)
    t = F.col(time_dim)
    covered = df.where((t >= stamp(start)) & (t < plus(stamp(end), horizon - every))).where(first <= last)
    run = covered.withColumn("__run", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    init = plus(stamp(start), F.col("__run").cast("bigint") * every)
    rest = [c for c in df.columns if c != time_dim]
    return run.select(
        init.alias(config.init_dim),
        (F.unix_seconds(time_dim) - F.unix_seconds(init)).alias(config.lead_dim),
        t.alias(config.valid_coord),
        *rest,
    )


def as_run_cube(
    cube: Cube, config: Forecast, start: Instant, end: Instant, flags: DataFrame | None = None, time_dim: str = "time"
) -> Cube:
    """A cube of runs: timed tables get (init, lead) and the valid time, static ones are unchanged.

    ``flags`` is the table of ``run_flags``: each flag becomes a boolean variable on (init, lead).
    """
    if all(time_dim not in dims for dims in cube.frames):
        raise ValueError(f"no variable has the dimension {time_dim!r}")
    frames = {}
    for dims, df in cube.frames.items():
        if time_dim in dims:
            dims = (config.init_dim, config.lead_dim, *(d for d in dims if d != time_dim))
            df = as_runs(df, config, start, end, time_dim)
        frames[dims] = df
    out = replace(cube, frames=frames, axes={d: a for d, a in cube.axes.items() if d != time_dim})
    if flags is None:
        return out
    names = [r["flag"] for r in flags.select("flag").distinct().collect()]
    if taken := sorted(set(names) & set(out.variables)):
        raise ValueError(f"flags {taken} are also variables of the run: rename one")
    wide = flags.groupBy(config.init_dim, config.lead_dim).pivot("flag", names).agg(F.bool_and("value"))
    return out.add_frame((config.init_dim, config.lead_dim), wide)


def series_is_the_run(series: DataFrame, runs: DataFrame, config: Forecast, time_dim: str = "time") -> DataFrame:
    """``(init_time, real)``: whether a series read now is a run's own forecast: it has stamps, and
    none at or after the run's end."""
    last = series.agg(F.max(time_dim)).scalar()
    end = plus(F.col(config.init_dim), seconds(config.horizon))
    return runs.select(config.init_dim, F.coalesce(last < end, F.lit(False)).alias("real"))


def run_flags(reports: DataFrame, leads: DataFrame, config: Forecast) -> DataFrame:
    """``(init_time, lead_time, flag, value)``: true where every dataset sharing the flag is the run's
    own forecast. ``reports`` is ``(init_time, dataset, flag, real, unavailable)``; ``leads`` the lead axis."""
    real = F.coalesce(F.col("real"), F.lit(False)) & ~F.coalesce(F.col("unavailable"), F.lit(False))
    named = reports.where(F.col("flag").isNotNull())
    merged = named.groupBy(config.init_dim, "flag").agg(F.bool_and(real).alias("value"))
    every = leads.agg(F.collect_set(config.lead_dim)).scalar()
    return merged.select(config.init_dim, F.explode(every).alias(config.lead_dim), "flag", "value")


def stand_in(
    runs: DataFrame, leads: DataFrame, cells: Mapping[str, DataFrame], variables: Mapping[str, str], config: Forecast
) -> DataFrame:
    """NULL rows for runs a source lacks: every stored lead and cell. ``variables`` maps names to their
    stored types, which are floating point."""
    if wrong := [n for n, kind in variables.items() if kind not in ("float", "double")]:
        raise ValueError(f"{wrong} are not floating point: missing values cannot stand in for them")
    axes = [(config.init_dim, runs), (config.lead_dim, leads), *cells.items()]
    empty = spine(axes)
    valid = plus(F.col(config.init_dim), F.col(config.lead_dim))
    nothing = {n: F.lit(None).cast(kind) for n, kind in variables.items()}
    return empty.withColumns({config.valid_coord: valid, **nothing})


def with_stand_ins(
    source: DataFrame, runs: DataFrame, leads: DataFrame, cells: Mapping[str, DataFrame], config: Forecast
) -> DataFrame:
    """The source's runs, and NULL rows for those of ``runs`` it lacks."""
    known = {config.init_dim, config.lead_dim, config.valid_coord, *cells}
    variables = {f.name: f.dataType.simpleString() for f in source.schema.fields if f.name not in known}
    have = local_copy(source.select(config.init_dim).distinct())
    lacking = runs.select(config.init_dim).join(have, config.init_dim, "left_anti")
    return source.unionByName(stand_in(lacking, leads, cells, variables, config).select(source.columns))


def different_valid_times(times: DataFrame, init: str = "init_time", time_dim: str = "time") -> DataFrame:
    """``(init_time, dataset, last, longest_last)``: the datasets of a run whose valid times differ from
    those of its longest dataset. ``times`` is ``(init_time, dataset, time)``.

    Times are matched by an equi-join and counted: no set of times is gathered in one row.
    """
    distinct = times.select(init, "dataset", time_dim).distinct()
    sizes = distinct.groupBy(init, "dataset").agg(F.count(F.lit(1)).alias("n"), F.max(time_dim).alias("last"))
    longest = sizes.groupBy(init).agg(
        F.max(F.struct("n", F.col("last"), "dataset")).alias("longest")
    )
    named = longest.select(
        init,
        F.col("longest.dataset").alias("longest"),
        F.col("longest.n").alias("wanted"),
        F.col("longest.last").alias("longest_last"),
    )
    model = distinct.join(named, init).where(F.col("dataset") == F.col("longest")).select(init, time_dim)
    matched = (
        distinct.join(model, [init, time_dim], "left_semi")
        .groupBy(init, "dataset")
        .agg(F.count(F.lit(1)).alias("matched"))
    )
    judged = sizes.join(matched, [init, "dataset"], "left").join(named, init)
    same = (F.col("n") == F.col("wanted")) & (F.coalesce("matched", F.lit(0)) == F.col("wanted"))
    return judged.where(~same).select(init, "dataset", "last", "longest_last")


def run_states(
    runs: DataFrame,
    source: DataFrame,
    stored: DataFrame,
    config: Forecast,
    now: Instant | None = None,
) -> DataFrame:
    """``(init_time, state)`` of the wanted runs: "stored" already, "ready" (the source has it whole),
    "waiting" (younger than ``missing_after`` and lacking or in part), "incomplete" (older, in part) or
    "missing" (older, lacking). ``source`` is ``(init_time, complete)``."""
    init = config.init_dim
    moment = stamp(now) if now is not None else F.current_timestamp()
    age = F.unix_seconds(moment) - F.unix_seconds(init)
    young = F.lit(False) if config.missing_after is None else age < seconds(config.missing_after)
    joined = (
        runs.select(init)
        .join(source.select(init, "complete"), init, "left")
        .join(stored.select(init).distinct().withColumn("stored", F.lit(True)), init, "left")
    )
    state = (
        F.when(F.col("stored"), "stored")
        .when(F.col("complete"), "ready")
        .when(young, "waiting")
        .when(F.col("complete").isNotNull(), "incomplete")
        .otherwise("missing")
    )
    return joined.select(init, state.alias("state"))


def rolling_window(df: DataFrame, dim: str, keep: int) -> DataFrame:
    """The rows of the last ``keep`` labels along ``dim``: their short list is read once, then joined."""
    if keep < 1:
        raise ValueError("a window holds at least one run")
    last = df.select(dim).distinct().orderBy(F.col(dim).desc()).limit(keep)
    return df.join(local_copy(last), dim, "left_semi").select(df.columns)


def layout_differences(
    stored: DataFrame, run: DataFrame, config: Forecast, ignored: Sequence[str] = ()
) -> DataFrame:
    """``(problem, name)``: leads on one side only, and stored variables the run lacks."""
    lead = config.lead_dim
    a, b = stored.select(lead).distinct(), run.select(lead).distinct()
    shown = F.col(lead).cast("string").alias("name")
    gone = a.join(b, lead, "left_anti").select(F.lit("lead not in the run").alias("problem"), shown)
    new = b.join(a, lead, "left_anti").select(F.lit("lead not stored").alias("problem"), shown)
    lacking = [c for c in stored.columns if c not in run.columns and c not in ignored]
    out = gone.unionByName(new)
    if lacking:
        spark = stored.sparkSession
        names = spark.range(1).select(
            F.lit("variable not in the run").alias("problem"), F.explode(F.array(*map(F.lit, lacking))).alias("name")
        )
        out = out.unionByName(names)
    return out


def lead_statistics(
    runs: DataFrame,
    series: DataFrame,
    cell: Sequence[str],
    forecast: str,
    observed: str,
    config: Forecast,
    time_dim: str = "time",
) -> DataFrame:
    """``(lead_time, n, bias, mae, rmse)``: run values against the series at their valid times.

    An equi-join on valid time and cell, then partial sums per lead.
    """
    other = series.select(F.col(time_dim).alias(config.valid_coord), *cell, F.col(observed).alias("__observed"))
    joined = runs.select(config.lead_dim, config.valid_coord, *cell, forecast).join(
        other, [config.valid_coord, *cell]
    )
    error: Column = F.col(forecast) - F.col("__observed")
    return joined.groupBy(config.lead_dim).agg(
        F.count(error).alias("n"),
        F.avg(error).alias("bias"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )

