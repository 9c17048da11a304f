"""Forecast runs as sources give them: (initialization, step) tables read along valid time.

Columns: ``init_time`` (timestamp), ``step_h`` (hours), then cell dimensions and variables.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridspark.functions.times import plus, stamp


def steps_as_valid_time(
    runs: DataFrame, time_dim: str = "time", init: str = "init_time", step: str = "step_h", keep_init: bool = False
) -> DataFrame:
    """One row per valid time (init + step) instead of per init and step."""
    valid = plus(F.col(init), F.col(step) * 3600).alias(time_dim)
    rest = [c for c in runs.columns if c not in (init, step)]
    return runs.select(*([init] if keep_init else []), valid, *rest)


def run_window(
    runs: DataFrame, first_h: int, last_h: int, init: str = "init_time", step: str = "step_h"
) -> DataFrame:
    """The steps from ``first_h`` to ``last_h`` (included) of every run."""
    return runs.where(F.col(step).between(first_h, last_h))


def run_status(
    runs: DataFrame, first_h: int, last_h: int, init: str = "init_time", step: str = "step_h"
) -> DataFrame:
    """``(init_time, last_step, status)``: per run "complete", "incomplete" (it ends before
    ``last_h``: being published, or cut short) or "no step at the end" (its steps skip it)."""
    at_end = F.max(F.when(F.col(step) == last_h, F.lit(1)))
    status = (
        F.when(F.col("last_step") < last_h, "incomplete")
        .when(F.col("at_end").isNull(), "no step at the end")
        .otherwise("complete")
    )
    ends = runs.groupBy(init).agg(F.max(step).alias("last_step"), at_end.alias("at_end"))
    return ends.select(init, "last_step", status.alias("status"))


def step_gaps(runs: DataFrame, init: str = "init_time", step: str = "step_h") -> DataFrame:
    """``(init_time, from_h, to_h)``: gaps between the steps of a run.

    The spacing of steps may not shrink, and the last spacing may not exceed the one before; a
    window holds the distinct steps of one run.
    """
    steps = runs.select(init, step).distinct()
    order = Window.partitionBy(init).orderBy(step)
    spaced = steps.select(
        init,
        F.col(step).alias("from_h"),
        F.lead(step).over(order).alias("to_h"),
    ).where("to_h IS NOT NULL")
    gap = F.col("to_h") - F.col("from_h")
    order = Window.partitionBy(init).orderBy("from_h")
    judged = spaced.withColumns(
        {
            "gap": gap,
            "before": F.lag(gap).over(order),
            "after": F.lead(gap).over(order),
        }
    )
    shrinks = F.col("gap") > F.col("after")
    ends_wide = F.col("after").isNull() & (F.col("gap") > F.col("before"))
    return judged.where(F.coalesce(shrinks, F.lit(False)) | F.coalesce(ends_wide, F.lit(False))).select(
        init, "from_h", "to_h"
    )


def deaccumulate(
    runs: DataFrame, variables: Iterable[str], cell: Sequence[str], init: str = "init_time", step: str = "step_h"
) -> DataFrame:
    """Accumulations since the start of the run become the increment to the next step (missing at
    the last). A window holds one cell's steps of one run."""
    order = Window.partitionBy(init, *cell).orderBy(step)
    return runs.withColumns({v: F.lead(v).over(order) - F.col(v) for v in variables})


def lead_hours(
    runs: DataFrame,
    start: str | datetime.datetime,
    end: str | datetime.datetime,
    every_h: int = 24,
    init: str = "init_time",
) -> DataFrame:
    """``(init_time, lead_h)``: the multiples of ``every_h`` hours, from one on, whose valid time is in
    ``[start, end)``."""
    step = every_h * 3600
    ahead = F.unix_seconds(stamp(start)) - F.unix_seconds(init)
    room = F.unix_seconds(stamp(end)) - F.unix_seconds(init)
    first = F.greatest(F.ceil(ahead / step), F.lit(1)).cast("int")
    last = (F.ceil(room / step) - 1).cast("int")
    many = runs.select(init).distinct().where(first <= last)
    return many.select(init, F.explode(F.sequence(first, last)).alias("k")).select(
        init, (F.col("k") * every_h).cast("int").alias("lead_h")
    )
