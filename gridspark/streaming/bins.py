"""Time bins of an arriving series."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.times import seconds

# The reductions whose state is a few numbers per bin.
_STREAMED = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev_pop,
    "var": F.var_pop,
}


def stream_resample(
    stream: DataFrame,
    variables: Mapping[str, str] | Sequence[str],
    cell: Sequence[str],
    reduce: str = "mean",
    period: str = "1 day",
    delay: str = "2 days",
    time_dim: str = "time",
    origin: str = "1970-01-01",
) -> DataFrame:
    """The bins of a stream: in append mode a bin is emitted once, when the watermark (the latest
    stamp less ``delay``) has passed its end; rows later than that are dropped.

    The state is one partial aggregate per open bin and cell. ``time_dim`` is a TIMESTAMP column. Bins
    are counted from ``origin``: with a period that doesn't divide a day, give the first day of the batch.
    """
    if reduce not in _STREAMED:
        raise ValueError(f"stream_resample: no reduction {reduce!r}: {', '.join(_STREAMED)}")
    names = variables if isinstance(variables, Mapping) else {v: v for v in variables}
    length = seconds(period.replace(" ", ""))
    since = datetime.datetime.fromisoformat(origin).replace(tzinfo=datetime.UTC).timestamp()
    from_epoch = f"{int(since) % length} seconds"
    made: list[Column] = [_STREAMED[reduce](v).alias(name) for v, name in names.items()]
    bins = stream.withWatermark(time_dim, delay).groupBy(F.window(time_dim, period, period, from_epoch).alias("w"), *cell).agg(*made)
    return bins.select(F.col("w.start").alias(time_dim), *cell, *names.values())
