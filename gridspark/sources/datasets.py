"""A dataset read for an interval: its parts opened, aligned, cut and merged, then its steps applied."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import SparkSession

from gridspark.cube import Cube
from gridspark.plans.steps import process
from gridspark.sources import parts

Instant = str | datetime.datetime


@dataclass(frozen=True)
class Part:
    """One table of a dataset and how it joins the others.

    ``rename`` applies right after opening; ``coordinate_tolerance`` gives it an earlier part's labels;
    ``time_offset`` moves its stamps; ``static_time`` reads it at one instant, without time.
    """

    path: str
    dims: Sequence[str]
    variables: Iterable[str] | None = None
    drop_variables: Iterable[str] | None = None
    rename: Mapping[str, str] | None = None
    coordinate_tolerance: float | None = None
    time_offset: str | datetime.timedelta | None = None
    static_time: Instant | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def open(self, spark: SparkSession, earlier: Sequence[Cube], start: Instant, end: Instant, time_dim: str) -> Cube:
        """The part over ``[start, end)``."""
        cube = parts.scan_part(
            spark, self.path, self.dims, self.variables, self.drop_variables, self.rename, self.format, **self.options
        )
        if self.coordinate_tolerance is not None:
            cube = parts.snap_coordinates(cube, earlier, self.coordinate_tolerance)
        if self.static_time is not None:
            if self.time_offset is not None:
                cube = parts.time_offset(cube, self.time_offset, time_dim=time_dim)
            return parts.static_time(cube, self.static_time, time_dim)
        if self.time_offset is not None:
            return parts.time_offset(cube, self.time_offset, start, end, time_dim)
        return parts.time_sel(cube, start, end, time_dim)


def open_dataset(
    spark: SparkSession,
    members: Sequence[Part],
    start: Instant,
    end: Instant,
    steps: Iterable[Mapping[str, Any]] = (),
    time_dim: str = "time",
) -> Cube:
    """The dataset of ``members`` over ``[start, end)``, processed by its own steps."""
    if not members:
        raise ValueError("a dataset has at least one part")
    opened: list[Cube] = []
    for member in members:
        opened.append(member.open(spark, opened, start, end, time_dim))
    return process(parts.merge_parts(opened), steps)


def merge_all(datasets: Sequence[Cube], steps: Iterable[Mapping[str, Any]] = ()) -> Cube:
    """Datasets on equal coordinates merged, then the steps of the whole."""
    return process(reduce(parts.merge_datasets, datasets), steps)
