"""The extent of a cube, from its coordinates."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridspark.cube import Cube
from gridspark.functions.times import iso_duration
from gridspark.plans.steps import step

# Machine precision of the label types.
_EPSILON = {"float": 1.1920928955078125e-07, "double": 2.220446049250313e-16}


def spacing(labels: DataFrame, dim: str) -> DataFrame:
    """One row ``(low, high, step)``: the ends of the labels and their spacing, NULL if irregular.

    Times are compared exactly (in microseconds; ``step`` is in seconds), numbers within the rounding
    of their type.
    """
    kind = labels.schema[dim].dataType
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return _time_spacing(labels.select(F.unix_micros(F.col(dim).cast("timestamp")).alias("x")).distinct())
    value = F.col(dim).cast("double")
    gaps = labels.select(value.alias("x")).distinct().withColumn(
        "gap", F.col("x") - F.lag("x").over(Window.orderBy("x"))
    )
    ends = gaps.agg(
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.min("gap").alias("least"),
        F.max("gap").alias("most"),
        F.count("x").alias("n"),
    )
    mean = F.when(F.col("n") > 1, (F.col("high") - F.col("low")) / (F.col("n") - 1))
    rounding = 4 * _EPSILON.get(kind.simpleString(), 0.0) * F.greatest(F.abs("low"), F.abs("high"))
    tolerance = F.greatest(1e-6 * mean, rounding)
    close = (F.abs(F.col("least") - mean) <= tolerance) & (F.abs(F.col("most") - mean) <= tolerance)
    return ends.select("low", "high", F.when((mean > 0) & close, mean).alias("step"))


def _time_spacing(stamps: DataFrame) -> DataFrame:
    """``spacing`` of distinct stamps, without ordering them: ``n`` of them are regular if the span is
    ``n - 1`` whole steps and each lies a whole number of steps after the first."""
    ends = stamps.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("n"))
    span = F.col("high") - F.col("low")
    even = (F.col("n") > 1) & (span % F.greatest(F.col("n") - 1, F.lit(1)) == 0)
    described = ends.select("low", "high", F.when(even, (span / (F.col("n") - 1)).cast("bigint")).alias("step"))
    one = described.select(F.struct("low", "high", "step").alias("e"))
    beside = stamps.select("x", one.scalar().alias("e"))
    off = beside.agg(
        F.first("e.low").alias("low"),
        F.first("e.high").alias("high"),
        F.first("e.step").alias("step"),
        F.count_if(F.pmod(F.col("x") - F.col("e.low"), F.col("e.step")) != 0).alias("off"),
    )
    return off.select("low", "high", F.when(F.col("off") == 0, F.col("step") / 1_000_000).alias("step"))


def _text(attribute: str, value: Column) -> Column:
    return F.struct(F.lit(attribute).alias("attribute"), F.lit(None).cast("double").alias("number"), value.alias("text"))


def _number(attribute: str, value: Column) -> Column:
    return F.struct(F.lit(attribute).alias("attribute"), value.alias("number"), F.lit(None).cast("string").alias("text"))


def _six_digits(value: Column) -> Column:
    """Six significant digits, without trailing zeros."""
    digits = F.lit(5) - F.floor(F.log10(value))
    shown = F.round(value * F.pow(F.lit(10.0), digits), 0) / F.pow(F.lit(10.0), digits)
    return F.regexp_replace(shown.cast("string"), r"\.0$", "")


def _rows(table: DataFrame, *made: Column) -> DataFrame:
    kept = F.filter(F.array(*made), lambda s: s["number"].isNotNull() | s["text"].isNotNull())
    return table.select(F.inline(kept))


def horizontal_coverage(axis: DataFrame, dim: str, name: str, units: str) -> DataFrame:
    """The attributes ``geospatial_<name>_*`` of a horizontal axis, one row each."""
    prefix = f"geospatial_{name}"
    return _rows(
        spacing(axis, dim),
        _number(f"{prefix}_min", F.round("low", 6)),
        _number(f"{prefix}_max", F.round("high", 6)),
        _text(f"{prefix}_units", F.lit(units)),
        _text(f"{prefix}_resolution", F.concat(_six_digits(F.col("step")), F.lit(" degree"))),
    )


def vertical_coverage(axis: DataFrame, dim: str, attrs: dict[str, Any]) -> DataFrame:
    """The attributes ``geospatial_vertical_*`` of a vertical axis."""
    ends = axis.agg(F.min(F.col(dim).cast("double")).alias("low"), F.max(F.col(dim).cast("double")).alias("high"))
    texts = [
        _text(f"geospatial_vertical_{key}", F.lit(attrs[key])) for key in ("units", "positive") if key in attrs
    ]
    return _rows(
        ends,
        _number("geospatial_vertical_min", F.round("low", 6)),
        _number("geospatial_vertical_max", F.round("high", 6)),
        *texts,
    )


def time_coverage(stamps: DataFrame, dim: str) -> DataFrame:
    """The attributes ``time_coverage_*``: first and last stamp, and the resolution if regular."""
    def iso(micros: str) -> Column:
        return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    return _rows(
        spacing(stamps, dim),
        _text("time_coverage_start", iso("low")),
        _text("time_coverage_end", iso("high")),
        _text("time_coverage_resolution", iso_duration(F.col("step"))),
    )


def coverage_report(
    cube: Cube,
    latitude_dim: str = "lat",
    longitude_dim: str = "lon",
    vertical_dim: str | None = None,
    time_dim: str | bool | None = "time",
) -> DataFrame:
    """``(attribute, number, text)``: the extent, one row per attribute."""
    parts = [
        horizontal_coverage(cube.axis(latitude_dim), latitude_dim, "lat", "degrees_north"),
        horizontal_coverage(cube.axis(longitude_dim), longitude_dim, "lon", "degrees_east"),
    ]
    if vertical_dim is not None:
        attrs = dict(cube.var_attrs.get(vertical_dim, {}))
        parts.append(vertical_coverage(cube.axis(vertical_dim), vertical_dim, attrs))
    if time_dim:
        parts.append(time_coverage(cube.axis(str(time_dim)), str(time_dim)))
    return reduce(DataFrame.unionByName, parts)


@step
def coverage_attrs(
    cube: Cube,
    latitude_dim: str = "lat",
    longitude_dim: str = "lon",
    vertical_dim: str | None = None,
    time_dim: str | bool | None = "time",
) -> Cube:
    """Set the attributes of the extent from the coordinates (a dozen values are read)."""
    rows = coverage_report(cube, latitude_dim, longitude_dim, vertical_dim, time_dim).collect()
    found = {row["attribute"]: row["text"] if row["number"] is None else row["number"] for row in rows}
    return replace(cube, attrs={**cube.attrs, **found})


def output_coverage(stored: DataFrame, block: DataFrame, dim: str = "time") -> DataFrame:
    """The time coverage of an output once a block is added to it: of the distinct stamps of both.

    For forecasts ``stored`` holds the valid times of the runs kept, which overlap.
    """
    return time_coverage(stored.select(dim).unionByName(block.select(dim)).distinct(), dim)
