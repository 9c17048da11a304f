"""Axis tables ``(idx, <dim>, ...)`` and spines (every combination of some axes).

``idx`` is the position along the dimension, 0-based; ``<dim>`` is the label the data tables are
keyed by. Further columns are auxiliary coordinates (bounds, old labels).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridspark.plans.sizing import LOCAL_ROWS, local_copy
from gridspark.session import workspace


def axis_of(spark: SparkSession, dim: str, values: Sequence, dtype: T.DataType | None = None) -> DataFrame:
    """The axis with the given labels, in the given order."""
    dtype = dtype or T.DoubleType()
    schema = T.StructType([T.StructField("idx", T.IntegerType(), False), T.StructField(dim, dtype, False)])
    table = pa.table({"idx": pa.array(range(len(values)), pa.int32()), dim: pa.array(list(values))})
    return spark.createDataFrame(table, schema=schema)


def axis_from(df: DataFrame, dim: str, descending: bool = False) -> DataFrame:
    """The axis of the labels present in ``df``, in label order.

    One column is scanned and made distinct before it is shuffled. Up to ``LOCAL_ROWS`` labels are
    ranked as one small relation; longer axes are sorted over all tasks (see ``_ranked``).
    """
    labels = df.select(dim).where(F.col(dim).isNotNull()).distinct()
    local = local_copy(labels)
    if local is labels:
        return _ranked(labels, dim, descending)
    order = F.col(dim).desc() if descending else F.col(dim).asc()
    return local.select((F.row_number().over(Window.orderBy(order)) - 1).alias("idx"), dim)


def _ranked(labels: DataFrame, dim: str, descending: bool) -> DataFrame:
    """Positions of many labels of any type: sorted over all tasks and written, so that each keeps its
    place in its part; the number of labels in the parts before (one row per part) is added."""
    order = F.col(dim).desc() if descending else F.col(dim).asc()
    path = workspace(labels.sparkSession, "ranked")
    labels.orderBy(order).withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    placed = labels.sparkSession.read.parquet(path).withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(starts), "part").select((F.col("start") + inside).cast("int").alias("idx"), dim)


def by_value(axis: DataFrame, dim: str) -> DataFrame:
    """``axis`` with each label's ``place`` in the order of values, which for a turned or picked axis is not its position.
    Up to ``LOCAL_ROWS`` labels are ranked as one small relation, longer axes over all tasks."""
    rows = axis.select("idx", dim)
    local = local_copy(rows)
    if local is rows:
        return rows.join(_ranked(rows.select(dim), dim, False).withColumnRenamed("idx", "place"), dim)
    return local.withColumn("place", F.row_number().over(Window.orderBy(dim)) - 1)


def shifted(axis: DataFrame, dim: str, by: int, name: str) -> DataFrame:
    """``axis`` with the label ``by`` positions further as ``name`` (NULL past the end): an equi-join
    on the position, so that no task ever holds the whole axis."""
    other = axis.select((F.col("idx") - by).alias("idx"), F.col(dim).alias(name))
    return axis.join(other, "idx", "left")


def labels_array(axis: DataFrame, dim: str) -> Column:
    """The axis's labels as one array value (a scalar subquery over a bounded axis)."""
    return axis.agg(F.collect_set(dim)).scalar()


def spine(axes: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Every combination of the labels of ``axes``: the first axis is the distributed side, the
    labels of the others are exploded from one array each (no join)."""
    (dim, axis), *rest = axes
    out = axis.select(dim)
    for name, other in rest:
        out = out.withColumn(name, F.explode(labels_array(other, name)))
    return out


__all__ = ["LOCAL_ROWS", "axis_from", "axis_of", "by_value", "labels_array", "shifted", "spine"]
