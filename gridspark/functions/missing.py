"""NaN, NULL and predicates on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """``df`` with NULL for NaN in its floating-point columns."""
    skipped = set(exclude)
    floats = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and f.name not in skipped
    ]
    return df.withColumns({name: F.nanvl(name, F.lit(None)) for name in floats}) if floats else df


def holds(predicate: Column) -> Column:
    """``predicate``, false where it is unknown (comparisons with missing values)."""
    return F.coalesce(predicate, F.lit(False))
