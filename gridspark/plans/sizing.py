"""Which side of a join may be broadcast: only one whose size was checked.

Axes, day lists and run lists are bounded by the coordinate they describe; ``local_copy`` reads at
most ``LOCAL_ROWS`` of them and hands Catalyst a relation of known size, which it broadcasts on its
own. Static fields (masks, areas) can hold a few million cells; ``broadcast_checked`` counts them
first. Beyond the bound both return the input unchanged: the join is then a shuffle join, whose
skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOCAL_ROWS = 200_000
BROADCAST_ROWS = 2_000_000


def local_copy(df: DataFrame, rows: int = LOCAL_ROWS) -> DataFrame:
    """``df`` as a local relation if it has at most ``rows`` rows, else ``df`` itself."""
    table = df.limit(rows + 1).toArrow()
    if table.num_rows > rows:
        return df
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def broadcast_checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else ``df`` itself."""
    if df.limit(rows + 1).count() <= rows:
        return F.broadcast(df)
    return df
