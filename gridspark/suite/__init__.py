"""The operators as queries over a star schema's tables, with the same question in plain SQL."""

from gridspark.suite import (  # noqa: F401
    aggregation,
    blocks,
    checks,
    climatology,
    flagship,
    forecast,
    geometry,
    masking,
    selection,
    sources,
    streams,
)
from gridspark.suite.tables import QUERIES, SQL, Tables

__all__ = ["QUERIES", "SQL", "Tables"]
