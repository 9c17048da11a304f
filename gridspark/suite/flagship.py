"""One question end to end: the daily mean of an hourly field on a coarser grid, sea cells only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.operators.blocks import blocks
from gridspark.operators.masks import is_positive_mask
from gridspark.plans.steps import process
from gridspark.session import workspace
from gridspark.sources.store import Output, intervals_of
from gridspark.suite.geometry import NESTED, WHERE, _overlaps
from gridspark.suite.tables import Tables, query, rounded

_START, _END = "2024-01-01", "2024-01-31"

STEPS = [
    {"name": "time_sel", "start": _START, "end": _END},
    {"name": "drop_vars", "names": ["n"]},
    {"name": "resample", "time": "1D", "reduce": "mean", "label": "left", "closed": "left", "dense": False},
    {"name": "regrid", "method": "conservative", "grid": NESTED, "kwargs": {"skipna": True}, **WHERE},
    {"name": "fraction_mask", "fraction": "seafrac", "mask_name": "sea", "threshold": 0.5, "inclusive": True},
    {"name": "apply_mask", "mask_name": "sea", "variables": ["t2m"]},
    {"name": "select_variables", "variables": ["t2m"]},
]


@query(
    "flagship_daily_sea_mean",
    "hourly static",
    f"""WITH {_overlaps(NESTED)},
        d AS (SELECT date_trunc('day', time) AS time, lat, lon, avg(t2m) AS t2m FROM hourly
            WHERE time >= TIMESTAMP '{_START}' AND time < TIMESTAMP '{_END}' GROUP BY 1, 2, 3),
        f AS (SELECT tlat, tlon, sum(w * CASE WHEN deptho > 0 THEN 1.0 ELSE 0.0 END) / sum(w) AS seafrac
            FROM static JOIN w USING (lat, lon) GROUP BY 1, 2)
        SELECT time, tlat AS lat, tlon AS lon, round(CASE WHEN max(seafrac) >= 0.5 THEN sum(w * t2m) / sum(w) END, 6) AS t2m
        FROM d JOIN w USING (lat, lon) JOIN f USING (tlat, tlon) GROUP BY 1, 2, 3""",
)
def _flagship(t: Tables) -> DataFrame:
    hourly = t.hourly(_START, _END)
    sea = is_positive_mask(t.static(), "deptho", "seafrac").frame("lat", "lon")
    sea = sea.select("lat", "lon", F.col("seafrac").cast("double").alias("seafrac"))
    cube = process(hourly.add_frame(("lat", "lon"), sea), STEPS)
    output = Output(t.spark, workspace(t.spark, "flagship"))
    run = output.start(recipe_id="daily-sea-mean")
    run.write_blocks(cube, intervals_of(blocks(t.spark, _START, _END, "7D")))
    run.publish()
    frame = rounded(output.read().frame("time", "lat", "lon"), "t2m")
    return frame.withColumns({d: F.col(d).cast("double") for d in ("lat", "lon")})


def daily_sea_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship over the tables of ``sf_dir``."""
    return _flagship(Tables(spark, sf_dir))
