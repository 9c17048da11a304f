"""Bins of a period, their statistics and windows over them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions.windows import window
from gridspark.operators import climatology
from gridspark.sources.parts import time_sel
from gridspark.suite.tables import Tables, query, rounded

DAILY = ("time", "cell")

_BIN = """CAST(dayofyear(time) - 1 - CASE WHEN (year(time) % 4 = 0) AND (month(time) > 2
    OR (month(time) = 2 AND day(time) = 29)) THEN 1 ELSE 0 END AS INT)"""
_BINNED = f"b AS (SELECT time, cell, {_BIN} AS bin, x FROM daily)"
_STATS = f"""{_BINNED}, every AS (SELECT CAST(c AS INT) AS cell, CAST(k AS INT) AS bin
        FROM (SELECT unnest(range(16)) AS c), (SELECT unnest(range(365)) AS k)),
    st AS (SELECT e.cell, e.bin, count(x) AS n, avg(x) AS mean, coalesce(var_pop(x) * count(x), 0.0) AS m2
        FROM every e LEFT JOIN b ON b.cell = e.cell AND b.bin = e.bin GROUP BY 1, 2)"""


def _pooled(size: int, weighting: str = "constant", scale: float | None = None) -> str:
    """Windows over ``st``, with the definition of weights and spread written out."""
    weights = ", ".join(f"({k}, CAST({w!r} AS DOUBLE))" for k, w in window(size, weighting, scale))
    return f"""{_STATS}, o(k, w) AS (VALUES {weights}),
        j AS (SELECT i.cell, i.bin, o.w, st.n, st.mean, st.m2 FROM every i, o, st
            WHERE st.cell = i.cell AND st.bin = (i.bin + o.k + 365) % 365),
        v AS (SELECT cell, bin, sum(w * n) AS v1, sum(w * w * n) AS v2, sum(w * n * mean) FILTER (WHERE n > 0) AS s FROM j GROUP BY 1, 2),
        c AS (SELECT cell, bin, v1, v2, CASE WHEN v1 > 0 THEN s / v1 END AS c FROM v),
        q AS (SELECT cell, bin, sum(w * (n * (mean - c) * (mean - c) + m2)) FILTER (WHERE n > 0) AS q
            FROM j JOIN c USING (cell, bin) GROUP BY 1, 2),
        p AS (SELECT cell, bin, c AS climatology, CASE WHEN v1 > 0 THEN CASE WHEN v1 - v2 / v1 > 0
            THEN q / (v1 - v2 / v1) END END AS anomaly_variance FROM c LEFT JOIN q USING (cell, bin))"""


@query(
    "I1_bins_position",
    "daily",
    """WITH a AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS k FROM (SELECT DISTINCT time FROM daily) d),
        n AS (SELECT count(*) AS n FROM a)
        SELECT time, cell, CAST(k % 7 AS INT) AS bin, x FROM daily JOIN a USING (time), n WHERE k < n - n % 7""",
)
def bins_position(t: Tables) -> DataFrame:
    """Weeks: the steps of whole periods and the bin of each."""
    cube = t.daily().with_axes("time")
    axis = cube.axes["time"]
    size = axis.count()
    axis = axis.where(F.col("idx") < size - size % 7)
    frame = cube.frame(*DAILY).join(axis.select("time"), "time", "left_semi")
    whole = replace(cube, frames={DAILY: frame}, axes={**cube.axes, "time": axis})
    return climatology.binned(whole, DAILY, 7, "position", "time").select("time", "cell", "bin", "x")


@query("I2_bins_day_of_year", "daily", f"WITH {_BINNED} SELECT time, cell, bin, x FROM b")
def bins_day_of_year(t: Tables) -> DataFrame:
    return climatology.binned(t.daily(), DAILY, 365, "day_of_year", "time").select("time", "cell", "bin", "x")


@query(
    "I3_bin_statistics",
    "daily",
    f"""WITH {_STATS} SELECT cell, bin, CAST(n AS BIGINT) AS n, round(mean, 4) AS mean, round(sqrt(m2), 3) AS root_m2 FROM st""",
)
def bin_statistics(t: Tables) -> DataFrame:
    table = climatology.bin_statistics(t.daily(), "x", 365, "day_of_year")
    return table.select(
        "cell", "bin", "n", F.round("mean", 4).alias("mean"), F.round(F.sqrt("m2"), 3).alias("root_m2")
    )


@query(
    "I4_combine_statistics",
    "daily",
    f"""WITH {_STATS} SELECT cell, bin, CAST(n AS BIGINT) AS n, round(mean, 4) AS mean, round(sqrt(m2), 3) AS root_m2 FROM st""",
)
def combine_statistics(t: Tables) -> DataFrame:
    """Statistics of two spans of years, combined: those of all years."""
    cube = t.daily()
    early = climatology.bin_statistics(time_sel(cube, "1990-01-01", "1998-07-01"), "x", 365, "day_of_year", dense=False)
    late = climatology.bin_statistics(time_sel(cube, "1998-07-01", "2030-01-01"), "x", 365, "day_of_year")
    table = climatology.combine_statistics(early, late, ["cell"])
    return table.select(
        "cell", "bin", "n", F.round("mean", 4).alias("mean"), F.round(F.sqrt("m2"), 3).alias("root_m2")
    )


@query(
    "I5_window_weights",
    "daily",
    f"""WITH {_BINNED}, o(k, w) AS (VALUES {", ".join(f"({k}, CAST({w!r} AS DOUBLE))" for k, w in window(7, "geometric"))})
        SELECT cell, round(sum(x * w), 2) AS weighted, round(sum(w), 6) AS weights
        FROM b JOIN o ON b.bin = o.k + 180 GROUP BY 1""",
)
def window_weights(t: Tables) -> DataFrame:
    """The weights of a window centred on bin 180, applied to the values in it."""
    binned = climatology.binned(t.daily(), DAILY, 365, "day_of_year", "time")
    weight = F.create_map(*(F.lit(v) for k, w in window(7, "geometric") for v in (k + 180, w)))[F.col("bin")]
    inside = binned.withColumn("w", weight).where(F.col("w").isNotNull())
    return inside.groupBy("cell").agg(
        F.round(F.sum(F.col("x") * F.col("w")), 2).alias("weighted"), F.round(F.sum("w"), 6).alias("weights")
    )


def _table(t: Tables, size: int, weighting: str = "constant", scale: float | None = None) -> DataFrame:
    statistics = climatology.bin_statistics(t.daily(), "x", 365, "day_of_year")
    return climatology.pooled(statistics, ["cell"], 365, size, weighting, scale)


@query(
    "I6_climatology",
    "daily",
    f"WITH {_pooled(31, 'gaussian')} SELECT cell, bin, round(ln(climatology), 9) AS climatology FROM p",
)
def pooled_mean(t: Tables) -> DataFrame:
    """In logarithms, as the next: means of a few prices often end on a 5, where rounding is unstable."""
    return _logarithms(_table(t, 31, "gaussian").select("cell", "bin", "climatology"), "climatology")


@query(
    "I7_anomaly_std",
    "daily",
    f"WITH {_pooled(5, 'geometric', 0.7)} SELECT cell, bin, round(ln(climatology), 9) AS climatology,"
    " round(CASE WHEN anomaly_variance > 0 THEN ln(anomaly_variance) / 2 END, 9) AS anomaly_std FROM p",
)
def pooled_spread(t: Tables) -> DataFrame:
    table = _table(t, 5, "geometric", 0.7).select("cell", "bin", "climatology", "anomaly_std")
    return _logarithms(table, "climatology", "anomaly_std")


def _logarithms(df: DataFrame, *names: str) -> DataFrame:
    return rounded(df.withColumns({n: F.when(F.col(n) > 0, F.ln(n)) for n in names}), *names, digits=9)


@query(
    "I8_reference_period",
    "daily",
    f"""WITH {_BINNED} SELECT cell, bin, CAST(count(x) AS BIGINT) AS n, round(avg(x), 4) AS mean FROM b
        WHERE time >= TIMESTAMP '1996-01-01' AND time < TIMESTAMP '1999-01-01' GROUP BY 1, 2""",
)
def reference_period(t: Tables) -> DataFrame:
    cube = climatology.reference_period(t.daily(), "1996-01-01", "1999-01-01")
    table = climatology.bin_statistics(cube, "x", 365, "day_of_year", dense=False)
    return rounded(table.select("cell", "bin", "n", "mean"), "mean", digits=4)


@query(
    "I9_anomalies",
    "daily",
    f"""WITH {_pooled(31)} SELECT time, cell, round(CASE WHEN anomaly_variance > 0 THEN (x - climatology) / sqrt(anomaly_variance) END, 5) AS anomaly
        FROM b LEFT JOIN p USING (cell, bin)""",
)
def anomalies(t: Tables) -> DataFrame:
    """Values standardized by the climatology and spread of their bin."""
    table = _table(t, 31)
    out = climatology.anomalies(t.daily(), "x", table, 365, "day_of_year", standardized=True)
    return rounded(out, "anomaly", digits=5)

