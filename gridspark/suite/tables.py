"""Cubes derived from the given tables, and the registry of queries.

Events become an hourly field, line items a daily field on levels, parts a static field, orders a daily
series per cell, and events again forecast runs with accumulated steps. Sums are over decimals, so
they are the same whatever the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.cube import Cube
from gridspark.functions.times import stamp
from gridspark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The same cubes in SQL.
VIEWS = {
    "hourly": """SELECT date_trunc('hour', ts) AS time, CAST(-1.75 + 0.5 * (user_id % 8) AS DOUBLE) AS lat,
        CAST(0.25 + 0.5 * (CAST(floor(user_id / 8.0) AS INT) % 8) AS DOUBLE) AS lon,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS t2m, CAST(count(*) AS BIGINT) AS n
        FROM events GROUP BY 1, 2, 3""",
    "ocean": """SELECT time, depth, lat, lon,
        CASE WHEN lon > 0.5 AND depth < 0.5 + 2 * (lon - 0.25) THEN q END AS thetao
        FROM (SELECT date_trunc('day', l_shipdate) AS time,
            CAST(CASE (l_linenumber - 1) % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 2.0 ELSE 5.0 END AS DOUBLE) AS depth,
            CAST(-1.75 + 0.5 * (l_suppkey % 8) AS DOUBLE) AS lat,
            CAST(0.25 + 0.5 * (l_partkey % 8) AS DOUBLE) AS lon,
            CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS q
            FROM lineitem GROUP BY 1, 2, 3, 4) o""",
    "static": """SELECT lat, lon, CASE WHEN lon > 0.5 THEN 0.5 + 2 * (lon - 0.25) END AS deptho
        FROM (SELECT DISTINCT CAST(-1.75 + 0.5 * (p_partkey % 8) AS DOUBLE) AS lat,
            CAST(0.25 + 0.5 * (CAST(floor(p_partkey / 8.0) AS INT) % 8) AS DOUBLE) AS lon FROM part) p""",
    "stock": """SELECT CAST(-1.75 + 0.5 * (p_partkey % 8) AS DOUBLE) AS lat,
        CAST(0.25 + 0.5 * (CAST(floor(p_partkey / 8.0) AS INT) % 8) AS DOUBLE) AS lon,
        CAST(max(p_size) AS DOUBLE) AS size, CAST(max(p_size) / 50.0 AS DOUBLE) AS fraction
        FROM part GROUP BY 1, 2""",
    "daily": """SELECT date_trunc('day', o_orderdate) AS time, CAST(o_custkey % 16 AS INT) AS cell,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS x FROM orders GROUP BY 1, 2""",
    "runs": """SELECT init_time, step_h, cell,
        CAST(sum(s) OVER (PARTITION BY init_time, cell ORDER BY step_h
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS tp
        FROM (SELECT date_trunc('day', ts) AS init_time, CAST(floor(hour(ts) / 3.0) * 3 AS INT) AS step_h,
            CAST(user_id % 4 AS INT) AS cell, sum(CAST(value AS DECIMAL(18,2))) AS s
            FROM events GROUP BY 1, 2, 3) r""",
}


def query(name: str, views: str = "", sql: str | None = None):
    """Register a query; ``views`` are the names of those its SQL uses."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ctes = [f"{v} AS ({VIEWS[v]})" for v in views.split()]
            body = sql.strip()
            if ctes and body[:5].upper() == "WITH ":
                SQL[name] = "WITH " + ", ".join(ctes) + ", " + body[5:]
            else:
                SQL[name] = ("WITH " + ", ".join(ctes) + " " if ctes else "") + body
        return function

    return register


def money(column: str) -> Column:
    """An exact sum of values with two decimals."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


class Tables:
    """The tables under ``sf_dir`` as cubes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def axis(self, dim: str, label: Column, size: int) -> DataFrame:
        return self.spark.range(size).select(F.col("id").cast("int").alias("idx"), label.alias(dim))

    @property
    def lat(self) -> DataFrame:
        return self.axis("lat", F.lit(-1.75) + F.lit(0.5) * F.col("id"), 8)

    @property
    def lon(self) -> DataFrame:
        return self.axis("lon", F.lit(0.25) + F.lit(0.5) * F.col("id"), 8)

    @property
    def depth(self) -> DataFrame:
        label = F.when(F.col("id") == 0, 0.5).when(F.col("id") == 1, 2.0).otherwise(5.0)
        return self.axis("depth", label, 3)

    def hourly_frame(self, events: DataFrame) -> DataFrame:
        keyed = events.select(
            F.date_trunc("hour", "ts").alias("time"),
            (F.lit(-1.75) + F.lit(0.5) * (F.col("user_id") % 8)).alias("lat"),
            (F.lit(0.25) + F.lit(0.5) * (F.floor(F.col("user_id") / 8.0) % 8)).alias("lon"),
            "value",
        )
        return keyed.groupBy("time", "lat", "lon").agg(money("value").alias("t2m"), F.count(F.lit(1)).alias("n"))

    def hourly(self, start: str | None = None, end: str | None = None) -> Cube:
        """(time, lat, lon): t2m, n. Bounds on whole hours are tested on the raw stamps by the scan."""
        events = self.table("events")
        if start is not None:
            events = events.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
        if end is not None:
            events = events.where(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        frame = self.hourly_frame(events)
        return Cube.of({("time", "lat", "lon"): frame}, {"lat": self.lat, "lon": self.lon})

    def ocean(self, static: bool = False) -> Cube:
        """(time, depth, lat, lon): thetao, missing on land and below the floor; with ``static``, also
        (lat, lon): deptho."""
        kind = (F.col("l_linenumber") - 1) % 3
        keyed = self.table("lineitem").select(
            F.date_trunc("day", "l_shipdate").alias("time"),
            F.when(kind == 0, 0.5).when(kind == 1, 2.0).otherwise(5.0).alias("depth"),
            (F.lit(-1.75) + F.lit(0.5) * (F.col("l_suppkey") % 8)).alias("lat"),
            (F.lit(0.25) + F.lit(0.5) * (F.col("l_partkey") % 8)).alias("lon"),
            "l_quantity",
        )
        dims = ("time", "depth", "lat", "lon")
        summed = keyed.groupBy(*dims).agg(money("l_quantity").alias("q"))
        wet = (F.col("lon") > 0.5) & (F.col("depth") < F.lit(0.5) + 2 * (F.col("lon") - 0.25))
        frames = {dims: summed.select(*dims, F.when(wet, F.col("q")).alias("thetao"))}
        if static:
            frames[("lat", "lon")] = self.static_frame()
        return Cube.of(frames, {"depth": self.depth, "lat": self.lat, "lon": self.lon})

    def static_frame(self) -> DataFrame:
        cells = self.part_cells(self.table("part")).select("lat", "lon").distinct()
        floor = F.when(F.col("lon") > 0.5, F.lit(0.5) + 2 * (F.col("lon") - 0.25))
        return cells.select("lat", "lon", floor.alias("deptho"))

    @staticmethod
    def part_cells(part: DataFrame) -> DataFrame:
        return part.select(
            (F.lit(-1.75) + F.lit(0.5) * (F.col("p_partkey") % 8)).alias("lat"),
            (F.lit(0.25) + F.lit(0.5) * (F.floor(F.col("p_partkey") / 8.0) % 8)).alias("lon"),
            "p_size",
        )

    def static(self) -> Cube:
        """(lat, lon): deptho, missing on land."""
        return Cube.of({("lat", "lon"): self.static_frame()}, {"lat": self.lat, "lon": self.lon})

    def stock(self) -> Cube:
        """(lat, lon): size (whole numbers), fraction (0 to 1), and deptho of ``static``."""
        cells = self.part_cells(self.table("part")).groupBy("lat", "lon")
        largest = F.max("p_size")
        frame = cells.agg(largest.cast("double").alias("size"), (largest / F.lit(50.0)).alias("fraction"))
        floor = F.when(F.col("lon") > 0.5, F.lit(0.5) + 2 * (F.col("lon") - 0.25))
        return Cube.of(
            {("lat", "lon"): frame.withColumn("deptho", floor)}, {"lat": self.lat, "lon": self.lon}
        )

    def daily(self) -> Cube:
        """(time, cell): x, several years of days."""
        keyed = self.table("orders").select(
            F.date_trunc("day", "o_orderdate").alias("time"),
            (F.col("o_custkey") % 16).cast("int").alias("cell"),
            "o_totalprice",
        )
        frame = keyed.groupBy("time", "cell").agg(money("o_totalprice").alias("x"))
        return Cube.of({("time", "cell"): frame}, {"cell": self.axis("cell", F.col("id").cast("int"), 16)})

    def runs(self) -> DataFrame:
        """init_time, step_h, cell: tp accumulated since the start of the run."""
        from pyspark.sql.window import Window

        parts = self.table("events").select(
            F.date_trunc("day", "ts").alias("init_time"),
            (F.floor(F.hour("ts") / 3.0) * 3).cast("int").alias("step_h"),
            (F.col("user_id") % 4).cast("int").alias("cell"),
            F.col("value").cast("decimal(18,2)").alias("value"),
        )
        sums = parts.groupBy("init_time", "step_h", "cell").agg(F.sum("value").alias("s"))
        order = Window.partitionBy("init_time", "cell").orderBy("step_h")
        so_far = F.sum("s").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return sums.select("init_time", "step_h", "cell", so_far.cast("double").alias("tp"))


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Computed columns rounded, for comparison by value."""
    return df.withColumns({n: F.round(n, digits) for n in names})


__all__ = ["QUERIES", "SQL", "Tables", "query", "rounded", "stamp"]
