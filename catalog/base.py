"""Registry and shared inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidespan import TemporalFrame
from tidespan.functions.time import INF, micros, snap_left
from tidespan.sources import ingress

QUERIES = {}
ORACLES = {}

HOUR = 3_600_000_000
DAY = 24 * HOUR


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is its answer in DuckDB's SQL."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(Tables(spark, sf_dir))
            return out.df if isinstance(out, TemporalFrame) else out

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


class Tables:
    """Frames over the given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def events(self) -> DataFrame:
        cents = F.round(F.col("value") * 100).cast("bigint").alias("cents")
        return self.read("events").select("event_id", "user_id", "event_type", cents, "ts")

    def points(self, *cols) -> TemporalFrame:
        """Events as points in time."""
        cols = cols or ("event_id", "user_id", "event_type", "cents")
        return ingress.from_points(self.events(), micros("ts")).select(*cols)

    def intervals(self, *cols) -> TemporalFrame:
        """Events that last one to seven hours."""
        cols = cols or ("event_id", "user_id", "event_type", "cents")
        vs = micros("ts")
        hours = F.lit(1) + F.pmod(F.col("event_id"), F.lit(7))
        return ingress.from_intervals(self.events(), vs, vs + hours * HOUR, check=False).select(*cols)

    def opened(self, *cols) -> TemporalFrame:
        """Events that stay active for ever."""
        cols = cols or ("event_id", "user_id", "event_type", "cents")
        return ingress.from_starts(self.events(), micros("ts")).select(*cols)

    def hourly(self, *cols) -> TemporalFrame:
        """Points floored to the hour, so that many share an instant."""
        cols = cols or ("event_id", "user_id", "event_type", "cents")
        return ingress.from_points(self.events(), snap_left(micros("ts"), HOUR)).select(*cols)

    def orders(self) -> TemporalFrame:
        """Orders, open-ended from their date."""
        df = self.read("orders").withColumn("price", F.round(F.col("o_totalprice") * 100).cast("bigint"))
        return ingress.from_starts(df, micros("o_orderdate")).select(
            "o_orderkey", "o_custkey", "o_orderstatus", "price"
        )

    def items(self) -> TemporalFrame:
        """Line items, open-ended from their ship date."""
        df = self.read("lineitem").withColumn("price", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
        return ingress.from_starts(df, micros("l_shipdate")).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "price"
        )


# Inputs as SQL, for the independent answers.
CENTS = "CAST(round(value * 100) AS BIGINT) AS cents"
POINTS = f"SELECT event_id, user_id, event_type, {CENTS}, epoch_us(ts) AS vs, epoch_us(ts) + 1 AS ve FROM events"
INTERVALS = (
    f"SELECT event_id, user_id, event_type, {CENTS}, epoch_us(ts) AS vs, "
    f"epoch_us(ts) + (1 + event_id % 7) * {HOUR} AS ve FROM events"
)
OPENED = f"SELECT event_id, user_id, event_type, {CENTS}, epoch_us(ts) AS vs, {INF} AS ve FROM events"
HOURLY = (
    f"SELECT event_id, user_id, event_type, {CENTS}, epoch_us(ts) // {HOUR} * {HOUR} AS vs, "
    f"epoch_us(ts) // {HOUR} * {HOUR} + 1 AS ve FROM events"
)
ORDERS = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS price, "
    f"epoch_us(o_orderdate) AS vs, {INF} AS ve FROM orders"
)
ITEMS = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, "
    "CAST(round(l_extendedprice * 100) AS BIGINT) AS price, "
    f"epoch_us(l_shipdate) AS vs, {INF} AS ve FROM lineitem"
)


def segments_sql(source: str, keys: str = "", out: str = "count(*) AS n", where: str = "true") -> str:
    """Snapshots by definition: cut time at all endpoints, then aggregate the rows active in each piece."""
    comma = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    same = "".join(f"s.{k} IS NOT DISTINCT FROM e.{k} AND " for k in keys.split(", ") if k)
    skeys = "".join(f"s.{k}, " for k in keys.split(", ") if k)
    return f"""
WITH src AS ({source}),
pts AS (SELECT {comma}vs AS t FROM src UNION SELECT {comma}ve FROM src),
seg AS (SELECT * FROM (SELECT {comma}t AS vs, lead(t) OVER ({part} ORDER BY t) AS ve FROM pts) WHERE ve IS NOT NULL)
SELECT {skeys}s.vs, s.ve, {out}
FROM seg s JOIN src e ON {same}e.vs <= s.vs AND e.ve > s.vs
WHERE {where}
GROUP BY {skeys}s.vs, s.ve"""
