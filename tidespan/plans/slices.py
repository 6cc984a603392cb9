"""Time slices: split the timeline of a hot key over many tasks.

A window partitioned by key alone puts every row of a key into one task. Here the work is partitioned by
(key, slice) instead, where slices hold about equally many rows, and a summary with at most one row per
(key, slice) carries running values from slice to slice.

Cut points are exact percentiles of a hash-selected part of the time column, which may have any ordered type (for types
without percentiles, of its distinct values). The selection affects only where
the cuts lie, never which rows are processed, and it is a pure function of the data: every branch of a plan, and
every retry, sees the same cuts. The cuts reach the plan as one scalar subquery of bounded size.
"""

from __future__ import annotations

from copy import copy

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.time import INF

SLICE = "_slice"
CUTS = "_cuts"
SAMPLE_TARGET = 20_000
PICKED_PER_SLICE = 64


def slice_count(spark: SparkSession) -> int:
    """Power of two near twice the shuffle partitions; `tidespan.slices` overrides."""
    given = spark.conf.get("tidespan.slices", None)
    wanted = int(given) if given else 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 1 << (max(2, wanted) - 1).bit_length()


class Cuts:
    """Cut points of one time column, planned once and shared by all frames derived from it."""

    def __init__(self, df: DataFrame, keys, time: str):
        self._rows = df.select(*keys, F.col(time).alias("_t"))
        self._keys = list(keys)
        self.count = slice_count(df.sparkSession)
        self._column = None
        self._shift, self._least = 0, 0

    def shifted(self, ticks: int) -> Cuts:
        """The same cuts for times moved by a constant."""
        other = copy(self)
        other._shift = self._shift + ticks
        return other

    def apart(self, least: int) -> Cuts:
        """The same cuts without those that are less than `least` ticks after the one before."""
        other = copy(self)
        other._column, other._least = None, least
        return other

    def column(self) -> Column:
        if self._column is None:
            total = self._rows.agg(F.count(F.lit(1)).alias("n")).scalar()
            target = max(SAMPLE_TARGET, PICKED_PER_SLICE * self.count)
            step = F.greatest(F.lit(1), F.floor(total / F.lit(target))).cast("long")
            picked = self._rows.where(F.pmod(F.xxhash64(*self._keys, "_t"), step) == 0)
            kind = self._rows.schema["_t"].dataType
            if isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType)):
                shares = F.expr(f"array({', '.join(f'{i / self.count!r}D' for i in range(1, self.count))})")
                points = F.percentile("_t", shares)
                if isinstance(kind, T.IntegralType):
                    points = F.transform(points, lambda x: x.cast("long"))
            else:
                values = F.sort_array(F.collect_set("_t"))
                places = F.expr(f"sequence(1, {self.count - 1})")
                points = F.transform(places, lambda i: F.get(values, F.floor(i * F.size(values) / self.count).cast("int")))
            found = picked.agg(points.alias("p"))
            if self._least:
                # all dropped cuts go to the end, where no time reaches them: slices stay numbered without gaps
                none, last = F.array().cast("array<bigint>"), F.element_at("p", F.lit(-1))
                far = lambda kept, x: (F.size(kept) == 0) | (x >= F.try_element_at(kept, F.lit(-1)) + F.lit(self._least))
                kept = F.aggregate("p", none, lambda kept, x: F.when(far(kept, x), F.array_append(kept, x)).otherwise(kept))
                rest = F.array_repeat(F.lit(INF).cast("long"), F.lit(self.count - 1) - F.size(kept))
                found = found.select(F.when(last.isNotNull(), F.concat(kept, rest)).otherwise(F.col("p")).alias("p"))
            self._column = found.scalar()
        return self._column

    def attach(self, df: DataFrame, time: str, name: str = SLICE) -> DataFrame:
        """Add the slice number of `time` (number of cut points not after it, by binary search); nulls go last."""
        t = F.col(time) - F.lit(self._shift) if self._shift else F.col(time)
        df = df.withColumn(CUTS, self.column()).withColumn(name, F.lit(0))
        span = self.count
        while span > 1:
            # each step narrows the range to a quarter (or half); plain expressions, so it stays in generated code
            ways = 4 if span % 4 == 0 else 2
            span //= ways
            hits = [
                t.isNull() | F.coalesce(F.element_at(CUTS, F.col(name) + i * span) <= t, F.lit(False))
                for i in range(1, ways)
            ]
            passed = sum((h.cast("int") for h in hits), F.lit(0))
            df = df.withColumn(name, F.col(name) + passed * F.lit(span))
        return df.drop(CUTS)


def match(left: str, right: str, cols) -> Column:
    """Null-safe equality of same-named columns of two aliased inputs."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return cond


def by(keys):
    """Partitioning list for a summary window; without keys the summary has one row per slice."""
    return [F.col(f"`{k}`") for k in keys] or [F.lit(0)]


def carry(df: DataFrame, keys, summary: dict[str, Column], carried) -> DataFrame:
    """Join back values carried between slices.

    `summary` are aggregates per (key, slice); `carried(w)` maps output names to expressions over the summary,
    where `w` orders the slices of a key.
    """
    group = [*keys, SLICE]
    per_slice = df.groupBy(*group).agg(*[e.alias(n) for n, e in summary.items()])
    w = Window.partitionBy(*by(keys)).orderBy(SLICE)
    out = carried(w)
    per_slice = per_slice.select(*group, *[e.alias(n) for n, e in out.items()])
    joined = df.alias("l").join(per_slice.alias("r"), match("l", "r", group), "inner")
    return joined.select("l.*", *[F.col(f"r.`{n}`") for n in out])


def local(keys) -> Window:
    return Window.partitionBy(*[F.col(f"`{k}`") for k in keys], F.col(SLICE))


BEFORE = (Window.unboundedPreceding, -1)
UPTO = (Window.unboundedPreceding, Window.currentRow)
