"""Windows, sessions and interval joins by Spark's own stateful operators.

Times are the `vs` column in microseconds. The watermark is put on the computed window start, so a window is
final (and emitted in append mode) once `delay` has passed beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.time import INF, snap_left, snap_right


def _marked(df: DataFrame, time, delay: str, name="_at") -> DataFrame:
    return df.withColumn(name, F.timestamp_micros(time)).withWatermark(name, delay)


def _unmarked(df: DataFrame, keys, size, outs) -> DataFrame:
    vs = F.unix_micros("_at")
    return df.select(*keys, vs.alias("vs"), (vs + size).alias("ve"), *outs)


def tumbling_windows(df: DataFrame, keys, size: int, delay: str, offset=0, **aggs) -> DataFrame:
    """Aggregates of the windows (T-size, T], reported over [T, T+size)."""
    df = _marked(df, snap_right("vs", size, offset), delay)
    out = df.groupBy("_at", *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return _unmarked(out, keys, size, aggs)


def hopping_windows(df: DataFrame, keys, size: int, period: int, delay: str, offset=0, **aggs) -> DataFrame:
    """Aggregates of the windows (T-size, T] at every hop T, reported over [T, T+period).

    The size need not be a multiple of the period. Where it is smaller, rows between windows are left out, and a window
    is reported over [T, T+size).
    """
    first, last = snap_right("vs", period, offset), F.col("vs") + F.lit(size - 1)
    hops = F.when(first <= last, F.sequence(first, last, F.lit(period)))
    df = _marked(df.withColumn("_hop", F.explode(hops)), F.col("_hop"), delay)
    out = df.groupBy("_at", *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return _unmarked(out, keys, min(size, period), aggs)


def partial_windows(df: DataFrame, keys, size: int, progress: int, delay: str, **aggs) -> DataFrame:
    """Early results: every window (floor-aligned) reported for each `progress` step it has reached."""
    start = snap_left("vs", size)
    step = snap_left("vs", progress)
    steps = F.explode(F.sequence(step, start + F.lit(size - progress), F.lit(progress)))
    df = _marked(df.withColumn("_start", start).withColumn("_step", steps), F.col("_step"), delay)
    out = df.groupBy("_at", "_start", *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    vs = F.unix_micros("_at")
    return out.select(*keys, vs.alias("vs"), (vs + progress).alias("ve"), *aggs)


def sessions(df: DataFrame, keys, timeout: int, delay: str, **aggs) -> DataFrame:
    """Sessions with a gap of at least `timeout` between them, as [first event, last event + timeout).

    `session_window` merges events whose distance equals its gap, hence the gap is one microsecond less.
    """
    df = _marked(df, F.col("vs"), delay)
    gap = F.session_window("_at", f"{timeout - 1} microseconds")
    out = df.groupBy(gap.alias("_s"), *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    start, end = F.unix_micros("_s.start"), F.unix_micros("_s.end") + 1
    return out.select(*keys, start.alias("vs"), end.alias("ve"), *aggs)


def interval_join(left: DataFrame, right: DataFrame, on: str, duration: int, delay: str, how="inner") -> DataFrame:
    """Rows with equal keys that start less than `duration` apart; both live for `duration`.

    Payload columns must be named differently on the two sides. `how="leftOuter"` adds unmatched left rows.
    """
    a = _marked(left.withColumnRenamed("vs", "l_vs"), F.col("l_vs"), delay, "_l")
    b = _marked(right.withColumnRenamed("vs", "r_vs").withColumnRenamed(on, "_on"), F.col("r_vs"), delay, "_r")
    whole, rest = divmod(duration - 1, 1_000_000)
    near = F.expr(f"INTERVAL '{whole}.{rest:06d}' SECOND")  # a literal, from which Spark derives state limits
    cond = (F.col(on) == F.col("_on")) & (F.col("_r") >= F.col("_l") - near) & (F.col("_r") <= F.col("_l") + near)
    out = a.join(b, cond, how)
    vs = F.greatest("l_vs", "r_vs")  # greatest and least skip the null of an unmatched row
    keep = [c for c in a.columns if c not in ("l_vs", "_l")] + [
        c for c in b.columns if c not in ("r_vs", "_r", "_on")
    ]
    return out.select(vs.alias("vs"), (F.least("l_vs", "r_vs") + duration).alias("ve"), *keep)


def evolving_state(df: DataFrame, keys, delay: str) -> DataFrame:
    """How the number of active rows per key changes: net change per instant, for rows with `vs` and `ve`.

    The state at a time is the sum of the changes up to it; a consumer adds them up as they arrive.
    """
    edges = F.array(
        F.struct(F.col("vs").alias("t"), F.lit(1).cast("long").alias("w")),
        F.struct(F.col("ve").alias("t"), F.lit(-1).cast("long").alias("w")),
    )
    rows = df.select(*keys, F.explode(edges).alias("_e")).where(F.col("_e.t") < INF)
    rows = _marked(rows, F.col("_e.t"), delay)
    out = rows.groupBy("_at", *keys).agg(F.sum("_e.w").alias("change")).where("change <> 0")
    return out.select(*keys, F.unix_micros("_at").alias("vs"), "change")
