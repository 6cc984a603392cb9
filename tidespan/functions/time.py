"""Time arithmetic on 64-bit tick columns."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Fixed values of the time domain.
INF = 3155378975999999999
MIN_T = 0
MAX_T = INF - 1


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ column, whatever the session zone."""
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z", "+00:00"):
        return F.unix_micros(col(ts).cast("timestamp"))  # the same value, several times faster
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), col(ts))


def snap_left(t, period: int, offset: int = 0) -> Column:
    """Largest grid point (multiple of `period` plus `offset`) not after `t`."""
    t = col(t)
    return t - F.pmod(t - F.lit(offset), F.lit(period))


def snap_right(t, period: int, offset: int = 0) -> Column:
    """Smallest grid point not before `t`."""
    return snap_left(col(t) + F.lit(period - 1), period, offset)


def plus(t, ticks) -> Column:
    """`t + ticks`, leaving an open end open."""
    t = col(t)
    return F.when(t >= INF, F.lit(INF)).otherwise(t + ticks)
