"""Snapshot aggregates on streams, for rows with general lifetimes.

Time is cut into buckets, and rows are kept once in each bucket that their lifetime touches, as entries of a list state of
(keys, bucket): a key that has most of the rows, or no key at all, is spread over its buckets, and a trigger only adds
the rows that it brings. When the watermark passes the end of a bucket, a timer reads its rows once, in order, and
emits its snapshots. Values are kept in order, so minima, maxima, percentiles and the first k follow every start and end.
Sums are exact: of floating-point numbers as whole multiples of the smallest of them, rounded once when they are shown.

A snapshot that goes on beyond a bucket comes out in pieces; `whole` puts them together when the output is read.
"""

from __future__ import annotations

import math
from array import array
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Row, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType, _parse_datatype_string

from ..functions.time import INF
from ..plans.slices import by
from .bucketed import appended

#: Doubles are whole multiples of two to the power of minus this.
FINEST = 1074


@dataclass(frozen=True)
class Live:
    """An aggregate of a column: its kind, a parameter, and the type of its result (that of the column if none)."""

    kind: str
    column: str | None = None
    given: float | int | None = None
    type: str | None = None


def count() -> Live:
    return Live("count", type="bigint")


def sum_(column: str) -> Live:
    """Zero if nothing is active. Whole numbers add up to a bigint, others to a double."""
    return Live("sum", column)


def min_(column: str) -> Live:
    return Live("min", column)


def max_(column: str) -> Live:
    return Live("max", column)


def percentile_continuous(column: str, share: float) -> Live:
    """Linear interpolation at share * (n - 1) of the ordered values."""
    return Live("continuous", column, share, "double")


def percentile_discrete(column: str, share: float) -> Live:
    """The value at place ceil(share * n) of the ordered values."""
    return Live("discrete", column, share)


def top(column: str, k: int) -> Live:
    """The k largest values, in descending order."""
    return Live("top", column, k)


class _Values:
    """The active values of a column that are not null, in order, and their sum."""

    def __init__(self):
        self.ordered, self.total, self.odd = [], 0, []

    def change(self, value, sign):
        if value is None:
            return
        if isinstance(value, float) and math.isnan(value):
            value = _Nan.last
        if sign > 0:
            insort(self.ordered, value)
        else:
            del self.ordered[bisect_left(self.ordered, value)]
        if isinstance(value, int):
            self.total += sign * value
        elif isinstance(value, float) and math.isfinite(value):
            top_, bottom = value.as_integer_ratio()
            self.total += sign * (top_ << (FINEST - bottom.bit_length() + 1))
        elif isinstance(value, float):
            self.odd.append(value) if sign > 0 else self.odd.remove(value)
        elif value is _Nan.last:
            self.odd.append(math.nan) if sign > 0 else self.odd.pop(next(i for i, x in enumerate(self.odd) if x != x))

    def result(self, live: Live):
        n = len(self.ordered)
        show = lambda v: math.nan if v is _Nan.last else v
        if live.kind == "sum":
            if live.type == "bigint":
                return self.total
            return sum(self.odd) if self.odd else self.total / (1 << FINEST)
        if live.kind == "top":
            return [show(v) for v in self.ordered[: -live.given - 1 : -1]]
        if not n:
            return None
        if live.kind == "min":
            return show(self.ordered[0])
        if live.kind == "max":
            return show(self.ordered[-1])
        if live.kind == "discrete":
            return show(self.ordered[max(math.ceil(live.given * n), 1) - 1])
        at = live.given * (n - 1)
        low, high = (float(show(self.ordered[i])) for i in (math.floor(at), math.ceil(at)))
        return low + (high - low) * (at - math.floor(at))


class _Nan(float):
    """NaN in its place: after all other numbers."""

    def __lt__(self, other):
        return False

    def __gt__(self, other):
        return not isinstance(other, _Nan)

    def __eq__(self, other):
        return isinstance(other, _Nan)

    __hash__ = float.__hash__


_Nan.last = _Nan(math.inf)


def snapshots(rows, lo: int, hi: int, aggs: list[Live], columns: list[str]):
    """(vs, ve, results, whether the piece is cut at its beginning, and at its end) of the rows within [lo, hi)."""
    starts, ends, given = array("q"), array("q"), [[] for _ in columns]
    for vs, ve, *found in rows:  # read once, into columns
        starts.append(vs)
        ends.append(ve)
        for column, v in zip(given, found, strict=True):
            column.append(v)
    starts, ends = np.array(starts, np.int64), np.array(ends, np.int64)
    starts_at_lo, ends_at_hi = bool((starts == lo).any()), bool((ends == hi).any())
    over = np.flatnonzero(ends < hi)
    times = np.concatenate((np.maximum(starts, lo), ends[over]))
    # edge i of the first ones begins row i; ends come before starts of their instant
    row = np.concatenate((np.arange(len(starts)), over))
    sign = np.repeat(np.array([1, -1], np.int8), [len(starts), len(over)])
    order = np.lexsort((row, sign, times))
    times, row, sign = times[order], row[order], sign[order]
    bounds = np.append(np.flatnonzero(np.diff(times)) + 1, len(times)) if len(times) else ()
    values, active, k = {c: _Values() for c in columns}, 0, 0
    for stop in map(int, bounds):
        t = int(times[k])
        for i, change in zip(row[k:stop].tolist(), sign[k:stop].tolist(), strict=True):
            active += change
            for c, column in zip(columns, given, strict=True):
                values[c].change(column[i], change)
        k = stop
        until = int(times[k]) if k < len(times) else hi
        if active:
            found = [active if a.kind == "count" else values[a.column].result(a) for a in aggs]
            yield t, until, found, t == lo and not starts_at_lo, k == len(times) and not ends_at_hi


class _Bucket(StatefulProcessor):
    def __init__(self, schema: StructType, aggs: list[Live], columns: list[str], width: int, names: list[str]):
        self.schema, self.aggs, self.columns, self.width, self.names = schema, aggs, columns, width, names

    def init(self, handle):
        self.handle, self.rows = handle, handle.getListState("rows", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        fields = self.schema.names
        appended(self.rows, (tuple(r[f] for f in fields) for r in rows))
        self.handle.registerTimer(-(-(key[-1] + 1) * self.width // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        lo = key[-1] * self.width
        make = Row(*self.names)
        for vs, ve, found, *cuts in snapshots(self.rows.get(), lo, lo + self.width, self.aggs, self.columns):
            yield make(*key[:-1], vs, ve, *found, *cuts)
        self.rows.clear()

    def close(self):
        pass


def aggregate(df: DataFrame, keys, bucket: int, delay: str, **aggs: Live) -> DataFrame:
    """`TemporalFrame.aggregate` on a stream, in pieces of at most a bucket; `keys` may be empty.

    `bucket` is a number of ticks: as long as results may wait, and as short as the rows of a key that live in it fit a
    task. Lifetimes are finite; an open one fails the query.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    typed = {}
    for n, a in aggs.items():
        kind = a.type or kinds[a.column]
        if a.kind == "sum":
            kind = "bigint" if kind in ("tinyint", "smallint", "int", "bigint") else "double"
        typed[n] = Live(a.kind, a.column, a.given, f"array<{kind}>" if a.kind == "top" else kind)
    columns = list(dict.fromkeys(a.column for a in aggs.values() if a.column))
    values = [F.col(c).cast("double") if kinds[c].startswith("decimal") else F.col(c) for c in columns]
    ends = F.when(F.col("ve") >= INF, F.raise_error(F.lit("an open lifetime has no last bucket"))).otherwise(F.col("ve"))
    number = lambda t: F.floor((t - F.pmod(t, F.lit(bucket))) / bucket).cast("long")
    rows = df.select(
        *keys, "vs", ends.alias("ve"), *[v.alias(c) for v, c in zip(values, columns, strict=True)],
        F.timestamp_micros("vs").alias("_at"),
    ).withWatermark("_at", delay)
    rows = rows.withColumn("_bucket", F.explode(F.sequence(number(F.col("vs")), number(F.col("ve") - 1))))
    state = StructType([rows.schema[c] for c in ("vs", "ve", *columns)])
    cuts = _parse_datatype_string("_cut_before boolean, _cut_after boolean").fields
    results = _parse_datatype_string(", ".join(["vs bigint", "ve bigint", *(f"`{n}` {a.type}" for n, a in typed.items())])).fields
    out = StructType([*[rows.schema[k] for k in keys], *results, *cuts])
    processor = _Bucket(state, list(typed.values()), columns, bucket, out.names)
    return rows.groupBy(*keys, "_bucket").transformWithState(processor, out, "Append", "EventTime")


def whole(pieces: DataFrame, keys) -> DataFrame:
    """What `aggregate` has written, with pieces that buckets cut put together again."""
    cut = F.col("_cut_before") | F.col("_cut_after")
    results = [c for c in pieces.columns if c not in (*keys, "vs", "ve", "_cut_before", "_cut_after")]
    # of each key and bucket at most its first and last piece
    along = Window.partitionBy(*by(keys)).orderBy("vs")
    # a bucket knows which of its rows start at its beginning or end at its end; both sides must have seen no such instant
    goes_on = F.col("_cut_before") & F.lag("_cut_after").over(along) & (F.lag("ve").over(along) == F.col("vs"))
    parts = pieces.where(cut).withColumn("_fresh", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    parts = parts.withColumn("_run", F.sum("_fresh").over(along))
    firsts = [F.first(c).alias(c) for c in results]
    joined = parts.groupBy(*keys, "_run").agg(F.min("vs").alias("vs"), F.max("ve").alias("ve"), *firsts)
    names = [*keys, "vs", "ve", *results]
    return pieces.where(~cut).select(*names).unionByName(joined.select(*names))
