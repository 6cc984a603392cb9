"""Clip and anti joins on streams whose keys have most of the rows, or that have no key.

As for snapshots, time is cut into buckets and rows are kept in each bucket that their lifetime touches: what one key
holds is spread over its buckets. When the watermark passes the end of a bucket, a timer solves it by itself and emits
what it knows of every row; `whole_clips` and `whole_stretches` put that together when the output is read. Lifetimes are
finite; an open one fails the query.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Row, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType, _parse_datatype_string

from ..functions.time import INF
from .stateful import _tagged

#: Rows that are handed to the state at once.
ADDED = 10_000


def appended(state, rows) -> None:
    """Add rows to a list state, a bounded number at a time."""
    rows = iter(rows)
    while some := list(islice(rows, ADDED)):
        state.appendList(some)


class _Solved(StatefulProcessor):
    def __init__(self, schema: StructType, width: int, solve, names: list[str]):
        self.schema, self.width, self.solve, self.names = schema, width, solve, names

    def init(self, handle):
        self.handle, self.rows = handle, handle.getListState("rows", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        fields = self.schema.names
        appended(self.rows, (tuple(r[f] for f in fields) for r in rows))
        self.handle.registerTimer(-(-(key[-1] + 1) * self.width // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        left, right = [], []
        for side, vs, ve, *payload in self.rows.get():
            if side:
                right.append((vs, ve))
            else:
                left.append((vs, ve, *payload))
        self.rows.clear()
        lo, make = key[-1] * self.width, Row(*self.names)
        for found in self.solve(left, np.array(right, np.int64).reshape(-1, 2), lo, lo + self.width):
            yield make(*key[:-1], *found)

    def close(self):
        pass


def clipped(left, right, lo: int, hi: int):
    """(vs, ve, payload, the first event inside, if the row starts here, if it ends here), for rows that do or have one."""
    events = np.unique(right[:, 0])
    nexts = np.searchsorted(events, [max(vs, lo - 1) for vs, *_ in left], side="right")
    for (vs, ve, *payload), i in zip(left, nexts, strict=True):
        clip = int(events[i]) if i < len(events) and events[i] < ve else None
        if clip is not None or vs >= lo or ve <= hi:
            yield vs, ve, *payload, clip, vs >= lo, ve <= hi


def uncovered(left, right, lo: int, hi: int):
    """(vs, ve, payload, the row's own times, if the piece goes on before, and after) of stretches without a right row."""
    right = right[np.argsort(right[:, 0], kind="stable")]
    begins = np.append(right[:, 0], hi)
    # up to the first right row, then from where all so far have ended to the next one
    since = np.maximum.accumulate(np.concatenate(([lo], right[:, 1])))
    real = since < begins
    since, begins = since[real], begins[real]
    starts, ends = ([f(r[i], b) for r in left] for f, i, b in ((max, 0, lo), (min, 1, hi)))
    first, last = np.searchsorted(begins, starts, side="right"), np.searchsorted(since, ends, side="left")
    since, begins = since.tolist(), begins.tolist()
    for (vs, ve, *payload), a, b, i, j in zip(left, starts, ends, first.tolist(), last.tolist(), strict=True):
        for g in range(i, j):
            start, end = max(since[g], a), min(begins[g], b)
            if start < end:
                yield start, end, *payload, vs, ve, start == lo > vs, end == hi < ve


def _filed(left: DataFrame, right: DataFrame, keys, bucket: int, delay: str, solve, more: str) -> DataFrame:
    rows, mine, _ = _tagged(left, right, keys)
    rows = rows.drop("_all")
    ends = F.when(F.col("ve") >= INF, F.raise_error(F.lit("an open lifetime has no last bucket"))).otherwise(F.col("ve"))
    number = lambda t: F.floor((t - F.pmod(t, F.lit(bucket))) / bucket).cast("long")
    rows = rows.select(*keys, "_side", "vs", ends.alias("ve"), *[f"`{c}`" for c in mine], F.timestamp_micros("vs").alias("_at"))
    rows = rows.withWatermark("_at", delay)
    touched = F.sequence(number(F.col("vs")), number(F.greatest(F.col("vs"), F.col("ve") - 1)))
    rows = rows.withColumn("_bucket", F.explode(touched))
    state = StructType([rows.schema[c] for c in ("_side", "vs", "ve", *mine)])
    fields = [rows.schema[k] for k in keys] + [rows.schema[c] for c in ("vs", "ve", *mine)]
    out = StructType([*fields, *_parse_datatype_string(more).fields])
    return rows.groupBy(*keys, "_bucket").transformWithState(_Solved(state, bucket, solve, out.names), out, "Append", "EventTime")


def clip_by(left: DataFrame, right: DataFrame, keys, bucket: int, delay: str) -> DataFrame:
    """`TemporalFrame.clip_by` on streams, by buckets of so many ticks; read with `whole_clips`."""
    more = "_clip bigint, _first boolean, _last boolean"
    return _filed(left, right.select(*keys, "vs"), keys, bucket, delay, clipped, more)


def whole_clips(found: DataFrame) -> DataFrame:
    """The rows of `clip_by` whose end is known, with that end."""
    own = [c for c in found.columns if c not in ("_clip", "_first", "_last")]
    rows = found.groupBy(*own).agg(F.min("_clip").alias("_clip"), F.count_if("_first").alias("_n"), F.bool_or("_last").alias("_last"))
    rows = rows.where(F.col("_last") | F.col("_clip").isNotNull()).withColumn("ve", F.least("ve", "_clip"))
    return rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*own)


def anti_join(left: DataFrame, right: DataFrame, keys, bucket: int, delay: str) -> DataFrame:
    """`TemporalFrame.where_not_exists` on streams, by buckets of so many ticks; read with `whole_stretches`."""
    more = "_vs bigint, _ve bigint, _cut_before boolean, _cut_after boolean"
    return _filed(left, right.select(*keys, "vs", "ve"), keys, bucket, delay, uncovered, more)


def whole_stretches(pieces: DataFrame) -> DataFrame:
    """The stretches of `anti_join`, with pieces that buckets cut put together again."""
    cut = F.col("_cut_before") | F.col("_cut_after")
    names = [c for c in pieces.columns if not c.startswith("_")]
    row = [c for c in pieces.columns if c not in ("vs", "ve", "_cut_before", "_cut_after")]
    # equal rows have equal pieces
    parts = pieces.where(cut).groupBy(*row, "vs", "ve").agg(F.count("*").alias("_n"))
    along = Window.partitionBy(*[F.col(f"`{c}`") for c in row]).orderBy("vs")
    fresh = F.coalesce(F.lag("ve").over(along) != F.col("vs"), F.lit(True)).cast("int")
    parts = parts.withColumn("_fresh", fresh).withColumn("_run", F.sum("_fresh").over(along))
    joined = parts.groupBy(*row, "_run").agg(F.min("vs").alias("vs"), F.max("ve").alias("ve"), F.first("_n").alias("_n"))
    joined = joined.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return pieces.where(~cut).select(*names).unionByName(joined.select(*names))
