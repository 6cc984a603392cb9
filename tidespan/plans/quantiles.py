"""Exact order statistics of the active values of every snapshot.

A percentile cannot be merged from parts, and listing the active values of each snapshot would cost the sum of all
snapshot sizes. Between two snapshots, though, the wanted place moves little: an event changes it by one or two. So each
stretch of a key's history is scanned on its own, with the active values around the wanted place and the number of those
below them; a cursor follows the place from event to event.

What a stretch must know of the values that are active when it begins is found from a table of counts by stretch and
block of values, summed along time: it names the few blocks that the place can reach within the stretch, and only
the active values of these blocks are handed to it. Keys get as many stretches, and as many blocks, as their share of all
events, so a key with few events is one stretch that begins with nothing, and the table has at most one cell for each
pair of slices.

Values may be of any ordered type: whole numbers stand for themselves, others are numbered first.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType, LongType, StructField, StructType

from ..functions.time import INF
from ..sources.scratch import settle
from .ordered import scan_ordered
from .slices import BEFORE, SLICE, UPTO, Cuts, by, carry, local, match
from .sweep import sweep
from .timeline import instants

STRETCH, BLOCK, PARTS = "_stretch", "_vblock", "_parts"
#: Kinds of rows of a stretch, in the order in which they count at an instant.
HELD, BELOW, EVENT, ASKED = range(4)


def numbered_values(rows: DataFrame) -> DataFrame:
    """(_v, _id): the distinct values in order. Numbers come from counts per slice, not from a global window."""
    distinct = instants(rows, [], "_v", Cuts(rows, [], "_v"))
    distinct = carry(
        distinct, [], {"_n": F.count(F.lit(1))}, lambda w: {"_base": F.sum("_n").over(w.rowsBetween(*BEFORE))}
    )
    nth = F.row_number().over(local([]).orderBy("_v")) - 1 + F.coalesce(F.col("_base"), F.lit(0))
    return distinct.select("_v", nth.cast("long").alias("_id"))


def counted_segments(rows: DataFrame, keys, cuts: Cuts) -> DataFrame:
    """Segments (keys, vs, ve) with the number `_m` of non-null active values `_v`."""
    present = F.when(F.col("_v").isNotNull(), F.lit(1).cast("long"))
    return settle(sweep(rows, keys, {"_m": present}, cuts).select(*keys, "vs", "ve", "_m"))


def order_statistics(segments: DataFrame, rows: DataFrame, keys, cuts: Cuts, places) -> DataFrame:
    """The segments with one column per wanted rank.

    Each of `places` maps names to 0-based ranks close to each other, as expressions over the number `_m` of non-null
    active values. Keys that are not cut are scanned once for all of them, others once for each, since what a stretch
    must know of its beginning lies around one place.
    """
    rows = rows.where(F.col("_v").isNotNull())
    whole = isinstance(rows.schema["_v"].dataType, IntegralType)
    if whole:
        rows = rows.withColumn("_id", F.col("_v").cast("long"))
    else:
        values = settle(numbered_values(rows))
        rows = rows.join(values, "_v")
    events = settle(_events(rows, keys, cuts))
    wanted = {n: F.when(F.col("_m") > 0, r).cast("long") for near in places for n, r in near.items()}
    asked = cuts.attach(segments.select(*keys, "vs", "ve", "_m", *[r.alias(n) for n, r in wanted.items()]), "vs")
    asked = asked.withColumnRenamed("vs", "_t")
    parts = settle(_parts(events, keys, cuts.count))
    events, asked = (_placed(df, parts, keys, cuts.count) for df in (events, asked))
    cut = [df.where(F.col(PARTS) > 1) for df in (events, asked)]
    if len(places) == 1:
        found = _scanned(events, asked, _held(*cut, keys, list(wanted)), keys, list(wanted))
    else:
        found = _scanned(*[df.where(F.col(PARTS) == 1) for df in (events, asked)], None, keys, list(wanted))
        apart = [_scanned(*cut, _held(*cut, keys, list(near)), keys, list(near)) for near in places]
        for i, (near, more) in enumerate(zip(places, apart, strict=True)):
            both = more if i == 0 else both.alias("l").join(more.alias("r"), match("l", "r", [*keys, "vs"])).select("l.*", *[f"r.{n}" for n in near])
        found = found.unionByName(both)
    if whole:
        kind = rows.schema["_v"].dataType
        return found.select(*segments.columns, *[F.col(n).cast(kind).alias(n) for n in wanted])
    for n in wanted:
        named = values.select(F.col("_id").alias("_number"), F.col("_v").alias(f"_v{n}"))
        found = found.join(named, F.col(n) == F.col("_number"), "left").drop("_number", n).withColumnRenamed(f"_v{n}", n)
    return found.select(*segments.columns, *wanted)


def _events(rows: DataFrame, keys, cuts: Cuts) -> DataFrame:
    """Net change `_w` of the count of each value at each instant `_t`, with time slice and block of values."""
    both = F.array(
        F.struct(F.col("vs").alias("t"), F.lit(1).cast("long").alias("w")),
        F.struct(F.col("ve").alias("t"), F.lit(-1).cast("long").alias("w")),
    )
    events = rows.select(*keys, "_id", F.explode(both).alias("_e")).where(F.col("_e.t") < INF)
    events = events.groupBy(*keys, F.col("_e.t").alias("_t"), "_id").agg(F.sum("_e.w").alias("_w")).where("_w <> 0")
    return Cuts(rows, [], "_id").attach(cuts.attach(events, "_t"), "_id", BLOCK)


def _parts(events: DataFrame, keys, slices: int) -> DataFrame:
    """(keys, _parts): into how many stretches a key is cut; one of them has about a slice's share of all events."""
    total = events.agg(F.sum(F.abs("_w")).alias("n")).scalar()
    parts = F.least(F.lit(slices), F.ceil(F.sum(F.abs("_w")) * slices / total)).cast("int")
    return events.groupBy(*keys).agg(parts.alias(PARTS)).where(F.col(PARTS) > 1)


def _placed(df: DataFrame, parts: DataFrame, keys, slices: int) -> DataFrame:
    """Rows with the stretch and the value block of their key, in place of slice and block of all rows."""
    joined = df.alias("l").join(parts.alias("r"), match("l", "r", keys), "left").select("l.*", F.coalesce(f"r.{PARTS}", F.lit(1)).alias(PARTS))
    share = lambda c: F.floor(F.col(c) * F.col(PARTS) / slices).cast("int")
    out = joined.withColumn(STRETCH, share(SLICE)).drop(SLICE)
    return out.withColumn(BLOCK, share(BLOCK)) if BLOCK in df.columns else out


def _intervals(changes: DataFrame, keys, what) -> DataFrame:
    """From running sums of changes (keys, what, stretch, _w): (keys, what, _n, _from, _to), the stretches at whose
    beginnings `_n` > 0 are active."""
    w = Window.partitionBy(*by([*keys, *what])).orderBy(STRETCH)
    out = changes.select(
        *keys,
        *what,
        F.sum("_w").over(w.rowsBetween(*UPTO)).alias("_n"),
        (F.col(STRETCH) + 1).alias("_from"),
        F.lead(STRETCH).over(w).alias("_to"),
    )
    return out.where(F.col("_n") > 0)


def _held(events: DataFrame, asked: DataFrame, keys, names) -> DataFrame:
    """What stretches must know of the values active at their beginning: rows (keys, stretch, _kind, _id, _w, _lo, _hi).

    HELD rows are values with their counts. One BELOW row says how many are smaller, and which blocks were handed over.
    A place between `_low` and `_high` moves by one with each change, so it stays among the values that lie within that
    many changes of them at the beginning, and those that come in between.
    """
    group = [*keys, STRETCH]
    moved = events.groupBy(*group).agg(F.sum(F.abs("_w")).alias("_moves"))
    least, most = (F.least(*names), F.greatest(*names)) if len(names) > 1 else (F.col(names[0]),) * 2
    reach = asked.groupBy(*group).agg(F.min(least).alias("_low"), F.max(most).alias("_high"), F.max(PARTS).alias(PARTS))
    reach = reach.where(F.col("_low").isNotNull()).alias("l").join(moved.alias("r"), match("l", "r", group), "left")
    moves = F.coalesce("r._moves", F.lit(0))
    reach = settle(reach.select("l.*", (F.col("_low") - moves).alias("_first"), (F.col("_high") + moves).alias("_last")))

    cells = _intervals(events.groupBy(*group, BLOCK, PARTS).agg(F.sum("_w").alias("_w")), keys, [BLOCK, PARTS])
    until = F.coalesce("_to", F.col(PARTS) - 1)
    cells = cells.where(F.col("_from") <= until).withColumn(STRETCH, F.explode(F.sequence("_from", until)))
    along = Window.partitionBy(*by(group)).orderBy(BLOCK).rowsBetween(*BEFORE)
    cells = cells.select(*group, BLOCK, "_n", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_under"))
    joined = cells.alias("l").join(reach.alias("r"), match("l", "r", group)).select("l.*", "r._first", "r._last")
    reached = (F.col("_under") + F.col("_n") > F.col("_first")) & (F.col("_under") <= F.col("_last"))
    needed = settle(joined.where(reached).drop("_first"))
    # where nothing is left out on a side, there is no bound
    below = needed.groupBy(*group).agg(
        F.min("_under").alias("_w"),
        F.when(F.min("_under") > 0, F.min(BLOCK)).alias("_lo"),
        F.when(F.max(F.col("_under") + F.col("_n") - F.col("_last")) > 0, F.max(BLOCK)).alias("_hi"),
    )

    single = _intervals(events.groupBy(*group, BLOCK, "_id").agg(F.sum("_w").alias("_w")), keys, [BLOCK, "_id"])
    inside = match("l", "r", [*keys, BLOCK]) & (F.col(f"r.{STRETCH}") >= F.col("l._from"))
    inside = inside & (F.col("l._to").isNull() | (F.col(f"r.{STRETCH}") <= F.col("l._to")))
    held = single.alias("l").join(needed.alias("r"), inside)
    held = held.select(*[F.col(f"l.`{k}`") for k in keys], f"r.{STRETCH}", "l._id", F.col("l._n").alias("_w"))
    return held.withColumn("_kind", F.lit(HELD)).unionByName(below.withColumn("_kind", F.lit(BELOW)), allowMissingColumns=True)


class _Cursor:
    """Active values of a stretch, and for each wanted rank the value at it."""

    def __init__(self, n_keys: int, n_ranks: int, key):
        self.at, self.ranks, self.key = n_keys + 1, n_ranks, key
        self.ids, self.counts = [], {}
        self.places, self.before = [0] * n_ranks, [0] * n_ranks
        self.below, self.lo, self.hi = 0, None, None

    def row(self, values):
        kind, t, id_, w, block, lo, hi, ve, m, *ranks = values[self.at :]
        if kind == ASKED:
            return [(*self.key[:-1], t, ve, m, *[None if r is None else self._value(j, r - self.below) for j, r in enumerate(ranks)])]
        if kind == BELOW:
            self.below, self.lo, self.hi = w, lo, hi
        elif kind == EVENT and self.lo is not None and block < self.lo:
            self.below += w
        elif kind == HELD or self.hi is None or block <= self.hi:
            self._change(id_, w)
        return []

    def _change(self, id_, w):
        i = bisect_left(self.ids, id_)
        fresh = id_ not in self.counts
        left = self.counts.get(id_, 0) + w
        if fresh:
            self.ids.insert(i, id_)
        if left:
            self.counts[id_] = left
        else:
            del self.ids[i], self.counts[id_]
        for j, place in enumerate(self.places):
            if i < place or (fresh and i == place):
                self.before[j] += w
                self.places[j] += fresh - (not left)

    def _value(self, j, rank):
        place, before = self.places[j], self.before[j]
        while rank < before:
            place -= 1
            before -= self.counts[self.ids[place]]
        while rank >= before + self.counts[self.ids[place]]:
            before += self.counts[self.ids[place]]
            place += 1
        self.places[j], self.before[j] = place, before
        return self.ids[place]

    def end(self):
        return []


def _scanned(events: DataFrame, asked: DataFrame, held: DataFrame, keys, names) -> DataFrame:
    """(keys, vs, ve, _m, the value number at each rank) of every segment."""
    events = events.withColumn("_kind", F.lit(EVENT))
    asked = asked.withColumn("_kind", F.lit(ASKED))
    rows = events.unionByName(asked, allowMissingColumns=True)
    if held is None:  # no stretch begins with anything
        rows = rows.withColumns({"_lo": F.lit(None).cast("int"), "_hi": F.lit(None).cast("int")})
    else:
        rows = rows.unionByName(held, allowMissingColumns=True)
    kinds = {f.name: f for f in rows.schema.fields}
    key_fields = [kinds[k] for k in keys]
    numbers = [StructField(n, LongType()) for n in ("vs", "ve", "_m", *names)]
    group = [*keys, STRETCH]
    columns = [*group, "_kind", "_t", "_id", "_w", BLOCK, "_lo", "_hi", "ve", "_m", *names]
    n_keys, n_ranks = len(keys), len(names)
    # what is held has no time and comes first
    return scan_ordered(
        rows.select(*columns), group, ["_t", "_kind"], lambda key: _Cursor(n_keys, n_ranks, key), StructType([*key_fields, *numbers])
    )
