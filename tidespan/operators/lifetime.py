"""Operators that reshape lifetimes."""

from __future__ import annotations

from collections import deque
from heapq import heappop, heappush

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.time import INF, col, plus, snap_left, snap_right
from ..plans.ordered import scan_ordered
from ..plans.slices import match
from ..plans.timeline import instants, with_following, with_latest, with_neighbours, with_running

def number(x):
    return F.lit(x) if isinstance(x, int) else col(x)


class LifetimeOps:
    def _lifetime(self, vs=None, ve=None, props=None, cuts=None):
        """Replace start and end at once, both computed from the old values."""
        times = {}
        if vs is not None:
            times["vs"] = vs.cast("long")
        if ve is not None:
            times["ve"] = ve.cast("long")
        return self._with(self.df.withColumns(times), props=props, cuts=cuts)

    def tumbling(self, size: int, offset: int = 0):
        """Windows (T-size, T], reported over [T, T+size)."""
        return self.hopping(size, size, offset)

    def hopping(self, size: int, period: int, offset: int = 0):
        """Windows (T-size, T] at every hop; an event counts from the first hop not before it."""
        frame = self
        if period > size:
            phase = F.pmod(F.col("vs") + F.lit(period - offset), F.lit(period))
            frame = self.where((phase > period - size) | (phase == 0))
        start = snap_right("vs", period, offset)
        if period > size or size % period == 0:
            props = self.props.but(duration=size, hop=period, offset=offset % period, open_ended=False)
            return frame._lifetime(start, start + size, props)
        return frame._lifetime(start, snap_right(F.col("vs") + size, period, offset))

    def repetitive_hopping(self, size: int, period: int, offset: int = 0):
        """Hopping windows whose every hop is reported, changed or not."""
        return self.hopping(size, period, offset).chop(offset, period)

    def quantize(self, size: int, period: int, offset: int = 0):
        """Move starts to the grid point before and ends to the grid point after."""
        return self._quantize(size, period, period, offset)

    def progressive_quantize(self, size: int, period: int, progress: int, offset: int = 0):
        """As quantize, with starts on a finer grid so that partial windows are reported early."""
        if progress >= period or period % progress:
            raise ValueError("progress must divide the period and be smaller than it")
        return self._quantize(size, period, progress, offset)

    def _quantize(self, size, period, progress, offset):
        end = F.greatest(F.col("ve") + F.lit(period - 1), F.col("vs") + F.lit(size))
        ve = F.when(F.col("ve") >= INF, F.lit(INF)).otherwise(snap_left(end, period, offset + size))
        return self._lifetime(snap_left("vs", progress, offset), ve)

    def set_duration(self, duration):
        """Duration as a number or an expression over `vs`, `ve`, keys and payload."""
        if isinstance(duration, int):
            if duration >= INF:
                return self._lifetime(ve=F.lit(INF), props=self.props.but(open_ended=True, duration=None))
            props = self.props.but(duration=duration, open_ended=False)
            return self._lifetime(ve=F.col("vs") + F.lit(duration), props=props)
        d = col(duration)
        return self._lifetime(ve=F.when(d >= INF, F.lit(INF)).otherwise(F.col("vs") + d))

    def shift(self, ticks):
        """Move lifetimes, keeping their duration."""
        by = number(ticks)
        out = self._lifetime(F.col("vs") + by, plus("ve", by), self.props.but(hop=None))
        out._cuts = self.cuts.shifted(ticks) if isinstance(ticks, int) else None
        return out

    def set_lifetime(self, start, duration):
        """New start and duration, as expressions over `vs`, `ve`, keys and payload."""
        start, d = number(start), number(duration)
        out = self._lifetime(start, F.when(d >= INF, F.lit(INF)).otherwise(start + d))
        if isinstance(duration, int) and duration < INF:
            out.props = out.props.but(duration=duration)
        out._cuts = None
        return out

    def extend(self, ticks: int):
        """Lengthen (or shorten) finite lifetimes; rows left without a lifetime are dropped."""
        out = self._lifetime(ve=plus("ve", F.lit(ticks)))
        return out if ticks >= 0 else out.where(F.col("ve") > F.col("vs"))

    def clip(self, limit: int):
        """Cut lifetimes longer than `limit`."""
        return self._lifetime(ve=F.least(F.col("ve"), F.col("vs") + F.lit(limit)))

    def chop(self, offset: int, period: int, horizon: int | None = None):
        """Split each lifetime at every grid point. Open lifetimes need a `horizon` to stop at."""
        df = self.df
        if horizon is not None:
            df = df.withColumn("ve", F.least("ve", F.lit(horizon))).where("vs < ve")
        else:
            open_end = F.raise_error(F.lit("chop: an open lifetime needs a horizon"))
            df = df.withColumn("ve", F.when(F.col("ve") >= INF, open_end).otherwise(F.col("ve")))
        df = df.withColumn(
            "_g", F.explode(F.sequence(snap_left("vs", period, offset), F.col("ve") - 1, F.lit(period)))
        )
        df = df.withColumns(
            {"vs": F.greatest("vs", "_g"), "ve": F.least(F.col("ve"), F.col("_g") + F.lit(period))}
        )
        return self._with(df.drop("_g"))

    def point_at_end(self):
        """A point event where each finite lifetime ends."""
        return self.where(F.col("ve") < INF)._lifetime(
            F.col("ve"), F.col("ve") + 1, self.props.but(duration=1, hop=None, open_ended=False)
        )

    def stitch(self):
        """Merge lifetimes of equal rows that touch (inverse of chop).

        Copies of a row that never overlap are merged by islands. Only connected stretches in which copies
        overlap need one-to-one linking of ends with starts, done per stretch.
        """
        self = self._ready()
        group = [*self.keys, *self.payload]
        one = F.lit(1).cast("long")
        rows = self.df.groupBy(*group, "vs", "ve").agg(F.count(one).alias("_copies"))
        edge = rows.select(
            *group,
            F.explode(
                F.array(
                    F.struct(F.col("vs").alias("t"), F.col("_copies").alias("up"), F.lit(0).alias("down")),
                    F.struct(F.col("ve").alias("t"), F.lit(0).alias("up"), F.col("_copies").alias("down")),
                )
            ).alias("_e"),
        ).select(*group, F.col("_e.t").alias("_t"), F.col("_e.up").alias("up"), F.col("_e.down").alias("down"))
        tl = instants(edge, group, "_t", self.cuts, up=F.sum("up"), down=F.sum("down"))
        tl = tl.withColumn("_net", F.col("up") - F.col("down"))
        tl = with_running(tl, group, "_t", {"_net": "_open"})
        # a stretch begins where rows start and none was open before
        fresh = (F.col("up") > 0) & (F.col("_open") - F.col("_net") == 0)
        tl = with_latest(tl, group, "_t", F.when(fresh, F.col("_t")), "_from")
        crowded = F.greatest(F.col("_open"), F.col("_open") - F.col("_net") + 0)
        parts = tl.groupBy(*group, "_from").agg(F.max("_t").alias("_to"), F.max(crowded).alias("_depth"))
        simple = parts.where("_depth <= 1").select(
            *group, F.col("_from").alias("vs"), F.col("_to").alias("ve")
        )
        marks = tl.select(*group, "_t", "_from")
        cond = match("l", "r", group) & (F.col("l.vs") == F.col("r._t"))
        placed = rows.alias("l").join(marks.alias("r"), cond).select("l.*", "r._from")
        deep = parts.where("_depth > 1").select(*group, "_from")
        tangled = (
            placed.alias("l").join(deep.alias("r"), match("l", "r", [*group, "_from"]), "leftsemi").select("l.*")
        )
        types = {f.name: f.dataType for f in self.df.schema.fields}
        schema = StructType([StructField(c, types[c], True) for c in (*group, "vs", "ve")])
        tangled = tangled.select(*group, "_from", "vs", "ve", "_copies")
        linked = scan_ordered(tangled, [*group, "_from"], ["vs", "ve"], _Links, schema)
        cols = schema.names
        return self._with(simple.select(*cols).unionByName(linked.select(*cols)), wide=True)

    def session(self, timeout: int, max_duration: int | None = None):
        """Lifetimes [vs, session end). A session ends `timeout` after its last event; a gap of exactly
        `timeout` separates sessions. With `max_duration`, sessions also end on a grid of that size: the first
        at the second grid point after a start off the grid, later ones at every grid point."""
        self = self._ready()
        keys, t = self.keys, F.col("vs")
        tl = instants(self.df, keys, "vs", self.cuts)
        tl = with_neighbours(tl, keys, "vs")
        gap_before = F.col("_prev").isNull() | (t - F.col("_prev") >= timeout)
        gap_after = F.col("_next").isNull() | (F.col("_next") - t >= timeout)
        if max_duration is None:
            tl = with_following(tl, keys, "vs", F.when(gap_after, t), "_last")
            tl = tl.withColumn("_end", F.col("_last") + timeout)
        else:
            d = max_duration
            tl = with_latest(tl, keys, "vs", F.when(gap_before, t), "_first")
            off_grid = F.pmod(F.col("_first"), F.lit(d))
            limit = F.col("_first") - off_grid + F.when(off_grid == 0, d).otherwise(2 * d)
            tl = tl.withColumn("_limit", limit)

            def cell(x):
                return F.when(x < F.col("_limit"), F.col("_limit")).otherwise(snap_left(x, d) + d)

            cut_after = gap_after | (cell(F.col("_next")) != cell(t))
            tl = with_following(tl, keys, "vs", F.when(cut_after, t), "_last")
            tl = tl.withColumn("_end", F.least(F.col("_last") + timeout, cell(t)))
        ends = tl.select(*keys, "vs", "_end")
        cond = match("l", "r", [*keys, "vs"])
        df = self.df.alias("l").join(ends.alias("r"), cond).select("l.*", "r._end")
        cols = self.df.columns
        return self._with(df.withColumn("ve", F.col("_end")).select(*cols), wide=True)


class _Links:
    """Links each end to one start at the same instant, first come first served.

    Holds the chains open at the current instant; those that ended before it are emitted.
    """

    def __init__(self, key):
        self.payload = key[:-1]
        self.waiting: dict[int, deque] = {}
        self.ends: list[int] = []

    def row(self, values):
        vs, ve, copies = values[-3:]
        out = self._emit(vs)
        for _ in range(copies):
            queue = self.waiting.get(vs)
            start = queue.popleft() if queue else vs
            if ve not in self.waiting:
                self.waiting[ve] = deque()
                heappush(self.ends, ve)
            self.waiting[ve].append(start)
        return out

    def _emit(self, before):
        out = []
        while self.ends and (before is None or self.ends[0] < before):
            end = heappop(self.ends)
            out.extend((*self.payload, start, end) for start in self.waiting.pop(end))
        return out

    def end(self):
        return self._emit(None)
