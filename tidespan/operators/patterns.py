"""Sequence patterns within the events of a key."""

from __future__ import annotations

from collections import namedtuple
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..functions.automaton import Matcher
from ..functions.time import INF, col
from ..plans.ordered import scan_ordered
from ..plans.runs import alternatives, matched_runs, numbered_runs
from ..plans.slices import BEFORE, SLICE, carry, local, match
from ..plans.timeline import instants, with_following, with_neighbours
from ..plans.transitions import events_decide, pieces

#: Instants of a key in a block of an unbounded sequence.
BLOCK = 4096


def _pair(left: DataFrame, right: DataFrame, keys, at: str) -> DataFrame:
    """Rows of the left whose `at` is the start of a row of the right, same key. Columns `l.*` and `r.*`."""
    cond = match("l", "r", keys) & (F.col(f"l.{at}") == F.col("r.vs"))
    return left.alias("l").join(right.alias("r"), cond)


def _chosen(joined, keys, second, select) -> DataFrame:
    exprs = select(lambda c: F.col(f"l.`{c}`"), lambda c: F.col(f"r.`{c}`"))
    return joined.select(
        F.col(f"r.{second}").alias("vs"),
        (F.col(f"r.{second}") + 1).alias("ve"),
        *[F.col(f"l.`{k}`") for k in keys],
        *[e.alias(n) for n, e in exprs.items()],
    )


class PatternOps:
    def _with_next_start(self, other=None) -> DataFrame:
        """Rows with `_next`: the next distinct start of the key, here or in `other`, strictly after."""
        keys = self.keys
        if other is None:
            tl = with_neighbours(instants(self.df, keys, "vs", self.cuts), keys, "vs")
        else:
            mine = self.df.select(*keys, "vs", F.lit(False).alias("_hit"))
            both = mine.unionByName(other.df.select(*keys, "vs", F.lit(True).alias("_hit")))
            tl = instants(both, keys, "vs", self.cuts, _hit=F.max("_hit"))
            tl = with_following(tl, keys, "vs", F.when(F.col("_hit"), F.col("vs")), "_next", inclusive=False)
        tl = tl.where(F.col("_next").isNotNull()).select(*keys, "vs", "_next")
        cond = match("l", "r", [*keys, "vs"])
        return self.df.alias("l").join(tl.alias("r"), cond).select("l.*", "r._next")

    def followed_by_immediate(self, first, second, within: int, select, other=None):
        """`first` then `second` with nothing in between, less than `within` apart.

        Intermediate events are those of this frame, or of `other` when the second event comes from there.
        A negative `within` keeps the rows' own lifetimes as the limit. `select(l, r)` maps names to results.
        """
        if 0 <= within < 2:
            raise ValueError("within must be at least 2")
        self = self._ready()
        limit = F.col("ve") if within < 0 else F.col("vs") + F.lit(within - 1)
        rows = self._with_next_start(other).where(col(first)).where(F.col("_next") <= limit)
        target = (other or self).df.where(col(second))
        out = _chosen(_pair(rows, target, self.keys, "_next"), self.keys, "vs", select)
        return self._with(out, wide=True)

    def consecutive_pairs(self, select):
        """Every event with the event(s) at the next instant of its key."""
        self = self._ready()
        rows = self._with_next_start()
        out = _chosen(_pair(rows, self.df, self.keys, "_next"), self.keys, "vs", select)
        return self._with(out, wide=True)

    def sessionize(self, is_start, is_end, session_key, select):
        """Each start event with the first later end event of its session key; several open starts all match."""
        names = [session_key] if isinstance(session_key, str) else list(session_key)
        inner = self._ready().group_by(*names)
        starts = inner.where(col(is_start))
        ends = inner.where(col(is_end))
        rows = starts._with_next_start(ends)
        out = _chosen(_pair(rows, ends.df, inner.keys, "_next"), inner.keys, "vs", select)
        return inner._with(out, wide=True).ungroup(*names)

    def _slices_ahead(self, df: DataFrame, max_duration: int) -> DataFrame:
        """Time slices with as much of the future as overlapping instances may last: `_chunk`, and `_own` for rows that
        may start a match in it.

        Slices are no shorter than that, so a row is read in its own slice and at most in the one before; shorter ones
        would read as much of the future each.
        """
        cuts = self.cuts.apart(max_duration)
        df = df.withColumn("_reach", F.col("vs") - F.lit(max_duration - 1))
        df = cuts.attach(cuts.attach(df, "_reach", "_lo"), "vs", "_hi")
        df = df.withColumn("_chunk", F.explode(F.sequence(F.col("_lo").cast("long"), F.col("_hi").cast("long"))))
        return df.withColumn("_own", F.col("_chunk") == F.col("_hi")).drop("_reach", "_lo", "_hi")

    def _between_pauses(self, df: DataFrame, max_duration: int, going) -> DataFrame:
        """Pieces of each key's history at whose beginning nothing can be under way: after a pause of `max_duration`,
        or at an instant that no instance survives. Each slice is cut at the first such place.

        `going` are the conditions of arcs out of states between instants; None if they are not known.
        """
        keys = self.keys
        survived = F.lit(True) if going is None else reduce(lambda a, b: a | b, going, F.lit(False))
        lone = F.lit(True) if going is None else F.count(F.lit(1)) == 1
        rows = self.df.select(*keys, "vs", F.coalesce(survived, F.lit(False)).alias("_on"))
        tl = instants(rows, keys, "vs", self.cuts, _on=lone & F.bool_or("_on"))
        tl = with_neighbours(tl, keys, "vs")
        pause = F.col("_prev").isNull() | (F.col("vs") - F.col("_prev") >= max_duration)
        tl = tl.withColumn("_cut", F.when(pause | ~F.col("_on"), F.col("vs")))
        tl = carry(
            tl, keys, {"_first": F.min("_cut")},
            lambda w: {"_here": F.col("_first"), "_before": F.max("_first").over(w.rowsBetween(*BEFORE))},
        )
        chunk = F.when(F.col("vs") >= F.col("_here"), F.col("_here")).otherwise(F.col("_before"))
        tl = tl.select(*keys, "vs", chunk.alias("_chunk"))
        cond = match("l", "r", [*keys, "vs"])
        df = df.alias("l").join(tl.alias("r"), cond).select("l.*", "r._chunk")
        return df.withColumn("_own", F.lit(True))

    def _rank_blocks(self, df: DataFrame, steps: int) -> DataFrame:
        """Blocks of consecutive instants of a key, each with the `steps - 1` instants that follow it."""
        keys = self.keys
        tl = carry(
            self.cuts.attach(df, "vs").repartition(*keys, SLICE), keys, {"_n": F.count(F.lit(1))},
            lambda w: {"_base": F.sum("_n").over(w.rowsBetween(*BEFORE))},
        )
        rank = F.row_number().over(local(keys).orderBy("vs")) - 1 + F.coalesce(F.col("_base"), F.lit(0))
        tl = tl.withColumn("_rank", rank).drop(SLICE, "_base")
        first = F.floor(F.greatest(F.col("_rank") - (steps - 1), F.lit(0)) / BLOCK)
        own = F.floor(F.col("_rank") / BLOCK)
        tl = tl.withColumn("_chunk", F.explode(F.sequence(first, own)))
        return tl.withColumn("_own", F.col("_chunk") == own).drop("_rank")

    def detect(
        self, pattern, max_duration: int, schema: str, register=None, overlapping=True, deterministic=False,
        result=None,
    ):
        """Run an automaton per key; each entry into a final state gives one row.

        The row lives in [match time, match start + max_duration). There is no skipping: an instance without
        an arc for the next event of its key ends. Registers are tuples laid out as `schema` (or mapped to
        such tuples by `result`).
        """
        self = self._ready()
        automaton = pattern.compile()
        tables, conds = automaton.tables(register), automaton.conditions()
        payload = self.payload
        tests = [f"_c{i}" for i in range(len(conds))]
        rows = self.df.select(
            *self.keys, "vs", *payload, *[F.coalesce(c, F.lit(False)).alias(n) for c, n in zip(conds, tests, strict=True)]
        )
        rows = rows.withColumn("_flags", F.array(*tests).cast("array<boolean>")).drop(*tests)
        decided = events_decide(tables)
        if max_duration < INF and overlapping:
            rows = self._slices_ahead(rows, max_duration)
        elif max_duration < INF:
            under_way = {s for out in tables["arcs"].values() for *_, reach in out for s in reach}
            going = {cond for s in under_way for _, cond, *_ in tables["arcs"].get(s, ())} if decided else None
            rows = self._between_pauses(rows, max_duration, going and [conds[i] for i in sorted(going)])
        elif decided:
            rows = pieces(rows, self.keys, self.cuts, tables, overlapping, deterministic)
        else:
            rows = rows.withColumn("_chunk", F.lit(0).cast("long")).withColumn("_own", F.lit(True))
        reg_type = _parse_datatype_string(schema)
        key_fields = [f for f in self.df.schema.fields if f.name in self.keys]
        times = _parse_datatype_string("vs bigint, ve bigint")
        out = StructType([*times.fields, *key_fields, *reg_type.fields])
        rows = rows.select(*self.keys, "_chunk", "vs", "_own", "_flags", *payload)
        machine = _runner(tables, max_duration, overlapping, deterministic, len(self.keys), payload, result)
        found = scan_ordered(rows, [*self.keys, "_chunk"], ["vs"], machine, out)
        return self._with(found, wide=True)

    def detect_sequence(self, conds, max_duration: int, select):
        """A fixed sequence of single events, wholly native: conditions over the next rows of the key.

        `select(e)` maps names to results, where `e[i]` accesses the columns of the i-th event. Simultaneous
        events of a key break a match, as in `detect`.
        """
        self = self._ready()
        keys, n = self.keys, len(conds)
        marks = [F.coalesce(c, F.lit(False)).alias(f"_m{i}") for i, c in enumerate(conds)]
        # one row per instant: a crowded instant can only break a match, so its rows need not be kept
        event = F.struct(*self.df.columns, *marks)
        df = self.df.groupBy(*keys, "vs").agg((F.count(F.lit(1)) == 1).alias("_lone"), F.any_value(event).alias("_e0"))
        df = self._slices_ahead(df, max_duration) if max_duration < INF else self._rank_blocks(df, n)
        w = Window.partitionBy(*keys, "_chunk").orderBy("vs")
        step = F.struct("_lone", "_e0")
        df = df.select("*", *[F.lead(step, i).over(w).alias(f"_s{i}") for i in range(1, n)])
        df = df.withColumns({f"_e{i}": F.col(f"_s{i}._e0") for i in range(1, n)})
        lone = [F.col("_lone"), *[F.col(f"_s{i}._lone") for i in range(1, n)]]
        ok = [F.col(f"_e{i}._m{i}") & lone[i] for i in range(n)]
        last = F.col(f"_e{n - 1}.vs")
        hit = reduce(lambda a, b: a & b, ok) & F.col("_own") & (last < F.col("vs") + F.lit(max_duration))
        exprs = select([lambda c, i=i: F.col(f"_e{i}.`{c}`") for i in range(n)])
        out = df.where(hit).select(
            last.alias("vs"),
            F.least(F.col("vs") + F.lit(max_duration), F.lit(INF)).alias("ve"),
            *keys,
            *[e.alias(n) for n, e in exprs.items()],
        )
        return self._with(out, wide=True)

    def detect_runs(self, kind, steps, max_duration: int, select):
        """A sequence of runs of events, wholly native: as `detect` finds it, one row for each start and accepted end.

        `steps` are pairs of a value of `kind` and how often it comes: "1", "+" (once or more), "?" (at most once) or "*".
        Steps that can follow each other are of different kinds. `select(first, last, n)` maps names to results, where
        `first` and `last` access the columns of the outer events and `n` is the number of events. Simultaneous events
        of a key break a match.
        """
        self = self._ready()
        keys = self.keys
        event = F.struct(*self.df.columns, col(kind).alias("_kind"))
        df = self.df.groupBy(*keys, "vs").agg((F.count(F.lit(1)) == 1).alias("_lone"), F.any_value(event).alias("_e"))
        df = df.select(*keys, "vs", "_e", F.when(F.col("_lone"), F.col("_e._kind")).alias("_kind"))
        rows = numbered_runs(df, keys, self.cuts, "_kind")
        found = [matched_runs(rows, keys, one, max_duration) for one in alternatives(steps)]
        pairs = reduce(DataFrame.unionByName, found)
        names = select(lambda c: F.col(f"s._e.`{c}`"), lambda c: F.col(f"e._e.`{c}`"), F.col("e._rank") - F.col("s._rank") + 1)
        out = pairs.select(
            F.col("e.vs").alias("vs"),
            F.least(F.col("s.vs") + F.lit(max_duration), F.lit(INF)).alias("ve"),
            *[F.col(f"s.`{k}`").alias(k) for k in keys],
            *[e.alias(n) for n, e in names.items()],
        )
        return self._with(out, wide=True)


def _runner(tables, max_duration, overlapping, deterministic, n_keys, payload, result):
    """Groups the rows of an instant and feeds them to the automaton."""

    event_types = []

    def start(key):
        if not event_types:  # made once per task
            event_types.append(namedtuple("Event", payload, rename=True))
        matcher = Matcher(tables, max_duration, overlapping, deterministic)
        return _Run(matcher, key[:n_keys], event_types[0], result)

    return start


class _Run:
    def __init__(self, matcher, key, event_type, result):
        self.matcher, self.key, self.event_type, self.result = matcher, key, event_type, result
        self.time, self.own, self.events = None, True, []

    def row(self, values):
        t, own, flags = values[len(self.key) + 1 : len(self.key) + 4]
        out = []
        if t != self.time:
            out = self.end()
            self.time, self.own, self.events = t, own, []
        # without arcs over whole instants, two events already say that the instant is crowded
        if self.matcher.lists or len(self.events) < 2:
            self.events.append((self.event_type._make(values[len(self.key) + 4 :]), flags))
        return out

    def end(self):
        if not self.events:
            return []
        found = self.matcher.at(self.time, self.events, self.own)
        return [(vs, ve, *self.key, *(self.result(r) if self.result else r)) for vs, ve, r in found]
