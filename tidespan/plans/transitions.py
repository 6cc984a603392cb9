"""Where an unbounded pattern can be cut: time slices as maps between sets of automaton states.

Without a bound on its duration, an instance may reach from any slice of a key's history into any later one. As long as
only the events decide which arcs are taken (not the registers), what a slice does to the instances that enter it is a
map from states to states: where an instance in each state ends up, or at which instant it dies. Maps of consecutive
slices compose, so all slices are summarised at the same time, one small row for each key and slice, and only these
rows meet per key. Their composition says how far the instances of each slice reach (if instances overlap), or at which
instant of a slice nothing is under way (if they do not). The history is then cut there, and the pieces are scanned
independently.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..functions.time import INF
from .ordered import scan_ordered
from .slices import SLICE, Cuts, match


def events_decide(tables) -> bool:
    """Whether every arc takes a lone event by a native condition, so that registers steer nothing."""
    return all(single and isinstance(cond, int) for arcs in tables["arcs"].values() for single, cond, *_ in arcs)


class StateSets:
    """The automaton on sets of states, as bits of a number; only states with arcs can be under way."""

    def __init__(self, tables, deterministic: bool):
        self.deterministic = deterministic
        arcs = tables["arcs"]
        place = {s: i for i, s in enumerate(arcs)}
        self.moves = [
            [(cond, sum(1 << place[s] for s in set(reach) if s in place)) for _, cond, _, reach in out] for out in arcs.values()
        ]
        self.starts = [place[s] for s in tables["starts"] if s in place]
        self.seen: dict[tuple, tuple[list[int], int]] = {}
        self.still = ([0] * len(self.moves), 0)

    def after(self, count: int, flags) -> tuple[list[int], int]:
        """What an instant makes of each state, and the states of instances that it starts."""
        if count != 1:
            return self.still
        key = tuple(flags)
        if key not in self.seen:
            image = [self._image(out, key) for out in self.moves]
            self.seen[key] = image, _union(image[s] for s in self.starts)
        return self.seen[key]

    def _image(self, out, flags) -> int:
        found = 0
        for cond, target in out:
            if flags[cond]:
                found |= target
                if self.deterministic:
                    break
        return found


def _union(masks) -> int:
    out = 0
    for m in masks:
        out |= m
    return out


def _apply(image: list[int], states: int) -> int:
    out, i = 0, 0
    while states:
        if states & 1:
            out |= image[i]
        states >>= 1
        i += 1
    return out


class _Slice:
    """The map of one key and slice.

    `dies` and `stays` are, for each state an instance may enter in, the instant at which nothing is left of it, or the
    states it leaves in. `own` are the states in which instances of the slice leave it if they overlap; `leaves` are
    those if one is under way at a time, by the instant from which on nothing was under way.
    """

    def __init__(self, sets: StateSets, key):
        self.sets, self.key = sets, key
        self.images = {i: 1 << i for i in range(len(sets.moves))}
        self.dies: dict[int, int] = {}
        self.own, self.first = 0, None
        self.runs: dict[int, list[int]] = {}  # states under way: the instants of the runs that have come to them
        self.time, self.count, self.flags = None, 0, None

    def row(self, values):
        t, flags = values[len(self.key) :]
        if t != self.time:
            self._instant()
            self.time, self.count, self.flags = t, 0, flags
        self.count += 1
        return []

    def _instant(self):
        if self.time is None:
            return
        image, start = self.sets.after(self.count, self.flags)
        runs: dict[int, list[int]] = {}
        for states, begun in self.runs.items():
            runs.setdefault(_apply(image, states) or start, []).extend(begun)
        if self.first is None:
            self.first = self.time
            runs[start] = [self.time]
        for i, states in list(self.images.items()):
            states = _apply(image, states)
            if states:
                self.images[i] = states
            else:
                del self.images[i]
                self.dies[i] = self.time
                if self.time not in runs.get(start, ()):
                    runs.setdefault(start, []).append(self.time)
        self.runs = runs
        self.own = _apply(image, self.own) | start

    def end(self):
        self._instant()
        leaves = {t: states for states, begun in self.runs.items() for t in begun}
        found = {"first": self.first, "own": self.own, "dies": self.dies, "stays": self.images, "leaves": leaves}
        return [(*self.key, json.dumps(found))]


class _Composed:
    """Composes a key's maps in the order of its slices; at most one row for each slice comes in."""

    def __init__(self, key, overlapping: bool):
        self.key, self.overlapping, self.maps = key, overlapping, []

    def row(self, values):
        number, found = values[len(self.key) :]
        self.maps.append((number, json.loads(found)))
        return []

    def end(self):
        found = self._reaches() if self.overlapping else self._cuts()
        return [(*self.key, *f) for f in found]

    def _passed(self, slice_, states):
        """The last instant of the slice that the states need (none: all of it), and the states that leave it."""
        inside = [i for i in range(states.bit_length()) if states >> i & 1]
        left = _union(slice_["stays"].get(str(i), 0) for i in inside)
        return (None if left else max(slice_["dies"][str(i)] for i in inside)), left

    def _reaches(self):
        """(slice, piece, upto): which rows of a slice the instances begun in an earlier one read."""
        for k, (piece, first) in enumerate(self.maps):
            states = first["own"]
            for number, later in self.maps[k + 1 :]:
                if not states:
                    break
                upto, states = self._passed(later, states)
                yield number, piece, INF if upto is None else upto

    def _cuts(self):
        """(slice, piece, upto): the instant of a slice at which nothing is under way, and the last one before it."""
        states, before = 0, None
        for number, here in self.maps:
            cut = here["first"]
            if states:
                cut, left = self._passed(here, states)
                states = left if cut is None else states
            if cut is not None:
                states = here["leaves"][str(cut)]
            yield number, before, cut
            before = before if cut is None else cut


def pieces(rows: DataFrame, keys, cuts: Cuts, tables, overlapping: bool, deterministic: bool) -> DataFrame:
    """Rows (with `vs` and `_flags`) by independent piece: `_chunk`, and `_own` for rows that may start a match."""
    rows = cuts.attach(rows, "vs")
    sets, group = StateSets(tables, deterministic), [*keys, SLICE]
    fields = [rows.schema[c] for c in group]
    maps = scan_ordered(
        rows.select(*group, "vs", "_flags"), group, ["vs"], lambda key: _Slice(sets, key), StructType([*fields]).add("_map", "string")
    )
    maps = maps.select(F.lit(0).alias("_all"), *maps.columns)  # there may be no key
    plan = StructType([maps.schema["_all"], *fields]).add("_piece", "long").add("_upto", "long")
    plan = scan_ordered(maps, ["_all", *keys], [SLICE], lambda key: _Composed(key, overlapping), plan)
    joined = rows.alias("l").join(plan.alias("r"), match("l", "r", group))
    if overlapping:
        later = joined.where(F.col("vs") <= F.col("_upto")).select("l.*", F.col("_piece").alias("_chunk"), F.lit(False).alias("_own"))
        return rows.withColumn("_chunk", F.col(SLICE).cast("long")).withColumn("_own", F.lit(True)).unionByName(later).drop(SLICE)
    mine = F.when(F.col("vs") >= F.col("_upto"), F.struct(F.col("_upto").alias("c"), F.lit(True).alias("own")))
    # the event at a cut may end what went before
    ends = F.col("_upto").isNull() | (F.col("vs") <= F.col("_upto"))
    fresh = F.col("_upto").isNull() | (F.col("vs") < F.col("_upto"))
    earlier = F.when(F.col("_piece").isNotNull() & ends, F.struct(F.col("_piece").alias("c"), fresh.alias("own")))
    joined = joined.withColumn("_p", F.explode(F.array_compact(F.array(mine, earlier))))
    return joined.select("l.*", F.col("_p.c").alias("_chunk"), F.col("_p.own").alias("_own")).drop(SLICE)
