"""Operators that need their events in order, on unbounded input.

Events are buffered until the watermark passes them and then run through a small state machine of their key in time
order; the machines' state is kept between triggers, by shards of many keys. The machines for patterns are those of the
batch operators.

State carries the version of what wrote it: the operator, its parameters and its columns. A query that is restarted with
another version fails instead of reading state that it would misunderstand.
"""

from __future__ import annotations

import pickle
from collections import deque, namedtuple
from heapq import heappop, heappush
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType, StringType, StructType, _parse_datatype_string

from ..functions.automaton import Matcher
from ..functions.time import INF, MIN_T


#: Groups that the keys of a stream are dealt into. State is kept by group, so the number cannot change between runs.
SHARDS = 2048


def release_in_order(df: DataFrame, keys, columns, delay: str, machine, schema: StructType, version: str) -> DataFrame:
    """Feed each key's rows (`vs` and `columns`) to `machine(key, saved)` in time order.

    The machine has `row(t, values)` and `advance(t)`, both returning output tuples (without the key), and
    `save()`, whose result is passed back as `saved` later. `version` names the machine and all that its state depends on.
    """
    if not keys:
        raise ValueError("a stateful stream needs at least one key")
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in (*keys, "vs", *columns))
    version = f"{version} of ({kinds})"
    # among nulls, pandas would make whole numbers doubles: they travel with a mark instead
    whole = [isinstance(df.schema[c].dataType, IntegralType) for c in columns]
    parts, names_in = [], [f"_{i}" for i in range(len(columns))]
    for c, n, w in zip(columns, names_in, whole, strict=True):
        value = F.col(f"`{c}`")
        parts += [F.coalesce(value.cast("long"), F.lit(0)).alias(n), value.isNull().alias(n + "_null")] if w else [value.alias(n)]
    rows = df.select(*keys, "vs", *parts)
    rows = rows.withColumn("_at", F.timestamp_micros("vs")).withWatermark("_at", delay)
    names, at = schema.names, itemgetter(0)

    def update(key, batches, state):
        written, buffered, saved = pickle.loads(state.get[0]) if state.exists else (version, [], None)
        if written != version:
            raise ValueError(f"the state was written by {written}, and cannot be read by {version}")
        run = machine(key, saved)
        for pdf in batches:
            values = [pdf["vs"].tolist()]
            for n, w in zip(names_in, whole, strict=True):
                if w:
                    given, null = pdf[n].tolist(), pdf[n + "_null"]
                    values.append([None if z else x for x, z in zip(given, null, strict=True)] if null.any() else given)
                else:
                    values.append(pdf[n].astype(object).where(pdf[n].notna(), None).tolist())
            buffered.extend(zip(*values, strict=True))
        limit = state.getCurrentWatermarkMs() * 1000
        buffered.sort(key=at)
        out, done = [], 0
        for v in buffered:
            if v[0] > limit:
                break
            out.extend(run.row(int(v[0]), v[1:]))
            done += 1
        if limit > 0:
            out.extend(run.advance(limit))
        rest = buffered[done:]
        wake = run.wake()
        times = [int(v[0]) for v in rest[:1]] + ([wake] if wake is not None else [])
        saved = run.save()
        if rest or saved is not None:
            state.update((pickle.dumps((version, rest, saved)),))
            if times:
                state.setTimeoutTimestamp(max(min(times) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame([(*key, *o) for o in out], columns=names, dtype=object)

    return rows.groupBy(*keys).applyInPandasWithState(
        update, schema, _parse_datatype_string("state binary"), "append", "EventTimeTimeout"
    )


class _Shard:
    """The machines of many keys; the values of a row begin with its key."""

    def __init__(self, machine, n, saved):
        self.machine, self.n = machine, n
        self.runs = {key: machine(key, state) for key, state in saved or ()}

    def row(self, t, values):
        key = values[: self.n]
        run = self.runs.get(key)
        if run is None:
            run = self.runs[key] = self.machine(key, None)
        return [(*key, *o) for o in run.row(t, values[self.n :])]

    def advance(self, t):
        return [(*key, *o) for key, run in self.runs.items() for o in run.advance(t)]

    def wake(self):
        return min((w for w in (run.wake() for run in self.runs.values()) if w is not None), default=None)

    def save(self):
        states = ((key, run.save()) for key, run in self.runs.items())
        return [(key, state) for key, state in states if state is not None] or None


def release_by_key(df: DataFrame, keys, columns, delay: str, machine, schema: StructType, version: str) -> DataFrame:
    """`release_in_order` for any number of keys: a group of the stream is not a key but a shard of many.

    A call for every key and trigger costs far more than the few rows of a key. Keys are dealt by hash if they are whole
    numbers or strings, whose values mean the same as parts of a row; others are groups of their own.
    """
    plain = all(isinstance(df.schema[k].dataType, IntegralType) or df.schema[k].dataType == StringType() for k in keys)
    if not keys or not plain:
        return release_in_order(df, keys, columns, delay, machine, schema, version)
    n, dealt = len(keys), df.withColumn("_shard", F.pmod(F.xxhash64(*keys), F.lit(SHARDS)).cast("int"))
    fields = [dealt.schema["_shard"], *schema.fields]
    shard = lambda key, saved: _Shard(machine, n, saved)
    found = release_in_order(dealt, ["_shard"], [*keys, *columns], delay, shard, StructType(fields), f"{version} in {SHARDS}")
    return found.drop("_shard")


def _out(df: DataFrame, keys, more: str) -> StructType:
    fields = [f for f in df.schema.fields if f.name in keys]
    return StructType([*fields, *_parse_datatype_string(more).fields])


class _Detect:
    def __init__(self, matcher, event_names, saved):
        self.matcher = matcher
        self.event = namedtuple("Event", event_names, rename=True)
        self.time, self.events = None, []
        if saved is not None:
            self.matcher.instances, self.time, self.events = saved
            self.events = [(self.event._make(e), f) for e, f in self.events]

    def row(self, t, values):
        out = self._flush() if self.time is not None and t != self.time else []
        self.time = t
        self.events.append((self.event._make(values[:-1]), values[-1]))
        return out

    def _flush(self):
        found = self.matcher.at(self.time, self.events) if self.events else []
        self.events = []
        return [(vs, ve, *reg) for vs, ve, reg in found]

    def advance(self, t):
        # events up to the watermark are complete, and instances that it leaves behind are over
        out = self._flush() if self.events and self.time <= t else []
        limit = self.matcher.max_duration
        self.matcher.instances = [i for i in self.matcher.instances if i[2] + limit > t]
        return out

    def wake(self):
        ends = [began + self.matcher.max_duration for _, _, began in self.matcher.instances]
        return min(ends) if ends and min(ends) < INF else None

    def save(self):
        if not self.matcher.instances and not self.events:
            return None
        return (self.matcher.instances, self.time, [(tuple(e), f) for e, f in self.events])


def stream_detect(df, keys, pattern, max_duration, schema, delay, register=None, overlapping=True):
    """`TemporalFrame.detect` on a stream."""
    automaton = pattern.compile()
    tables, conds = automaton.tables(register), automaton.conditions()
    payload = [c for c in df.columns if c not in ("vs", "ve", *keys)]
    flags = F.array(*[F.coalesce(c, F.lit(False)) for c in conds])
    rows = df.withColumn("_flags", flags)

    def machine(key, saved):
        return _Detect(Matcher(tables, max_duration, overlapping), payload, saved)

    out = _out(df, keys, "vs bigint, ve bigint, " + schema)
    shape = {s: [(single, cond if isinstance(cond, int) else "call", reach) for single, cond, _, reach in arcs] for s, arcs in tables["arcs"].items()}
    tests = [c._jc.toString() if hasattr(c, "_jc") else str(c) for c in conds]
    version = f"detect 1 {shape} {tests} {sorted(tables['finals'])} {max_duration} {overlapping} {schema}"
    return release_by_key(rows, keys, [*payload, "_flags"], delay, machine, out, version)


class _Signal:
    def __init__(self, saved):
        self.open = saved or []

    def row(self, t, values):
        out = []
        if self.open and self.open[0][0] < t:
            out = [(vs, t, *v) for vs, v in self.open]
            self.open = []
        self.open.append((t, tuple(values)))
        return out

    def advance(self, t):
        return []

    def wake(self):
        return None

    def save(self):
        return self.open or None


def stream_signal(df, keys, delay):
    """`TemporalFrame.as_signal` on a stream: a row is emitted when the next one of its key arrives."""
    payload = [c for c in df.columns if c not in ("vs", "ve", *keys)]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in payload)
    out = _out(df, keys, "vs bigint, ve bigint, " + types)
    return release_by_key(df, keys, payload, delay, lambda key, saved: _Signal(saved), out, "signal 1")


class _Session:
    """Sessions with an optional grid limit: rows wait until their session's end is known."""

    def __init__(self, timeout, cap, saved):
        self.timeout, self.cap = timeout, cap
        self.last, self.limit, self.open = saved or (None, INF, [])

    def _end(self):
        return min(self.last + self.timeout, self.limit)

    def _close(self):
        end = self._end()
        out = [(vs, end, *v) for vs, v in self.open]
        self.open = []
        return out

    def row(self, t, values):
        out = []
        if self.last is None or t - self.last >= self.timeout:
            out = self._close() if self.open else []
            phase = t % self.cap if self.cap else 0
            self.limit = t - phase + (1 if phase == 0 else 2) * self.cap if self.cap else INF
        elif t >= self.limit:
            out = self._close()
            self.limit = t - t % self.cap + self.cap
        self.last = t
        self.open.append((t, tuple(values)))
        return out

    def advance(self, t):
        if self.open and t >= self._end():
            out = self._close()
            if t >= self.last + self.timeout:
                self.last, self.limit = None, INF
            return out
        return []

    def wake(self):
        return self._end() if self.open else None

    def save(self):
        return (self.last, self.limit, self.open) if self.last is not None else None


def stream_session(df, keys, timeout, delay, max_duration=None):
    """`TemporalFrame.session` on a stream: one output row per event."""
    payload = [c for c in df.columns if c not in ("vs", "ve", *keys)]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in payload)
    out = _out(df, keys, "vs bigint, ve bigint, " + types)
    return release_by_key(
        df, keys, payload, delay, lambda key, saved: _Session(timeout, max_duration, saved), out,
        f"session 1 {timeout} {max_duration}",
    )


class _Snapshot:
    """Running count and sum over active lifetimes; a segment is emitted when the next edge is known."""

    def __init__(self, saved):
        self.since, self.n, self.total, self.ends = saved or (None, 0, 0, [])

    def _edge(self, t):
        out = []
        if self.n and self.since is not None and self.since < t:
            out.append((self.since, t, self.n, self.total))
        self.since = t
        return out

    def _expire(self, t):
        out = []
        while self.ends and self.ends[0][0] <= t:
            end, value = heappop(self.ends)
            out.extend(self._edge(end))
            self.n, self.total = self.n - 1, self.total - value
        return out

    def row(self, t, values):
        ve, value = values
        out = self._expire(t) + self._edge(t)
        self.n, self.total = self.n + 1, self.total + (value or 0)
        heappush(self.ends, (int(ve), value or 0))
        return out

    def advance(self, t):
        return self._expire(t)

    def wake(self):
        return self.ends[0][0] if self.ends else None

    def save(self):
        return (self.since, self.n, self.total, self.ends) if self.n else None


def stream_snapshot(df, keys, value, delay):
    """Count and sum per snapshot for general lifetimes, on a stream."""
    rows = df.select(*keys, "vs", "ve", F.col(value).alias("_v"))
    out = _out(df, keys, "vs bigint, ve bigint, n bigint, total bigint")
    return release_by_key(rows, keys, ["ve", "_v"], delay, lambda key, saved: _Snapshot(saved), out, "snapshot 1")


class _Stitch:
    """Links each end to a start at the same instant, per payload."""

    def __init__(self, saved):
        self.open = {e: deque(s) for e, s in saved} if saved else {}

    def row(self, t, values):
        ve = int(values[0])
        out = self._done(t)
        queue = self.open.get(t)
        start = queue.popleft() if queue else t
        self.open.setdefault(ve, deque()).append(start)
        return out

    def _done(self, before):
        out = []
        for end in sorted(e for e in self.open if e < before):
            out.extend((start, end) for start in self.open.pop(end))
        return out

    def advance(self, t):
        return self._done(t)

    def wake(self):
        ends = [e for e, s in self.open.items() if s]
        return min(ends) + 1 if ends else None

    def save(self):
        left = [(e, list(s)) for e, s in self.open.items() if s]
        return left or None


def stream_stitch(df, keys, delay):
    """`TemporalFrame.stitch` on a stream; `keys` must be all columns that make rows equal."""
    out = _out(df, keys, "vs bigint, ve bigint")
    return release_by_key(df, keys, ["ve"], delay, lambda key, saved: _Stitch(saved), out, "stitch 1")


def _tagged(left: DataFrame, right: DataFrame, keys) -> tuple[DataFrame, list[str], list[str]]:
    """Rows of both sides with their `_side`, and the payload columns of either; without keys one that is always equal."""
    mine, theirs = ([c for c in df.columns if c not in ("vs", "ve", *keys)] for df in (left, right))
    if set(mine) & set(theirs):
        raise ValueError("payload columns must be named differently on the two sides")
    ends = [df if "ve" in df.columns else df.withColumn("ve", F.col("vs") + 1) for df in (left, right)]
    sides = [df.select(*(keys or [F.lit(0).alias("_all")]), "vs", "ve", *p, F.lit(i).alias("_side")) for i, (df, p) in enumerate(zip(ends, (mine, theirs), strict=True))]
    return sides[0].unionByName(sides[1], allowMissingColumns=True), mine, theirs


class _Clip:
    """Open rows, by their ends; the next event of the other side that comes after their start closes them."""

    def __init__(self, saved):
        self.open, self.seen = saved or ([], 0)

    def _over(self, t):
        out = []
        while self.open and self.open[0][0] <= t:
            ve, _, vs, payload = heappop(self.open)
            out.append((vs, ve, *payload))
        return out

    def row(self, t, values):
        side, ve, *payload = values
        out = self._over(t)
        if side:
            out.extend((vs, t, *p) for _, _, vs, p in self.open if vs < t)
            self.open = [o for o in self.open if o[2] == t]
        else:
            self.seen += 1
            heappush(self.open, (int(ve), self.seen, t, tuple(payload)))
        return out

    def advance(self, t):
        return self._over(t)

    def wake(self):
        return self.open[0][0] if self.open and self.open[0][0] < INF else None

    def save(self):
        return (self.open, self.seen) if self.open else None


def stream_clip_by(left, right, keys, delay):
    """`TemporalFrame.clip_by` on streams: the row is emitted when it is clipped or the watermark passes its end."""
    rows, mine, _ = _tagged(left, right.select(*keys, "vs"), keys)
    names = list(keys) or ["_all"]
    types = "".join(f", `{c}` {left.schema[c].dataType.simpleString()}" for c in mine)
    out = _out(rows, names, "vs bigint, ve bigint" + types)
    found = release_by_key(rows, names, ["_side", "ve", *mine], delay, lambda key, saved: _Clip(saved), out, "clip 1")
    return found if keys else found.drop("_all")


class _Uncovered:
    """Left rows with the time since which no right row covers them, and the right rows that are active.

    A stretch without cover is emitted when a right row or the end of the left row closes it. With `pairs`, so is every
    overlap of two rows, as soon as both have begun.
    """

    def __init__(self, pairs, n_left, n_right, saved):
        self.pairs, self.n_left, self.n_right = pairs, n_left, n_right
        self.left, self.right, self.seen = saved or ({}, [], 0)  # left: number -> [since, vs, ve, payload]

    def _stretch(self, row, t):
        since, _, _, payload = row
        return [(since, t, *payload, *[None] * (self.n_right if self.pairs else 0))] if since is not None and since < t else []

    def _over(self, t):
        """Ends up to t, of both sides, in order."""
        out = []
        while True:
            first = min(((r[2], i) for i, r in self.left.items()), default=None)
            end = self.right[0][0] if self.right else None
            if end is not None and end <= t and (first is None or end <= first[0]):
                heappop(self.right)
                if not self.right:
                    for row in self.left.values():
                        row[0] = end
            elif first is not None and first[0] <= t:
                out.extend(self._stretch(self.left.pop(first[1]), first[0]))
            else:
                return out

    def _pair(self, left, right, t):
        _, _, ve, payload = left
        return (t, min(ve, right[0]), *payload, *right[2])

    def row(self, t, values):
        side, ve, *payload = values
        out, ve = self._over(t), int(ve)
        self.seen += 1
        if side:
            right = (ve, self.seen, tuple(payload[self.n_left :]))
            for row in self.left.values():
                out.extend(self._stretch(row, t))
                row[0] = None
                if self.pairs:
                    out.append(self._pair(row, right, t))
            heappush(self.right, right)
        else:
            row = [None if self.right else t, t, ve, tuple(payload[: self.n_left])]
            self.left[self.seen] = row
            if self.pairs:
                out.extend(self._pair(row, right, t) for right in self.right)
        return out

    def advance(self, t):
        return self._over(t)

    def wake(self):
        ends = [r[2] for r in self.left.values()] + [r[0] for r in self.right[:1]]
        return min(ends) if ends and min(ends) < INF else None

    def save(self):
        return (self.left, self.right, self.seen) if self.left or self.right else None


def _uncovered(left, right, keys, delay, pairs: bool):
    rows, mine, theirs = _tagged(left, right, keys)
    names = list(keys) or ["_all"]
    shown = [*mine, *theirs] if pairs else mine
    types = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in shown)
    out = _out(rows, names, "vs bigint, ve bigint" + types)
    n, m = len(mine), len(theirs)
    version = f"uncovered 1 {pairs}"
    found = release_by_key(
        rows, names, ["_side", "ve", *mine, *theirs], delay, lambda key, saved: _Uncovered(pairs, n, m, saved), out, version
    )
    return found if keys else found.drop("_all")


def stream_anti_join(left, right, keys, delay):
    """`TemporalFrame.where_not_exists` on streams, for general lifetimes: several stretches for a row.

    A stretch comes out when a right row or the row's end closes it and the watermark has passed that. Right rows keep
    only their ends as long as they are active.
    """
    return _uncovered(left, right.select(*keys, "vs", "ve"), keys, delay, pairs=False)


def stream_left_outer_join(left, right, keys, delay):
    """`TemporalFrame.left_outer_join` on streams: overlaps with their right rows, and uncovered stretches with nulls."""
    return _uncovered(left, right, keys, delay, pairs=True)


def stream_arrivals(df, per, arrival: str):
    """Rows with `_now`, their partition's clock when they arrived: the largest start seen before.

    Partitions are the values of the columns `per`. The rows of a trigger are taken by `arrival`; between triggers a
    partition keeps one number.
    """
    rest = [c for c in df.columns if c not in per]
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, IntegralType)}
    rows = df.select(*per, *[(F.col(f"`{c}`").cast("string") if c in whole else F.col(f"`{c}`")).alias(c) for c in rest])
    schema = StructType([*[df.schema[c] for c in per], *[df.schema[c] for c in rest]]).add("_now", "long")

    def update(key, batches, state):
        clock = state.get[0] if state.exists else None
        values = []
        for pdf in batches:
            columns = []
            for c in rest:
                given = pdf[c].astype(object).where(pdf[c].notna(), None)
                columns.append([x if x is None else int(x) for x in given] if c in whole else given.tolist())
            values.extend(zip(*columns, strict=True))
        at, start = rest.index(arrival), rest.index("vs")
        values.sort(key=lambda v: v[at])
        out = []
        for v in values:
            out.append((*key, *v, clock))
            clock = v[start] if clock is None else max(clock, v[start])
        state.update((clock,))
        yield pd.DataFrame(out, columns=schema.names, dtype=object)

    state = _parse_datatype_string("clock bigint")
    return rows.groupBy(*per).applyInPandasWithState(update, schema, state, "append", "NoTimeout")


def stream_disorder(df, per, arrival: str, policy: str, latency: int = 0, end: str = "ve"):
    """`Disorder(per=...)` on a stream: what its policy makes of rows that arrive late.

    `policy` is "drop", "adjust" (late starts move to the partition's time, rows that are over by then go) or "throw",
    which give the rows in order; or "report drop" and "report adjust", which give the late rows with their `action` and
    `delta`.
    """
    rows = stream_arrivals(df, per, arrival)
    now = F.greatest(F.coalesce(F.col("_now") - F.lit(latency), F.lit(MIN_T)), F.lit(MIN_T))
    rows = rows.withColumn("_now", now)
    late = F.col("vs") < F.col("_now")
    if policy == "drop":
        out = rows.where(~late)
    elif policy == "adjust":
        out = rows.withColumn("vs", F.greatest("vs", "_now")).where(F.col("vs") < F.col(end))
    elif policy == "throw":
        bad = F.raise_error(F.concat(F.lit("late row at "), F.col("vs").cast("string")))
        out = rows.withColumn("vs", F.when(late, bad).otherwise(F.col("vs")))
    elif policy in ("report drop", "report adjust"):
        over = F.lit(policy == "report drop") | (F.col("_now") >= F.col(end))
        return rows.where(late).select(
            *df.columns,
            F.when(over, "dropped").otherwise("adjusted").alias("action"),
            F.when(~over, F.col("_now") - F.col("vs")).alias("delta"),
        )
    else:
        raise ValueError(f"no policy {policy!r}")
    return out.select(*df.columns)
