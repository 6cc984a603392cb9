"""Machines of streams and queues of edges on small inputs."""

import math
import pickle
import random
from collections import Counter, defaultdict, deque
from types import SimpleNamespace

import pytest

from tests.test_model import snapshots as by_definition
from tidespan import INF
from tidespan.sources.ingress import DisorderedEdges
from tidespan.streaming import snapshots as SN
from tidespan.streaming import stateful as ST
from tidespan.streaming.runner import QueryContainer, replay


def intervals(rnd, n, horizon=40, longest=9):
    return [(vs := rnd.randrange(horizon), vs + 1 + rnd.randrange(longest), i) for i in range(n)]


def fed(make, rows, rnd):
    """The machine's output, saved and loaded at random, with rows of a time in any order."""
    saved, out, machine = None, [], make(None)
    order = sorted(rows, key=lambda r: (r[0], rnd.random()))
    for t, values in order:
        out += machine.row(t, values)
        if rnd.random() < 0.3:
            out += machine.advance(t - 1)
            saved = machine.save()
            machine = make(pickle.loads(pickle.dumps(saved)) if saved is not None else None)
    return out + machine.advance(10**6)


def ticks(rows):
    return [(t, *r[2:]) for r in rows for t in range(r[0], r[1])]


@pytest.mark.parametrize("seed", range(30))
def test_uncovered_stretches_and_pairs(seed):
    rnd = random.Random(seed)
    left, right = intervals(rnd, 12), intervals(rnd, rnd.randrange(10), longest=6)
    rows = [(vs, (0, ve, i, None)) for vs, ve, i in left] + [(vs, (1, ve, None, -i)) for vs, ve, i in right]
    covered = {t for vs, ve, _ in right for t in range(vs, ve)}
    alone = Counter((t, i) for vs, ve, i in left for t in range(vs, ve) if t not in covered)
    out = fed(lambda saved: ST._Uncovered(False, 1, 1, saved), rows, rnd)
    assert Counter(ticks(out)) == alone
    by_row = defaultdict(list)
    for vs, ve, i in out:
        by_row[i].append((vs, ve))
    assert all(a[1] < b[0] for parts in by_row.values() for a, b in zip(sorted(parts), sorted(parts)[1:], strict=False))
    out = fed(lambda saved: ST._Uncovered(True, 1, 1, saved), rows, rnd)
    pairs = Counter((max(a, c), min(b, d), i, -j) for a, b, i in left for c, d, j in right if a < d and c < b)
    assert Counter(o for o in out if o[3] is not None) == pairs
    assert Counter(ticks([o for o in out if o[3] is None])) == Counter({(t, i, None): n for (t, i), n in alone.items()})


@pytest.mark.parametrize("seed", range(20))
def test_clipped_rows(seed):
    rnd = random.Random(seed)
    left = [(vs, INF if rnd.random() < 0.2 else ve, i) for vs, ve, i in intervals(rnd, 15)]
    right = [rnd.randrange(40) for _ in range(6)] + [50]
    rows = [(vs, (0, ve, i)) for vs, ve, i in left] + [(t, (1, t + 1, None)) for t in right]
    want = Counter((vs, min([ve, *(t for t in right if t > vs)]), i) for vs, ve, i in left)
    assert Counter(fed(ST._Clip, rows, rnd)) == want


@pytest.mark.parametrize("seed", range(20))
def test_snapshots_of_buckets(seed):
    """Pieces of buckets, put together, are the snapshots of all rows."""
    rnd = random.Random(seed)
    values = [None, 0.5, -3.25, 1e300, 7.0, math.inf] if seed % 2 else list(range(9))
    rows = [(vs, ve, rnd.choice(values)) for vs, ve, _ in intervals(rnd, 25, longest=25)]
    aggs = [SN.count(), SN.Live("sum", "v", None, "double" if seed % 2 else "bigint"), SN.min_("v"), SN.top("v", 2), SN.percentile_discrete("v", 0.5)]
    pieces = []
    for lo in range(0, 80, 8):
        mine = [r for r in rows if r[0] < lo + 8 and r[1] > lo]
        pieces += SN.snapshots(mine, lo, lo + 8, aggs, ["v"])
    joined = []
    for vs, ve, found, before, after in pieces:
        if before and joined and joined[-1][3] and joined[-1][1] == vs:
            assert repr(joined[-1][2]) == repr(found)
            joined[-1] = (joined[-1][0], ve, found, after)
        else:
            joined.append((vs, ve, found, after))

    def result(active):
        v = sorted(x for x in active if x is not None)
        total = (math.fsum(v) if math.inf not in v else math.inf) if seed % 2 else sum(v)
        return len(active), total, v[0] if v else None, v[::-1][:2], v[max(-(-len(v) // 2), 1) - 1] if v else None

    want = by_definition([(vs, ve, None, v) for vs, ve, v in rows], lambda a: (repr(list(result(a))),))
    assert Counter((None, vs, ve, repr(found)) for vs, ve, found, _ in joined) == want


def test_pieces_are_put_together(spark):
    rows = [("a", 0, 8, 1, False, True), ("a", 8, 16, 1, True, True), ("a", 16, 20, 1, True, False), ("a", 20, 24, 2, False, False),
            ("a", 24, 30, 3, True, False), (None, 3, 8, 4, False, True), (None, 8, 9, 4, True, False), ("b", 8, 9, 5, True, False)]
    pieces = spark.createDataFrame(rows, "k string, vs long, ve long, n int, _cut_before boolean, _cut_after boolean")
    got = sorted((tuple(r) for r in SN.whole(pieces, ["k"]).collect()), key=repr)
    want = [("a", 0, 20, 1), ("a", 20, 24, 2), ("a", 24, 30, 3), (None, 3, 9, 4), ("b", 8, 9, 5)]
    assert got == sorted(want, key=repr)


def test_state_of_another_version_is_refused():
    """A query that goes on with other parameters fails instead of misreading its state."""
    taken = {}

    class Frame(SimpleNamespace):
        def applyInPandasWithState(self, update, *rest):
            taken["update"] = update

    def update_of(version):
        import tidespan.streaming.stateful as module

        frame = Frame(schema=defaultdict(lambda: SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "string"))))
        frame.select = frame.withColumn = frame.withWatermark = frame.groupBy = lambda *a, **k: frame
        module.release_in_order(frame, ["k"], [], "1 hour", lambda key, saved: ST._Signal(saved), SimpleNamespace(names=["k", "vs", "ve"]), version)
        return taken["update"]

    class State(SimpleNamespace):
        def update(self, value):
            self.get, self.exists = value, True

        def getCurrentWatermarkMs(self):
            return 0

        def setTimeoutTimestamp(self, t):
            pass

    import pandas as pd

    state = State(exists=False, get=None)
    list(update_of("signal 1")(("a",), [pd.DataFrame({"vs": [5]})], state))
    assert state.exists
    list(update_of("signal 1")(("a",), [pd.DataFrame({"vs": [6]})], state))
    with pytest.raises(ValueError, match="written by signal 1 .* cannot be read by signal 2"):
        list(update_of("signal 2")(("a",), [pd.DataFrame({"vs": [7]})], state))


def slow_edges(given, latency, policy):
    """Edges one by one, with a queue for each start and payload."""
    clock, queues, out = {}, defaultdict(deque), []
    for arrival, per, payload, begins, vs, start in sorted(given):
        now = max(clock.get(per, 0) - latency, 0)
        clock[per] = max(clock.get(per, 0), vs)
        late = vs < now
        if begins:
            if late:
                queues[per, payload, vs].append(now)
            if not (late and policy == "drop"):
                out.append((arrival, per, payload, begins, max(vs, now), start))
        elif queues[per, payload, start]:
            moved = queues[per, payload, start].popleft()
            if policy == "adjust":
                out.append((arrival, per, payload, begins, max(vs, now), moved))
        elif not (late and policy == "drop"):
            out.append((arrival, per, payload, begins, max(vs, now), start))
    return Counter(out)


@pytest.mark.parametrize("policy", ["drop", "adjust"])
def test_ends_follow_their_starts(spark, policy):
    """Few payloads and starts, so that queues hold several equal ones, some of them in time and some late."""
    spark.conf.set("tidespan.slices", 8)
    rnd = random.Random(9)
    given, used = [], set()
    for _ in range(150):
        start, per, payload = rnd.randrange(6) * 10, rnd.choice(["a", None]), rnd.choice("xy")
        ends = start + 10 + rnd.randrange(30)
        first = start * 100 + rnd.randrange(6000)
        for begins, vs, arrival in ((True, start, first), (False, ends, max(first + 1, ends * 100 + rnd.randrange(3000)))):
            while arrival in used:
                arrival += 1
            used.add(arrival)
            given.append((arrival, per, payload, begins, vs, start))
    given = [(*r[:3], r[3], r[4], r[5]) for r in sorted(given, key=lambda r: r[0])]
    df = spark.createDataFrame(given, "arrival long, per string, payload string, begins boolean, vs long, start long")
    edges = DisorderedEdges(df, "arrival", "begins", "start", ["payload"], latency=5, per="per")
    out = getattr(edges, policy)()
    spark.conf.unset("tidespan.slices")
    key = lambda r: (r[0], r[1] or "", *r[2:])
    want = slow_edges([key(r) for r in given], 5, policy)
    assert Counter(key(tuple(r)) for r in out.collect()) == want


def test_consumers_come_and_go(spark, tmp_path):
    """A consumer that is detached and attached again goes on; one that comes later sees everything."""
    rows = lambda a, b: spark.range(a, b).selectExpr("id AS vs", "id % 3 AS k")
    replay(str(tmp_path / "in"), rows(0, 50))
    box = QueryContainer(spark, str(tmp_path / "home"))
    box.publish("log", box.register_input("in", str(tmp_path / "in"), rows(0, 1).schema))
    box.run()
    box.attach("first", "log", lambda s: s.where("k = 1")).awaitTermination()
    box.detach("first")
    replay(str(tmp_path / "in"), rows(50, 90))
    box.run()
    box.attach("first", "log", lambda s: s.where("k = 1")).awaitTermination()
    box.attach("late", "log", lambda s: s.where("k = 1"), since=30).awaitTermination()
    assert sorted(r.vs for r in box.result("first").collect()) == list(range(1, 90, 3))
    assert sorted(r.vs for r in box.result("late").collect()) == list(range(31, 90, 3))
