"""How much work operators make of larger inputs, and that larger inputs give whole results."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidespan import TemporalFrame
from tidespan.functions import aggregates as A, automaton as P
from tidespan.streaming import bucketed as SB, snapshots as SN, stateful as ST
from tidespan.streaming.runner import QueryContainer, replay


def test_rows_are_read_in_two_slices_at_most(spark):
    """However many slices there are, looking a match duration ahead does not multiply the rows."""
    spark.conf.set("tidespan.slices", 64)
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.col("id").alias("vs"), (F.col("id") + 1).alias("ve"))
    f = TemporalFrame(df, ["k"])
    for longest in (1, 3, 100, 700, 5000):
        rows = f._slices_ahead(f.df, longest)
        assert rows.groupBy("vs").count().agg(F.max("count")).first()[0] <= 2
        assert rows.where("_own").count() == 2000
        # of each slice, all rows that its own rows may reach
        own = rows.where("_own").groupBy("_chunk").agg(F.max("vs").alias("last"))
        ahead = {r["_chunk"]: r["n"] for r in rows.where("not _own").groupBy("_chunk").agg(F.count("*").alias("n")).collect()}
        for r in own.collect():
            assert ahead.get(r["_chunk"], 0) >= min(longest - 1, 1999 - r["last"])
    spark.conf.unset("tidespan.slices")


def test_slices_ahead_find_what_one_slice_finds(spark):
    rows = [(i % 3, i * 10, "ab"[(i * i + i // 5) % 2]) for i in range(300)]
    f = TemporalFrame(spark.createDataFrame(rows, "k int, vs long, kind string").withColumn("ve", F.col("vs") + 1), ["k"])
    note = lambda t, e, reg: (t if reg is None else reg[0], 1 if reg is None else reg[1] + 1)
    pattern = P.sequence(P.single(F.col("kind") == "a", note).repeated(), P.single(lambda t, e, reg: e.kind == "b", note))
    found = []
    for slices in (2, 64):
        spark.conf.set("tidespan.slices", slices)
        out = TemporalFrame(f.df, ["k"]).detect(pattern, 400, "first bigint, n bigint")
        found.append(sorted(tuple(r) for r in out.df.select("k", "vs", "ve", "first", "n").collect()))
    spark.conf.unset("tidespan.slices")
    assert found[0] and found[0] == found[1]


def test_keys_of_a_stream_share_groups(spark, tmp_path):
    """State is kept by shard, not by key; keys may be null, and values among nulls keep their digits."""
    rows = spark.range(1, 6001).select(
        F.when(F.col("id") % 3000 > 0, F.col("id") % 3000).alias("k"), F.when(F.col("id") % 5 > 0, "x").alias("name"),
        F.col("id").alias("vs"), F.when(F.col("id") % 7 > 0, F.col("id") + 9007199254740993).alias("wide"),
    )
    replay(str(tmp_path / "in"), rows)
    box = QueryContainer(spark, str(tmp_path / "home"))
    stream = box.register_input("in", str(tmp_path / "in"), rows.schema)
    box.register_output("out", ST.stream_signal(stream, ["k", "name"], "1 second"))
    box.run()
    assert 0 < box.progress("out")["state_rows"] <= ST.SHARDS < 3000
    replay(str(tmp_path / "in"), rows.limit(1).withColumn("vs", F.lit(10**13)).withColumn("k", F.lit(-1).cast("long")))
    box.run()
    got = sorted((tuple(r) for r in box.result("out").select("k", "name", "vs", "ve", "wide").collect()), key=repr)
    given = sorted(rows.collect(), key=lambda r: r.vs)
    last, want = {}, []
    for r in given:
        before = last.get((r.k, r.name))
        if before is not None:
            want.append((r.k, r.name, before.vs, r.vs, before.wide))
        last[r.k, r.name] = r
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(20))
def test_buckets_of_clips_and_stretches(seed):
    """What buckets say of rows, put together, is what the machine over all time says."""
    rnd = random.Random(seed)
    left = [(vs := rnd.randrange(40), vs + 1 + rnd.randrange(25), i) for i in range(15)]
    right = np.array([(vs := rnd.randrange(45), vs + 1 + rnd.randrange(6)) for _ in range(rnd.randrange(8))], np.int64).reshape(-1, 2)
    clips, ticks = {}, Counter()
    for lo in range(0, 80, 8):
        inside = lambda r, lo=lo: r[0] < lo + 8 and r[1] > lo
        here = np.array([r for r in right if inside(r)], np.int64).reshape(-1, 2)
        mine = [r for r in left if inside(r)]
        events = here[(here[:, 0] >= lo)]
        for vs, ve, i, clip, first, last in SB.clipped(mine, events, lo, lo + 8):
            assert first == (vs >= lo) and last == (ve <= lo + 8)
            clips[vs, ve, i] = min(clips.get((vs, ve, i), ve), ve if clip is None else clip)
        for vs, ve, i, own_vs, own_ve, before, after in SB.uncovered(mine, here, lo, lo + 8):
            assert before == (vs == lo and own_vs < lo) and after == (ve == lo + 8 and own_ve > lo + 8)
            ticks.update((t, i) for t in range(vs, ve))
    assert clips == {(vs, ve, i): min([ve, *(int(t) for t, _ in right if t > vs)]) for vs, ve, i in left}
    covered = {t for a, b in right for t in range(a, b)}
    assert ticks == Counter((t, i) for vs, ve, i in left for t in range(vs, ve) if t not in covered)


def test_one_timeline_is_spread_over_buckets(spark, tmp_path):
    """Equal rows, rows over many buckets, null payloads; no group has all rows."""
    given = [(i % 50 * 10 + 10**6, 1 + i * i % 90, None if i % 4 == 0 else i % 3, i % 5 == 0) for i in range(200)] * 2
    df = spark.createDataFrame([(vs, vs + n, k, right) for vs, n, k, right in given] + [(10**12, 10**12 + 1, 0, r) for r in (True, False)],
                               "vs long, ve long, k int, right boolean")
    replay(str(tmp_path / "in"), df)
    found = {}
    for name, build, whole in (("clip", SB.clip_by, SB.whole_clips), ("anti", SB.anti_join, SB.whole_stretches)):
        box = QueryContainer(spark, str(tmp_path / name))
        stream = box.register_input("in", str(tmp_path / "in"), df.schema)
        box.register_output("out", build(stream.where("not right").drop("right"), stream.where("right").select("vs", "ve"), [], 64, "1 second"))
        box.run()
        found[name] = Counter(tuple(r) for r in whole(box.result("out")).select("vs", "ve", "k").collect())
    left = [(vs, vs + n, k) for vs, n, k, right in given if not right]
    right = [(vs, vs + n) for vs, n, _, right in given if right]
    assert found["clip"] == Counter((vs, min([ve, *(t for t, _ in right if t > vs)]), k) for vs, ve, k in left)
    machine, want = ST._Uncovered(False, 1, 0, None), []
    for t, values in sorted([(vs, (0, ve, k)) for vs, ve, k in left] + [(vs, (1, ve, None)) for vs, ve in right], key=lambda r: r[0]):
        want += machine.row(t, values)
    assert found["anti"] == Counter(want + machine.advance(10**9))


def test_snapshots_read_their_rows_once():
    """Rows come one by one out of state and are not gathered as rows."""
    rows = [(i % 7, i % 7 + 3 + i % 5, i) for i in range(50)]
    aggs = [SN.count(), SN.max_("v")]
    assert list(SN.snapshots(iter(rows), 2, 9, aggs, ["v"])) == list(SN.snapshots(rows, 2, 9, aggs, ["v"])) != []
    assert list(SN.snapshots(iter(()), 2, 9, aggs, ["v"])) == []


def shuffled_rows(df) -> int:
    """Rows that the shuffles of a query have written."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()

    def walk(node):
        name, below = node.getClass().getSimpleName(), node.children()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name == "ReusedExchangeExec":
            return 0
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        mine = node.metrics().get("shuffleRecordsWritten").get().value() if name == "ShuffleExchangeExec" else 0
        return mine + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(plan)


@pytest.mark.parametrize("made", ["top", "extremes", "deviations"])
def test_states_are_handed_down_the_blocks(spark, made):
    """Lifetimes that overlap by the hundred: a snapshot does not look up every level above it, and the results are whole."""
    n = 2000
    rnd = random.Random(5)
    given = [(i * 3, i * 3 + 1 + rnd.randrange(n), float(rnd.randrange(10**6)) if i % 11 else None) for i in range(n)]
    f = TemporalFrame(spark.createDataFrame(given, "vs long, ve long, v double").coalesce(1))
    instants = sorted({t for vs, ve, _ in given for t in (vs, ve)})
    if made == "top":
        out = f.top_k(2, "v").df.select("vs", "rank", "v")
        want = lambda a: [(1 + sum(x > y for x in a), y) for y in sorted(a, reverse=True)[:2]]
    elif made == "extremes":
        out = f.aggregate(n=A.count(), lo=A.min_("v"), hi=A.max_("v")).df.select("vs", "n", "lo", "hi")
    else:
        out = f.aggregate(d=A.population_variance("v"), e=A.population_stddev("v")).df.select("vs", "d", "e")
    assert shuffled_rows(out) <= 16 * len(instants)
    got = {}
    for vs, *values in out.collect():
        got.setdefault(vs, []).append(tuple(values))
    for vs in rnd.sample(instants[:-1], 60):
        alive = [v for a, b, v in given if a <= vs < b]
        known = [v for v in alive if v is not None]
        if made == "top" and len(known) > 1:
            assert sorted(got[vs]) == sorted(want(known))
        elif made == "extremes" and alive:
            assert got[vs] == [(len(alive), min(known, default=None), max(known, default=None))]
        elif made == "deviations" and alive:
            d = np.var(known) if known else None
            assert got[vs][0] == ((None, None) if d is None else pytest.approx((d, d**0.5), rel=1e-9, abs=1e-6))


def test_quantiles_of_the_same_values_share_segments_and_scans(spark, monkeypatch):
    """One sweep for all places; hot keys, which are cut, are scanned once for each place, and the results are whole."""
    from tidespan.plans import quantiles

    calls = []
    monkeypatch.setattr(quantiles, "sweep", lambda *a, f=quantiles.sweep, **k: calls.append(1) or f(*a, **k))
    spark.conf.set("tidespan.slices", 16)
    rnd = random.Random(8)
    given = [(t, t + 1 + rnd.randrange(60), rnd.choice(["hot", "hot", "hot", None, *"abcdefgh"]), rnd.randrange(99) if t % 9 else None) for t in range(400)]
    f = TemporalFrame(spark.createDataFrame(given, "vs long, ve long, k string, v int"), ["k"])
    shares = {"low": 0.1, "mid": 0.5, "high": 0.9}
    out = f.aggregate(**{n: A.percentile_discrete("v", p) for n, p in shares.items()}, c=A.percentile_continuous("v", 0.5))
    got = {(k, vs): values for k, vs, *values in out.df.select("k", "vs", *shares, "c").collect()}
    spark.conf.unset("tidespan.slices")
    assert len(calls) == 1
    want = {}
    for key in {r[2] for r in given}:
        mine = [r for r in given if r[2] == key]
        for t in {t for r in mine for t in r[:2]}:
            alive = [r[3] for r in mine if r[0] <= t < r[1]]
            known = sorted(v for v in alive if v is not None)
            if alive:
                places = [known[max(int(np.ceil(p * len(known))), 1) - 1] if known else None for p in shares.values()]
                want[key, t] = [*places, float(np.median(known)) if known else None]
    assert got == want


def test_functions_of_snapshots_are_not_called_by_sparks_grouping(spark):
    """Groups that reach over batches, nulls among the values, null keys, and results of several types."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    rnd = random.Random(9)
    given = [(t, t + 1 + rnd.randrange(30), rnd.choice(["a", None]), rnd.randrange(99) if t % 5 else None) for t in range(80)]
    f = TemporalFrame(spark.createDataFrame(given, "vs long, ve long, k string, v long"), ["k"])

    def spread(v) -> int:
        return None if v.isna().all() else int(v.max() - v.min()) * 10 + len(v)

    out = f.aggregate_pandas(spread, "v", "bigint", "s").df
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()
    got = Counter(tuple(r) for r in out.select("k", "vs", "ve", "s").collect())
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = Counter()
    for key in ("a", None):
        mine = [r for r in given if r[2] == key]
        cuts = sorted({t for r in mine for t in r[:2]})
        for a, b in zip(cuts, cuts[1:], strict=False):
            alive = [r[3] for r in mine if r[0] <= a < r[1]]
            known = [v for v in alive if v is not None]
            if alive:
                want[key, a, b, (max(known) - min(known)) * 10 + len(alive) if known else None] += 1
    assert got == want
