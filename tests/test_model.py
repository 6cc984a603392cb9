"""Random small inputs against a plain model that walks time tick by tick, under several slicings and skews."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidespan import INF, TemporalFrame
from tidespan.functions import aggregates as A

SCHEMA = "vs long, ve long, k string, v long"


def events(seed, n=60, horizon=40, hot=0.4, open_share=0.1):
    """Rows of which a large part has one key."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        vs = rnd.randrange(horizon)
        ve = INF if rnd.random() < open_share else vs + 1 + rnd.randrange(12)
        key = "hot" if rnd.random() < hot else rnd.choice(["a", "b", None])
        out.append((vs, ve, key, rnd.randrange(9)))
    return out


def snapshots(given, fn):
    """(key, vs, ve, fn(active values)) by definition."""
    out = []
    for key in {r[2] for r in given}:
        mine = [r for r in given if r[2] == key]
        cuts = sorted({t for r in mine for t in r[:2]})
        for a, b in zip(cuts, cuts[1:], strict=False):
            active = [r[3] for r in mine if r[0] <= a and r[1] >= b]
            if active:
                out.append((key, a, b, *fn(active)))
    return Counter(out)


def bag(out, *columns):
    df = out.df if hasattr(out, "df") else out
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(params=[2, 16])
def sliced(spark, request):
    spark.conf.set("tidespan.slices", request.param)
    yield
    spark.conf.unset("tidespan.slices")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_snapshot_aggregates(spark, sliced, seed):
    given = events(seed)
    f = TemporalFrame(spark.createDataFrame(given, SCHEMA), "k")
    out = f.aggregate(n=A.count(), s=A.sum_("v"), lo=A.min_("v"), hi=A.max_("v"), d=A.percentile_discrete("v", 0.3))
    want = snapshots(given, lambda a: (len(a), sum(a), min(a), max(a), sorted(a)[max(-(-3 * len(a) // 10), 1) - 1]))
    assert bag(out, "k", "vs", "ve", "n", "s", "lo", "hi", "d") == want


@pytest.mark.parametrize("seed", [1, 2])
def test_percentiles(spark, seed):
    given = [(vs, ve, k, v * 37 + i % 5 if i % 7 else None) for i, (vs, ve, k, v) in enumerate(events(seed))]
    f = TemporalFrame(spark.createDataFrame(given, SCHEMA), "k")
    out = f.aggregate(d=A.percentile_discrete("v", 0.3), c=A.percentile_continuous("v", 0.5))

    def middle(active):
        a = sorted(x for x in active if x is not None)
        if not a:
            return (None, None)
        return a[max(-(-3 * len(a) // 10), 1) - 1], (a[(len(a) - 1) // 2] + a[len(a) // 2]) / 2

    assert bag(out, "k", "vs", "ve", "d", "c") == snapshots(given, middle)


@pytest.mark.parametrize("seed", [1, 2])
def test_top_two(spark, sliced, seed):
    given = events(seed)
    f = TemporalFrame(spark.createDataFrame(given, SCHEMA), "k")

    def best(active):
        ranked = [(1 + sum(b > a for b in active), a) for a in active]
        return (tuple(sorted(r for r in ranked if r[0] <= 2)),)

    want = snapshots(given, best)
    got = {}
    for k, vs, ve, rank, v in f.top_k(2, "v").df.select("k", "vs", "ve", "rank", "v").collect():
        got.setdefault((k, vs, ve), []).append((rank, v))
    assert Counter((*key, tuple(sorted(r))) for key, r in got.items()) == want


def overlap(a, b):
    return max(a[0], b[0]), min(a[1], b[1])


@pytest.mark.parametrize("keyed", [True, False])
def test_join(spark, sliced, keyed):
    left, right = events(4), events(5)
    lf = TemporalFrame(spark.createDataFrame(left, SCHEMA).withColumnRenamed("v", "x"))
    rf = TemporalFrame(spark.createDataFrame(right, SCHEMA).withColumnRenamed("k", "k" if keyed else "k2"))
    want = Counter()
    for a in left:
        for b in right:
            vs, ve = overlap(a, b)
            if vs < ve and (not keyed or a[2] == b[2]):
                want[(vs, ve, a[3], b[3])] += 1
    assert bag(lf.join(rf, "k" if keyed else []), "vs", "ve", "x", "v") == want


@pytest.mark.parametrize("keyed", [True, False])
def test_anti_join(spark, sliced, keyed):
    left, right = events(6), events(7, n=8, open_share=0.0)
    lf = TemporalFrame(spark.createDataFrame(left, SCHEMA))
    rf = TemporalFrame(spark.createDataFrame(right, SCHEMA))
    want = Counter()
    for vs, ve, k, v in left:
        stops = sorted({vs, ve} | {t for r in right for t in r[:2] if vs < t < ve})
        pieces = []
        for a, b in zip(stops, stops[1:], strict=False):
            covered = any(r[0] <= a and r[1] >= b and (not keyed or r[2] == k) for r in right)
            if not covered and pieces and pieces[-1][1] == a:
                pieces[-1] = (pieces[-1][0], b)
            elif not covered:
                pieces.append((a, b))
        want.update((a, b, k, v) for a, b in pieces)
    got = lf.where_not_exists(rf, "k" if keyed else [])
    assert bag(got, "vs", "ve", "k", "v") == want


def test_clip(spark, sliced):
    left, right = events(8), events(9, n=12)
    lf = TemporalFrame(spark.createDataFrame(left, SCHEMA))
    rf = TemporalFrame(spark.createDataFrame(right, SCHEMA))
    want = Counter()
    for vs, ve, k, v in left:
        later = [r[0] for r in right if r[2] == k and r[0] > vs]
        want[(vs, min([ve, *later]), k, v)] += 1
    assert bag(lf.clip_by(rf, "k"), "vs", "ve", "k", "v") == want


@pytest.mark.parametrize("cap", [None, 10])
def test_session(spark, sliced, cap):
    given = events(10)
    f = TemporalFrame(spark.createDataFrame(given, SCHEMA), "k").session(4, cap)
    want = Counter()
    for key in {r[2] for r in given}:
        mine = sorted((r for r in given if r[2] == key), key=lambda r: r[0])
        done, waiting, last, limit = [], [], None, INF
        for r in mine:
            t = r[0]
            if last is None or t - last >= 4:
                done += [(w, min(last + 4, limit)) for w in waiting] if waiting else []
                waiting = []
                limit = INF if cap is None else t - t % cap + (cap if t % cap == 0 else 2 * cap)
            elif t >= limit:
                done += [(w, min(last + 4, limit)) for w in waiting]
                waiting, limit = [], t - t % cap + cap
            waiting.append(r)
            last = t
        done += [(w, min(last + 4, limit)) for w in waiting]
        want.update((w[0], end, key, w[3]) for w, end in done)
    assert bag(f, "vs", "ve", "k", "v") == want


def test_chop_then_stitch_is_identity(spark, sliced):
    given = [(vs, ve, k, i) for i, (vs, ve, k, _) in enumerate(events(11, open_share=0))]
    f = TemporalFrame(spark.createDataFrame(given, SCHEMA), "k")
    assert rows(f.chop(0, 5).stitch(), "v", "vs", "ve") == rows(f, "v", "vs", "ve")


def test_stitch_preserves_snapshots(spark, sliced):
    """Stitched rows have the same multiplicity at every instant, and no end meets a start any more."""
    given = [(vs, vs + 1 + v % 3, k, 0) for vs, _, k, v in events(12, n=80, horizon=25)]
    out = TemporalFrame(spark.createDataFrame(given, SCHEMA), "k").stitch().df.select("vs", "ve", "k").collect()
    for t in range(30):
        for k in {r[2] for r in given}:
            assert sum(r.vs <= t < r.ve and r.k == k for r in out) == sum(r[0] <= t < r[1] and r[2] == k for r in given)
    ends, starts = {(r.k, r.ve) for r in out}, {(r.k, r.vs) for r in out}
    assert not ends & starts


@pytest.mark.parametrize("duration", [1, 5, 64])
def test_constant_lifetimes(spark, duration):
    """Every merge that has a two-way form, over blocks shorter and longer than a slice."""
    spark.conf.set("tidespan.slices", 16)
    given = [(vs, vs + duration, k, v) for vs, _, k, v in events(duration, n=90, horizon=120)]
    f = TemporalFrame(spark.createDataFrame(given, SCHEMA), "k").set_duration(duration)
    out = f.aggregate(
        n=A.count(), s=A.sum_("v"), d=A.sum_(F.col("v") / 4), lo=A.min_("v"), hi=A.max_("v"), p=A.product("v"),
        odd=A.sum_("v").where(F.col("v") % 2 == 1), first=A.min_by("v", F.col("v") % 3),
    )
    want = snapshots(given, lambda a: (
        len(a), sum(a), sum(a) / 4, min(a), max(a), float(math.prod(a)), sum(x for x in a if x % 2), min(a, key=lambda x: (x % 3, x))
    ))
    spark.conf.unset("tidespan.slices")
    assert bag(out, "k", "vs", "ve", "n", "s", "d", "lo", "hi", "p", "odd", "first") == want


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_percentiles_of_long_and_equal_values(spark, seed):
    """Lifetimes over many slices, values that most rows share, open rows: places at both ends and in the middle."""
    spark.conf.set("tidespan.slices", 16)
    rnd = random.Random(seed)
    given = []
    for _ in range(400):
        vs = rnd.randrange(300)
        ve = INF if rnd.random() < 0.1 else vs + 1 + rnd.randrange(rnd.choice([3, 250]))
        v = 50 if rnd.random() < 0.3 else rnd.randrange(100)
        given.append((vs, ve, "hot" if rnd.random() < 0.8 else rnd.choice(["a", None]), v))
    shares = [0.0, 0.1, 0.5, 0.97, 1.0]
    at = lambda a, p: sorted(a)[max(math.ceil(p * len(a)), 1) - 1]
    want = snapshots(given, lambda a: tuple(at(a, p) for p in shares))
    for kind in ("long", "string"):
        df = spark.createDataFrame(given, SCHEMA)
        v = F.col("v") if kind == "long" else F.lpad(F.col("v").cast("string"), 3, "0")
        f = TemporalFrame(df.withColumn("v", v), "k")
        outs = {f"p{i}": A.percentile_discrete("v", p) for i, p in enumerate(shares)}
        out = f.aggregate(**outs).df.select("k", "vs", "ve", *[F.col(c).cast("int").alias(c) for c in outs])
        assert bag(out, "k", "vs", "ve", *outs) == want
    spark.conf.unset("tidespan.slices")
