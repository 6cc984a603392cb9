"""Literal inputs with the results the reference's tests expect.

The inputs and expected values below are fixed values: they must equal the reference's for right results.
"""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidespan import INF
from tidespan.functions import aggregates as A, automaton as P
from tidespan.sources import ingress

POINT = "vs long, ve long, field1 int, field2 string"


def points(frame, *given):
    return frame([(t, t + 1, n, s) for t, n, s in given], POINT)


def test_tumbling_sum_by_group(frame):
    f = points(frame, (11, 1, "A"), (12, 1, "A"), (21, 2, "D"), (25, 2, "D")).tumbling(10)
    out = f.group_aggregate("field2", total=A.sum_("field1"))
    assert rows(out, "vs", "ve", "field2", "total") == [(20, 30, "A", 2), (30, 40, "D", 4)]


def test_tumbling_sum_mixed_groups(frame):
    f = points(frame, (11, 1, "A"), (12, 1, "A"), (21, 2, "A"), (25, 2, "D")).tumbling(10)
    out = f.group_aggregate("field2", total=A.sum_("field1"))
    assert rows(out, "vs", "ve", "field2", "total") == [(20, 30, "A", 2), (30, 40, "A", 2), (30, 40, "D", 2)]


def test_tumbling_boundary_belongs_to_earlier_window(frame):
    f = points(frame, (10, 1, "A"), (11, 1, "A"), (20, 1, "A")).tumbling(10)
    assert rows(f, "vs", "ve") == [(10, 20), (20, 30), (20, 30)]


def test_quantize_points(frame):
    f = points(frame, (0, 1, "A"), (10, 1, "A"), (25, 1, "A")).quantize(10, 10)
    assert rows(f, "vs", "ve") == [(0, 10), (10, 20), (20, 30)]


def test_quantize_keeps_open_end(frame):
    f = frame([(13, INF)], "vs long, ve long").quantize(10, 10)
    assert rows(f, "vs", "ve") == [(10, INF)]


STACK = [(1, 5, 10), (1, 3, 20), (2, 3, 30), (2, 4, 40), (3, 4, 50)]


def test_top_k(frame):
    out = frame(STACK, "vs long, ve long, v int").top_k_lists(3, "v")
    out = out.select(v=F.transform("top", lambda x: x["payload"]["v"]))
    assert rows(out, "vs", "ve", "v") == [
        (1, 2, [20, 10]), (2, 3, [40, 30, 20]), (3, 4, [50, 40, 10]), (4, 5, [10]),
    ]


def test_top_k_keeps_ties_and_leaves_gaps(frame):
    out = frame([(0, 9, 5), (0, 9, 5), (0, 9, 3), (0, 9, 1)], "vs long, ve long, v int").top_k(3, "v")
    assert rows(out, "rank", "v") == [(1, 5), (1, 5), (3, 3)]


@pytest.mark.parametrize("p, down", [(0.6, False), (0.4, True)])
def test_percentile_discrete(frame, p, down):
    out = frame(STACK, "vs long, ve long, v int").aggregate(v=A.percentile_discrete("v", p, down))
    assert rows(out, "vs", "ve", "v") == [(1, 2, 20), (2, 3, 30), (3, 4, 40), (4, 5, 10)]


LEFT = [(100, 101, "A", "A3"), (100, 110, "A", "A1"), (101, 105, "A", "A2"), (109, 112, "A", "A4"), (102, 112, "B", "B1")]
RIGHT = [(101, 103, "A"), (106, 108, "A"), (106, 109, "A"), (100, 110, "C")]
FRAGMENTS = [
    (100, 101, "A1"), (100, 101, "A3"), (102, 112, "B1"), (103, 105, "A2"), (103, 106, "A1"), (109, 110, "A1"),
    (109, 112, "A4"),
]


def sides(frame):
    return frame(LEFT, "vs long, ve long, k string, p string"), frame(RIGHT, "vs long, ve long, k string")


def test_anti_join_fragments(frame):
    left, right = sides(frame)
    assert rows(left.where_not_exists(right, "k"), "vs", "ve", "p") == FRAGMENTS


def test_left_outer_join_fills_fragments_with_nulls(frame):
    left, right = sides(frame)
    out = left.left_outer_join(right.select("k", hit=F.lit(1)), "k")
    alone = out.where(F.col("hit").isNull())
    assert rows(alone, "vs", "ve", "p") == FRAGMENTS
    assert rows(out.where("hit = 1"), "vs", "ve", "p") == [
        (101, 103, "A1"), (101, 103, "A2"), (106, 108, "A1"), (106, 109, "A1"),
    ]


def test_anti_join_with_empty_right(frame):
    left, right = sides(frame)
    nobody = right.where("k = 'none'")
    assert rows(left.where_not_exists(nobody, on=[]), "p") == rows(left, "p")
    assert rows(left.where_not_exists(nobody, "k"), "p") == rows(left, "p")


def test_clip_is_strict(frame):
    left = frame([(1, 9, "a"), (5, 9, "b"), (6, 9, "c")], "vs long, ve long, p string")
    right = frame([(1, 2), (5, 6)], "vs long, ve long")
    assert rows(left.clip_by(right, on=[]), "vs", "ve", "p") == [(1, 5, "a"), (5, 9, "b"), (6, 9, "c")]


def test_chop(frame):
    f = frame([(100, 109, 1), (100, 110, 2), (100, 111, 3), (100, 150, 4)], "vs long, ve long, p int").chop(0, 10)
    got = rows(f, "p", "vs", "ve")
    assert got == [
        (1, 100, 109), (2, 100, 110), (3, 100, 110), (3, 110, 111),
        *[(4, t, t + 10) for t in range(100, 150, 10)],
    ]


def test_chop_rejects_open_rows(frame):
    with pytest.raises(Exception, match="needs a horizon"):
        frame([(1, INF)], "vs long, ve long").chop(0, 10).df.collect()


def test_stitch_copies(frame):
    given = [(1, 5, "A"), (5, 6, "A"), (2, 3, "A"), (3, 4, "A"), (4, 7, "A")]
    out = frame(given, "vs long, ve long, p string").stitch()
    assert rows(out, "vs", "ve", "p") == [(1, 6, "A"), (2, 7, "A")]


def test_fixed_interval_join(frame):
    left = frame([(t, t + 10, t) for t in (100, 101, 102, 120)], "vs long, ve long, l int", duration=10)
    right = frame([(t, t + 10, t) for t in (105, 106, 107, 125)], "vs long, ve long, r int", duration=10)
    want = [
        (max(a, b), min(a, b) + 10, a, b)
        for a in (100, 101, 102, 120)
        for b in (105, 106, 107, 125)
        if abs(a - b) < 10
    ]
    assert rows(left.join(right), "vs", "ve", "l", "r") == sorted(want)


def test_session_gap_equal_to_timeout_separates(frame):
    f = frame([(t, t + 1, 1) for t in (0, 10, 15, 25)], "vs long, ve long, k int", ["k"]).session(10)
    assert rows(f, "vs", "ve") == [(0, 10), (10, 25), (15, 25), (25, 35)]


def spell(time, event, reg):
    return ((reg[0] if reg else "") + event.sym,)


def symbols(frame):
    word = "A1 A2 B2 A1 B1 B2 B1 C1 B2 A2".split()
    return frame([(i, i + 7, s[0], int(s[1])) for i, s in enumerate(word)], "vs long, ve long, sym string, key int")


def test_pattern_per_key(frame):
    is_a, is_b = F.col("sym") == "A", F.col("sym") == "B"
    pattern = P.sequence(P.single(is_a, spell).repeated(), P.single(is_b, spell).repeated())
    out = symbols(frame).group_by("key").detect(pattern, 7, "word string")
    assert rows(out, "vs", "ve", "word", "key") == [
        (2, 8, "AB", 2), (4, 7, "AAB", 1), (4, 10, "AB", 1), (5, 8, "ABB", 2), (6, 7, "AABB", 1), (6, 10, "ABB", 1),
    ]


def test_simultaneous_events_cancel(frame):
    f = frame([(0, 1, "A"), (1, 2, "B"), (1, 2, "B"), (2, 3, "B"), (3, 4, "A"), (4, 5, "B")], "vs long, ve long, sym string")
    pattern = P.sequence(P.single(F.col("sym") == "A", spell), P.single(F.col("sym") == "B", spell))
    assert rows(f.detect(pattern, 10, "word string"), "vs", "ve") == [(4, 13)]
    native = f.detect_sequence([F.col("sym") == "A", F.col("sym") == "B"], 10, lambda e: {"w": e[0]("sym")})
    assert rows(native, "vs", "ve") == [(4, 13)]


def test_unpivot_skips_nulls(frame):
    f = frame([(0, 1, "a", 5, None, 9), (0, 1, "b", None, 11, None)], "vs long, ve long, key1 string, i1 int, i2 int, o int")
    out = f.unpivot(["key1"], ["i1", "i2", "o"])
    assert rows(out, "key1", "attribute", "value") == [("a", "i1", 5), ("a", "o", 9), ("b", "i2", 11)]


def test_changelog_round_trip(frame):
    f = frame([(1, 5, "x"), (1, 7, "x"), (2, INF, "x"), (3, 4, "y")], "vs long, ve long, p string")
    back = ingress.from_changelog(f.to_changelog().drop("kind"))
    assert rows(back, "vs", "ve", "p") == rows(f, "vs", "ve", "p")


def test_empty_lifetime_fails(spark):
    df = spark.createDataFrame([(5, 5)], "a long, b long")
    with pytest.raises(Exception, match="empty lifetime"):
        ingress.from_intervals(df, "a", "b").df.collect()


def test_late_row_fails_strict_policy(frame):
    f = frame([(1, 9, 1), (5, 9, 2), (3, 9, 3)], "vs long, ve long, arrival long")
    policy = ingress.Disorder(f.df, "arrival")
    with pytest.raises(Exception, match="late row"):
        policy.strict().df.collect()
    assert rows(policy.drop(), "vs") == [(1,), (5,)]
    assert rows(policy.adjust(), "vs") == [(1,), (5,), (5,)]


def test_single_or_default_rejects_two(frame):
    with pytest.raises(Exception, match="more than one"):
        frame([(0, 5, 1), (2, 7, 2)], "vs long, ve long, v int").aggregate(v=A.single_or_default("v")).df.collect()


def test_argument_checks(frame):
    f = frame([(0, 5, 1)], "vs long, ve long, v int")
    with pytest.raises(ValueError):
        f.progressive_quantize(10, 10, 3)
    with pytest.raises(ValueError):
        f.followed_by_immediate(F.lit(True), F.lit(True), 1, lambda l, r: {})


SPANS = "vs long, ve long, v double"


def test_an_infinity_passes(frame):
    out = frame([(0, 10, float("inf")), (5, 30, 1.0)], SPANS).aggregate(s=A.sum_("v"), m=A.average("v"), q=A.sum_squares("v"))
    inf = float("inf")
    assert rows(out, "vs", "ve", "s", "m", "q") == [(0, 5, inf, inf, inf), (5, 10, inf, inf, inf), (10, 30, 1.0, 1.0, 1.0)]


def test_a_large_number_passes(frame):
    out = frame([(0, 10, 1e17), (5, 30, 1.0)], SPANS).aggregate(s=A.sum_("v"))
    assert rows(out, "vs", "s") == [(0, 1e17), (5, 1e17 + 1.0), (10, 1.0)]


@pytest.mark.parametrize("size", [1e-5, 1.0, 1e16])
@pytest.mark.parametrize("tumbled", [False, True])
def test_spreads_of_any_size(frame, size, tumbled):
    given = frame([(1, 2, size), (1, 2, 3 * size)], SPANS)
    f = given.tumbling(10) if tumbled else given
    out = f.aggregate(sd=A.stddev("v"), var=A.variance("v"), psd=A.population_stddev("v"), pv=A.population_variance("v"))
    ((sd, var, psd, pv),) = rows(out, "sd", "var", "psd", "pv")
    assert (sd, var, psd, pv) == pytest.approx((2**0.5 * size, 2 * size**2, size, size**2), rel=1e-9)


def test_spread_of_few_values(frame):
    f = frame([(0, 9, 5.0), (3, 6, None), (4, 5, 7.0)], SPANS)
    out = f.aggregate(sd=A.stddev("v"), psd=A.population_stddev("v"))
    assert rows(out, "vs", "sd", "psd")[2] == (4, pytest.approx(2**0.5), 1.0)
    assert [(r[0], r[1] is None, r[2]) for r in rows(out, "vs", "sd", "psd") if r[0] != 4] == [(0, True, 0.0), (3, True, 0.0), (5, True, 0.0), (6, True, 0.0)]


def test_exact_spread_of_integers(frame):
    f = frame([(0, 9, 2**40), (0, 9, 2**40 + 2)], "vs long, ve long, v long")
    assert rows(f.aggregate(var=A.population_variance("v")), "var") == [(1.0,)]


def test_single_or_default_counts_rows(frame):
    f = frame([(0, 9, 7.0), (3, 6, None)], SPANS)
    with pytest.raises(Exception, match="more than one active row"):
        f.aggregate(x=A.single_or_default("v")).df.collect()
    assert rows(f.aggregate(x=A.skip_nulls(A.single_or_default("v"), "v")), "x") == [(7.0,)] * 3


def test_a_lone_end_edge_fails(spark):
    edges = spark.createDataFrame([(20, 5)], "sync long, other long")
    with pytest.raises(Exception, match="without a start"):
        ingress.from_changelog(edges).df.collect()
    more = spark.createDataFrame([(5, INF), (20, 5), (21, 5)], "sync long, other long")
    with pytest.raises(Exception, match="without a start"):
        ingress.from_changelog(more).df.collect()


@pytest.mark.parametrize("kind,values", [("string", ["b", None, "a"]), ("int", [2, None, 1]), ("double", [0.2, None, 0.1])])
def test_sequence_of_any_ordered_type(spark, kind, values):
    out = ingress.from_sequence(spark.createDataFrame([(v,) for v in values], f"o {kind}"), "o")
    assert [(r.vs, r.o) for r in out.df.orderBy("vs").collect()] == [(0, values[2]), (1, values[0]), (2, None)]


def test_arrays_with_text_ties(frame):
    f = frame([(1, 2, "b"), (1, 2, "a"), (1, 2, "c"), (0, 1, "z")], "vs long, ve long, t string")
    out = f.to_arrays(3, tie="t").orderBy("chunk").collect()
    assert [[x["t"] for x in r["items"]] for r in out] == [["z", "a", "b"], ["c"]]


def test_running_extremes_without_end(frame):
    f = frame([(1, INF, 5.0), (1, INF, 4.0), (3, INF, 9.0), (7, INF, 1.0)], SPANS).declare(open_ended=True)
    out = f.aggregate(lo=A.min_("v"), hi=A.max_("v"), s=A.sum_("v"), p=A.product("v"))
    assert rows(out, "vs", "ve", "lo", "hi", "s", "p") == [
        (1, 3, 4.0, 5.0, 9.0, 20.0), (3, 7, 4.0, 9.0, 18.0, 180.0), (7, INF, 1.0, 9.0, 19.0, 180.0),
    ]
