"""Patterns over histories cut into pieces, against one matcher that reads each key's events from first to last."""

import random
from collections import Counter, namedtuple
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tidespan import INF, TemporalFrame
from tidespan.functions import automaton as P
from tidespan.functions.automaton import Matcher
from tidespan.operators import patterns
from tidespan.plans import transitions

Event = namedtuple("Event", "s v")
LETTERS = {}


def note(time, event, reg):
    return (event.v, 1) if reg is None else (reg[0], reg[1] + 1)


def of(letter):
    """A lone event of that letter; any letter for None."""
    cond = F.lit(True) if letter is None else F.col("s") == letter
    LETTERS[id(cond)] = cond, letter
    return P.single(cond, note)


PATTERNS = {
    "sequence": lambda: P.sequence(of("a"), of("b"), of("a")),
    "runs": lambda: P.sequence(of("a").repeated(), of("b").repeated()),
    "anything between": lambda: P.sequence(of("a"), of(None).any_number(), of("c")),
    "one between": lambda: P.sequence(of("a"), of(None), of("a")),
    "ambiguous": lambda: P.sequence(of("a").repeated(), P.one_of(of("a"), of("b")).any_number(), of("c").optional(), of("b")),
}


def events(seed):
    rnd = random.Random(seed)
    n = rnd.choice([40, 90])
    return [(rnd.randrange(n * 2), "hot" if rnd.random() < 0.7 else rnd.choice(["x", None]), rnd.choice("aaabbc"), i) for i in range(n)]


def expected(given, keyed, pattern, limit, overlapping, deterministic):
    automaton, found = pattern.compile(), Counter()
    letters = [LETTERS[id(c)][1] for c in automaton.conditions()]
    for key in {r[1] for r in given} if keyed else [None]:
        matcher = Matcher(automaton.tables(), limit, overlapping, deterministic)
        mine = sorted((r for r in given if not keyed or r[1] == key), key=lambda r: r[0])
        for t, now in groupby(mine, key=lambda r: r[0]):
            instant = [(Event(s, v), [x is None or s == x for x in letters]) for _, _, s, v in now]
            for vs, ve, reg in matcher.at(t, instant):
                found[key, vs, ve, *reg] += 1
    return found


def frame_of(spark, given, keyed):
    df = spark.createDataFrame(given, "vs long, k string, s string, v long").withColumn("ve", F.col("vs") + 1)
    return TemporalFrame(df, "k") if keyed else TemporalFrame(df.drop("k"))


def found_by(out, keyed):
    return Counter((r.k if keyed else None, r.vs, r.ve, r["first"], r.n) for r in out.df.collect())


@pytest.fixture
def sliced(spark):
    spark.conf.set("tidespan.slices", 16)
    yield
    spark.conf.unset("tidespan.slices")


@pytest.mark.parametrize("overlapping", [True, False])
@pytest.mark.parametrize("name", PATTERNS)
def test_unbounded_patterns(spark, sliced, name, overlapping):
    for seed, keyed in ((1, True), (2, False)):
        given, pattern = events(seed), PATTERNS[name]()
        deterministic = seed == 2 and not overlapping
        out = frame_of(spark, given, keyed).detect(pattern, INF, "first long, n long", overlapping=overlapping, deterministic=deterministic)
        assert found_by(out, keyed) == expected(given, keyed, pattern, INF, overlapping, deterministic)


@pytest.mark.parametrize("name", PATTERNS)
def test_bounded_patterns_one_at_a_time(spark, sliced, name):
    given, pattern = events(3), PATTERNS[name]()
    out = frame_of(spark, given, True).detect(pattern, 12, "first long, n long", overlapping=False)
    assert found_by(out, True) == expected(given, True, pattern, 12, False, False)


@pytest.mark.parametrize("limit", [INF, 12])
def test_sequences_in_blocks(spark, sliced, limit, monkeypatch):
    monkeypatch.setattr(patterns, "BLOCK", 4)
    for seed, keyed in ((4, True), (5, False)):
        given = events(seed)
        conds = [F.col("s") == c for c in "aba"]
        out = frame_of(spark, given, keyed).detect_sequence(conds, limit, lambda e: {"first": e[0]("v"), "n": F.lit(3).cast("long")})
        assert found_by(out, keyed) == expected(given, keyed, PATTERNS["sequence"](), limit, True, False)


@pytest.mark.parametrize("limit", [INF, 9])
@pytest.mark.parametrize("steps", [
    [("a", "+")], [("a", "1")], [("a", "+"), ("b", "+")], [("a", "1"), ("b", "+")], [("a", "+"), ("b", "1")],
    [("a", "1"), ("b", "*"), ("c", "1")], [("a", "+"), ("b", "1"), ("a", "+")], [("c", "?"), ("a", "+"), ("b", "?")],
])
def test_runs(spark, sliced, steps, limit):
    often = {"1": lambda p: p, "+": P.Pattern.repeated, "?": P.Pattern.optional, "*": P.Pattern.any_number}
    for seed, keyed in ((6, True), (7, False)):
        given, pattern = events(seed), P.sequence(*[often[q](of(c)) for c, q in steps])
        out = frame_of(spark, given, keyed).detect_runs("s", steps, limit, lambda first, last, n: {"first": first("v"), "n": n})
        assert found_by(out, keyed) == expected(given, keyed, pattern, limit, True, False)


def test_steps_must_differ(spark):
    with pytest.raises(ValueError, match="different kinds"):
        frame_of(spark, events(1), True).detect_runs("s", [("a", "+"), ("b", "?"), ("a", "1")], INF, lambda first, last, n: {"n": n})


@pytest.mark.parametrize("overlapping", [True, False])
def test_one_key_without_pause_is_spread(spark, overlapping):
    """One key, an event at every instant, no bound: as many pieces as slices, none with most of the rows."""
    spark.conf.set("tidespan.slices", 16)
    pattern = P.sequence(of("a").repeated(), of("b").repeated())
    automaton = pattern.compile()
    rnd = random.Random(8)
    given = [(t, "hot", rnd.choice("abc"), t) for t in range(4000)]
    f = frame_of(spark, given, True)
    conds = [F.col("s") == LETTERS[id(c)][1] for c in automaton.conditions()]
    rows = f.df.withColumn("_flags", F.array(*conds))
    out = transitions.pieces(rows, ["k"], f.cuts, automaton.tables(), overlapping, False)
    sizes = [r["count"] for r in out.groupBy("_chunk").count().collect()]
    spark.conf.unset("tidespan.slices")
    assert len(sizes) == 16 and max(sizes) < 2 * 4000 / 16


def test_native_runs_have_no_python_worker(spark):
    import __spark_entry__ as entry

    text = entry.queries()["detect_plus_plus"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in text and "Python" not in text
