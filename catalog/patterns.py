"""Sequence patterns."""

from pyspark.sql import functions as F

from tidespan.functions import automaton as P
from tidespan.functions.time import INF

from .base import DAY, HOUR, HOURLY, INTERVALS, POINTS, query

NEXT = "lead(vs) OVER (PARTITION BY user_id ORDER BY vs)"


def is_type(name):
    return F.col("event_type") == name


def ids(l, r):
    return {"first_id": l("event_id"), "second_id": r("event_id")}


def follow_sql(source, limit):
    """Pairs at consecutive instants of a user."""
    return f"""WITH src AS ({source}),
t AS (SELECT user_id, vs, lead(vs) OVER (PARTITION BY user_id ORDER BY vs) AS nxt FROM (SELECT DISTINCT user_id, vs FROM src))
SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id, b.vs, b.vs + 1 AS ve
FROM src a JOIN t ON t.user_id = a.user_id AND t.vs = a.vs JOIN src b ON b.user_id = a.user_id AND b.vs = t.nxt
WHERE {limit}"""


@query(
    "followed_by_immediate",
    follow_sql(POINTS, f"a.event_type = 'view' AND b.event_type = 'purchase' AND b.vs - a.vs < {DAY}"),
)
def followed_by_immediate(t):
    """A view, then a purchase as the user's very next event, within a day."""
    f = t.points().group_by("user_id")
    return f.followed_by_immediate(is_type("view"), is_type("purchase"), DAY, ids)


@query(
    "followed_by_immediate_ties",
    follow_sql(HOURLY, f"a.event_type = 'view' AND b.event_type = 'purchase' AND b.vs - a.vs < {6 * HOUR}"),
)
def followed_by_immediate_ties(t):
    """Several events share an instant: all pairs of the two instants match."""
    f = t.hourly().group_by("user_id")
    return f.followed_by_immediate(is_type("view"), is_type("purchase"), 6 * HOUR, ids)


@query(
    "followed_by_immediate_own_lifetime",
    follow_sql(INTERVALS, "a.event_type = 'view' AND b.event_type = 'purchase' AND b.vs <= a.ve"),
)
def followed_by_immediate_own_lifetime(t):
    """Negative duration: the rows' own lifetimes are the limit."""
    f = t.intervals().group_by("user_id")
    return f.followed_by_immediate(is_type("view"), is_type("purchase"), -1, ids)


@query(
    "followed_by_immediate_streams",
    f"""WITH a AS (SELECT * FROM ({POINTS}) WHERE event_type = 'signup'),
b AS (SELECT * FROM ({POINTS}) WHERE event_type IN ('purchase', 'error'))
SELECT user_id, first_id, second_id, vs2 AS vs, vs2 + 1 AS ve FROM (
  SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id, b.event_type AS kind, a.vs AS vs1, b.vs AS vs2
  FROM (SELECT *, vs + 1 AS after FROM a) a ASOF JOIN b ON b.user_id = a.user_id AND b.vs >= a.after)
WHERE kind = 'purchase' AND vs2 - vs1 < {2 * DAY}""",
)
def followed_by_immediate_streams(t):
    """A signup, then a purchase before any other event of the second stream."""
    first = t.points().where("event_type = 'signup'").group_by("user_id")
    second = t.points().where("event_type in ('purchase', 'error')").group_by("user_id")
    return first.followed_by_immediate(F.lit(True), is_type("purchase"), 2 * DAY, ids, other=second)


@query("consecutive_pairs", follow_sql(POINTS, "true"))
def consecutive_pairs(t):
    return t.points().group_by("user_id").consecutive_pairs(ids)


@query("consecutive_pairs_ties", follow_sql(HOURLY, "true"))
def consecutive_pairs_ties(t):
    return t.hourly().group_by("user_id").consecutive_pairs(ids)


@query(
    "sessionize",
    f"""WITH a AS (SELECT *, vs + 1 AS after FROM ({POINTS}) WHERE event_type = 'signup'),
b AS (SELECT * FROM ({POINTS}) WHERE event_type = 'purchase')
SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id, b.vs, b.vs + 1 AS ve
FROM a ASOF JOIN b ON b.user_id = a.user_id AND b.vs >= a.after""",
)
def sessionize(t):
    """Sessions from a start marker to the user's next end marker; every open start matches."""
    return t.points().sessionize(is_type("signup"), is_type("purchase"), "user_id", ids)


@query(
    "sessionize_ties",
    f"""WITH src AS ({HOURLY}),
a AS (SELECT * FROM src WHERE event_type = 'signup'), b AS (SELECT * FROM src WHERE event_type = 'purchase'),
n AS (SELECT a.event_id, min(b.vs) AS at FROM a JOIN b ON b.user_id = a.user_id AND b.vs > a.vs GROUP BY 1)
SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id, b.vs, b.vs + 1 AS ve
FROM a JOIN n ON n.event_id = a.event_id JOIN b ON b.user_id = a.user_id AND b.vs = n.at""",
)
def sessionize_ties(t):
    return t.hourly().sessionize(is_type("signup"), is_type("purchase"), "user_id", ids)


# Automata. Registers are tuples (first event id, number of events).

FIRST = "first_id bigint, n bigint"


def note(time, event, reg):
    return (event.event_id, 1) if reg is None else (reg[0], reg[1] + 1)


def of(name):
    return P.single(is_type(name), note)


RANKED = f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY vs) AS rn FROM ({POINTS})"


def steps_sql(types, duration):
    """A fixed sequence of consecutive events."""
    joins = " ".join(
        f"JOIN p e{i} ON e{i}.user_id = e0.user_id AND e{i}.rn = e0.rn + {i} AND e{i}.event_type = '{x}'"
        for i, x in enumerate(types)
        if i
    )
    last = f"e{len(types) - 1}"
    return f"""WITH p AS ({RANKED})
SELECT e0.user_id, e0.event_id AS first_id, {len(types)}::BIGINT AS n, {last}.vs, e0.vs + {duration} AS ve
FROM p e0 {joins} WHERE e0.event_type = '{types[0]}' AND {last}.vs < e0.vs + {duration}"""


STEPS = ["view", "click", "purchase"]


@query("detect_sequence", steps_sql(STEPS, 2 * DAY))
def detect_sequence(t):
    """Three consecutive events, evaluated natively."""
    f = t.points().group_by("user_id")
    return f.detect_sequence(
        [is_type(x) for x in STEPS],
        2 * DAY,
        lambda e: {"first_id": e[0]("event_id"), "n": F.lit(3).cast("bigint")},
    )


@query("detect_concat", steps_sql(STEPS, 2 * DAY))
def detect_concat(t):
    """The same by the automaton."""
    return t.points().group_by("user_id").detect(P.sequence(*map(of, STEPS)), 2 * DAY, FIRST)


@query("detect_unkeyed", steps_sql(STEPS, HOUR).replace("PARTITION BY user_id ", "").replace("e0.user_id, e0.event_id", "e0.event_id").replace(
    "e1.user_id = e0.user_id AND ", "").replace("e2.user_id = e0.user_id AND ", ""))
def detect_unkeyed(t):
    """No key: the history is cut into time slices that reach one match duration ahead."""
    return t.points("event_id", "event_type").detect(P.sequence(*map(of, STEPS)), HOUR, FIRST)


RUNS = f"""WITH p AS ({RANKED}),
g AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS fresh FROM p WINDOW w AS (PARTITION BY user_id ORDER BY rn)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS run FROM g)"""


PLUS_PLUS = RUNS + f""" SELECT a.user_id, a.event_id AS first_id, CAST(b.rn - a.rn + 1 AS BIGINT) AS n, b.vs, a.vs + {3 * DAY} AS ve
FROM r a JOIN r b ON b.user_id = a.user_id AND b.run = a.run + 1
WHERE a.event_type = 'view' AND b.event_type = 'click' AND b.vs < a.vs + {3 * DAY}"""


def outer(first, last, n):
    return {"first_id": first("event_id"), "n": n}


@query("detect_plus_plus", PLUS_PLUS)
def detect_plus_plus(t):
    """view+ click+, evaluated natively: a match at every accepting event, from every start."""
    f = t.points().group_by("user_id")
    return f.detect_runs("event_type", [("view", "+"), ("click", "+")], 3 * DAY, outer)


@query("detect_plus_plus_automaton", PLUS_PLUS)
def detect_plus_plus_automaton(t):
    """The same by the automaton."""
    pattern = P.sequence(of("view").repeated(), of("click").repeated())
    return t.points().group_by("user_id").detect(pattern, 3 * DAY, FIRST)


@query(
    "detect_runs_of_one_kind",
    RUNS
    + f""" SELECT a.user_id, a.event_id AS first_id, CAST(b.rn - a.rn + 1 AS BIGINT) AS n, b.vs, a.vs + {DAY} AS ve
FROM r a JOIN r b ON b.user_id = a.user_id AND b.run = a.run AND b.rn >= a.rn
WHERE a.event_type = 'view' AND b.vs < a.vs + {DAY}""",
)
def detect_runs_of_one_kind(t):
    """view+, natively."""
    return t.points().group_by("user_id").detect_runs("event_type", [("view", "+")], DAY, outer)


@query(
    "detect_runs_between",
    RUNS
    + f""", e AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY rn) AS nth, count(*) OVER (PARTITION BY user_id, run) AS size FROM r),
f AS (SELECT * FROM e WHERE nth = 1)
SELECT a.user_id, a.event_id AS first_id, CAST(c.rn - a.rn + 1 AS BIGINT) AS n, c.vs, a.vs + {3 * DAY} AS ve
FROM e a JOIN f b ON b.user_id = a.user_id AND b.run = a.run + 1 AND a.nth = a.size JOIN f c ON c.user_id = a.user_id AND c.run = a.run + 2
WHERE a.event_type = 'click' AND b.event_type = 'view' AND c.event_type = 'purchase' AND c.vs < a.vs + {3 * DAY}
UNION ALL
SELECT a.user_id, a.event_id, CAST(c.rn - a.rn + 1 AS BIGINT), c.vs, a.vs + {3 * DAY}
FROM e a JOIN f c ON c.user_id = a.user_id AND c.rn = a.rn + 1
WHERE a.event_type = 'click' AND c.event_type = 'purchase' AND c.vs < a.vs + {3 * DAY}""",
)
def detect_runs_between(t):
    """click view* purchase, natively."""
    steps = [("click", "1"), ("view", "*"), ("purchase", "1")]
    return t.points().group_by("user_id").detect_runs("event_type", steps, 3 * DAY, outer)


UNKEYED = f"SELECT *, row_number() OVER (ORDER BY vs) AS rn FROM ({POINTS})"
OPEN_STEPS = " ".join(f"JOIN p e{i} ON e{i}.rn = e0.rn + {i} AND e{i}.event_type = '{x}'" for i, x in enumerate(STEPS) if i)
OPEN_SEQUENCE = f"""WITH p AS ({UNKEYED})
SELECT e0.event_id AS first_id, 3::BIGINT AS n, e2.vs, {INF} AS ve FROM p e0 {OPEN_STEPS} WHERE e0.event_type = '{STEPS[0]}'"""


@query("detect_sequence_unbounded", OPEN_SEQUENCE)
def detect_sequence_unbounded(t):
    """No bound and no key: blocks of instants that read on for two more."""
    return t.points().detect_sequence(
        [is_type(x) for x in STEPS], INF, lambda e: {"first_id": e[0]("event_id"), "n": F.lit(3).cast("bigint")}
    )


@query("detect_unbounded", OPEN_SEQUENCE)
def detect_unbounded(t):
    """The same by the automaton, over time slices whose maps between states are composed."""
    return t.points("event_id", "event_type").detect(P.sequence(*map(of, STEPS)), INF, FIRST)


@query(
    "detect_unbounded_not_overlapping",
    f"""WITH p AS ({UNKEYED}),
g AS (SELECT *, CASE WHEN event_type = 'view' AND lag(event_type) OVER w = 'view' THEN 0 ELSE 1 END AS fresh FROM p WINDOW w AS (ORDER BY rn)),
r AS (SELECT *, sum(fresh) OVER (ORDER BY rn ROWS UNBOUNDED PRECEDING) AS run FROM g),
v AS (SELECT run, min(event_id) AS any_id, arg_min(event_id, rn) AS first_id, count(*) AS views, max(rn) AS last FROM r WHERE event_type = 'view' GROUP BY ALL)
SELECT v.first_id, v.views + 1 AS n, p.vs, {INF} AS ve FROM v JOIN p ON p.rn = v.last + 1 WHERE p.event_type = 'purchase'""",
)
def detect_unbounded_not_overlapping(t):
    """view+ purchase, one instance at a time, without a bound: the history is cut where no instance is under way."""
    pattern = P.sequence(of("view").repeated(), of("purchase"))
    return t.points("event_id", "event_type").detect(pattern, INF, FIRST, overlapping=False)


@query(
    "detect_star",
    f"""WITH p AS ({RANKED}),
x AS (SELECT *, sum(CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY rn) AS others FROM p)
SELECT a.user_id, a.event_id AS first_id, CAST(b.rn - a.rn + 1 AS BIGINT) AS n, b.vs, a.vs + {3 * DAY} AS ve
FROM x a JOIN x b ON b.user_id = a.user_id AND b.rn > a.rn AND b.vs < a.vs + {3 * DAY}
WHERE a.event_type = 'signup' AND b.event_type = 'purchase' AND b.others = a.others + 1""",
)
def detect_star(t):
    """signup view* purchase."""
    pattern = P.sequence(of("signup"), of("view").any_number(), of("purchase"))
    return t.points().group_by("user_id").detect(pattern, 3 * DAY, FIRST)


def union_sql(*parts):
    return " UNION ALL ".join(f"SELECT user_id, first_id, n, vs, ve FROM ({p})" for p in parts)


@query("detect_or", union_sql(steps_sql(["view", "click"], DAY), steps_sql(["error", "error"], DAY)))
def detect_or(t):
    """Either of two sequences."""
    pattern = P.one_of(P.sequence(of("view"), of("click")), P.sequence(of("error"), of("error")))
    return t.points().group_by("user_id").detect(pattern, DAY, FIRST)


@query("detect_optional", union_sql(steps_sql(["view", "purchase"], DAY), steps_sql(["view", "click", "purchase"], DAY)))
def detect_optional(t):
    """view click? purchase."""
    pattern = P.sequence(of("view"), of("click").optional(), of("purchase"))
    return t.points().group_by("user_id").detect(pattern, DAY, FIRST)


@query(
    "detect_prefixes",
    union_sql(
        f"SELECT user_id, event_id AS first_id, 1::BIGINT AS n, vs, vs + {DAY} AS ve FROM ({POINTS}) WHERE event_type = 'view'",
        steps_sql(["view", "click"], DAY),
        steps_sql(["view", "click", "purchase"], DAY),
    ),
)
def detect_prefixes(t):
    """Every prefix of the sequence is a match."""
    return t.points().group_by("user_id").detect(P.sequence_prefixes(*map(of, STEPS)), DAY, FIRST)


@query("detect_epsilon", steps_sql(["view", "click"], DAY))
def detect_epsilon(t):
    """An automaton given by states and arcs, with a free move between the two elements."""
    a = P.Automaton().single(0, 1, is_type("view"), note).epsilon(1, 2).single(2, 3, is_type("click"), note).final(3)
    return t.points().group_by("user_id").detect(a, DAY, FIRST)


@query(
    "detect_register",
    f"""WITH p AS ({RANKED})
SELECT e0.user_id, e0.cents AS low, e2.cents AS high, e2.vs, e0.vs + {3 * DAY} AS ve
FROM p e0 JOIN p e1 ON e1.user_id = e0.user_id AND e1.rn = e0.rn + 1 JOIN p e2 ON e2.user_id = e0.user_id AND e2.rn = e0.rn + 2
WHERE e1.cents > 2 * e0.cents AND e2.cents > 2 * e1.cents AND e2.vs < e0.vs + {3 * DAY}""",
)
def detect_register(t):
    """Conditions on the register: amounts that more than double, twice in a row."""
    start = P.single(lambda time, e, reg: True, lambda time, e, reg: (e.cents, e.cents))
    grow = P.single(lambda time, e, reg: e.cents > 2 * reg[1], lambda time, e, reg: (reg[0], e.cents))
    f = t.points("user_id", "cents").group_by("user_id")
    return f.detect(P.sequence(start, grow, grow), 3 * DAY, "low bigint, high bigint")


@query(
    "detect_simultaneous",
    f"""WITH lone AS (SELECT user_id, vs, count(*) AS c, min(event_id) AS event_id, min(event_type) AS event_type FROM ({HOURLY}) GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY vs) AS rn FROM lone)
SELECT a.user_id, a.event_id AS first_id, 2::BIGINT AS n, b.vs, a.vs + {DAY} AS ve
FROM p a JOIN p b ON b.user_id = a.user_id AND b.rn = a.rn + 1
WHERE a.c = 1 AND b.c = 1 AND a.event_type = 'view' AND b.event_type = 'click' AND b.vs < a.vs + {DAY}""",
)
def detect_simultaneous(t):
    """A second event at the same instant cancels what is under way."""
    return t.hourly().group_by("user_id").detect(P.sequence(of("view"), of("click")), DAY, FIRST)


AT = f"SELECT user_id, vs, list(event_type) AS types, count(*) AS c FROM ({HOURLY}) GROUP BY ALL"
ATN = f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY vs) AS rn FROM ({AT})"


def instants_sql(first, second):
    return f"""WITH p AS ({ATN})
SELECT a.user_id, CAST(a.c + b.c AS BIGINT) AS n, b.vs, a.vs + {DAY} AS ve
FROM p a JOIN p b ON b.user_id = a.user_id AND b.rn = a.rn + 1
WHERE {first} AND {second} AND b.vs < a.vs + {DAY}"""


def tally(time, events, reg):
    return (len(events) + (reg[0] if reg else 0),)


@query("detect_list", instants_sql("a.c >= 2", "b.c >= 2"))
def detect_list(t):
    """Arcs over all events of an instant: two crowded instants in a row."""
    crowd = P.listed(lambda time, events, reg: len(events) >= 2, tally)
    return t.hourly().group_by("user_id").detect(P.sequence(crowd, crowd), DAY, "n bigint")


@query(
    "detect_any_all",
    instants_sql("list_contains(a.types, 'view')", "len(list_filter(b.types, lambda x: x <> 'click')) = 0"),
)
def detect_any_all(t):
    """Some event of an instant is a view, then all events of the next are clicks."""
    some = P.any_of(lambda time, e, reg: e.event_type == "view", tally)
    every = P.all_of(lambda time, e, reg: e.event_type == "click", tally)
    return t.hourly().group_by("user_id").detect(P.sequence(some, every), DAY, "n bigint")


@query(
    "detect_folded",
    f"""WITH s AS (SELECT user_id, vs, CAST(sum(cents) AS BIGINT) AS total FROM ({HOURLY}) GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY vs) AS rn FROM s)
SELECT a.user_id, a.total + b.total AS total, b.vs, a.vs + {DAY} AS ve
FROM p a JOIN p b ON b.user_id = a.user_id AND b.rn = a.rn + 1
WHERE a.total > 5000 AND b.total > 5000 AND b.vs < a.vs + {DAY}""",
)
def detect_folded(t):
    """Fold over the events of each instant: two dear instants in a row."""
    dear = P.folded(
        start=lambda time, reg: 0,
        step=lambda time, e, reg, acc: acc + e.cents,
        accept=lambda time, acc, reg: acc > 5000,
        update=lambda time, acc, reg: (acc + (reg[0] if reg else 0),),
    )
    f = t.hourly("user_id", "cents").group_by("user_id")
    return f.detect(P.sequence(dear, dear), DAY, "total bigint")


@query(
    "detect_not_overlapping",
    f"""WITH RECURSIVE p AS ({RANKED}),
walk AS (
  SELECT user_id, rn, vs, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS done, event_id AS first_id, vs AS began,
    false AS hit, event_id AS hit_id, vs AS hit_began FROM p WHERE rn = 1
  UNION ALL
  SELECT p.user_id, p.rn, p.vs,
    CASE WHEN w.done = 1 AND p.vs < w.began + {DAY} THEN 2 WHEN p.event_type = 'view' THEN 1 ELSE 0 END,
    CASE WHEN w.done = 1 AND p.vs < w.began + {DAY} THEN w.first_id ELSE p.event_id END,
    CASE WHEN w.done = 1 AND p.vs < w.began + {DAY} THEN w.began ELSE p.vs END,
    w.done = 2 AND p.vs < w.began + {DAY} AND p.event_type = 'view', w.first_id, w.began
  FROM walk w JOIN p ON p.user_id = w.user_id AND p.rn = w.rn + 1)
SELECT user_id, hit_id AS first_id, 3::BIGINT AS n, vs, hit_began + {DAY} AS ve FROM walk WHERE hit""",
)
def detect_not_overlapping(t):
    """view, anything, view, one instance at a time: views inside an instance start nothing."""
    pattern = P.sequence(of("view"), P.single(F.lit(True), note), of("view"))
    return t.points().group_by("user_id").detect(pattern, DAY, FIRST, overlapping=False)


@query(
    "detect_runs_not_overlapping",
    f"""WITH p AS ({RANKED}),
g AS (SELECT *, CASE WHEN event_type = 'view' AND lag(event_type) OVER w = 'view' THEN 0 ELSE 1 END AS fresh FROM p WINDOW w AS (PARTITION BY user_id ORDER BY rn)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS run FROM g),
v AS (SELECT user_id, run, min(event_id) AS first_id, min(vs) AS began, count(*) AS views, max(rn) AS last FROM r WHERE event_type = 'view' GROUP BY ALL)
SELECT v.user_id, v.first_id, v.views + 1 AS n, p.vs, v.began + {30 * DAY} AS ve
FROM v JOIN p ON p.user_id = v.user_id AND p.rn = v.last + 1 WHERE p.event_type = 'purchase'""",
)
def detect_runs_not_overlapping(t):
    """view+ purchase without overlap: only the first view of a run starts an instance."""
    pattern = P.sequence(of("view").repeated(), of("purchase"))
    return t.points().group_by("user_id").detect(pattern, 30 * DAY, FIRST, overlapping=False)


@query(
    "detect_deterministic",
    f"""WITH p AS ({RANKED})
SELECT a.user_id, a.event_id AS first_id, CASE WHEN b.cents > 1000 THEN 1 ELSE 2 END::BIGINT AS branch, b.vs, a.vs + {DAY} AS ve
FROM p a JOIN p b ON b.user_id = a.user_id AND b.rn = a.rn + 1
WHERE a.event_type = 'view' AND b.event_type <> 'view' AND b.vs < a.vs + {DAY}""",
)
def detect_deterministic(t):
    """First successful arc wins: a dear event takes the first branch although the second fits as well."""
    a = (
        P.Automaton()
        .single(0, 1, is_type("view"), lambda time, e, reg: (e.event_id, 0))
        .single(1, 2, (F.col("cents") > 1000) & (F.col("event_type") != "view"), lambda time, e, reg: (reg[0], 1))
        .single(1, 3, F.col("event_type") != "view", lambda time, e, reg: (reg[0], 2))
        .final(2)
        .final(3)
    )
    f = t.points().group_by("user_id")
    return f.detect(a, DAY, "first_id bigint, branch bigint", overlapping=False, deterministic=True)


@query(
    "detect_expiry",
    steps_sql(["view", "view"], HOUR),
)
def detect_expiry(t):
    """A short duration: instances die when their time is over."""
    return t.points().group_by("user_id").detect(P.sequence(of("view"), of("view")), HOUR, FIRST)
