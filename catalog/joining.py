"""Temporal joins."""

from pyspark.sql import functions as F

from tidespan.sources import ingress

from .base import DAY, HOUR, INTERVALS, ITEMS, OPENED, ORDERS, POINTS, query

INF = 3155378975999999999
OVER = "a.vs < b.ve AND b.vs < a.ve"
LIFE = "greatest(a.vs, b.vs) AS vs, least(a.ve, b.ve) AS ve"


def kind(t, name, prefix, frame=None):
    """Events of one type, payload columns prefixed."""
    f = (frame or t.intervals)().where(F.col("event_type") == name)
    return f.select("user_id", **{f"{prefix}_id": "event_id", f"{prefix}_cents": "cents"})


def kind_sql(name, prefix, source=INTERVALS):
    return (
        f"(SELECT user_id, event_id AS {prefix}_id, cents AS {prefix}_cents, vs, ve FROM ({source}) "
        f"WHERE event_type = '{name}')"
    )


@query(
    "inner_join",
    f"""SELECT a.user_id, v_id, v_cents, p_id, p_cents, {LIFE}
FROM {kind_sql('view', 'v')} a JOIN {kind_sql('purchase', 'p')} b ON a.user_id = b.user_id AND {OVER}""",
)
def inner_join(t):
    return kind(t, "view", "v").join(kind(t, "purchase", "p"), "user_id")


@query(
    "inner_join_self",
    f"""SELECT a.user_id, a.event_id, b.event_id AS event_id_r, {LIFE}
FROM ({INTERVALS}) a JOIN ({INTERVALS}) b ON a.user_id = b.user_id AND {OVER}""",
)
def inner_join_self(t):
    return t.intervals("event_id", "user_id").join(t.intervals("event_id", "user_id"), "user_id")


@query(
    "join_two_names",
    f"""SELECT a.user_id, c_custkey, event_id, {LIFE}
FROM ({INTERVALS}) a JOIN (SELECT c_custkey, c_nationkey * {DAY} + 1704067200000000 AS vs,
  c_nationkey * {DAY} + 1704067200000000 + {10 * DAY} AS ve FROM customer) b
ON a.user_id = b.c_custkey AND {OVER}""",
)
def join_two_names(t):
    """Key columns with different names, lifetimes of very different length."""
    start = F.col("c_nationkey").cast("bigint") * DAY + 1704067200000000
    c = ingress.from_intervals(t.read("customer"), start, start + 10 * DAY, check=False).select("c_custkey")
    return t.intervals("event_id", "user_id").join(c, [("user_id", "c_custkey")])


@query(
    "broadcast_join",
    f"""SELECT a.user_id, event_id, n_name, a.vs, a.ve
FROM ({INTERVALS}) a JOIN nation ON n_nationkey = user_id % 25""",
)
def broadcast_join(t):
    """A small side, counted before it is broadcast."""
    n = ingress.from_starts(t.read("nation"), F.lit(0).cast("bigint")).select("n_name", k=F.col("n_nationkey").cast("bigint"))
    e = t.intervals("event_id", "user_id").select("event_id", "user_id", k=F.col("user_id") % 25)
    return e.join(n, "k", small="right").select("user_id", "event_id", "n_name")


@query(
    "cross_join",
    f"""SELECT v_id, p_id, {LIFE} FROM {kind_sql('view', 'v')} a JOIN {kind_sql('purchase', 'p')} b ON {OVER}""",
)
def cross_join(t):
    """Overlap alone, no key."""
    return kind(t, "view", "v").select("v_id").join(kind(t, "purchase", "p").select("p_id"))


@query(
    "cross_join_in_group",
    f"""SELECT a.user_id, v_id, p_id, {LIFE}
FROM {kind_sql('view', 'v')} a JOIN {kind_sql('purchase', 'p')} b ON a.user_id = b.user_id AND {OVER}""",
)
def cross_join_in_group(t):
    """The same within a group: group keys are the join keys."""
    v = kind(t, "view", "v").select("user_id", "v_id").group_by("user_id")
    p = kind(t, "purchase", "p").select("user_id", "p_id").group_by("user_id")
    return v.join(p)


START_EDGE = f"""SELECT o_orderkey, o_custkey, o_orderstatus, a.price, l_linenumber, l_partkey, l_returnflag, b.price AS price_r,
  greatest(a.vs, b.vs) AS vs, {INF} AS ve
FROM ({ORDERS}) a JOIN ({ITEMS}) b ON a.o_orderkey = b.l_orderkey"""


@query("start_edge_join", f"SELECT *, o_orderkey AS l_orderkey FROM ({START_EDGE})")
def start_edge_join(t):
    """Both sides open-ended: a plain equality join."""
    return t.orders().join(t.items(), [("o_orderkey", "l_orderkey")])


@query("sorted_key_join", f"SELECT *, o_orderkey AS l_orderkey FROM ({START_EDGE})")
def sorted_key_join(t):
    """The same as a merge join of key-sorted inputs."""
    return t.orders().join(t.items(), [("o_orderkey", "l_orderkey")], hint="merge")


@query(
    "fixed_interval_join",
    f"""SELECT a.user_id, v_id, p_id, greatest(a.vs, b.vs) AS vs, least(a.vs, b.vs) + {HOUR} AS ve
FROM {kind_sql('view', 'v', POINTS)} a JOIN {kind_sql('purchase', 'p', POINTS)} b
ON a.user_id = b.user_id AND abs(a.vs - b.vs) < {HOUR}""",
)
def fixed_interval_join(t):
    """Constant durations on both sides: starts less than the duration apart."""
    v = kind(t, "view", "v", t.points).select("user_id", "v_id").set_duration(HOUR)
    p = kind(t, "purchase", "p", t.points).select("user_id", "p_id").set_duration(HOUR)
    return v.join(p, "user_id")


@query(
    "join_with_condition",
    f"""SELECT a.user_id, v_id, v_cents, p_id, p_cents, {LIFE}
FROM {kind_sql('view', 'v')} a JOIN {kind_sql('purchase', 'p')} b ON a.user_id = b.user_id AND {OVER} AND p_cents > v_cents""",
)
def join_with_condition(t):
    return kind(t, "view", "v").join(
        kind(t, "purchase", "p"), "user_id", residual=lambda l, r: r("p_cents") > l("v_cents")
    )


@query(
    "semi_join",
    f"""SELECT a.user_id, v_id, v_cents, {LIFE}
FROM {kind_sql('view', 'v')} a JOIN {kind_sql('purchase', 'p')} b ON a.user_id = b.user_id AND {OVER}""",
)
def semi_join(t):
    """Attributes of the left side during matches."""
    return kind(t, "view", "v").semi_join(kind(t, "purchase", "p"), "user_id")


def gaps_sql(right, keys):
    """Complement of the union of the lifetimes of each key."""
    comma = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return f"""r AS ({right}),
m AS (SELECT {comma}vs, ve, max(ve) OVER ({part} ORDER BY vs, ve ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r),
gaps AS (SELECT {comma}coalesce(before, 0) AS vs, vs AS ve FROM m WHERE before IS NULL OR vs > before
  UNION ALL SELECT {comma}max(ve), {INF} FROM r {'GROUP BY ' + ', '.join(keys) if keys else ''} HAVING max(ve) < {INF})"""


def anti_sql(left, right, keys, cols):
    on = " AND ".join([f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys] + [OVER])
    none = " AND ".join([f"a.{k} IS NOT DISTINCT FROM r.{k}" for k in keys] or ["true"])
    names = ", ".join(f"a.{c}" for c in cols)
    return f"""WITH l AS ({left}), {gaps_sql(right, keys)}
SELECT {names}, {LIFE} FROM l a JOIN gaps b ON {on}
UNION ALL SELECT {names}, a.vs, a.ve FROM l a WHERE NOT EXISTS (SELECT 1 FROM r WHERE {none})"""


VIEWS, BUYS = kind_sql("view", "v")[1:-1], kind_sql("purchase", "p")[1:-1]


@query("anti_join", anti_sql(VIEWS, BUYS, ["user_id"], ["user_id", "v_id", "v_cents"]))
def anti_join(t):
    """Views minus the times with a purchase of the same user."""
    return kind(t, "view", "v").where_not_exists(kind(t, "purchase", "p"), "user_id")


@query(
    "anti_join_missing_keys",
    anti_sql(INTERVALS, f"SELECT * FROM ({INTERVALS}) WHERE cents > 20000", ["user_id"], ["user_id", "event_id"]),
)
def anti_join_missing_keys(t):
    """Few right rows: most users pass unchanged."""
    rare = t.intervals("user_id", "cents").where("cents > 20000")
    return t.intervals("user_id", "event_id").where_not_exists(rare, "user_id")


@query(
    "anti_join_unkeyed",
    anti_sql(
        INTERVALS,
        f"SELECT vs, vs + {HOUR // 4} AS ve FROM ({POINTS}) WHERE event_type = 'error'",
        [],
        ["event_id", "user_id"],
    ),
)
def anti_join_unkeyed(t):
    """Lifetimes minus the quarter hours after any error."""
    errors = t.points("event_type").where("event_type = 'error'").set_duration(HOUR // 4)
    return t.intervals("event_id", "user_id").where_not_exists(errors, on=[])


HITS = f"""SELECT a.user_id, a.v_id, a.v_cents, {LIFE}
FROM ({VIEWS}) a JOIN ({BUYS}) b ON a.user_id = b.user_id AND {OVER} AND b.p_cents > a.v_cents"""
THETA = anti_sql(VIEWS, HITS, ["user_id", "v_id", "v_cents"], ["user_id", "v_id", "v_cents"])


@query("anti_join_condition", THETA)
def anti_join_condition(t):
    """Views minus the times with a dearer purchase of the same user."""
    return kind(t, "view", "v").where_not_exists(
        kind(t, "purchase", "p"), "user_id", residual=lambda l, r: r("p_cents") > l("v_cents")
    )


MATCHED = f"""SELECT a.user_id, v_id, v_cents, p_id, p_cents, {LIFE}
FROM ({VIEWS}) a JOIN ({BUYS}) b ON a.user_id = b.user_id AND {OVER}"""
ANTI = anti_sql(VIEWS, BUYS, ["user_id"], ["user_id", "v_id", "v_cents"])


@query(
    "left_outer_join",
    f"{MATCHED} UNION ALL SELECT user_id, v_id, v_cents, NULL, NULL, vs, ve FROM ({ANTI})",
)
def left_outer_join(t):
    return kind(t, "view", "v").left_outer_join(kind(t, "purchase", "p"), "user_id")


@query(
    "left_outer_join_condition",
    f"{MATCHED} AND p_cents > v_cents UNION ALL SELECT user_id, v_id, v_cents, NULL, NULL, vs, ve FROM ({THETA})",
)
def left_outer_join_condition(t):
    return kind(t, "view", "v").left_outer_join(
        kind(t, "purchase", "p"), "user_id", residual=lambda l, r: r("p_cents") > l("v_cents")
    )


RIGHT_ANTI = anti_sql(BUYS, VIEWS, ["user_id"], ["user_id", "p_id", "p_cents"])


@query(
    "full_outer_join",
    f"""{MATCHED} UNION ALL SELECT user_id, v_id, v_cents, NULL, NULL, vs, ve FROM ({ANTI})
UNION ALL SELECT user_id, NULL, NULL, p_id, p_cents, vs, ve FROM ({RIGHT_ANTI})""",
)
def full_outer_join(t):
    return kind(t, "view", "v").full_outer_join(kind(t, "purchase", "p"), "user_id")


@query(
    "clip_by_stream",
    f"""WITH r AS (SELECT DISTINCT vs FROM ({POINTS}) WHERE event_type = 'error')
SELECT event_id, l.vs, least(l.ve, coalesce(r.vs, {INF})) AS ve
FROM (SELECT *, vs + 1 AS after FROM ({INTERVALS})) l ASOF LEFT JOIN r ON r.vs >= l.after""",
)
def clip_by_stream(t):
    """Lifetimes end at the next error of anyone."""
    errors = t.points("event_type").where("event_type = 'error'")
    return t.intervals("event_id").clip_by(errors, on=[])


@query(
    "clip_by_stream_keyed",
    f"""WITH r AS (SELECT DISTINCT user_id, vs FROM ({POINTS}) WHERE event_type = 'error')
SELECT event_id, l.user_id, l.vs, least(l.ve, coalesce(r.vs, {INF})) AS ve
FROM (SELECT *, vs + 1 AS after FROM ({OPENED})) l ASOF LEFT JOIN r ON r.user_id = l.user_id AND r.vs >= l.after""",
)
def clip_by_stream_keyed(t):
    """Open lifetimes end at the user's next error."""
    errors = t.points("event_type", "user_id").where("event_type = 'error'")
    return t.opened("event_id", "user_id").clip_by(errors, "user_id")


@query(
    "signal",
    f"""SELECT event_id, user_id, vs, coalesce((SELECT min(b.vs) FROM ({OPENED}) b WHERE b.user_id = a.user_id AND b.vs > a.vs), {INF}) AS ve
FROM (SELECT *, vs // {HOUR} AS h FROM ({OPENED})) a""",
)
def signal(t):
    """Each row lives until the user's next one."""
    return t.opened("event_id", "user_id").group_by("user_id").as_signal()


@query(
    "coverage_gaps",
    f"WITH {gaps_sql(f'SELECT user_id, vs, ve FROM ({INTERVALS})', ['user_id'])} SELECT user_id, vs, ve FROM gaps",
)
def coverage_gaps(t):
    """Periods without activity of each user."""
    return t.intervals("user_id").group_by("user_id").coverage_gaps()
