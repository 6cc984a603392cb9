"""Compositions: the reference's benchmark and sample queries over the given tables."""

from pyspark.sql import functions as F

from tidespan.functions import aggregates as A
from tidespan.sources import ingress

from .base import DAY, HOUR, INTERVALS, ITEMS, OPENED, ORDERS, POINTS, query, segments_sql

INF = 3155378975999999999

TEN = 10_000_000


def up(x, p):
    return f"(({x} + {p} - 1) // {p} * {p})"


@query(
    "campaign_counts",
    f"""SELECT r_name AS campaign, {up('vs', TEN)} AS vs, {up('vs', TEN)} + {TEN} AS ve, count(*) AS n, max(vs) AS last_update
FROM ({POINTS}) JOIN nation ON n_nationkey = user_id % 25 JOIN region ON r_regionkey = n_regionkey
WHERE event_type = 'view' GROUP BY ALL""",
)
def campaign_counts(t):
    """Views per ten seconds and campaign, with the time of the last one.

    The mapping from ad to campaign is a small dimension, counted before it is broadcast.
    """
    dims = t.read("nation").join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    ads = ingress.from_starts(dims, F.lit(0).cast("bigint"))
    ads = ads.select(ad=F.col("n_nationkey").cast("bigint"), campaign="r_name")
    views = t.points().where("event_type = 'view'").select(ad=F.col("user_id") % 25, at=F.col("vs"))
    joined = views.tumbling(TEN).join(ads, "ad", small="right").declare(duration=TEN, hop=TEN)
    return joined.group_aggregate("campaign", n=A.count(), last_update=A.max_("at"))


@query(
    "toll_tumbling_count",
    f"SELECT {up('vs', 3 * HOUR)} AS vs, {up('vs', 3 * HOUR)} + {3 * HOUR} AS ve, count(*) AS n FROM ({POINTS}) GROUP BY ALL",
)
def toll_tumbling_count(t):
    return t.points("event_id").tumbling(3 * HOUR).count()


HOP3 = f"SELECT *EXCLUDE (vs, ve), {up('vs', HOUR)} AS vs, {up('vs', HOUR)} + {3 * HOUR} AS ve FROM ({POINTS})"


@query(
    "toll_hopping_count",
    f"SELECT n, vs, vs + 1 AS ve FROM ({segments_sql(HOP3, '', 'count(*) AS n')})",
)
def toll_hopping_count(t):
    """The count as of the last reported result, as a point."""
    return t.points("event_id").hopping(3 * HOUR, HOUR).count().set_duration(1)


@query("toll_hopping_per_group", segments_sql(HOP3, "event_type", "CAST(sum(cents) AS BIGINT) AS total, count(*) AS n"))
def toll_hopping_per_group(t):
    """Sum and count per group, each an aggregate of its own, joined in time."""

    def sub(g):
        h = g.hopping(3 * HOUR, HOUR)
        return h.multicast(lambda s: s.aggregate(total=A.sum_("cents")).join(s.count()))

    return t.points().group_apply("event_type", sub)


LONGER = f"SELECT *EXCLUDE (ve), ve + {HOUR} AS ve FROM ({INTERVALS})"


def sliding(t):
    return t.intervals().set_duration(F.col("ve") - F.col("vs") + HOUR)


@query("toll_sliding_per_group", segments_sql(LONGER, "user_id", "CAST(sum(cents) AS BIGINT) AS total, count(*) AS n"))
def toll_sliding_per_group(t):
    return sliding(t).group_aggregate("user_id", total=A.sum_("cents"), n=A.count())


@query(
    "toll_moving_average",
    f"""SELECT user_id, vs, vs + 1 AS ve, round(total / n, 6) AS mean
FROM ({segments_sql(LONGER, "user_id", "CAST(sum(cents) AS BIGINT) AS total, count(*) AS n")})""",
)
def toll_moving_average(t):
    f = sliding(t).group_aggregate("user_id", total=A.sum_("cents"), n=A.count()).set_duration(1)
    return f.select("user_id", mean=F.round(F.col("total") / F.col("n"), 6))


COUNTS = segments_sql(LONGER, "event_type", "count(*) AS n")


@query(
    "toll_inner_join",
    f"""SELECT a.n, greatest(a.vs, b.vs) AS vs, least(a.ve, b.ve) AS ve
FROM ({COUNTS}) a JOIN ({COUNTS}) b ON a.n = b.n AND a.vs < b.ve AND b.vs < a.ve
WHERE a.event_type = 'view' AND b.event_type = 'click'""",
)
def toll_inner_join(t):
    """Whenever two groups have the same count."""
    counts = sliding(t).group_aggregate("event_type", n=A.count())
    first = counts.where("event_type = 'view'").select("n")
    return first.join(counts.where("event_type = 'click'").select("n"), "n")


@query(
    "toll_cross_join",
    f"""SELECT a.n AS views, b.n AS clicks, greatest(a.vs, b.vs) AS vs, least(a.ve, b.ve) AS ve
FROM ({COUNTS}) a JOIN ({COUNTS}) b ON a.vs < b.ve AND b.vs < a.ve
WHERE a.event_type = 'view' AND b.event_type = 'click'""",
)
def toll_cross_join(t):
    counts = sliding(t).group_aggregate("event_type", n=A.count())
    first = counts.where("event_type = 'view'").select(views="n")
    return first.join(counts.where("event_type = 'click'").select(clicks="n"))


@query(
    "toll_anti_join",
    f"SELECT event_id, event_type, vs, ve FROM ({POINTS}) a WHERE NOT EXISTS (SELECT 1 FROM ({POINTS}) b WHERE b.vs = a.vs AND b.cents >= 500)",
)
def toll_anti_join(t):
    """Readings without a valid observation at the same instant."""
    f = t.points().set_duration(1)
    return f.select("event_id", "event_type").where_not_exists(f.where("cents >= 500"), on=[])


@query(
    "toll_outer_join",
    f"""WITH l AS (SELECT event_id, event_type, vs, ve FROM ({INTERVALS})), r AS (SELECT event_id, cents, vs, ve FROM ({INTERVALS}) WHERE event_type <> 'view')
SELECT l.event_id, event_type, cents, l.vs, l.ve FROM l LEFT JOIN r ON l.event_id = r.event_id""",
)
def toll_outer_join(t):
    left = t.intervals("event_id", "event_type")
    right = t.intervals().where("event_type <> 'view'").select("event_id", "cents")
    return left.left_outer_join(right, "event_id")


@query(
    "toll_user_function",
    f"SELECT event_id, event_type, cents, vs, ve FROM ({POINTS}) WHERE event_type = 'error' OR cents % 97 = 3",
)
def toll_user_function(t):
    """A user predicate in Python, evaluated batch by batch."""
    import pandas as pd

    @F.pandas_udf("boolean")
    def suspicious(cents: pd.Series) -> pd.Series:
        return cents % 97 == 3

    f = t.points().where((F.col("event_type") == "error") | suspicious("cents"))
    return f.select("event_id", "event_type", "cents")


@query(
    "time_slices",
    f"""WITH src AS ({OPENED}),
sig AS (SELECT *, lead(vs) OVER (PARTITION BY user_id ORDER BY vs) AS nxt FROM src),
sl AS (SELECT user_id, event_type, nxt - vs AS slice, nxt AS stop FROM sig WHERE nxt IS NOT NULL),
h AS (SELECT event_type, {up('stop', DAY)} AS vs, {up('stop', DAY)} + {DAY} AS ve, CAST(sum(slice) AS BIGINT) AS used FROM sl GROUP BY ALL)
SELECT vs - {DAY} AS period_start, vs AS period_end, event_type, used FROM h
WHERE used = (SELECT max(used) FROM h h2 WHERE h2.vs = h.vs)""",
)
def time_slices(t):
    """How long each activity lasted until the user's next one, and which used most time each day."""
    switches = t.opened("event_id", "user_id", "event_type").group_by("user_id")
    named = switches.select("event_type", tick=F.col("vs"))
    points = named.set_duration(1)
    slices = named.as_signal().shift(1).join(points.select(next_tick="tick"))
    used = slices.select("event_type", slice=F.col("next_tick") - F.col("tick")).ungroup()
    daily = used.group_apply("event_type", lambda g: g.hopping(DAY, DAY).aggregate(used=A.sum_("slice")))
    best = daily.top_k(1, "used")
    return best.to_rows(
        period_start=F.col("vs") - DAY, period_end="vs", event_type="event_type", used="used"
    )


@query(
    "time_slices_chopped",
    f"""WITH src AS (SELECT * FROM ({OPENED})),
sig AS (SELECT user_id, event_id, vs, least(coalesce(lead(vs) OVER (PARTITION BY user_id ORDER BY vs), {INF}), {1706659200000000}) AS ve FROM src),
g AS (SELECT *, unnest(range(vs // {DAY} * {DAY}, ve, {DAY})) AS g FROM sig WHERE vs < {1706659200000000})
SELECT user_id, event_id, greatest(vs, g) AS tick, greatest(vs, g) AS vs, greatest(vs, g) + 1 AS ve FROM g""",
)
def time_slices_chopped(t):
    """The signal cut at day boundaries, each piece a point that remembers its start."""
    f = t.opened("event_id", "user_id").group_by("user_id").as_signal()
    return f.chop(0, DAY, horizon=1706659200000000).select("event_id", tick=F.col("vs")).set_duration(1)


RULED = f"""SELECT rule, event_id, cents, vs - vs % (size * {HOUR}) AS vs, vs - vs % (size * {HOUR}) + size * {HOUR} AS ve FROM (
  SELECT *, unnest(CASE WHEN event_type = 'view' THEN ['A', 'B'] WHEN event_type = 'purchase' THEN ['B', 'C'] WHEN event_type = 'error' THEN ['C'] ELSE [] END) AS rule FROM ({POINTS}))
JOIN (VALUES ('A', 1), ('B', 6), ('C', 24)) r(name, size) ON name = rule"""


def ruled(t):
    """Events fan out to rules, and every rule has windows of its own."""
    rules = (
        F.when(F.col("event_type") == "view", F.array(F.lit("A"), F.lit("B")))
        .when(F.col("event_type") == "purchase", F.array(F.lit("B"), F.lit("C")))
        .when(F.col("event_type") == "error", F.array(F.lit("C")))
        .otherwise(F.array().cast("array<string>"))
    )
    size = F.when(F.col("rule") == "A", HOUR).when(F.col("rule") == "B", 6 * HOUR).otherwise(24 * HOUR)
    f = t.points().flat_map(rules, "rule", keep=["event_id", "cents"]).partition("rule")
    return f.set_lifetime(F.col("vs") - F.col("vs") % size, size.cast("bigint"))


@query(
    "rules_engine_user_aggregate",
    f"""SELECT rule, measure, amount, vs, ve FROM (
  SELECT rule, vs, ve, unnest(['gap', 'spread']) AS measure,
    unnest([coalesce(list_max([s[i + 1] - s[i] for i in range(1, len(s))]), 0), s[len(s)] - s[1]]) AS amount FROM (
    {segments_sql(RULED, 'rule', 'list_sort(list(cents)) AS s')}))""",
)
def rules_engine_user_aggregate(t):
    """The rules' windows under an aggregate of the user's: the widest gap between neighbours of the ordered values."""
    long = lambda v: v.cast("bigint")
    start = F.struct(long(F.lit(None)).alias("first"), long(F.lit(None)).alias("last"), long(F.lit(0)).alias("gap"))

    def step(state, v):
        gap = F.greatest(state["gap"], v - F.coalesce(state["last"], v))
        return F.struct(F.coalesce(state["first"], v).alias("first"), v.alias("last"), gap.alias("gap"))

    both = lambda s: F.struct(s["gap"].alias("gap"), (s["last"] - s["first"]).alias("spread"))
    out = ruled(t).aggregate(u=A.user_fold("cents", start, step, both))
    measures = [F.struct(F.lit(n).alias("measure"), F.col("u")[n].alias("amount")) for n in ("gap", "spread")]
    return out.flat_map(F.array(*measures), "m").select(measure="m.measure", amount="m.amount")


@query(
    "rules_engine",
    f"""SELECT rule, measure, amount, vs, ve FROM (
  SELECT rule, vs, ve, unnest(['count', 'max', 'sum']) AS measure, unnest([n, high, total]) AS amount FROM (
    {segments_sql(RULED, 'rule', 'count(*) AS n, max(cents) AS high, CAST(sum(cents) AS BIGINT) AS total')}))""",
)
def rules_engine(t):
    """Events fan out to rules, every rule has its own window, and its aggregate fans out to results."""
    out = ruled(t).aggregate(n=A.count(), high=A.max_("cents"), total=A.sum_("cents"))
    measures = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), F.col(c).alias("amount"))
            for name, c in (("count", "n"), ("max", "high"), ("sum", "total"))
        ]
    )
    return out.flat_map(measures, "m").select(measure="m.measure", amount="m.amount")


@query(
    "equi_join_throughput",
    f"""SELECT o_custkey, count(*) AS n, CAST(sum(b.price) AS BIGINT) AS total, max(greatest(a.vs, b.vs)) AS last_start
FROM ({ORDERS}) a JOIN ({ITEMS}) b ON a.o_orderkey = b.l_orderkey GROUP BY ALL""",
)
def equi_join_throughput(t):
    """Open-ended orders joined to open-ended line items, summed up per customer."""
    orders = t.orders().select("o_orderkey", "o_custkey")
    joined = orders.join(t.items().select("l_orderkey", "price"), [("o_orderkey", "l_orderkey")])
    return joined.df.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum("price").alias("total"), F.max("vs").alias("last_start")
    )


def shipped(t):
    """Line items as points at their ship date, in tumbling weeks."""
    return t.items().set_duration(1).tumbling(7 * DAY)


WEEKS = f"SELECT *EXCLUDE (vs, ve), {up('vs', 7 * DAY)} AS vs, {up('vs', 7 * DAY)} + {7 * DAY} AS ve FROM ({ITEMS})"


def weekly(out, extra=""):
    return f"SELECT {extra}vs, ve, {out} FROM ({WEEKS}) GROUP BY ALL"


@query("perf_where", f"SELECT l_orderkey, l_linenumber, price, vs, ve FROM ({WEEKS}) WHERE l_orderkey % 2 = 0")
def perf_where(t):
    return shipped(t).where("l_orderkey % 2 = 0").select("l_orderkey", "l_linenumber", "price")


@query("perf_select", f"SELECT l_orderkey, l_linenumber, price + 1 AS price1, vs, ve FROM ({WEEKS})")
def perf_select(t):
    return shipped(t).select("l_orderkey", "l_linenumber", price1=F.col("price") + 1)


@query("perf_count", weekly("count(*) AS n"))
def perf_count(t):
    return shipped(t).count()


@query("perf_sum", weekly("CAST(sum(price) AS BIGINT) AS total"))
def perf_sum(t):
    return shipped(t).aggregate(total=A.sum_("price"))


@query("perf_average", weekly("round(CAST(sum(price) AS BIGINT) / count(*), 4) AS mean"))
def perf_average(t):
    return shipped(t).aggregate(mean=A.wrap(A.average("price"), lambda x: F.round(x, 4)))


@query("perf_max", weekly("max(price) AS high"))
def perf_max(t):
    return shipped(t).aggregate(high=A.max_("price"))


@query("perf_min", weekly("min(price) AS low"))
def perf_min(t):
    return shipped(t).aggregate(low=A.min_("price"))


@query("perf_group_count", weekly("count(*) AS n", "l_partkey, "))
def perf_group_count(t):
    return shipped(t).group_aggregate("l_partkey", n=A.count())


@query("threshold_crossing", f"""WITH p AS (SELECT event_type, vs, cents, lead(cents) OVER w AS nc, lead(vs) OVER w AS nv, event_id,
  lead(event_id) OVER w AS ni FROM ({POINTS}) WINDOW w AS (PARTITION BY event_type ORDER BY vs))
SELECT event_type, event_id AS below_id, ni AS above_id, nv AS vs, nv + 1 AS ve FROM p WHERE cents < 1000 AND nc >= 1000""")
def threshold_crossing(t):
    """A reading below the threshold, followed at once by one above it."""
    f = t.points().group_by("event_type")
    return f.followed_by_immediate(
        F.col("cents") < 1000,
        F.col("cents") >= 1000,
        30 * DAY,
        lambda l, r: {"below_id": l("event_id"), "above_id": r("event_id")},
    )


@query(
    "changing_limit",
    f"""WITH lim AS (SELECT cents AS threshold, vs, coalesce(lead(vs) OVER (ORDER BY vs), {INF}) AS ve FROM ({OPENED}) WHERE event_type = 'error')
SELECT event_id, cents, threshold, a.vs, a.ve FROM ({POINTS}) a ASOF JOIN lim ON a.vs >= lim.vs WHERE event_type = 'purchase' AND cents > threshold""",
)
def changing_limit(t):
    """Points against a slowly changing limit: a signal without a key."""
    limit = t.opened("event_type", "cents").where("event_type = 'error'").as_signal().select(threshold="cents")
    buys = t.points().where("event_type = 'purchase'").select("event_id", "cents")
    return buys.join(limit, residual=lambda l, r: l("cents") > r("threshold"))


