"""Unions, data placement, disorder policies and properties."""

from pyspark.sql import functions as F

from tidespan.functions import aggregates as A
from tidespan.sources.ingress import Disorder, DisorderedEdges

from .base import DAY, HOUR, HOURLY, INTERVALS, OPENED, POINTS, query, segments_sql


def of_type(t, *names, frame=None):
    return (frame or t.intervals)().where(F.col("event_type").isin(*names))


@query("union", f"SELECT * FROM ({INTERVALS}) WHERE event_type IN ('view', 'click')")
def union(t):
    return of_type(t, "view").union(of_type(t, "click"))


@query(
    "ordered_union",
    f"SELECT *, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS src FROM ({INTERVALS}) WHERE event_type IN ('view', 'click', 'error')",
)
def ordered_union(t):
    """The input number decides the order of ties."""
    return of_type(t, "view").ordered_union(of_type(t, "click"), of_type(t, "error"))


@query("disjoint_union", INTERVALS)
def disjoint_union(t):
    """Shards put together again."""
    shards = t.intervals().shard_number(4, "user_id").split(4)
    whole = shards[0].union(*shards[1:])
    return whole.select("event_id", "user_id", "event_type", "cents")


@query(
    "multicast",
    segments_sql(
        f"SELECT * FROM ({INTERVALS}) WHERE event_type IN ('view', 'purchase')",
        "",
        "count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'purchase') AS buys",
        "true",
    ).replace("GROUP BY s.vs, s.ve", "GROUP BY s.vs, s.ve HAVING count(*) FILTER (WHERE event_type = 'view') > 0 AND count(*) FILTER (WHERE event_type = 'purchase') > 0"),
)
def multicast(t):
    """One input, two sub-queries, joined in time."""
    return t.intervals("event_type").multicast(
        lambda s: s.where("event_type = 'view'").count("views").join(s.where("event_type = 'purchase'").count("buys"))
    )


@query("multicast_copies", f"SELECT event_id, vs, ve FROM ({POINTS}) UNION ALL SELECT event_id, vs, ve FROM ({POINTS})")
def multicast_copies(t):
    a, b = t.points("event_id").copies(2)
    return a.union(b)


@query(
    "multicast_two_inputs",
    f"""SELECT a.user_id, a.event_id, greatest(a.vs, b.vs) AS vs, least(a.ve, b.ve) AS ve
FROM (SELECT * FROM ({INTERVALS}) WHERE event_type = 'view') a JOIN (SELECT * FROM ({INTERVALS}) WHERE event_type = 'error') b
ON a.user_id = b.user_id AND a.vs < b.ve AND b.vs < a.ve""",
)
def multicast_two_inputs(t):
    views = of_type(t, "view").select("user_id", "event_id")
    errors = of_type(t, "error").select("user_id", err="event_id")
    return views.multicast(lambda l, r: l.semi_join(r, "user_id"), errors)


@query("in_time_order", f"SELECT event_id, user_id, vs, ve FROM ({HOURLY})")
def in_time_order(t):
    return t.hourly("event_id", "user_id").in_order("event_id")


@query("partition", segments_sql(INTERVALS, "user_id", "count(*) AS n"))
def partition(t):
    """Independent timelines per user."""
    return t.intervals().partition("user_id").count()


@query("map_reduce", segments_sql(f"SELECT * FROM ({INTERVALS}) WHERE cents > 200", "event_type", "max(cents) AS high"))
def map_reduce(t):
    return t.intervals().map_reduce(
        lambda f: f.where("cents > 200"), "event_type", lambda f: f.aggregate(high=A.max_("cents"))
    )


@query(
    "map_reduce_two_inputs",
    f"""SELECT a.user_id, a.event_id, b.p_id, greatest(a.vs, b.vs) AS vs, least(a.ve, b.ve) AS ve
FROM (SELECT * FROM ({INTERVALS}) WHERE event_type = 'view') a
JOIN (SELECT user_id, event_id AS p_id, vs, ve FROM ({INTERVALS}) WHERE event_type = 'purchase') b
ON a.user_id = b.user_id AND a.vs < b.ve AND b.vs < a.ve""",
)
def map_reduce_two_inputs(t):
    return t.intervals().map_reduce_with(
        t.intervals(),
        lambda f: f.where("event_type = 'view'").select("user_id", "event_id"),
        lambda f: f.where("event_type = 'purchase'").select("user_id", p_id="event_id"),
        "user_id",
        lambda l, r: l.join(r),
    )


@query("shard_unshard", f"SELECT event_id, vs, ve FROM ({POINTS})")
def shard_unshard(t):
    return t.points("event_id").shard(8).unshard()


@query("rekey_shuffle", segments_sql(f"SELECT *, user_id % 7 AS bucket FROM ({INTERVALS})", "bucket", "count(*) AS n"))
def rekey_shuffle(t):
    """A new key, rows laid out by it, a sub-query per key."""
    return t.intervals().rekey(bucket=F.col("user_id") % 7).shuffle().count()


@query("redistribute", f"SELECT event_id, user_id, vs, ve FROM ({POINTS})")
def redistribute(t):
    return t.points("event_id", "user_id").group_by("user_id").redistribute(8).reshard(4)


@query("broadcast_copies", f"SELECT event_id, vs, ve, unnest([0, 1, 2]) AS shard FROM ({POINTS})")
def broadcast_copies(t):
    """Every shard gets all rows."""
    return t.points("event_id").broadcast_to(3)


@query("send_to_shards", f"SELECT event_id, vs, ve, unnest([event_id % 3, 3 + event_id % 2]) AS shard FROM ({POINTS})")
def send_to_shards(t):
    """Each row goes to a computed list of shards."""
    return t.points("event_id").send_to(F.array(F.col("event_id") % 3, F.col("event_id") % 2 + 3))


@query("shard_query", segments_sql(f"SELECT *, user_id AS k FROM ({INTERVALS})", "k", "CAST(sum(cents) AS BIGINT) AS total"))
def shard_query(t):
    """A query on every shard, with a payload made from the key."""
    f = t.intervals().group_by("user_id").shuffle().select_key(k=F.col("user_id")).rekey("k")
    return f.query(lambda s: s.aggregate(total=A.sum_("cents")))


@query(
    "sharded_join_query",
    f"""SELECT a.user_id, a.event_id, b.p_id, greatest(a.vs, b.vs) AS vs, least(a.ve, b.ve) AS ve
FROM (SELECT * FROM ({INTERVALS}) WHERE event_type = 'click') a
JOIN (SELECT user_id, event_id AS p_id, vs, ve FROM ({INTERVALS}) WHERE event_type = 'purchase') b
ON a.user_id = b.user_id AND a.vs < b.ve AND b.vs < a.ve""",
)
def sharded_join_query(t):
    """A two-input query on shards laid out by the same key."""
    a = of_type(t, "click").select("user_id", "event_id").group_by("user_id").shuffle()
    b = of_type(t, "purchase").select("user_id", p_id="event_id").group_by("user_id").shuffle()
    return a.query(lambda l, r: l.join(r), b)


# Disorder: rows arrive shuffled within blocks of 50 (or 1000) events.

ARRIVAL = "event_id // 50 * 50 + event_id * 17 % 50"
WIDE = "event_id // 1000 * 1000 + event_id * 617 % 1000"


def arrivals(t, block=50, factor=17):
    f = t.intervals("event_id", "user_id")
    arrival = F.expr(f"event_id div {block} * {block} + event_id * {factor} % {block}")
    return f.df.withColumn("arrival", arrival)


def clock_sql(arrival, latency, per=""):
    part = f"PARTITION BY {per}" if per else ""
    return f"""WITH a AS (SELECT event_id, user_id, vs, ve, {arrival} AS arrival FROM ({INTERVALS})),
c AS (SELECT *, greatest(coalesce(max(vs) OVER ({part} ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {latency}, 0), 0) AS now FROM a)"""


@query("drop_late", clock_sql(ARRIVAL, 0) + " SELECT event_id, user_id, arrival, vs, ve FROM c WHERE vs >= now")
def drop_late(t):
    return Disorder(arrivals(t), "arrival").drop()


@query(
    "reorder_and_drop",
    clock_sql(ARRIVAL, HOUR) + " SELECT event_id, user_id, arrival, vs, ve FROM c WHERE vs >= now",
)
def reorder_and_drop(t):
    """An hour of reordering, then dropping."""
    return Disorder(arrivals(t), "arrival", latency=HOUR).drop()


@query(
    "adjust_late",
    clock_sql(ARRIVAL, HOUR // 2)
    + " SELECT event_id, user_id, arrival, greatest(vs, now) AS vs, ve FROM c WHERE greatest(vs, now) < ve",
)
def adjust_late(t):
    return Disorder(arrivals(t), "arrival", latency=HOUR // 2).adjust()


# Edges: of each row its start and its end arrive on their own, up to four hours late, each user with a clock.

EDGES = f"""SELECT event_id, user_id, 0 AS kind, vs, vs AS start, (vs + event_id * 617 % 5 * {HOUR}) // 1000 * 200000 + event_id * 2 AS arrival FROM ({INTERVALS})
UNION ALL SELECT event_id, user_id, 1, ve, vs, (ve + (event_id * 617 % 5 + event_id * 31 % 3) * {HOUR}) // 1000 * 200000 + event_id * 2 + 1 FROM ({INTERVALS})"""
EDGE_CLOCK = f"""WITH e AS ({EDGES}),
c AS (SELECT *, greatest(coalesce(max(vs) OVER (PARTITION BY user_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {HOUR}, 0), 0) AS now FROM e),
m AS (SELECT event_id AS late_id, now AS moved FROM c WHERE kind = 0 AND vs < now),
j AS (SELECT c.*, moved FROM c LEFT JOIN m ON kind = 1 AND late_id = event_id)"""


def edges(t):
    """Start and end edges of the intervals in order of arrival."""
    df = t.intervals("event_id", "user_id").df
    late, later = F.expr("event_id * 617 % 5"), F.expr("event_id * 31 % 3")
    order = lambda at, extra: F.expr("cast(0 as bigint)") + F.floor(at / 1000).cast("long") * 200000 + F.col("event_id") * 2 + extra
    begin = df.select("event_id", "user_id", F.lit(0).alias("kind"), "vs", F.col("vs").alias("start"), order(F.col("vs") + late * HOUR, 0).alias("arrival"))
    end = df.select("event_id", "user_id", F.lit(1).alias("kind"), F.col("ve").alias("vs"), F.col("vs").alias("start"), order(F.col("ve") + (late + later) * HOUR, 1).alias("arrival"))
    return DisorderedEdges(begin.unionByName(end), "arrival", F.col("kind") == 0, "start", ["event_id"], latency=HOUR, per="user_id")


@query("drop_late_edges", f"{EDGE_CLOCK} SELECT event_id, user_id, kind, vs, start, arrival FROM j WHERE vs >= now AND moved IS NULL")
def drop_late_edges(t):
    """A dropped start takes its end along, even if that is in time."""
    return edges(t).drop()


@query(
    "adjust_late_edges",
    f"""{EDGE_CLOCK} SELECT event_id, user_id, kind, greatest(vs, now) AS vs, CASE WHEN kind = 1 THEN coalesce(moved, start) ELSE start END AS start, arrival FROM j""",
)
def adjust_late_edges(t):
    """The end of a moved start names the new start."""
    return edges(t).adjust()


@query("throw_on_late", f"SELECT event_id, user_id, event_id AS arrival, vs, ve FROM ({INTERVALS})")
def throw_on_late(t):
    """Rows that do arrive in order pass; a late one would fail the query."""
    f = t.intervals("event_id", "user_id")
    return Disorder(f.df.withColumn("arrival", F.col("event_id")), "arrival").strict()


@query(
    "late_report",
    clock_sql(ARRIVAL, HOUR // 2)
    + """ SELECT event_id, user_id, arrival, vs, ve, CASE WHEN now >= ve THEN 'dropped' ELSE 'adjusted' END AS action,
  CASE WHEN now < ve THEN now - vs END AS delta FROM c WHERE vs < now""",
)
def late_report(t):
    """Side output: what happened to each late row."""
    return Disorder(arrivals(t), "arrival", latency=HOUR // 2).report("adjust")


@query(
    "late_report_drop",
    clock_sql(ARRIVAL, 0)
    + " SELECT event_id, user_id, arrival, vs, ve, 'dropped' AS action, CAST(NULL AS BIGINT) AS delta FROM c WHERE vs < now",
)
def late_report_drop(t):
    return Disorder(arrivals(t), "arrival").report("drop")


@query(
    "drop_late_per_partition",
    clock_sql(WIDE, 6 * HOUR, "user_id") + " SELECT event_id, user_id, arrival, vs, ve FROM c WHERE vs >= now",
)
def drop_late_per_partition(t):
    """A clock per user."""
    return Disorder(arrivals(t, 1000, 617), "arrival", latency=6 * HOUR, per="user_id").drop()


@query(
    "drop_late_low_watermark",
    clock_sql(WIDE, 6 * HOUR, "user_id").replace("c AS (SELECT *,", "c AS (SELECT *, max(vs) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high,")
    + f""" SELECT event_id, user_id, arrival, vs, ve FROM c
WHERE vs >= greatest(now, coalesce((high - {12 * HOUR}) // {HOUR} * {HOUR}, 0))""",
)
def drop_late_low_watermark(t):
    """A clock per user, but none more than twelve hours behind the latest of all, in steps of an hour."""
    low = {"low_lag": 12 * HOUR, "low_period": HOUR}
    return Disorder(arrivals(t, 1000, 617), "arrival", latency=6 * HOUR, per="user_id", **low).drop()


# Properties.


@query(
    "profile",
    f"""WITH src AS ({HOURLY}), s AS (SELECT user_id, vs, count(*) AS c, max(ve) AS e FROM src GROUP BY ALL),
o AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY vs ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT (SELECT count(*) FROM src) AS n_rows, (SELECT min(ve - vs) FROM src) AS min_duration,
  (SELECT max(ve - vs) FROM src) AS max_duration, 0::BIGINT AS n_open,
  CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS n_simultaneous,
  count(*) FILTER (WHERE before > vs) AS n_overlapping_starts FROM o""",
)
def profile(t):
    """Is the duration constant? Are there open, simultaneous, overlapping rows?"""
    return t.hourly().group_by("user_id").profile()


@query(
    "declared_tumbling",
    f"SELECT user_id, vs, ve, count(*) AS n FROM (SELECT user_id, vs // {DAY} * {DAY} AS vs, vs // {DAY} * {DAY} + {DAY} AS ve FROM ({POINTS})) GROUP BY ALL",
)
def declared_tumbling(t):
    """Declared properties select the plain aggregation."""
    f = t.points("user_id").set_lifetime(F.col("vs") - F.col("vs") % DAY, DAY)
    return f.declare(duration=DAY, hop=DAY).group_by("user_id").count()


@query(
    "violations",
    f"""SELECT event_id, vs, ve, 'duration' AS broken FROM ({INTERVALS}) WHERE ve - vs <> {3 * HOUR}
UNION ALL SELECT event_id, vs, ve, 'hop' FROM ({INTERVALS}) WHERE vs % {HOUR} <> 0""",
)
def violations(t):
    """Rows that break a declared property."""
    return t.intervals("event_id").declare(duration=3 * HOUR, hop=HOUR).violations()


@query(
    "gaps_between_starts",
    f"SELECT user_id, vs, lead(vs) OVER (PARTITION BY user_id ORDER BY vs) - vs AS to_next FROM (SELECT DISTINCT user_id, vs FROM ({OPENED}))",
)
def gaps_between_starts(t):
    return t.opened("user_id").group_by("user_id").gaps_between_starts()
