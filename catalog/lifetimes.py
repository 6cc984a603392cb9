"""Lifetime operators."""

from pyspark.sql import functions as F

from tidespan.functions import aggregates as A
from tidespan.functions.time import INF, snap_left

from .base import DAY, HOUR, HOURLY, INTERVALS, OPENED, POINTS, query, segments_sql

CEIL6 = f"(vs + {6 * HOUR} - 1) // {6 * HOUR} * {6 * HOUR}"


@query("tumbling", f"SELECT event_id, {CEIL6} AS vs, {CEIL6} + {6 * HOUR} AS ve FROM ({POINTS})")
def tumbling(t):
    return t.points("event_id").tumbling(6 * HOUR)


OFF = HOUR // 2
CEILOFF = f"((vs - {OFF} + {2 * HOUR} - 1) // {2 * HOUR} * {2 * HOUR} + {OFF})"


@query("hopping", f"SELECT event_id, {CEILOFF} AS vs, {CEILOFF} + {6 * HOUR} AS ve FROM ({POINTS})")
def hopping(t):
    return t.points("event_id").hopping(6 * HOUR, 2 * HOUR, OFF)


def ceil_to(x, p):
    return f"(({x} + {p} - 1) // {p} * {p})"


@query(
    "hopping_uneven",
    f"SELECT event_id, {ceil_to('vs', 2 * HOUR)} AS vs, {ceil_to(f'(vs + {5 * HOUR})', 2 * HOUR)} AS ve FROM ({POINTS})",
)
def hopping_uneven(t):
    """Window size not a multiple of the hop."""
    return t.points("event_id").hopping(5 * HOUR, 2 * HOUR)


@query(
    "hopping_sparse",
    f"SELECT event_id, {ceil_to('vs', 5 * HOUR)} AS vs, {ceil_to('vs', 5 * HOUR)} + {2 * HOUR} AS ve FROM ({POINTS}) "
    f"WHERE vs > {ceil_to('vs', 5 * HOUR)} - {2 * HOUR}",
)
def hopping_sparse(t):
    """Hop larger than the window: events between windows vanish."""
    return t.points("event_id").hopping(2 * HOUR, 5 * HOUR)


@query(
    "repetitive_hopping",
    f"""SELECT event_id, h AS vs, h + {2 * HOUR} AS ve
FROM (SELECT event_id, unnest(range({ceil_to('vs', 2 * HOUR)}, {ceil_to('vs', 2 * HOUR)} + {6 * HOUR}, {2 * HOUR})) AS h
      FROM ({POINTS}))""",
)
def repetitive_hopping(t):
    return t.points("event_id").repetitive_hopping(6 * HOUR, 2 * HOUR)


def quantized(size, period, progress):
    end = f"greatest(ve + {period - 1}, vs + {size})"
    return (
        f"SELECT event_id, vs // {progress} * {progress} AS vs, "
        f"({end} - {size}) // {period} * {period} + {size} AS ve FROM ({INTERVALS})"
    )


@query("quantize", quantized(6 * HOUR, 2 * HOUR, 2 * HOUR))
def quantize(t):
    return t.intervals("event_id").quantize(6 * HOUR, 2 * HOUR)


@query("progressive_quantize", quantized(6 * HOUR, 6 * HOUR, 2 * HOUR))
def progressive_quantize(t):
    return t.intervals("event_id").progressive_quantize(6 * HOUR, 6 * HOUR, 2 * HOUR)


@query(
    "early_results",
    segments_sql(quantized(6 * HOUR, 6 * HOUR, 2 * HOUR), "", "count(*) AS n"),
)
def early_results(t):
    """Windows reported while still filling, by progressive quantizing."""
    return t.intervals("event_id").progressive_quantize(6 * HOUR, 6 * HOUR, 2 * HOUR).aggregate(n=A.count())


@query("set_duration", f"SELECT event_id, vs, vs + {HOUR} AS ve FROM ({POINTS})")
def set_duration(t):
    return t.points("event_id").set_duration(HOUR)


@query(
    "set_duration_by_time",
    f"SELECT event_id, vs, vs + vs % {HOUR} + 1 AS ve FROM ({POINTS})",
)
def set_duration_by_time(t):
    return t.points("event_id").set_duration(F.col("vs") % HOUR + 1)


@query(
    "set_duration_by_lifetime",
    f"SELECT event_id, vs, vs + 2 * (ve - vs) AS ve FROM ({INTERVALS})",
)
def set_duration_by_lifetime(t):
    return t.intervals("event_id").set_duration(2 * (F.col("ve") - F.col("vs")))


@query("set_duration_open", f"SELECT event_id, vs, {INF} AS ve FROM ({POINTS})")
def set_duration_open(t):
    return t.points("event_id").set_duration(INF)


@query("shift", f"SELECT event_id, vs + {DAY} AS vs, ve + {DAY} AS ve FROM ({INTERVALS})")
def shift(t):
    return t.intervals("event_id").shift(DAY)


@query(
    "shift_by_time",
    f"SELECT event_id, vs + vs % 1000 AS vs, ve + vs % 1000 AS ve FROM ({INTERVALS})",
)
def shift_by_time(t):
    return t.intervals("event_id").shift(F.col("vs") % 1000)


@query("shift_open", f"SELECT event_id, vs + {DAY} AS vs, ve FROM ({OPENED})")
def shift_open(t):
    return t.opened("event_id").shift(DAY)


@query(
    "set_lifetime",
    f"SELECT event_id, vs // {DAY} * {DAY} AS vs, vs // {DAY} * {DAY} + {HOUR} AS ve FROM ({POINTS})",
)
def set_lifetime(t):
    return t.points("event_id").set_lifetime(snap_left("vs", DAY), HOUR)


@query(
    "set_lifetime_by_lifetime",
    f"SELECT event_id, vs + 10 AS vs, vs + 10 + (ve - vs) // 2 AS ve FROM ({INTERVALS})",
)
def set_lifetime_by_lifetime(t):
    return t.intervals("event_id").set_lifetime(F.col("vs") + 10, F.expr("(ve - vs) div 2"))


@query(
    "lifetime_per_partition",
    f"SELECT event_id, user_id, vs - vs % (user_id + 1) AS vs, "
    f"vs - vs % (user_id + 1) + (user_id + 1) * 60000000 AS ve FROM ({POINTS})",
)
def lifetime_per_partition(t):
    """Start and duration depend on the partition key."""
    f = t.points("event_id", "user_id").partition("user_id")
    k = F.col("user_id") + 1
    return f.set_lifetime(F.col("vs") - F.col("vs") % k, k * 60000000)


@query("extend", f"SELECT event_id, vs, ve + {HOUR} AS ve FROM ({INTERVALS})")
def extend(t):
    return t.intervals("event_id").extend(HOUR)


@query(
    "extend_negative",
    f"SELECT event_id, vs, ve - {3 * HOUR} AS ve FROM ({INTERVALS}) WHERE ve - {3 * HOUR} > vs",
)
def extend_negative(t):
    return t.intervals("event_id").extend(-3 * HOUR)


@query("clip_constant", f"SELECT event_id, vs, least(ve, vs + {3 * HOUR}) AS ve FROM ({INTERVALS})")
def clip_constant(t):
    return t.intervals("event_id").clip(3 * HOUR)


CHOPPED = f"""SELECT event_id, event_type, greatest(vs, g) AS vs, least(ve, g + {2 * HOUR}) AS ve
FROM (SELECT *, unnest(range(vs // {2 * HOUR} * {2 * HOUR}, ve, {2 * HOUR})) AS g FROM ({INTERVALS}))"""


@query("chop", f"SELECT event_id, vs, ve FROM ({CHOPPED})")
def chop(t):
    return t.intervals("event_id").chop(0, 2 * HOUR)


@query(
    "chop_offset_horizon",
    f"""SELECT event_id, greatest(vs, g) AS vs, least(h, g + {DAY}) AS ve
FROM (SELECT *, unnest(range((vs - {OFF}) // {DAY} * {DAY} + {OFF}, h, {DAY})) AS g
      FROM (SELECT *, {1706659200000000} AS h FROM ({OPENED}) WHERE vs < {1706659200000000}))""",
)
def chop_offset_horizon(t):
    """Open lifetimes chopped up to a horizon."""
    return t.opened("event_id").chop(OFF, DAY, horizon=1706659200000000)


@query("stitch", f"SELECT event_id, vs, ve FROM ({INTERVALS})")
def stitch(t):
    """Chopping and stitching gives the input back."""
    return t.intervals("event_id").chop(0, 2 * HOUR).stitch()


@query(
    "stitch_islands",
    f"""WITH src AS (SELECT DISTINCT user_id, vs, vs + {HOUR} AS ve FROM ({HOURLY})),
m AS (SELECT *, CASE WHEN lag(ve) OVER (PARTITION BY user_id ORDER BY vs) = vs THEN 0 ELSE 1 END AS fresh FROM src),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY vs) AS i FROM m)
SELECT user_id, min(vs) AS vs, max(ve) AS ve FROM g GROUP BY user_id, i""",
)
def stitch_islands(t):
    """Hours with activity of a user, merged to stretches."""
    f = t.hourly("user_id").set_duration(HOUR)
    return f._with(f.df.distinct()).stitch()


@query(
    "stitch_copies",
    f"""WITH RECURSIVE src AS (
  SELECT user_id, vs, vs + {HOUR} AS ve, row_number() OVER (PARTITION BY user_id, vs ORDER BY event_id) AS i
  FROM ({HOURLY})),
walk AS (
  SELECT s.user_id, s.vs AS start, s.ve, s.i FROM src s
  WHERE NOT EXISTS (SELECT 1 FROM src p WHERE p.user_id = s.user_id AND p.ve = s.vs AND p.i = s.i)
  UNION ALL
  SELECT w.user_id, w.start, n.ve, n.i FROM walk w JOIN src n ON n.user_id = w.user_id AND n.vs = w.ve AND n.i = w.i)
SELECT user_id, start AS vs, max(ve) AS ve FROM walk GROUP BY user_id, start, i""",
)
def stitch_copies(t):
    """Several copies of a row at once: each end is linked to one start, copy by copy."""
    return t.hourly("user_id").set_duration(HOUR).stitch()


@query("point_at_end", f"SELECT event_id, ve AS vs, ve + 1 AS ve FROM ({INTERVALS})")
def point_at_end(t):
    return t.intervals("event_id").point_at_end()


@query("point_at_end_open", f"SELECT event_id, ve AS vs, ve + 1 AS ve FROM ({OPENED}) WHERE false")
def point_at_end_open(t):
    """Open rows have no end."""
    return t.opened("event_id").point_at_end()


def session_sql(source, key, timeout):
    part = f"PARTITION BY {key}" if key else "PARTITION BY 1"
    return f"""
WITH src AS ({source}),
b AS (SELECT *, CASE WHEN vs - lag(vs) OVER w < {timeout} THEN 0 ELSE 1 END AS fresh FROM src WINDOW w AS ({part} ORDER BY vs, event_id)),
s AS (SELECT *, sum(fresh) OVER ({part} ORDER BY vs, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM b),
e AS (SELECT *, max(vs) OVER ({part}, sid) + {timeout} AS send FROM s)"""


@query(
    "session",
    session_sql(POINTS, "user_id", 8 * HOUR) + " SELECT event_id, user_id, vs, send AS ve FROM e",
)
def session(t):
    return t.points("event_id", "user_id").group_by("user_id").session(8 * HOUR)


@query(
    "session_ties",
    session_sql(HOURLY, "user_id", 6 * HOUR) + " SELECT event_id, user_id, vs, send AS ve FROM e",
)
def session_ties(t):
    """Whole hours: gaps of exactly the timeout do occur and separate sessions."""
    return t.hourly("event_id", "user_id").group_by("user_id").session(6 * HOUR)


@query(
    "session_unkeyed",
    session_sql(POINTS, "", 600_000_000) + " SELECT event_id, vs, send AS ve FROM e",
)
def session_unkeyed(t):
    return t.points("event_id").session(600_000_000)


@query(
    "session_capped",
    session_sql(POINTS, "user_id", 12 * HOUR)
    + f""",
f AS (SELECT *, min(vs) OVER (PARTITION BY user_id, sid) AS first_vs FROM e),
c AS (SELECT *, first_vs - first_vs % {DAY} + CASE WHEN first_vs % {DAY} = 0 THEN {DAY} ELSE {2 * DAY} END AS cap FROM f),
g AS (SELECT *, CASE WHEN vs < cap THEN cap ELSE vs - vs % {DAY} + {DAY} END AS stop FROM c)
SELECT event_id, user_id, vs, least(stop, max(vs) OVER (PARTITION BY user_id, sid, stop) + {12 * HOUR}) AS ve FROM g""",
)
def session_capped(t):
    """Sessions that also end on a daily grid."""
    return t.points("event_id", "user_id").group_by("user_id").session(12 * HOUR, max_duration=DAY)


@query(
    "snap_left",
    f"SELECT event_id, (vs - 7) // 1000 * 1000 + 7 AS snapped FROM ({POINTS})",
)
def snapped(t):
    return t.points("event_id").to_rows(event_id="event_id", snapped=snap_left("vs", 1000, 7))
