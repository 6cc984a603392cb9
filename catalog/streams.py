"""Queries on streams: the table is replayed as files and processed by Structured Streaming."""

from pyspark.sql import functions as F

from tidespan.functions import automaton as P
from tidespan.functions.time import INF
from tidespan.sources.scratch import scratch_dir
from tidespan.streaming import bucketed as SB
from tidespan.streaming import snapshots as SN
from tidespan.streaming import stateful as ST
from tidespan.streaming import windows as SW
from tidespan.streaming.runner import REPLAY_FILES, QueryContainer, replay

from .base import DAY, HOUR, INTERVALS, ORACLES, POINTS, query, segments_sql
from .joining import anti_sql
from .patterns import FIRST, RUNS, note
from .lifetimes import session_sql

FAR = 7258118400000000  # year 2200, in microseconds


def feed(t, frame, parts=2):
    """Replay a frame in time order, followed by one row far in the future that closes all windows."""
    df = frame.df
    path = scratch_dir(t.spark, "feed")
    cuts = [1704067200000000 + 30 * DAY * i // parts for i in range(1, parts)]
    bounds = [0, *cuts, FAR]
    pieces = [df.where(F.col("vs").between(a, b - 1)) for a, b in zip(bounds, bounds[1:], strict=False)]
    last = t.spark.range(1).select(
        *[
            # keys must not be null: joins drop null keys before the watermark sees the row
            (F.lit(FAR) if c in ("vs", "ve") else F.lit(-1)).cast(df.schema[c].dataType).alias(c)
            for c in df.columns
        ]
    )
    replay(path, *pieces, last)
    return path, df.schema


def streamed(t, frame, build, parts=2):
    """Run `build(stream)` over the replayed frame, part by part, and read back what it wrote."""
    path, schema = feed(t, frame, parts)
    box = QueryContainer(t.spark)
    box.register_output("out", build(box.register_input("in", path, schema, files_per_trigger=REPLAY_FILES)))
    box.run()
    out = box.result("out")
    return out.where(F.col("vs") < FAR)


def up(x, p):
    return f"(({x} + {p} - 1) // {p} * {p})"


@query(
    "stream_tumbling",
    f"SELECT event_type, {up('vs', 6 * HOUR)} AS vs, {up('vs', 6 * HOUR)} + {6 * HOUR} AS ve, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total FROM ({POINTS}) GROUP BY ALL",
)
def stream_tumbling(t):
    return streamed(
        t,
        t.points(),
        lambda s: SW.tumbling_windows(s, ["event_type"], 6 * HOUR, "1 hour", n=F.count("*"), total=F.sum("cents")),
    )


@query(
    "stream_hopping",
    f"""SELECT user_id, h AS vs, h + {2 * HOUR} AS ve, count(*) AS n
FROM (SELECT user_id, unnest(range({up('vs', 2 * HOUR)}, {up('vs', 2 * HOUR)} + {6 * HOUR}, {2 * HOUR})) AS h FROM ({POINTS})) GROUP BY ALL""",
)
def stream_hopping(t):
    return streamed(
        t, t.points(), lambda s: SW.hopping_windows(s, ["user_id"], 6 * HOUR, 2 * HOUR, "1 hour", n=F.count("*"))
    )


@query(
    "stream_hopping_uneven",
    f"""SELECT user_id, h AS vs, h + {2 * HOUR} AS ve, count(*) AS n
FROM (SELECT user_id, unnest(range({up('vs', 2 * HOUR)}, vs + {5 * HOUR}, {2 * HOUR})) AS h FROM ({POINTS})) GROUP BY ALL""",
)
def stream_hopping_uneven(t):
    """Window size not a multiple of the hop."""
    return streamed(
        t, t.points(), lambda s: SW.hopping_windows(s, ["user_id"], 5 * HOUR, 2 * HOUR, "1 hour", n=F.count("*"))
    )


@query(
    "stream_hopping_sparse",
    f"""SELECT user_id, {up('vs', 5 * HOUR)} AS vs, {up('vs', 5 * HOUR)} + {2 * HOUR} AS ve, count(*) AS n
FROM ({POINTS}) WHERE vs > {up('vs', 5 * HOUR)} - {2 * HOUR} GROUP BY ALL""",
)
def stream_hopping_sparse(t):
    """Hop larger than the window."""
    return streamed(
        t, t.points(), lambda s: SW.hopping_windows(s, ["user_id"], 2 * HOUR, 5 * HOUR, "1 hour", n=F.count("*"))
    )


def late_sql(latency, rest):
    return f"""WITH a AS (SELECT event_id, user_id, vs, ve, event_id // 1000 * 1000 + event_id * 617 % 1000 AS arrival FROM ({INTERVALS})),
c AS (SELECT *, greatest(coalesce(max(vs) OVER (PARTITION BY user_id ORDER BY arrival
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {latency}, 0), 0) AS now FROM a) {rest}"""


def late_stream(t, policy, latency):
    """Rows arriving in disorder, in two parts; each user has a clock."""
    arrival = F.expr("event_id div 1000 * 1000 + event_id * 617 % 1000")
    df = t.intervals("event_id", "user_id").df.withColumn("arrival", arrival)
    path, half = scratch_dir(t.spark, "feed"), F.col("arrival") < 5000
    replay(path, df.where(half), df.where(~half))
    box = QueryContainer(t.spark)
    stream = box.register_input("in", path, df.schema, files_per_trigger=REPLAY_FILES)
    box.register_output("out", ST.stream_disorder(stream, ["user_id"], "arrival", policy, latency))
    box.run()
    return box.result("out")


@query("stream_drop_late", late_sql(6 * HOUR, "SELECT event_id, user_id, arrival, vs, ve FROM c WHERE vs >= now"))
def stream_drop_late(t):
    return late_stream(t, "drop", 6 * HOUR)


@query(
    "stream_adjust_late",
    late_sql(HOUR, "SELECT event_id, user_id, arrival, greatest(vs, now) AS vs, ve FROM c WHERE greatest(vs, now) < ve"),
)
def stream_adjust_late(t):
    return late_stream(t, "adjust", HOUR)


@query(
    "stream_late_report",
    late_sql(HOUR, """SELECT event_id, user_id, arrival, vs, ve, CASE WHEN now >= ve THEN 'dropped' ELSE 'adjusted' END AS action,
  CASE WHEN now < ve THEN now - vs END AS delta FROM c WHERE vs < now"""),
)
def stream_late_report(t):
    return late_stream(t, "report adjust", HOUR)


@query(
    "stream_partial_windows",
    f"""SELECT event_type, h AS vs, h + {2 * HOUR} AS ve, count(*) AS n
FROM (SELECT event_type, unnest(range(vs // {2 * HOUR} * {2 * HOUR}, vs // {6 * HOUR} * {6 * HOUR} + {6 * HOUR}, {2 * HOUR})) AS h FROM ({POINTS})) GROUP BY ALL""",
)
def stream_partial_windows(t):
    """Early results while a window fills."""
    return streamed(
        t, t.points(), lambda s: SW.partial_windows(s, ["event_type"], 6 * HOUR, 2 * HOUR, "1 hour", n=F.count("*"))
    )


@query(
    "stream_sessions",
    session_sql(POINTS, "user_id", 8 * HOUR)
    + " SELECT user_id, min(vs) AS vs, max(send) AS ve, count(*) AS n FROM e GROUP BY user_id, sid",
)
def stream_sessions(t):
    return streamed(t, t.points(), lambda s: SW.sessions(s, ["user_id"], 8 * HOUR, "1 hour", n=F.count("*")))


@query(
    "stream_interval_join",
    f"""SELECT a.user_id, a.event_id AS v_id, b.event_id AS p_id, greatest(a.vs, b.vs) AS vs, least(a.vs, b.vs) + {HOUR} AS ve
FROM ({POINTS}) a JOIN ({POINTS}) b ON a.user_id = b.user_id AND abs(a.vs - b.vs) < {HOUR}
WHERE a.event_type = 'view' AND b.event_type = 'purchase'""",
)
def stream_interval_join(t):
    """Two streams joined within a fixed distance, with watermarks on both sides."""

    def build(s):
        v = s.where("event_type = 'view'").select("user_id", "vs", F.col("event_id").alias("v_id"))
        p = s.where("event_type = 'purchase'").select("user_id", "vs", F.col("event_id").alias("p_id"))
        return SW.interval_join(v, p, "user_id", HOUR, "1 hour")

    return streamed(t, t.points(), build)


@query("stream_snapshot", segments_sql(INTERVALS, "user_id", "count(*) AS n, CAST(sum(cents) AS BIGINT) AS total"))
def stream_snapshot(t):
    """General lifetimes on a stream."""
    f = t.intervals("user_id", "cents")
    return streamed(t, f, lambda s: ST.stream_snapshot(s, ["user_id"], "cents", "1 hour"))


@query(
    "stream_signal",
    f"""SELECT * FROM (SELECT event_id, user_id, vs, lead(vs) OVER (PARTITION BY user_id ORDER BY vs) AS ve FROM ({POINTS})) WHERE ve IS NOT NULL""",
)
def stream_signal(t):
    """Each row until the user's next; the last ones stay open and are not reported yet."""
    return streamed(t, t.points("event_id", "user_id"), lambda s: ST.stream_signal(s, ["user_id"], "1 hour"))


@query(
    "stream_session_capped",
    session_sql(POINTS, "user_id", 12 * HOUR)
    + f""",
f AS (SELECT *, min(vs) OVER (PARTITION BY user_id, sid) AS first_vs FROM e),
c AS (SELECT *, first_vs - first_vs % {DAY} + CASE WHEN first_vs % {DAY} = 0 THEN {DAY} ELSE {2 * DAY} END AS cap FROM f),
g AS (SELECT *, CASE WHEN vs < cap THEN cap ELSE vs - vs % {DAY} + {DAY} END AS stop FROM c)
SELECT event_id, user_id, vs, least(stop, max(vs) OVER (PARTITION BY user_id, sid, stop) + {12 * HOUR}) AS ve FROM g""",
)
def stream_session_capped(t):
    f = t.points("event_id", "user_id")
    return streamed(t, f, lambda s: ST.stream_session(s, ["user_id"], 12 * HOUR, "1 hour", max_duration=DAY))


@query(
    "stream_detect",
    RUNS
    + f""" SELECT a.user_id, a.event_id AS first_id, CAST(b.rn - a.rn + 1 AS BIGINT) AS n, b.vs, a.vs + {3 * DAY} AS ve
FROM r a JOIN r b ON b.user_id = a.user_id AND b.run = a.run + 1
WHERE a.event_type = 'view' AND b.event_type = 'click' AND b.vs < a.vs + {3 * DAY}""",
)
def stream_detect(t):
    """view+ click+ on a stream, with the batch automaton."""
    kind = F.col("event_type")
    pattern = P.sequence(P.single(kind == "view", note).repeated(), P.single(kind == "click", note).repeated())
    f = t.points("event_id", "user_id", "event_type")
    return streamed(t, f, lambda s: ST.stream_detect(s, ["user_id"], pattern, 3 * DAY, FIRST, "1 hour"))


@query("stream_stitch", f"SELECT event_id, vs, ve FROM ({INTERVALS})")
def stream_stitch(t):
    """Chopped rows put together again on a stream."""
    f = t.intervals("event_id").chop(0, 2 * HOUR)
    return streamed(t, f, lambda s: ST.stream_stitch(s, ["event_id"], "1 hour"))


@query(
    "stream_restart",
    f"SELECT event_type, {up('vs', DAY)} AS vs, {up('vs', DAY)} + {DAY} AS ve, count(*) AS n FROM ({POINTS}) GROUP BY ALL",
)
def stream_restart(t):
    """Stopped after the first half and resumed from the checkpoint by a new container."""
    df = t.points("event_type").df
    path, home = scratch_dir(t.spark, "feed"), scratch_dir(t.spark, "container")
    middle = 1704067200000000 + 15 * DAY
    far = t.spark.range(1).select(
        F.lit("").alias("event_type"), F.lit(FAR).alias("vs"), F.lit(FAR).alias("ve")
    )

    def run():
        box = QueryContainer(t.spark, home)
        s = box.register_input("in", path, df.schema, files_per_trigger=REPLAY_FILES)
        box.register_output("out", SW.tumbling_windows(s, ["event_type"], DAY, "1 hour", n=F.count("*")))
        box.run()
        return box

    replay(path, df.where(F.col("vs") < middle))
    run()
    replay(path, df.where(F.col("vs") >= middle), far.select(*df.columns))
    return run().result("out").where(F.col("vs") < FAR)


WIDE = "event_id + 9007199254740993"  # beyond what a double holds exactly


@query(
    "stream_signal_wide",
    f"""SELECT * FROM (SELECT user_id, event_id, vs, lead(vs) OVER (PARTITION BY user_id ORDER BY vs) AS ve,
  CASE WHEN event_id % 3 > 0 THEN {WIDE} END AS wide FROM ({POINTS})) WHERE ve IS NOT NULL""",
)
def stream_signal_wide(t):
    """Integers beyond 2**53, some of them null, keep all their digits."""
    wide = F.expr(f"CASE WHEN event_id % 3 > 0 THEN {WIDE} END")
    f = t.points("user_id", "event_id").select("user_id", "event_id", wide=wide)
    out = streamed(t, f, lambda s: ST.stream_signal(s, ["user_id"], "1 hour"))
    return out.where(F.col("ve") < FAR)


@query("stream_passive_replay", f"SELECT event_id, user_id, vs, ve FROM ({POINTS})")
def stream_passive_replay(t):
    """A stream written out as it came."""
    return streamed(t, t.points("event_id", "user_id"), lambda s: s)




@query(
    "stream_evolving_state",
    f"""SELECT event_type, t AS vs, CAST(sum(w) AS BIGINT) AS change FROM (
  SELECT event_type, vs AS t, 1 AS w FROM ({INTERVALS}) UNION ALL SELECT event_type, ve, -1 FROM ({INTERVALS}))
GROUP BY ALL HAVING sum(w) <> 0""",
)
def stream_evolving_state(t):
    """Inserts and deletes of the current multiset, netted per instant."""
    f = t.intervals("event_type")
    return streamed(t, f, lambda s: SW.evolving_state(s, ["event_type"], "8 hours"))


@query(
    "stream_interval_join_outer",
    f"""SELECT a.user_id, a.event_id AS v_id, b.event_id AS p_id, greatest(a.vs, coalesce(b.vs, a.vs)) AS vs,
  least(a.vs, coalesce(b.vs, a.vs)) + {HOUR} AS ve
FROM (SELECT * FROM ({POINTS}) WHERE event_type = 'view') a
LEFT JOIN (SELECT * FROM ({POINTS}) WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND abs(a.vs - b.vs) < {HOUR}""",
)
def stream_interval_join_outer(t):
    """Left rows without a partner come out once the watermark has passed their reach."""

    def build(s):
        # the closing row must pass both inputs for both watermarks to move
        last = F.col("vs") >= FAR
        v = s.where((F.col("event_type") == "view") | last).select("user_id", "vs", F.col("event_id").alias("v_id"))
        p = s.where((F.col("event_type") == "purchase") | last).select("user_id", "vs", F.col("event_id").alias("p_id"))
        return SW.interval_join(v, p, "user_id", HOUR, "1 hour", how="leftOuter")

    return streamed(t, t.points(), build)


@query(
    "stream_two_outputs",
    f"""SELECT 'purchase' AS part, event_id, vs, ve FROM ({POINTS}) WHERE event_type = 'purchase'
UNION ALL SELECT 'dear', event_id, vs, ve FROM ({POINTS}) WHERE cents > 5000""",
)
def stream_two_outputs(t):
    """Two consumers of one stream; the second attaches after the first has finished and still sees all of it."""
    path, schema = feed(t, t.points())
    box = QueryContainer(t.spark)
    s = box.register_input("in", path, schema)
    box.register_output("first", s.where("event_type = 'purchase'").select("event_id", "vs", "ve"))
    box.run()
    box.register_output("second", s.where("cents > 5000").select("event_id", "vs", "ve"))
    box.run()
    first = box.result("first").withColumn("part", F.lit("purchase"))
    return first.unionByName(box.result("second").withColumn("part", F.lit("dear")))


# Two inputs in one stateful operator. The closing row of the replay is on both sides, so that it moves all time on.


def kinds(s, first, second):
    last = F.col("vs") >= FAR
    a = s.where((F.col("event_type") == first) | last)
    b = s.where((F.col("event_type") == second) | last)
    return a, b


CLIPS = f"""WITH r AS (SELECT DISTINCT user_id, vs FROM ({POINTS}) WHERE event_type = 'error')
SELECT event_id, l.user_id, l.vs, least(l.ve, coalesce(r.vs, {INF})) AS ve
FROM (SELECT *, vs + 1 AS after FROM ({INTERVALS}) WHERE event_type = 'view') l ASOF LEFT JOIN r ON r.user_id = l.user_id AND r.vs >= l.after"""


@query("stream_clip_by", CLIPS)
def stream_clip_by(t):
    """Views end at the user's next error, live."""

    def build(s):
        views, errors = kinds(s, "view", "error")
        return ST.stream_clip_by(views.drop("event_type"), errors, ["user_id"], "1 hour")

    return streamed(t, t.intervals("event_id", "user_id", "event_type"), build)


@query(
    "stream_clip_by_unkeyed",
    CLIPS.replace("DISTINCT user_id, vs", "DISTINCT vs").replace("l.user_id, ", "").replace("r.user_id = l.user_id AND ", ""),
)
def stream_clip_by_unkeyed(t):
    """Views end at the next error of anyone, live."""

    def build(s):
        views, errors = kinds(s, "view", "error")
        return SB.clip_by(views.select("event_id", "vs", "ve"), errors, [], 6 * HOUR, "1 hour")

    return SB.whole_clips(streamed(t, t.intervals("event_id", "user_id", "event_type"), build))


LEFT, RIGHT = (f"SELECT * FROM ({INTERVALS}) WHERE event_type = '{k}'" for k in ("view", "purchase"))
STREAM_ANTI = anti_sql(LEFT, RIGHT, ["user_id"], ["user_id", "event_id"])


def sides(s):
    a, b = kinds(s, "view", "purchase")
    return a.select("user_id", "event_id", "vs", "ve"), b.select("user_id", F.col("event_id").alias("p_id"), "vs", "ve")


@query("stream_anti_join", STREAM_ANTI)
def stream_anti_join(t):
    """Views minus the times with a purchase of the same user: several stretches for a view, live."""
    f = t.intervals("event_id", "user_id", "event_type")
    return streamed(t, f, lambda s: ST.stream_anti_join(*sides(s), ["user_id"], "1 hour"))


@query(
    "stream_left_outer_join",
    f"""SELECT a.user_id, a.event_id, b.event_id AS p_id, greatest(a.vs, b.vs) AS vs, least(a.ve, b.ve) AS ve
FROM ({LEFT}) a JOIN ({RIGHT}) b ON a.user_id = b.user_id AND a.vs < b.ve AND b.vs < a.ve
UNION ALL SELECT user_id, event_id, NULL, vs, ve FROM ({STREAM_ANTI})""",
)
def stream_left_outer_join(t):
    """Views with the purchases that overlap them, and the rest of the views alone, live."""
    f = t.intervals("event_id", "user_id", "event_type")
    return streamed(t, f, lambda s: ST.stream_left_outer_join(*sides(s), ["user_id"], "1 hour"))


@query(
    "stream_anti_join_unkeyed",
    anti_sql(
        INTERVALS, f"SELECT vs, vs + {HOUR // 4} AS ve FROM ({POINTS}) WHERE event_type = 'error'", [], ["event_id"]
    ),
)
def stream_anti_join_unkeyed(t):
    """Lifetimes minus the quarter hours after any error, live."""

    def build(s):
        errors = s.where((F.col("event_type") == "error") | (F.col("vs") >= FAR))
        return SB.anti_join(s.select("event_id", "vs", "ve"), errors.select("vs", (F.col("vs") + HOUR // 4).alias("ve")), [], 6 * HOUR, "1 hour")

    return SB.whole_stretches(streamed(t, t.intervals("event_id", "event_type"), build))


def live(t, frame, keys, **aggs):
    """Snapshot aggregates by bucket; the closing row is not among them."""
    pieces = streamed(t, frame, lambda s: SN.aggregate(s, keys, DAY, "1 hour", **aggs))
    return SN.whole(pieces, keys)


@query(
    "stream_extremes",
    segments_sql(INTERVALS, "event_type", "count(*) AS n, min(cents) AS low, max(cents) AS high, CAST(sum(cents) AS BIGINT) AS total"),
)
def stream_extremes(t):
    """Counts, sums and extremes of general lifetimes, live."""
    f = t.intervals("event_type", "cents")
    return live(t, f, ["event_type"], n=SN.count(), low=SN.min_("cents"), high=SN.max_("cents"), total=SN.sum_("cents"))


@query(
    "stream_percentiles",
    segments_sql(INTERVALS, "event_type", "quantile_cont(cents, 0.9) AS p90, quantile_disc(cents, 0.5) AS p50"),
)
def stream_percentiles(t):
    f = t.intervals("event_type", "cents")
    return live(t, f, ["event_type"], p90=SN.percentile_continuous("cents", 0.9), p50=SN.percentile_discrete("cents", 0.5))


@query("stream_top_k", segments_sql(INTERVALS, "event_type", "list_sort(list(cents), 'DESC')[1:3] AS top"))
def stream_top_k(t):
    """The three largest values of every snapshot."""
    return live(t, t.intervals("event_type", "cents"), ["event_type"], top=SN.top("cents", 3))


@query("stream_sum_doubles", segments_sql(INTERVALS, "event_type", "round(sum(cents / 8.0), 4) AS total"))
def stream_sum_doubles(t):
    """Floating-point sums, exact through every start and end."""
    f = t.intervals("event_type", "cents").select("event_type", eighths=F.col("cents") / F.lit(8.0))
    return live(t, f, ["event_type"], total=SN.sum_("eighths")).withColumn("total", F.round("total", 4))


@query("stream_extremes_unkeyed", segments_sql(INTERVALS, "", "count(*) AS n, max(cents) AS high"))
def stream_extremes_unkeyed(t):
    """No key: the buckets of one timeline are tasks of their own."""
    return live(t, t.intervals("cents"), [], n=SN.count(), high=SN.max_("cents"))


# Restarts: a container is stopped in the middle of open state, and another goes on from its folder.


def restarted(t, frame, build):
    """The first half of a frame, then in a new container of the same home the second."""
    path, home = scratch_dir(t.spark, "feed"), scratch_dir(t.spark, "container")
    df, middle = frame.df, 1704067200000000 + 15 * DAY
    last = t.spark.range(1).select(
        *[(F.lit(FAR) if c in ("vs", "ve") else F.lit(-1)).cast(df.schema[c].dataType).alias(c) for c in df.columns]
    )
    for parts in ((df.where(F.col("vs") < middle),), (df.where(F.col("vs") >= middle), last)):
        replay(path, *parts)
        box = QueryContainer(t.spark, home)
        box.register_output("out", build(box.register_input("in", path, df.schema, files_per_trigger=REPLAY_FILES)))
        box.run()
    return box.result("out").where(F.col("vs") < FAR)


@query("stream_restart_detect", ORACLES["stream_detect"])
def stream_restart_detect(t):
    """Instances of a pattern that are under way when the container stops."""
    kind = F.col("event_type")
    pattern = P.sequence(P.single(kind == "view", note).repeated(), P.single(kind == "click", note).repeated())
    f = t.points("event_id", "user_id", "event_type")
    return restarted(t, f, lambda s: ST.stream_detect(s, ["user_id"], pattern, 3 * DAY, FIRST, "1 hour"))


@query("stream_restart_session", ORACLES["stream_session_capped"])
def stream_restart_session(t):
    """Open sessions with a cap."""
    f = t.points("event_id", "user_id")
    return restarted(t, f, lambda s: ST.stream_session(s, ["user_id"], 12 * HOUR, "1 hour", max_duration=DAY))


@query("stream_restart_stitch", ORACLES["stream_stitch"])
def stream_restart_stitch(t):
    """Pieces that wait for their continuation."""
    f = t.intervals("event_id").chop(0, 2 * HOUR)
    return restarted(t, f, lambda s: ST.stream_stitch(s, ["event_id"], "1 hour"))


@query(
    "stream_late_consumer",
    f"""SELECT 'all' AS consumer, event_type, {up('vs', DAY)} AS vs, {up('vs', DAY)} + {DAY} AS ve, count(*) AS n FROM ({POINTS}) GROUP BY ALL
UNION ALL SELECT 'late', event_type, {up('vs', DAY)}, {up('vs', DAY)} + {DAY}, count(*) FROM ({POINTS}) WHERE vs >= 1704067200000000 + 10 * {DAY} GROUP BY ALL""",
)
def stream_late_consumer(t):
    """Consumers that attach to a published log while its container runs: one from its beginning, one from the tenth day."""
    df, path = t.points("event_type").df, scratch_dir(t.spark, "feed")
    middle = 1704067200000000 + 15 * DAY
    last = t.spark.range(1).select(F.lit("").alias("event_type"), F.lit(FAR).alias("vs"), F.lit(FAR).alias("ve"))
    windows = lambda s: SW.tumbling_windows(s, ["event_type"], DAY, "1 hour", n=F.count("*"))
    box = QueryContainer(t.spark)
    replay(path, df.where(F.col("vs") < middle))
    box.publish("log", box.register_input("in", path, df.schema, files_per_trigger=REPLAY_FILES))
    box.run()
    box.attach("all", "log", windows).awaitTermination()
    box.detach("all")
    replay(path, df.where(F.col("vs") >= middle), last.select(*df.columns))
    box.run()
    box.attach("all", "log", windows)
    box.attach("late", "log", windows, since=1704067200000000 + 10 * DAY)
    for name in ("all", "late"):
        box.running[name].awaitTermination()
    found = [box.result(n).withColumn("consumer", F.lit(n)) for n in ("all", "late")]
    return found[0].unionByName(found[1]).where(F.col("vs") < FAR)


@query(
    "stream_input_rows",
    f"""SELECT event_type AS input, count(*) AS n, event_type = 'error' AS waiting FROM ({POINTS}) WHERE event_type IN ('view', 'error') GROUP BY ALL""",
)
def stream_input_rows(t):
    """What two named inputs have brought; one of them brings nothing in the last run and holds the other back."""
    paths = {}
    for name in ("view", "error"):
        df = t.points("event_id", "event_type").where(f"event_type = '{name}'").df
        paths[name] = scratch_dir(t.spark, "feed"), df
    box = QueryContainer(t.spark)
    early = F.col("vs") < 1704067200000000 + 15 * DAY
    for name, (path, df) in paths.items():
        replay(path, df.where(early) if name == "view" else df)
    both = [box.register_input(name, path, df.schema) for name, (path, df) in paths.items()]
    box.register_output("out", both[0].unionByName(both[1]))
    box.run()
    first = box.input_rows()
    replay(paths["view"][0], paths["view"][1].where(~early))
    box.run()
    waiting, second = box.waiting_inputs(), box.input_rows()
    rows = [(name, first[name] + second[name], name in waiting) for name in paths]
    return t.spark.createDataFrame(rows, "input string, n bigint, waiting boolean")
