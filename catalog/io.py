"""Ways in and out."""

from pyspark.sql import functions as F

from tidespan import TemporalFrame
from tidespan.functions.time import micros
from tidespan.sources import ingress
from tidespan.sources.scratch import scratch_dir

from .base import DAY, HOUR, HOURLY, INTERVALS, OPENED, POINTS, query

INF = 3155378975999999999
EDGES = f"""SELECT event_id, user_id, vs AS sync, {INF} AS other, 'start' AS kind FROM ({INTERVALS})
UNION ALL SELECT event_id, user_id, ve, vs, 'end' FROM ({INTERVALS})"""


UP = f"((vs + {6 * HOUR} - 1) // {6 * HOUR} * {6 * HOUR})"


@query("to_changelog", EDGES)
def to_changelog(t):
    """Start and end edges."""
    return t.intervals("event_id", "user_id").to_changelog()


@query("from_changelog", f"SELECT event_id, user_id, vs, ve FROM ({INTERVALS})")
def from_changelog(t):
    """Edges paired to intervals again."""
    log = t.intervals("event_id", "user_id").to_changelog().drop("kind")
    return ingress.from_changelog(log)


@query(
    "from_changelog_open",
    f"""SELECT user_id, vs, CASE WHEN i <= closed THEN vs + {DAY} ELSE {INF} END AS ve FROM (
  SELECT user_id, vs, row_number() OVER (PARTITION BY user_id, vs ORDER BY event_id) AS i,
    count(*) FILTER (WHERE event_id % 2 = 0) OVER (PARTITION BY user_id, vs) AS closed FROM ({HOURLY}))""",
)
def from_changelog_open(t):
    """A bag of equal starts of which only some end: the rest stay open."""
    f = t.hourly("event_id", "user_id").df
    starts = f.select("user_id", F.col("vs").alias("sync"), F.lit(INF).alias("other"))
    ends = f.where("event_id % 2 = 0").select(
        "user_id", (F.col("vs") + DAY).alias("sync"), F.col("vs").alias("other")
    )
    return ingress.from_changelog(starts.unionByName(ends))


@query("from_starts", OPENED)
def from_starts(t):
    return t.opened()


@query("from_intervals", INTERVALS)
def from_intervals(t):
    """Start and end expressions; an empty lifetime would fail the query."""
    vs = micros("ts")
    end = vs + (F.lit(1) + F.pmod(F.col("event_id"), F.lit(7))) * HOUR
    f = ingress.from_intervals(t.events(), vs, end)
    return f.select("event_id", "user_id", "event_type", "cents")


@query(
    "from_two_dates",
    """SELECT l_orderkey, l_linenumber, epoch_us(o_orderdate) AS vs, epoch_us(l_shipdate) AS ve
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < l_shipdate""",
)
def from_two_dates(t):
    """Lifetimes from two date columns: from order to shipping."""
    df = t.read("lineitem").join(t.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    df = df.where("o_orderdate < l_shipdate")
    return ingress.from_timestamps(df, "o_orderdate", end="l_shipdate").select("l_orderkey", "l_linenumber")


@query("from_partitioned", f"SELECT user_id, event_id, vs, ve FROM ({POINTS})")
def from_partitioned(t):
    """The partition column becomes the key."""
    return ingress.from_timestamps(t.events(), "ts", keys="user_id").select("event_id")


@query(
    "from_sequence",
    f"SELECT doc_id, lang, (row_number() OVER (ORDER BY doc_id) - 1) // 10 AS vs, {INF} AS ve FROM documents",
)
def from_sequence(t):
    """Timeless rows, ten per tick."""
    return ingress.from_sequence(t.read("documents").select("doc_id", "lang"), "doc_id", 10)


@query("from_clock", f"SELECT doc_id, lang, true AS recent, {INF} AS ve FROM documents")
def from_clock(t):
    """Timeless rows stamped with the query's wall clock."""
    f = ingress.from_clock(t.read("documents").select("doc_id", "lang"))
    return f.to_rows(doc_id="doc_id", lang="lang", recent=F.col("vs") > 1704067200000000, ve="ve")


def batches(t):
    """Points as arrays of at most a hundred."""
    number = F.floor(F.col("event_id") / 100)
    item = F.struct("event_id", "user_id", F.col("vs").alias("at"))
    return t.points("event_id", "user_id").df.groupBy(number).agg(F.collect_list(item).alias("batch"))


@query("from_arrays", f"SELECT event_id, user_id, vs, vs + {HOUR} AS ve FROM ({POINTS})")
def from_arrays(t):
    """Batches of rows as arrays of structs."""
    packed = batches(t)
    f = ingress.from_arrays(packed, "batch", F.col("at"), F.col("at") + HOUR)
    return f.select("event_id", "user_id")


@query("from_arrays_open", f"SELECT event_id, user_id, vs, {INF} AS ve FROM ({POINTS})")
def from_arrays_open(t):
    packed = batches(t)
    return ingress.from_arrays(packed, "batch", "at").select("event_id", "user_id")


@query("file_round_trip", f"SELECT event_id, user_id, vs, ve FROM ({INTERVALS})")
def file_round_trip(t):
    """A frame written to files and replayed."""
    path = scratch_dir(t.spark, "frame")
    f = t.intervals("event_id", "user_id")
    f.write(path)
    return ingress.from_files(t.spark, path, schema=f.df.schema)


@query("sharded_file_round_trip", f"SELECT event_id, event_type, vs, ve FROM ({INTERVALS})")
def sharded_file_round_trip(t):
    """One folder of files per event type; reading keeps the partition column."""
    path = scratch_dir(t.spark, "frame")
    t.intervals("event_id", "event_type").write(path, partition_by=["event_type"])
    return ingress.from_files(t.spark, path).select("event_id", "event_type")


@query("to_events", f"SELECT event_id, vs, ve FROM ({HOURLY})")
def to_events(t):
    return t.hourly("event_id").to_events("event_id")


@query("to_rows", f"SELECT event_id, vs // 1000 AS start_ms, (ve - vs) // {HOUR} AS hours FROM ({INTERVALS})")
def to_rows(t):
    """Result rows from start, end and payload."""
    return t.intervals().to_rows(
        event_id="event_id", start_ms=F.expr("vs div 1000"), hours=F.expr(f"(ve - vs) div {HOUR}")
    )


@query("to_rows_with_key", f"SELECT user_id AS who, event_id, vs AS since FROM ({INTERVALS})")
def to_rows_with_key(t):
    return t.intervals().group_by("user_id").to_rows(who="user_id", event_id="event_id", since="vs")


@query("to_table", f"SELECT event_id, user_id, event_type, cents FROM ({INTERVALS})")
def to_table(t):
    """Payload without time."""
    return t.intervals().to_table()


@query(
    "to_arrays",
    f"""SELECT user_id, (rn - 1) // 10 AS chunk, array_to_string(list(CAST(event_id AS VARCHAR) ORDER BY rn), ',') AS ids
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY vs, event_id) AS rn FROM ({HOURLY})) GROUP BY ALL""",
)
def to_arrays(t):
    """Arrays of ten consecutive rows per user."""
    df = t.hourly("event_id", "user_id").group_by("user_id").to_arrays(10, tie="event_id")
    ids = F.array_join(F.transform("items", lambda x: x["event_id"].cast("string")), ",")
    return df.select("user_id", F.col("chunk").cast("bigint").alias("chunk"), ids.alias("ids"))


AT = 1705276800000000


@query(
    "as_of",
    f"SELECT event_id, user_id, event_type, cents FROM ({INTERVALS}) WHERE vs <= {AT} AND ve > {AT}",
)
def as_of(t):
    """The state at one moment."""
    return t.intervals().as_of(AT)


@query("cache", f"SELECT event_id, vs, ve FROM ({INTERVALS}) UNION ALL SELECT event_id, vs, ve FROM ({INTERVALS})")
def cache(t):
    """Materialised once, used twice."""
    f = t.intervals("event_id").cache()
    return f.union(f)


@query("cache_first_rows", f"SELECT event_id, user_id, vs, ve FROM ({INTERVALS}) ORDER BY vs, ve, event_id LIMIT 200")
def cache_first_rows(t):
    """Only the first rows in time are kept."""
    return t.intervals("event_id", "user_id").cache(limit=200)


@query(
    "cache_inferred",
    f"SELECT event_type, {UP} AS vs, {UP} + {6 * HOUR} AS ve, count(*) AS n FROM ({POINTS}) GROUP BY ALL",
)
def cache_inferred(t):
    """Windows whose constant length and grid are found in the data, so that a plain aggregation does."""
    f = TemporalFrame(t.points("event_type").tumbling(6 * HOUR).df, "event_type").cache(infer=True)
    assert f.props.tumbling
    return f.count()
