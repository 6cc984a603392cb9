"""Snapshot aggregates."""

import pandas as pd
from pyspark.sql import functions as F

from tidespan.functions import aggregates as A
from tidespan.functions.time import INF, micros
from tidespan.sources import ingress

from .base import DAY, HOUR, INTERVALS, ITEMS, OPENED, POINTS, query, segments_sql

CEIL6 = f"((vs + {6 * HOUR} - 1) // {6 * HOUR} * {6 * HOUR})"
CEILDAY = f"((vs + {DAY} - 1) // {DAY} * {DAY})"
TUMBLED = f"SELECT event_id, user_id, event_type, cents, {CEIL6} AS vs, {CEIL6} + {6 * HOUR} AS ve FROM ({POINTS})"
CEIL1 = f"((vs + {HOUR} - 1) // {HOUR} * {HOUR})"
HOPPED = f"SELECT event_id, user_id, event_type, cents, {CEIL1} AS vs, {CEIL1} + {6 * HOUR} AS ve FROM ({POINTS})"
SLID = f"SELECT event_id, user_id, event_type, cents, vs, vs + {2 * HOUR} AS ve FROM ({POINTS})"

NUMBERS = (
    "count(*) AS n, CAST(sum(cents) AS BIGINT) AS total, round(CAST(sum(cents) AS BIGINT) / count(*), 6) AS mean, "
    "min(cents) AS low, max(cents) AS high"
)


def numbers():
    return {
        "n": A.count(),
        "total": A.sum_("cents"),
        "mean": A.wrap(A.average("cents"), lambda x: F.round(x, 6)),
        "low": A.min_("cents"),
        "high": A.max_("cents"),
    }


@query("snapshot_general", segments_sql(INTERVALS, "user_id", NUMBERS))
def snapshot_general(t):
    """Arbitrary lifetimes per user, five aggregates."""
    return t.intervals().group_by("user_id").aggregate(**numbers())


@query("snapshot_unkeyed", segments_sql(INTERVALS, "", NUMBERS))
def snapshot_unkeyed(t):
    return t.intervals().aggregate(**numbers())


@query("snapshot_tumbling", f"SELECT event_type, vs, ve, {NUMBERS} FROM ({TUMBLED}) GROUP BY ALL")
def snapshot_tumbling(t):
    """A window per group: one plain aggregation."""
    return t.points().tumbling(6 * HOUR).group_by("event_type").aggregate(**numbers())


@query("snapshot_hopping", segments_sql(HOPPED, "event_type", NUMBERS))
def snapshot_hopping(t):
    return t.points().hopping(6 * HOUR, HOUR).group_by("event_type").aggregate(**numbers())


@query("snapshot_sliding", segments_sql(SLID, "user_id", NUMBERS))
def snapshot_sliding(t):
    return t.points().set_duration(2 * HOUR).group_by("user_id").aggregate(**numbers())


@query(
    "snapshot_running",
    f"""WITH src AS ({OPENED}),
p AS (SELECT user_id, vs, count(*) AS c, sum(cents) AS s FROM src GROUP BY ALL)
SELECT user_id, vs, coalesce(lead(vs) OVER w, {3155378975999999999}) AS ve,
  CAST(sum(c) OVER w AS BIGINT) AS n, CAST(sum(s) OVER w AS BIGINT) AS total
FROM p WINDOW w AS (PARTITION BY user_id ORDER BY vs)""",
)
def snapshot_running(t):
    """Open-ended rows: a running aggregate."""
    return t.opened().group_by("user_id").aggregate(n=A.count(), total=A.sum_("cents"))


@query(
    "running_min_max",
    f"""WITH src AS ({OPENED}),
p AS (SELECT event_type, vs, min(cents) AS lo, max(cents) AS hi FROM src GROUP BY ALL)
SELECT event_type, vs, coalesce(lead(vs) OVER w, {3155378975999999999}) AS ve, min(lo) OVER w AS low, max(hi) OVER w AS high
FROM p WINDOW w AS (PARTITION BY event_type ORDER BY vs)""",
)
def running_min_max(t):
    """Extremes over open-ended rows: long lifetimes, few blocks each."""
    return t.opened().group_by("event_type").aggregate(low=A.min_("cents"), high=A.max_("cents"))


@query(
    "count_by_return_flag",
    f"""WITH src AS ({ITEMS}),
p AS (SELECT l_returnflag, vs, count(*) AS c FROM src GROUP BY ALL)
SELECT l_returnflag, vs, coalesce(lead(vs) OVER w, {3155378975999999999}) AS ve, CAST(sum(c) OVER w AS BIGINT) AS n
FROM p WINDOW w AS (PARTITION BY l_returnflag ORDER BY vs)""",
)
def count_by_return_flag(t):
    """Three groups only, each a third of all line items: groups are split over time slices."""
    return t.items().group_aggregate("l_returnflag", n=A.count())


@query(
    "multi_aggregate",
    segments_sql(
        INTERVALS,
        "",
        "count(*) AS n, CAST(sum(cents) AS BIGINT) AS total, max(cents) - min(cents) AS range, "
        "CAST(sum(cents * cents) AS BIGINT) AS squares",
    ),
)
def multi_aggregate(t):
    """Several aggregates merged into result columns."""
    f = t.intervals().aggregate(
        n=A.count(), total=A.sum_("cents"), lo=A.min_("cents"), hi=A.max_("cents"), squares=A.sum_squares("cents")
    )
    return f.select("n", "total", "squares", range=F.col("hi") - F.col("lo"))


@query("group_aggregate", segments_sql(INTERVALS, "event_type, user_id", "count(*) AS n, CAST(sum(cents) AS BIGINT) AS total"))
def group_aggregate(t):
    return t.intervals().group_aggregate(["event_type", "user_id"], n=A.count(), total=A.sum_("cents"))


@query(
    "group_apply",
    segments_sql(f"SELECT * FROM ({SLID}) WHERE cents > 500", "user_id", "count(*) AS n"),
)
def group_apply(t):
    """A sub-query per user: filter, reshape, aggregate."""
    return t.points().group_apply("user_id", lambda g: g.where("cents > 500").set_duration(2 * HOUR).count())


@query("nested_groups", segments_sql(INTERVALS, "event_type, user_id", "max(cents) AS top"))
def nested_groups(t):
    """Groups within groups: keys add up."""
    return t.intervals().group_apply(
        "event_type", lambda g: g.group_apply("user_id", lambda h: h.aggregate(top=A.max_("cents")))
    )


@query(
    "filtered_aggregate",
    segments_sql(
        INTERVALS,
        "user_id",
        "count(*) FILTER (WHERE event_type = 'view') AS views, "
        "CAST(coalesce(sum(cents) FILTER (WHERE event_type = 'purchase'), 0) AS BIGINT) AS spent, "
        "max(cents) FILTER (WHERE event_type = 'purchase') AS top, "
        "round(CAST(sum(cents) FILTER (WHERE event_type = 'purchase') AS BIGINT) / count(*) FILTER (WHERE event_type = 'purchase'), 6) AS mean",
    ),
)
def filtered_aggregate(t):
    """Aggregates over matching rows; snapshots follow all rows."""
    bought = F.col("event_type") == "purchase"
    return t.intervals().group_by("user_id").aggregate(
        views=A.count().where(F.col("event_type") == "view"),
        spent=A.sum_("cents").where(bought),
        top=A.max_("cents").where(bought),
        mean=A.wrap(A.average("cents").where(bought), lambda x: F.round(x, 6)),
    )


@query(
    "distinct",
    f"""WITH src AS (SELECT user_id, event_type, vs, ve FROM ({INTERVALS})),
pts AS (SELECT user_id, event_type, vs AS t FROM src UNION SELECT user_id, event_type, ve FROM src),
seg AS (SELECT user_id, event_type, t AS vs, lead(t) OVER (PARTITION BY user_id, event_type ORDER BY t) AS ve FROM pts)
SELECT s.* FROM seg s WHERE ve IS NOT NULL AND EXISTS (
  SELECT 1 FROM src e WHERE e.user_id = s.user_id AND e.event_type = s.event_type AND e.vs <= s.vs AND e.ve > s.vs)""",
)
def distinct(t):
    return t.intervals("user_id", "event_type").distinct()


@query(
    "distinct_by",
    f"""WITH src AS (SELECT user_id % 10 AS bucket, vs, ve FROM ({INTERVALS})),
pts AS (SELECT bucket, vs AS t FROM src UNION SELECT bucket, ve FROM src),
seg AS (SELECT bucket, t AS vs, lead(t) OVER (PARTITION BY bucket ORDER BY t) AS ve FROM pts)
SELECT s.* FROM seg s WHERE ve IS NOT NULL AND EXISTS (
  SELECT 1 FROM src e WHERE e.bucket = s.bucket AND e.vs <= s.vs AND e.ve > s.vs)""",
)
def distinct_by(t):
    return t.intervals().distinct_by(bucket=F.col("user_id") % 10)


@query(
    "two_stream_aggregate",
    segments_sql(
        f"""SELECT user_id, cents, 0 AS side, vs, ve FROM ({INTERVALS}) WHERE event_type = 'purchase'
UNION ALL SELECT user_id, cents, 1, vs, ve FROM ({SLID}) WHERE event_type = 'view'""",
        "user_id",
        "count(*) FILTER (WHERE side = 0) AS bought, count(*) FILTER (WHERE side = 1) AS viewed, "
        "CAST(coalesce(sum(cents) FILTER (WHERE side = 0), 0) AS BIGINT) AS spent",
    ),
)
def two_stream_aggregate(t):
    """One aggregate over two streams."""
    bought = t.intervals().where("event_type = 'purchase'").group_by("user_id")
    viewed = t.points().where("event_type = 'view'").set_duration(2 * HOUR).group_by("user_id")
    first, second = F.col("side") == 0, F.col("side") == 1
    return bought.aggregate_with(
        viewed,
        bought=A.count().where(first),
        viewed=A.count().where(second),
        spent=A.sum_("cents").where(first),
    )


NULLABLE = f"SELECT *, CASE WHEN event_id % 11 <> 0 THEN cents END AS maybe FROM ({INTERVALS})"


def nullable(t):
    return t.intervals().select("event_id", "user_id", maybe=F.when(F.col("event_id") % 11 != 0, F.col("cents")))


@query("count_not_null", segments_sql(NULLABLE, "user_id", "count(*) AS n, count(maybe) AS n_maybe"))
def count_not_null(t):
    return nullable(t).group_by("user_id").aggregate(n=A.count(), n_maybe=A.count_not_null("maybe"))


@query(
    "null_policies",
    segments_sql(
        NULLABLE,
        "user_id",
        "CAST(coalesce(sum(maybe), 0) AS BIGINT) AS zero_when_empty, CAST(sum(maybe) AS BIGINT) AS null_when_empty, "
        "coalesce(max(maybe), -1) AS default_when_empty, min(maybe) AS low",
    ),
)
def null_policies(t):
    """Nulls are skipped; an empty input gives the initial value, null, or a default."""
    return nullable(t).group_by("user_id").aggregate(
        zero_when_empty=A.skip_nulls(A.sum_("maybe"), "maybe"),
        null_when_empty=A.null_when_empty(A.sum_("maybe"), "maybe"),
        default_when_empty=A.or_default(A.max_("maybe"), -1),
        low=A.min_("maybe"),
    )


@query("count", segments_sql(INTERVALS, "", "count(*) AS n"))
def count(t):
    return t.intervals().count()


@query("sum", segments_sql(INTERVALS, "event_type", "CAST(sum(cents) AS BIGINT) AS total"))
def total(t):
    return t.intervals().group_by("event_type").aggregate(total=A.sum_("cents"))


@query(
    "sum_decimal",
    segments_sql(
        f"SELECT *, CAST(cents AS DECIMAL(18,2)) / 1 AS amount FROM ({INTERVALS})",
        "event_type",
        "CAST(sum(CAST(cents AS BIGINT)) AS BIGINT) AS total",
    ),
)
def sum_decimal(t):
    """Decimal input: snapshots add up exactly."""
    f = t.intervals().select("event_type", amount=(F.col("cents").cast("decimal(18,2)") / 100).cast("decimal(18,2)"))
    out = f.group_by("event_type").aggregate(total=A.sum_("amount"))
    return out.select(total=(F.col("total") * 100).cast("bigint"))


@query("sum_squares", segments_sql(INTERVALS, "event_type", "CAST(sum(cents * cents) AS BIGINT) AS squares"))
def sum_squares(t):
    return t.intervals().group_by("event_type").aggregate(squares=A.sum_squares("cents"))


@query(
    "complex_sum",
    segments_sql(INTERVALS, "event_type", "CAST(sum(cents) AS BIGINT) AS re, CAST(sum(event_id) AS BIGINT) AS im"),
)
def complex_sum(t):
    """Complex numbers as structs."""
    f = t.intervals().select("event_type", z=F.struct(F.col("cents").alias("re"), F.col("event_id").alias("im")))
    return f.group_by("event_type").aggregate(z=A.complex_sum("z")).select(re="z.re", im="z.im")


@query(
    "product",
    segments_sql(
        f"SELECT *, event_id % 3 AS factor FROM ({INTERVALS})",
        "user_id",
        "CAST(product(factor) AS BIGINT) AS prod",
    ),
)
def product(t):
    """Zeros included: nothing is divided."""
    f = t.intervals().select("user_id", factor=F.col("event_id") % 3)
    return f.group_by("user_id").aggregate(prod=A.wrap(A.product("factor"), lambda x: x.cast("bigint")))


@query("average", segments_sql(INTERVALS, "event_type", "round(CAST(sum(cents) AS BIGINT) / count(*), 6) AS mean"))
def average(t):
    mean = A.wrap(A.average("cents"), lambda x: F.round(x, 6))
    return t.intervals().group_by("event_type").aggregate(mean=mean)


@query(
    "average_squares",
    segments_sql(INTERVALS, "event_type", "round(CAST(sum(cents * cents) AS BIGINT) / count(*), 4) AS mean_square"),
)
def average_squares(t):
    mean = A.wrap(A.average_squares("cents"), lambda x: F.round(x, 4))
    return t.intervals().group_by("event_type").aggregate(mean_square=mean)


@query("minimum", segments_sql(INTERVALS, "event_type", "min(cents) AS low"))
def minimum(t):
    return t.intervals().group_by("event_type").aggregate(low=A.min_("cents"))


@query(
    "minimum_by_order",
    segments_sql(INTERVALS, "user_id", "arg_min(event_id, ROW(cents % 100, event_id)) AS low_event"),
)
def minimum_by_order(t):
    """A custom order, given as a sort key."""
    return t.intervals().group_by("user_id").aggregate(low_event=A.min_by("event_id", F.col("cents") % 100))


@query("maximum", segments_sql(INTERVALS, "event_type", "max(cents) AS high"))
def maximum(t):
    return t.intervals().group_by("event_type").aggregate(high=A.max_("cents"))


@query(
    "maximum_by_order",
    segments_sql(INTERVALS, "user_id", "arg_max(event_id, ROW(length(event_type), event_id)) AS high_event"),
)
def maximum_by_order(t):
    return t.intervals().group_by("user_id").aggregate(high_event=A.max_by("event_id", F.length("event_type")))


def top_sql(source, keys, k, order):
    inner = segments_sql(source, keys, "1").split("SELECT " + (f"s.{keys}, " if keys else "") + "s.vs")[0]
    part = f"s.{keys}, s.vs" if keys else "s.vs"
    same = f"s.{keys} = e.{keys} AND " if keys else ""
    lead = f"s.{keys}, " if keys else ""
    return f"""{inner}
SELECT * FROM (SELECT {lead}s.vs, s.ve, rank() OVER (PARTITION BY {part} ORDER BY {order}) AS rank, e.event_id, e.cents
FROM seg s JOIN src e ON {same}e.vs <= s.vs AND e.ve > s.vs) WHERE rank <= {k}"""


@query("top_k", top_sql(INTERVALS, "", 3, "e.cents DESC"))
def top_k(t):
    return t.intervals("event_id", "cents").top_k(3, "cents")


@query(
    "top_k_ties",
    top_sql(INTERVALS, "user_id", 2, "e.cents // 1000 DESC"),
)
def top_k_ties(t):
    """Coarse order: many ties, all kept."""
    f = t.intervals("event_id", "user_id", "cents").group_by("user_id")
    return f.top_k(2, F.expr("cents div 1000"))


@query("bottom_k", top_sql(INTERVALS, "user_id", 2, "e.cents"))
def bottom_k(t):
    """Reversed order."""
    return t.intervals("event_id", "user_id", "cents").group_by("user_id").top_k(2, "cents", ascending=True)


@query(
    "top_k_lists",
    f"""SELECT user_id, vs, ve, CAST(list(cents ORDER BY rank, cents) AS VARCHAR) AS best
FROM ({top_sql(INTERVALS, "user_id", 3, "e.cents DESC")}) GROUP BY ALL""",
)
def top_k_lists(t):
    """Ranked lists as one array per snapshot."""
    f = t.intervals("user_id", "cents").group_by("user_id").top_k_lists(3, "cents")
    values = F.transform("top", lambda x: x["payload"]["cents"].cast("string"))
    return f.select(best=F.concat(F.lit("["), F.array_join(values, ", "), F.lit("]")))


@query(
    "percentile_continuous",
    segments_sql(INTERVALS, "event_type", "round(quantile_cont(CAST(cents AS DOUBLE), 0.6), 4) AS p60"),
)
def percentile_continuous(t):
    p = A.wrap(A.percentile_continuous("cents", 0.6), lambda x: F.round(x, 4))
    return t.intervals().group_by("event_type").aggregate(p60=p)


@query(
    "percentile_discrete",
    segments_sql(
        INTERVALS,
        "user_id",
        "quantile_disc(cents, 0.6) AS p60, percentile_disc(0.4) WITHIN GROUP (ORDER BY cents DESC) AS p40_down",
    ),
)
def percentile_discrete(t):
    return t.intervals().group_by("user_id").aggregate(
        p60=A.percentile_discrete("cents", 0.6), p40_down=A.percentile_discrete("cents", 0.4, descending=True)
    )


@query(
    "percentile_tumbling",
    f"SELECT event_type, vs, ve, round(quantile_cont(CAST(cents AS DOUBLE), 0.9), 4) AS p90 FROM ({TUMBLED}) GROUP BY ALL",
)
def percentile_tumbling(t):
    p = A.wrap(A.percentile_continuous("cents", 0.9), lambda x: F.round(x, 4))
    return t.points().tumbling(6 * HOUR).group_by("event_type").aggregate(p90=p)


def spread_sql(pairs):
    """Variance and its root as exact fractions of integers; null where the divisor is zero."""
    n = pairs.replace("n", "count(*)")
    num = "CAST(count(*) * sum(CAST(cents AS HUGEINT) * cents) - sum(CAST(cents AS HUGEINT)) * sum(CAST(cents AS HUGEINT)) AS DOUBLE)"
    var = f"{num} / nullif({n}, 0)"
    return f"round(sqrt({var}), 2) AS sd, round({var}, 2) AS var"


def rounded(agg):
    return A.wrap(agg, lambda x: F.round(x, 2))


@query(
    "deviation_sample",
    segments_sql(INTERVALS, "event_type", spread_sql("n * (n - 1)")),
)
def deviation_sample(t):
    """Null for a single value."""
    return t.intervals().group_by("event_type").aggregate(
        sd=rounded(A.stddev("cents")), var=rounded(A.variance("cents"))
    )


@query(
    "deviation_population",
    segments_sql(INTERVALS, "event_type", spread_sql("n * n")),
)
def deviation_population(t):
    return t.intervals().group_by("event_type").aggregate(
        sd=rounded(A.population_stddev("cents")), var=rounded(A.population_variance("cents"))
    )


@query(
    "single_or_default",
    f"""WITH src AS (SELECT user_id, event_id, vs, coalesce(lead(vs) OVER (PARTITION BY user_id ORDER BY vs), 3155378975999999999) AS ve FROM ({OPENED}))
SELECT user_id, vs, ve, event_id AS only FROM src""",
)
def single_or_default(t):
    """The one active row of a signal."""
    f = t.opened("event_id", "user_id").group_by("user_id").as_signal()
    return f.aggregate(only=A.single_or_default("event_id"))


@query(
    "user_aggregate_sums",
    segments_sql(
        INTERVALS,
        "event_type",
        "round(CAST(sum(cents * (event_id % 5 + 1)) AS BIGINT) / CAST(sum(event_id % 5 + 1) AS BIGINT), 6) AS weighted",
    ),
)
def user_aggregate_sums(t):
    """A weighted mean: two sums that can be undone, and a final expression."""
    weight = F.col("event_id") % 5 + 1
    agg = A.user_aggregate(
        {"num": F.col("cents") * weight, "den": weight}, lambda p: F.round(p["num"] / p["den"], 6)
    )
    return t.intervals().group_by("event_type").aggregate(weighted=agg)


@query(
    "user_aggregate_merge",
    segments_sql(INTERVALS, "user_id", "max(cents) - min(cents) AS spread, bool_and(event_type <> 'error') AS clean"),
)
def user_aggregate_merge(t):
    """States that merge but cannot be undone."""
    spread = A.user_aggregate(
        {"lo": "cents", "hi": "cents"}, lambda p: p["hi"] - p["lo"], merge={"lo": F.min, "hi": F.max}
    )
    clean = A.user_aggregate(
        {"ok": F.col("event_type") != "error"}, lambda p: p["ok"], merge={"ok": F.bool_and}
    )
    return t.intervals().group_by("user_id").aggregate(spread=spread, clean=clean)


@query(
    "user_aggregate_fold",
    segments_sql(
        INTERVALS,
        "user_id",
        "CAST(list_reduce(list_prepend(0::BIGINT, list_sort(list(cents))), lambda a, b: (a * 31 + b) % 1000003) AS BIGINT) AS folded",
    ),
)
def user_aggregate_fold(t):
    """A fold over the ordered active values."""
    fold = A.user_fold("cents", F.lit(0).cast("bigint"), lambda a, x: (a * 31 + x) % 1000003, lambda a: a)
    return t.intervals().group_by("user_id").aggregate(folded=fold)


@query(
    "user_aggregate_pandas",
    segments_sql(INTERVALS, "user_id", "max(cents) - min(cents) AS spread"),
)
def user_aggregate_pandas(t):
    """An opaque function over the active values of each snapshot."""

    def spread(v: pd.Series) -> int:
        return int(v.max() - v.min())

    return t.intervals().group_by("user_id").aggregate_pandas(spread, "cents", "bigint", "spread")


@query(
    "collect_values",
    segments_sql(
        INTERVALS, "user_id", "array_to_string(list_transform(list_sort(list(cents)), lambda x: CAST(x AS VARCHAR)), ',') AS vals"
    ),
)
def collect_values(t):
    """All active values of a snapshot."""
    return t.intervals().group_by("user_id").aggregate(
        vals=A.wrap(A.collect("cents"), lambda x: F.array_join(F.transform(x, lambda v: v.cast("string")), ","))
    )


@query(
    "partial_and_final_count",
    f"SELECT vs, ve, count(*) AS n FROM (SELECT {CEILDAY} AS vs, {CEILDAY} + {DAY} AS ve FROM ({POINTS})) GROUP BY ALL",
)
def partial_and_final_count(t):
    """Counts per map task, then summed: Spark's own partial aggregation."""
    return t.points("event_id").tumbling(DAY).count()


# Doubles: the raw values, very small ones, large ones with small differences, and now and then an infinity.
DOUBLES = (
    "SELECT event_type, value, value / 1e7 AS tiny, 1e12 + value AS large, "
    "CASE WHEN event_id % 500 = 0 THEN 'infinity'::DOUBLE ELSE value END AS wild, "
    f"vs, ve FROM (SELECT *, epoch_us(ts) AS vs, epoch_us(ts) + (1 + event_id % 7) * {HOUR} AS ve FROM events)"
)


def doubles(t):
    vs = micros("ts")
    wild = F.when(F.col("event_id") % 500 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    df = t.read("events").withColumns(
        {"tiny": F.col("value") / 1e7, "large": F.lit(1e12) + F.col("value"), "wild": wild}
    )
    f = ingress.from_intervals(df, vs, vs + (F.lit(1) + F.pmod("event_id", F.lit(7))) * HOUR, check=False)
    return f.select("event_type", "value", "tiny", "large", "wild")


def near(digits):
    return lambda x: F.round(x, digits)


@query(
    "sum_doubles",
    segments_sql(
        DOUBLES,
        "event_type",
        "round(sum(value), 5) AS total, round(avg(value), 6) AS mean, round(sum(value * value), 6) AS squares, "
        "isinf(sum(wild)) AS endless, round(sum(value) FILTER (WHERE value > 50), 5) AS high",
    ),
)
def sum_doubles(t):
    """Sums of doubles, after an infinity has come and gone too."""
    out = doubles(t).group_by("event_type").aggregate(
        total=A.wrap(A.sum_("value"), near(5)),
        mean=A.wrap(A.average("value"), near(6)),
        squares=A.wrap(A.sum_squares("value"), near(6)),
        endless=A.sum_("wild"),
        high=A.wrap(A.null_when_empty(A.sum_("value").where(F.col("value") > 50), "value"), near(5)),
    )
    return out.select("total", "mean", "squares", "high", endless=F.col("endless") == float("inf"))


@query(
    "spread_doubles",
    segments_sql(
        DOUBLES,
        "event_type",
        "round(stddev_samp(value), 6) AS sd, abs(var_pop(tiny) * 1e14 - var_pop(value)) < 1e-6 AS small, abs(stddev_pop(large) - stddev_pop(value)) < 0.01 AS big",
    ),
)
def spread_doubles(t):
    """Variances of doubles of all magnitudes."""
    out = doubles(t).group_by("event_type").aggregate(
        sd=A.wrap(A.stddev("value"), near(6)),
        small=A.wrap(A.population_variance("tiny"), lambda x: x * 1e14),
        big=A.population_stddev("large"),
        plain=A.population_stddev("value"),
    )
    small = F.abs(F.col("small") - F.col("plain") * F.col("plain")) < 1e-6
    return out.select("sd", small=small, big=F.abs(F.col("big") - F.col("plain")) < 0.01)


@query(
    "spread_doubles_tumbling",
    f"""SELECT event_type, vs, vs + {DAY} AS ve, round(stddev_samp(value), 6) AS sd FROM (
  SELECT event_type, value, (epoch_us(ts) + {DAY} - 1) // {DAY} * {DAY} AS vs FROM events) GROUP BY event_type, vs""",
)
def spread_doubles_tumbling(t):
    f = ingress.from_points(t.read("events"), micros("ts")).select("event_type", "value")
    return f.tumbling(DAY).group_by("event_type").aggregate(sd=A.wrap(A.stddev("value"), near(6)))


ORDERED = f"SELECT event_type, user_id, value, CAST(ts AS DATE) AS day, vs, ve FROM (SELECT *, epoch_us(ts) AS vs, epoch_us(ts) + (1 + event_id % 7) * {HOUR} AS ve FROM events)"


@query(
    "percentile_ordered_types",
    segments_sql(
        ORDERED,
        "",
        "quantile_disc(event_type, 0.5) AS name, quantile_disc(day, 0.5) AS day, quantile_disc(value, 0.3) AS value",
    ),
)
def percentile_ordered_types(t):
    """Discrete percentiles of texts, dates and fractions, without a key."""
    vs = micros("ts")
    df = t.read("events").withColumn("day", F.to_date("ts"))
    f = ingress.from_intervals(df, vs, vs + (F.lit(1) + F.pmod("event_id", F.lit(7))) * HOUR, check=False)
    return f.select("event_type", "value", "day").aggregate(
        name=A.percentile_discrete("event_type", 0.5),
        day=A.percentile_discrete("day", 0.5),
        value=A.percentile_discrete("value", 0.3),
    )


@query(
    "percentile_tumbling_text",
    f"""SELECT vs, vs + {DAY} AS ve, count(*) AS n, quantile_disc(event_type, 0.4) AS name FROM (
  SELECT event_type, (epoch_us(ts) + {DAY} - 1) // {DAY} * {DAY} AS vs FROM events) GROUP BY vs""",
)
def percentile_tumbling_text(t):
    """Without a key, a window may hold most rows: no window's values are listed."""
    f = ingress.from_points(t.read("events"), micros("ts")).select("event_type")
    return f.tumbling(DAY).aggregate(n=A.count(), name=A.percentile_discrete("event_type", 0.4))


@query(
    "extremes_open",
    f"""SELECT vs, coalesce(lead(vs) OVER (ORDER BY vs), {INF}) AS ve, min(lo) OVER w AS lo, max(hi) OVER w AS hi,
  max(late) OVER w AS late FROM (
  SELECT vs, min(cents) AS lo, max(cents) AS hi, max(event_type) AS late FROM ({OPENED}) GROUP BY vs)
WINDOW w AS (ORDER BY vs ROWS UNBOUNDED PRECEDING)""",
)
def extremes_open(t):
    """Rows that never end: extremes run along time, without a key."""
    return t.opened().aggregate(lo=A.min_("cents"), hi=A.max_("cents"), late=A.max_("event_type"))
