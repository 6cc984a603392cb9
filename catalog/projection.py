"""Filter, projection, flat-map, pivot, unpivot."""

import pandas as pd
from pyspark.sql import functions as F

from tidespan.functions import aggregates as A

from .base import DAY, INTERVALS, POINTS, query, segments_sql

TYPES = ["click", "error", "purchase", "signup", "view"]


@query("where", f"SELECT event_id, cents, vs, ve FROM ({POINTS}) WHERE event_type = 'view' AND cents > 1000")
def where(t):
    f = t.points().where((F.col("event_type") == "view") & (F.col("cents") > 1000))
    return f.select("event_id", "cents")


@query("select", f"SELECT event_id, cents * 2 AS doubled, vs, ve FROM ({POINTS})")
def select(t):
    return t.points().select("event_id", doubled=F.col("cents") * 2)


@query("select_with_start", f"SELECT event_id, vs % {DAY} AS time_of_day, vs, ve FROM ({POINTS})")
def select_with_start(t):
    return t.points().select("event_id", time_of_day=F.col("vs") % DAY)


@query("select_by_key", f"SELECT user_id, event_id, user_id * 10 + 1 AS tag, vs, ve FROM ({POINTS})")
def select_by_key(t):
    return t.points().group_by("user_id").select("event_id", tag=F.col("user_id") * 10 + 1)


@query("select_by_key_and_start", f"SELECT user_id, event_id, vs % (user_id + 1) AS tag, vs, ve FROM ({POINTS})")
def select_by_key_and_start(t):
    return t.points().group_by("user_id").select("event_id", tag=F.col("vs") % (F.col("user_id") + 1))


@query(
    "adjust_columns",
    f"SELECT event_id, cents + 1 AS cents, upper(event_type) AS event_type, CAST(NULL AS VARCHAR) AS note, vs, ve FROM ({POINTS})",
)
def adjust_columns(t):
    """Same-named columns copied, two overridden, a missing one null."""
    f = t.points().adjust(
        ["event_id", "cents", "event_type", "note"], cents=F.col("cents") + 1, event_type=F.upper("event_type")
    )
    return f._with(f.df.withColumn("note", F.col("note").cast("string")))


@query(
    "flat_map",
    f"SELECT event_id, unnest(range(event_id % 4)) AS i, vs, ve FROM ({POINTS})",
)
def flat_map(t):
    n = F.pmod("event_id", F.lit(4))
    counted = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    return t.points().flat_map(counted, "i", keep=["event_id"])


@query(
    "flat_map_with_start",
    f"SELECT event_id, unnest([vs % 10, vs % 100]) AS m, vs, ve FROM ({POINTS})",
)
def flat_map_with_start(t):
    return t.points().flat_map(F.array(F.col("vs") % 10, F.col("vs") % 100), "m", keep=["event_id"])


@query(
    "flat_map_by_key",
    f"SELECT user_id, event_id, unnest([user_id, user_id + vs % 7]) AS m, vs, ve FROM ({POINTS})",
)
def flat_map_by_key(t):
    made = F.array(F.col("user_id"), F.col("user_id") + F.col("vs") % 7)
    return t.points().group_by("user_id").flat_map(made, "m", keep=["event_id"])


@query(
    "flat_map_pandas",
    f"SELECT event_id, unnest([cents, -cents]) AS signed, vs, ve FROM ({POINTS})",
)
def flat_map_pandas(t):
    def both(pdf):
        return pd.concat([pdf, pdf.assign(signed=-pdf["signed"])])

    f = t.points().select("event_id", signed=F.col("cents"))
    return f.flat_map_pandas(both, f.df.schema)


@query(
    "flat_map_words",
    "SELECT doc_id, w, doc_id AS vs, doc_id + 1 AS ve FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents)",
)
def flat_map_words(t):
    from tidespan.sources import ingress

    f = ingress.from_points(t.read("documents").select("doc_id", "text"), "doc_id")
    return f.flat_map(F.split("text", " "), "w", keep=["doc_id"])


@query(
    "user_table_function",
    f"SELECT event_id, vs, ve, unnest([cents // 100, cents % 100]) AS piece FROM ({POINTS})",
)
def user_table_function(t):
    from pyspark.sql.functions import udtf

    @udtf(returnType="piece: bigint")
    class Pieces:
        def eval(self, cents: int):
            yield (cents // 100,)
            yield (cents % 100,)

    f = t.points("event_id", "cents").flat_map_table(Pieces, ["cents"], ["piece"])
    return f.select("event_id", "piece")


@query(
    "user_function",
    f"SELECT event_id, CAST(round(ln(1 + cents) * 1000) AS BIGINT) AS score, vs, ve FROM ({POINTS})",
)
def user_function(t):
    import numpy as np

    @F.pandas_udf("bigint")
    def score(cents: pd.Series) -> pd.Series:
        return np.floor(np.log1p(cents) * 1000 + 0.5).astype("int64")

    return t.points().select("event_id", score=score("cents"))


PIVOTED = ", ".join(f"CAST(sum(cents) FILTER (WHERE event_type = '{x}') AS BIGINT) AS \"{x}\"" for x in TYPES)


@query("pivot", segments_sql(INTERVALS, "user_id", PIVOTED.replace("sum(cents)", "max(cents)")))
def pivot(t):
    """One column per event type, as one snapshot aggregate."""
    return t.intervals().pivot("user_id", "event_type", "cents", TYPES, A.max_)


CEILDAY = f"((vs + {DAY} - 1) // {DAY} * {DAY})"


@query(
    "pivot_tumbling",
    f"SELECT user_id, {CEILDAY} AS vs, {CEILDAY} + {DAY} AS ve, "
    + ", ".join(f"CAST(coalesce(sum(cents) FILTER (WHERE event_type = '{x}'), 0) AS BIGINT) AS \"{x}\"" for x in TYPES)
    + f" FROM ({POINTS}) GROUP BY ALL",
)
def pivot_tumbling(t):
    return t.points().tumbling(DAY).pivot("user_id", "event_type", "cents", TYPES, A.sum_)


@query(
    "unpivot",
    f"""SELECT event_id, attribute, value, vs, ve FROM (
SELECT event_id, vs, ve, unnest(['user_id', 'cents', 'odd']) AS attribute,
  unnest([user_id, CASE WHEN event_id % 11 <> 0 THEN cents END, CASE WHEN event_id % 2 = 1 THEN event_id END]) AS value
FROM ({POINTS})) WHERE value IS NOT NULL""",
)
def unpivot(t):
    """Columns to rows, nulls skipped."""
    f = t.points().select(
        "event_id",
        "user_id",
        cents=F.when(F.col("event_id") % 11 != 0, F.col("cents")),
        odd=F.when(F.col("event_id") % 2 == 1, F.col("event_id")),
    )
    return f.unpivot(["event_id"], ["user_id", "cents", "odd"])


@query(
    "comprehension",
    f"""SELECT a.user_id, CAST(a.event_type AS VARCHAR) AS a_type, b.event_type AS b_type,
  greatest(a.vs, b.vs) AS vs, least(a.ve, b.ve) AS ve
FROM ({INTERVALS}) a JOIN ({INTERVALS}) b ON a.user_id = b.user_id AND a.vs < b.ve AND b.vs < a.ve
WHERE a.event_type = 'signup' AND b.event_type = 'purchase'""",
)
def comprehension(t):
    """from a … join b on user where … select: query syntax is just method calls."""
    a = t.intervals("user_id", "event_type").where("event_type = 'signup'").select("user_id", a_type="event_type")
    b = t.intervals("user_id", "event_type").where("event_type = 'purchase'").select("user_id", b_type="event_type")
    return a.join(b, "user_id")


