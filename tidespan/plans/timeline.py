"""Ordered computations on the distinct instants of each key, sliced so that no key is held by one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .slices import BEFORE, SLICE, UPTO, Cuts, carry, local


def instants(df: DataFrame, keys, time: str, cuts: Cuts, **aggs: Column) -> DataFrame:
    """One row per (key, time), pre-aggregated on the map side, laid out by (key, slice)."""
    cols = [e.alias(n) for n, e in aggs.items()]
    rows = df.groupBy(*keys, time).agg(*cols) if cols else df.select(*keys, time).distinct()
    return cuts.attach(rows, time).repartition(*keys, SLICE)


def with_neighbours(df: DataFrame, keys, time: str, prev="_prev", nxt="_next") -> DataFrame:
    """Previous and next instant of the same key."""
    df = carry(
        df,
        keys,
        {"_lo": F.min(time), "_hi": F.max(time)},
        lambda w: {"_plo": F.lag("_hi").over(w), "_nhi": F.lead("_lo").over(w)},
    )
    w = local(keys).orderBy(time)
    return (
        df.withColumn(prev, F.coalesce(F.lag(time).over(w), F.col("_plo")))
        .withColumn(nxt, F.coalesce(F.lead(time).over(w), F.col("_nhi")))
        .drop("_plo", "_nhi")
    )


def with_latest(df: DataFrame, keys, time: str, marked: Column, name: str, inclusive=True) -> DataFrame:
    """Largest `marked` value (a time, or null) at or before each row; strictly before if not inclusive."""
    df = df.withColumn("_m", marked)
    df = carry(df, keys, {"_s": F.max("_m")}, lambda w: {"_c": F.max("_s").over(w.rowsBetween(*BEFORE))})
    w = local(keys).orderBy(time).rowsBetween(*(UPTO if inclusive else BEFORE))
    return df.withColumn(name, F.greatest(F.max("_m").over(w), F.col("_c"))).drop("_m", "_c")


def with_following(df: DataFrame, keys, time: str, marked: Column, name: str, inclusive=True) -> DataFrame:
    """Smallest `marked` value (a time, or null) at or after each row; strictly after if not inclusive."""
    df = df.withColumn("_m", marked)

    def later(w):
        # the summary holds at most one row per slice, so reversing its order is cheap
        rev = w.orderBy(F.col(SLICE).desc()).rowsBetween(*BEFORE)
        return {"_c": F.min("_s").over(rev)}

    df = carry(df, keys, {"_s": F.min("_m")}, later)
    w = local(keys).orderBy(F.col(time).desc()).rowsBetween(*(UPTO if inclusive else BEFORE))
    return df.withColumn(name, F.least(F.min("_m").over(w), F.col("_c"))).drop("_m", "_c")


def with_running(df: DataFrame, keys, order: str, sums: dict[str, str]) -> DataFrame:
    """Running sums of columns, in order: `sums` maps input column to output column."""
    df = carry(
        df,
        keys,
        {f"_s{i}": F.sum(c) for i, c in enumerate(sums)},
        lambda w: {
            f"_c{i}": F.sum(f"_s{i}").over(w.rowsBetween(*BEFORE)) for i, _ in enumerate(sums)
        },
    )
    w = local(keys).orderBy(order).rowsBetween(*UPTO)
    run = [(F.sum(c).over(w) + F.coalesce(F.col(f"_c{i}"), F.lit(0))).alias(o) for i, (c, o) in enumerate(sums.items())]
    return df.select("*", *run).drop(*[f"_c{i}" for i, _ in enumerate(sums)])
