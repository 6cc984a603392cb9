"""Edge sweep for aggregates that can be undone: add at the start, subtract at the end, sum along time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.time import INF
from .slices import BEFORE, UPTO, Cuts, carry, local
from .timeline import instants

ACTIVE = "_active"


def edges(df: DataFrame, keys, deltas: dict[str, Column]) -> DataFrame:
    """Two signed rows per finite lifetime, one per open lifetime, from a single scan."""
    rows = df.select(
        *keys,
        *[F.coalesce(e, F.lit(0)).alias(n) for n, e in deltas.items()],
        F.explode(
            F.array(
                F.struct(F.col("vs").alias("t"), F.lit(1).alias("sign")),
                F.struct(F.col("ve").alias("t"), F.lit(-1).alias("sign")),
            )
        ).alias("_e"),
    )
    rows = rows.where(F.col("_e.t") < INF)
    return rows.select(
        *keys,
        F.col("_e.t").alias("_t"),
        F.col("_e.sign").cast("long").alias(ACTIVE),
        *[(F.col(n) * F.col("_e.sign")).alias(n) for n in deltas],
    )


def sweep(df: DataFrame, keys, deltas: dict[str, Column], cuts: Cuts, keep_idle=False) -> DataFrame:
    """Snapshot segments (keys, vs, ve, `_active`, one running sum per delta).

    A segment starts at every instant where some lifetime of the key starts or ends. Segments without active
    rows are dropped unless `keep_idle`.
    """
    names = [ACTIVE, *deltas]
    signed = edges(df, keys, deltas)
    tl = instants(signed, keys, "_t", cuts, **{n: F.sum(n) for n in names})
    tl = carry(
        tl,
        keys,
        {"_first": F.min("_t"), **{f"_s{i}": F.sum(n) for i, n in enumerate(names)}},
        lambda w: {
            "_nextfirst": F.lead("_first").over(w),
            **{f"_c{i}": F.sum(f"_s{i}").over(w.rowsBetween(*BEFORE)) for i, _ in enumerate(names)},
        },
    )
    w = local(keys).orderBy("_t")
    run = w.rowsBetween(*UPTO)
    out = tl.select(
        *keys,
        F.col("_t").alias("vs"),
        F.coalesce(F.lead("_t").over(w), F.col("_nextfirst"), F.lit(INF)).alias("ve"),
        *[
            (F.sum(n).over(run) + F.coalesce(F.col(f"_c{i}"), F.lit(0))).alias(n)
            for i, n in enumerate(names)
        ],
    )
    return out if keep_idle else out.where(F.col(ACTIVE) > 0)
