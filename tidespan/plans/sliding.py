"""Lifetimes of one constant duration: what is active at an instant, as two merges, without retraction or trees.

Time is cut into blocks as long as a lifetime. At an instant, the active rows are those of its block that have started,
and those of the block before that have not ended yet. A row ends exactly one block after it has started, so with starts
and ends on one timeline both are running merges inside a block: of starts from its beginning on, and of ends back from
its end. That is linear in the rows, holds for every merge, and never takes anything away again. Rows that start at the
same instant (of hopping windows: all rows of a pane) are merged before they are shuffled.

Blocks longer than a slice are carried on from slice to slice, and slices may hold many blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .slices import BEFORE, SLICE, UPTO, Cuts, carry, local, match
from .timeline import instants

BLOCK, COUNT = "_block", "_active"
AFTER = (1, Window.unboundedFollowing)


def _added(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


#: Merges of two states for the aggregates that merge many.
MERGES = {
    F.min: lambda a, b: F.least(a, b),
    F.max: lambda a, b: F.greatest(a, b),
    F.sum: _added,
    F.product: lambda a, b: F.coalesce(a * b, a, b),
}


def sliding(df: DataFrame, keys, duration: int, parts: dict[str, Column], merges: dict, cuts: Cuts) -> DataFrame:
    """Snapshot segments (keys, vs, ve, one merged state per part) of rows that all live for `duration`.

    `merges` has an aggregate of `MERGES` for each part.
    """
    merges = {**merges, COUNT: F.sum}
    rows = df.select(*keys, "vs", *[c.alias(p) for p, c in parts.items()], F.lit(1).cast("long").alias(COUNT))
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def at(t: Column, side: str):
        state = [(F.col(p) if s == side else F.lit(None).cast(kinds[p])).alias(f"{s}{p}") for s in ("in", "out") for p in merges]
        return F.struct(t.alias("t"), *state)

    both = F.explode(F.array(at(F.col("vs"), "in"), at(F.col("vs") + F.lit(duration), "out"))).alias("_e")
    names = [f"{s}{p}" for s in ("in", "out") for p in merges]
    edges = rows.select(*keys, both).select(*keys, F.col("_e.t").alias("_t"), *[f"_e.{n}" for n in names])
    merge_of = {f"{s}{p}": m for s in ("in", "out") for p, m in merges.items()}
    tl = instants(edges, keys, "_t", cuts, **{n: m(n) for n, m in merge_of.items()})
    tl = carry(tl, keys, {"_first": F.min("_t")}, lambda w: {"_nextfirst": F.lead("_first").over(w)})
    tl = tl.withColumn("_ve", F.coalesce(F.lead("_t").over(local(keys).orderBy("_t")), F.col("_nextfirst")))
    tl = tl.withColumn(BLOCK, F.col("_t") - F.pmod(F.col("_t"), F.lit(duration)))
    carried = _between_slices(tl, keys, merge_of)
    group = [*keys, BLOCK, SLICE]
    tl = tl.alias("l").join(carried.alias("r"), match("l", "r", group), "left").select("l.*", *[f"r._{n}" for n in names])
    inside = local([*keys, BLOCK]).orderBy("_t")
    states = {}
    for p, m in merges.items():
        two = MERGES[m]
        begun = two(m(f"in{p}").over(inside.rowsBetween(*UPTO)), F.col(f"_in{p}"))
        going = two(m(f"out{p}").over(inside.rowsBetween(*AFTER)), F.col(f"_out{p}"))
        states[p] = two(begun, going)
    out = tl.select(*keys, F.col("_t").alias("vs"), F.col("_ve").alias("ve"), *[c.alias(p) for p, c in states.items()])
    return out.where(F.col(COUNT) > 0).drop(COUNT)


def _between_slices(tl: DataFrame, keys, merge_of) -> DataFrame:
    """For blocks that reach over several slices, what earlier slices have started and later ones end.

    Of a slice only its first and last block can do so: there are at most two rows for each key and slice.
    """
    group = [*keys, BLOCK, SLICE]
    parts = tl.groupBy(*group).agg(*[m(n).alias(n) for n, m in merge_of.items()])
    ends = Window.partitionBy(*[F.col(f"`{k}`") for k in keys], F.col(SLICE))
    outer = (F.col(BLOCK) == F.min(BLOCK).over(ends)) | (F.col(BLOCK) == F.max(BLOCK).over(ends))
    parts = parts.withColumn("_outer", outer).where("_outer")
    along = Window.partitionBy(*[F.col(f"`{k}`") for k in keys], F.col(BLOCK)).orderBy(SLICE)
    frames = {"in": along.rowsBetween(*BEFORE), "out": along.rowsBetween(*AFTER)}
    moved = [m(n).over(frames["in" if n.startswith("in") else "out"]).alias(f"_{n}") for n, m in merge_of.items()]
    return parts.select(*group, *moved)
