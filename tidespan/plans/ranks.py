"""Segment trees for aggregates that cannot be undone (min, max, product, top-k, percentile, user aggregates).

Every key's endpoints get dense ranks (sliced, see `slices`). A lifetime is the rank range [lo, hi), which splits
into at most 2*log2(hi-lo) aligned blocks. What merges (`descend`) is handed down from the longest blocks to the two
halves of each, and merged with what is filed there, until blocks are single ranks: a level has half as many blocks as
the next, so that all levels together are two states a snapshot. Whatever needs all active values (`look_up`) is looked
up in the blocks above each snapshot. No pair of segment and row is formed for aggregates that merge, so the work stays
N log N even when many lifetimes overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.time import INF
from ..sources.scratch import settle
from .slices import BEFORE, SLICE, UPTO, Cuts, carry, local, match
from .timeline import instants


def with_blocks(df: DataFrame) -> DataFrame:
    """One row per aligned power-of-two block (`_lvl`, `_node`) of the range [_lo, _hi).

    On each level the range's aligned part is [lo, hi) in units of that level; what the next level cannot hold
    is an odd first block and an odd last one.
    """
    top = F.floor(F.log2(F.col("_hi") - F.col("_lo"))).cast("int") + 1
    df = df.withColumn("_lvl", F.explode(F.sequence(F.lit(0), top)))
    lo = F.expr("shiftright(_lo + shiftleft(1L, _lvl) - 1, _lvl)")
    df = df.withColumns({"_lo": lo, "_hi": F.expr("shiftright(_hi, _lvl)")})
    df = df.where("_lo < _hi and (_lo % 2 = 1 or _hi % 2 = 1)")
    ends = F.array(F.when(F.col("_lo") % 2 == 1, F.col("_lo")), F.when(F.col("_hi") % 2 == 1, F.col("_hi") - 1))
    df = df.withColumn("_node", F.explode(ends)).where(F.col("_node").isNotNull())
    return df.drop("_lo", "_hi")


def _on_level(ranked: DataFrame, level: int) -> DataFrame:
    """The rows of the blocks of one level, as `with_blocks` files them: `_node` in place of [_lo, _hi)."""
    lo, hi = F.expr(f"shiftright(_lo + {(1 << level) - 1}L, {level})"), F.expr(f"shiftright(_hi, {level})")
    df = ranked.withColumns({"_lo": lo, "_hi": hi}).where("_lo < _hi and (_lo % 2 = 1 or _hi % 2 = 1)")
    ends = F.array(F.when(F.col("_lo") % 2 == 1, F.col("_lo")), F.when(F.col("_hi") % 2 == 1, F.col("_hi") - 1))
    return df.withColumn("_node", F.explode(ends)).where(F.col("_node").isNotNull()).drop("_lo", "_hi")


def descend(ranked: DataFrame, reduce) -> DataFrame:
    """What is active at each rank `_node` at which something is: rows [_lo, _hi) reduced by (keys, _node), from level to level.

    `reduce(filed, handed)` makes one result of the rows filed in a block and of what `reduce` made of the block of twice
    the length, null on the first level.
    """
    longest = ranked.agg(F.max(F.col("_hi") - F.col("_lo"))).first()[0]
    found = None
    for level in reversed(range(max(1, longest or 0).bit_length())):
        if found is not None:
            halves = F.array(F.col("_node") * 2, F.col("_node") * 2 + 1)
            found = found.withColumn("_node", F.explode(halves))
        found = reduce(_on_level(ranked, level), found)
    return found


def at_ranks(segments: DataFrame, found: DataFrame, keys) -> DataFrame:
    """Segments with what was found at their rank."""
    cond = match("l", "r", keys) & (F.col("l._rank") == F.col("r._node"))
    # size estimates do not see the halving: never let them choose a broadcast
    joined = _reported(segments).hint("merge").alias("l").join(found.alias("r"), cond)
    mine = [c for c in segments.columns if c != "_rank"]
    rest = [c for c in found.columns if c not in (*keys, "_node")]
    return joined.select(*[F.col(f"l.`{c}`") for c in mine], *[F.col(f"r.`{c}`") for c in rest])


def _reported(segments: DataFrame) -> DataFrame:
    return segments.where((F.col("vs") < INF) & F.col("ve").isNotNull())


def ranked_segments(df: DataFrame, keys, cuts: Cuts, sums=()) -> DataFrame:
    """(keys, vs, ve, rank) for all instants of each key, with the sums over the active rows of the columns `sums`, which
    can be taken away again; the open end has a rank of its own."""
    at = lambda t, sign: F.struct(F.col(t).alias("_t"), *[(sign * F.coalesce(s, F.lit(0))).alias(s) for s in sums])
    points = df.select(*keys, F.explode(F.array(at("vs", 1), at("ve", -1))).alias("_p")).select(*keys, "_p.*")
    tl = instants(points, keys, "_t", cuts, **{s: F.sum(s) for s in sums})
    tl = carry(
        tl,
        keys,
        {"_n": F.count(F.lit(1)), "_first": F.min("_t"), **{f"_s{i}": F.sum(s) for i, s in enumerate(sums)}},
        lambda w: {
            "_base": F.sum("_n").over(w.rowsBetween(*BEFORE)),
            "_nextfirst": F.lead("_first").over(w),
            **{f"_c{i}": F.sum(f"_s{i}").over(w.rowsBetween(*BEFORE)) for i, _ in enumerate(sums)},
        },
    )
    w = local(keys).orderBy("_t")
    run = w.rowsBetween(*UPTO)
    return tl.select(
        *[(F.sum(s).over(run) + F.coalesce(F.col(f"_c{i}"), F.lit(0))).alias(s) for i, s in enumerate(sums)],
        *keys,
        F.col("_t").alias("vs"),
        F.coalesce(F.lead("_t").over(w), F.col("_nextfirst")).alias("ve"),
        (F.row_number().over(w) - 1 + F.coalesce(F.col("_base"), F.lit(0))).cast("long").alias("_rank"),
    )


def ranked_rows(rows: DataFrame, segments: DataFrame, keys) -> DataFrame:
    """Add the rank range [_lo, _hi) of each lifetime."""
    marks = segments.select(*keys, F.col("vs").alias("_t"), "_rank")
    for bound, name in (("vs", "_lo"), ("ve", "_hi")):
        cond = match("l", "r", keys) & (F.col(f"l.{bound}") == F.col("r._t"))
        rows = rows.alias("l").join(marks.alias("r"), cond).select("l.*", F.col("r._rank").alias(name))
    return rows


def ranked_table(rows: DataFrame, keys, cuts: Cuts, sums=()):
    """Segments, with their sums, and rows with their rank ranges.

    Segments are read three times and ranked rows on each level, so both are written out once.
    """
    segments = settle(ranked_segments(rows, keys, cuts, sums))
    ranked = ranked_rows(rows.drop(*sums), segments, keys).drop("vs", "ve")
    return segments, settle(ranked)


def blocks_and_lookups(rows: DataFrame, keys, cuts: Cuts):
    """Rows exploded to blocks, and segments exploded to the blocks above them."""
    segments, ranked = ranked_table(rows, keys, cuts)
    # each key has as many levels as its own longest lifetime needs
    spans = ranked.groupBy(*keys).agg(F.floor(F.log2(F.max(F.col("_hi") - F.col("_lo")))).cast("int").alias("_top"))
    blocks = with_blocks(ranked)
    asked = _reported(segments)
    if keys:
        asked = asked.alias("l").join(settle(spans).alias("r"), match("l", "r", keys)).select("l.*", "r._top")
    else:
        asked = asked.withColumn("_top", spans.scalar())
    lookups = asked.withColumn("_lvl", F.explode(F.sequence(F.lit(0), F.coalesce("_top", F.lit(0))))).drop("_top")
    lookups = lookups.withColumn("_node", F.expr("shiftright(_rank, _lvl)")).drop("_rank")
    return blocks, lookups


def look_up(lookups: DataFrame, blocks: DataFrame, keys) -> DataFrame:
    """Block contents for each segment. One block may serve very many segments of a hot key: the block side is
    pre-aggregated, so adaptive skew handling can split the segment side freely."""
    group = [*keys, "_lvl", "_node"]
    # size estimates do not see the explosion to levels: never let them choose a broadcast
    joined = lookups.hint("merge").alias("l").join(blocks.alias("r"), match("l", "r", group))
    mine, rest = ([c for c in df.columns if c not in (*group, "vs", "ve")] for df in (lookups, blocks))
    return joined.select(
        *[F.col(f"l.`{c}`") for c in (*keys, "vs", "ve", *mine)], *[F.col(f"r.`{c}`") for c in rest]
    )
