"""Overlap join: pairs of rows with equal keys (or no keys) whose lifetimes overlap.

Every overlapping pair is found exactly once: either the right row starts inside the left lifetime, or the left
row starts strictly inside the right lifetime. Each half is a point-in-interval join. An interval is filed in the one
or two buckets it touches of the smallest width that is a power of four and holds it; a point is filed in one bucket
per width that occurs, at most 32. The join is then an equality on (keys, width, bucket), with candidates proportional to results
even without keys, instead of all pairs of a key or a nested loop.

Open lifetimes hold all points that come after their start. Under a key they share one bucket. Without keys they are filed
by the time slice in which they start, and a point in every slice up to its own: no task has them all, and pairs in the
wrong order are met in one slice only.

Without keys the answer of a join can be far larger than the input. Then its rows are made block by block (`block_join`): filed
rows also go by time slices of the points, and those of a place are put in arrays of neighbouring rows, which meet whole. No task
has all pairs of a bucket, and consecutive rows of the answer repeat each other: columnar files store them in far fewer bytes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.time import INF
from .slices import BEFORE, SLICE, Cuts

LVL, BUCKET = "_w", "_b"


OPEN = 62  # the class of open lifetimes: one bucket holds all of time

#: Rows of a block, if they have at most ROW_BYTES, else fewer. A task holds the pairs of two blocks at once.
BLOCK_ROWS, ROW_BYTES = 128, 128
#: Pairs for each row of the inputs from which they are made block by block.
PAIRS_PER_ROW = 32


def width_class(vs="vs", ve="ve") -> Column:
    length = 2 * F.ceil(F.log2((F.col(ve) - F.col(vs)).cast("double")) / 2).cast("int")
    return F.when(F.col(ve) >= INF, F.lit(OPEN)).otherwise(length)


def file_intervals(df: DataFrame, vs: str, ve: str, open_cuts: Cuts | None = None) -> DataFrame:
    df = df.withColumn(LVL, width_class(vs, ve))
    buckets = F.expr(f"sequence(shiftright(`{vs}`, {LVL}), shiftright(`{ve}` - 1, {LVL}))")
    if open_cuts is None:
        return df.withColumn(BUCKET, F.explode(buckets))
    df = open_cuts.attach(df, vs, "_start")
    by_start = F.array(F.col("_start").cast("long"))
    return df.withColumn(BUCKET, F.explode(F.when(F.col(LVL) == OPEN, by_start).otherwise(buckets))).drop("_start")


def file_points(df: DataFrame, t: str, widths: Column, open_cuts: Cuts | None = None) -> DataFrame:
    df = df.withColumn(LVL, F.explode(widths))
    bucket = F.expr(f"shiftright(`{t}`, {LVL})")
    if open_cuts is None:
        return df.withColumn(BUCKET, bucket)
    df = open_cuts.attach(df, t, "_upto")
    upto = F.sequence(F.lit(0).cast("long"), F.col("_upto").cast("long"))
    return df.withColumn(BUCKET, F.explode(F.when(F.col(LVL) == OPEN, upto).otherwise(F.array(bucket)))).drop("_upto")


def widths_of(df: DataFrame, vs: str, ve: str, props) -> Column:
    """The interval widths that occur: known from the declared properties, or else at most 32 small integers
    as a scalar subquery."""
    if props is not None and props.open_ended:
        return F.array(F.lit(OPEN))
    if props is not None and props.duration is not None:
        return F.array(F.lit(2 * -(-(props.duration - 1).bit_length() // 2)))
    return df.agg(F.sort_array(F.collect_set(width_class(vs, ve))).alias("w")).scalar()


def equal(lk, rk) -> Column:
    cond = (F.col(f"l.{LVL}") == F.col(f"r.{LVL}")) & (F.col(f"l.{BUCKET}") == F.col(f"r.{BUCKET}"))
    for a, b in zip(lk, rk, strict=True):
        cond = cond & F.col(f"l.`{a}`").eqNullSafe(F.col(f"r.`{b}`"))
    return cond


def overlap_join(
    left: DataFrame, right: DataFrame, lk=(), rk=(), residual: Column | None = None, lprops=None, rprops=None, blocked=False
) -> DataFrame:
    """Inner overlap join. Inputs have disjoint column names; times are `l_vs, l_ve` and `r_vs, r_ve`.

    `blocked` lets rows be made block by block if the answer is measured to be far larger than the input, as without keys.
    """
    halves = []
    for ivs, pts, lo, hi, t, strict, props in (
        (left, right, "l_vs", "l_ve", "r_vs", False, lprops),
        (right, left, "r_vs", "r_ve", "l_vs", True, rprops),
    ):
        if strict and props is not None and props.duration == 1:
            continue  # nothing starts strictly inside a point
        widths = widths_of(ivs, lo, hi, props)
        finite = props is not None and props.duration is not None
        open_cuts = None if lk or finite else Cuts(ivs.where(F.col(hi) >= INF), [], lo)
        filed = file_intervals(ivs, lo, hi, open_cuts)
        points = file_points(pts, t, widths, open_cuts)
        after = F.col(t) > F.col(lo) if strict else F.col(t) >= F.col(lo)
        cond = after & (F.col(t) < F.col(hi))
        if residual is not None:
            cond = cond & residual
        cuts = Cuts(pts, [], t)
        if blocked and dense(ivs, pts, lo, hi, cuts):
            joined = block_join(points, filed, t, lo, hi, cuts).where(cond)
        else:
            a, b = (filed, points) if not strict else (points, filed)
            joined = a.alias("l").join(b.alias("r"), equal(lk, rk) & cond)
        halves.append(joined.select(*[F.col(f"`{c}`") for c in [*left.columns, *right.columns]]))
    return reduce(DataFrame.unionByName, halves)


def touched(ivs: DataFrame, lo: str, hi: str, cuts: Cuts) -> DataFrame:
    """Add the first and the last slice of each interval."""
    ends = cuts.attach(ivs, lo, "_from").withColumn("_end", F.col(hi) - 1)
    return cuts.attach(ends, "_end", "_upto").drop("_end")


def dense(ivs: DataFrame, pts: DataFrame, lo: str, hi: str, cuts: Cuts) -> bool:
    """Whether points in intervals are many more than the rows. As slices hold about equally many points, it is enough to
    count the cuts that lie in intervals. This decides only how the pairs are made, never which."""
    total = pts.agg(F.count(F.lit(1)).alias("n")).scalar()
    crossed = touched(ivs, lo, hi, cuts).agg(F.sum(F.col("_upto") - F.col("_from")).alias("cuts"), F.count(F.lit(1)).alias("n"))
    found = crossed.withColumn("points", total).first()
    return (found.cuts or 0) * found.points >= PAIRS_PER_ROW * cuts.count * max(1, found.n + found.points)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: texts and binary values by length, nested ones by their text, others 8, and 16 a row."""
    sizes = [F.lit(16).cast("long")]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)).cast("long"))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            sizes.append(F.coalesce(F.octet_length(c.cast("string")), F.lit(0)).cast("long"))
        else:
            sizes.append(F.lit(8).cast("long"))
    return sum(sizes[1:], sizes[0])


def blocks(df: DataFrame, place, order: str, lo: str, hi: str, name: str) -> DataFrame:
    """Rows of a place in arrays of BLOCK_ROWS or fewer, neighbours in order, with the first `lo` and the last `hi` of each."""
    rows = df.drop(*place)
    weight = F.ceil(row_bytes(rows) / F.lit(ROW_BYTES))
    before = F.sum(weight).over(Window.partitionBy(*place).orderBy(order).rowsBetween(*BEFORE))
    df = df.withColumn("_n", F.floor(F.coalesce(before, F.lit(0)) / F.lit(BLOCK_ROWS)))
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    bounds = F.min(lo).alias(name + "_lo"), F.max(hi).alias(name + "_hi")
    return df.groupBy(*place, "_n").agg(F.collect_list(row).alias(name), *bounds)


def block_join(points: DataFrame, filed: DataFrame, t: str, lo: str, hi: str, cuts: Cuts) -> DataFrame:
    """Pairs of filed points and intervals of one bucket and one slice of the points, those that may overlap among them.

    An interval goes to every slice it touches, whose points it nearly all holds. Of two blocks, each point meets all
    intervals before the next one does: points by time and intervals by end, so a point's rows are like those of the one before.
    """
    place = [LVL, BUCKET, SLICE]
    is_open = F.col(LVL) == OPEN  # filed by slices already
    points = cuts.attach(points, t).withColumn(SLICE, F.when(is_open, 0).otherwise(F.col(SLICE)))
    slices = F.when(is_open, F.array(F.lit(0))).otherwise(F.sequence("_from", "_upto"))
    filed = touched(filed, lo, hi, cuts).withColumn(SLICE, F.explode(slices)).drop("_from", "_upto")
    # a given number of partitions: adaptive execution would merge them by their bytes, and few tasks make all pairs
    outer = blocks(points.repartition(cuts.count, *place), place, t, t, t, "_p").alias("l")
    inner = blocks(filed.repartition(cuts.count, *place), place, hi, lo, hi, "_i").alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in place]
    near = (F.col("_p_hi") >= F.col("_i_lo")) & (F.col("_p_lo") < F.col("_i_hi"))
    met = outer.hint("merge").join(inner, reduce(Column.__and__, same) & near).select("_p", "_i")
    # a narrow step that moves nothing: rows are made from one pair of blocks at a time, not from all blocks that one meets
    met = met.coalesce(cuts.count)
    return met.select(F.explode("_p").alias("_p"), "_i").select("_p", F.explode("_i").alias("_i")).select("_p.*", "_i.*")
