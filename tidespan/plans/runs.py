"""Runs of equal neighbours in the order of time, numbered along each key without holding a key in one task."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.time import INF
from .slices import BEFORE, SLICE, UPTO, Cuts, by, local, match


def numbered_runs(df: DataFrame, keys, cuts: Cuts, kind: str) -> DataFrame:
    """Rows, one for each key and `vs`, with their place `_rank` in the key's history, the number `_run` of their run of
    equal `kind`, and whether they begin it (`_fresh`). A null kind is a run of its own.

    Slices are numbered on their own and then moved on by what lies before them, or joined to the run that reaches in.
    """
    tl = cuts.attach(df, "vs").repartition(*keys, SLICE)
    w = local(keys).orderBy("vs")
    changed = ~F.coalesce(F.lag(kind).over(w) == F.col(kind), F.lit(False))
    tl = tl.withColumn("_fresh", changed).withColumn("_nth", F.row_number().over(w))
    group = [*keys, SLICE]
    per_slice = tl.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("_fresh").alias("_new"),
        F.min_by(kind, "vs").alias("_first"),
        F.max_by(kind, "vs").alias("_last"),
    )
    along = Window.partitionBy(*by(keys)).orderBy(SLICE)
    goes_on = F.coalesce((F.lag("_last").over(along) == F.col("_first")).cast("int"), F.lit(0))
    per_slice = per_slice.withColumn("_on", goes_on)
    before = along.rowsBetween(*BEFORE)
    per_slice = per_slice.select(
        *group,
        "_on",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ranks"),
        F.coalesce(F.sum(F.col("_new") - F.col("_on")).over(before), F.lit(0)).alias("_runs"),
    )
    joined = tl.alias("l").join(per_slice.alias("r"), match("l", "r", group)).select("l.*", "r._on", "r._ranks", "r._runs")
    run = F.col("_runs") + F.sum(F.col("_fresh").cast("int")).over(w.rowsBetween(*UPTO)) - F.col("_on")
    return joined.select(
        *df.columns,
        (F.col("_ranks") + F.col("_nth") - 1).alias("_rank"),
        run.alias("_run"),
        (F.col("_fresh") & ~((F.col("_nth") == 1) & (F.col("_on") == 1))).alias("_fresh"),
    )


def alternatives(steps) -> list[list[tuple[object, str]]]:
    """The sequences of (kind, "1" or "+") that a sequence with optional steps stands for."""
    choices = {"1": ["1"], "+": ["+"], "?": ["", "1"], "*": ["", "+"]}
    found = []
    for chosen in product(*(choices[often] for _, often in steps)):
        one = [(kind, often) for (kind, _), often in zip(steps, chosen, strict=True) if often]
        if any(a == b for (a, _), (b, _) in zip(one, one[1:], strict=False)):
            raise ValueError("steps that can follow each other must be of different kinds")
        if one:
            found.append(one)
    return found


def matched_runs(rows: DataFrame, keys, steps, max_duration: int) -> DataFrame:
    """Pairs of events (`s`, `e`: structs of the columns of `rows`) that begin and end a match of the steps.

    Every step but the first and last takes a whole run, so a match is decided by its first and last event and the
    runs in between.
    """

    def side(name: str, kind, fresh=False) -> DataFrame:
        found = rows.where(F.col("_kind") == F.lit(kind))
        found = found.where("_fresh") if fresh else found
        return found.select(F.struct(*rows.columns).alias(name), *[F.col(k).alias(f"{name}_{k}") for k in keys], F.col("_run").alias(f"{name}_run"))

    def same(name: str, run: Column) -> Column:
        cond = F.col(f"{name}_run") == run
        for k in keys:
            cond = cond & F.col(f"s_{k}").eqNullSafe(F.col(f"{name}_{k}"))
        return cond

    (first, begins), (last, ends) = steps[0], steps[-1]
    out = side("s", first)
    if len(steps) == 1 and begins == "1":
        return out.select("s", F.col("s").alias("e"))
    if len(steps) > 2 or (len(steps) == 2 and begins == "1"):
        at, often = F.col("s._rank"), begins
        for i, (kind, times) in enumerate(steps[1:], 1):
            name = f"m{i}"
            cond = same(name, F.col("s_run") + i)
            if often == "1":
                cond = cond & (F.col(f"{name}._rank") == at + 1)
            out = out.join(side(name, kind, fresh=True), cond)
            at, often = F.col(f"{name}._rank"), times
    cond = same("e", F.col("s_run") + (len(steps) - 1)) & (F.col("e._rank") >= F.col("s._rank"))
    tail = side("e", last, fresh=ends == "1" and len(steps) > 1)
    if max_duration < INF:
        # of a long run, only what is near in time
        at = F.expr(f"s.vs div {max_duration} - cast(s.vs < 0 as int)")
        out = out.withColumn("_near", F.explode(F.array(at, at + 1)))
        tail = tail.withColumn("_at", F.expr(f"e.vs div {max_duration} - cast(e.vs < 0 as int)"))
        cond = cond & (F.col("_near") == F.col("_at")) & (F.col("e.vs") < F.col("s.vs") + F.lit(max_duration))
    return out.join(tail, cond).select("s", "e")
