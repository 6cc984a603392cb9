"""Snapshot aggregation: the value of an aggregate over the rows active at each moment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.aggregates import Additive, Mergeable, Moments, Multiset, Quantile, Spread
from ..functions.time import INF, col
from ..plans.ordered import call_by_group
from ..plans.quantiles import counted_segments, order_statistics
from ..plans.ranks import at_ranks, blocks_and_lookups, descend, look_up, ranked_table
from ..plans.slices import BEFORE, SLICE, UPTO, Cuts, by, local, match
from ..plans.sliding import MERGES, sliding
from ..plans.sweep import sweep
from ..plans.timeline import instants
from ..sources.scratch import settle

NUMBERS = (T.IntegralType, T.FloatType, T.DoubleType)


class AggregateOps:
    def aggregate(self, **aggs):
        """Aggregate per group key and snapshot.

        The output changes at every instant where a row of the key starts or ends, even if the value does not;
        `stitch` merges equal neighbours. Nothing is reported while no row is active.
        """
        keys = self.keys
        if self.props.tumbling and not any(isinstance(a, Quantile) for a in aggs.values()):
            aggs = {n: a.over(self.df) if isinstance(a, Spread) else a for n, a in aggs.items()}
            return self._with(_tumbling(self.df, keys, aggs), props=self.props, wide=True)
        self = self._ready()
        aggs = {n: a.over(self.df) if isinstance(a, (Additive, Spread)) else a for n, a in aggs.items()}
        families = []
        if self.props.duration is not None:
            flat = {n: a for n, a in aggs.items() if _two_way(a)}
            if flat:
                families.append(_slid(self.df, keys, flat, self.props.duration, self.cuts))
            rest = {n: a for n, a in aggs.items() if n not in flat}
        else:
            rest = aggs
        additive = {n: a for n, a in rest.items() if isinstance(a, Additive)}
        mergeable = {n: a for n, a in rest.items() if isinstance(a, Mergeable)}
        moments = {n: a for n, a in rest.items() if isinstance(a, Moments)}
        if mergeable and self.props.open_ended:
            families.append(_running(self.df, keys, mergeable, self.cuts))
            mergeable = {}
        if mergeable or moments:
            families.append(_ranked(self.df, keys, additive, mergeable, moments))
        elif additive:
            families.append(_swept(self.df, keys, additive, self.cuts))
        quantiles = {n: a for n, a in aggs.items() if isinstance(a, Quantile)}
        alike = _alike(self.df, quantiles)
        for first in dict.fromkeys(alike.values()):
            same = {n: a for n, a in quantiles.items() if alike[n] == first}
            families.append(_by_rank(self.df, keys, same, self.cuts))
        for n, a in aggs.items():
            if isinstance(a, Multiset) and not isinstance(a, Quantile):
                families.append(_from_values(self.df, keys, n, a, self.cuts))
        out = families[0]
        for more in families[1:]:
            # all families cut time at the same instants
            extra = [c for c in more.columns if c not in (*keys, "vs", "ve")]
            cond = match("l", "r", [*keys, "vs"])
            out = out.alias("l").join(more.alias("r"), cond).select("l.*", *[f"r.{c}" for c in extra])
        return self._with(out.select(*keys, "vs", "ve", *aggs), wide=True)

    def group_aggregate(self, group, **aggs):
        """Aggregate per group; the group columns become payload of the result."""
        names, frame = _grouped(self, group)
        return frame.aggregate(**aggs).ungroup(*names)

    def count(self, name="n"):
        from ..functions.aggregates import count

        return self.aggregate(**{name: count()})

    def distinct(self):
        """One row per distinct payload and snapshot of its multiplicity."""
        cols = [*self.keys, *self.payload]
        out = self._with(self.df, keys=cols, props=self.props).count("_n")
        return self._with(out.df.select("vs", "ve", *cols))

    def distinct_by(self, **exprs):
        return self.select(**exprs).distinct()

    def aggregate_with(self, right, **aggs):
        """Aggregate over the tagged union of two frames; conditions may test the `side` column (0 or 1)."""
        names = [*self.payload, *[c for c in right.payload if c not in self.payload]]
        sides = []
        for i, f in enumerate((self, right)):
            types = dict(self.df.dtypes) | {c: t for c, t in right.df.dtypes if c not in self.df.columns}
            cols = [F.col(c) if c in f.df.columns else F.lit(None).cast(types[c]).alias(c) for c in names]
            sides.append(f.df.select("vs", "ve", *self.keys, *cols, F.lit(i).alias("side")))
        both = self._with(sides[0].unionByName(sides[1]), wide=self._wide or right._wide)
        return both.aggregate(**aggs)

    def top_k(self, k: int, by, ascending=False):
        """Rows ranked by `by` within each snapshot, with gaps after ties; ties at the cut are all kept.

        One output row per snapshot and ranked row, with its `rank`.
        """
        self = self._ready()
        keys, payload = self.keys, self.payload
        order = F.col("_o").asc_nulls_last() if ascending else F.col("_o").desc_nulls_last()
        packed = F.struct(*payload).alias("_p")
        rows = self.df.select(*keys, "vs", "ve", col(by).alias("_o"), packed)
        segments, ranked = ranked_table(rows, keys, self.cuts)
        # per block only the first k ranks can matter; the filter on rank is applied before the shuffle too
        in_block = Window.partitionBy(*keys, "_node").orderBy(order)

        def best(filed, handed):
            both = filed if handed is None else filed.unionByName(handed.drop("rank"))
            return both.withColumn("rank", F.rank().over(in_block)).where(F.col("rank") <= k)

        out = at_ranks(segments, descend(ranked, best), keys)
        return self._with(out.select(*keys, "vs", "ve", "rank", "_p.*"), wide=True)

    def top_k_lists(self, k: int, by, ascending=False, name="top"):
        """As `top_k`, packed into one array of (rank, payload) per snapshot."""
        ranked = self.top_k(k, by, ascending)
        keys, payload = self.keys, self.payload
        item = F.struct(F.col("rank"), F.struct(*payload).alias("payload"))
        df = ranked.df.groupBy(*keys, "vs", "ve").agg(F.array_sort(F.collect_list(item)).alias(name))
        return self._with(df)

    def aggregate_pandas(self, fn, value, schema_type: str, name="result"):
        """An opaque user aggregate: `fn` is a grouped pandas function over the active values of a snapshot."""
        self = self._ready()
        keys = self.keys
        rows = self.df.select(*keys, "vs", "ve", col(value).alias("_v"))
        blocks, lookups = blocks_and_lookups(rows, keys, self.cuts)
        found = look_up(lookups, blocks.drop("vs", "ve"), keys)
        # Spark's own call of a grouped function costs more than most functions; numbers need none of its conversions
        if isinstance(rows.schema["_v"].dataType, NUMBERS) and isinstance(T.DataType.fromDDL(schema_type), (*NUMBERS, T.BooleanType)):
            return self._with(call_by_group(found, [*keys, "vs"], "_v", fn, name, schema_type), wide=True)
        udf = F.pandas_udf(fn, schema_type)
        return self._with(found.groupBy(*keys, "vs", "ve").agg(udf("_v").alias(name)), wide=True)


def _grouped(frame, group):
    if isinstance(group, dict):
        return list(group), frame.group_by(**group)
    names = [group] if isinstance(group, str) else list(group)
    return names, frame.group_by(*names)


def _parts(aggs) -> dict[str, dict[str, Column]]:
    return {n: {f"_{n}_{p}": c for p, c in a.rows().items()} for n, a in aggs.items()}


def _finish(n, a, columns) -> Column:
    return a.finish({p: columns(f"_{n}_{p}") for p in a.parts}).alias(n)


def _tumbling(df: DataFrame, keys, aggs) -> DataFrame:
    """Constant duration equal to the hop: a snapshot is a window, so one plain aggregation does it."""
    group = [*keys, "vs", "ve"]
    inputs, merges, outs = {}, [], []
    values = [n for n, a in aggs.items() if isinstance(a, Multiset)]
    for n, a in aggs.items():
        if isinstance(a, Multiset):
            inputs[f"_{n}"] = a.row()
            merges.append(a.finish(F.col(f"_{n}"), F.lit(1).cast("long")).alias(n))
            outs.append(F.col(n))
            continue
        if isinstance(a, Moments):
            v = f"_{n}"
            inputs[v] = a.row()
            state = (F.count(v), F.avg(v), F.var_pop(v) * F.count(v))
            merges += [c.alias(f"{v}_{i}") for i, c in enumerate(state)]
            outs.append(a.finish(*[F.col(f"{v}_{i}") for i in range(3)]).alias(n))
            continue
        for p, c in a.rows().items():
            name = f"_{n}_{p}"
            inputs[name] = c
            if isinstance(a, Additive):
                merges.append(F.coalesce(F.sum(name), F.lit(0)).alias(name))
            else:
                merges.append(a.merge[p](name).alias(name))
        outs.append(_finish(n, a, F.col))
    rows = df.select(*group, *[c.alias(n) for n, c in inputs.items()])
    if len(values) == 1 and len(aggs) == 1:
        # values repeat: count equal ones on the map side first
        v = f"_{values[0]}"
        counted = rows.groupBy(*group, v).agg(F.count(F.lit(1)).alias("_c"))
        return counted.groupBy(*group).agg(aggs[values[0]].finish(F.col(v), F.col("_c")).alias(values[0]))
    return rows.groupBy(*group).agg(*merges).select(*group, *outs)


def _two_way(agg) -> bool:
    """Whether two states of the aggregate can be merged by an expression."""
    return isinstance(agg, Additive) or (isinstance(agg, Mergeable) and all(m in MERGES for m in agg.merge.values()))


def _slid(df, keys, aggs, duration, cuts) -> DataFrame:
    parts = {p: c for ps in _parts(aggs).values() for p, c in ps.items()}
    merges = {f"_{n}_{p}": F.sum if isinstance(a, Additive) else a.merge[p] for n, a in aggs.items() for p in a.parts}
    seg = sliding(df, keys, duration, parts, merges, cuts)
    outs = [
        _finish(n, a, (lambda p: F.coalesce(F.col(p), F.lit(0))) if isinstance(a, Additive) else F.col) for n, a in aggs.items()
    ]
    return seg.select(*keys, "vs", "ve", *outs)


def _swept(df, keys, aggs, cuts) -> DataFrame:
    deltas = {p: c for parts in _parts(aggs).values() for p, c in parts.items()}
    seg = sweep(df, keys, deltas, cuts)
    return seg.select(*keys, "vs", "ve", *[_finish(n, a, F.col) for n, a in aggs.items()])


def _ranked(df, keys, additive, mergeable, moments) -> DataFrame:
    """All aggregates over one timeline of ranked instants, from one scan of the input.

    What can be taken away again is summed along the instants. Merged states, and counts, means and squared deviations,
    are kept for each block, and handed down from block to block.
    """
    sums = {p: c for ps in _parts(additive).values() for p, c in ps.items()}
    parts = {p: c for ps in _parts(mergeable).values() for p, c in ps.items()}
    merge = {f"_{n}_{p}": a.merge[p] for n, a in mergeable.items() for p in a.parts}
    alike = _alike(df, moments)
    values = {f"_{n}": moments[n].row() for n in dict.fromkeys(alike.values())}
    rows = df.select(*keys, "vs", "ve", *[c.alias(n) for n, c in (sums | parts | values).items()])

    def fold(frame, group, **more):
        return frame.groupBy(*group).agg(*[m(p).alias(p) for p, m in merge.items()], *[c.alias(n) for n, c in more.items()])

    if not moments:
        rows = fold(rows, [*keys, "vs", "ve"], **{p: F.sum(p) for p in sums}, _c=F.count(F.lit(1))).drop("_c")
    rows = settle(rows)
    cuts = Cuts(rows, keys, "vs")
    segments, ranked = ranked_table(rows, keys, cuts, list(sums))

    def merged(filed, handed):
        first = handed is None
        if not first:
            filed = filed.unionByName(handed, allowMissingColumns=True)
        # raw values and the one state handed down are in columns of their own
        own = {v: F.struct(F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2")) for v in values}
        above = {} if first else {f"{v}_up": F.any_value(f"{v}_state", F.lit(True)) for v in values}
        out = fold(filed, [*keys, "_node"], **own, **above)
        state = lambda v: F.col(v) if first else _merged_moments(F.coalesce(f"{v}_up", _no_moments()), F.col(v))
        return out.select(*keys, "_node", *merge, *[state(v).alias(f"{v}_state") for v in values])

    out = at_ranks(segments, descend(ranked, merged), keys)
    outs = [_finish(n, a, F.col) for n, a in (additive | mergeable).items()]
    for n, a in moments.items():
        total = F.col(f"_{alike[n]}_state")
        outs.append(a.finish(total["n"], total["mean"], total["m2"]).alias(n))
    return out.select(*keys, "vs", "ve", *outs)


def _alike(df, aggs) -> dict[str, str]:
    """For each aggregate the first one over the same values."""
    rows = {n: df.select(a.row().alias("_v")) for n, a in aggs.items()}
    return {n: next(m for m, other in rows.items() if m == n or other.sameSemantics(mine)) for n, mine in rows.items()}


def _no_moments() -> Column:
    return F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))


def _merged_moments(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    mean = a["mean"] + gap * b["n"] / n
    m2 = a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n
    one = lambda name, c: F.when(a["n"] == 0, b[name]).when(b["n"] == 0, a[name]).otherwise(c).alias(name)
    return F.struct(n.alias("n"), one("mean", mean), one("m2", m2))


def _running(df, keys, aggs, cuts) -> DataFrame:
    """Open-ended rows never leave: a running merge along time, carried from slice to slice."""
    parts = _parts(aggs)
    merge = {f"_{n}_{p}": a.merge[p] for n, a in aggs.items() for p in a.parts}
    rows = df.select(*keys, F.col("vs").alias("_t"), *[c.alias(p) for ps in parts.values() for p, c in ps.items()])
    tl = instants(rows, keys, "_t", cuts, **{p: m(p) for p, m in merge.items()})
    group = [*keys, SLICE]
    slices = tl.groupBy(*group).agg(F.min("_t").alias("_first"), *[m(p).alias(p) for p, m in merge.items()])
    order = Window.partitionBy(*by(keys)).orderBy(SLICE)
    carried = slices.select(
        *group,
        F.lead("_first").over(order).alias("_nextfirst"),
        *[m(p).over(order.rowsBetween(*BEFORE)).alias(p) for p, m in merge.items()],
    )
    # what earlier slices leave behind goes before the first row of each slice
    before = carried.withColumn("_t", F.lit(None).cast("long"))
    lines = tl.withColumn("_nextfirst", F.lit(None).cast("long")).unionByName(before)
    inside = local(keys).orderBy("_t")
    run = inside.rowsBetween(*UPTO)
    out = lines.select(
        *keys,
        F.col("_t").alias("vs"),
        F.lead("_t").over(inside).alias("_next"),
        F.first("_nextfirst", ignorenulls=True).over(local(keys)).alias("_nextfirst"),
        *[m(p).over(run).alias(p) for p, m in merge.items()],
    ).where(F.col("vs").isNotNull())
    ends = F.coalesce("_next", "_nextfirst", F.lit(INF)).alias("ve")
    return out.select(*keys, "vs", ends, *[_finish(n, a, F.col) for n, a in aggs.items()])


def _by_rank(df, keys, aggs, cuts) -> DataFrame:
    """Quantiles of the same values, which share segments and events."""
    rows = df.select(*keys, "vs", "ve", next(iter(aggs.values())).row().alias("_v"))
    segments = counted_segments(rows, keys, cuts)
    places = {n: {f"_{i}{r}": at for r, at in a.ranks(F.col("_m")).items()} for i, (n, a) in enumerate(aggs.items())}
    found = order_statistics(segments, rows, keys, cuts, list(places.values()))
    outs = []
    for n, a in aggs.items():
        at = dict(zip(a.ranks(F.lit(1)), places[n], strict=True))
        outs.append(a.post(a.pick(F.col("_m"), {r: F.col(c) for r, c in at.items()})).alias(n))
    return found.select(*keys, "vs", "ve", *outs)


def _from_values(df, keys, name, agg, cuts) -> DataFrame:
    rows = df.select(*keys, "vs", "ve", agg.row().alias("_v"))
    rows = rows.groupBy(*keys, "vs", "ve", "_v").agg(F.count(F.lit(1)).alias("_c"))
    blocks, lookups = blocks_and_lookups(rows, keys, cuts)
    blocks = blocks.groupBy(*keys, "_lvl", "_node", "_v").agg(F.sum("_c").alias("_c"))
    found = look_up(lookups, blocks, keys)
    found = found.groupBy(*keys, "vs", "ve", "_v").agg(F.sum("_c").alias("_c"))
    return found.groupBy(*keys, "vs", "ve").agg(agg.finish(F.col("_v"), F.col("_c")).alias(name))
