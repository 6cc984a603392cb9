"""Temporal joins: the result lives where both inputs live."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.time import INF, MIN_T
from ..plans.overlap import overlap_join, row_bytes
from ..plans.sweep import ACTIVE, sweep
from ..plans.timeline import instants, with_following
from ..sources.scratch import settle

#: Bytes of a side that may be broadcast.
SMALL_BYTES = 32 << 20


def byte_size(df: DataFrame) -> int:
    """Bytes of the rows, as `row_bytes` counts them."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def pairs(on, left, right) -> tuple[list[str], list[str]]:
    """Key columns of both sides: names, (left, right) pairs, or by default the shared group keys."""
    if on is None:
        on = [k for k in left.keys if k in right.keys]
    if isinstance(on, str):
        on = [on]
    both = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    return [a for a, _ in both], [b for _, b in both]


def prefixed(df: DataFrame, p: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(p + c) for c in df.columns])


class Sides:
    """Naming of a two-input operator: inputs get `l_` and `r_` prefixes, the output gets plain names."""

    def __init__(self, left, right, on):
        self.left, self.right = left, right
        self.lk, self.rk = pairs(on, left, right)
        self.ldf, self.rdf = prefixed(left.df, "l_"), prefixed(right.df, "r_")
        self.lkeys, self.rkeys = ["l_" + k for k in self.lk], ["r_" + k for k in self.rk]
        taken = set(left.df.columns)
        same = {b for a, b in zip(self.lk, self.rk, strict=True) if a == b}
        self.right_out = {}
        for c in right.df.columns:
            if c in ("vs", "ve") or c in same:
                continue
            self.right_out[c] = c + "_r" if c in taken else c

    def residual(self, make) -> Column | None:
        return None if make is None else make(lambda c: F.col("l_" + c), lambda c: F.col("r_" + c))

    def left_cols(self):
        return [F.col("l_" + c).alias(c) for c in self.left.df.columns if c not in ("vs", "ve")]

    def right_cols(self):
        return [F.col("r_" + c).alias(n) for c, n in self.right_out.items()]

    def result(self, df: DataFrame):
        """The joined frame: intersection of the lifetimes."""
        out = df.select(
            F.greatest("l_vs", "r_vs").alias("vs"),
            F.least("l_ve", "r_ve").alias("ve"),
            *self.left_cols(),
            *self.right_cols(),
        )
        return self.left._with(out, wide=True)


class JoinOps:
    def join(self, right, on=None, residual=None, small: str | None = None, hint: str | None = None):
        """Inner join of overlapping lifetimes.

        `on` names the equality columns (default: shared group keys; none means overlap alone).
        `residual(l, r)` is an extra condition, given accessors for the two sides' columns.
        `small="left"` or `"right"` asks for a broadcast of that side; it happens only if the side is measured
        to have at most SMALL_BYTES bytes. `hint` is a Spark join hint for open-ended inputs.
        """
        if small is not None:
            # only the side that is measured is settled for it
            first = self._ready() if small == "left" else right._ready()
            if byte_size(first.df) <= SMALL_BYTES:
                s = Sides(first, right, on) if small == "left" else Sides(self, first, on)
                return self._join_small(s, s.residual(residual), small)
        self, right = self._ready(), right._ready()
        s = Sides(self, right, on)
        extra = s.residual(residual)
        if s.lk and self.props.open_ended and right.props.open_ended:
            return self._join_open(s, extra, hint)
        return s.result(
            overlap_join(s.ldf, s.rdf, s.lkeys, s.rkeys, extra, lprops=self.props, rprops=right.props, blocked=not s.lk)
        )

    def _join_small(self, s, extra, small):
        cond = (F.col("l_vs") < F.col("r_ve")) & (F.col("r_vs") < F.col("l_ve"))
        for a, b in zip(s.lkeys, s.rkeys, strict=True):
            cond = cond & F.col(a).eqNullSafe(F.col(b))
        if extra is not None:
            cond = cond & extra
        ldf = F.broadcast(s.ldf) if small == "left" else s.ldf
        rdf = F.broadcast(s.rdf) if small == "right" else s.rdf
        out = s.result(ldf.join(rdf, cond))
        out._wide = self._wide or s.right._wide
        return out

    def _join_open(self, s, extra, hint):
        """Both sides open-ended: every pair of equal keys overlaps, a plain equality join."""
        cond = F.lit(True)
        for a, b in zip(s.lkeys, s.rkeys, strict=True):
            cond = cond & F.col(a).eqNullSafe(F.col(b))
        if extra is not None:
            cond = cond & extra
        rdf = s.rdf.hint(hint) if hint else s.rdf
        out = s.result(s.ldf.join(rdf, cond))
        out.props = out.props.but(open_ended=True)
        return out

    def semi_join(self, right, on=None, residual=None):
        """Inner join projected to the left columns."""
        keep = self.df.columns
        out = self.join(right, on, residual)
        return out._with(out.df.select(*keep))

    def _idle(self, bounded=False) -> DataFrame:
        """Per key, the maximal periods without any active row after the first start; if bounded, before the last end."""
        seg = sweep(self.df, self.keys, {}, self.cuts, keep_idle=True).where(F.col(ACTIVE) == 0)
        return (seg.where(F.col("ve") < INF) if bounded else seg).select(*self.keys, "vs", "ve")

    def coverage_gaps(self):
        """Per key, the maximal periods without any active row, from the start of time to its end."""
        self = self._ready()
        keys = self.keys
        inner = self._idle()
        first = self.df.groupBy(*keys).agg(F.min("vs").alias("ve"))
        head = first.where(F.col("ve") > MIN_T).select(*keys, F.lit(MIN_T).cast("long").alias("vs"), "ve")
        return self._with(inner.unionByName(head), wide=True)

    def where_not_exists(self, right, on=None, residual=None):
        """Left lifetimes minus the union of the matching right lifetimes.

        With a residual condition, a left row is reduced only where a right row matches it entirely; such rows
        are matched back by equality of the whole left row.
        """
        if residual is not None:
            return self._without_hits(self.join(right, on, residual))
        self, right = self._ready(), right._ready()
        s = Sides(self, right, on)
        ks = ["_k%d" % i for i in range(len(s.rk))]
        renamed = [F.col(f"`{b}`").alias(k) for b, k in zip(s.rk, ks, strict=True)]
        cover = right._with(right.df.select("vs", "ve", *renamed), keys=ks)
        cols = ["vs", "ve", *[c for c in self.df.columns if c not in ("vs", "ve")]]
        # what lies before the first or after the last right row of its key, or has none, needs that row's bounds only
        bounds = cover.df.groupBy(*ks).agg(F.min("vs").alias("_first"), F.max("ve").alias("_last"))
        if ks:
            cond = F.lit(True)
            for a, k in zip(s.lk, ks, strict=True):
                cond = cond & F.col(f"l.`{a}`").eqNullSafe(F.col(f"r.`{k}`"))
            bounded = self.df.alias("l").join(settle(bounds).alias("r"), cond, "left").select("l.*", "r._first", "r._last")
        else:
            bounded = self.df.withColumns({c: bounds.select(c).scalar() for c in ("_first", "_last")})
        piece = lambda lo, hi: F.struct(lo.alias("_a"), hi.alias("_z"))
        vs, ve, first, last = (F.col(c) for c in ("vs", "ve", "_first", "_last"))
        outside = F.array(
            F.when(first.isNull(), piece(vs, ve)),
            F.when(vs < first, piece(vs, F.least(ve, first))),
            F.when(ve > last, piece(F.greatest(vs, last), ve)),
        )
        free = bounded.withColumn("_p", F.explode(F.filter(outside, lambda p: p.isNotNull())))
        free = free.withColumns({"vs": F.col("_p._a"), "ve": F.col("_p._z")}).select(*cols)
        # inside the bounds all lifetimes are finite
        inner = bounded.withColumns({"vs": F.greatest(vs, first), "ve": F.least(ve, last)}).where("vs < ve").select(*cols)
        gaps = prefixed(settle(cover._idle(bounded=True)), "r_")
        gkeys = ["r_" + k for k in ks]
        pieces = overlap_join(prefixed(inner, "l_"), gaps, s.lkeys, gkeys).select(
            F.greatest("l_vs", "r_vs").alias("vs"), F.least("l_ve", "r_ve").alias("ve"), *s.left_cols()
        )
        return self._with(pieces.select(*cols).unionByName(free), wide=True)

    def _without_hits(self, joined):
        """The left lifetimes without what an inner join of them has matched."""
        cols = self.payload + self.keys
        return self.where_not_exists(joined._with(joined.df.select("vs", "ve", *cols), keys=[]), on=cols)

    def left_outer_join(self, right, on=None, residual=None):
        """Inner matches, plus the unmatched stretches of the left side with nulls on the right."""
        self, right = self._ready(), right._ready()
        inner = self.join(right, on, residual)
        if residual is None:
            alone = self.where_not_exists(right, on)
        else:
            inner = inner.settle()  # read here and below
            alone = self._without_hits(inner)
        return inner._with(inner.df.unionByName(_with_nulls(alone.df, inner.df)))

    def full_outer_join(self, right, on=None):
        self, right = self._ready(), right._ready()
        s = Sides(self, right, on)
        left_part = self.left_outer_join(right, on)
        alone = right.where_not_exists(self, on=list(zip(s.rk, s.lk, strict=True)))
        names = dict(s.right_out)
        for a, b in zip(s.lk, s.rk, strict=True):
            names.setdefault(b, a)
        df = alone.df.select("vs", "ve", *[F.col(c).alias(n) for c, n in names.items()])
        return left_part._with(left_part.df.unionByName(_with_nulls(df, left_part.df)))

    def clip_by(self, right, on=None):
        """End each lifetime at the first right start strictly after its own start, if that comes earlier."""
        self, right = self._ready(), (self._ready() if right is self else right._ready())
        s = Sides(self, right, on)
        ks = ["_k%d" % i for i in range(len(s.lk))]
        lt = self.df.select(*[F.col(a).alias(k) for a, k in zip(s.lk, ks, strict=True)], F.col("vs").alias("_t"))
        rt = right.df.select(*[F.col(b).alias(k) for b, k in zip(s.rk, ks, strict=True)], F.col("vs").alias("_t"))
        marked = lt.withColumn("_hit", F.lit(False)).unionByName(rt.withColumn("_hit", F.lit(True)))
        tl = instants(marked, ks, "_t", self.cuts, _hit=F.max("_hit"))
        tl = with_following(tl, ks, "_t", F.when(F.col("_hit"), F.col("_t")), "_at", inclusive=False)
        tl = tl.where(F.col("_at").isNotNull()).select(*ks, "_t", "_at")
        cond = F.col("l.vs") == F.col("r._t")
        for a, k in zip(s.lk, ks, strict=True):
            cond = cond & F.col(f"l.`{a}`").eqNullSafe(F.col(f"r.`{k}`"))
        df = self.df.alias("l").join(tl.alias("r"), cond, "left").select("l.*", "r._at")
        df = df.withColumn("ve", F.least("ve", F.coalesce("_at", F.lit(INF)))).drop("_at")
        return self._with(df, wide=True)

    def as_signal(self):
        """Each row lives until the next distinct start of its key."""
        ready = self._ready()
        return ready.set_duration(INF).clip_by(ready)


def _with_nulls(df: DataFrame, like: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in like.schema.fields}
    return df.select(
        *[
            F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(types[c]).alias(c)
            for c in like.columns
        ]
    )
