"""Aggregates for `TemporalFrame.aggregate`.

Families decide the physical plan:

* `Additive` can be undone: per-row parts are summed, so one sweep over the edges gives all snapshots. Parts that are
  floating-point numbers are merged instead: taking an infinity or a large number away again would not give back the
  sum of what is left.
* `Moments` are count, mean and squared deviations of floating-point numbers, merged like those sums.
* `Mergeable` has a state that merges (min, max, product, ...): one state per block of a segment tree.
* `Quantile` wants values by rank: a descent through the ordered values with one sweep per level.
* `Multiset` needs all active values of every snapshot (lists, folds): blocks hold (value, count) pairs, and the work
  grows with the number of distinct active values of all snapshots.

Sums over doubles are rounded like any sum of doubles over the active rows; use integers or decimals where snapshots
must add up to the last digit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .time import col


@dataclass(frozen=True)
class Additive:
    parts: dict[str, Column]
    finish: Callable[[dict[str, Column]], Column]
    conds: tuple = ()

    def where(self, cond) -> Additive:
        """Aggregate only the rows satisfying `cond`; snapshots still follow all rows."""
        return replace(self, conds=(*self.conds, col(cond)))

    def rows(self) -> dict[str, Column]:
        return {n: guarded(c, self.conds) for n, c in self.parts.items()}

    def over(self, df: DataFrame) -> Additive | Mergeable:
        """This aggregate over the rows of `df`: merged if a part is a floating-point number."""
        types = df.select(*[c.alias(n) for n, c in self.parts.items()]).schema
        if not any(isinstance(f.dataType, (T.FloatType, T.DoubleType)) for f in types):
            return self

        def finish(p):
            return self.finish({n: F.coalesce(c, F.lit(0)) for n, c in p.items()})

        return Mergeable(self.parts, dict.fromkeys(self.parts, F.sum), finish, self.conds)


@dataclass(frozen=True)
class Mergeable:
    parts: dict[str, Column]
    merge: dict[str, Callable[[Column], Column]]
    finish: Callable[[dict[str, Column]], Column]
    conds: tuple = ()

    def where(self, cond) -> Mergeable:
        return replace(self, conds=(*self.conds, col(cond)))

    def rows(self) -> dict[str, Column]:
        return {n: guarded(c, self.conds) for n, c in self.parts.items()}


@dataclass(frozen=True)
class Multiset:
    value: Column
    finish: Callable[[Column, Column], Column]
    conds: tuple = ()

    def where(self, cond) -> Multiset:
        return replace(self, conds=(*self.conds, col(cond)))

    def row(self) -> Column:
        return guarded(self.value, self.conds)


def same(x: Column) -> Column:
    return x


@dataclass(frozen=True)
class Quantile(Multiset):
    """Order statistics: `ranks(m)` names the wanted ranks among `m` values, `pick(m, found)` makes the result.

    `finish` is the plain aggregate for tumbling windows; `post` applies to either result.
    """

    ranks: Callable = None
    pick: Callable = None
    post: Callable = same


def guarded(value: Column, conds) -> Column:
    for c in conds:
        value = F.when(c, value)
    return value


def present(x: Column) -> Column:
    return F.when(x.isNotNull(), F.lit(1).cast("long"))


def count() -> Additive:
    return Additive({"n": F.lit(1).cast("long")}, lambda p: p["n"])


def count_not_null(x) -> Additive:
    return Additive({"n": present(col(x))}, lambda p: p["n"])


def sum_(x) -> Additive:
    """Zero when nothing is active."""
    return Additive({"s": col(x)}, lambda p: p["s"])


def sum_squares(x) -> Additive:
    return Additive({"s": col(x) * col(x)}, lambda p: p["s"])


def ratio(num: Column, den: Column) -> Column:
    return F.when(den != 0, num / den)


def average(x) -> Additive:
    return Additive({"s": col(x), "n": present(col(x))}, lambda p: ratio(p["s"], p["n"]))


def average_squares(x) -> Additive:
    x = col(x)
    return Additive({"s": x * x, "n": present(x)}, lambda p: ratio(p["s"], p["n"]))


@dataclass(frozen=True)
class Moments:
    """A function of the count, the mean and the sum of squared deviations of a floating-point value."""

    value: Column
    finish: Callable[[Column, Column, Column], Column]
    conds: tuple = ()

    def where(self, cond) -> Moments:
        return replace(self, conds=(*self.conds, col(cond)))

    def row(self) -> Column:
        return guarded(self.value.cast("double"), self.conds)


@dataclass(frozen=True)
class Spread:
    """Variance or standard deviation; how it is computed depends on the type of its value."""

    value: Column
    sample: bool
    root: bool
    conds: tuple = ()
    post: Callable = same

    def where(self, cond) -> Spread:
        return replace(self, conds=(*self.conds, col(cond)))

    def _result(self, spread: Column, n: Column) -> Column:
        """From n times the sum of squared deviations."""
        pairs = n * (n - 1) if self.sample else n * n
        var = F.when(pairs > 0, spread / pairs)
        return self.post(F.sqrt(var) if self.root else var)

    def over(self, df: DataFrame) -> Additive | Moments:
        """Exact decimal sums for integers and decimals of at most 19 digits, so that retraction loses nothing, and
        merged moments for all other numbers."""
        kind = df.select(self.value.alias("x")).schema["x"].dataType
        if isinstance(kind, T.IntegralType):
            digits, scale = 19, 0
        elif isinstance(kind, T.DecimalType) and kind.precision <= 19:
            digits, scale = kind.precision, kind.scale
        else:

            def deviations(n, mean, m2):
                wide = n.cast("double")
                return self._result(wide * m2, wide)

            return Moments(self.value, deviations, self.conds)
        wide = self.value.cast(f"decimal({digits},{scale})")
        square = (wide * wide).cast(f"decimal(38,{2 * scale})")

        def finish(p):
            n, s, q = p["n"], p["s"].cast(f"decimal(38,{scale})"), p["q"].cast(f"decimal(38,{2 * scale})")
            # n*q - s*s without rounding where 38 digits suffice, else in doubles
            exact = F.try_subtract(F.try_multiply(n.cast("decimal(19,0)"), q), F.try_multiply(s, s)).cast("double")
            wide_n, wide_s = n.cast("double"), s.cast("double")
            rough = wide_n * q.cast("double") - wide_s * wide_s
            return self._result(F.greatest(F.coalesce(exact, rough), F.lit(0.0)), wide_n)

        return Additive({"s": wide, "q": square, "n": present(self.value)}, finish, self.conds)


def _spread(x, sample: bool, root: bool) -> Spread:
    return Spread(col(x), sample, root)


def variance(x) -> Spread:
    """Sample variance; null for fewer than two values."""
    return _spread(x, sample=True, root=False)


def population_variance(x) -> Spread:
    return _spread(x, sample=False, root=False)


def stddev(x) -> Spread:
    return _spread(x, sample=True, root=True)


def population_stddev(x) -> Spread:
    return _spread(x, sample=False, root=True)


def complex_sum(x) -> Additive:
    """Sum of a struct column with fields `re` and `im`."""
    x = col(x)
    return Additive(
        {"re": x["re"], "im": x["im"]}, lambda p: F.struct(p["re"].alias("re"), p["im"].alias("im"))
    )


def min_(x) -> Mergeable:
    return Mergeable({"m": col(x)}, {"m": F.min}, lambda p: p["m"])


def max_(x) -> Mergeable:
    return Mergeable({"m": col(x)}, {"m": F.max}, lambda p: p["m"])


def _extreme(x, order, pick) -> Mergeable:
    """Extreme under a custom order, given as a sort key; ties fall to the value itself."""
    pair = F.struct(col(order).alias("o"), col(x).alias("x"))
    return Mergeable({"m": pair}, {"m": pick}, lambda p: p["m"]["x"])


def min_by(x, order) -> Mergeable:
    return _extreme(x, order, F.min)


def max_by(x, order) -> Mergeable:
    return _extreme(x, order, F.max)


def product(x) -> Mergeable:
    """Products never divide, so zeros are safe."""
    one = F.lit(1.0)
    return Mergeable({"m": col(x).cast("double")}, {"m": F.product}, lambda p: F.coalesce(p["m"], one))


def single_or_default(x) -> Mergeable:
    """The value of the only active row, null when there is none; more than one row is an error, null or not."""

    def finish(p):
        many = F.raise_error(F.lit("single_or_default: more than one active row"))
        return F.when(p["n"] > 1, many).otherwise(p["m"])

    return Mergeable({"m": col(x), "n": F.lit(1).cast("long")}, {"m": F.min, "n": F.sum}, finish)


def percentile_continuous(x, p: float, descending=False) -> Quantile:
    """Linear interpolation at p*(n-1) of the ordered values."""
    share = 1 - p if descending else p

    def ranks(m):
        at = F.lit(share) * (m - 1)
        return {"_lo": F.floor(at), "_hi": F.ceil(at)}

    def between(m, found):
        lo, hi = found["_lo"].cast("double"), found["_hi"].cast("double")
        at = F.lit(share) * (m - 1)
        return lo + (hi - lo) * (at - F.floor(at))

    return Quantile(col(x), lambda v, n: F.percentile(v, F.lit(share), n), ranks=ranks, pick=between)


def percentile_discrete(x, p: float, descending=False) -> Quantile:
    """Value at rank ceil(p*n) of the ordered values (the first for p = 0)."""

    def ranks(m):
        nth = F.greatest(F.ceil(F.lit(p) * m), F.lit(1))
        return {"_at": m - nth if descending else nth - 1}

    def finish(v, n):
        pairs = F.sort_array(F.collect_list(F.struct(v.alias("v"), n.alias("n"))))
        seen = F.filter(pairs, lambda e: e["v"].isNotNull())
        total = F.aggregate(seen, F.lit(0).cast("long"), lambda a, e: a + e["n"])
        target = ranks(total)["_at"]
        start = F.struct(F.lit(0).cast("long").alias("run"), F.get(seen, F.lit(0))["v"].alias("v"))
        walked = F.aggregate(
            seen,
            start,
            lambda a, e: F.struct(
                (a["run"] + e["n"]).alias("run"), F.when(a["run"] <= target, e["v"]).otherwise(a["v"]).alias("v")
            ),
        )
        return walked["v"]

    return Quantile(col(x), finish, ranks=ranks, pick=lambda m, found: found["_at"])


def collect(x) -> Multiset:
    """All active values, ordered."""
    return Multiset(
        col(x), lambda v, n: F.sort_array(F.flatten(F.collect_list(F.array_repeat(v, n.cast("int")))))
    )


def user_aggregate(parts: dict, finish, merge: dict | None = None):
    """A user aggregate from column expressions.

    `parts` are per-row values and `finish(parts)` makes the result. Without `merge` the parts are sums (add on
    arrival, subtract on expiry); with `merge`, a Spark aggregate per part combines them.
    """
    parts = {n: col(c) for n, c in parts.items()}
    return Additive(parts, finish) if merge is None else Mergeable(parts, merge, finish)


def user_fold(x, start: Column, step, finish) -> Multiset:
    """A user aggregate folded over the ordered active values: `step(state, value)`, then `finish(state)`."""

    def run(v, n):
        values = F.flatten(F.collect_list(F.array_repeat(v, n.cast("int"))))
        return F.aggregate(F.sort_array(values), start, step, finish)

    return Multiset(col(x), run)


def skip_nulls(agg, x):
    return agg.where(col(x).isNotNull())


def or_default(agg, value):
    """`value` instead of null."""
    return wrap(agg, lambda x: F.coalesce(x, F.lit(value)))


def null_when_empty(agg: Additive, x) -> Additive:
    """Null instead of the initial value when no non-null input is active."""
    n = guarded(present(col(x)), agg.conds)
    inner = agg.finish
    return replace(agg, parts={**agg.parts, "present": n}, finish=lambda p: F.when(p["present"] > 0, inner(p)))


def wrap(agg, fn):
    """Apply `fn` to the result."""
    if isinstance(agg, Spread):
        outer = agg.post
        return replace(agg, post=lambda x: fn(outer(x)))
    inner = agg.finish
    if isinstance(agg, Quantile):
        post = agg.post
        return replace(agg, finish=lambda v, n: fn(inner(v, n)), post=lambda x: fn(post(x)))
    if isinstance(agg, Multiset):
        return replace(agg, finish=lambda v, n: fn(inner(v, n)))
    return replace(agg, finish=lambda p: fn(inner(p)))
