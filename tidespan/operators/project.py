"""Filter, projection, flat-map, pivot and unpivot."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.time import col


def named(cols, exprs) -> list[Column]:
    return [col(c) for c in cols] + [col(e).alias(n) for n, e in exprs.items()]


class ProjectOps:
    def where(self, cond) -> "TemporalFrame":
        return self._with(self.df.where(cond), props=self.props)

    def select(self, *cols, **exprs) -> "TemporalFrame":
        """New payload. Expressions may use the payload, `vs`, `ve` and the key columns."""
        return self._with(self.df.select("vs", "ve", *self.keys, *named(cols, exprs)), props=self.props)

    def adjust(self, fields: list[str], **overrides) -> "TemporalFrame":
        """Payload with exactly `fields`: copied by name, overridden, or null when neither exists."""
        have = set(self.payload)
        out = []
        for f in fields:
            if f in overrides:
                out.append(col(overrides[f]).alias(f))
            else:
                out.append(F.col(f) if f in have else F.lit(None).alias(f))
        return self._with(self.df.select("vs", "ve", *self.keys, *out), props=self.props)

    def flat_map(self, array, name="item", keep=()) -> "TemporalFrame":
        """One row per element of an array expression (over payload, `vs` and keys)."""
        df = self.df.select("vs", "ve", *self.keys, *keep, F.explode(col(array)).alias(name))
        return self._with(df, props=self.props)

    def flat_map_pandas(self, fn, schema: str) -> "TemporalFrame":
        """Flat-map by an opaque function from pandas batch to pandas batch."""
        return self._with(self.df.mapInPandas(lambda it: (fn(b) for b in it), schema), props=self.props)

    def flat_map_table(self, udtf, args, out: list[str]) -> "TemporalFrame":
        """Flat-map by a registered Python table function, joined laterally to each row."""
        call = udtf(*[F.col(a).outer() for a in args])
        df = self.df.lateralJoin(call).select("vs", "ve", *self.keys, *self.payload, *out)
        return self._with(df, props=self.props)

    def pivot(self, rows, attribute, value, names: list[str], agg) -> "TemporalFrame":
        """One column per attribute value: a single snapshot aggregate with one filter per output field."""
        made = {n: agg(col(value)).where(col(attribute) == n) for n in names}
        return self.group_aggregate(rows, **made)

    def unpivot(self, ids: list[str], values: list[str], attribute="attribute", value="value"):
        """One row per non-null value column."""
        df = self.df.unpivot(["vs", "ve", *self.keys, *ids], values, attribute, value)
        return self._with(df.where(F.col(value).isNotNull()), props=self.props)
