"""Keys and data placement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import col


class PlacementOps:
    def group_by(self, *keys, **exprs) -> "TemporalFrame":
        """Add group keys. All operators work per key, so a sub-query per group is just further calls."""
        df = self.df.withColumns({n: col(e) for n, e in exprs.items()}) if exprs else self.df
        return self._with(df, keys=[*self.keys, *keys, *exprs], props=self.props)

    def ungroup(self, *keys) -> "TemporalFrame":
        """Turn key columns back into payload; without arguments all of them."""
        drop = keys or tuple(self.keys)
        return self._with(self.df, keys=[k for k in self.keys if k not in drop], props=self.props)

    def group_apply(self, keys, query) -> "TemporalFrame":
        """Run `query` within each group; the group keys become payload afterwards."""
        keys = [keys] if isinstance(keys, str) else list(keys)
        out = query(self.group_by(*keys))
        return out.ungroup(*keys)

    partition = group_by

    def rekey(self, *keys, **exprs) -> "TemporalFrame":
        df = self.df.withColumns({n: col(e) for n, e in exprs.items()}) if exprs else self.df
        return self._with(df, keys=[*keys, *exprs], props=self.props)

    def select_key(self, **exprs) -> "TemporalFrame":
        return self.select(*self.payload, **exprs)

    def map_reduce(self, mapper, keys, reducer) -> "TemporalFrame":
        """Map in parallel, then reduce per key."""
        return mapper(self).group_apply(keys, reducer)

    def map_reduce_with(self, other, mapper, other_mapper, keys, reducer) -> "TemporalFrame":
        """Two-input form: both sides are mapped and keyed, the reducer combines them per key."""
        keys = [keys] if isinstance(keys, str) else list(keys)
        out = reducer(mapper(self).group_by(*keys), other_mapper(other).group_by(*keys))
        return out.ungroup(*keys)

    def shard(self, n: int) -> "TemporalFrame":
        return self._with(self.df.repartition(n), props=self.props)

    def unshard(self) -> "TemporalFrame":
        return self

    reshard = shard

    def shuffle(self, *keys) -> "TemporalFrame":
        keys = keys or tuple(self.keys)
        return self._with(self.df.repartition(*[col(k) for k in keys]), props=self.props)

    def redistribute(self, n: int) -> "TemporalFrame":
        return self._with(self.df.repartition(n, *self.keys), props=self.props)

    def shard_number(self, n: int, *cols, name="shard") -> "TemporalFrame":
        """Shard number by hash of columns, as payload."""
        cols = cols or tuple(self.keys)
        df = self.df.withColumn(name, F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int"))
        return self._with(df, props=self.props)

    def broadcast_to(self, n: int, name="shard") -> "TemporalFrame":
        """One copy of every row per shard."""
        df = self.df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        return self._with(df, props=self.props)

    def send_to(self, shards, name="shard") -> "TemporalFrame":
        """A copy of each row for every shard in an array expression, laid out by shard."""
        df = self.df.withColumn(name, F.explode(col(shards)))
        return self._with(df.repartition(name), props=self.props)

    def split(self, n: int, name="shard") -> list["TemporalFrame"]:
        """The frames of the single shards."""
        return [self.where(F.col(name) == i) for i in range(n)]

    def query(self, fn, other=None) -> "TemporalFrame":
        return fn(self) if other is None else fn(self, other)
