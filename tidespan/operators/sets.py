"""Union, sharing and ordering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F


class SetOps:
    def union(self, *others) -> "TemporalFrame":
        """Bag union of frames with the same columns."""
        df = reduce(lambda a, b: a.unionByName(b), [o.df for o in others], self.df)
        return self._with(df, wide=any(f._wide for f in (self, *others)))

    def ordered_union(self, *others, source="src") -> "TemporalFrame":
        """Union that remembers the input number, so that ties in time have a fixed order at the sink."""
        frames = [self, *others]
        tagged = [f.df.withColumn(source, F.lit(i)) for i, f in enumerate(frames)]
        return self._with(reduce(lambda a, b: a.unionByName(b), tagged), wide=any(f._wide for f in frames))

    def multicast(self, fn, other=None):
        """Feed this frame to a function of sub-queries; `other` is passed as second argument."""
        return fn(self) if other is None else fn(self, other)

    def copies(self, n: int) -> list["TemporalFrame"]:
        """n independent consumers of the same rows."""
        return [self._with(self.df, props=self.props) for _ in range(n)]

    def in_order(self, *ties):
        """Rows in time order, as a sorted DataFrame for a sink."""
        return self.df.orderBy("vs", *ties)

    def in_order_per_partition(self, *ties) -> "TemporalFrame":
        return self._with(self.df.sortWithinPartitions(*self.keys, "vs", *ties), props=self.props)
