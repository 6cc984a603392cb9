"""Profiling, declaring and checking stream properties."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.time import INF, snap_left
from ..plans.timeline import instants, with_latest, with_neighbours


class QualityOps:
    def declare(self, **facts) -> "TemporalFrame":
        """Assert properties (duration, hop, offset, open_ended) to enable a cheaper plan."""
        return self._with(self.df, props=self.props.but(**facts))

    def profile(self):
        """One row: number of rows, duration range, open ends, simultaneous and overlapping rows."""
        facts = self.df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(F.when(F.col("ve") < INF, F.col("ve") - F.col("vs"))).alias("min_duration"),
            F.max(F.when(F.col("ve") < INF, F.col("ve") - F.col("vs"))).alias("max_duration"),
            F.count(F.when(F.col("ve") >= INF, 1)).alias("n_open"),
        )
        starts = self._starts()
        ties = starts.agg(
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("n_simultaneous"),
            F.count(F.when(F.col("_before") > F.col("vs"), 1)).alias("n_overlapping_starts"),
        )
        # both sides are one-row aggregates
        return facts.select("*", *[ties.select(c).scalar().alias(c) for c in ties.columns])

    def _starts(self):
        """Distinct starts per key with their row count and the latest end of all earlier rows."""
        tl = instants(self.df, self.keys, "vs", self.cuts, _n=F.count(F.lit(1)), _end=F.max("ve"))
        return with_latest(tl, self.keys, "vs", F.col("_end"), "_before", inclusive=False)

    def violations(self):
        """Rows that break a declared property, with the property's name in `broken`."""
        p, checks = self.props, []
        length = F.col("ve") - F.col("vs")
        checks.append(("lifetime", F.col("ve") <= F.col("vs")))
        if p.duration is not None:
            checks.append(("duration", length != p.duration))
        if p.hop is not None:
            checks.append(("hop", snap_left("vs", p.hop, p.offset) != F.col("vs")))
        if p.open_ended:
            checks.append(("open_ended", F.col("ve") < INF))
        parts = [self.df.where(c).withColumn("broken", F.lit(n)) for n, c in checks]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def gaps_between_starts(self):
        """Distance from each distinct start to the next of its key."""
        tl = with_neighbours(instants(self.df, self.keys, "vs", self.cuts), self.keys, "vs")
        return tl.select(*self.keys, "vs", (F.col("_next") - F.col("vs")).alias("to_next"))
