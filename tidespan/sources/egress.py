"""Turn frames back into rows, arrays, files and views."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from ..functions.time import INF, col
from ..plans.slices import SLICE, Cuts, match
from ..plans.timeline import instants, with_running


class EgressOps:
    def to_events(self, *order) -> DataFrame:
        """Interval rows, sorted by time."""
        return self.df.orderBy("vs", *order)

    def to_changelog(self) -> DataFrame:
        """Edge rows (sync, other, kind): a start edge for each row, an end edge for each finite one."""
        rest = [*self.keys, *self.payload]
        edges = F.array(
            F.struct(F.col("vs").alias("sync"), F.lit(INF).alias("other"), F.lit("start").alias("kind")),
            F.struct(F.col("ve").alias("sync"), F.col("vs").alias("other"), F.lit("end").alias("kind")),
        )
        df = self.df.select(*rest, F.explode(edges).alias("_e")).select("_e.*", *rest)
        return df.where(F.col("sync") < INF)

    def to_rows(self, **exprs) -> DataFrame:
        """Result rows built from `vs`, `ve`, keys and payload."""
        return self.df.select(*[col(e).alias(n) for n, e in exprs.items()])

    def to_table(self) -> DataFrame:
        """Payload and keys without time."""
        return self.df.drop("vs", "ve")

    def to_arrays(self, size: int, order="vs", tie=None, name="items") -> DataFrame:
        """Arrays of `size` consecutive rows per key, in time order, numbered by `chunk`.

        Rows with the same time are ordered by `tie`, which must make (key, time, tie) unique.
        """
        tie = tie or order
        cols, at = self.df.columns, [*self.keys, order]
        # rows before each instant, then rows before each row within its instant; both counts are sliced
        tl = instants(self.df, self.keys, order, Cuts(self.df, self.keys, order), _n=F.count(F.lit(1)))
        tl = with_running(tl, self.keys, order, {"_n": "_upto"})
        cond = match("l", "r", at)
        rows = self.df.alias("l").join(tl.alias("r"), cond).select("l.*", (F.col("r._upto") - F.col("r._n")).alias("_before"))
        if tie != order:
            rows = Cuts(self.df, self.keys, tie).attach(rows, tie).withColumn("_one", F.lit(1).cast("long"))
            rows = with_running(rows.repartition(*at, SLICE), at, tie, {"_one": "_nth"})
        else:
            rows = rows.withColumn("_nth", F.lit(1).cast("long"))
        pos = F.col("_before") + F.col("_nth") - 1
        rows = rows.withColumn("chunk", F.floor(pos / size)).withColumn("_pos", pos)
        item = F.struct(F.col("_pos"), F.struct(*[c for c in cols if c not in self.keys]).alias("_v"))
        out = rows.groupBy(*self.keys, "chunk").agg(F.array_sort(F.collect_list(item)).alias(name))
        return out.withColumn(name, F.transform(name, lambda x: x["_v"]))

    def as_of(self, t) -> DataFrame:
        """The rows active at time `t`."""
        t = F.lit(t) if isinstance(t, int) else t
        return self.df.where((F.col("vs") <= t) & (F.col("ve") > t)).drop("vs", "ve")

    def cache(self, limit: int = 0, infer: bool = False) -> "TemporalFrame":
        """Materialise for replay, optionally only the first `limit` rows in time.

        Rows of equal start go by end and then by their other columns. With `infer`, facts that hold for all rows are
        declared for the cheaper plans that they allow: one constant duration, starts on a grid of that width, or no ends.
        """
        df = self.df
        if limit:
            rest = [c for c in df.columns if c not in ("vs", "ve")]
            df = df.orderBy("vs", "ve", *rest).limit(limit)
        out = self._with(df.persist(StorageLevel.MEMORY_AND_DISK), props=self.props)
        return out.infer() if infer else out

    def infer(self) -> "TemporalFrame":
        """Declare what one look at all lifetimes shows: duration, hop and offset, or open ends."""
        length = F.when(F.col("ve") < INF, F.col("ve") - F.col("vs"))
        seen = self.df.agg(
            F.min(length).alias("least"), F.max(length).alias("most"), F.min("vs").alias("first"),
            F.count_if(F.col("ve") >= INF).alias("open"), F.count_if(F.col("ve") < INF).alias("closed"),
        ).first()
        if seen.open and not seen.closed:
            return self._with(self.df, props=self.props.but(open_ended=True, duration=None, hop=None))
        if seen.open or not seen.closed or seen.least != seen.most:
            return self
        width, offset = seen.least, seen.first % seen.least
        aligned = self.df.where(F.pmod(F.col("vs"), F.lit(width)) != offset).isEmpty() if width > 1 else False
        hop = {"hop": width, "offset": offset} if aligned else {"hop": None}
        return self._with(self.df, props=self.props.but(duration=width, open_ended=False, **hop))

    def write(self, path: str, partition_by=(), mode="overwrite") -> None:
        writer = self.df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
