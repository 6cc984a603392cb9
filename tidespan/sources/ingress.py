"""Build temporal frames from tables, change logs and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..frame import Props, TemporalFrame
from ..functions.time import INF, MIN_T, col, micros, snap_left
from ..plans.slices import BEFORE, SLICE, Cuts, carry, local, match
from ..plans.timeline import instants, with_latest, with_running
from .scratch import settle


def from_starts(df: DataFrame, start, keys=()) -> TemporalFrame:
    """Rows that live from `start` on."""
    df = df.withColumn("vs", col(start)).withColumn("ve", F.lit(INF))
    return TemporalFrame(df, keys, Props(open_ended=True))


def from_points(df: DataFrame, start, keys=()) -> TemporalFrame:
    df = df.withColumn("vs", col(start))
    return TemporalFrame(df.withColumn("ve", F.col("vs") + 1), keys, Props(duration=1))


def from_intervals(df: DataFrame, start, end, keys=(), check=True) -> TemporalFrame:
    """Rows that live in [start, end). With `check`, an empty lifetime fails the query."""
    df = df.withColumns({"vs": col(start), "ve": col(end)})
    if check:
        bad = F.raise_error(F.concat(F.lit("empty lifetime at "), F.col("vs").cast("string")))
        df = df.withColumn("ve", F.when(F.col("vs") < F.col("ve"), F.col("ve")).otherwise(bad))
    return TemporalFrame(df, keys)


def from_timestamps(df: DataFrame, ts, keys=(), end=None) -> TemporalFrame:
    """Points (or intervals up to `end`) from TIMESTAMP_NTZ columns, in microseconds."""
    if end is None:
        return from_points(df, micros(ts), keys)
    return from_intervals(df, micros(ts), micros(end), keys)


def from_changelog(df: DataFrame, sync="sync", other="other", keys=()) -> TemporalFrame:
    """Pair end edges with start edges.

    Edges have `other = INF` for starts and `other = start time` for ends (`sync > other`); rows with
    `sync < other < INF` are intervals already. A start without an end stays open. Equal rows are a bag: with n
    starts and m ends at times e1 <= e2 <= ..., the first m starts get those ends. More ends than starts fail the query.
    """
    rest = [c for c in df.columns if c not in (sync, other)]
    s, o = F.col(sync), F.col(other)
    start = F.when(s > o, o).otherwise(s)
    end = F.when(s > o, s).when(o < INF, o)
    edges = df.select(*rest, start.alias("vs"), end.alias("_end"), ((o < INF) & (s < o)).alias("_whole"))
    whole = edges.where("_whole").select("vs", F.col("_end").alias("ve"), *rest)
    # counts per distinct edge: a hot row is one group of counts, not a list of copies
    bag = (
        edges.where("not _whole")
        .groupBy(*rest, "vs")
        .agg(F.count(F.when(F.col("_end").isNull(), 1)).alias("_starts"))
    )
    ends = (
        edges.where("not _whole and _end is not null").groupBy(*rest, "vs", "_end").agg(F.count("*").alias("_n"))
    )
    total = ends.groupBy(*rest, "vs").agg(F.sum("_n").alias("_m"))
    cond = match("l", "r", [*rest, "vs"])
    lone = F.raise_error(F.concat(F.lit("end edge without a start at "), F.col("l._end").cast("string")))
    known = bag.alias("b").join(total.alias("t"), match("b", "t", [*rest, "vs"])).select("b.*", "t._m")
    paired = ends.alias("l").join(known.alias("r"), cond).select(
        "l.vs", F.when(F.col("r._m") <= F.col("r._starts"), F.col("l._end")).otherwise(lone).alias("ve"),
        *[F.col(f"l.`{c}`") for c in rest], "l._n",
    )
    closed = paired.select("vs", "ve", *rest, F.explode(F.expr("sequence(1L, _n)")).alias("_i"))
    left = bag.alias("l").join(total.alias("r"), cond, "left").select("l.*", "r._m")
    left = left.withColumn("_open", F.col("_starts") - F.coalesce("_m", F.lit(0))).where("_open > 0")
    still = left.select("vs", F.lit(INF).alias("ve"), *rest, F.explode(F.expr("sequence(1L, _open)")).alias("_i"))
    df = whole.unionByName(closed.drop("_i")).unionByName(still.drop("_i"))
    return TemporalFrame(df, keys)


def from_sequence(df: DataFrame, order, per_tick: int = 1, keys=()) -> TemporalFrame:
    """Give timeless rows a time by position: `per_tick` rows share each tick, and rows stay open.

    `order` is a unique ordering column of any ordered type, a null being last; positions come from sliced counts, not
    from a global window.
    """
    df = df.withColumn("_o", col(order))
    tl = instants(df, [], "_o", Cuts(df, [], "_o"))
    tl = carry(
        tl, [], {"_n": F.count(F.lit(1))}, lambda w: {"_base": F.sum("_n").over(w.rowsBetween(*BEFORE))}
    )
    pos = F.row_number().over(local([]).orderBy(F.col("_o").asc_nulls_last())) - 1 + F.coalesce("_base", F.lit(0))
    tl = tl.select(F.col("_o").alias("_p"), F.floor(pos / per_tick).cast("long").alias("vs"))
    df = df.join(tl, F.col("_o").eqNullSafe(F.col("_p"))).drop("_o", "_p")
    return TemporalFrame(df.withColumn("ve", F.lit(INF)), keys, Props(open_ended=True))


def from_clock(df: DataFrame, keys=()) -> TemporalFrame:
    """Give timeless rows the query's wall-clock time."""
    return from_starts(df, F.unix_micros(F.current_timestamp()), keys)


def from_arrays(df: DataFrame, array, start, end=None, keys=()) -> TemporalFrame:
    """Rows packed as arrays of structs; `start` and `end` refer to fields of the struct."""
    rows = df.select(F.explode(col(array)).alias("_x")).select("_x.*")
    return from_starts(rows, start, keys) if end is None else from_intervals(rows, start, end, keys)


def from_files(spark: SparkSession, path: str, keys=(), schema=None) -> TemporalFrame:
    """Replay a frame written with `write`."""
    reader = spark.read.schema(schema) if schema else spark.read
    return TemporalFrame(reader.parquet(path), keys)


class Disorder:
    """Arrival-ordered rows and the rule for those that come late.

    Time at an arrival is the largest start seen before it minus `latency` (never below the start of time); with
    `per` each partition has a clock of its own. A row whose start lies before it is late. The running maximum
    is sliced over the arrival order.

    With `low_lag`, a low watermark holds for all partitions: the largest start seen before in any of them, minus that
    lag, snapped down to a multiple of `low_period`. Clocks behind it are raised to it.
    """

    def __init__(
        self, df: DataFrame, arrival: str, latency: int = 0, per=(), end="ve", low_lag: int | None = None, low_period: int = 1
    ):
        self.per = [per] if isinstance(per, str) else list(per)
        self.end = end
        self.columns = df.columns
        rows = Cuts(df, self.per, arrival).attach(df, arrival).repartition(*self.per, SLICE)
        seen = with_latest(rows, self.per, arrival, F.col("vs"), "_high", inclusive=False)
        clock = F.greatest(F.col("_high") - F.lit(latency), F.lit(MIN_T))
        self.rows = seen.drop(SLICE).withColumn("_now", F.coalesce(clock, F.lit(MIN_T)))
        if low_lag is not None:
            everywhere = Cuts(df, [], arrival).attach(self.rows, arrival).repartition(SLICE)
            everywhere = with_latest(everywhere, [], arrival, F.col("vs"), "_any", inclusive=False)
            low = snap_left(F.col("_any") - F.lit(low_lag), low_period)
            self.rows = everywhere.withColumn("_now", F.greatest("_now", low)).drop(SLICE, "_any")
        self.late = F.col("vs") < F.col("_now")

    def _frame(self, df, keys):
        return TemporalFrame(df.select(*self.columns), keys)

    def drop(self, keys=()) -> TemporalFrame:
        """Discard late rows."""
        return self._frame(self.rows.where(~self.late), keys)

    def adjust(self, keys=()) -> TemporalFrame:
        """Move late starts to the current time; rows already over are discarded."""
        df = self.rows.withColumn("vs", F.greatest("vs", "_now"))
        return self._frame(df.where(F.col("vs") < F.col(self.end)), keys)

    def strict(self, keys=()) -> TemporalFrame:
        """Fail the query when a late row is read."""
        bad = F.raise_error(F.concat(F.lit("late row at "), F.col("vs").cast("string")))
        return self._frame(self.rows.withColumn("vs", F.when(self.late, bad).otherwise(F.col("vs"))), keys)

    def report(self, policy: str) -> DataFrame:
        """Late rows with what was done to them: `action` and, for moved rows, the `delta`."""
        late = self.rows.where(self.late)
        over = F.lit(policy == "drop") | (F.col("_now") >= F.col(self.end))
        return late.select(
            *self.columns,
            F.when(over, "dropped").otherwise("adjusted").alias("action"),
            F.when(~over, F.col("_now") - F.col("vs")).alias("delta"),
        )


class DisorderedEdges(Disorder):
    """Start and end edges in order of arrival, and the rule for those that come late.

    Of a start edge `vs` is its start, of an end edge the end, with the row's start in the column `start`. What happens to a
    late start happens to its row: an end edge takes the first start of its own payload and original start that was
    late and has not met an end yet. An end edge that finds none is on its own, and late if time has passed it.

    Such queues are a walk that goes up with each late start and down with each end, but not below zero. Its height is
    the running sum less its lowest point so far, both sliced over the arrival order, and the numbers of late starts and of
    ends that found one are what joins them.
    """

    def __init__(self, df: DataFrame, arrival: str, is_start, start: str, payload, latency: int = 0, per=(), **low):
        super().__init__(df, arrival, latency, per, **low)
        self.start, self.payload = start, list(payload)
        rows = settle(self.rows.withColumn("_begins", col(is_start)))
        self.rows = rows
        queue = [*dict.fromkeys([*self.per, *self.payload]), "_origin"]
        step = F.when(F.col("_begins") & self.late, 1).when(~F.col("_begins"), -1)
        walk = rows.withColumn("_origin", F.when(F.col("_begins"), F.col("vs")).otherwise(F.col(start)))
        walk = walk.withColumn("_step", step.cast("long")).where("_step IS NOT NULL")
        walk = Cuts(walk, queue, arrival).attach(walk, arrival).repartition(*queue, SLICE)
        walk = with_running(walk, queue, arrival, {"_step": "_sum"})
        walk = carry(
            walk, queue, {"_low": F.min("_sum")}, lambda w: {"_lows": F.min("_low").over(w.rowsBetween(*BEFORE))}
        )
        here = F.min("_sum").over(local(queue).orderBy(arrival).rowsBetween(*BEFORE))
        lowest = F.least(F.lit(0), here, F.col("_lows"))
        found = (F.col("_step") < 0) & (F.col("_sum") - F.col("_step") - lowest > 0)
        walk = walk.withColumn("_found", found).drop("_lows", "_sum")
        walk = walk.withColumn("_up", F.when(F.col("_step") > 0, 1).otherwise(0)).withColumn("_down", F.col("_found").cast("int"))
        walk = settle(with_running(walk, queue, arrival, {"_up": "_nth_up", "_down": "_nth_down"}))
        mine = walk.where("_found").select(*[F.col(q).alias(f"{q}_") for q in queue], F.col("_nth_down").alias("_nth_"), F.col(arrival).alias("_end"))
        starts = walk.where("_step > 0").select(*queue, "_nth_up", F.col("_now").alias("_moved"))
        same = F.col("_nth_up") == F.col("_nth_")
        for q in queue:
            same = same & F.col(q).eqNullSafe(F.col(f"{q}_"))
        linked = mine.join(starts, same).select(*[F.col(f"{k}_").alias(f"{k}_") for k in self.per], "_end", "_moved")
        at = F.col(arrival) == F.col("_end")
        for k in self.per:
            at = at & F.col(k).eqNullSafe(F.col(f"{k}_"))
        self.edges = rows.join(linked, at & ~F.col("_begins"), "left")

    def drop(self) -> DataFrame:
        """Edges without late starts, their ends, and other late ends."""
        return self.edges.where(~self.late & F.col("_moved").isNull()).select(*self.columns)

    def adjust(self) -> DataFrame:
        """Late edges at the time of their arrival; ends of moved starts carry the new start."""
        origin = F.when(~F.col("_begins"), F.coalesce("_moved", self.start)).otherwise(F.col(self.start))
        out = self.edges.withColumn(self.start, origin).withColumn("vs", F.greatest("vs", "_now"))
        return out.select(*self.columns)
