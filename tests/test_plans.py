"""Physical plans: no nested loops, pruned and filtered scans, hot groups split."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"

SHUFFLED = [
    "cross_join", "anti_join_unkeyed", "inner_join", "clip_by_stream", "count", "count_by_return_flag",
    "session_unkeyed", "maximum", "top_k", "left_outer_join", "toll_cross_join", "changing_limit",
]


def plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString(), df


@pytest.mark.parametrize("name", SHUFFLED)
def test_no_nested_loops(spark, name):
    text, _ = plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in text
    assert "CartesianProduct" not in text


def test_filter_and_columns_reach_the_scan(spark):
    text, _ = plan(spark, "where")
    assert "EqualTo(event_type,view)" in text
    assert "props" not in text


def test_only_used_columns_are_read(spark):
    text, _ = plan(spark, "perf_count")
    read = text.split("ReadSchema: ")[1].split(">")[0]
    assert read == "struct<l_shipdate:timestamp_ntz"


def test_tumbling_counts_need_one_shuffle(spark):
    text, _ = plan(spark, "snapshot_tumbling")
    assert text.count("Exchange") == 1
    assert "partial_sum" in text


def test_windows_are_split_by_slice(spark):
    """A running aggregate over three groups, each a third of the rows, orders rows per (group, slice)."""
    text, _ = plan(spark, "count_by_return_flag")
    windows = [line for line in text.splitlines() if " Window " in line or "- Window" in line]
    over_rows = [w for w in windows if "_t#" in w.split("windowspecdefinition(")[1]]
    assert over_rows and all("_slice#" in w for w in over_rows)


def test_slices_are_balanced(spark):
    """The slice of a hot key holds about its share, whatever the distribution of times."""
    from pyspark.sql import functions as F

    from tidespan.plans.slices import Cuts

    t = F.pow(F.col("id") / 1000, F.lit(5)).cast("long")  # times crowd at the beginning
    df = spark.range(20000).select(t.alias("vs"), F.lit("hot").alias("k"), "id")
    cuts = Cuts(df, ["k"], "vs")
    sizes = [r["count"] for r in cuts.attach(df, "vs").groupBy("_slice").count().collect()]
    crowd = df.groupBy("vs").count().agg(F.max("count")).first()[0]
    assert max(sizes) <= 2 * 20000 / cuts.count + crowd


def test_small_side_is_measured_before_broadcast(spark, monkeypatch):
    from tidespan.operators import joins

    monkeypatch.setattr(joins, "SMALL_BYTES", 100)
    text, df = plan(spark, "broadcast_join")
    assert "ResolvedHint (strategy=broadcast)" not in df._jdf.queryExecution().analyzed().toString()


def test_slices_are_balanced_on_fractions_and_texts(spark):
    from pyspark.sql import functions as F

    from tidespan.plans.slices import Cuts

    df = spark.range(20000).select(F.rand(1).alias("x"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    for column in ("x", "t"):
        cuts = Cuts(df, [], column)
        sizes = [r["count"] for r in cuts.attach(df, column).groupBy("_slice").count().collect()]
        assert len(sizes) == cuts.count and max(sizes) <= 2 * 20000 / cuts.count


def test_slices_follow_the_setting(spark):
    from tidespan.plans.slices import slice_count

    spark.conf.set("tidespan.slices", "20000")
    try:
        assert slice_count(spark) == 1 << 15
    finally:
        spark.conf.unset("tidespan.slices")


def test_levels_per_key(spark):
    """Short keys beside a long one are looked up on their own few levels."""
    from pyspark.sql import functions as F

    from tidespan.plans.ranks import blocks_and_lookups
    from tidespan.plans.slices import Cuts

    hot = spark.range(1024).select(F.lit(-1).cast("long").alias("k"), F.col("id").alias("vs"), F.lit(5000).cast("long").alias("ve"))
    cold = spark.range(500).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("vs"), F.lit(2).cast("long").alias("ve"))
    df = hot.unionByName(cold)
    _, lookups = blocks_and_lookups(df, ["k"], Cuts(df, ["k"], "vs"))
    assert lookups.where("k >= 0").count() == 500


def test_anti_join_has_no_copies_outside_the_right_side(spark):
    """A left row is filed for the gaps between right rows only; before and after them it needs no bucket."""
    from pyspark.sql import functions as F

    from tidespan import INF, TemporalFrame

    left = spark.range(2000).select(F.col("id").alias("vs"), F.lit(INF).alias("ve"), "id")
    right = spark.createDataFrame([(100, 110), (105, 120)], "vs long, ve long")
    out = TemporalFrame(left).where_not_exists(TemporalFrame(right))
    assert out.df.count() == 2000 + 100  # rows that begin before 100 live before and after, others once
    assert out.df.where("vs < 120 AND ve > 100").isEmpty()


def test_stream_inspection(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidespan.streaming.runner import QueryContainer, replay

    rows = spark.range(10).select(F.col("id").alias("vs"), (F.col("id") + 1).alias("ve"))
    replay(str(tmp_path / "in"), rows)
    box = QueryContainer(spark, str(tmp_path / "home"))
    stream = box.register_input("in", str(tmp_path / "in"), rows.schema)
    box.register_output("out", stream.withColumn("at", F.timestamp_micros("vs")).withWatermark("at", "1 second").drop("at"))
    box.run()
    assert box.progress("out")["input_rows"] in (0, 10) and box.result("out").count() == 10
    assert "FileScan" in box.plan("out") or "StreamingRelation" in box.plan("out") or "Scan" in box.plan("out")
    box.run()  # nothing new: the input is what the output waits for
    assert box.waiting_inputs() == ["out"]


@pytest.mark.parametrize("name", ["snapshot_hopping", "snapshot_sliding"])
def test_constant_lifetimes_need_no_tree(spark, name):
    """Panes are merged before the first shuffle, and nothing is written in between."""
    text, _ = plan(spark, name)
    scans = [line for line in text.splitlines() if "Scan parquet" in line]
    assert scans and all("events.parquet" in s for s in scans) and "_lvl" not in text
    assert "partial_" in text


def test_percentiles_scan_each_stretch_once(spark, monkeypatch):
    """However many distinct values there are, there is one sweep and one scan."""
    from tidespan.plans import quantiles

    calls = []
    for name in ("sweep", "scan_ordered"):
        monkeypatch.setattr(quantiles, name, lambda *a, f=getattr(quantiles, name), n=name, **k: calls.append(n) or f(*a, **k))
    entry.queries()["percentile_continuous"](spark, SF)
    assert calls == ["sweep", "scan_ordered"]


def test_several_families_of_aggregates_scan_their_input_once(spark, monkeypatch):
    """Sums, extremes and deviations share one timeline: the table is written once, and read from there."""
    from tidespan.operators import aggregate

    texts = []
    monkeypatch.setattr(aggregate, "settle", lambda df, f=aggregate.settle: texts.append(df._jdf.queryExecution().executedPlan().toString()) or f(df))
    final, _ = plan(spark, "multi_aggregate")
    assert len(texts) == 1 and texts[0].count("events.parquet") == 1 and "events.parquet" not in final
