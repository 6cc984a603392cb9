"""Joins by overlap alone: whole answers, made block by block and written in few bytes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidespan import TemporalFrame


def some(spark, n, seed, longest, extra=()):
    """Rows at random times, after the given ones."""
    rng = np.random.default_rng(seed)
    vs = rng.integers(0, 20_000, n)
    rows = [(int(a), int(a + d), i) for i, (a, d) in enumerate(zip(vs, rng.integers(1, longest, n), strict=True))]
    return spark.createDataFrame([*extra, *rows], "vs bigint, ve bigint, x bigint")


def frames(spark, left, right):
    return TemporalFrame(left), TemporalFrame(right.withColumnRenamed("x", "y"))


def brute(left, right):
    a, b = (f.df.collect() for f in (left, right))
    return sorted((max(p.vs, q.vs), min(p.ve, q.ve), p.x, q.y) for p in a for q in b if p.vs < q.ve and q.vs < p.ve)


@pytest.mark.parametrize("longest", [2, 40, 3000, 40_000])
def test_blocks_find_every_pair_once(spark, monkeypatch, longest):
    from tidespan.functions.time import INF
    from tidespan.plans import overlap

    monkeypatch.setattr(overlap, "PAIRS_PER_ROW", 0)
    opened = [(5, INF, -1), (19_000, INF, -2)]
    left, right = frames(spark, some(spark, 400, 1, longest, opened), some(spark, 300, 2, 3 * longest, opened[1:]))
    got = sorted(tuple(r) for r in left.join(right, []).df.select("vs", "ve", "x", "y").collect())
    assert got == brute(left, right)


def test_blocks_of_wide_rows_are_small(spark):
    from tidespan.plans.overlap import BLOCK_ROWS, blocks

    wide = F.when(F.col("id") >= 500, F.repeat(F.lit("w"), 6400))
    df = spark.range(1000).select(F.lit(0).alias("k"), F.col("id").alias("t"), wide.alias("w"))
    got = blocks(df, ["k"], "t", "t", "t", "_p").select(F.size("_p").alias("n"), "_p_lo", "_p_hi").collect()
    assert sum(r.n for r in got) == 1000 and all(r._p_hi - r._p_lo + 1 == r.n for r in got)
    assert max(r.n for r in got) <= BLOCK_ROWS and max(r.n for r in got if r._p_lo >= 500) <= 3


def test_payload_of_any_type_and_conditions(spark, monkeypatch):
    from tidespan.plans import overlap

    monkeypatch.setattr(overlap, "PAIRS_PER_ROW", 0)
    left, right = frames(spark, some(spark, 50, 3, 2000), some(spark, 50, 4, 2000))
    left = left._with(left.df.select("vs", "ve", F.create_map("x", F.lit("a")).alias("odd name"), "x"))
    got = left.join(right, [], residual=lambda a, b: a("x") < b("y")).df
    want = [r for r in brute(left, right) if r[2] < r[3]]
    assert sorted(tuple(r) for r in got.select("vs", "ve", "x", "y").collect()) == want
    assert got.where("`odd name`[x] = 'a'").count() == len(want)


def test_only_dense_answers_are_made_in_blocks(spark):
    """Lifetimes that hardly overlap, and those of which many are active at once, also if only for a short while."""
    from tidespan.plans.overlap import dense
    from tidespan.plans.slices import Cuts

    sparse = some(spark, 3000, 7, 10)
    short = sparse.withColumn("vs", F.col("vs") % 50).withColumn("ve", F.col("vs") + 9)
    burst = short.unionByName(sparse.withColumns({c: F.col(c) + 10**9 for c in ("vs", "ve")}))
    for df, wanted in ((sparse, False), (burst, True), (sparse.limit(0), False)):
        assert dense(df, df, "vs", "ve", Cuts(df, [], "vs")) is wanted


def test_dense_answers_take_few_bytes_and_many_tasks(spark, tmp_path):
    """All pairs that overlap, without a key: consecutive ones are alike, and no task has most of them."""
    left, right = frames(spark, some(spark, 6000, 5, 4000), some(spark, 6000, 6, 4000))
    a, b = (np.array(f.df.select("vs", "ve").collect()) for f in (left, right))
    # pairs: all, less those of which one has ended when the other starts
    ended = sum(np.searchsorted(np.sort(p[:, 1]), q[:, 0], "right").sum() for p, q in ((a, b), (b, a)))
    out = left.join(right, []).df
    out.write.parquet(str(tmp_path / "pairs"))
    files = list((tmp_path / "pairs").glob("*.parquet"))
    written = spark.read.parquet(str(tmp_path / "pairs"))
    by_file = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
    assert sum(by_file) == 6000 * 6000 - ended > 5_000_000
    assert sum(f.stat().st_size for f in files) < 0.75 * sum(by_file)
    assert max(by_file) < 0.25 * sum(by_file)
