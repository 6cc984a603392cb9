"""Exact search over binary codes against brute force."""

import random

import numpy as np
import pytest

from tidespan.llm import hamming


def brute(rows, queries, k):
    known = {(i, c) for i, c in rows if i is not None and c is not None}
    out = []
    for q, c in {(i, c) for i, c in queries if i is not None and c is not None}:
        near = sorted(((c ^ d) & (2**64 - 1)).bit_count() * 10**9 + i for i, d in known if (i, d) != (q, c))[:k]
        out += [(q, n + 1, x % 10**9, x // 10**9) for n, x in enumerate(near)]
    return sorted(out)


def signed(c):
    return c - (1 << 64) if c >> 63 else c


def codes(seed, n=300):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    rows = []
    for i in range(n):
        c = centres[i % 4] if i % 3 == 0 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 3) if i % 2 else 0):
            c ^= 1 << rng.randrange(64)
        rows.append((i, signed(c)))
    return rows + [(n, None), (None, 5), rows[0], rows[0], (n + 1, 0), (n + 2, -1)]


@pytest.mark.parametrize("k,file_classes,query_block", [(10, 8192, 8192), (7, 16, 3), (400, 64, 16)])
def test_equals_brute_force(spark, k, file_classes, query_block):
    rows = codes(k)
    df = spark.createDataFrame(rows, "vec_id long, code long")
    out = hamming.nearest(df, df.where("vec_id % 20 = 0"), k, file_classes=file_classes, query_block=query_block)
    got = sorted(tuple(r) for r in out.select("query_id", "rank", "neighbour_id", "distance").collect())
    assert got == brute(rows, [r for r in rows if r[0] is not None and r[0] % 20 == 0], k)


def test_ties_and_clashing_columns(spark):
    """Many classes at one distance, one segment value in most codes, and columns named like the operator's own."""
    rows = [(i, signed((1 << 63) | (1 << i % 40) | (1 << i % 23))) for i in range(400)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "vec_id long, code long, query string, distance int, n int")
    out = hamming.nearest(df, df.where("vec_id % 20 = 0"), 5, file_classes=8, query_block=4)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, [r for r in rows if r[0] % 20 == 0], 5)


def test_probes_follow_the_open_queries(spark, monkeypatch):
    """Each round sends open queries only, and no row for each pair of a block of classes and a query."""
    sent = []
    settled = hamming._probes

    def watched(open_, segments, radius):
        sent.append((radius, open_.count(), segments))
        return settled(open_, segments, radius)

    monkeypatch.setattr(hamming, "_probes", watched)
    rows = [(i, signed(random.Random(i // 40).getrandbits(64) ^ (1 << i % 40))) for i in range(2000)]
    rows += [(3000 + i, signed(random.Random(-1 - i).getrandbits(64))) for i in range(0, 100, 20)]
    df = spark.createDataFrame(rows, "vec_id long, code long")
    assert hamming.nearest(df, df.where("vec_id % 20 = 0"), 10).count() == 105 * 10
    opened = [n for _, n, _ in sent]
    assert opened[0] == 105 and max(opened[1:]) < 10 and opened == sorted(opened, reverse=True)


def test_sign_codes(spark):
    vectors = [[1.0, -1.0] * 32, [0.0] * 64, [None, 2.0] + [0.0] * 62, [1.0] * 63, None, [-1.0] * 63 + [1.0]]
    df = spark.createDataFrame([(v,) for v in vectors], "embedding array<float>")
    got = [r.c for r in df.select(hamming.sign_code().alias("c")).collect()]
    assert got == [0x5555555555555555, 0, 2, None, None, -(2**63)]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, code long")
    some = spark.createDataFrame([(1, 2)], "vec_id long, code long")
    for rows, queries in ((empty, empty), (empty, some), (some, empty), (some, some)):
        assert hamming.nearest(rows, queries, 3).count() == 0
