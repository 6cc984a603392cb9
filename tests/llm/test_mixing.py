"""Mixing: raked margins, calibrated probabilities, the draw."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidespan.llm import mixing


def corpus(spark, n=600):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        text = "word " * rng.randint(1, 60) + ("a | b | " * 3 if i % 5 == 0 else "") + ("x@y.z " if i % 7 == 0 else "")
        rows.append((i, text, "s0" if i % 3 else f"s{i % 4}", rng.choice(["en", "de", None]), "old", 1))
    rows += [(None, "no key", "s0", "en", "old", 1), (0, rows[0][1], "s0", "en", "old", 1), (n, None, None, None, None, None)]
    rows += [(n + 1, "", "s1", "de", "old", 1), (n + 2, "long " * 50_000, "s1", "de", "old", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string, p int")


def test_topics(spark):
    texts = ["", "plain", "a | b", "a@b", "a@b@c | d", "%%% &&& x | y", "All rights reserved"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.topic(F.col("t")).alias("topic"))
    got = [r.topic for r in df.collect()]
    assert got == ["prose", "prose", "listing", "contact", "contact", "markup", "rights"]


def shares_of(spark, **given):
    return {m: spark.createDataFrame(list(v.items()), f"{m} string, share double") for m, v in given.items()}


def test_margins_are_reached(spark):
    cells = [(s, la, t, (i * 37 + j * 11 + k * 5) % 90 + 10) for i, s in enumerate("abc") for j, la in enumerate(["x", None]) for k, t in enumerate("pq")]
    total = sum(c[3] for c in cells)
    cells = spark.createDataFrame(cells, "source string, lang string, topic string, n long")
    aims = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.4, None: 0.6}, "topic": {"p": 0.7, "q": 0.3}}
    out, report = mixing.fitted(cells, shares_of(spark, **aims), fraction=0.05)
    out = out.collect()
    assert sum(r.n * r.p for r in out) == pytest.approx(0.05 * total) and max(r.p for r in out) < 1
    for margin, shares in aims.items():
        for value, share in shares.items():
            assert sum(r.n * r.p for r in out if r[margin] == value) == pytest.approx(share * 0.05 * total, rel=1e-5)
    assert all(r.reached == pytest.approx(r.target, abs=1e-6) for r in report.collect())
    # odds ratios, the interactions of the data, are kept
    by = {(r.source, r.lang, r.topic): r for r in out}
    odds = [by[k].p for k in (("a", "x", "p"), ("b", None, "p"), ("a", None, "p"), ("b", "x", "p"))]
    assert odds[0] * odds[1] == pytest.approx(odds[2] * odds[3], rel=1e-6)


def test_marks_and_samples(spark):
    rows, docs = corpus(spark)
    out = mixing.mark(docs, fraction=0.5)
    assert sorted(out.columns) == sorted("doc_id text source lang p topic tokens probability weight kept".split())
    marked = out.collect()
    assert len(marked) == len(rows)
    for r in marked:
        text = r.text or ""
        u = int(hashlib.md5((text if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:8], 16) / 2**32
        assert r.kept == (u < r.probability) and r.tokens == -(-len(text.encode()) // 4) and 0 <= r.probability <= 1
    expected = sum(r.tokens * r.probability for r in marked)
    assert expected == pytest.approx(0.5 * sum(r.tokens for r in marked), rel=1e-6)
    kept = mixing.sample(docs, fraction=0.5)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(r.doc_id) for r in marked if r.kept)


def test_no_rows_and_no_tokens(spark):
    _, docs = corpus(spark, 10)
    assert mixing.mark(docs.limit(0)).count() == 0
    blank = docs.where("coalesce(text, '') = ''")
    assert [r.kept for r in mixing.mark(blank).collect()] == [False, False]


def test_bounded_samples_meet_their_targets(spark):
    tokens_ = [8249, 191, 111, 9937, 234, 174, 2008, 491, 6013, 291, 8298, 435]
    sizes = dict(zip(itertools.product(("a", None, "c"), "xy", "pq"), tokens_, strict=True))
    cells = spark.createDataFrame([(*k, n) for k, n in sizes.items()], "source string, lang string, topic string, n long")
    aims = {m: mixing.tempered(cells, m, mixing.TEMPERATURES[m]) for m in mixing.MARGINS}
    out, report = mixing.fitted(cells, aims, 0.6)
    out = out.collect()
    assert all(0 <= r.p <= 1 for r in out) and any(r.p == 1 for r in out)
    assert sum(r.n * r.p for r in out) == pytest.approx(0.6 * sum(sizes.values()), rel=1e-4)
    assert all(r.reached == pytest.approx(r.target, abs=1e-4) for r in report.collect())


def test_targets_that_cannot_be_met_are_reported(spark):
    cells = spark.createDataFrame([("a", "x", "p", 900), ("b", "x", "p", 100), ("b", "y", "p", 0)], "source string, lang string, topic string, n long")
    aims = shares_of(spark, source={"a": 0.5, "b": 0.5}) | {m: mixing.tempered(cells, m, 1.0) for m in ("lang", "topic")}
    out, report = mixing.fitted(cells, aims, 0.8)
    b = next(r for r in report.collect() if (r.margin, r.value) == ("source", "b"))
    assert (b.target, b.reached, b.available) == pytest.approx((0.5, 0.125, 0.125))
    assert {(r.source, r.lang): r.p for r in out.collect()}["b", "x"] == 1


def test_values_without_a_target_get_nothing(spark):
    cells = spark.createDataFrame([("a", "x", "p", 50), ("b", "x", "p", 50)], "source string, lang string, topic string, n long")
    aims = shares_of(spark, source={"a": 1.0, "z": 3.0}) | {m: mixing.tempered(cells, m, 1.0) for m in ("lang", "topic")}
    out, _ = mixing.fitted(cells, aims, 0.3)
    assert {r.source: round(r.p, 6) for r in out.collect()} == {"a": 0.6, "b": 0.0}


def test_reported_margins_and_tied_topics(spark):
    rows, docs = corpus(spark)
    assert {r.margin for r in mixing.margins(docs).collect()} == set(mixing.MARGINS)
    tied = spark.createDataFrame([(1, "a | b @ c", "s", "en"), (2, "@" * 9 + " | " * 9 + "x" * 200_000, "s", "en")], "doc_id long, text string, source string, lang string")
    assert [r.topic for r in mixing.mark(tied).collect()] == ["listing", "listing"]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_given_tables_meet_their_targets(spark, sf):
    """On the given tables every share is met to within a thousandth."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    report = mixing.margins(docs).collect()
    assert max(abs(r.target - r.reached) for r in report) < 1e-3


def test_no_python_on_the_main_path(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = mixing.mark(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_many_cells_are_raked_alike(spark, monkeypatch):
    """Cells that do not fit one partition are shuffled by margin, to the same shares."""
    sizes = {k: 50 + 37 * i % 400 for i, k in enumerate(itertools.product(("a", None, "c"), "xy", "pq"))}
    cells = spark.createDataFrame([(*k, n) for k, n in sizes.items()], "source string, lang string, topic string, n long")
    aims = {m: mixing.tempered(cells, m, mixing.TEMPERATURES[m]) for m in mixing.MARGINS}
    found = []
    for limit in (mixing.CELL_ROWS, 5):
        monkeypatch.setattr(mixing, "CELL_ROWS", limit)
        out, _ = mixing.fitted(cells, aims, 0.7, rounds=4)
        found.append({(r.source, r.lang, r.topic): r.p for r in out.collect()})
    assert found[0] == pytest.approx(found[1], rel=1e-9)
