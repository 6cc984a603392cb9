"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidespan.llm import queries, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest=1, buckets=10_000):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def slow_marks(docs, target, longest=1, buckets=10_000, least=20, percent=10):
    found = [(key, *features(text, longest, buckets)) for key, text in docs]
    s = Counter(b for *_, f in found for b in f)
    t = Counter(b for text in target for b in features(text, longest, buckets)[1])
    size, total = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (size + buckets) / ((s[b] + 1) * (total + buckets)))) for b in range(buckets)]
    rows = []
    for key, words, f in found:
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def marks_of(out):
    return sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def documents(n=400):
    rng = np.random.default_rng(3)
    words = [f"W{i}é" if i % 7 else f"w-{i}" for i in range(90)]
    return [(int(i), " ".join(rng.choice(words, rng.integers(0, 60)))) for i in rng.permutation(n)]


EDGE = [(None, "some words " * 30), (None, None), (-5, ""), (2**40, "Tea 茶 " * 40), (3_000, "x" * 100_000), (3_001, "long " * 50_000)]


@pytest.mark.parametrize("options", [{}, {"longest": 2, "buckets": 50, "percent": 100}, {"least_words": 0, "percent": 37}])
def test_marks(spark, options, monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK_ROWS", (16, 64))  # many blocks, digits with many and with no rows
    docs, target = documents() + EDGE, ["w3é w4é w4é tea", None, "W8é " * 20]
    frame = spark.createDataFrame([(*r, "a", 1) for r in docs], "doc_id long, text string, rank string, seq int")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = resampling.mark(frame, goal, **options)
    names = {"longest": "longest", "buckets": "buckets", "percent": "percent", "least_words": "least"}
    assert marks_of(out) == slow_marks(docs, target, **{names[k]: v for k, v in options.items()})
    assert out.columns == ["doc_id", "seq", "n_features", "weight", "score", "rank"]


def test_equal_scores_and_repeated_rows(spark):
    """One text and key many times: ranks are whole, the rows any."""
    rows = [(7, "same words here " * 9)] * 50 + documents(60)
    out = resampling.mark(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("same",)], "text string"), percent=100)
    got, want = marks_of(out), slow_marks(rows, ["same"], percent=100)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert sorted(r[4] for r in got if r[4]) == sorted(r[4] for r in want if r[4])


def test_drawn_documents_keep_their_columns(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string")
    out = resampling.draw(docs, docs.limit(0), percent=20)
    assert out.columns == ["doc_id", "text", "n_features", "weight", "score", "rank"]
    assert sorted(r.rank for r in out.collect()) == list(range(1, out.count() + 1))


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.mark(none, none).collect() == []
    short = spark.createDataFrame([(1, "too short"), (2, None)], "doc_id long, text string")
    assert [r[4] for r in marks_of(resampling.mark(short, short))] == [None, None]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    read = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    docs = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    target = [r.text for r in read("benchmark").collect()]
    assert marks_of(queries.QUERIES["op13_importance_resampling"](spark, sf)) == slow_marks(docs, target)
