"""Exact and near duplicates against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tidespan.llm import exact_dedup, simhash

SCHEMA = "doc_id long, text string, kept string, row int"
EDGE = [
    (5, "a b", "x", 1),
    (3, "ab", None, 2),
    (4, " a\tb ", "x", 3),
    (9, None, "x", 4),
    (8, "", "x", 5),
    (7, " \n", "x", 6),
    (2, "alone", "x", 7),
    (None, "no key", "x", 8),
    (None, "no key", "x", 9),
    (6, "nokey", "x", 10),
    (11, "twice", "x", 11),
    (11, "twice", "x", 11),
    (12, "long " * 20_000, "x", 12),
    (13, "long" * 20_000, "x", 13),
]


def wanted(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    out = []
    for i, t, *_ in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[norm], key=lambda r: (r[0], r[1], r[2] or 0))
        kept = (-len(t or ""), i is None, i) == best
        out.append((i, best[2], len(groups[norm]), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_marks_copies(spark):
    out = exact_dedup.mark_copies(spark.createDataFrame(EDGE, SCHEMA))
    assert [c for c in out.columns if c == "kept"] == ["kept"] and "row" in out.columns
    got = out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == wanted(EDGE)


def test_drops_copies(spark):
    out = exact_dedup.drop_copies(spark.createDataFrame(EDGE, SCHEMA))
    assert out.columns == ["doc_id", "text", "kept", "row"]
    best = {r[4]: r[1] for r in wanted(EDGE)}  # of every text the key that stays
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted(best.values(), key=repr)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """With a bit for each row instead of sixteen, every row is suspected."""
    monkeypatch.setattr(exact_dedup, "BITS_PER_ROW", 1)
    monkeypatch.setattr(exact_dedup, "BLOCK_BITS", 512)
    rows = [(i, f"text {i % 150}") for i in range(300)]
    out = exact_dedup.mark_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    got = out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == wanted(rows)


def test_ranges_keep_the_filter_small(spark, monkeypatch):
    """With memory for one block, rows go by ranges of their hash, and few that are alone are suspected."""
    monkeypatch.setattr(exact_dedup, "MOST_BLOCKS", 1)
    monkeypatch.setattr(exact_dedup, "BLOCK_BITS", 1024)
    rows = [(i, f"text {i}") for i in range(400)] + [(1000 + i, f"again {i % 15}") for i in range(45)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, range int")
    got = exact_dedup.mark_copies(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == wanted(rows)
    alone, rest = exact_dedup._parts(docs, "text", "doc_id")
    assert 45 <= rest.count() <= 45 + 40 and alone.count() + rest.count() == len(rows)
    assert len(exact_dedup._ranges(docs, "text")) == 8


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.mark_copies(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0
    assert simhash.near_copies(empty).count() == 0
    assert simhash.drop_near_copies(empty).count() == 0


def slow_print(text, words=3):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not parts:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(parts[i : i + words]), 42) for i in range(max(1, len(parts) - words + 1))
    ]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "one two", "A b\tC d é É ß", "a a a a a", "x " * 5000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_print(text)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint(text) == slow_print(text)


def components_of(prints, radius):
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {p: top(p) for p in prints}


def some_prints(seed, n=300):
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    centres = [rng.getrandbits(64) for _ in range(8)]
    while len(out) < n:
        p = rng.choice(centres)
        for _ in range(rng.randint(0, 7)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_tiles_connect_what_is_near(radius):
    prints = some_prints(radius)
    left, right = simhash.linked(np.array(prints, dtype=np.uint64), radius, tile=16)
    assert len(left) < len(prints)  # a forest, not all pairs
    want = components_of(prints, radius)
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    assert {p: top(p) for p in prints} == want


@pytest.mark.parametrize("file_rows", [8192, 10])
def test_links_find_all_components(spark, file_rows):
    prints = some_prints(7, 200)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "print_ long"), 2, file_rows)
    roots = {r.node: r.root for r in simhash.components(found).collect()}
    want, groups = components_of(prints, 2), defaultdict(set)
    for p, r in want.items():
        groups[r].add(p - (1 << 64) if p >> 63 else p)
    for members in groups.values():
        assert {roots.get(m, m) for m in members} == {min(members)}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(5, 5)]
    got = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 40)}}


def test_near_copies(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(4, base, 1), (9, base + " tail", 2), (7, base.upper(), 3), (2, None, 4), (3, "", 5), (1, "own words here", 6)]
    rows += [(None, "own words here", 7), (1, "own words here", 8), (None, "nameless text without a key", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_copies(docs).collect()]
    prints = {p: None for p in (slow_print(t) for _, t, _ in rows)}
    roots = components_of(list(prints), 2)
    least = {}
    for i, t, _ in rows:
        r = roots[slow_print(t)]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = [(i, f"{slow_print(t):016x}", least[roots[slow_print(t)]]) for i, t, _ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    stay = sorted((i for i, _, c in want if i == c), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == stay
