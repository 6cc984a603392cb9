"""Near duplicates by SimHash, compared exactly in tiles.

Every text gets a 64-bit fingerprint. Rows with the same fingerprint are one class from the start, so a large group of
copies is one fingerprint. Distinct fingerprints within `radius` bits of each other agree on all but `radius` of
`radius + 2` equal segments, hence on two whole segments: they are filed under every pair of segments, and each file is
compared in tiles sorted by population count, with exclusive-or and bit counts; tile pairs whose population counts
differ by more than the radius are skipped. Files of more than `FILE_ROWS` fingerprints are split into parts, and each
pair of parts is a task of its own. A file reports links that connect what it found, never all pairs. Links between
files are joined into components by alternating star contractions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import replacing, settle, whole

WORDS = 3
RADIUS = 2
SEED = 42
BITS = 64
FILE_ROWS = 8192
TILE = 512
#: Shingles hashed at a time, which bounds the memory that a very long text takes.
CHUNK = 65_536


def fingerprint(text: str, words: int = WORDS) -> int:
    """Bit i is set if it is set in more than half of the hashes of the text's word shingles; no words: 0.

    A to Z are lowered; words are separated by space and U+0009 to U+000D; shingles are space-joined, repeats count, and
    a text with fewer words is one shingle. The hash is XXH64 with seed 42 over UTF-8.
    """
    import xxhash

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(parts) - words + 1)
    last = ends[min(words, len(parts)) - 1 :].tolist()
    first = starts[:count].tolist()
    hash_, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, count, CHUNK):
        spans = zip(first[at : at + CHUNK], last[at : at + CHUNK], strict=True)
        hashes = np.array([hash_(line[s:e], SEED) for s, e in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS) -> DataFrame:
    """Of every row the `key`, a `hash` of its text, and the signed 64-bit `print_`."""
    schema = f"key {docs.schema[key].dataType.simpleString()}, hash bigint, print_ bigint"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(prints.view(np.int64))], names=["key", "hash", "print_"]
            )

    body = whole(text)
    return docs.select(F.col(key).alias("key"), F.xxhash64(body).alias("hash"), body.alias("text")).mapInArrow(hashed, schema)


def _masks(radius: int) -> list[int]:
    """Bits that must agree: every pair of `radius + 2` segments."""
    edges = [BITS * i // (radius + 2) for i in range(radius + 3)]
    segments = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [a | b for a, b in combinations(segments, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked(prints: np.ndarray, radius: int, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all of the distinct `prints` that are within the radius of each other.

    Tiles of fingerprints in the order of their population counts are compared pairwise, unless the counts are too far
    apart. Of each fingerprint only its link to the first one found in a tile and links that join groups are kept.
    """
    prints = prints[np.argsort(np.bitwise_count(prints), kind="stable")]
    counts = np.bitwise_count(prints).astype(np.int64)
    root = np.arange(len(prints))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left, right = [], []
    for a in range(0, len(prints), tile):
        one = prints[a : a + tile]
        for b in range(a, len(prints), tile):
            if counts[b] - counts[a + len(one) - 1] > radius:
                break
            near = np.bitwise_count(one[:, None] ^ prints[b : b + tile][None, :]) <= radius
            if a == b:
                near = np.triu(near, 1)
            for i, j in zip(*np.nonzero(near), strict=True):
                x, y = top(a + i), top(b + j)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    left.append(a + i)
                    right.append(b + j)
    return prints[left], prints[right]


def links(prints: DataFrame, radius: int = RADIUS, file_rows: int = FILE_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct `print_` within the radius.

    `prints` holds each fingerprint once and is read from a written table.
    """
    masks = _masks(radius)
    filed = [
        F.struct(F.lit(i).alias("m"), F.col("print_").bitwiseAND(F.lit(_signed(mask))).alias("v"))
        for i, mask in enumerate(masks)
    ]
    files = prints.select("print_", F.explode(F.array(*filed)).alias("file")).select("print_", "file.m", "file.v")
    sizes = files.groupBy("m", "v").agg(F.count("*").alias("n")).where("n >= 2")
    sizes = settle(sizes.select("m", "v", F.ceil(F.col("n") / file_rows).cast("int").alias("parts")))
    mine = F.pmod(F.xxhash64("print_"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = (
        files.join(sizes, ["m", "v"])
        .select("m", "v", "print_", mine.alias("part"), other.alias("other"))
        .select("m", "v", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "print_")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None  # the fingerprints of the file at hand

        def found():
            a, b = linked(np.concatenate(held).view(np.uint64), radius) if held else ([], [])
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
                )

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)])
            values = batch.column(4).to_numpy()
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(values)], strict=True):
                if hi == lo:
                    continue
                if name is not None and tuple(keys[:, lo]) != name:
                    yield from found()
                    held = []
                name = tuple(keys[:, lo])
                held.append(values[lo:hi])
        yield from found()

    order = ["m", "v", "p", "q"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(compared, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Of every node of the edges (a, b) the smallest node it is connected to: (node, root).

    Alternating large-star and small-star steps; each step is written, so lineage stays short. Only minima are
    aggregated, the neighbours of a node are never gathered in one place, and as both sides of every join are read from
    tables, Spark can split the rows of a hot node.
    """
    ordered = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = settle(ordered.distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = settle(large.where("a != b").distinct())
        low = settle(large.groupBy("a").agg(F.min("b").alias("m")))
        moved = F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))
        small = large.join(low, "a").select(F.explode(moved).alias("e"))
        edges = settle(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a != b").distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end `a` has one edge and is no smaller end `b`: then the smaller ends are the roots."""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )
    nodes = edges.select(F.explode(ends).alias("e")).groupBy("e.node")
    nodes = nodes.agg(F.sum("e.up").alias("up"), F.sum("e.down").alias("down"))
    return nodes.where("up > 1 OR (up = 1 AND down > 0)").isEmpty()


def _joined(docs: DataFrame, text: str, key: str, words: int, radius: int) -> DataFrame:
    """Of every row `key`, `hash`, `print_`, the smallest key `first` of its component, and its links `n`."""
    rows = settle(fingerprints(docs, text, key, words))
    classes = settle(rows.groupBy("print_").agg(F.min("key").alias("first")))
    found = settle(links(classes.select("print_"), radius))
    roots = components(found)
    degree = found.select(F.explode(F.array("a", "b")).alias("print_")).groupBy("print_").agg(F.count("*").alias("n"))
    named = classes.join(roots, F.col("print_") == F.col("node"), "left").select(
        "print_", "first", F.coalesce("root", "print_").alias("root")
    )
    named = settle(named)
    smallest = settle(named.groupBy("root").agg(F.min("first").alias("first")))
    named = named.select("print_", "root").join(smallest, "root").join(settle(degree), "print_", "left")
    return rows.join(settle(named.select("print_", "first", "n")), "print_")


def near_copies(
    docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """Key, `fingerprint` (16 hex digits), `component_id` and `component_links` of every row.

    Rows belong together if a chain of fingerprints within the radius joins them. `component_id` is the smallest key of
    a component; null only if all its keys are null. `component_links` is the number of links from the row's fingerprint
    that were kept to connect its component. Null and empty texts have fingerprint zero and are linked like others.
    """
    return _joined(docs, text, key, words, radius).select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("print_"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"),
        F.coalesce("n", F.lit(0).cast("long")).alias("component_links"),
    )


def drop_near_copies(
    docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """The rows whose key is the smallest of their component, with the input's columns.

    Rows that agree in key and text all stay or all go. A component without any key stays whole.
    """
    chosen = _joined(docs, text, key, words, radius).where(F.col("key").eqNullSafe(F.col("first")))
    chosen = settle(chosen.select(F.col("key").alias("_key"), F.col("hash").alias("_hash")).distinct())
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row").getField(key).eqNullSafe(F.col("_key"))
    same_text = F.xxhash64(F.coalesce(F.col("row").getField(text), F.lit(""))) == F.col("_hash")
    return rows.join(chosen, same & same_text, "left_semi").select(*replacing("row", docs.columns))
