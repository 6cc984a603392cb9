"""Importance resampling towards a target distribution, with scores ranked by a distributed radix sort.

Texts are runs of words hashed into buckets. How much more often a bucket occurs in the target than in the documents is
its gain; a document's weight is the sum of the gains of its features, looked up in one array of `BUCKETS` numbers. With
Gumbel noise from a hash of the key added, the highest scores are a sample without replacement.

Ranks come from a least-significant-digit radix sort of the composite key (score descending, document key). Rows lie in
blocks of equally many places. One pass counts the digits of every block, sums these counts to the place where each
(digit, block) begins, and moves every row there by a stable counting sort of its block; places are dense, so a digit or
score that many rows share changes no task's size. After the last pass a row's place is its rank. Each pass is written, so
a lost executor repeats part of one pass.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .base import replacing, settle

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
DIGIT_BITS = 11
#: Places in a block: as few as spread the rows over all tasks, and never more than fit one task.
BLOCK_ROWS = 4_096, 1 << 20
#: Words whose bucket a task remembers.
REMEMBERED = 1 << 18

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # in UTF-8: every character that is neither ASCII nor ASCII letter or digit counts


class Buckets:
    """Buckets of the features of texts: runs of 1 to `longest` words."""

    def __init__(self, longest: int, buckets: int) -> None:
        self.longest, self.buckets, self.known = longest, buckets, {}

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every feature, repeats included. Only A to Z are lowered."""
        words = WORD.findall(text.encode("utf-8", "surrogatepass").lower())  # bytes: lowers ASCII only
        found = []
        for size in range(1, self.longest + 1):
            runs = words if size == 1 else [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
            found += map(self.bucket, runs)
        return len(words), np.array(found, np.int64)

    def bucket(self, feature: bytes) -> int:
        at = self.known.get(feature)
        if at is None:
            at = zlib.crc32(feature) % self.buckets
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[feature] = at
        return at


def bucket_counts(texts: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends at most one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, sums = Buckets(longest, buckets), np.zeros(buckets, np.int64)
        for b in batches:
            for t in b.column(0):
                sums += np.bincount(hashed.of(t.as_py())[1], minlength=buckets)
        met = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(sums[met])], names=["bucket", "n"])

    found = texts.select(F.coalesce(text, F.lit(""))).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of every bucket floor(1000 ln((t+1)(S+b) / ((s+1)(T+b)))) in doubles; b is the number of buckets."""
    size, of_docs, of_target = float(len(docs)), float(docs.sum()), float(target.sum())
    ratios = [(t + 1.0) * (of_docs + size) / ((s + 1.0) * (of_target + size)) for s, t in zip(docs, target, strict=True)]
    return np.array([floor(1000 * log(r)) for r in ratios], np.int64)


def noise(key, seed: int) -> int:
    """floor(-1000 ln(-ln u)) for u from the first 32 bits of the SHA-256 of `seed:key`; a null key is written as nothing."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, text: str, key: str, longest: int, seed: int, kept: list[str]) -> DataFrame:
    """Of every row `_row` (the columns `kept`), the key, its words, features, weight and score."""
    carried = T.StructType([docs.schema[c] for c in kept])
    fields = [T.StructField("_row", carried, False)] if kept else []
    numbers = ["key", "words", "n_features", "weight", "score"]
    schema = T.StructType([*fields, *(T.StructField(n, T.LongType()) for n in numbers)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Buckets(longest, len(gain))
        for b in batches:
            keys = b.column(b.num_columns - 2)
            out = []
            for k, t in zip(keys.to_pylist(), b.column(b.num_columns - 1), strict=True):
                words, found = hashed.of(t.as_py())
                weight = int(gain[found].sum()) if len(found) else 0
                out.append((words, len(found), weight, weight + noise(k, seed)))
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] or [pa.array([], pa.int64())] * 4
            row = [b.column(0)] if kept else []
            yield pa.RecordBatch.from_arrays([*row, keys, *columns], names=["_row"] * len(row) + numbers)

    row = [F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")] if kept else []
    return docs.select(*row, F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text")).mapInArrow(run, schema)


def _digit(at: int, low_bits: int, bits: int) -> Column:
    """The digit of `bits` bits from bit `at` on, of the number whose low bits are `low` and whose other bits are `high`."""
    parts = []
    if at < low_bits:
        part = min(bits, low_bits - at)
        parts.append(F.shiftright("low", at).bitwiseAND(F.lit((1 << part) - 1)))
    if at + bits > low_bits:
        shift = max(0, low_bits - at)
        high = F.shiftright("high", max(0, at - low_bits)).bitwiseAND(F.lit((1 << (bits - shift)) - 1))
        parts.append(F.shiftleft(high, shift))
    return sum(parts[1:], parts[0]).cast("int")


def starts(rows: DataFrame) -> DataFrame:
    """Where the rows of each (block, digit) begin: those of smaller digits, and of earlier blocks, come before them."""
    counts = settle(rows.groupBy("block", "digit").agg(F.count("*").alias("n")))
    before = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # over at most 2 ** DIGIT_BITS rows
    digits = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    digits = digits.select("digit", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("base") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return counts.join(F.broadcast(digits), "digit").select("block", "digit", first.cast("long").alias("first"))


def _counting_sort(rows: pa.Table, first: pa.Table) -> pa.Table:
    """Places of one block's rows: its digits' beginnings, and on from there in the order of the places so far."""
    order = np.argsort(rows["place"].to_numpy(), kind="stable")
    digits = rows["digit"].to_numpy()[order]
    by_digit = np.argsort(digits, kind="stable")
    order, digits = order[by_digit], digits[by_digit]
    begin = np.zeros(1 << DIGIT_BITS, np.int64)
    begin[first["digit"].to_numpy()] = first["first"].to_numpy()
    runs = np.flatnonzero(np.concatenate(([True], digits[1:] != digits[:-1])))
    nth = np.arange(len(digits)) - np.repeat(runs, np.diff(np.append(runs, len(digits))))
    out = rows.select(["seq", "low", "high"]).take(pa.array(order))
    return out.append_column("place", pa.array(begin[digits] + nth))


def ranked(rows: DataFrame, count: int, low_bits: int, high_bits: int) -> DataFrame:
    """(seq, place): the place from 0 of every one of `count` rows in the order of (high, low), both from 0 on.

    `rows` has seq, low and high and is read from a written table.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = max(BLOCK_ROWS[0], min(BLOCK_ROWS[1], -(-count // (4 * tasks))))
    blocks = max(1, -(-count // size))
    # any first order will do, and blocks by hash have about equally many rows
    rows, block = rows.withColumn("place", F.col("seq")), F.pmod(F.xxhash64("seq"), F.lit(blocks))
    for at in range(0, max(1, low_bits + high_bits), DIGIT_BITS):
        dealt = rows.select("*", block.alias("block"), _digit(at, low_bits, DIGIT_BITS).alias("digit"))
        left, right = dealt.groupBy("block"), starts(dealt).groupBy("block")
        rows = settle(left.cogroup(right).applyInArrow(_counting_sort, "seq long, low long, high long, place long"))
        block = F.floor(F.col("place") / size)
    return rows.select("seq", "place")


def mark(
    docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text",
    longest: int = 1, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT,
    with_text: bool = False,
) -> DataFrame:
    """All columns of the documents, the text only if asked for, with `n_features`, `weight`, `score` and `rank`.

    Features are counted over all documents and all target texts; null and empty texts have none, and weight 0. Of the N
    documents of at least `least_words` words, floor(percent * N / 100) are drawn: those of the highest scores, ties to
    the smaller key, null keys last. They are ranked from 1 on; the others have no rank. The key is a whole number. Rows
    with the same key and score, such as repeated rows, are ranked in any order. An empty table gives an empty result; an
    empty target counts nothing. Columns of the input with the names of the new ones are replaced.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    new = ("n_features", "weight", "score", "rank")
    kept = [c for c in docs.columns if c.lower() not in new and (with_text or c != text)]
    rows = scored(docs, gain, text, key, longest, seed, kept)
    rows = settle(rows.withColumn("seq", F.monotonically_increasing_id()))
    able = rows.where(F.col("words") >= least_words)
    ends = [f(c).alias(f.__name__ + c) for f in (F.min, F.max) for c in ("key", "score")]
    stats = able.agg(F.count("*").alias("n"), *ends).first()
    drawn = stats.n * percent // 100
    row = replacing("_row", kept) if kept else []
    if not drawn:
        return rows.select(*row, "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    no_key = 0 if stats.maxkey is None else stats.maxkey - stats.minkey + 1  # null keys come after all others
    low = F.coalesce(F.col("key") - F.lit(stats.minkey), F.lit(no_key)).cast("long")
    high = F.lit(stats.maxscore) - F.col("score")
    places = ranked(
        able.select("seq", low.alias("low"), high.alias("high")),
        stats.n, no_key.bit_length(), (stats.maxscore - stats.minscore).bit_length(),
    )
    ranks = places.where(F.col("place") < drawn).select("seq", (F.col("place") + 1).alias("rank"))
    return rows.join(ranks, "seq", "left").select(*row, "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns, `n_features`, `weight`, `score` and `rank`; options as for `mark`."""
    return mark(docs, target, with_text=True, **options).where(F.col("rank").isNotNull())
