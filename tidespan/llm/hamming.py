"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

Codes have up to 64 bits. Rows with equal codes are one class, of which only the ids that can be among the first k
matter, so any number of copies is one entry. Every class is filed once by each of a few segments of its code, in files of
a bounded number of classes that agree on the upper bits of the segment.

Queries go in rounds. In round r each open query probes all segments at radius r: it is sent to the files whose upper
bits differ in at most r places, and there looks up its own lower bits with the remaining flips. What it meets is
verified by exclusive-or and bit counts, and reported once, by the first segment that agrees best. After the round
every code within m * (r + 1) - 1 bits has been met, m being the number of segments: a query whose kth distance this
covers is closed, and only the others go on. Work and shuffle follow the open queries and what they meet, not pairs of blocks.

A file that many classes share is split into parts, and the queries of a file into blocks, which meet pairwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import settle

BITS = 64
#: Classes in a file, and queries that meet it at a time.
FILE_CLASSES, QUERY_BLOCK = 8192, 8192
#: Probes that are looked up at a time.
PROBES = 1 << 18
#: Bits of a segment.
WIDTHS = 4, 22


def sign_code(vector: str = "embedding", bits: int = BITS) -> Column:
    """Bit i is set if element i is positive; null for vectors without exactly `bits` elements, null elements are 0."""
    v = F.col(vector)
    places = F.sequence(F.lit(0), F.lit(bits - 1))
    ones = F.transform(places, lambda i: F.when(F.get(v, i) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    code = F.aggregate(ones, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(F.coalesce(x, F.lit(0).cast("long"))))
    return F.when(F.size(v) == bits, code)


class Segments:
    """The segments of a code, each with upper bits that name a file and lower bits that are looked up in it."""

    def __init__(self, classes: int, file_classes: int, bits: int = BITS):
        width = int(np.clip(np.log2(max(2, classes)), *WIDTHS))
        edges = np.linspace(0, bits, -(-bits // width) + 1).astype(int).tolist()
        self.places = list(zip(edges[:-1], (hi - lo for lo, hi in zip(edges, edges[1:], strict=False)), strict=True))
        self.upper = [min(w - 1, max(0, int(np.ceil(np.log2(max(1, classes / file_classes)))))) for _, w in self.places]

    def __len__(self) -> int:
        return len(self.places)

    def filed(self, i: int) -> Column:
        """The file of column `code` in segment i."""
        (lo, width), upper = self.places[i], self.upper[i]
        return F.shiftrightunsigned("code", lo + width - upper).bitwiseAND(F.lit((1 << upper) - 1)) if upper else F.lit(0).cast("long")

    def values(self, codes: np.ndarray, i: int) -> np.ndarray:
        lo, width = self.places[i]
        return ((codes >> np.uint64(lo)) & np.uint64((1 << width) - 1)).astype(np.int64)


@cache
def _flips(width: int, radius: int) -> np.ndarray:
    """All masks of `radius` of `width` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], dtype=np.int64)


def _probes(open_: DataFrame, segments: Segments, radius: int) -> DataFrame:
    """(segment, file, code, bound): where each open query looks at this radius."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, bounds = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, ((_, width), upper) in enumerate(zip(segments.places, segments.upper, strict=True)):
                lower = width - upper
                masks = [_flips(upper, d) for d in range(max(0, radius - lower), min(radius, upper) + 1)]
                masks = np.concatenate(masks) if masks else np.zeros(0, np.int64)
                each = max(1, PROBES // max(1, len(masks)))
                for at in range(0, len(codes), each):
                    some = codes[at : at + each]
                    files = (segments.values(some.view(np.uint64), i) >> lower)[:, None] ^ masks
                    many = len(masks)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(files.size, i, np.int32)),
                            pa.array(files.ravel()),
                            pa.array(np.repeat(some, many)),
                            pa.array(np.repeat(bounds[at : at + each], many)),
                        ],
                        names=["segment", "file", "code", "bound"],
                    )

    return open_.mapInArrow(dealt, "segment int, file bigint, code bigint, bound int")


def _met(have: np.ndarray, counts: np.ndarray, asked: np.ndarray, bounds: np.ndarray, i: int, radius: int, segments: Segments, need: int):
    """(query, code, distance, rows) of what the queries meet in one file at exactly this radius of segment i."""
    (_, width), upper = segments.places[i], segments.upper[i]
    lower = width - upper
    low = (1 << lower) - 1
    values = segments.values(have, i)
    order = np.argsort(values & low, kind="stable")
    have, counts, sorted_low = have[order], counts[order], (values & low)[order]
    file = int(values[0]) >> lower if len(values) else 0
    mine = segments.values(asked, i)
    left = radius - np.bitwise_count((mine >> lower) ^ file).astype(np.int64)  # flips that remain for the lower bits
    for flips in np.unique(left):
        if not 0 <= flips <= lower:
            continue
        masks, group = _flips(lower, int(flips)), np.flatnonzero(left == flips)
        step = max(1, PROBES // len(masks))
        for at in range(0, len(group), step):
            who = group[at : at + step]
            wanted = ((mine[who] & low)[:, None] ^ masks).ravel()
            first = np.searchsorted(sorted_low, wanted)
            size = np.searchsorted(sorted_low, wanted, side="right") - first
            hit = np.flatnonzero(size)
            first, size = first[hit], size[hit]
            place = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            query = np.repeat(who[hit // len(masks)], size)
            apart = asked[query] ^ have[place]
            distance = np.bitwise_count(apart).astype(np.int64)
            near = distance <= bounds[query]
            for j, (lo, w) in enumerate(segments.places):  # another segment that agrees better, or as well and earlier, has it
                other = np.bitwise_count((apart >> np.uint64(lo)) & np.uint64((1 << w) - 1))
                near &= other >= radius + (j < i)
            query, place, distance = query[near], place[near], distance[near]
            # of each query only the nearest, with all at the last distance
            by = np.lexsort((distance, query))
            query, place, distance = query[by], place[by], distance[by]
            total = np.cumsum(counts[place])
            begins = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, np.int64)
            lengths = np.diff(np.append(begins, len(query)))
            before = np.repeat(total[begins] - counts[place][begins], lengths) if len(query) else total
            enough = total - counts[place] - before >= need  # that many rows are nearer or as near
            last = np.full(len(asked), BITS + 1)
            np.minimum.at(last, query[enough], distance[enough])
            keep = distance <= last[query]
            yield asked[query[keep]], have[place[keep]], distance[keep], counts[place[keep]]


def _split(rows: DataFrame, size: int) -> DataFrame:
    """(segment, file, parts) of the files with more than `size` rows."""
    sizes = rows.groupBy("segment", "file").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    return settle(sizes.where("parts > 1"))


def _round(files: DataFrame, large: DataFrame, probes: DataFrame, segments: Segments, radius: int, need: int, query_block: int) -> DataFrame:
    """(query, code, distance, n): what the probes meet."""
    place = ["segment", "file"]
    busy = _split(probes, query_block).withColumnRenamed("parts", "blocks")
    parts, blocks = F.coalesce("parts", F.lit(1)), F.coalesce("blocks", F.lit(1))
    deal = lambda n: F.pmod(F.xxhash64("code"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = files.join(large, place, "left").join(busy, place, "left")
    left = left.select(*place, deal(parts).alias("part"), every(blocks).alias("block"), "code", "n")
    right = probes.join(large, place, "left").join(busy, place, "left")
    right = right.select(*place, every(parts).alias("part"), deal(blocks).alias("block"), "code", "bound")

    def look(key: tuple, have: pa.Table, asked: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if have.num_rows and asked.num_rows:
            codes, counts = have["code"].to_numpy().view(np.uint64), have["n"].to_numpy().astype(np.int64)
            queries, bounds = asked["code"].to_numpy().view(np.uint64), asked["bound"].to_numpy()
            found += _met(codes, counts, queries, bounds, key[0].as_py(), radius, segments, need)
        query, code, distance, n = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"query": query.view(np.int64), "code": code.view(np.int64), "distance": distance, "n": n})

    group = [*place, "part", "block"]
    met = left.groupBy(*group).cogroup(right.groupBy(*group))
    return met.applyInArrow(look, "query bigint, code bigint, distance bigint, n bigint")


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "vec_id",
    code: str = "code",
    file_classes: int = FILE_CLASSES,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k rows nearest to each query: `query_id`, `rank` (from 1), `neighbour_id`, `distance`.

    Both inputs have a key and a 64-bit `code`; other columns are not carried along, whatever their names. A query is not
    its own neighbour. Equal distances go by smaller id. Rows without key or code are left out; repeated rows count once.
    Fewer than k rows give fewer neighbours; empty tables give an empty result.
    """
    wanted = k + 1  # the query itself is among them
    known = rows.select(F.col(key).alias("id"), F.col(code).alias("code")).dropna().distinct()
    order = Window.partitionBy("code").orderBy("id")
    first = known.withColumn("n", F.row_number().over(order)).where(F.col("n") <= wanted)
    classes = settle(first.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asked = settle(queries.select(F.col(key).alias("query_id"), F.col(code).alias("code")).dropna().distinct())
    size, total = classes.agg(F.count("*"), F.sum(F.size("ids"))).first()
    need = min(wanted, total or 0)
    segments = Segments(size, file_classes)
    filed = [F.struct(F.lit(i).alias("segment"), segments.filed(i).alias("file")) for i in range(len(segments))]
    files = classes.select(F.explode(F.array(*filed)).alias("f"), "code", F.size("ids").cast("long").alias("n"))
    files = settle(files.select("f.segment", "f.file", "code", "n"))
    large = _split(files, file_classes)

    open_ = settle(asked.select("code", F.lit(BITS).alias("bound")).distinct())
    found, radius = [], 0
    while need and not open_.isEmpty():
        probes = settle(_probes(open_, segments, radius))
        met = _round(files, large, probes, segments, radius, need, query_block)
        found.append(settle(met))
        # how far the nearest rows of the open queries reach, as far as is known
        near = reduce(DataFrame.unionByName, found).join(open_.select(F.col("code").alias("query")), "query", "left_semi")
        near = near.groupBy("query", "distance").agg(F.sum("n").alias("n"))
        upto = Window.partitionBy("query").orderBy("distance").rowsBetween(Window.unboundedPreceding, 0)
        reach = near.withColumn("held", F.sum("n").over(upto)).where(F.col("held") >= need)
        reach = reach.groupBy("query").agg(F.min("distance").cast("int").alias("reach"))
        joined = open_.join(reach, F.col("code") == F.col("query"), "left")
        covered = len(segments) * (radius + 1) - 1
        left = joined.select("code", F.coalesce("reach", "bound").alias("bound"))
        open_ = settle(left.where(F.col("bound") > covered))
        radius += 1
        if radius > max(w for _, w in segments.places):
            break
    if not found:
        return asked.select("query_id", F.lit(0).alias("rank"), F.col("query_id").alias("neighbour_id"), F.lit(0).cast("long").alias("distance")).limit(0)
    met = reduce(DataFrame.unionByName, found)
    near = met.join(classes, "code").select("query", F.explode("ids").alias("id"), "distance")
    best = Window.partitionBy("query").orderBy("distance", "id")
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= wanted)
    nearby = F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("found")
    answers = settle(near.groupBy("query").agg(nearby))
    own = F.struct(F.lit(0).cast("long").alias("distance"), F.col("query_id").alias("id"))
    others = F.slice(F.array_remove("found", own), 1, k)
    joined = asked.join(answers, F.col("code") == F.col("query")).select("query_id", F.posexplode(others).alias("at", "x"))
    return joined.select(
        "query_id",
        (F.col("at") + 1).alias("rank"),
        F.col("x.id").alias("neighbour_id"),
        F.col("x.distance").alias("distance"),
    )
