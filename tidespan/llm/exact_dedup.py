"""Exact duplicates, in DataFrame functions only.

Pass one counts, for every text, a few bit positions of its hash. Positions that were hit at least twice form a blocked
Bloom filter: a text whose positions are not all in it is certainly alone. Pass two tests every row against that filter;
rows that pass through are finished where they are, and only the possibly repeated ones are shuffled, as
(digest, length, doc_id), to find the row that stays.

The filter has `BITS_PER_ROW` bits for each row. What is broadcast is bounded: at most `MOST_BLOCKS` blocks of 4 KiB (64 MiB).
Rows that need more are first written once by ranges of their hash, without a shuffle, and each range goes through both
passes with a filter of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .base import replacing, scratch_dir, settle, whole

BLANKS = " \t\n\x0b\x0c\r"
BLOCK_BITS = 32_768
BITS_PER_ROW = 16
MOST_BLOCKS = 16_384  # a power of two
PROBES = 4


def normalised(text: str = "text") -> Column:
    """The text without blanks (space and U+0009 to U+000D); texts are equal when this is."""
    return F.translate(whole(text), BLANKS, "")


def _blocks(rows: int) -> int:
    """Filter blocks for so many rows, a power of two."""
    return 1 << max(0, -(-rows * BITS_PER_ROW // BLOCK_BITS) - 1).bit_length()


def _hashed(docs: DataFrame, text: str, blocks: int) -> DataFrame:
    """The rows with the filter block of their text and its positions in that block."""
    h = F.xxhash64(normalised(text))
    mixed = F.xxhash64(F.col("_hash"), F.lit(1))
    places = [F.shiftrightunsigned(mixed, 15 * i).bitwiseAND(BLOCK_BITS - 1).cast("int") for i in range(PROBES)]
    return (
        docs.select(F.struct("*").alias("row"))
        .withColumn("text", F.col("row").getField(text))
        .withColumn("_hash", h)
        .select("row", F.col("_hash").bitwiseAND(blocks - 1).cast("int").alias("block"), F.array(*places).alias("places"))
    )


def repeated_filter(docs: DataFrame, blocks: int, text: str = "text") -> DataFrame:
    """The Bloom filter as rows (block, words): bit positions that at least two rows hit, 64 to a word."""
    bits = (
        _hashed(docs, text, blocks)
        .select("block", F.explode(F.array_distinct("places")).alias("place"))
        .groupBy("block", "place")
        .agg(F.count("*").alias("n"))
        .where("n >= 2")
        .select("block", "place")
        .repartition("block")
        .groupBy("block")
        .agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))
    )
    word = lambda i: F.conv(F.hex(F.substr("bits", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    return bits.select("block", F.transform(F.sequence(F.lit(0), F.lit(max(1, BLOCK_BITS // 64) - 1)), word).alias("words"))


def _set(place: Column) -> Column:
    """Whether the bit of a position is set. Bytes of a word are read as one number, the first byte highest."""
    word = F.get("words", F.shiftright(place, 6))
    bit = (7 - F.shiftright(place, 3).bitwiseAND(7)) * 8 + place.bitwiseAND(7)
    return F.getbit(word, bit) == 1


def _ranges(docs: DataFrame, text: str) -> list[tuple[DataFrame, int]]:
    """The rows by ranges of the hash of their text, each with the filter blocks it needs: one unless they are too many."""
    blocks = _blocks(docs.count())
    if blocks <= MOST_BLOCKS:
        return [(docs, blocks)]
    path, count = scratch_dir(docs.sparkSession, "ranges"), blocks // MOST_BLOCKS
    number = F.shiftrightunsigned(F.xxhash64(normalised(text), F.lit(2)), 8).bitwiseAND(count - 1).cast("int")
    docs.select(F.struct("*").alias("row"), number.alias("range")).write.partitionBy("range").parquet(path)
    kinds = T.StructType([T.StructField("row", docs.schema), T.StructField("range", T.IntegerType())])
    rows = docs.sparkSession.read.schema(kinds).parquet(path)
    return [(rows.where(F.col("range") == i).select("row.*"), MOST_BLOCKS) for i in range(count)]


def _parts(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that are certainly alone, and the others with the best row and the size of their group."""
    parts = [_two_passes(rows, blocks, text, key) for rows, blocks in _ranges(docs, text)]
    return tuple(reduce(DataFrame.unionByName, side) for side in zip(*parts, strict=True))


def _two_passes(docs: DataFrame, blocks: int, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    filled = F.broadcast(settle(repeated_filter(docs, blocks, text).withColumnRenamed("block", "filled")))
    tested = _hashed(docs, text, blocks).join(filled, F.col("block") == F.col("filled"), "left")
    suspect = F.col("words").isNotNull()
    for i in range(PROBES):
        suspect = suspect & F.coalesce(_set(F.col("places")[i]), F.lit(False))
    tested = tested.select("row", suspect.alias("suspect"))
    digest = F.sha2(F.translate(F.coalesce(F.col("row").getField(text), F.lit("")), BLANKS, ""), 256)
    alone = tested.where(~F.col("suspect")).select("row", digest.alias("digest"))
    rest = tested.where("suspect").select(
        "row",
        digest.alias("digest"),
        F.struct(
            (-F.length(F.coalesce(F.col("row").getField(text), F.lit("")))).alias("less"),
            F.col("row").getField(key).isNull().alias("unnamed"),
            F.col("row").getField(key).alias("id"),
        ).alias("rank"),
    )
    best = rest.groupBy("digest").agg(F.min("rank").alias("best"), F.count("*").alias("size"))
    best = settle(best).withColumnRenamed("digest", "group")  # read from a table, so a hot group can be split in the join
    # null-safe, although digests are never null: else the digests of all rows are computed to test them for null
    return alone, rest.join(best, F.col("digest").eqNullSafe(F.col("group")))


def mark_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row with `keep_id`, `group_size`, `kept` and `text_sha256`.

    Of equal texts the row with the most code points stays, then the one with the smallest key; a null key comes last.
    Rows that repeat the kept row whole, key included, are marked kept like it. Null texts are empty texts.
    """
    alone, rest = _parts(docs, text, key)
    names = docs.columns
    id_ = F.col("row").getField(key)
    passed = alone.select(
        *replacing(
            "row",
            names,
            keep_id=id_,
            group_size=F.lit(1).cast("long"),
            kept=F.lit(True),
            text_sha256=F.col("digest"),
        )
    )
    grouped = rest.select(
        *replacing(
            "row",
            names,
            keep_id=F.col("best.id"),
            group_size=F.col("size"),
            kept=F.col("rank") == F.col("best"),
            text_sha256=F.col("digest"),
        )
    )
    return passed.unionByName(grouped)


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of equal texts, chosen as in `mark_copies`, with the input's columns.

    Of rows that are equal in key and text one stays.
    """
    alone, rest = _parts(docs, text, key)
    winners = rest.where("rank = best").select("row", "digest").dropDuplicates(["digest"])
    return alone.unionByName(winners).select(*replacing("row", docs.columns))
