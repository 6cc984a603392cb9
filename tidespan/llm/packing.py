"""Vector best-fit packing of tokenised documents into training sequences.

Documents are tokenised where they lie. The pieces, without their tokens, are dealt evenly into blocks of about
`BLOCK_PIECES`, and each block is packed by one task: pieces by falling demand, each into the open sequence
that it leaves with the smallest weighted residual. A sequence has three capacities, tokens, pieces and attention cost
(the sum of squared lengths), and a piece goes only where it fits in all three. Blocks bound a task's work and memory at
any input size; they cost at most a few unfilled sequences in each block.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .base import process_state, settle

BLOCK_PIECES = 16_384
#: Vocabularies that are also there as ranks.
RANKS = {"byte_bpe_50k.json": "byte_bpe_50k.tiktoken"}
#: Bytes of ids in an output batch.
BATCH_BYTES = 8 << 20
END_ID = 0
#: Names a written piece while its ids are away; keys of documents may repeat.
ROW = "_piece_row"


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold, and how much each residual counts when sequences are compared."""

    tokens: int = 2048
    pieces: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = field(default=(1.0, 0.0, 0.0))

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.pieces or self.tokens, self.attention or self.tokens**2], dtype=np.float64)


def tokenizer_path(file: str) -> str:
    """A tokenizer file by path, or by its name among the installed public vocabularies."""
    if "/" in file:
        return file
    import public_tokenizers

    return public_tokenizers.path(file)


def open_tokenizer(file: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(file))


class Ids:
    """Ids of texts, as little-endian unsigned 32-bit integers.

    The byte-level vocabulary also comes as ranks, with which tiktoken finds the same ids in a third of the time. It is
    used for texts of Latin letters and common punctuation, where both libraries' character classes agree for certain,
    unless they hold the string of a special token: `tokenizers` gives that its own id.
    """

    def __init__(self, file: str):
        import re

        self.file, self.tokenizer, self.ranked = file, None, None
        self.special: list[str] = []
        self.common = re.compile("[\x00-\u024f\u2010-\u2027]*").fullmatch
        if file in RANKS:
            import public_tokenizers
            import tiktoken

            with open(tokenizer_path(file), encoding="utf-8") as whole:
                self.special = [t["content"] for t in json.load(whole)["added_tokens"]]
            with open(public_tokenizers.path(RANKS[file]), "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding(
                file, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def of(self, text: str) -> bytes:
        if self.ranked is not None and self.common(text) and not any(t in text for t in self.special):
            return np.array(self.ranked.encode_ordinary(text), dtype="<u4").tobytes()
        if self.tokenizer is None:  # only where a text needs it: it takes memory
            self.tokenizer = open_tokenizer(self.file)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def tokenise(docs: DataFrame, tokenizer_file: str, tokens: int = 2048, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of at most `tokens` ids: key, `piece`, `start`, `length`, `ids` (little-endian unsigned 32-bit, binary).

    A document is its ids and one id 0; a null text is empty and gives that id alone. Only a longer document is cut,
    into full pieces after a first one that may be shorter. Rows that repeat are tokenised one by one. The string of a
    special token in a text becomes that token's id. The key has a name of its own.
    """
    if key in ("piece", "start", "length", "ids"):
        raise ValueError(f"the key column cannot be named {key!r}")
    end = np.array([END_ID], dtype="<u4").tobytes()
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = process_state("ids_" + tokenizer_file, lambda: Ids(tokenizer_file))

        def batch(rows):
            columns = list(zip(*rows, strict=True))
            kinds = [keys, pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=schema.fieldNames()
            )

        rows, size = [], 0
        for b in batches:
            keys = b.schema.field(0).type
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                data = ids.of(t.as_py() or "") + end
                total = len(data) // 4
                first = total % tokens or tokens
                at = 0
                for piece, stop in enumerate(range(min(first, total), total + 1, tokens)):
                    rows.append((k, piece, at, stop - at, data[4 * at : 4 * stop]))
                    size += 4 * (stop - at) + 64
                    at = stop
                    if size > BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Of each piece its sequence and its offset there."""
    limits, weights = capacity.limits(), np.array(capacity.weights)
    demands = np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1) / limits
    order = np.argsort(-lengths, kind="stable")
    smallest = demands.min(axis=0) if len(lengths) else limits
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.empty((len(lengths), 3))  # residuals of the open sequences, in shares of the capacities
    names = np.empty(len(lengths), np.int64)
    used = np.zeros(len(lengths), np.int64)
    opened = live = 0
    for i in order:
        need = demands[i]
        rest = left[:live] - need
        score = rest * rest @ weights
        score[(rest < -1e-12).any(axis=1)] = np.inf
        best = int(np.argmin(score)) if live else -1
        if best < 0 or score[best] == np.inf:
            best, names[live], left[live] = live, opened, 1.0
            live += 1
            opened += 1
        where[i], offset[i] = names[best], used[names[best]]
        used[names[best]] += lengths[i]
        left[best] -= need
        if (left[best] < smallest - 1e-12).any():  # nothing fits any more
            live -= 1
            left[best], names[best] = left[live], names[live]
    return where, offset


def pack(
    pieces: DataFrame, capacity: Capacity = Capacity(), block_pieces: int = BLOCK_PIECES, row: str | None = None
) -> DataFrame:
    """The pieces with `sequence_id` and `offset`: each sequence is gapless and keeps to every capacity.

    `pieces` has a column `length` between 1 and the token capacity and is read from a written table; its other columns
    are carried along. With `row`, a column whose values are written and all different, only it and the lengths go to
    the tasks that pack, and the other columns, which may be large, are joined to the result. A piece longer than the
    capacity is an error.
    """
    if row is not None:
        rest = pieces.drop("sequence_id", "offset")
        placed = pack(pieces.select(row, "length"), capacity, block_pieces)
        return rest.join(placed.drop("length"), row).select(*rest.columns, "sequence_id", "offset")
    blocks = max(1, -(-pieces.count() // block_pieces))
    schema = T.StructType(
        [f for f in pieces.schema.fields if f.name.lower() not in ("sequence_id", "offset")]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    names = [n for n in schema.fieldNames()[:-2]]

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        lengths = rows.column("length").to_numpy().astype(np.int64)
        if len(lengths) and (lengths.max() > capacity.tokens or lengths.min() < 1):
            raise ValueError("a piece is empty or longer than a sequence")
        where, offset = best_fit(lengths, capacity)
        columns = [rows.column(n) for n in names]
        block = key[0].as_py()
        return pa.Table.from_arrays(
            [*columns, pa.array((block << 32) + where), pa.array(offset)], names=schema.fieldNames()
        )

    dealt = pieces.select(*names).withColumn("_block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    # a number of partitions that is given is kept: rows are small for the time they take, and would go to few tasks
    tasks = min(blocks, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.repartition(tasks, "_block").groupBy("_block").applyInArrow(packed, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: Capacity = Capacity(),
    text: str = "text",
    key: str = "doc_id",
    with_ids: bool = True,
) -> DataFrame:
    """Documents as packed pieces: the columns of `tokenise`, `ids_crc32`, `sequence_id` and `offset`.

    Without `with_ids` the ids themselves stay behind; then only a few numbers of each piece are shuffled.
    """
    pieces = tokenise(docs, tokenizer_file, capacity.tokens, text, key)
    pieces = pieces.select(key, "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), *["ids"] * with_ids)
    if not with_ids:
        return pack(settle(pieces), capacity)
    return pack(settle(pieces.withColumn(ROW, F.monotonically_increasing_id())), capacity, row=ROW).drop(ROW)
