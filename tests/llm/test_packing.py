"""Packing: ids against the tokenizer, sequences against their capacities."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidespan.llm import packing

FILE = "byte_bpe_50k.json"


def contract_ids(text):
    """Ids by the library itself, as the contract names it."""
    import public_tokenizers
    from tokenizers import Tokenizer

    if not hasattr(contract_ids, "tokenizer"):
        contract_ids.tokenizer = Tokenizer.from_file(public_tokenizers.path(FILE))
    return contract_ids.tokenizer.encode(text, add_special_tokens=False).ids


TEXTS = [
    None,
    "",
    " ",
    "one two  three\n\n four's ",
    "<|endoftext|> is text",
    "éà ß Ǆ “quoted” – 12 345",
    "日本語 текст 🙂   \x1c",
    "word " * 3000,
    "long" * 4000,
    "\n" * 100,
]


def test_ids_are_the_tokenizers(monkeypatch):
    ids = packing.Ids(FILE)
    assert np.frombuffer(ids.of("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    rng = random.Random(5)
    texts = [t or "" for t in TEXTS]
    pool = " \n\t'sStT.,0é" + "".join(map(chr, range(0x20, 0x24F))) + "日Ω  "
    texts += ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(ids.of(t), "<u4").tolist() == contract_ids(t), ascii(t)


def test_pieces_and_sequences(spark):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 0), (None, TEXTS[3], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = packing.pack_documents(docs, FILE, packing.Capacity(tokens=512)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length and r.length <= 512
        pieces[r.doc_id].append((r.start, r.piece, bytes(r.ids)))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, t, _ in rows:
        want = np.array(contract_ids(t or "") + [0], "<u4").tobytes()
        copies = sum(1 for j, *_ in rows if j == i)
        assert b"".join(p for *_, p in sorted(set(pieces[i]))) == want
        assert sum(len(p) for *_, p in pieces[i]) == copies * len(want)
        numbers = sorted({(s, n) for s, n, _ in pieces[i]})
        assert [n for _, n in numbers] == list(range(len(numbers)))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
        assert sum(n for _, n in parts) <= 512


@pytest.mark.parametrize("weights", [(1.0, 0.0, 0.0), (1.0, 0.5, 0.5)])
def test_every_capacity_holds(weights):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 400, 2000)
    capacity = packing.Capacity(tokens=512, pieces=5, attention=120_000, weights=weights)
    lengths = lengths[lengths**2 <= 120_000]
    where, offset = packing.best_fit(lengths, capacity)
    for s in np.unique(where):
        own = lengths[where == s]
        assert own.sum() <= 512 and len(own) <= 5 and (own**2).sum() <= 120_000
        assert sorted(offset[where == s]) == sorted(np.cumsum(np.concatenate([[0], own[np.argsort(offset[where == s])][:-1]])))


def test_few_sequences():
    rng = np.random.default_rng(2)
    lengths = np.minimum(rng.lognormal(5.5, 1.0, 5000).astype(int) + 1, 2048)
    where, _ = packing.best_fit(lengths, packing.Capacity())
    assert len(np.unique(where)) <= -(-lengths.sum() // 2048) * 1.01 + 1


def test_blocks_and_no_rows(spark):
    pieces = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 7 + 1).alias("length"))
    out = packing.pack(pieces, packing.Capacity(tokens=8), block_pieces=10)
    load = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert out.count() == 100 and max(r.n for r in load) <= 8
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(empty, FILE).count() == 0


def test_ids_stay_out_of_the_blocks(spark):
    rows = [(i % 3 if i % 4 else None, f"a text of some words {i % 5}") for i in range(40)]
    out = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), FILE, packing.Capacity(tokens=32))
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    packed = [line for line in plan if "FlatMapGroupsInArrow" in line]
    assert len(packed) == 1 and "ids" not in packed[0]  # a block's ids would be held by one task
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    want = sorted((str(k), np.array(contract_ids(t) + [0], "<u4").tobytes()) for k, t in rows)
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in out.collect()) == want


def test_other_columns_by_row(spark, tmp_path):
    pieces = spark.range(100).select("id", (F.col("id") % 7 + 1).alias("length"), F.lit(None).cast("string").alias("x"))
    pieces.withColumn("offset", F.lit(-1)).write.parquet(str(tmp_path / "pieces"))
    out = packing.pack(spark.read.parquet(str(tmp_path / "pieces")), packing.Capacity(tokens=8), block_pieces=10, row="id")
    rows = out.collect()
    assert out.columns == ["id", "length", "x", "sequence_id", "offset"]
    assert sorted((r.id, r.length, r.x) for r in rows) == [(i, i % 7 + 1, None) for i in range(100)]
    places = {(r.sequence_id, r.offset + k) for r in rows for k in range(r.length)}
    assert len(places) == sum(r.length for r in rows) and all(0 <= at < 8 for _, at in places)


def test_blocks_are_spread_over_tasks(spark):
    pieces = spark.range(400).select("id", (F.col("id") % 7 + 1).alias("length"))
    out = packing.pack(pieces, packing.Capacity(tokens=8), block_pieces=10)
    tasks = out.select(F.spark_partition_id().alias("t"), "sequence_id").distinct().collect()
    assert len({r.t for r in tasks}) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_too_long_a_piece(spark):
    pieces = spark.createDataFrame([(1, 9)], "doc_id long, length long")
    with pytest.raises(Exception, match="longer than a sequence"):
        packing.pack(pieces, packing.Capacity(tokens=8)).collect()
