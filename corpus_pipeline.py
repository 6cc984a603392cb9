"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of `documents`. `run`
writes every stage's rows below the shared folder and reads them back, so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidespan.llm import exact_dedup, mixing, packing, simhash, toxicity
from tidespan.llm.base import settle, table
from tidespan.llm.queries import TOKENIZER
from tidespan.sources.scratch import release, workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; learnt from the labels outside the held-out third."""
    labels = table(spark, sf_dir, "labels").where(toxicity.remainder("doc_id", 3) != 1)
    model = toxicity.fit(docs, labels)
    flagged = toxicity.score(docs.select(*docs.columns), model)
    return flagged.where(F.col("predicted") == 0).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for blanks."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (three words) are linked by steps of at most two bits."""
    return simhash.drop_near_copies(docs, words=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its ids and its place in a sequence."""
    return packing.pack_documents(docs, TOKENIZER, packing.Capacity(tokens=2048))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Toxicity and fingerprints cannot be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over all documents. What a stage writes for itself is removed when its rows are
    written, and those when the next stage's are."""
    docs, written = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with workspace(spark):
            docs = settle(stage(spark, docs, sf_dir), outside=True)
        if written is not None:
            release(written)
        written = docs.tidespan_path
    return docs
