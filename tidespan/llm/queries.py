"""Registered queries of this subpackage, one for each operator, over the whole of their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, exact_dedup, hamming, html_text, mixing, packing, pii, quality, resampling, simhash, spelling, toxicity, warc
from .base import settle, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_mixing", mixing.sample_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic, raked weight, sampling probability and draw of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    out = mixing.mark(docs)
    places = [F.round(c, 6).alias(c) for c in ("probability", "weight")]
    return out.select("doc_id", "topic", "tokens", *places, "kept")


@query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.col("spans.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    base, terms = pii.spelled("spans"), pii.spelled("terms")
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(terms, F.lit(""))).alias("spans"),
        F.size("terms").cast("long").alias("n_terms"),
    )


@query(
    "op3_topk_search",
    """
WITH e AS (SELECT vec_id, [CASE WHEN x > 0 THEN 1 ELSE 0 END for x in embedding] AS b
           FROM embeddings WHERE len(embedding) = 64),
p AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id,
             CAST(list_sum([CASE WHEN q.b[i] <> r.b[i] THEN 1 ELSE 0 END for i in range(1, 65)]) AS BIGINT) AS distance
      FROM e q JOIN e r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, neighbour_id, distance FROM n WHERE rank <= 10""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all sign codes, for every vector whose id is divisible by 20."""
    codes = table(spark, sf_dir, "embeddings").select("vec_id", hamming.sign_code("embedding").alias("code"))
    return hamming.nearest(codes, codes.where("vec_id % 20 = 0"), k=10)


#: What the tools that op4 derives from user turns accept.
TOOLS = {
    "search": {
        "type": "object",
        "required": ["query", "limit"],
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "maximum": 20}},
        "additionalProperties": False,
    },
    "lookup": {
        "type": "object",
        "required": ["key"],
        "properties": {"key": {"type": "string", "pattern": "^[0-9a-f]{32}$"}, "exact": {"type": "boolean"}},
    },
    "shorten": {
        "type": "object",
        "required": ["text", "words"],
        "properties": {"text": {"type": "string", "maxLength": 2000}, "words": {"type": "number", "minimum": 1}},
    },
}


def tool_log(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as the turns of conversations imply them.

    A user turn calls one of three tools, chosen by its length, with its text as argument, and builds on the call two
    turns before; an assistant turn is the result of the call one turn before.
    """
    size = F.length("text")
    id_ = lambda back: F.concat_ws("-", F.lit("call"), "conv_id", F.col("turn") - back)
    search = F.to_json(F.struct((size % 24).alias("limit"), F.col("text").alias("query")))
    lookup = F.to_json(F.struct(F.md5(F.col("text").cast("binary")).alias("key"), (size % 2 == 0).alias("exact")))
    shorten = F.to_json(F.struct("text", (size / 16).alias("words")))
    kind = size % 3
    calls = turns.where("role = 'user'").select(
        "conv_id",
        "turn",
        id_(0).alias("call_id"),
        F.when(kind == 0, "search").when(kind == 1, "lookup").otherwise("shorten").alias("name"),
        F.when(kind == 0, search).when(kind == 1, lookup).otherwise(shorten).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(id_(2))).otherwise(F.array().cast("array<string>")).alias("refers"),
    )
    results = turns.where("role = 'assistant'").select("conv_id", "turn", id_(1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


@query("op4_chat_formatting")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tool calls that all conversations imply, linked, ordered and checked."""
    calls, results = tool_log(table(spark, sf_dir, "conversations"))
    return chat.link(calls, results, TOOLS)


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels outside the held-out third."""
    held_out = toxicity.remainder("doc_id", 3) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    "op7_exact_dedup",
    r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS len,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY len DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document the row that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.mark_copies(docs).drop("text")


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, TOKENIZER, packing.Capacity(tokens=2048), with_ids=False)


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels outside the held-out fifth."""
    held_out = quality.remainder("doc_id", 5) == 0
    stats = settle(quality.measured(table(spark, sf_dir, "documents").select("doc_id", "text")))
    model = quality.fit(stats, table(spark, sf_dir, "labels").where(~held_out))
    return quality.score(stats, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op10_warc")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from the archives."""
    records = warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), least=0, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its form, root and number of near words."""
    return spelling.group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op12_html_extraction")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op13_importance_resampling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document towards the benchmark's texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.mark(docs, table(spark, sf_dir, "benchmark"))
