"""The registered queries of the operators: name -> function of session and data folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouch.llm import alignment, bpe, embeddings, language, packing, prefixes, quality, sharding, simhash, suffixes, tool_calls, urls, warc
from vouch.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHARDS = 40
URL_RULES = [
    urls.UrlRule(False, "net"),
    urls.UrlRule(True, "example.net", "/en/"),
    urls.UrlRule(False, "example.com", "/de/"),
    urls.UrlRule(True, "org", "/fr/"),
]
BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BPE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def vocabulary(path: str = BPE_TOKENIZER) -> str:
    """The tokenizer's file as text: it travels with the job, executors need no copy of the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def piece_model(path: str = PIECE_MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@query("op1_embedding_near_dedup")
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query("op2_url_filters")
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query("op5_suffix_array_dedup")
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality.judge(docs, labels).drop("text")


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = bpe.Vocabulary.read(BPE_RANKS, public_tokenizers.PATTERN)
    return bpe.digests(table(spark, sf_dir, "documents", "doc_id", "text"), ranked)


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), SHARDS)


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary())


@query("op10_chat_formatting")
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = tool_calls.format_chats(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return calls.withColumn("faults", F.array_join("faults", "; "))


@query("op11_conversation_prefix_trie")
def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@query("op12_warc")
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digests(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query("op13_cross_tokenizer_alignment")
def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_scores(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary(), piece_model())
