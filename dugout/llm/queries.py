"""Registered queries of the training-data operators: name -> fn(spark, sf_dir), and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.llm import (
    decontaminate, jaccard_join, language_id, license_scan, line_dedup, mixing, prefix_trie, token_counts, token_pack, toxicity, warc, whitening,
    winnow,
)
from dugout.llm.common import read
from dugout.llm.oracle import ORACLE  # noqa: F401  (registered with the queries)


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the chain's probabilities and its verdict."""
    docs = read(spark, sf_dir, "documents")
    chain = toxicity.fit(docs, toxicity.with_categories(read(spark, sf_dir, "labels")))
    return toxicity.score(docs, chain).drop("text_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: one row per (document, item)."""
    return (decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts.section_tokens(read(spark, sf_dir, "documents"), RANKS)


def op4_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_pack.pack_documents(read(spark, sf_dir, "documents"), TOKENIZER)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions read back from the archives that hold all pages."""
    archives = warc.write_archives(read(spark, sf_dir, "pages"))
    rows = warc.captures(warc.read_records(spark, archives, with_payload=False))
    return rows.select(warc.field("page-id").cast("long").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                       F.col("type").alias("record_type"), warc.field("revisits-page-id").cast("long").alias("refers_to"), "url")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without its host's boilerplate lines."""
    return line_dedup.drop_boilerplate(read(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(read(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", "source"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_pairs(read(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class of linked documents, its copy class, its number of links."""
    return (jaccard_join.similar_documents(read(spark, sf_dir, "documents"))
            .select("doc_id", "class_id", "copy_id", "n_links"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    return language_id.identify(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each node of the trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole, finite embedding on each of the 16 leading components."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_token_pack": op4_token_pack,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_winnowing": op8_winnowing,
    "op9_license_scan": op9_license_scan,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_language_id": op11_language_id,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}
