"""Registered queries of the text operators: each applies its operator to a whole given table."""

from __future__ import annotations

import math

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    acsearch,
    bpe,
    chat,
    htmltext,
    langid,
    lz,
    mixing,
    near,
    pii,
    quality,
    urlfilter,
    warc,
    whitening,
)
from starmart.llm.common import shuffle_partitions, table
from starmart.sources import paths

RANGE_BYTES = 128 * 1024 * 1024


def _ranges(spark: SparkSession, path: str) -> int:
    """As many parts as the session asks for, more where they would grow too large."""
    return max(shuffle_partitions(spark), math.ceil(paths.size_of(spark, path) / RANGE_BYTES))


def op1_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lz.compared(docs, ranges=_ranges(spark, f"{sf_dir}/documents.parquet"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = urlfilter.rules_frame(spark, URL_RULES)
    return urlfilter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trips(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages).select("page_id", "url", "text", "n_chars")


def op8_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repaired(table(spark, sf_dir, "conversations"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    automata = langid.learn(langid.sample(docs))
    return langid.identify(docs.select("doc_id", "text"), automata).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(f"{k}_spans").cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_list(pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.span_list([k.name for k in pii.KINDS]).alias("spans"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return acsearch.search(docs, items, k=10)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index, archives = warc.archived(pages)
    found = warc.look_up(index, pages, "url", "page_id")
    return warc.read_records(found, archives, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=4)


QUERIES = {
    "op1_lz_fingerprint": op1_lz_fingerprint,
    "op2_ngram_join": op2_ngram_join,
    "op3_mixing": op3_mixing,
    "op4_url_filter": op4_url_filter,
    "op5_quality_rules": op5_quality_rules,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_html_text": op7_html_text,
    "op8_chat_repair": op8_chat_repair,
    "op9_language": op9_language,
    "op10_pii": op10_pii,
    "op11_lexical_search": op11_lexical_search,
    "op12_warc": op12_warc,
    "op13_whitening": op13_whitening,
}
