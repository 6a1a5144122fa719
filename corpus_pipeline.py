"""Corpus pipeline: documents through quality rules, near duplicates, personal data, mixing, token ids.

Every stage takes what the one before it kept, written as Parquet and read again, and returns the
columns of documents with its decisions applied; the last one returns token ids.

1. ``quality``: failing lines are removed, rejected documents go.
2. ``near_duplicates``: of each group of near duplicates the document with the smallest id stays.
3. ``personal_data``: spans of personal data are replaced by their kind in brackets.
4. ``mix``: documents as often, and with the words, that the mix to target weights takes.
5. ``token_ids``: the ids of each text, which decode to it again.

Defined results, for every stage but the last: columns stay as they are, whatever their names, but for text
and its length. A null text is the empty text; quality rules reject it, as they do texts that are too
short. Rows repeated with their doc_id and text are one document from the second stage on. Empty tables
stay empty. Texts of any length are taken whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import bpe, mixing, near, pii, quality
from starmart.llm.common import stored, table, whole_text

RANKS = "byte_bpe_multi_50k.tiktoken"


def _carried(docs: DataFrame) -> DataFrame:
    """The text beside the whole row in one column, so that no column an operator adds meets one of the row's."""
    return docs.select("text", F.struct(*(docs[c] for c in docs.columns)).alias("_row"))


def _with_text(carried: DataFrame, columns: list[str], text) -> DataFrame:
    """The carried rows as documents again, with another text and its length."""
    changed = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    row = [changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns]
    return carried.select("_row", text.alias("_text")).select(*row)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = quality.judge(_carried(docs)).filter("kept")
    return _with_text(kept, docs.columns, F.col("cleaned_text"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.one_of_each(docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(pii.find(_carried(docs)), docs.columns, pii.masked(whole_text()))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_ids_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    ids = bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN)
    return ids.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("personal_data", personal_data_stage),
    ("mix", mix_stage),
    ("token_ids", token_ids_stage),
]

# Near duplicates, the permutations of the mix and the tokenizer are not expressible in SQL; the
# pipeline is tested against a plain Python version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
