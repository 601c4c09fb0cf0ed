"""A training corpus from `documents`: languages, near copies, secrets, mixture, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import bpe, language_id, mixing, ngram_join, secrets
from tidewell.llm.common import col, drop, ready, remainder, staged, table, workspace
from tidewell.llm.queries import RANKS

#: SQL cannot express the stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that can be given a language learned from this corpus stay, with it where they had none; those without a letter go."""
    model = language_id.learn(docs, remainder(col("doc_id"), 4) != 2)
    return language_id.keep_identified(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by 75 % of their word shingles the one of smallest id stays."""
    return ngram_join.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by their kind, and n_chars follows."""
    return secrets.redact(docs, length="n_chars")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture of the sources takes it."""
    return mixing.repeated(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, and what they decode to, as digests."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.digests(bpe.round_trip(docs, ranks, public_tokenizers.PATTERN))


STAGES = [
    ("language_id", known_languages),
    ("near_copies", near_copies),
    ("secrets", without_secrets),
    ("mixture", mixture),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again by the next. What a stage has staged
    for itself is deleted when its rows are written, and these when those of the next are."""
    docs, read = table(ready(spark), sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        with workspace(spark):
            docs = staged(stage(spark, docs, sf_dir), beyond_workspace=True)
        for folder in read:
            drop(spark, folder)
        read = [docs.inputFiles()[0].rsplit("/", 1)[0]] if docs.inputFiles() else []
    return STAGES[-1][1](spark, docs, sf_dir)
