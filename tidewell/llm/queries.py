"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import (bpe, embedding_dedup, language_id, license_scan, mean_order_clusters, mixing, ngram_join, nn_descent, piece_bpe, secrets,
                          toxicity, url_filter, vector_codes)
from tidewell.llm.common import col, remainder, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"))


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(documents(spark, sf_dir))


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixing.taken(mixed).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digests(license_scan.scan(documents(spark, sf_dir)))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), remainder(col("doc_id"), 5) != 0)
    return toxicity.score_toxicity(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    index = nn_descent.build(embeddings)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return nn_descent.search(index, embeddings.where("vec_id % 50 = 0"))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(documents(spark, sf_dir)))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.digests(bpe.round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.learn(docs, remainder(col("doc_id"), 4) != 2)
    return language_id.identify(docs, model).select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = piece_bpe.read_vocabulary(public_tokenizers.path(PIECES))
    return piece_bpe.digests(piece_bpe.round_trip(documents(spark, sf_dir), vocabulary))


@query
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    model = mean_order_clusters.fit(embeddings)
    return mean_order_clusters.digests(mean_order_clusters.assign(embeddings, model), model)


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = vector_codes.plant(table(spark, sf_dir, "embeddings"))
    books = vector_codes.fit(forest)
    return vector_codes.digests(vector_codes.encode(forest, books), books)
