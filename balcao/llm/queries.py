"""Registered queries of the training-data operators, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.llm import (
    alignment,
    block_labeller,
    chunked_bpe,
    decontaminate,
    graph_search,
    line_spread,
    path_join,
    periodic_runs,
    quality,
    speculative_bpe,
    token_counts,
    toxicity,
    uniform_shards,
)
from balcao.llm.package import shipped
from balcao.llm.tables import table

MIN_SITES, MIN_LINE_WORDS = 5, 3
SIMILARITY, SHINGLE = 0.8, 5
SHARDS = 16


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = graph_search.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_spread.dedup_lines(docs, MIN_SITES, MIN_LINE_WORDS).select("doc_id", "n_lines", "n_removed", "text")


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return path_join.join(table(spark, sf_dir, "documents"), SIMILARITY, SHINGLE)


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def encoded(docs: DataFrame) -> DataFrame:
    """Digests of the ids and of the decoded text."""
    rows = speculative_bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = uniform_shards.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def toxic_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return block_labeller.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), SIMILARITY, SHINGLE)


def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find_runs(table(spark, sf_dir, "documents"), periodic_runs.replay_tenth))


def chunk_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chunked_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def tokenizer_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.aligned(table(spark, sf_dir, "documents"), first, second)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": shipped(token_count),
    "op2_graph_neighbours": shipped(nearest_neighbours),
    "op3_line_spread": shipped(line_dedup),
    "op4_path_join": shipped(jaccard_join),
    "op5_speculative_bpe": shipped(bpe_round_trip),
    "op6_uniform_shards": shipped(sharding),
    "op7_toxicity": shipped(toxic_score),
    "op8_main_text": shipped(main_text),
    "op9_quality": shipped(quality_score),
    "op10_decontamination": shipped(leaks),
    "op11_periodic_runs": shipped(word_runs),
    "op12_chunked_bpe": shipped(chunk_round_trip),
    "op13_alignment": shipped(tokenizer_links),
}

ORACLES: dict[str, str] = {
    "op3_line_spread": line_spread.SQL.format(sites=MIN_SITES, gaps=MIN_LINE_WORDS - 1),
    "op4_path_join": path_join.SQL.format(width=SHINGLE, threshold=SIMILARITY),
    "op10_decontamination": decontaminate.SQL.format(width=SHINGLE, threshold=SIMILARITY),
}
