"""From raw documents to encoded training text: quality, shared lines, near copies, test passages, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the columns of
``documents``; the last returns the digests of the encoded texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.functions.lineage import shared_folder
from balcao.llm import decontaminate, line_spread, path_join, quality
from balcao.llm.package import shipped
from balcao.llm.queries import MIN_LINE_WORDS, MIN_SITES, SHINGLE, SIMILARITY, encoded
from balcao.llm.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEEP_SCORE = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It is fitted on the labels of the table, outside the held-out fold."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(quality.score(F.col("text"), model) >= KEEP_SCORE).select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sources and texts share stay where they are first; texts and their lengths shrink, documents stay.

    Copies and near copies of a text count as one text: the next stage decides on them as a whole.
    """
    cut = line_spread.dedup_lines_of_texts(docs, MIN_SITES, MIN_LINE_WORDS, SIMILARITY, SHINGLE)
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return path_join.first_of_groups(docs, SIMILARITY, SHINGLE).select(*COLUMNS)


def drop_test_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), SIMILARITY, SHINGLE).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", shipped(keep_quality)),
    ("lines", shipped(drop_shared_lines)),
    ("near copies", shipped(drop_near_copies)),
    ("test passages", shipped(drop_test_passages)),
    ("tokens", shipped(encode)),
]

#: The learned classifier of the first stage cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
