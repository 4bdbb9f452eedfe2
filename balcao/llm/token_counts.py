"""Token counts: heap-and-linked-list byte-pair merging; a count is the initial symbols minus the merges, no ids emitted."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import merging

#: Counts of so many distinct words, none longer than CACHED_LENGTH, are remembered per worker; speed only, not results.
CACHE_WORDS = 400_000
CACHED_LENGTH = 48

# Fixed value: the published pattern that splits text before byte-level merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Counter:
    """Counts the tokens of texts with one vocabulary."""

    def __init__(self, path: str):
        self.merges = merging.load(path)
        self.words = regex.compile(PATTERN).findall
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        symbols = self.merges.symbols(word)
        n = len(symbols)
        n -= self.merges.merge(symbols)[0]
        if len(word) <= CACHED_LENGTH:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = n
        return n

    def piece(self, text: str) -> int:
        words = self.words(text)
        counts = list(map(self.known.get, words))
        try:
            return sum(counts)
        except TypeError:
            return sum(self.word(w) if c is None else c for w, c in zip(words, counts, strict=True))

    def text(self, text: str) -> int:
        if self.special is None or "<|" not in text and not self.special.search(text):
            return self.piece(text)
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(map(self.piece, pieces))


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def token_count(text: Column, vocabulary: str) -> Column:
    """Number of tokens of each text with the vocabulary file at ``vocabulary``; null counts as the empty text."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(vocabulary)
        for texts in batches:
            yield pd.Series([own.text(t) for t in texts], dtype="int64")

    return count(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and null ids give a row each. Other columns are not read, so
    their names cannot clash. An empty table gives an empty result. Texts of any length are counted whole: a word of n bytes
    takes O(n log n). Nothing is shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), token_count(text, vocabulary).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
