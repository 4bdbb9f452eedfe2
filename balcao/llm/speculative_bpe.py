"""BPE encoding and decoding by speculation: greedy longest match, vectorised checks of adjacent pairs, exact merging of the rest."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import merging

CACHE_WORDS = 300_000
CACHED_LENGTH = 48
#: Texts are handed back in pieces of about so many characters, which bounds the memory of a batch of long texts.
PIECE_CHARS = 4_000_000
SCHEMA = "n_tokens long, ids binary, decoded string"

# Fixed value: the published pattern that splits normalised text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NO_LIMIT = np.iinfo(np.int64).max


class Speculator:
    """Encodes words with one vocabulary whose word-final symbols carry a suffix."""

    def __init__(self, path: str):
        self.merges = m = merging.load(path)
        size = max([*m.vocab.values(), *m.special.values()]) + 1
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        pairs = np.array([(a, b, r, t) for (a, b), (r, t) in m.pair.items()], np.int64).reshape(-1, 4)
        self.rank[pairs[:, 3]] = pairs[:, 2]
        self.left[pairs[:, 3]], self.right[pairs[:, 3]] = pairs[:, 0], pairs[:, 1]
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.pair_key, self.pair_rank = keys[order], pairs[order, 2]
        self.string = [""] * size
        for s, i in [*m.vocab.items(), *m.special.items()]:
            self.string[i] = s
        self._own_tokens(pairs)
        self.split = regex.compile(PATTERN).findall
        special = sorted(m.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.space = regex.compile(r"\s+")
        self.known: dict[str, tuple[int, bytes, str]] = {}

    def _own_tokens(self, pairs: np.ndarray) -> None:
        """Only tokens that merging their own symbols gives may be proposed."""
        fit = self.compatible(pairs[:, 0], pairs[:, 1], pairs[:, 2])
        own = np.ones(len(self.rank), bool)
        for a, b, t, ok in zip(pairs[:, 0].tolist(), pairs[:, 1].tolist(), pairs[:, 3].tolist(), fit.tolist(), strict=True):
            own[t] = ok and own[a] and own[b]
        suffix = self.merges.suffix
        self.inner = {s: i for s, i in self.merges.vocab.items() if own[i] and not (suffix and s.endswith(suffix))}
        self.final = {s.removesuffix(suffix): i for s, i in self.merges.vocab.items() if own[i] and (not suffix or s.endswith(suffix))}
        self.longest_inner = max(map(len, self.inner))
        self.longest_final = max(map(len, self.final))

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NO_LIMIT)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = NO_LIMIT) -> np.ndarray:
        """Whether merging the symbols of tokens ``a`` and ``b`` side by side never joins the two, for each pair.

        The merges of both are undone from the last to the first. At each step the two symbols that meet must have no
        merge that would have come earlier than the merge undone last; of equal ranks the one to the left comes first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.broadcast_to(np.asarray(limit, np.int64), a.shape).copy()
        fit, open_ = np.ones(len(a), bool), np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            clash = self.pair_ranks(x, y) < limit[open_]
            fit[open_[clash]] = False
            rx, ry = self.rank[x], self.rank[y]
            going = ~clash & ((rx >= 0) | (ry >= 0))
            undo_right = ry >= rx
            r, left = open_[going & undo_right], open_[going & ~undo_right]
            limit[r], b[r] = self.rank[b[r]] + 1, self.left[b[r]]
            limit[left], a[left] = self.rank[a[left]], self.right[a[left]]
            open_ = open_[going]
        return fit

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over the byte characters of ``word``."""
        s = "".join([self.merges.alphabet[b] for b in word.encode("utf-8")])
        out, at, n = [], 0, len(s)
        inner, final = self.inner, self.final
        while at < n:
            if n - at <= self.longest_final and (t := final.get(s[at:])) is not None:
                out.append(t)
                break
            for k in range(min(self.longest_inner, n - at - 1), 0, -1):
                if (t := inner.get(s[at : at + k])) is not None:
                    out.append(t)
                    at += k
                    break
        return out

    def exact(self, word: str) -> list[int]:
        _, symbols, following = self.merges.merge(self.merges.symbols(word))
        out, at = [], 0
        while at != merging.NONE:
            out.append(symbols[at])
            at = following[at]
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word: proposals that pass the check of every adjacent pair, exact merging for the others."""
        ids = [self.propose(w) for w in words]
        lengths = np.array([len(x) for x in ids])
        if not len(lengths):
            return ids
        flat = np.fromiter((t for x in ids for t in x), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(ids)), lengths)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        if len(inside):
            a, b = flat[inside], flat[inside + 1]
            distinct, back = np.unique(a << 32 | b, return_inverse=True)
            fit = self.compatible(distinct >> 32, distinct & 0xFFFFFFFF)[back]
            for w in np.unique(owner[inside[~fit]]).tolist():
                ids[w] = self.exact(words[w])
        return ids

    def normalise(self, text: str) -> str:
        """Composed form, white space as one blank, lower case letter by letter (no final sigma)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.space.sub(" ", text).lower()

    def pieces(self, text: str) -> list[str]:
        """Words of a text, with special strings as words of their own."""
        if self.special is None or not self.special.search(text):
            return self.split(self.normalise(text))
        out = []
        for i, piece in enumerate(self.special.split(text)):
            out += [piece] if i % 2 else self.split(self.normalise(piece))
        return out

    def entries(self, words: Iterable[str]) -> dict[str, tuple[int, bytes, str]]:
        words = list(words)
        plain = [w for w in words if w not in self.merges.special]
        ids = dict(zip(plain, self.encode_words(plain), strict=True)) | {w: [self.merges.special[w]] for w in words if w in self.merges.special}
        return {w: (len(x), np.array(x, "<u4").tobytes(), " ".join([self.string[t] for t in x])) for w, x in ids.items()}

    def encode(self, texts: list[str]) -> list[tuple[int, bytes, str]]:
        """Number of tokens, packed ids and decoded text of each text."""
        split = [self.pieces(t) for t in texts]
        known = self.known
        new = {w for words in split for w in words if w not in known}
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = {w for words in split for w in words}
        found = self.entries(new)
        known.update((w, e) for w, e in found.items() if len(w) <= CACHED_LENGTH)
        out = []
        for words in split:
            rows = [known[w] if w in known else found[w] for w in words]
            out.append((sum([r[0] for r in rows]), b"".join([r[1] for r in rows]), " ".join([r[2] for r in rows])))
        return out


@lru_cache(maxsize=4)
def speculator(path: str) -> Speculator:
    return Speculator(path)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) of every row: ids packed as little-endian unsigned 32-bit integers, and their decoded text.

    Decoding joins the vocabulary's strings of the ids by blanks, as the public library does for a file without a decoder.
    Null and empty texts give 0 tokens, empty bytes and the empty text. Repeated rows and null ids give a row each; other
    columns are not read; an empty table gives an empty result. Nothing is shuffled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = speculator(vocabulary)
        for batch in batches:
            sizes = batch["text"].str.len().cumsum()
            for _, part in batch.groupby(sizes // PIECE_CHARS, sort=False):
                rows = own.encode(part["text"].tolist())
                yield pd.DataFrame({id_col: part[id_col], **{c: [r[i] for r in rows] for i, c in enumerate(("n_tokens", "ids", "decoded"))}})

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(run, f"`{id_col}` {kind}, {SCHEMA}")


def ids_array(ids: Column) -> Column:
    """Packed ids as an array of longs."""
    code, n = F.hex(ids), F.floor(F.octet_length(ids) / 4).cast("int")
    byte = lambda i, k: F.substr(code, i * 8 + 1 + 2 * k, F.lit(2))
    one = lambda i: F.conv(F.concat(*[byte(i, k) for k in (3, 2, 1, 0)]), 16, 10).cast("long")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<bigint>"))
