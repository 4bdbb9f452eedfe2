"""Byte-level BPE over overlapping chunks: pre-tokenise in parallel, stitch where boundaries resynchronise, encode the pieces."""

from __future__ import annotations

import base64
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balcao.functions.lineage import write_intermediate
from balcao.llm import merging

#: Longer texts are cut into chunks of so many characters; each reads so many characters of the next one.
CHUNK_CHARS, OVERLAP_CHARS = 50_000, 400
#: A boundary nearer than this to the end of a chunk may depend on what follows (a contraction has three characters).
LOOK_AHEAD = 3
#: Words and pairs that a worker remembers, and the length of such words; speed only, not results.
CACHE_WORDS, CACHED_LENGTH, CACHE_PAIRS = 600_000, 48, 1_000_000
#: Words of up to so many bytes are merged without a heap.
SHORT_BYTES, NO_RANK = 40, 1 << 60
#: Results are handed back in pieces of about so many characters, which bounds the memory of a batch.
PIECE_CHARS = 2_000_000


SPACE = regex.compile(r"\s")

# Code points that Unicode made letters and numbers after version 16, to which the public library's classes go.
NEWER = """
558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee
11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda
18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de
1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f
"""
NEWER_CLASS = "[" + "".join("-".join(chr(int(c, 16)) for c in x.split("-")) for x in NEWER.split()) + "]"


class Pairs(dict):
    """(rank, merged id) of two adjacent ids: the rank of their joined bytes, looked up once."""

    def __init__(self, rank: dict[bytes, int], token: list[bytes]):
        super().__init__()
        self.rank, self.token = rank, token

    def get(self, pair: tuple[int, int]) -> tuple[int, int] | None:
        try:
            return self[pair]
        except KeyError:
            if len(self) >= CACHE_PAIRS:
                self.clear()
            at = self.rank.get(self.token[pair[0]] + self.token[pair[1]])
            found = self[pair] = None if at is None else (at, at)
            return found


class Ranks(merging.Merges):
    """Merges by a file of ranks: the pair whose joined bytes have the lowest rank comes first, the leftmost of equals."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.byte_id = [self.rank[bytes([b])] for b in range(256)]
        self.pair = Pairs(self.rank, self.token)

    def word(self, word: str) -> list[int]:
        """Ids of one match of the pattern; a word that is a token as a whole is not merged."""
        raw = word.encode("utf-8")
        whole = self.rank.get(raw)
        if whole is not None:
            return [whole]
        if len(raw) <= SHORT_BYTES:
            return self.merge_short(raw)
        _, symbols, following = self.merge([self.byte_id[b] for b in raw])
        out, at = [], 0
        while at != merging.NONE:
            out.append(symbols[at])
            at = following[at]
        return out

    def merge_short(self, raw: bytes) -> list[int]:
        """The same merges for a few bytes, by a plain search for the least rank, which costs less than a heap."""
        rank = self.rank
        get = rank.get
        parts = [raw[i : i + 1] for i in range(len(raw))]
        ranks = [get(a + b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) != NO_RANK:
            i = ranks.index(least)
            parts[i : i + 2] = [joined] = [self.token[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + joined, NO_RANK)
            if i < len(ranks):
                ranks[i] = get(joined + parts[i + 1], NO_RANK)
        return [rank[p] for p in parts]


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The matches of ``pattern`` in a text, with the classes of Unicode 16."""
    other = r"[^\s\p{L}\p{N}]"
    older = pattern.replace(other, "\0").replace(r"\p{L}", rf"(?:(?!{NEWER_CLASS})\p{{L}})").replace(r"\p{N}", rf"(?:(?!{NEWER_CLASS})\p{{N}})")
    plain, exact = regex.compile(pattern).findall, regex.compile(older.replace("\0", f"(?:{NEWER_CLASS}|{other})")).findall
    newer = re.compile(NEWER_CLASS).search
    return lambda text: plain(text) if text.isascii() or not newer(text) else exact(text)


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.ranks = Ranks(path)
        self.split = splitter(pattern)
        self.known: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        ids = self.ranks.word(word)
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= CACHED_LENGTH:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text, packed as little-endian unsigned 32-bit integers."""
        words = self.split(text)
        found = list(map(self.known.get, words))
        try:
            return b"".join(found)
        except TypeError:
            return b"".join([self.word(w) if ids is None else ids for w, ids in zip(words, found, strict=True)])

    def decode(self, ids: bytes) -> bytes:
        """The raw bytes of the ids, joined."""
        return b"".join(map(self.ranks.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def cut(text: str, chunk: int, overlap: int) -> list[str]:
    """Chunks of a text, each with the first ``overlap`` characters of what follows."""
    return [text[s : s + chunk + overlap] for s in range(0, len(text), chunk)]


def boundaries(window: str, split, chunk: int, overlap: int, last: bool) -> tuple[list[int], list[int]]:
    """Ends of words in the overlap at the beginning of a chunk (its first place counts) and in the overlap at its end.

    Places count from the beginning of the chunk. Ends that the missing rest of the text could change are left out, and so are ends
    after white space: how the pattern splits white space depends on what follows, so a piece must not end there.
    """
    ends = np.cumsum([0, *map(len, split(window))])
    if not last:
        ends = ends[ends <= len(window) - LOOK_AHEAD]
    tail = [e for e in ends[ends >= chunk].tolist() if not SPACE.match(window, e - 1)]
    return ends[ends <= overlap].tolist(), tail


def _encoded(rows: DataFrame, keys: list[str], vocabulary: str, pattern: str) -> DataFrame:
    """The keys, n_tokens, ids and decoded bytes of each row's text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(vocabulary, pattern)
        for batch in batches:
            sizes = batch["text"].str.len().cumsum()
            for _, part in batch.groupby(sizes // PIECE_CHARS, sort=False):
                ids = [own.encode(t) for t in part["text"]]
                yield part[keys].assign(n_tokens=[len(x) // 4 for x in ids], ids=ids, decoded=[own.decode(x) for x in ids])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    return rows.select(*keys, "text").mapInPandas(run, f"{schema}, n_tokens long, ids binary, decoded binary")


def _chunks(long: DataFrame, id_col: str, chunk: int, overlap: int) -> DataFrame:
    """(id, key, part, last, text) of the chunks of long texts, written before they are dealt out: a key is drawn once for good."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, text in zip(batch[id_col], batch["text"], strict=True):
                windows, key = cut(text, chunk, overlap), uuid.uuid4().hex
                for begin in range(0, len(windows), 100):
                    some = windows[begin : begin + 100]
                    part = np.arange(begin, begin + len(some))
                    frame = pd.DataFrame({"key": key, "part": part, "last": part == len(windows) - 1, "text": some})
                    frame.insert(0, id_col, pd.Series([doc_id] * len(some), dtype=batch[id_col].dtype))
                    yield frame

    kind = dict(long.dtypes)[id_col]
    rows = long.mapInPandas(run, f"`{id_col}` {kind}, key string, part long, last boolean, text string")
    return write_intermediate(rows, "bpe-chunks")


def stitched(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(key, part, piece, cut, end, alone): the piece of each chunk, its share of it within its own window, and whether it is all of it.

    A piece begins at the first boundary that a chunk and the one before it have in common. Where they have none (one word or
    blank fills the overlap) the chunk goes on with the piece before. The cuts are boundaries of the whole text: by the pattern,
    a scan that begins inside a text can differ from the scan of the whole only in its first match, and only up to three characters
    on (a contraction after punctuation), since every other match ends where the class of characters changes; and an
    overlap lies further than that from the beginning of the chunk before.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split = splitter(pattern)
        for batch in batches:
            found = [boundaries(t, split, chunk, overlap, e) for t, e in zip(batch["text"], batch["last"], strict=True)]
            yield batch[["key", "part", "last"]].assign(head=[h for h, _ in found], tail=[t for _, t in found])

    schema = "key string, part long, last boolean, head array<long>, tail array<long>"
    ends = write_intermediate(chunks.select("key", "part", "last", "text").repartition("key", "part").mapInPandas(run, schema), "bpe-boundaries")
    before = ends.select("key", (F.col("part") + 1).alias("part"), F.transform("tail", lambda p: p - chunk).alias("tail"))
    common = F.array_min(F.array_intersect("head", "before.tail"))
    cuts = (
        ends.alias("own")
        .join(before.alias("before"), ["key", "part"], "left")
        .select("key", "part", "last", F.when(F.col("part") == 0, F.lit(0).cast("long")).otherwise(common).alias("cut"))
    )
    ordered = Window.partitionBy("key").orderBy("part")
    following = F.lead("cut").over(ordered)
    return cuts.select(
        "key",
        "part",
        F.last(F.when(F.col("cut").isNotNull(), F.col("part")), ignorenulls=True).over(ordered).alias("piece"),
        F.coalesce("cut", F.lit(0)).cast("int").alias("cut"),
        F.when(F.col("last"), F.lit(chunk + overlap)).otherwise(chunk + F.coalesce(following, F.lit(0))).cast("int").alias("end"),
        (F.col("cut").isNotNull() & (F.col("last") | following.isNotNull())).alias("alone"),
    )


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str = public_tokenizers.PATTERN,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_tokens, ids, decoded) of every row: ids packed as little-endian unsigned 32-bit integers, and their raw bytes.

    Each match of ``pattern`` is encoded by itself, without special tokens. Texts of up to ``chunk`` characters are one chunk and
    stay where they are. Longer ones are cut into overlapping chunks that any task may take, stitched, encoded piece by piece and
    put together by their key, so a very long text is spread over the cluster; only a single word longer than a chunk, and
    the finished row, are held whole. ``overlap`` is at least 4 and less than ``chunk``.

    Null and empty texts give 0 tokens and empty bytes. Repeated rows and null ids give a row each: a long row has a key of its
    own. Other columns are not read; an empty table gives an empty result.
    """
    if not LOOK_AHEAD < overlap < chunk:
        raise ValueError("the overlap must be longer than a contraction and shorter than a chunk")
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = _encoded(texts.where(F.char_length("text") <= chunk), [id_col], vocabulary, pattern)
    chunks = _chunks(texts.where(F.char_length("text") > chunk), id_col, chunk, overlap)
    shares = chunks.join(stitched(chunks, pattern, chunk, overlap), ["key", "part"]).select(
        id_col, "key", "part", "piece", "alone", F.substring("text", F.col("cut") + 1, F.col("end") - F.col("cut")).alias("text")
    )
    shares = write_intermediate(shares, "bpe-pieces")
    alone = shares.where("alone").select(id_col, "key", "piece", "text")
    joined = (
        shares.where(~F.col("alone"))
        .groupBy("key", "piece")
        .agg(F.sort_array(F.collect_list(F.struct("part", "text", F.col(id_col).alias("id")))).alias("rows"))
        .select(F.col("rows")[0]["id"].alias(id_col), "key", "piece", F.array_join("rows.text", "").alias("text"))
    )
    pieces = _encoded(alone.unionByName(joined), [id_col, "key", "piece"], vocabulary, pattern)
    packed = F.struct("piece", F.col(id_col).alias("id"), "n_tokens", "ids", "decoded")
    join = lambda name: F.unhex(F.array_join(F.transform(f"rows.{name}", F.hex), ""))
    whole = (
        pieces.groupBy("key")
        .agg(F.sort_array(F.collect_list(packed)).alias("rows"))
        .select(
            F.col("rows")[0]["id"].alias(id_col),
            F.expr("reduce(rows, 0L, (s, r) -> s + r.n_tokens)").alias("n_tokens"),
            join("ids").alias("ids"),
            join("decoded").alias("decoded"),
        )
    )
    return short.unionByName(whole)
