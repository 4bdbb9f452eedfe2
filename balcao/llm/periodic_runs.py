"""Periodic runs of words by seeds and diagonals: an index of k-grams, pairs of occurrences in one text, extensions per lag."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run is at least so many words and so many periods long.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Texts are worked on in slices of about so many bytes (a longer text is a slice of its own), which bounds memory.
SLICE_BYTES = 6_000_000
#: First step of an extension, doubled until a word differs.
FIRST_STEP = 64

#: Places a text's words are taken from again: (doc_id, number of words) to (first place, period), or None.
Replay = Callable[[object, int], "tuple[int, int] | None"]


def replay_tenth(doc_id: object, n: int) -> tuple[int, int] | None:
    """The words that a tenth of the ids repeat: from word a on, with period p."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(k, least period, greatest period) of each index that a text of ``longest`` words needs.

    A run of period q repeats, at lag q, at least ``max(6, 4 q) - q`` words; k is the least of these overlaps over the periods of
    the scale, so every run holds a k-gram and its copy q words on. The scale ends where k is still ``2 q - 1``: such a k-gram
    has no nearer copy inside the run, or the run would have a smaller period. So pairs of neighbouring occurrences suffice.
    """
    low = 1
    while max(MIN_WORDS, MIN_PERIODS * low) <= longest:
        k = max(MIN_WORDS - low, (MIN_PERIODS - 1) * low)
        high = (k + 1) // 2
        yield k, low, high
        low = high + 1


class Index:
    """Exact names of the k-grams that occur at least twice in their text; a name of k words joins two names of fewer words."""

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        self.k, self.name = 0, words
        self.size = len(words)
        self._keep(np.arange(self.size), doc * (int(words.max(initial=0)) + 1) + words)
        self.k = 1

    def _keep(self, at: np.ndarray, key: np.ndarray) -> None:
        _, name, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[name] > 1
        self.at = at[again]
        self.name = np.full(self.size, -1, np.int64)
        self.name[self.at] = name[again]

    def grow(self, k: int) -> None:
        """Longer grams; words are named per text, so a gram over the end of a text never occurs again."""
        while self.k < k and len(self.at):
            step = min(k - self.k, self.k)
            at = self.at[self.at + step < self.size]
            after = self.name[at + step]
            at, after = at[after >= 0], after[after >= 0]
            self._keep(at, self.name[at] * (int(self.name.max(initial=0)) + 1) + after)
            self.k += step

    def pairs(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, lag) of neighbouring occurrences with a lag of the scale, one for each stretch of seeds in a row."""
        order = np.argsort(self.name[self.at], kind="stable")
        at = self.at[order]
        name = self.name[at]
        lag = at[1:] - at[:-1]
        fit = (name[1:] == name[:-1]) & (lag >= low) & (lag <= high)
        at, lag = at[:-1][fit], lag[fit]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        first = np.ones(len(at), bool)
        first[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        return at[first], lag[first]


def _agreement(left: np.ndarray, right: np.ndarray) -> int:
    """Number of leading places at which two arrays agree."""
    n, done, step = min(len(left), len(right)), 0, FIRST_STEP
    while done < n:
        differ = np.flatnonzero(left[done : min(done + step, n)] != right[done : min(done + step, n)])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, step * 2
    return n


def runs(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(text, start, length, period) of every run of the texts whose words begin at ``starts``; the last start is the end."""
    n_words = np.diff(starts)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    index, found = Index(words, doc), []
    for k, low, high in scales(int(n_words.max(initial=0))):
        index.grow(k)
        if not len(index.at):
            break
        covered: dict[int, int] = {}
        for i, q in zip(*(x.tolist() for x in index.pairs(low, high)), strict=True):
            if i < covered.get(q, 0):
                continue
            d = int(doc[i])
            begin, end = int(starts[d]), int(starts[d + 1])
            right = i + _agreement(words[i : end - q], words[i + q : end])
            left = i - _agreement(words[begin:i][::-1], words[begin + q : i + q][::-1])
            covered[q] = right
            if right - left + q >= max(MIN_WORDS, MIN_PERIODS * q):
                found.append((d, left - begin, right - left + q, q))
    out = np.array(found, np.int64).reshape(-1, 4)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _slice(ids: list, texts: pa.Array, replay: Replay | None) -> dict[str, pa.Array]:
    """Columns n_words, runs and collapsed of some texts."""
    split = pc.ascii_split_whitespace(texts)
    flat, doc = split.flatten(), pc.list_parent_indices(split).to_numpy()
    real = pc.greater(pc.binary_length(flat), 0)
    flat, doc = flat.filter(real), doc[real.to_numpy(zero_copy_only=False)]
    starts = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(ids)))])
    place = np.arange(len(flat))
    if replay:
        for d, doc_id in enumerate(ids):
            begin, n = int(starts[d]), int(starts[d + 1] - starts[d])
            if again := replay(doc_id, n):
                a, p = again
                place[begin + a : begin + n] = begin + a + np.arange(n - a) % p
    words = flat.dictionary_encode().indices.to_numpy().astype(np.int64)[place]
    found = runs(words, starts)
    change = np.zeros(len(words) + 1, np.int64)
    base = starts[found[:, 0]] + found[:, 1]
    np.add.at(change, base + found[:, 3], 1)
    np.add.at(change, base + found[:, 2], -1)
    kept = np.cumsum(change[:-1]) == 0
    before = np.concatenate([[0], np.cumsum(kept)])
    left = pa.LargeListArray.from_arrays(before[starts], flat.cast(pa.large_string()).take(pa.array(place[kept])))
    records = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
    bounds = np.searchsorted(found[:, 0], np.arange(len(ids) + 1)).astype(np.int32)
    return {
        "n_words": pa.array(np.diff(starts)),
        "runs": pa.ListArray.from_arrays(bounds, records),
        "collapsed": pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string()),
    }


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE_BYTES."""
    begin = total = 0
    for k, size in enumerate(sizes.tolist()):
        if k > begin and total + size > SLICE_BYTES:
            yield begin, k
            begin, total = k, 0
        total += size
    if len(sizes) > begin:
        yield begin, len(sizes)


def find_runs(docs: DataFrame, replay: Replay | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of every row of ``docs``.

    Words are separated by ASCII white space. ``runs`` holds (start, length, period) of every maximal stretch of words with smallest
    period q, at least six words and four periods long, by start and period. ``collapsed`` is the text without the words that lie
    in a run after its first period, joined by one space. ``replay`` may name words that repeat earlier ones, before the search.

    Null, empty and blank texts have no words and no runs, and collapse to the empty text. Rows with null or repeated ids give a
    row each (a null id replays nothing). Other columns are not read; an empty table gives an empty result. Texts are read
    whole: memory is in proportion to the longest text. Work grows with n log n of a text's words, also where one word or
    passage fills it, as only neighbouring occurrences are paired. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            for begin, end in _slices(sizes):
                ids = batch.column(0).slice(begin, end - begin)
                part = _slice(ids.to_pylist(), texts.slice(begin, end - begin), replay)
                yield pa.RecordBatch.from_arrays([ids, *part.values()], [id_col, *part])

    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, schema)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest run (ties: smallest start, then period) and digests of the runs and of the collapsed text."""
    best = F.expr("reduce(runs, cast(null as struct<start:long,length:long,period:long>), (b, r) -> if(b is null or r.length > b.length, r, b))")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
