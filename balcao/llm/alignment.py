"""Which tokens of two tokenizers cover the same bytes: an Arrow pipeline in the tasks, its partial counts merged by Spark."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.functions.lineage import write_intermediate
from balcao.llm.merging import load
from balcao.llm.token_counts import PATTERN

#: Texts are worked on in slices of about so many characters; a longer text is cut between words into several slices.
SLICE_CHARS = 1_000_000
#: Links are listed in blocks of so many; a group with more is listed from several blocks.
BLOCK_LINKS = 4_000_000
#: Documents are looked up in bundles of about so many distinct links, closed with a document.
BUNDLE_LINKS = 400_000
#: Stretches that a worker remembers, and their ids; speed only, not results.
KNOWN_STRETCHES, KNOWN_IDS = 600_000, 8_000_000

#: Both tokenizers cut a text before a blank, tab or line feed that follows a character other than white space: no merge of the
#: first crosses into white space, and no piece of the second holds one of them after another character (``Pair`` checks this).
STRETCH = re.compile(r"\s*\S+(?:[^\S \n\t]\s*\S+)*(?:[^\S \n\t]\s*\Z)?|\s+")
BLANK = "▁"


class Pair:
    """The two tokenizers: ids of stretches of text, and the bytes of each id."""

    def __init__(self, first: str, second: str):
        from sentencepiece import SentencePieceProcessor

        self.b = SentencePieceProcessor(model_file=second)
        piece = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(c in p.lstrip(BLANK) for p in piece for c in (BLANK, "\n", "\t")):
            raise ValueError("pieces that go on after white space: the second vocabulary does not cut before blanks")
        self.encode_a, self.bytes_a = _byte_level(first)
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(piece)]
        self.size_b = len(piece)
        if len(self.bytes_a) * self.size_b >= 1 << 31:
            raise ValueError("a pair of ids must fit in 31 bits")
        self.length_a, self.length_b = (pa.array(list(map(len, x)), pa.int64()) for x in (self.bytes_a, self.bytes_b))
        self.blank = self.b.piece_to_id(BLANK)
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        #: Ids of the known stretches, and whether both tokenizers give the stretch back byte by byte.
        self.lists = [_lists([]), _lists([])]
        self.same = np.zeros(0, bool)

    def rows(self, words: list[str]) -> np.ndarray:
        """Rows of ``lists`` and ``same`` that hold each stretch; new ones are encoded."""
        found = list(map(self.row.get, words))
        if None in found:
            new = list(dict.fromkeys(w for w, r in zip(words, found, strict=True) if r is None))
            if len(self.row) + len(new) > KNOWN_STRETCHES or len(self.lists[0].values) > KNOWN_IDS:
                self._clear()
                new = list(dict.fromkeys(words))
            self._learn(new)
            found = list(map(self.row.__getitem__, words))
        return np.array(found, np.int64)

    def _learn(self, new: list[str]) -> None:
        a = self._first(new)
        b = self._second(new)
        raw = [w.encode() for w in new]
        same = [_joined(ids, table) == raw for ids, table in ((a, self.bytes_a), (b, self.bytes_b))]
        self.same = np.concatenate([self.same, np.logical_and(*same)])
        self.lists = [pa.concat_arrays(x) for x in zip(self.lists, (a, b), strict=True)]
        self.row.update(zip(new, range(len(self.row), len(self.row) + len(new)), strict=True))

    def _first(self, new: list[str]) -> pa.LargeListArray:
        """Side by side, stretches are encoded as they are alone, unless one ends in white space: a bar keeps those apart."""
        text = "".join([w + "|" if w[-1].isspace() or w[-1] in BLANK else w for w in new])
        bars = [w[-1].isspace() or w[-1] in BLANK for w in new]
        if any(bars):
            return _lists([self.encode_a(w) for w in new])
        ids = np.array(self.encode_a(text), np.int32)
        ends = np.cumsum([len(w.encode()) for w in new])
        reached = np.cumsum(np.asarray(self.length_a)[ids])
        return pa.LargeListArray.from_arrays(np.concatenate([[0], np.searchsorted(reached, ends) + 1]), ids)

    def _second(self, new: list[str]) -> pa.LargeListArray:
        """The tokenizer's own leading blank stands for the blank of the stretch."""
        found = self.b.encode([w[1:] if w[0] == " " else w for w in new], num_threads=1)
        return _lists([[self.blank] if w == " " else y if w[0] == " " else y[1:] for w, y in zip(new, found, strict=True)])


def _byte_level(path: str):
    """Encoder and token bytes of a byte-level vocabulary file.

    Where the ids follow the order of the merges, which is so for files made from ranks, the faster rank library reads the same
    vocabulary; it differs where a whole word is a token that its merges do not reach, so that is checked too.
    """
    merges = load(path)
    value = {c: i for i, c in enumerate(merges.alphabet)}
    entry = {i: bytes([value[c] for c in t]) for t, i in merges.vocab.items() if all(c in value for c in t) and t not in merges.special}
    size = max([*merges.vocab.values(), *merges.special.values()]) + 1
    table = [entry.get(i, b"") for i in range(size)] if not merges.special else [
        entry.get(i) or next((t.encode() for t, k in merges.special.items() if k == i), b"") for i in range(size)
    ]
    by_rank = sorted((rank, merged) for rank, merged in merges.pair.values())
    made = {merged for _, merged in by_rank}
    if [m for _, m in by_rank] == sorted(made) and len(made) + 256 == len(entry):
        import tiktoken

        ranks = {t: i for i, t in entry.items()}
        return tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, table
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return lambda text: own.encode(text, add_special_tokens=False).ids, table


@lru_cache(maxsize=2)
def tokenizers(first: str, second: str) -> Pair:
    return Pair(first, second)


def _mark(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


def _joined(ids: pa.LargeListArray, table: list[bytes]) -> np.ndarray:
    """The bytes of each list of ids, as an array of objects."""
    tokens = pa.array(table, pa.large_binary()).take(ids.values)
    return np.array(pc.binary_join(pa.LargeListArray.from_arrays(ids.offsets, tokens), pa.scalar(b"", pa.large_binary())).to_pylist(), object)


def _lists(rows: list[list[int]]) -> pa.LargeListArray:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    values = np.fromiter(chain.from_iterable(rows), np.int32, int(sizes.sum()))
    return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]), values)


def _segmented_ends(ids: pa.LargeListArray, length: pa.Array) -> pa.Table:
    """(doc, end, token, place) of every token: byte ends counted from the beginning of each document."""
    token, doc = ids.flatten(), pc.list_parent_indices(ids)
    size = length.take(token)
    running = pc.cumulative_sum(size)
    sizes = np.asarray(pc.list_value_length(ids))
    firsts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    total = np.concatenate([[0], np.asarray(running)])
    base = pa.array(total[firsts]).take(doc)
    return pa.table({"doc": doc, "end": pc.subtract(running, base), "token": token, "place": pa.array(np.arange(len(token)))})


def _group_numbers(n: int, cuts: pa.ChunkedArray) -> np.ndarray:
    """Number of the group of each of ``n`` tokens: how many cuts lie before it."""
    cut = np.zeros(n, np.int64)
    cut[np.asarray(cuts)] = 1
    return np.cumsum(cut) - cut


def _spelled(token: pa.Array, group: np.ndarray, n_groups: int) -> pa.Array:
    """Decimal ids of each group, joined by commas."""
    starts = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=n_groups))])
    return pc.binary_join(pa.LargeListArray.from_arrays(starts, token.cast(pa.large_string())), _mark(","))


def _blocks(products: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of tokens whose links fit a block; a token alone may exceed it."""
    bounds = np.cumsum(products) // BLOCK_LINKS
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bounds)) + 1, [len(products)]])
    yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def _links(doc: np.ndarray, a: np.ndarray, group: np.ndarray, b: np.ndarray, group_b: np.ndarray, n_groups: int, size_b: int) -> pa.Table:
    """(doc, pair, links) of the distinct pairs of each document, from all pairs of a group, listed block by block."""
    n_b = np.bincount(group_b, minlength=n_groups)
    first_b = np.concatenate([[0], np.cumsum(n_b)])
    parts = []
    for begin, end in _blocks(n_b[group]) if len(group) else ():
        g = group[begin:end]
        n = n_b[g]
        own = np.repeat(np.arange(begin, end), n)
        other = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first_b[g], n)
        pair = a[own].astype(np.int64) * size_b + b[other]
        part = pa.table({"doc": doc[own], "pair": pair.astype(np.int32)})
        parts.append(part.group_by(["doc", "pair"]).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "links"]))
    return _merged(parts)


def _merged(parts: list[pa.Table]) -> pa.Table:
    if not parts:
        return pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int32()), "links": pa.array([], pa.int64())})
    if len(parts) == 1:
        return parts[0]
    return pa.concat_tables(parts).group_by(["doc", "pair"]).aggregate([("links", "sum")]).rename_columns(["doc", "pair", "links"])


class Aligned:
    """Sums, groups and links of the documents of a slice; ``texts`` are (row, stretch list), in order, ``rows`` ascending."""

    def __init__(self, own: Pair, pieces: list[list[str]]):
        rows = own.rows(list(chain.from_iterable(pieces)))
        sizes = np.array([len(p) for p in pieces], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.a, self.b = (self._documents(x, pa.array(rows), offsets) for x in own.lists)
        #: Whether both tokenizers give the text back; no stretch comes back longer, so one that differs is never made up for.
        self.same = np.bincount(np.repeat(np.arange(len(pieces)), sizes), weights=~own.same[rows], minlength=len(pieces)) == 0
        self.own = own

    @staticmethod
    def _documents(lists: pa.LargeListArray, codes: pa.Array, offsets: np.ndarray) -> pa.LargeListArray:
        taken = lists.take(codes)
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(taken)))])
        return pa.LargeListArray.from_arrays(ends[offsets], taken.flatten())

    def table(self) -> tuple[dict[str, np.ndarray], list[str], pa.Table]:
        """Counts and spelled groups of each document, and (doc, pair, links) of its distinct links."""
        n = len(self.same)
        left, right = _segmented_ends(self.a, self.own.length_a), _segmented_ends(self.b, self.own.length_b)
        valid = pa.array(self.same)
        left, right = (t.filter(valid.take(t["doc"])) for t in (left, right))
        left, right = (t.set_column(3, "place", pa.array(np.arange(len(t)))) for t in (left, right))
        cuts = left.select(["doc", "end", "place"]).join(
            right.select(["doc", "end", "place"]).rename_columns(["doc", "end", "other"]), ["doc", "end"], join_type="inner", use_threads=False
        )
        group_a, group_b = _group_numbers(len(left), cuts["place"]), _group_numbers(len(right), cuts["other"])
        doc_a, doc_b = np.asarray(left["doc"]), np.asarray(right["doc"])
        n_groups = len(cuts)
        token_a, token_b = left["token"].combine_chunks(), right["token"].combine_chunks()
        links = _links(doc_a, np.asarray(token_a), group_a, np.asarray(token_b), group_b, n_groups, self.own.size_b)
        spelled = pc.binary_join_element_wise(_spelled(token_a, group_a, n_groups), _spelled(token_b, group_b, n_groups), _mark("|"))
        group_doc = doc_a[np.concatenate([[0], np.cumsum(np.bincount(group_a, minlength=n_groups))])[:-1]] if n_groups else doc_a
        starts = np.searchsorted(group_doc, np.arange(n + 1))
        groups = pc.binary_join(pa.LargeListArray.from_arrays(starts, spelled), _mark(";")).to_pylist()
        count = lambda x: np.bincount(x, minlength=n)
        n_links = np.bincount(np.asarray(links["doc"]), weights=np.asarray(links["links"]), minlength=n).astype(np.int64)
        return {"n_a": count(doc_a), "n_b": count(doc_b), "n_groups": np.diff(starts), "n_links": n_links}, groups, links


class Rows:
    """Results of documents, put together from the slices they were cut into."""

    def __init__(self, own: Pair):
        self.own = own
        self.open: dict | None = None

    def slice(self, pieces: list[tuple[int, list[str], bool]]) -> Iterator[dict]:
        """Finished rows; a piece is (row, stretches, whether it is the row's last)."""
        counts, groups, links = (aligned := Aligned(self.own, [p for _, p, _ in pieces])).table()
        order = pc.sort_indices(links, [("doc", "ascending"), ("pair", "ascending")])
        links = links.take(order)
        pair, weight = np.asarray(links["pair"]), np.asarray(links["links"])
        starts = np.searchsorted(np.asarray(links["doc"]), np.arange(len(pieces) + 1))
        for k, (row, _, last) in enumerate(pieces):
            part = slice(starts[k], starts[k + 1])
            now = {c: int(v[k]) for c, v in counts.items()}
            own = self.open
            if own is None:
                own = {"row": row, "same": True, "n": dict.fromkeys(counts, 0), "sha": hashlib.sha256(), "links": []}
            own["same"] &= bool(aligned.same[k])
            own["sha"].update((";" if own["n"]["n_groups"] and now["n_groups"] else "").encode() + groups[k].encode())
            own["n"] = {c: v + now[c] for c, v in own["n"].items()}
            own["links"].append((pair[part], weight[part]))
            if len(own["links"]) > 8:
                own["links"] = [_summed(own["links"])]
            self.open = own
            if last:
                self.open = None
                yield own | {"links": own["links"][0] if len(own["links"]) == 1 else _summed(own["links"])}


def _summed(links: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pair, weight = (np.concatenate(x) for x in zip(*links, strict=True))
    pair, back = np.unique(pair, return_inverse=True)
    return pair, np.bincount(back, weights=weight, minlength=len(pair)).astype(np.int64)


def _pieces(texts: list[str | None]) -> Iterator[list[tuple[int, list[str], bool]]]:
    """Slices of (row, stretches, last): the blank and the text, cut between stretches where a text is long."""
    batch, chars = [], 0
    for row, text in enumerate(texts):
        words = STRETCH.findall(" " + text) if text else []
        if len(text or "") <= SLICE_CHARS:
            batch.append((row, words, True))
            chars += len(text or "")
        else:
            begin = size = 0
            for k, w in enumerate(words):
                size += len(w)
                if size >= SLICE_CHARS and k + 1 < len(words):
                    yield [*batch, (row, words[begin : k + 1], False)]
                    batch, begin, size = [], k + 1, 0
            batch.append((row, words[begin:], True))
            chars += size
        if chars >= SLICE_CHARS:
            yield batch
            batch, chars = [], 0
    if batch:
        yield batch


ROW = "bundle long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, links array<long>"
#: Rows with ``pair`` are a bundle's partial counts, those without are documents.
FOUND = ROW + ", pair array<int>, documents array<long>"


class Bundle:
    """Documents that are looked up together, and how many of them link each pair."""

    def __init__(self, first: int):
        self.number, self.pairs, self.size = first, [], 0

    def add(self, pairs: np.ndarray) -> None:
        self.pairs.append(pairs)
        self.size += len(pairs)

    def close(self) -> tuple[int, list, list] | None:
        """(number, pairs, documents) by ``Table.group_by``, and a new bundle begins."""
        if not self.pairs:
            return None
        table = pa.table({"pair": np.concatenate(self.pairs)}).group_by("pair").aggregate([([], "count_all")])
        out = self.number, table["pair"].combine_chunks(), table["count_all"].combine_chunks()
        self.number, self.pairs, self.size = self.number + 1, [], 0
        return out


def _found(docs: DataFrame, first: str, second: str, id_col: str) -> DataFrame:
    """Rows of documents and of bundles, written: bundles are numbered within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(first, second)
        bundle, rows = Bundle(TaskContext.get().partitionId() << 32), Rows(own)
        int_lists, long_lists = pa.list_(pa.int32()), pa.list_(pa.int64())

        def partial(kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            if closed := bundle.close():
                number, pair, documents = closed
                empty = [pa.nulls(1, t) for t in (*[pa.int64()] * 4, pa.string(), int_lists, long_lists)]
                lists = [pa.ListArray.from_arrays(np.array([0, len(x)], np.int32), x) for x in (pair, documents)]
                yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.array([number]), *empty, *lists], names)

        names = [id_col, "bundle", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links", "pair", "documents"]
        kind = None
        for batch in batches:
            ids = batch.column(0)
            kind = ids.type
            for pieces in _pieces(batch.column(1).to_pylist()):
                for group in _bundled(rows.slice(pieces), bundle):
                    places = pa.array([r["row"] for r in group], pa.int64())
                    ok = [r["same"] for r in group]
                    counts = [pa.array([r["n"][c] if s else 0 for r, s in zip(group, ok, strict=True)], pa.int64()) for c in names[2:6]]
                    sha = pa.array([r["sha"].hexdigest() if s and r["n"]["n_a"] else "" for r, s in zip(group, ok, strict=True)])
                    kept = [r["links"] if s else (r["links"][0][:0], r["links"][1][:0]) for r, s in zip(group, ok, strict=True)]
                    offsets = np.concatenate([[0], np.cumsum([len(p) for p, _ in kept])]).astype(np.int32)
                    lists = [
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[k] for x in kept]).astype(t)))
                        for k, t in ((0, np.int32), (1, np.int64))
                    ]
                    blank = [pa.nulls(len(group), t) for t in (int_lists, long_lists)]
                    number = pa.array(np.full(len(group), bundle.number))
                    yield pa.RecordBatch.from_arrays([ids.take(places), number, *counts, sha, *lists, *blank], names)
                    for pairs, _ in kept:
                        bundle.add(pairs)
                    if bundle.size >= BUNDLE_LINKS:
                        yield from partial(kind)
        if kind is not None:
            yield from partial(kind)

    kind = dict(docs.dtypes)[id_col]
    return write_intermediate(docs.mapInArrow(run, f"`{id_col}` {kind}, {FOUND}"), "aligned")


def _bundled(rows: Iterator[dict], bundle: Bundle) -> Iterator[list[dict]]:
    """Finished rows in groups that fit the open bundle."""
    group, size = [], bundle.size
    for r in rows:
        group.append(r)
        size += len(r["links"][0])
        if size >= BUNDLE_LINKS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _tables(docs: DataFrame, first: str, second: str, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of documents, the pairs that each bundle wants, and corpus-wide pairs."""
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = _found(texts, first, second, id_col)
    partial = found.where(F.col("n_a").isNull()).select("bundle", F.explode(F.arrays_zip("pair", "documents")).alias("x"))
    partial = partial.select("bundle", "x.pair", "x.documents")
    counts = write_intermediate(partial.groupBy("pair").agg(F.sum("documents").alias("n")), "pair-counts")
    size_b = tokenizers(first, second).size_b
    counts = counts.select(F.floor(F.col("pair") / size_b).cast("int").alias("a"), (F.col("pair") % size_b).alias("b"), "pair", "n")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    # The hinted side has a row for each id of the first vocabulary at most.
    pairs = counts.join(F.broadcast(highest), "a").select("a", "b", "pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    rows = found.where(F.col("n_a").isNotNull()).drop("pair", "documents")
    return rows, partial.select(F.col("bundle").alias("wanted_by"), "pair"), pairs


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents and corpus-wide pairs of two tokenizers' tokens.

    The first table has, for every row of ``docs``: id, bundle, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct linked
    ``pairs`` (id of the first times the size of the second vocabulary, plus id of the second) with their ``links``. The second
    has (a, b, pair, n, best): in how many documents a pair is linked, and whether no pair of the same a is linked in more.

    ``first`` is a file of the tokenizers library and reads a blank before the text, ``second`` is a sentencepiece model, which adds
    one. Offsets at which tokens of both end cut the text into groups; all tokens of a group are linked with each other.
    """
    rows, _, pairs = _tables(docs, first, second, id_col, text_col)
    return rows, pairs


def aligned(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    ``n_best`` counts the links whose pair is in the most documents among the pairs of its first id (ties included), ``count_sum`` adds
    up the documents of every link's pair. Null and empty texts, and texts that either vocabulary does not give back
    byte by byte, have no tokens: zeros and no digest. Every row counts as a document, repeated rows and ids too; null ids
    are kept. Other columns are not read; an empty table gives an empty result.

    Bundles of documents fetch the counts of their own distinct pairs, so a pair that every document links crosses the network
    once for each bundle. Long texts are worked on in slices; a task holds a bundle at a time.
    """
    rows, wanted, pairs = _tables(docs, first, second, id_col, text_col)
    return _look_up(rows, wanted.join(pairs, "pair").select("wanted_by", "pair", "n", "best"), id_col)


def _look_up(rows: DataFrame, counts: DataFrame, id_col: str) -> DataFrame:
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(right["pair"]))
        pair, n, best = (np.asarray(right[c])[order] for c in ("pair", "n", "best"))
        lists, links = (left[c].combine_chunks() for c in ("pairs", "links"))
        row = np.asarray(pc.list_parent_indices(lists))
        at = np.searchsorted(pair, np.asarray(lists.flatten()))
        links = np.asarray(links.flatten())
        sums = {}
        for c, x in (("n_best", best[at] * links), ("count_sum", n[at] * links)):
            total = np.zeros(len(left), np.int64)
            np.add.at(total, row, x)
            sums[c] = total
        out = {id_col: left[id_col], **{c: left[c] if c in left.column_names else pa.array(sums[c]) for c in names}}
        return pa.table({**out, "groups_sha256": left["groups_sha256"]})

    kind = dict(rows.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in names) + ", groups_sha256 string"
    return rows.groupBy("bundle").cogroup(counts.groupBy("wanted_by")).applyInArrow(run, schema)
