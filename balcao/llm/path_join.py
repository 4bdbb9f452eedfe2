"""N-gram Jaccard join by chosen paths.

A document is the set of its word shingles; equal sets are one class, so copies cost nothing further. Each class is sketched by
``COORDINATES`` MinHash values, on which sets agree in a share equal to their Jaccard similarity. All classes start in one bucket.
A bucket above ``LEAF`` members is split on tokens sampled for it: two coordinates are chosen by the bucket's path, and members go to
the buckets of their values there. A pair of similarity s survives a split with 1 - (1 - s)**2, and a run of any depth with
the survival probability of that branching process; runs repeat until the target recall. Small buckets are brute-forced on the
sketches; what is still large at the greatest depth is brute-forced in blocks, so nothing is left out.

The proposals form clusters. Within a cluster every pair is verified on the whole shingle sets, in blocks of bounded size by
sparse products, and only counts and spanning links leave a block, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.functions.lineage import write_intermediate

WIDTH = 5
COORDINATES = 64
BRANCHES = 2
LEAF = 256
DEPTH = 6
#: A bucket that keeps this share of the bucket above it holds near copies, which no split parts: it is brute-forced in blocks.
DENSE = 0.5
#: Members of a part when a bucket is looked at in blocks of two parts.
PART = 512
#: Pairs agree on a share of the sketch that lies five standard errors below the threshold, or are not similar.
SLACK = 0.25
#: Members and shingles of a block when clusters are verified.
BLOCK_MEMBERS, BLOCK_SHINGLES = 128, 200_000
SEED = 20

_GOLD, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_RNG = np.random.default_rng(SEED)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_POWER = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, WIDTH + 16, dtype=np.uint64) | np.uint64(1)
_MULTIPLIER = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_WORD_BYTE = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * _GOLD
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text has one shingle of all its words, none has none.

    Words are runs of ASCII letters and digits and of other characters beyond ASCII, in lower case.
    """
    b = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    inside = _WORD_BYTE[b]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    last = np.zeros(len(b), np.int64)
    last[starts] = starts
    at = np.arange(len(b)) - np.maximum.accumulate(last)
    terms = np.where(inside, _BYTE[b] * _POWER[at & 63] + (at >> 6).astype(np.uint64), np.uint64(0))
    words = mix(np.add.reduceat(terms, starts) + (ends - starts).astype(np.uint64))
    n = max(1, len(words) - width + 1)
    k = min(width, len(words))
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out += words[i : i + n] * _PLACE[i]
    return np.unique(mix(out))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set, one for each coordinate."""
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        best = np.minimum(best, (shingles[at : at + 1024, None] * _MULTIPLIER).min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32)


def extinction(similarity: float, branches: int = BRANCHES) -> float:
    """Probability that a pair is lost in a run however deep: the fixed point of its branching process."""
    lost = 0.0
    for _ in range(10_000):
        lost = (1 - similarity + similarity * lost) ** branches
    return lost


def runs_for(recall: float, similarity: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(extinction(similarity))))


def children(paths: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Paths (n * BRANCHES) of the buckets that the members of buckets ``paths`` go to, and the rows they come from.

    The coordinates of a bucket are those of the lowest hashes with its path.
    """
    distinct, back = np.unique(paths, return_inverse=True)
    chosen = np.argsort(mix(distinct[:, None] + _MULTIPLIER * _PLACE[0]), axis=1, kind="stable")[:, :BRANCHES][back]
    values = np.take_along_axis(sketches, chosen, 1).astype(np.uint64)
    rows = np.repeat(np.arange(len(paths)), BRANCHES)
    return mix(paths[rows] * _GOLD + mix(values.ravel() * _ODD + chosen.ravel().astype(np.uint64))), rows


def _labels(linked: np.ndarray) -> np.ndarray:
    """Lowest index of each row's component in a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(1, initial=len(linked)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _sums(s: np.ndarray) -> tuple[int, int]:
    """Two independent sums over a set, which stand for it."""
    return tuple(int(x.view(np.int64)) for x in (s.sum(dtype=np.uint64), mix(s + _GOLD).sum(dtype=np.uint64)))


def _class_of(*columns: str) -> Column:
    return F.xxhash64(*columns)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc, s1, s2, n, sketch) of (doc, text); n is 0 for texts without words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc"], batch["text"], strict=True):
                s = shingle_set(text, width)
                rows.append((doc, *_sums(s), len(s), sketch(s).tobytes()) if len(s) else (doc, 0, 0, 0, b""))
            yield pd.DataFrame(rows, columns=["doc", "s1", "s2", "n", "sketch"])

    return docs.mapInPandas(run, "doc long, s1 long, s2 long, n long, sketch binary")


def _split(members: DataFrame, runs: int = 0) -> DataFrame:
    """(path, above, rep) one level down from (path, size, rep, sketch); ``above`` is the size of the bucket that was split.

    With ``runs``, (rep, sketch) go from the root to the buckets of every run.
    """

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sketches = np.frombuffer(b"".join(batch["sketch"]), np.uint32).reshape(len(batch), -1)
            rep = batch["rep"].to_numpy()
            if runs:
                starts = [np.full(len(batch), mix(np.array([r + 1], np.uint64))[0]) for r in range(runs)]
                above = np.full(len(batch), np.iinfo(np.int64).max)
            else:
                starts, above = [batch["path"].to_numpy().view(np.uint64)], batch["size"].to_numpy()
            for paths in starts:
                below, rows = children(paths, sketches)
                yield pd.DataFrame({"path": below.view(np.int64), "above": above[rows], "rep": rep[rows]})

    return members.mapInPandas(step, "path long, above long, rep long")


def _packed(number: str, digits: int = 16) -> Column:
    return F.unhex(F.lpad(F.hex(number), digits, "0"))


def _blocks(rows: DataFrame, group: str, packed: list[Column]) -> DataFrame:
    """(low, high, members): the members of every two parts of each group, packed one after the other.

    The column ``parts`` holds a group's number of parts; a member's part is a hash of it, so parts are of like size and
    a block is bounded. A member goes to one block for each part, and any two members meet in a block.
    """
    own = F.pmod(F.xxhash64(F.lit("part"), "rep"), F.col("parts")).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    return dealt.groupBy(group, "low", "high").agg(F.collect_list(F.concat(*packed)).alias("members")).select("low", "high", "members")


def _proposals(blocks: DataFrame, least: float) -> DataFrame:
    """(a, b) links that span the members of each bucket block whose sketches agree on a share of ``least``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for members in batch["members"]:
                raw = np.frombuffer(b"".join(members), np.uint8).reshape(len(members), -1)
                rep = raw[:, :8].copy().view(">i8")[:, 0].astype(np.int64)
                s = raw[:, 8:].copy().view(np.uint32)
                order = np.argsort(rep, kind="stable")
                rep, s = rep[order], s[order]
                label = _labels(np.stack([(s == row).mean(1) >= least for row in s]))
                some = label != np.arange(len(rep))
                a.append(rep[some])
                b.append(rep[label[some]])
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return blocks.mapInPandas(run, "a long, b long").where("a <> b").distinct()


def propose(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(a, b) links between classes (rep, sketch) that chosen paths bring together and whose sketches are alike."""
    level = write_intermediate(_split(classes, runs_for(recall, threshold)), "paths-1")
    found = None
    for depth in range(1, DEPTH + 1):
        who, whose = F.bit_xor(F.xxhash64("rep")).alias("who"), F.bit_xor(F.xxhash64(F.lit("whose"), "rep")).alias("whose")
        sizes = level.groupBy("path", "above").agg(F.count("*").alias("size"), who, whose)
        sizes = write_intermediate(sizes.where("size > 1"), "paths-sizes")
        split = (F.col("size") > LEAF) & (F.col("size") < F.col("above") * DENSE) & F.lit(depth < DEPTH)
        # Buckets of the same members, as copies make in every run, are looked at once.
        ripe = sizes.where(~split).groupBy("size", "who", "whose").agg(F.min("path").alias("path"))
        parts = F.when(F.col("size") <= LEAF, 1).otherwise(F.ceil(F.col("size") / PART)).alias("parts")
        met = level.join(ripe.select("path", parts), "path").join(classes, "rep")
        links = write_intermediate(_proposals(_blocks(met, "path", [_packed("rep"), F.col("sketch")]), threshold - SLACK), "paths-links")
        found = links if found is None else found.unionByName(links)
        large = sizes.where(split).select("path", "size")
        if depth == DEPTH or large.isEmpty():
            break
        below = level.join(large, "path").join(classes, "rep").select("path", "size", "rep", "sketch")
        level = write_intermediate(_split(below), "paths-next")
    return found.distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and two full hashes of all edges: equal for equal sets, whatever their order."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64(F.lit("again"), "v", "u"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the lowest node of each node's component, for the nodes of ``links`` (a, b); large and small stars in turn.

    A hub's links are reduced by partial minima. The minima are written before they are joined back, so that the join reads two plain
    tables: Spark broadcasts the minima while they are small and splits the hub's rows when they are not. Rounds grow with the logarithm
    of the longest chain.
    """
    edges = write_intermediate(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components-0")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = write_intermediate(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components-low")
        wide = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        wide = write_intermediate(wide.where("u <> v").distinct(), "components-wide")
        lowest = write_intermediate(wide.groupBy("u").agg(F.min("v").alias("m")), "components-low")
        near = wide.join(lowest, "u").select("u", "v", "m")
        small = near.select("u", F.col("m").alias("v")).unionByName(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = write_intermediate(small.where("u <> v").distinct(), "components")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def similar(sets: list[np.ndarray], side: np.ndarray, within: bool, threshold: float) -> np.ndarray:
    """Symmetric matrix of the pairs whose Jaccard similarity reaches the threshold: all pairs, or those across the sides."""
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count[token] > 1
    owner, token = owner[common], token[common]
    number = np.cumsum(count > 1) - 1
    token = number[token]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    shared = np.zeros((len(sets), len(sets)), np.float64)
    step = 8192
    cuts = np.searchsorted(token, np.arange(0, (token[-1] if len(token) else 0) + step + 1, step))
    for k in range(len(cuts) - 1):
        m = np.zeros((len(sets), step), np.float32)
        m[owner[cuts[k] : cuts[k + 1]], token[cuts[k] : cuts[k + 1]] - k * step] = 1
        shared += m @ m.T
    out = shared >= threshold * (n[:, None] + n[None, :] - shared) - 1e-9
    np.fill_diagonal(out, False)
    return out if within else out & (side[:, None] != side[None, :])


def _verify(blocks: DataFrame, threshold: float) -> DataFrame:
    """(rep, links, hub) of each member of each block: its exact links there and the lowest member they lead to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low, high, members in zip(batch["low"], batch["high"], batch["members"], strict=True):
                members = sorted(set(map(bytes, members)))
                rep = np.array([int.from_bytes(m[:8], "big", signed=True) for m in members], np.int64)
                side = np.array([int.from_bytes(m[8:12], "big") for m in members])
                linked = similar([np.frombuffer(m, np.uint64, offset=12) for m in members], side, low == high, threshold)
                yield pd.DataFrame({"rep": rep, "links": linked.sum(1).astype(np.int64), "hub": rep[_labels(linked)]})

    return blocks.mapInPandas(run, "rep long, links long, hub long")


def _exact(docs: DataFrame, clusters: DataFrame, width: int, threshold: float) -> DataFrame:
    """(rep, links, hub) over all blocks of all clusters (rep, root, first, n), from the texts of the classes' first documents."""
    sizes = clusters.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    wanted = clusters.join(sizes.where("members > 1").select("root", parts.alias("parts")), "root").select("rep", "root", "first", "parts")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                sets = [shingle_set(t, width) for t in part["text"]]
                sums = [_sums(s) for s in sets]
                yield part[["rep", "root", "parts"]].assign(
                    s1=[x[0] for x in sums], s2=[x[1] for x in sums], n=[len(s) for s in sets], shingles=[s.tobytes() for s in sets]
                )

    held = docs.join(wanted, docs["doc"] == wanted["first"]).select("rep", "root", "parts", "text")
    held = held.mapInPandas(run, "rep long, root long, parts long, s1 long, s2 long, n long, shingles binary")
    held = held.where(F.col("rep") == _class_of("s1", "s2", "n"))
    return _verify(_blocks(held, "root", [_packed("rep"), _packed("own", 8), F.col("shingles")]), threshold)


def join(
    docs: DataFrame, threshold: float = 0.8, width: int = WIDTH, recall: float = 0.99999, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, class_id, n_links) of every row: its group of near copies and its number of links.

    Two texts are linked when the Jaccard similarity of their distinct shingles reaches ``threshold``. ``class_id`` is the lowest id
    that can be reached over links and equal shingle sets; ``n_links`` counts the other distinct sets that are linked to the row's.
    A text without words (null, empty, signs only) has no shingles and is alone. Ids are integers; rows with a null id get null
    as class and no links. Rows that repeat an id are told apart by their texts. Other columns are not read. Empty tables
    give an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = rows.where("doc IS NOT NULL")
    sets = write_intermediate(_sets(known, width), "join-sets")
    classes = sets.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc").alias("first"), F.first("sketch").alias("sketch"))
    classes = write_intermediate(classes.withColumn("rep", _class_of("s1", "s2", "n")), "join-classes")
    links = propose(classes.select("rep", "sketch"), threshold, recall)
    clusters = components(links).join(classes.select(F.col("rep").alias("node"), "first", "n"), "node").withColumnRenamed("node", "rep")
    exact = write_intermediate(_exact(known, clusters, width, threshold), "join-exact")
    counts = exact.groupBy("rep").agg(F.sum("links").alias("n_links")).where("n_links > 0")
    groups = components(exact.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))).withColumnRenamed("node", "rep")
    groups = write_intermediate(groups.join(counts, "rep").join(classes.select("rep", "s1", "s2", "n", "first"), "rep"), "join-groups")
    lowest = groups.groupBy("root").agg(F.min("first").alias("class_id"))
    linked = groups.join(lowest, "root").select("s1", "s2", "n", "class_id", "n_links")
    found = classes.select("s1", "s2", "n", "first").join(linked, ["s1", "s2", "n"], "left")
    found = found.select(
        "s1", "s2", "n", F.coalesce("class_id", "first").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )
    none = F.lit(0).cast("long").alias("n_links")
    with_words = sets.where("n > 0").select("doc", "s1", "s2", "n").join(found, ["s1", "s2", "n"]).select("doc", "class_id", "n_links")
    without = sets.where("n = 0").select("doc", F.col("doc").alias("class_id"), none)
    unknown = rows.where("doc IS NULL").select("doc", F.col("doc").alias("class_id"), none)
    return with_words.unionByName(without).unionByName(unknown).withColumnRenamed("doc", id_col)


def first_of_groups(docs: DataFrame, threshold: float = 0.8, width: int = WIDTH) -> DataFrame:
    """One row of ``docs`` for each group of near copies, the one with the lowest ``doc_id`` and then the lowest text hash; null ids come last.

    Rows that share an id, or have none, are judged each on its own text. Rows of the same id and text are one; rows without id and words stay.
    """
    key = F.xxhash64("doc_id", "text").alias("__key")
    rows = docs.select("doc_id", "text", key, F.xxhash64("text").alias("__version"))
    classes = join(rows, threshold, width, id_col="__key").select("__key", "class_id").distinct()
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__version")).alias("least")
    first = rows.select("__key", "doc_id", "__version").distinct().join(classes, "__key").groupBy("class_id").agg(least)
    first = first.select(F.col("least.doc_id").alias("__id"), F.col("least.__version").alias("__first")).distinct()
    wordless = F.col("doc_id").isNull() & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[a-zA-Z0-9]|[^\x00-\x7F]")
    judged = docs.where(~wordless).withColumn("__version", F.xxhash64("text"))
    kept = judged.join(first, judged["doc_id"].eqNullSafe(first["__id"]) & (judged["__version"] == first["__first"]), "left_semi")
    same = Window.partitionBy("doc_id", "__version").orderBy("text")
    kept = kept.withColumn("__row", F.row_number().over(same)).where("__row = 1").drop("__row", "__version")
    return kept.unionByName(docs.where(wordless))


#: The same rows by an exact join of all shingles. Parameters: width, threshold.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{{80}}-\x{{10ffff}}]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(len(w) - {width} + 1, 1)), lambda i: array_to_string(w[i:i + {width} - 1], ' '))) AS s
  FROM w WHERE len(w) > 0
),
k AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS key FROM s GROUP BY doc_id),
c AS (SELECT key, min(doc_id) AS rep, any_value(n) AS n FROM k GROUP BY key),
r AS (SELECT s.doc_id, s.s FROM s JOIN c ON s.doc_id = c.rep),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM r a JOIN r b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN c ca ON ca.rep = a.doc_id JOIN c cb ON cb.rep = b.doc_id
  GROUP BY a.doc_id, b.doc_id, ca.n, cb.n HAVING count(*) >= {threshold} * (ca.n + cb.n - count(*)) - 1e-9
),
reach AS (SELECT rep AS a, rep AS b FROM c UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a),
g AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
l AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT w.doc_id, coalesce(g.class_id, w.doc_id) AS class_id, CAST(coalesce(l.n_links, 0) AS BIGINT) AS n_links
FROM w LEFT JOIN k USING (doc_id) LEFT JOIN c USING (key) LEFT JOIN g ON g.a = c.rep LEFT JOIN l ON l.a = c.rep
"""
