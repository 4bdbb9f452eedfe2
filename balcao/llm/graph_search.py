"""Approximate nearest neighbours over robust-pruned directed graphs.

Equal vectors become one point with its lowest ids. Points are dealt by hash into shards of bounded size. In a shard, points join a
graph in growing batches: a greedy search over the graph so far proposes neighbours, and relaxed distance pruning keeps
diverse edges, a candidate going when a kept neighbour is ``alpha`` times nearer to it than the point itself. Edges are
made both ways and pruned again. The finished graphs are a written table. Queries walk every shard's graph by
beam search, in blocks; the nearest of all shards are merged and scored anew in double precision.

Searches run for many points at a time in numpy; Spark deals out shards and query blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.functions.lineage import write_intermediate

#: Points of a shard on average, and queries of a block: both bound a task's memory.
SHARD_POINTS = 4096
BLOCK_QUERIES = 1024
DEGREE = 32
BUILD_BEAM = 48
ALPHA = 1.2
BATCH = 512


def distances(points: np.ndarray, squares: np.ndarray, at: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of ``queries`` (b, d) to the points ``at`` (b, k), less the query's own square."""
    return squares[at] - 2 * np.einsum("bkd,bd->bk", points[at], queries)


def beam_search(points: np.ndarray, squares: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int, width: int = 4):
    """Greedy search for many queries at a time: the ``beam`` nearest points met and their distances, nearest first.

    In each round the ``width`` nearest points of a beam that were not yet left are left along their edges. A search ends when
    every point of its beam was left. ``edges`` has the point itself where a neighbour is missing.
    """
    b, n = len(queries), len(points)
    rows = np.arange(b)[:, None]
    seen = np.zeros((b, n), bool)
    ids = np.full((b, beam), start)
    far = np.full((b, beam), np.inf, np.float32)
    far[:, 0] = distances(points, squares, ids[:, :1], queries)[:, 0]
    left = np.isinf(far)
    seen[:, start] = True
    active = np.arange(b)
    while len(active):
        waiting = np.where(left[active], np.inf, far[active])
        pick = np.argsort(waiting, axis=1)[:, :width]
        real = ~np.isinf(np.take_along_axis(waiting, pick, 1))
        some = real.any(1)
        active, pick, real = active[some], pick[some], real[some]
        if not len(active):
            break
        own = active[:, None]
        at = np.where(real, ids[own, pick], ids[own, pick[:, :1]])
        left[own, pick] = True
        near = edges[at].reshape(len(active), -1)
        near.sort(axis=1)
        new = ~seen[own, near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[own, near] = True
        d = np.where(new, distances(points, squares, near, queries[active]), np.inf).astype(np.float32)
        all_d = np.concatenate((far[active], d), 1)
        keep = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        order = np.take_along_axis(all_d, keep, 1).argsort(axis=1, kind="stable")
        keep = np.take_along_axis(keep, order, 1)
        far[active] = np.take_along_axis(all_d, keep, 1)
        ids[active] = np.take_along_axis(np.concatenate((ids[active], near), 1), keep, 1)
        old = np.concatenate((left[active], np.zeros(near.shape, bool)), 1)
        left[active] = np.take_along_axis(old, keep, 1) | np.isinf(far[active])
    return ids, far + (queries * queries).sum(1)[rows.ravel()][:, None]


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, far: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each point ``own`` among ``candidates`` (sorted by ``far``; infinite: none)."""
    b, k = candidates.shape
    vectors = points[candidates]
    squares = (vectors * vectors).sum(2)
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    open_ = np.isfinite(far) & (candidates != own[:, None])
    out = np.repeat(own[:, None], degree, 1)
    rows = np.arange(b)
    for slot in range(degree):
        some = open_.any(1)
        if not some.any():
            break
        first = open_.argmax(1)
        out[some, slot] = candidates[rows, first][some]
        open_[rows, first] = False
        open_ &= ~((alpha * alpha * between[rows, first] <= far) & some[:, None])
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 1) -> tuple[np.ndarray, int]:
    """Edges (n, degree) and the start, the point nearest to the mean."""
    n = len(points)
    squares = (points * points).sum(1)
    start = int((squares - 2 * points @ points.mean(0)).argmin())
    edges = np.repeat(np.arange(n)[:, None], degree, 1)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([start], order[order != start]))
    at = 1
    while at < n:
        size = min(max(1, at // 2), BATCH, n - at)
        own = order[at : at + size]
        ids, far = beam_search(points, squares, edges, start, points[own], min(beam, at + 1))
        chosen = robust_prune(points, own, ids, far, degree, alpha)
        edges[own] = chosen
        _add_back(points, squares, edges, own, chosen, degree, alpha)
        at += size
    return edges, start


def _add_back(points, squares, edges, own, chosen, degree, alpha) -> None:
    """Edges from the chosen neighbours back to ``own``; points with too many are pruned again."""
    source, target = np.repeat(own, degree), chosen.ravel()
    real = source != target
    source, target = source[real], target[real]
    by = np.argsort(target, kind="stable")
    source, target = source[by], target[by]
    to, first, count = np.unique(target, return_index=True, return_counts=True)
    for some in np.array_split(np.arange(len(to)), max(1, len(to) // BATCH)):
        if not len(some):
            continue
        width = int(count[some].max())
        slot = np.arange(width)[None, :]
        back = np.where(slot < count[some][:, None], source[np.minimum(first[some][:, None] + slot, len(source) - 1)], to[some][:, None])
        both = np.concatenate((edges[to[some]], back), 1)
        both.sort(axis=1)
        again = np.zeros(both.shape, bool)
        again[:, 1:] = both[:, 1:] == both[:, :-1]
        far = distances(points, squares, both, points[to[some]]) + squares[to[some]][:, None]
        far[again | (both == to[some][:, None])] = np.inf
        order = far.argsort(axis=1, kind="stable")
        both, far = np.take_along_axis(both, order, 1), np.take_along_axis(far, order, 1)
        few = np.isfinite(far).sum(1) <= degree
        fit = np.where(np.isfinite(far), both, to[some][:, None])[:, :degree]
        if fit.shape[1] < degree:
            fit = np.concatenate((fit, np.repeat(to[some][:, None], degree - fit.shape[1], 1)), 1)
        edges[to[some][few]] = fit[few]
        if not few.all():
            many = ~few
            edges[to[some][many]] = robust_prune(points, to[some][many], both[many], far[many], degree, alpha)


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def distinct_points(vectors: DataFrame, id_col: str, vector_col: str, copies: int) -> DataFrame:
    """(vector, ids): each distinct usable vector with its ``copies`` lowest ids, which is all that a search can return."""
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where(usable(F.col("vector")))
    lowest = Window.partitionBy("vector").orderBy("id")
    rows = rows.withColumn("rank", F.row_number().over(lowest)).where(F.col("rank") <= copies)
    return rows.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def index(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", shard_points: int = SHARD_POINTS) -> DataFrame:
    """The written graphs: (shard, at, ids, vector, edges, start), a row for each distinct vector.

    Vectors of different lengths lie in different shards. Every usable vector is in a graph.
    """
    points = write_intermediate(distinct_points(vectors, id_col, vector_col, k + 1), "graph-points")
    sizes = {r["d"]: r["n"] for r in points.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect()}
    shards = F.create_map(*[F.lit(x) for d, n in sorted(sizes.items()) for x in (d, -(-n // shard_points))]) if sizes else F.create_map(F.lit(0), F.lit(1))
    d = F.size("vector")
    dealt = points.withColumn("shard", F.concat_ws("-", d, F.pmod(F.xxhash64("vector"), shards[d])))

    def graph(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ids", key=lambda s: s.str[0]).reset_index(drop=True)
        edges, start = build(np.stack(rows["vector"].to_numpy()).astype(np.float32))
        return rows.assign(at=np.arange(len(rows)), edges=list(edges.astype(np.int32)), start=start)

    kind = dict(points.dtypes)["vector"]
    built = dealt.groupBy("shard").applyInPandas(graph, f"vector {kind}, ids array<long>, shard string, at int, edges array<int>, start int")
    return write_intermediate(built, "graph-index")


def nearest_in(points: np.ndarray, exact: np.ndarray, edges: np.ndarray, start: int, q: np.ndarray, k: int, beam: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, distances) of the ``k`` nearest points found for each query, and of all found that tie with the last of them.

    A beam that ends within such a tie does not hold all of it: those queries are searched again with twice the beam.
    """
    squares = (points * points).sum(1)
    out: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, int), np.empty(0))] * len(q)
    open_ = np.arange(len(q))
    while len(open_):
        width = min(beam, len(points))
        met, far = beam_search(points, squares, edges, start, q[open_].astype(np.float32), width)
        true = np.sqrt(((exact[met] - q[open_][:, None, :]) ** 2).sum(2))
        true[~np.isfinite(far)] = np.inf
        order = true.argsort(axis=1, kind="stable")
        true, met = np.take_along_axis(true, order, 1), np.take_along_axis(met, order, 1)
        last = true[:, min(k, width) - 1]
        ties = np.isfinite(last) & (true[:, -1] <= last) & (width < len(points))
        for i in np.flatnonzero(~ties):
            some = np.isfinite(true[i]) & (true[i] <= last[i])
            out[open_[i]] = met[i, some], true[i, some]
        open_, beam = open_[ties], beam * 2
    return out


def search(graphs: DataFrame, queries: DataFrame, k: int = 10, beam: int = 160, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` nearest found for each query, other than the query's own row.

    Every query block meets every shard once; a task holds one shard and one block. Ties go to the lower id. Each vector of a
    repeated id is a query, and the other rows of that id are among its candidates.
    """
    wanted = queries.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).alias("vector"))
    wanted = wanted.where(usable(F.col("vector"))).dropDuplicates(["query_id", "vector"]).withColumn("own", F.xxhash64("query_id", "vector"))
    wanted = write_intermediate(wanted, "graph-queries")
    blocks = max(1, -(-wanted.count() // BLOCK_QUERIES))
    block = F.pmod("own", F.lit(blocks)).cast("int")
    shards = graphs.groupBy(F.size("vector").alias("d")).agg(F.collect_set("shard").alias("shards"))
    asked = wanted.withColumn("d", F.size("vector")).join(F.broadcast(shards), "d")
    asked = asked.select("query_id", "own", "vector", block.alias("block"), F.explode("shards").alias("shard"))
    offered = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def walk(key: tuple, sides: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        shape = {"query_id": "int64", "own": "int64", "ids": "object", "score": "float64"}
        rows = sides.sort_values("at")
        if not len(rows) or not len(ask):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in shape.items()})
        exact = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        points, ids = exact.astype(np.float32), rows["ids"].to_numpy()
        edges = np.stack(rows["edges"].to_numpy()).astype(np.int64)
        q = np.stack(ask["vector"].to_numpy()).astype(np.float64)
        at, far = [], []
        for some in np.array_split(np.arange(len(q)), max(1, len(q) // 256)):
            for places, distances_ in nearest_in(points, exact, edges, int(rows["start"].iloc[0]), q[some], k + 1, beam):
                at.append(places)
                far.append(distances_)
        n = [len(x) for x in at]
        return pd.DataFrame({
            "query_id": np.repeat(ask["query_id"].to_numpy(), n), "own": np.repeat(ask["own"].to_numpy(), n),
            "ids": list(ids[np.concatenate(at)]), "score": np.concatenate(far),
        })

    found = offered.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(walk, "query_id long, own long, ids array<long>, score double")
    each = found.select("query_id", "own", F.explode("ids").alias("id"), "score")
    # The query's own row is one of those with its id and its very vector.
    itself = Window.partitionBy("query_id", "own", "id").orderBy("score")
    each = each.withColumn("n", F.row_number().over(itself)).where((F.col("id") != F.col("query_id")) | (F.col("score") > 0) | (F.col("n") > 1))
    nearest = Window.partitionBy("query_id", "own").orderBy("score", "id")
    return each.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, beam: int = 160, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_points: int = SHARD_POINTS,
) -> DataFrame:
    """The ``k`` nearest vectors of each query by Euclidean distance; (query_id, rank from 1, id, score).

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, take no part, as queries
    or as candidates. Of ties the lowest ids are returned, however many tie. Only vectors of a query's length are its candidates. Equal vectors tie and the lower id comes first; rows
    that repeat an id and vector count as one candidate for each row. With fewer candidates than ``k`` all are returned.
    Other columns are not read; empty tables give an empty result.
    """
    return search(index(vectors, k, id_col, vector_col, shard_points), queries, k, beam, id_col, vector_col)
