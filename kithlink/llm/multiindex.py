"""Nearest neighbours by largest inner product with an inverted multi-index.

The two halves of the vectors are quantised separately, each with centroids learned by k-means from a sample of at
most ``SAMPLE`` different vectors (the first by a hash of their ids). The number of centroids grows with the square
root of the number of vectors, ``PER_ROOT`` times it, up to ``MOST_CENTROIDS``. Every vector is an entry of the cell
of its two nearest centroids. A query ranks cells by summed distance, the distance of a half to a centroid being
their inner product with its sign turned, so that it is the ranking's own measure whatever the vectors' lengths. A
heap that holds the next run of cells of each first centroid gives the cells in this order; cells without entries are
passed over. It stops at the cell with which ``SHARE`` of all different vectors are seen, at every size of table (and
one vector more than neighbours are asked for, so that so many can be found where there are so many).
The entries of the cells seen are reranked by their exact inner product with the query, in double precision.

First centroids are dealt into ``GROUPS`` groups, and a query goes only to those that it saw a cell of. A group's
entries and its queries are both dealt into blocks of bounded size by a hash, and each pair of blocks is one matrix
product, so no group of entries (such as a vector that many rows repeat) and no number of queries makes a large
task. Of each pair of blocks a query takes its best entries along; ties to the smaller id. What the driver gathers
and broadcasts is the codebooks and one count a cell, both bounded by ``MOST_CENTROIDS``.

Vectors that are null, zero or hold null or non-finite components take no part, neither as queries nor as
candidates; nor do rows without an id. Vectors of different lengths have no inner product: each length is searched
by itself. Of rows with the same id and the same vector one takes part; with different vectors each does, its
queries' neighbours are ranked together, and none is a neighbour of its own id. Fewer candidates than asked for give
fewer rows; an empty table gives an empty result. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions

NEIGHBOURS = 20
PER_ROOT = 8
MOST_CENTROIDS = 512
SAMPLE = 16384
#: The cells that are reranked for a query hold this share of the different vectors. With 64-dimensional vectors that
#: form no tight clusters, fewer come near a recall of 0.9 (the README has the curve).
SHARE = 0.25
ENTRY_BLOCK = 8192
QUERY_BLOCK = 4096
#: Groups of first centroids that are searched together.
GROUPS = 16
#: Cells of one first centroid that are taken from the heap at a time.
RUN = 32
#: Cells as far as the last one seen count as seen, whatever the order in which a product was summed.
SLACK = 1e-9


@dataclass
class Codebooks:
    first: np.ndarray
    second: np.ndarray

    @property
    def cut(self) -> int:
        return self.first.shape[1]

    @property
    def width(self) -> int:
        return self.cut + self.second.shape[1]

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of either half."""
        return tuple(
            ((c * c).sum(1)[None, :] - 2 * h @ c.T).argmin(1).astype(np.int32)
            for h, c in ((vectors[:, : self.cut], self.first), (vectors[:, self.cut :], self.second)))

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of both halves to their centroids: the inner product, its sign turned."""
        return -(vectors[:, : self.cut] @ self.first.T), -(vectors[:, self.cut :] @ self.second.T)


def centroids_for(n: int) -> int:
    """The number of centroids of either half for n vectors, a power of two."""
    return min(MOST_CENTROIDS, 1 << max(0, int(np.ceil(np.log2(PER_ROOT * np.sqrt(max(n, 1)))))))


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """At most k centroids."""
    points = np.unique(points, axis=0)
    k = min(k, len(points))
    random = np.random.default_rng(seed)
    centroids = points[random.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = ((centroids * centroids).sum(1)[None, :] - 2 * points @ centroids.T).argmin(1)
        count = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        full = count > 0
        starts = (np.cumsum(count) - count)[full]
        centroids[full] = np.add.reduceat(points[order], starts, axis=0) / count[full, None]
        if not full.all():
            centroids[~full] = points[random.choice(len(points), int((~full).sum()))]
    return centroids


def reach(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: float, run: int = RUN) -> tuple[float, np.ndarray]:
    """The summed distance of the cell with which the nearest cells hold ``enough`` entries, and the first centroids of the cells up to there.

    ``first`` and ``second`` are one query's distances, ``counts`` the entries of each cell. The cells of a first centroid that have entries are
    taken in the order of distance, ``run`` at a time; the heap holds the first of each centroid's next run. Once what was taken holds enough, the
    sorted sums tell where; further runs are taken until the heap's least is beyond that.
    """
    by_second = np.argsort(second, kind="stable")
    line, place = np.nonzero((counts > 0)[:, by_second])
    if not len(line):
        return -np.inf, line
    place = by_second[place]
    sums, held = first[line] + second[place], counts[line, place]
    edges = np.searchsorted(line, np.arange(len(first) + 1)).tolist()
    total = np.concatenate(([0.0], np.cumsum(held)))
    heap = [(sums[s], s, e) for s, e in zip(edges, edges[1:], strict=False) if s < e]
    heapq.heapify(heap)
    taken: list[np.ndarray] = []

    def far() -> float:
        """The sum with which the cells taken hold enough, or the largest of all."""
        own = np.concatenate(taken)
        own = own[np.argsort(sums[own], kind="stable")]
        at = int(np.searchsorted(np.cumsum(held[own]), enough))
        return float(sums[own[at]]) if at < len(own) else float(sums.max())

    seen, limit = 0.0, np.inf
    while heap and heap[0][0] <= limit:
        _, at, end = heap[0]
        upto = min(at + run, end)
        taken.append(np.arange(at, upto))
        seen += total[upto] - total[at]
        if upto < end:
            heapq.heapreplace(heap, (sums[upto], upto, end))
        else:
            heapq.heappop(heap)
        if seen >= enough and limit == np.inf:
            limit = far()  # no cell beyond it is needed
    last = far()
    return last, np.flatnonzero(np.bincount(line[sums <= last + SLACK], minlength=len(first)))


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components, and one that isn't zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def _assigned(batches, books):
    books = books.value
    for batch in batches:
        if batch.num_rows:
            cells = books.cells(_matrix(batch.column(1), books.width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells[0]), pa.array(cells[1])], names=["vec_id", "vector", "c1", "c2"])


def _probes(batches, books, counts, enough, group_of):
    """A row for each query and each group that it saw a cell of, with the distance of the last cell."""
    books, counts = books.value, counts.value
    for batch in batches:
        if not batch.num_rows:
            continue
        d1, d2 = books.distances(_matrix(batch.column(1), books.width))
        at, group, last = [], [], []
        for q in range(batch.num_rows):
            far, lines = reach(d1[q], d2[q], counts, enough)
            for g in np.unique(group_of[lines]).tolist():
                at.append(q)
                group.append(g)
                last.append(far)
        taken = batch.take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(group, pa.int32()), pa.array(last, pa.float64())], names=["query_id", "vector", "grp", "far"])


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions in a row that reach its k-th best score, all ties (up to rounding) included."""
    if len(scores) <= k:
        return np.flatnonzero(scores > -np.inf)
    kth = np.partition(scores, len(scores) - k)[len(scores) - k]
    return np.flatnonzero((scores >= kth - 1e-9 * (1 + abs(kth))) & (scores > -np.inf))


def _searched(entries: pd.DataFrame, queries: pd.DataFrame, books, k) -> pd.DataFrame:
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(entries) and len(queries):
        books = books.value
        e = np.stack(entries["vector"].to_numpy()).astype(np.float64)
        ids, c1, c2 = (entries[c].to_numpy() for c in ("vec_id", "c1", "c2"))
        qids, far = queries["query_id"].to_numpy(), queries["far"].to_numpy()
        vectors = np.stack(queries["vector"].to_numpy()).astype(np.float64)
        for s in range(0, len(vectors), 128):
            block = vectors[s : s + 128]
            d1, d2 = books.distances(block)
            product = block @ e.T
            product[d1[:, c1] + d2[:, c2] > far[s : s + 128, None] + SLACK] = -np.inf
            product[ids[None, :] == qids[s : s + 128, None]] = -np.inf
            for i, row in enumerate(product, s):
                near = best_of(row, k)
                if len(near):
                    # each product summed in the same order, so that equal vectors score equally
                    exact = (e[near] * vectors[i]).sum(axis=1)
                    own = ids[near]
                    order = np.lexsort((own, -exact))[:k]
                    out["query_id"].append(np.full(len(order), qids[i]))
                    out["vec_id"].append(own[order])
                    out["score"].append(exact[order])
    kinds = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}
    return pd.DataFrame({c: np.concatenate(x) if x else np.zeros(0, kinds[c]) for c, x in out.items()})


def _found(vectors: DataFrame, queries: DataFrame, width: int, k: int, share: float, centroids: int | None) -> DataFrame:
    """query_id, vec_id and score of what blocks find among vectors of one length."""
    spark = vectors.sparkSession
    first_rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()  # at most SAMPLE rows
    sample = np.array([r["vector"] for r in first_rows])
    n = centroids or centroids_for(vectors.count() if len(sample) == SAMPLE else len(sample))
    cut = max(1, width // 2)
    books = Codebooks(k_means(sample[:, :cut], n), k_means(sample[:, cut:], n) if width > cut else np.zeros((1, 0)))
    shared = spark.sparkContext.broadcast(books)
    entries = materialise(vectors.mapInArrow(partial(_assigned, books=shared), "vec_id long, vector array<double>, c1 int, c2 int"), "entries")
    counts, sizes = np.zeros((len(books.first), len(books.second))), np.zeros(len(books.first))
    cells = entries.groupBy("c1", "c2", F.xxhash64("vector").alias("h")).count().groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("different"), F.sum("count").alias("rows"))
    for r in cells.toLocalIterator():  # one row a cell that has entries
        counts[r["c1"], r["c2"]] = r["different"]
        sizes[r["c1"]] += r["rows"]
    n_groups = min(GROUPS, len(books.first))
    group_of = np.arange(len(books.first)) * n_groups // len(books.first)
    parts = np.maximum(1, np.ceil(np.bincount(group_of, sizes, n_groups) / ENTRY_BLOCK)).astype(int).tolist()

    probes = queries.mapInArrow(
        partial(_probes, books=shared, counts=spark.sparkContext.broadcast(counts), enough=max(share * counts.sum(), k + 1), group_of=group_of),
        "query_id long, vector array<double>, grp int, far double")
    # entries meet each block of queries, and queries each block of the entries of their groups
    query_parts = max(1, -(-queries.count() // QUERY_BLOCK))
    parts_of = F.get(F.lit(parts), F.col("grp"))
    left = entries.withColumn("grp", F.get(F.lit(group_of.tolist()), F.col("c1")).cast("int"))
    left = left.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts_of).cast("int")).withColumn("qpart", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))
    right = probes.withColumn("qpart", F.pmod(F.xxhash64("query_id"), F.lit(query_parts)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), parts_of - 1)))
    keys = ["grp", "part", "qpart"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(partial(_searched, books=shared, k=k), "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, share: float = SHARE, centroids: int | None = None) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest ``vectors`` found for each of ``queries`` (both vec_id, embedding)."""
    spark = vectors.sparkSession
    # repeated rows go before anything is cut to k
    clean = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & usable(F.col("vector"))).dropDuplicates(["vec_id", "vector"])
    entries = materialise(clean(vectors), "vectors")
    asked = clean(queries).repartition(shuffle_partitions(spark), "vec_id")  # a query's walk takes longer than its bytes tell
    widths = sorted(r[0] for r in entries.select(F.size("vector")).distinct().collect())
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    of = lambda df, w: df.where(F.size("vector") == w)
    found = reduce(DataFrame.unionByName, [_found(of(entries, w), of(asked, w), w, k, share, centroids) for w in widths])
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
