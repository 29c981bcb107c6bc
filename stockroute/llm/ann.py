"""Approximate nearest neighbours by balanced posting lists.

Centroids come from balanced splits of a bounded sample's distinct vectors and
are found through an in-memory graph of near centroids. A vector near a boundary
is written to several lists (distance ratio, with close centroids skipped); a
query visits the lists whose distance is within a ratio of its nearest one's,
however many they are; the ratio is fitted on the sample's own neighbours. Scores are exact cosines in double precision.

A list is dealt in chunks of rows and of queries, so a vector that a third of
all rows repeat fills many cells, never one task; a cell returns its best few for
each query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .near_dedup import stored

#: The fitting sample (rows of smallest seeded hash, and its most numbers), rows
#: aimed at in a list, and the most lists: sample and centroids pass the driver, so
#: they are bounded. Lists grow longer beyond LIST_ROWS * MAX_LISTS rows.
SAMPLE_ROWS, SAMPLE_VALUES, LIST_ROWS, MAX_LISTS = 65_536, 1 << 22, 256, 8192
#: Copies of a boundary vector, and their distance ratio to the nearest centroid.
COPIES, COPY_RATIO = 4, 1.15
#: The distance ratio of the lists that a query visits is the least, from
#: LEAST_RATIO on, that reaches this share of the NEIGHBOURS nearest of TRIALS sample
#: vectors; rows that a query meets at least.
REACHED, LEAST_RATIO, NEIGHBOURS, TRIALS, LEAST_ROWS = 0.97, 1.05, 5, 256, 512
#: The graph: links to near centroids and to random ones, least number of entry
#: points, and of centroids whose links are followed.
NEAR_LINKS, FAR_LINKS, ENTRIES, BEAM = 12, 4, 32, 16
#: Distances held at once by a search.
HELD = 1 << 21
#: Rows and queries of a list in one cell.
CELL_ROWS, CELL_QUERIES = 2048, 512


@dataclass
class Centroids:
    """Unit centroids, each with links to others, and the entry points of a search."""

    vectors: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    ratio: float = LEAST_RATIO

    @classmethod
    def of(cls, vectors: np.ndarray) -> "Centroids":
        """With links to the nearest others and a few seeded random ones."""
        n, rng = len(vectors), np.random.default_rng(0)
        near = min(NEAR_LINKS, n - 1)
        links = np.empty((n, near + FAR_LINKS), dtype=np.int64)
        for at in range(0, n, 1024):
            close = vectors[at:at + 1024] @ vectors.T
            close[np.arange(len(close)), np.arange(at, at + len(close))] = -np.inf
            links[at:at + 1024, :near] = np.argpartition(-close, max(near - 1, 0), axis=1)[:, :near]
        links[:, near:] = rng.integers(0, n, (n, FAR_LINKS))
        return cls(vectors, links, rng.permutation(n)[:max(ENTRIES, int(np.sqrt(n)))])

    def search(self, x: np.ndarray, ratio: float) -> np.ndarray:
        """Distances (rows x centroids) of the centroids met on the graph, infinite
        for the others. Links are followed from the ``BEAM`` nearest so far and from
        all within ``ratio`` of the nearest, until none of these is left."""
        n = len(self.vectors)
        dist = np.full((len(x), n), np.inf)
        dist[:, self.entries] = _distance(x @ self.vectors[self.entries].T)
        followed = np.zeros(dist.shape, dtype=bool)
        while True:
            limit = ratio * dist.min(axis=1)
            if n > BEAM:
                limit = np.maximum(limit, np.partition(dist, BEAM - 1, axis=1)[:, BEAM - 1])
            row, node = np.nonzero((dist <= limit[:, None]) & ~followed & (dist < np.inf))
            if not len(row):
                return dist
            followed[row, node] = True
            met = np.unique(np.repeat(row, self.links.shape[1]) * n + self.links[node].ravel())
            met = met[np.isinf(dist.flat[met])]
            for at in range(0, len(met), 1 << 15):
                i, j = np.divmod(met[at:at + (1 << 15)], n)
                dist[i, j] = _distance(np.einsum("ij,ij->i", x[i], self.vectors[j]))

    def blocks(self, rows: int) -> Iterator[slice]:
        """Slices of rows whose searches hold ``HELD`` distances at most."""
        step = max(1, HELD // len(self.vectors))
        return (slice(at, at + step) for at in range(0, rows, step))

    def nearest(self, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each unit row of ``x``, the ``most`` nearest centroids found (all, if
        they are fewer), nearest first, and their distances."""
        found = []
        for part in self.blocks(len(x)):
            dist = self.search(x[part], 1.0)
            order = np.argsort(dist, axis=1, kind="stable")[:, :most]
            found.append((order, np.take_along_axis(dist, order, axis=1)))
        return np.concatenate([o for o, _ in found]), np.concatenate([d for _, d in found])

    def visited(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs that queries visit: lists within ``ratio`` of the
        nearest one's distance, and further ones until ``LEAST_ROWS`` rows are met."""
        rows, lists = [], []
        for part in self.blocks(len(x)):
            dist = self.search(x[part], self.ratio)
            order = np.argsort(dist, axis=1, kind="stable")
            dist = np.take_along_axis(dist, order, axis=1)
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            i, j = np.nonzero((dist < np.inf) & ((dist <= self.ratio * dist[:, :1]) | (before < LEAST_ROWS)))
            rows.append(i + part.start)
            lists.append(order[i, j])
        return np.concatenate(rows), np.concatenate(lists)


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _distinct(sample: np.ndarray) -> np.ndarray:
    """Unit vectors of the sample, each direction once, in the sample's order."""
    x = _unit(sample)
    return x[np.sort(np.unique(np.round(x, 9), axis=0, return_index=True)[1])]


def fit_centroids(sample: np.ndarray, lists: int) -> Centroids:
    """Balanced splits of the distinct vectors: the largest cluster is halved at
    the median of its main direction until there are ``lists``."""
    x = _distinct(sample)
    clusters = [(-len(x), 0, np.arange(len(x)))]  # a heap; numbers keep equal sizes in order
    made = 1
    while len(clusters) < lists and clusters[0][0] < -1:
        mine = heapq.heappop(clusters)[2]
        part = x[mine]
        a, b = part[0], part[np.argmin(part @ part[0])]
        for _ in range(4):
            side = part @ (a - b)
            cut = np.argsort(side, kind="stable")
            low, high = cut[:len(cut) // 2], cut[len(cut) // 2:]
            a, b = part[high].mean(axis=0), part[low].mean(axis=0)
        for half in (mine[low], mine[high]):
            heapq.heappush(clusters, (-len(half), made, half))
            made += 1
    made_of = Centroids.of(_unit(np.array([x[c].mean(axis=0) for _, _, c in clusters])))
    made_of.ratio = fit_ratio(x, made_of)
    return made_of


def fit_ratio(x: np.ndarray, centroids: Centroids) -> float:
    """The distance ratio at which the lists of a vector's neighbours in the sample
    are visited. A table's neighbours are nearer than its sample's, so the sample errs
    to the safe side."""
    asked = np.linspace(0, len(x) - 1, min(TRIALS, len(x))).astype(int)
    close = x[asked] @ x.T
    close[np.arange(len(asked)), asked] = -np.inf
    near = np.argpartition(-close, min(NEIGHBOURS, len(x) - 1) - 1, axis=1)[:, :min(NEIGHBOURS, len(x) - 1)]
    if not near.size:
        return LEAST_RATIO
    dist = _distance(x[asked] @ centroids.vectors.T)
    least = np.maximum(dist.min(axis=1), 1e-12)
    needed = np.full(near.size, np.inf)
    for row, c in filed(x[near.ravel()], centroids):
        needed[row] = min(needed[row], dist[row // near.shape[1], c] / least[row // near.shape[1]])
    return max(LEAST_RATIO, float(np.quantile(needed, REACHED)))


def usable(vector: Column) -> Column:
    """Not null, not empty, not all zero, every component present and finite."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(values), -1)


def filed(x: np.ndarray, centroids: Centroids) -> Iterator[tuple[int, int]]:
    """(row, list) pairs that unit rows are written to."""
    return _copies(x, *centroids.nearest(x, 2 * COPIES), centroids)


def _copies(x: np.ndarray, lists: np.ndarray, dist: np.ndarray, centroids: Centroids) -> Iterator[tuple[int, int]]:
    """(row, list) pairs: the nearest list, and others within the ratio unless a
    chosen centroid is nearer to theirs than the vector is."""
    for i in range(len(x)):
        chosen: list[int] = []
        for c, d in zip(lists[i], dist[i]):
            if d > COPY_RATIO * dist[i, 0] or d == np.inf or len(chosen) == COPIES:
                break
            if all(_distance(centroids.vectors[c] @ centroids.vectors[o]) >= d for o in chosen):
                chosen.append(int(c))
                yield i, int(c)


def _best(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The ``k`` best rows of one cell for each of its queries."""
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if len(rows) and len(queries):
        v, q = _matrix(rows.column("v")), _matrix(queries.column("v"))
        ids, own = rows.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
        size, lead = np.sqrt((v * v).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        rough = q @ v.T / lead[:, None] / size
        rough[own[:, None] == ids] = -np.inf
        limit = np.partition(rough, len(ids) - min(k, len(ids)), axis=1)[:, len(ids) - min(k, len(ids))]
        for i in range(len(own)):
            near = np.flatnonzero((rough[i] >= limit[i] - 1e-9) & (rough[i] > -np.inf))
            exact = (v[near] * q[i]).sum(axis=1) / (lead[i] * size[near])
            for j in np.lexsort((ids[near], -exact))[:k]:
                out["query_id"].append(int(own[i]))
                out["vec_id"].append(int(ids[near[j]]))
                out["score"].append(float(exact[j]))
    return pa.table(out, pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, seed: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row
    with ``is_query``, by cosine, ties to the smaller id.

    Rows take no part if their id or vector is null, or the vector is empty, zero,
    of another length than the most common one, or has a null or non-finite
    component. Rows that share a query's id count as its own; a repeated id is
    returned once, with its best score. An empty table gives an empty result.
    Other columns are not read.

    Only the sample, list sizes (at most MAX_LISTS numbers) and the most common
    length reach the driver; every row is indexed, and postings are stored.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = (vectors.withColumn("__q", is_query).where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce("__q", F.lit(False)).alias("q"),
                    F.col(vector_col).alias("v")))
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == common.d)
    most = min(SAMPLE_ROWS, SAMPLE_VALUES // common.d + 1)
    # By hash, a little under the bound; the limit only guards against repeated ids.
    drawn = F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 40)) < int(min(1.0, 0.95 * most / common.n) * (1 << 40))
    sample = rows.where(F.lit(common.n <= most) | drawn).limit(most).select("v").toArrow()
    if not len(sample):
        sample = rows.limit(1).select("v").toArrow()
    sample = _distinct(_matrix(sample.column("v")))
    lists = int(np.clip(-(-common.n // LIST_ROWS), 1, min(MAX_LISTS, max(1, len(sample) // 8))))
    centroids = spark.sparkContext.broadcast(fit_centroids(sample, lists))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                x = _unit(_matrix(batch.column("v")))
                pairs = list(filed(x, centroids.value))
                picked = batch.take(pa.array([i for i, _ in pairs], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([c for _, c in pairs], pa.int32()), *picked.columns],
                                                 ["list", *batch.schema.names])

    kind = dict(rows.dtypes)["v"]
    postings = stored(rows.select("vec_id", "v").mapInArrow(file, f"list int, vec_id long, v {kind}"), "postings")
    sizes = np.zeros(len(centroids.value.vectors), dtype=np.int64)
    for r in postings.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                i, found = centroids.value.visited(_unit(_matrix(batch.column("v"))), sizes)
                picked = batch.take(pa.array(i))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *picked.columns],
                                                 ["list", *batch.schema.names])

    asked = stored(rows.where("q").select(F.col("vec_id").alias("query_id"), "v")
                   .mapInArrow(visit, f"list int, query_id long, v {kind}"), "visits")
    split = asked.groupBy("list").agg(F.ceil(F.count("*") / CELL_QUERIES).cast("int").alias("q_cells"))
    split = split.join(postings.groupBy("list").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("v_cells")), "list")
    split = F.broadcast(split)  # at most MAX_LISTS rows
    cell = lambda key, n: F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.col(n)).cast("int")
    left = postings.join(split, "list").select(
        "list", cell("vec_id", "v_cells").alias("a"), F.explode(F.sequence(F.lit(0), F.col("q_cells") - 1)).alias("b"), "vec_id", "v")
    right = asked.join(split, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("v_cells") - 1)).alias("a"), cell("query_id", "q_cells").alias("b"), "query_id", "v")
    best = left.groupBy("list", "a", "b").cogroup(right.groupBy("list", "a", "b")).applyInArrow(
        lambda r, q: _best(r, q, k), "query_id long, vec_id long, score double")
    once = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
