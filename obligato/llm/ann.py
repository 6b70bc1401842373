"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut into two halves, each quantised by its own codebook; a cell is a pair of
centroids. A query visits cells in order of the summed distances of its halves to the centroids, with a
heap over centroid pairs, until the cells hold the calibrated share of all vectors; every entry there is
reranked by its exact cosine in double precision.

The codebooks are fitted on a bounded sample (``SAMPLE``), and the share is calibrated on it: the smallest
that finds ``TARGET`` of the true neighbours of ``PROBES`` sampled queries. Every vector is indexed.
Equal vectors are one entry with their smallest ids, so a vector that is very common is ranked once.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from obligato.llm.common import materialized

SAMPLE, PROBES, TARGET, ROUNDS = 8192, 128, 0.97, 8
PER_CELL, MAX_CENTROIDS = 12, 64
TOP, QUERY_EVERY = 5, 50
#: Entries of one first-half centroid that a task holds at once, on average (twice as many to odds below 1e-300); more are dealt into blocks by hash.
BLOCK = 4096
#: Queries that a task holds at once; they are dealt by hash into blocks of half as many on average, which
#: leaves more than this many in one to odds below 1e-300.
QUERY_BLOCK = 4096


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, v (doubles) of the vectors that take part: not null, not zero, all components finite."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")).where(
        v.isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists(v, lambda x: x != 0))


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * np.einsum("ik,jk->ij", x, centroids) + (centroids * centroids).sum(1), 0)


def _codebook(x: np.ndarray, n: int) -> np.ndarray:
    centroids = x[np.random.default_rng(7).choice(len(x), n, replace=False)]
    for _ in range(ROUNDS):
        nearest = _distances(x, centroids).argmin(1)
        count = np.bincount(nearest, minlength=n)
        total = np.zeros_like(centroids)
        np.add.at(total, nearest, x)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
    return centroids


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two (exact, and no matter to cosines), so that no square overflows or vanishes."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1])


def unit(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


class MultiIndex:
    """Two codebooks and the number of entries per cell."""

    def __init__(self, sample: np.ndarray, entries: int):
        x = unit(sample)
        self.half = x.shape[1] // 2
        n = int(min(MAX_CENTROIDS, len(x), max(1, round((entries / PER_CELL) ** 0.5))))
        self.books = _codebook(x[:, :self.half], n), _codebook(x[:, self.half:], n)
        self.n, self.counts = n, np.zeros((n, n), np.int64)
        self.share = self._calibrated(x)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, :self.half], self.books[0]).argmin(1), _distances(x[:, self.half:], self.books[1]).argmin(1)

    def visited(self, x: np.ndarray, wanted: float) -> list[tuple[int, int]]:
        """Cells in order of summed distances until they hold at least that many entries."""
        d = [_distances(h[None, :], book)[0] for h, book in zip((x[:self.half], x[self.half:]), self.books)]
        order = [np.argsort(row, kind="stable").tolist() for row in d]
        near = [np.sort(row).tolist() for row in d]
        counts, held, found = self.counts, 0, []
        heap, reached = [(near[0][0] + near[1][0], 0, 0)], [0] * self.n
        while heap and held < wanted:
            _, a, b = heapq.heappop(heap)
            i, j = order[0][a], order[1][b]
            if counts[i, j]:
                found.append((i, j))
                held += int(counts[i, j])
            # Each row of pairs is walked once, and starts when the pair above its first one is left.
            if b + 1 < self.n:
                heapq.heappush(heap, (near[0][a] + near[1][b + 1], a, b + 1))
            if b == 0 and a + 1 < self.n:
                heapq.heappush(heap, (near[0][a + 1] + near[1][0], a + 1, 0))
        return found

    def _calibrated(self, x: np.ndarray) -> float:
        """The share of entries to visit, from the sample's own neighbours."""
        if len(x) <= TOP + 1:
            return 1.0
        probes = x[np.random.default_rng(8).choice(len(x), min(PROBES, len(x)), replace=False)]
        a, b = self.cells(x)
        cell = a * self.n + b
        summed = (_distances(probes[:, :self.half], self.books[0])[:, :, None]
                  + _distances(probes[:, self.half:], self.books[1])[:, None, :]).reshape(len(probes), -1)
        order = np.argsort(summed, axis=1, kind="stable")
        filled = np.cumsum(np.bincount(cell, minlength=self.n ** 2)[order], axis=1) / len(x)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(self.n ** 2)[None, :], axis=1)
        top = np.argsort(-np.einsum("ik,jk->ij", probes, x), axis=1)[:, 1:TOP + 1]  # without the probe itself
        needed = np.take_along_axis(filled, np.take_along_axis(place, cell[top], axis=1), axis=1)
        return float(min(1.0, np.quantile(needed, TARGET)))


def build_index(entries: DataFrame) -> tuple[MultiIndex | None, DataFrame]:
    """The index and all entries (v, ids) with their cells."""
    n = entries.count()
    sample = entries.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(SAMPLE).collect()
    widths = {len(r.v) for r in sample}
    if not sample:
        return None, entries
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(widths)}")
    index = MultiIndex(np.array([r.v for r in sample]), n)

    cells = materialized(entries.select("v", "ids").mapInPandas(_cells_of(index), "v array<double>, ids array<long>, i int, j int"))
    for r in cells.groupBy("i", "j").count().collect():  # at most MAX_CENTROIDS ** 2 rows
        index.counts[r.i, r.j] = r["count"]
    return index, cells


def _cells_of(index: MultiIndex):
    def run(frames):
        for frame in frames:
            if len(frame):
                i, j = index.cells(unit(np.stack(frame["v"])))
                yield frame.assign(i=i.astype(np.int32), j=j.astype(np.int32))

    return run


def nearest(vectors: DataFrame, queries: DataFrame | None = None, top: int = TOP, share: float | None = None, *,
            vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's nearest found, largest cosine first, ties to the smaller id.

    ``queries`` are rows of the same columns (default: ids divisible by ``QUERY_EVERY``). A query's own id is no
    candidate. Null, zero and non-finite vectors and null ids take no part, neither as queries nor as
    candidates; fewer candidates than ``top`` give fewer ranks. Repeated rows count once; an id with several
    vectors, as a query or as a candidate, is one id with the best score of them. Vectors of different lengths
    raise an error; no rows give no rows.
    """
    rows = usable(vectors, vec_id, embedding)
    asked = rows.where(F.col("vec_id") % QUERY_EVERY == 0) if queries is None else usable(queries, vec_id, embedding)
    asked = materialized(asked.distinct())
    query_blocks = max(1, -(-2 * asked.count() // QUERY_BLOCK))
    # The smallest ids of equal vectors: as many as could be ranked, and one more for the query itself.
    # The limit on the rank acts before the shuffle too, so a very common vector sends a few rows per task.
    firsts = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.distinct().withColumn("n", firsts).where(F.col("n") <= top + 1)
    entries = materialized(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    index, cells = build_index(entries)
    schema = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return vectors.sparkSession.createDataFrame([], schema)
    wanted = max(10.0 * top, (share if share is not None else index.share) * float(index.counts.sum()))

    def visits(frames):
        for frame in frames:
            found = []
            for q, v in zip(frame["vec_id"], frame["v"]):
                by_first: dict[int, list[int]] = {}
                for i, j in index.visited(unit(np.array(v)[None, :])[0], wanted):
                    by_first.setdefault(i, []).append(j)
                found += [(q, v, i, js) for i, js in by_first.items()]
            yield pd.DataFrame(found, columns=["query_id", "q", "i", "js"])

    blocks = {i: int(-(-n // BLOCK)) for i, n in enumerate(index.counts.sum(1).tolist()) if n}
    block_count = F.element_at(F.array(*[F.lit(blocks.get(i, 1)) for i in range(index.n)]), F.col("i") + 1)
    query_block = F.pmod(F.xxhash64("query_id", "q"), F.lit(query_blocks)).cast("int")
    routed = (asked.mapInPandas(visits, "query_id long, q array<double>, i int, js array<int>")
              .withColumns({"block": F.explode(F.sequence(F.lit(0), block_count - 1)), "query_block": query_block}))
    blocked = cells.withColumn("block", F.pmod(F.xxhash64("v"), block_count).cast("int")).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def rerank(key, asked_here, entries_here):
        if not len(asked_here) or not len(entries_here):
            return pd.DataFrame(columns=["query_id", "vec_id", "score"])
        v, q = scaled(np.stack(entries_here["v"])), scaled(np.stack(asked_here["q"]))
        j, ids, found = entries_here["j"].to_numpy(), entries_here["ids"].to_numpy(), []
        rows_of = {int(cell): np.flatnonzero(j == cell) for cell in np.unique(j)}
        norms = np.sqrt((v * v).sum(1))
        for query, x, js in zip(asked_here["query_id"], q, asked_here["js"]):
            chosen = np.concatenate([rows_of.get(int(cell), np.zeros(0, np.int64)) for cell in js])
            scores = np.einsum("ij,j->i", v[chosen], x) / (norms[chosen] * np.sqrt((x * x).sum()))
            wanted_here = top + 1  # one entry may be the query's own
            while True:
                edge = -np.partition(-scores, wanted_here - 1)[wanted_here - 1] if len(scores) > wanted_here else -np.inf
                best: dict[int, float] = {}  # by id; ties at the edge are all kept
                for k in np.flatnonzero(scores >= edge).tolist():
                    for i in ids[chosen[k]]:
                        if i != query:
                            best[i] = max(best.get(i, -np.inf), scores[k])
                if len(best) >= top or edge == -np.inf:
                    break
                wanted_here *= 4  # an id with many vectors took the places of others
            found += [(query, i, s) for i, s in sorted(best.items(), key=lambda r: (-r[1], r[0]))[:top]]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    group = ["i", "block", "query_block"]
    found = routed.groupBy(*group).cogroup(blocked.groupBy(*group)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    # Blocks and a query's several vectors may find an id more than once.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
