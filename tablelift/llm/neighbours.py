"""Nearest neighbours by a permutation index, largest inner product first.

The distinct vectors are dealt over blocks, and each block is an index of its own.  PIVOTS of its
vectors, those of smallest hash without near copies, are its pivots (chosen from SAMPLE times as
many, the bounded sample the index is fitted on).  Every
vector is represented by its POSTED nearest pivots in order and is posted in their inverted files;
a posting holds the vector's place of that pivot, in LEVELS steps.  A query is ordered the same way.
Its footrule distance to a vector sums, over the pivots, how far the two places lie apart; pivots
in which a vector is not posted count as place POSTED.  The inverted files of a block are bitmaps,
so the distances of many queries are one matrix product of place weights and postings.  The nearest
SHARE of the block, LEAST at least, by footrule are reranked first, by the exact inner product in
double precision; the score of the last wanted one is the query's floor.  Footrule knows neither
lengths nor the order inside a crowd of near copies, so it decides nothing: of all other vectors of
the block only those are left out that cannot reach the floor.  That is told by the nearest pivot
p of a vector x, since q.x <= q.p + |q||x - p|, by q.x <= |q||x|, and then by a matrix product whose
rounding is allowed for; the rest are reranked too.  The result is that of a full comparison.  Crowds
and short vectors are ruled out by their bounds; of uniformly random unit vectors in 64 dimensions,
the hardest case, next to none are (README).  The best of all blocks are merged.  Blocks and query
blocks have bounded size; each (block, query block) is one group of a cogroup.

Equal vectors are one entry of the index with their `k` + 1 smallest ids, so a vector that a third
of the rows share costs no more than any other, and ties go to the smaller id exactly.

Defined results: vectors that are null, empty, all zero or hold a null, NaN or infinite component take no
part, nor do rows without an id; rows that share an id count once, with their smallest vector; vectors
of different length are not compared; fewer than `k` candidates give fewer rows; an empty table
gives none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablelift.llm.common import written

BLOCK = 8192  # vectors of one index block
QUERY_BLOCK = 4096
PIVOTS = 256
SAMPLE = 4  # vectors looked at for each pivot
PARALLEL = 0.9  # cosine from which two vectors are too alike to be pivots both
POSTED = 128
LEVELS = 8
SHARE = 0.04
LEAST = 512
CHUNK = 256  # queries scored at once
ROUNDING = 1e-9  # of the product of two lengths: far more than an inner product in double precision loses


def places(vectors: np.ndarray, pivots: np.ndarray, posted: int, levels: int) -> np.ndarray:
    """Level of each pivot in each vector's order, `levels` for pivots beyond the posted ones."""
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")
    place = np.empty(order.shape, np.int32)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1], dtype=np.int32), order.shape), 1)
    return np.minimum(place, posted) * levels // posted


def spread(sample: np.ndarray, wanted: int) -> np.ndarray:
    """The first `wanted` vectors of the sample that are not nearly parallel to one chosen before.

    A crowd of near copies would fill the permutations with places that only noise decides.
    """
    units = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen: list[int] = []
    for i in range(len(sample)):
        if len(chosen) == wanted:
            break
        if not chosen or (units[chosen] @ units[i]).max() < PARALLEL:
            chosen.append(i)
    return sample[chosen]


class PermutationIndex:
    """One block: pivots, and for every (pivot, level) the bitmap of the vectors posted there."""

    def __init__(self, vectors: np.ndarray, order: np.ndarray, pivots: int = PIVOTS, posted: int = POSTED, levels: int = LEVELS):
        self.vectors = vectors
        self.pivots = spread(vectors[np.argsort(order, kind="stable")[: SAMPLE * pivots]], pivots)
        self.posted = min(posted, len(self.pivots))
        self.levels = min(levels, self.posted)
        level = places(vectors, self.pivots, self.posted, self.levels)
        row, pivot = np.nonzero(level < self.levels)
        self.files = np.zeros((len(self.pivots) * self.levels, len(vectors)), np.float32)
        self.files[pivot * self.levels + level[row, pivot], row] = 1.0
        self.lengths = np.linalg.norm(vectors, axis=1)
        pivot_lengths = np.linalg.norm(self.pivots, axis=1)
        self.owner = np.argmin(pivot_lengths**2 - 2 * (vectors @ self.pivots.T), axis=1)
        apart = np.linalg.norm(vectors - self.pivots[self.owner], axis=1)
        self.radius = apart + ROUNDING * (self.lengths + pivot_lengths[self.owner])

    def reach(self, queries: np.ndarray) -> np.ndarray:
        """An inner product that no vector exceeds, for every query and vector."""
        length = np.linalg.norm(queries, axis=1)[:, None]
        near_pivot = (queries @ self.pivots.T)[:, self.owner] + length * self.radius
        return np.minimum(near_pivot, length * self.lengths * (1 + ROUNDING))

    def footrule(self, queries: np.ndarray) -> np.ndarray:
        """Footrule distance of every query to every vector, in levels."""
        level = places(queries, self.pivots, self.posted, self.levels)
        apart = np.abs(np.arange(self.levels + 1)[None, None, :] - level[:, :, None]).astype(np.float32)
        unposted = apart[:, :, self.levels]
        weights = (apart[:, :, : self.levels] - unposted[:, :, None]).reshape(len(queries), -1)
        return unposted.sum(axis=1)[:, None] + weights @ self.files

    def search(self, queries: np.ndarray, wanted: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query: the nearest by footrule and all others that may be among the `wanted` best, with their exact inner products."""
        n = len(self.vectors)
        candidates = min(n, max(LEAST, wanted, int(np.ceil(SHARE * n))))
        found = []
        for start in range(0, len(queries), CHUNK):
            part = queries[start : start + CHUNK]
            if candidates == n:
                found += [(np.arange(n), self.scores(np.arange(n), query)) for query in part]
                continue
            near = np.argpartition(self.footrule(part), candidates - 1, axis=1)[:, :candidates]
            scores = np.array([self.scores(rows, query) for query, rows in zip(part, near, strict=True)])
            rest = self.open(part, near, np.partition(scores, -wanted, axis=1)[:, -wanted])
            for query, rows, known, more in zip(part, near, scores, rest, strict=True):
                others = np.flatnonzero(more)
                found.append((np.concatenate([rows, others]), np.concatenate([known, self.scores(others, query)])))
        return found

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        return (self.vectors[rows] * query).sum(axis=1)

    def open(self, queries: np.ndarray, near: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """For every query the vectors beyond `near` that may reach its floor; what overflows stays open."""
        rest = ~(self.reach(queries) < floor[:, None])
        np.put_along_axis(rest, near, False, 1)
        rows = np.flatnonzero(rest.any(axis=0))
        slack = ROUNDING * np.linalg.norm(queries, axis=1)[:, None] * self.lengths[rows]
        rest[:, rows] &= ~(queries @ self.vectors[rows].T + slack < floor[:, None])
        return rest


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1).astype(np.float64)


def search_block(k: int, data: pa.Table, queries: pa.Table) -> pa.Table:
    """The k best of one block for each query of one query block."""
    out: tuple[list, list, list] = ([], [], [])
    if data.num_rows and queries.num_rows:
        data = data.sort_by("order")
        ids = data.column("ids").to_pylist()
        index = PermutationIndex(matrix(data.column("embedding"), data.num_rows), data.column("order").to_numpy())
        query_ids = queries.column("query_id").to_pylist()
        for query_id, (rows, scores) in zip(query_ids, index.search(matrix(queries.column("embedding"), queries.num_rows), k + 1), strict=True):
            floor = np.partition(scores, -(k + 1))[-(k + 1)] if len(scores) > k + 1 else -np.inf
            best = [(-s, i) for r, s in zip(rows[scores >= floor].tolist(), scores[scores >= floor].tolist(), strict=True) for i in ids[r] if i != query_id]
            for s, i in sorted(best)[:k]:
                out[0].append(query_id)
                out[1].append(i)
                out[2].append(-s)
    return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, embedding array<double>), one row per id, without vectors that take no part."""
    e = F.col(embedding).cast("array<double>")
    chosen = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), e.alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    chosen = chosen.where(F.col("vec_id").isNotNull() & fine & F.exists("embedding", lambda x: x != 0))
    return chosen.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def nearest(
    vectors: DataFrame, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20,
    block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found for each row whose id divides by `every`."""
    rows = written(usable(vectors, vec_id, embedding), "vectors")
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("nth", first).where(F.col("nth") <= k + 1)  # limited before the shuffle as well
    classes = few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = classes.select("embedding", "ids", F.xxhash64(F.element_at("ids", 1)).alias("order"), F.size("embedding").alias("dim"))
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).select(
        F.col("vec_id").alias("query_id"), "embedding", F.size("embedding").alias("dim")
    )
    n, n_queries = rows.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_queries // query_block))
    sought = queries.withColumn("qblock", F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(query_blocks)))
    dealt = classes.withColumn("block", F.pmod(F.xxhash64("order"), F.lit(blocks)))
    dealt = dealt.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).withColumn("qblock", F.col("qblock").cast("long"))
    sought = sought.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    keys = ["dim", "block", "qblock"]

    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        return search_block(k, data, queries)

    found = dealt.groupBy(*keys).cogroup(sought.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
