"""Exact top-k inner products by MaxScore over blocks of queries and shards of candidates.

Terms are the vector's dimensions. Within a shard a term's postings are its values less
the shard's smallest (for a negative query weight: the largest less the values), so
that every contribution is at least 0 and bounded by the query's weight times the
term's range; what is taken off is one constant for each query and shard. For each query
the terms are sorted by bound. Those whose bounds together cannot lift a candidate over
the k-th best score so far are non-essential: postings of the essential terms are
traversed for all candidates, the others are probed one group after the other, only
for the candidates that are still competitive. The k-th best score carries over from
shard to shard of a task; each task keeps k rows for each query, and those merge.

Queries go in blocks, candidates in shards, both packed in the smallest type that holds
their numbers; a task has one block and a run of shards and searches SEARCH queries at a
time, so memory is bounded by block and shard sizes, and no side is broadcast. A shard
goes once to each block, a block once to each run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.common import land

#: Queries in a block, candidates in a shard, shards that one task takes one after the other, queries searched together.
BLOCK, SHARD, RUN, SEARCH = 16384, 4096, 64, 256
_PROBED = 8  # terms probed at a time


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component; null where the vector or a component is null or not finite."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), whole)


def narrow(matrix: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest integer type that holds them."""
    low, high = (int(matrix.min()), int(matrix.max())) if matrix.size else (0, 0)
    return matrix.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def matrix_of(vectors: list[list[int]]) -> np.ndarray:
    """Vectors as rows; a shorter vector goes on with zeros."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def packed_shards(rows: DataFrame) -> DataFrame:
    """Rows (id, v) as shards of SHARD rows and less: (shard, ids, cells, item), numbers in their smallest type."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        vectors: list[list[int]] = []

        def out():
            cells = narrow(matrix_of(vectors))
            columns = [pa.array([(part << 32) + made]), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([cells.tobytes()], pa.binary()), pa.array([cells.itemsize], pa.int32())]
            ids.clear()
            vectors.clear()
            return pa.RecordBatch.from_arrays(columns, names=["shard", "ids", "cells", "item"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                vectors.append(v)
                if len(ids) == SHARD:
                    yield out()
                    made += 1
        if ids:
            yield out()

    return rows.mapInArrow(run, "shard long, ids binary, cells binary, item int")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by score, ties to smaller ids."""
    if len(scores) > 4 * k:  # leave out those below the k-th score before sorting
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class BlockSearch:
    """The queries of one block with their k best rows so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]

    def take(self, ids: np.ndarray, cells: np.ndarray) -> None:
        """Search one shard."""
        width = max(self.queries.shape[1], cells.shape[1])
        wide = lambda m: np.pad(m.astype(np.int64), ((0, 0), (0, width - m.shape[1])))
        q, rows = wide(self.queries), wide(cells)
        low, high = rows.min(axis=0, initial=0), rows.max(axis=0, initial=0)
        bounds = np.abs(q) * (high - low)
        constant = (q * np.where(q >= 0, low, high)).sum(axis=1)  # what every candidate has at least
        # Sums in floating point are exact below 2^24 and 2^53; beyond that they stay in integers.
        size = float((np.abs(q).max(axis=1, initial=0) * 1.0).max(initial=0)) * float(max(abs(int(low.min(initial=0))), int(high.max(initial=0)))) * max(width, 1)
        kind = np.float32 if size < 2 ** 23 else np.float64 if size < 2 ** 52 else np.int64
        # Postings by term, less the smallest value; a negative weight turns them round: w * (x - high) = w * (x - low) - w * (high - low).
        postings = np.ascontiguousarray((rows - low).T).astype(kind)
        turned = np.where(q < 0, -q * (high - low), 0)
        order = np.argsort(-bounds, axis=1, kind="stable")
        ranked = np.take_along_axis(bounds, order, axis=1)
        after = np.concatenate([np.cumsum(ranked[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1), np.int64)], axis=1)
        full = np.array([len(s) == self.k for _, s in self.found])
        floors = np.array([s[-1] if len(s) == self.k else 0 for _, s in self.found])
        # Essential terms: without them nobody can reach the k-th score.
        essential = np.where(full, (after + constant[:, None] >= floors[:, None]).sum(axis=1), width)
        essential = np.minimum(essential, (ranked > 0).sum(axis=1))
        mask = np.zeros(q.shape, bool)
        np.put_along_axis(mask, order, np.arange(width) < essential[:, None], axis=1)
        terms = np.flatnonzero(mask.any(axis=0))
        partial = (np.where(mask, q, 0)[:, terms].astype(kind) @ postings[terms]).astype(np.int64)
        partial += (constant + np.where(mask, turned, 0).sum(axis=1))[:, None]
        for n in range(len(q)):
            others = ids != self.ids[n]
            alive = np.flatnonzero(others & (partial[n] + after[n, essential[n]] >= floors[n]) if full[n] else others)
            scores = partial[n, alive]
            at = essential[n]
            while at < width and len(alive):  # probe the non-essential terms while a candidate is competitive
                some = order[n, at:at + _PROBED]
                scores = scores + (q[n, some].astype(kind) @ postings[np.ix_(some, alive)]).astype(np.int64) + int(turned[n, some].sum())
                at += len(some)
                if full[n]:
                    left = scores + after[n, at] >= floors[n]
                    alive, scores = alive[left], scores[left]
            if len(alive):
                own_ids, own_scores = np.concatenate([self.found[n][0], ids[alive]]), np.concatenate([self.found[n][1], scores])
                keep = best(own_scores, own_ids, self.k)
                self.found[n] = own_ids[keep], own_scores[keep]


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query and rank: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose id is divisible by `every`; candidates are all rows but
    those with the query's id. Score: inner product of the components' floor(scale * x);
    the k highest (all, if fewer), ties to smaller ids. Vectors that are null, or hold a
    null or non-finite component, and rows with a null id take no part; an empty vector
    scores 0; a shorter vector goes on with zeros. A candidate row that is repeated takes
    as many ranks; of rows that repeat a query's id, the smallest vector is the query.
    Other columns are not read; an empty table gives an empty one. Sums must fit into 64
    bits.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col), scale).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    spark, top = vectors.sparkSession, k
    queries = land(packed_shards(rows.filter(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v"))), "queries")
    shards = land(packed_shards(rows), "shards")
    asked_for = queries.agg(F.sum(F.octet_length("ids") / 8)).first()[0] or 0
    n_shards = shards.count()
    blocks = max(1, int(-(-asked_for // BLOCK)))
    # Shorter runs where blocks alone would leave cores idle.
    runs = max(1, min(n_shards, max(-(-n_shards // RUN), -(-2 * spark.sparkContext.defaultParallelism // blocks))))
    packed = ["ids", "cells", "item"]
    asked = queries.select(F.pmod(F.xxhash64("shard"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"), F.lit(0).alias("what"), "shard", *packed)
    given = shards.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("shard"), F.lit(runs)).cast("int").alias("run"), F.lit(1).alias("what"), "shard", *packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        searches: list[BlockSearch] = []

        def out():
            for search in searches:
                found = [(q, i, s) for q, (i, s) in zip(search.ids.tolist(), search.found, strict=True) if len(i)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found])), pa.array(np.concatenate([i for _, i, _ in found])), pa.array(np.concatenate([s for _, _, s in found]))],
                        names=["query_id", "vec_id", "score"])

        for batch in batches:
            for block, part, what, raw_ids, raw, item in zip(*(batch.column(c).to_pylist() for c in ("block", "run", "what", *packed)), strict=True):
                if (block, part) != at:
                    yield from out()
                    at, searches = (block, part), []
                ids = np.frombuffer(raw_ids, np.int64)
                cells = np.frombuffer(raw, np.dtype(f"<i{item}")).reshape(len(ids), -1)
                if not what:
                    searches += [BlockSearch(ids[k:k + SEARCH], cells[k:k + SEARCH], top) for k in range(0, len(ids), SEARCH)]
                else:
                    for search in searches:
                        search.take(ids, cells)
        yield from out()

    met = asked.unionAll(given).repartition("block", "run").sortWithinPartitions("block", "run", "what", "shard")
    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
