"""Exact top-k inner products by the threshold algorithm.

Candidates stay where they are read: a task takes its vectors in blocks. In a block, every dimension has
its vectors sorted by that component. A query walks the lists of its non-zero components from their best
end, scores every vector it meets, and stops when the best score an unmet vector could have, the
threshold, is below its k-th score so far. Queries are broadcast in slices of bounded size; a task sends
the k best of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlane.llm.common import prepare, stored

#: Vectors of a candidate block, and bytes of the queries that are broadcast at a time.
BLOCK_ROWS, SLICE_BYTES = 32_768, 32 << 20


def scaled(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id, x`` with x = floor(scale * component), components as doubles.

    Null ids, null vectors and vectors holding null or non-finite components take no part. Rows that
    repeat an id are vectors of their own. Components too large for scores of 64 bits make `top_k` raise.
    """
    doubles = F.transform("embedding", lambda v: v.cast("double") * scale)
    sound = F.forall("d", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    held = F.transform("d", lambda v: F.floor(F.greatest(F.lit(-9e18), F.least(F.lit(9e18), v))))
    return (vectors.select("vec_id", doubles.alias("d")).where(F.col("vec_id").isNotNull() & F.col("d").isNotNull())
            .where(sound).select(F.col("vec_id").cast("long"), held.alias("x")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


class Best:
    """The k best of each query so far: scores, ids and rows, best first, ties to the smaller id, then row."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.of = k, [np.empty((3, 0), dtype=np.int64) for _ in range(n)]

    def floor(self, query: int) -> int | None:
        """The k-th score, once there are k."""
        held = self.of[query]
        return int(held[0, -1]) if held.shape[1] == self.k else None

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if (least := self.floor(query)) is not None:
            good = scores >= least
            scores, ids, rows = scores[good], ids[good], rows[good]
        if len(scores) > self.k:
            good = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids, rows = scores[good], ids[good], rows[good]
        if len(scores):
            both = np.concatenate([self.of[query], np.stack([scores, ids, rows])], axis=1)
            self.of[query] = both[:, np.lexsort((both[2], both[1], -both[0]))[:self.k]]


def search_block(queries: np.ndarray, own: np.ndarray, block: np.ndarray, ids: np.ndarray, rows: np.ndarray, best: Best) -> None:
    """Threshold algorithm for each query over one block; the query's own row is left out."""
    n = len(block)
    order = np.argsort(block, axis=0, kind="stable").astype(np.int32)  # of each dimension, ascending
    lists = np.take_along_axis(block, order, axis=0)
    top = int(max(np.abs(block).max(initial=0), 1)) * int(max(np.abs(queries).max(initial=0), 1)) * max(block.shape[1], 1)
    exact = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64
    values = block.astype(exact)
    place = {r: i for i, r in enumerate(rows.tolist())}
    for number, (query, self_row) in enumerate(zip(queries, own.tolist())):
        used = np.flatnonzero(query)
        weight, q = query[used], query.astype(exact)
        seen = np.zeros(n, dtype=bool)
        if self_row in place:
            seen[place[self_row]] = True
        done, step = 0, max(best.k, 16)
        while True:
            upto = min(n, done + step)
            if len(used) == 0 or 2 * len(used) * upto > n:
                upto = n  # the lists would meet most vectors: read them to their end
                new = np.flatnonzero(~seen)
            else:
                met = np.zeros(n, dtype=bool)
                rising, falling = used[weight < 0], used[weight > 0]
                met[order[done:upto, rising].ravel()] = True
                met[order[n - upto:n - done, falling].ravel()] = True
                new = np.flatnonzero(met & ~seen)
            seen[new] = True
            product = (values @ q)[new] if 2 * len(new) > n else values[new] @ q
            best.add(number, product.astype(np.int64), ids[new], rows[new])
            if upto >= n:
                break
            edge = np.where(weight > 0, lists[n - upto, used], lists[upto - 1, used])
            if (least := best.floor(number)) is not None and int((edge * weight).sum()) < least:
                break  # an unmet vector scores at most the threshold; equality could still win by its id
            done, step = upto, step * 2


def top_k(vectors: DataFrame, is_query, k: int = 20, block_rows: int = BLOCK_ROWS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The k best inner products of each query (rows where ``is_query`` holds) with every other row.

    ``vectors``: ``vec_id, x`` as `scaled` makes them; a shorter vector counts as padded with zeros. Every
    row is a candidate, and every query a row, of its own, repeated ids included. Queries are taken in
    slices of ``slice_bytes``, each one pass over the candidates, which are never shuffled. Raises when
    a score could leave 64 bits. Returns ``query_id, rank, vec_id, score``; other columns are ignored.
    """
    spark = prepare(vectors.sparkSession)
    vectors = stored(vectors.select("vec_id", "x", is_query.alias("asks")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = vectors.where("asks").select("vec_id", "row", "x")
    largest = F.coalesce(F.max(F.aggregate("x", F.lit(0).cast("long"), lambda a, v: F.greatest(a, F.abs(v)))), F.lit(0))
    width, of_all = vectors.agg(F.coalesce(F.max(F.size("x")), F.lit(0)), largest).first()
    n, of_queries = asked.agg(F.count("*"), largest).first()
    if width * of_all * of_queries >= 1 << 63:
        raise ValueError("components are too large: scores would not fit 64 bits")
    slices = max(1, -(-n * max(width, 1) * 8 // slice_bytes))
    out = None
    for part in range(slices):
        few = asked.where(F.pmod(F.xxhash64("row"), F.lit(slices)) == part).toArrow().combine_chunks()  # about slice_bytes
        query_ids = few["vec_id"].to_numpy()
        shared = spark.sparkContext.broadcast((_matrix(few["x"].combine_chunks(), width), few["row"].to_numpy()))

        def searched(batches: Iterator[pa.RecordBatch], shared=shared, query_ids=query_ids) -> Iterator[pa.RecordBatch]:
            queries, own = shared.value
            best, held, size = Best(len(own), k), [], 0

            def search() -> None:
                block = pa.Table.from_batches(held).combine_chunks()
                search_block(queries, own, _matrix(block["x"].combine_chunks(), width), block["vec_id"].to_numpy(),
                             block["row"].to_numpy(), best)

            for batch in batches:
                held.append(batch)
                size += batch.num_rows
                if size >= block_rows:
                    search()
                    held, size = [], 0
            if size:
                search()
            counts = [b.shape[1] for b in best.of]
            both = np.concatenate(best.of, axis=1) if best.of else np.empty((3, 0), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(query_ids, counts)), pa.array(np.repeat(own, counts)), *map(pa.array, both)],
                names=["query_id", "query_row", "score", "vec_id", "row"])

        if len(query_ids) or part == 0:
            found = vectors.select("vec_id", "row", "x").mapInArrow(
                searched, "query_id long, query_row long, score long, vec_id long, row long")
            order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
            found = (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                     .select("query_id", "rank", "vec_id", "score"))
            out = found if out is None else out.unionByName(found)
    return out
