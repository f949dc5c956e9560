"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are dealt into blocks of bounded size. In a block every dimension
has its list of vectors sorted by component. A query reads all lists from the
end that its sign favours, some entries at a time, scores what it meets in
full, and stops once the best score that an unseen vector could still reach
lies below its kth result. A tie with the kth may still win by its smaller
id, so equality goes on. Each block returns at most k rows per query, and a
window keeps the k best of those.

Queries come to a block as a sorted stream behind its vectors, so a task
holds one block and one batch of queries whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
LARGEST = (1 << 63) - 1
HITS = "query_id bigint, vec_id bigint, score bigint"


def scaled(vector: Column, factor: int) -> Column:
    """Components as ``floor(factor * x)``; null for vectors that take no part.

    A vector takes no part when it is null or holds a null, an infinite or a
    NaN component, or one whose scaled value does not fit a long.
    """
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * factor))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * factor >= float(1 << 62)))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


class SortedLists:
    """One block of vectors with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        # Doubles multiply fast and are exact while every sum stays below 2**53.
        self.limit = int(np.abs(rows).max(initial=0)) if rows.size else 0
        self.exact = self.rows.astype(np.float64)
        self.lists = np.argsort(self.rows, axis=0, kind="stable")
        self.values = np.take_along_axis(self.rows, self.lists, axis=0)

    def search(self, query_id: int, query: np.ndarray, k: int, depth: int) -> list[tuple[int, int]]:
        """The k best (score, id) of the block for one query, each id once, without its own id."""
        n, dims = self.rows.shape
        small = int(np.abs(query).max(initial=0)) * self.limit * max(1, dims) < 1 << 53
        weights = query.astype(np.float64) if small else query.astype(object)
        table = self.exact if small else self.rows.astype(object)
        down = query < 0
        seen = np.zeros(n, bool)
        ids, scores = np.empty(0, np.int64), np.empty(0, weights.dtype)
        at, step = 0, depth
        while at < n:
            end = min(n, at + step)
            step *= 2
            used = query != 0
            top = self.lists[n - end : n - at][:, used & ~down].ravel()
            low = self.lists[at:end][:, down].ravel()
            met = np.concatenate([top, low]) if used.any() else np.arange(at, end)
            new = np.unique(met[~seen[met]])
            seen[new] = True
            new = new[self.ids[new] != query_id]
            found = table[new] @ weights if dims else np.zeros(len(new))
            ids, scores = np.concatenate([ids, self.ids[new]]), np.concatenate([scores, found])
            by_id = np.lexsort((-scores, ids))  # an id of several vectors keeps its best
            by_id = by_id[np.diff(ids[by_id], prepend=ids[by_id[:1]] - 1) != 0]
            ids, scores = ids[by_id], scores[by_id]
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if end == n or seen.all():
                break
            edge = np.where(down, self.values[end - 1], self.values[n - end])
            if len(scores) == k and (edge.astype(weights.dtype) @ weights) < scores[-1]:
                break
            at = end
        return [(max(-LARGEST - 1, min(LARGEST, int(s))), int(i)) for s, i in zip(scores, ids, strict=True)]


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 10, factor: int = 1024, depth: int = 16) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best other rows for each query row.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored.
    Rows that repeat count once. Rows of another length than the query are no
    candidates for it. A null id takes no part. Ties go to the smaller id, and
    scores beyond a long stay at its end. Where a query id stands for several
    different vectors, its results are the best over them.
    """
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), is_query.alias("asks"), scaled(F.col("embedding"), factor).alias("x"))
        .where(F.col("x").isNotNull() & F.col("vec_id").isNotNull())
        .dropDuplicates(["vec_id", "x"])
        .withColumn("dims", F.size("x"))
    )
    sizes = {r["dims"]: r["count"] for r in rows.groupBy("dims").count().collect()}  # one row per vector length
    blocks = {dims: -(-n // BLOCK) for dims, n in sizes.items()}
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    count = F.coalesce(*[F.when(F.col("dims") == d, F.lit(n).cast("long")) for d, n in blocks.items()])
    spread = rows.withColumn("blocks", count)
    held = spread.select("vec_id", "x", "dims", F.pmod(F.xxhash64("vec_id", "x"), "blocks").alias("block"), F.lit(False).alias("asks"))
    asking = spread.where("asks").select("vec_id", "x", "dims", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "asks")
    dealt = held.unionByName(asking).repartition(max(sum(blocks.values()), 1), "dims", "block").sortWithinPartitions("dims", "block", "asks", "vec_id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, parts, lists = None, [], [], None
        for batch in batches:
            frame = batch.to_pandas()
            for (dims, block, asks), group in frame.groupby(["dims", "block", "asks"], sort=True):
                if (dims, block) != here:
                    here, ids, parts, lists = (dims, block), [], [], None
                matrix = np.array(group["x"].tolist(), np.int64).reshape(len(group), int(dims))
                if not asks:
                    ids.append(group["vec_id"].to_numpy())
                    parts.append(matrix)
                    continue
                if lists is None:
                    lists = SortedLists(np.concatenate(ids), np.concatenate(parts)) if ids else None
                if lists is None:
                    continue
                hits = [(q, i, s) for q, x in zip(group["vec_id"].tolist(), matrix, strict=True) for s, i in lists.search(q, x, k, depth)]
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(hits, columns=["query_id", "vec_id", "score"]).astype("int64"), preserve_index=False
                )

    found = dealt.select("vec_id", "x", "dims", "block", "asks").mapInArrow(scan, HITS)
    # A vector id that stands for several vectors keeps its best score.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
