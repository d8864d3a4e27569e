"""Exact top-k search: whole scores of every query with every vector, term at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from math import floor

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakelayers.llm.common import map_arrow, stored
from lakelayers.sources.workspace import scratch_path

# Fixed values of the contract: components are counted in parts of one, results of a query.
SCALE = 256
K = 5

# A block of queries is sent to every task and has at most about this many bytes, whatever the number of queries.
BLOCK_BYTES = 32 << 20
# Queries whose dense score arrays a task holds at a time.
TOGETHER = 16
# Scores beyond a long are held at its ends; the lowest value marks rows that do not count.
MOST = (1 << 63) - 1
NONE = -(1 << 63)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` rows of ``vectors`` with the highest inner product with each query.

    Components become whole numbers, floor(``scale`` * x). A batch of vectors is turned into postings, for each component the rows that have
    it with their weights; each component that a query has scatters its weighted postings into the query's
    dense score array over the batch. All rows get their whole score; a task selects each query's best as it goes, and
    the tasks' lists are merged in one shuffle of ``k`` rows per query and task. Vectors never move. Queries are cut by row into
    blocks of bounded size that are sent to all tasks one after the other; each block's results are written, so a
    lost executor repeats tasks of one block.

    A row is not a candidate of a query with its id, so repeated rows of a query do not find each other; a null id is a
    candidate of all. Queries that are equal in id and vector are one query; queries of one id with different vectors are answered each. Repeated
    rows of ``vectors`` are candidates each. Equal scores go by id, null last. Vectors that are null or hold null or
    non-finite components take no part. Components that one of two vectors of different length lacks count as zero, an empty vector
    scores 0. A query with fewer than ``k`` candidates returns them all. Empty tables give an empty table. Scores that no
    long holds are held at its ends.
    """
    usable = lambda df: df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).filter(_whole(F.col("vector")))
    rows = usable(vectors)
    asked = stored(usable(queries).distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    sizes = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("vector")).alias("components")).first()
    blocks = -(-(8 * (sizes.components or 0) + 64 * sizes.n) // block_bytes)
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"query long, id {kind}, score long"
    path = scratch_path(vectors.sparkSession, "found")
    _best(rows.sparkSession.createDataFrame([], schema), k).write.parquet(path)
    for number in range(blocks):
        block = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == number)
        sent = vectors.sparkSession.sparkContext.broadcast(_block(block, scale))
        scored = map_arrow(rows, partial(_search, sent, k, scale), schema)
        _best(scored, k).write.mode("append").parquet(path)
        sent.unpersist()
    best = vectors.sparkSession.read.schema(f"{schema}, rank int").parquet(path)
    named = asked.select("query", F.col("id").alias("query_id"))
    return best.join(named, "query").select("query_id", "rank", "id", "score")


def _whole(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block(block: DataFrame, scale: int) -> tuple[np.ndarray, list, np.ndarray]:
    """Row numbers, ids and component-wise weights of a block of queries, whose size is bounded."""
    rows = block.select("query", "id", "vector").toArrow()
    return rows["query"].to_numpy(), rows["id"].to_pylist(), _weights(rows["vector"].combine_chunks(), scale)


def _weights(vectors: pa.ListArray, scale: int) -> np.ndarray:
    """Whole components, a row per component and a column per vector; shorter vectors are filled with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if np.abs(x).max(initial=0) * scale < 2**53:
        x = np.floor(scale * x).astype(np.int64)
    else:  # a double of this size is a whole number
        x = np.array([floor(scale * v) if abs(v) < 2**53 else int(v) * scale for v in x.tolist()], object)
    width = lengths.max(initial=0)
    if (lengths == width).all():
        return np.ascontiguousarray(x.reshape(len(lengths), width).T)
    out = np.zeros((width, len(lengths)), x.dtype)
    column = np.repeat(np.arange(len(lengths)), lengths)
    out[np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths), column] = x
    return out


def _search(sent: Broadcast, k: int, scale: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best ``k`` rows of a task for each query of the block."""
    numbers, asked, weights = sent.value
    best: list[list[tuple]] = [[] for _ in numbers]
    kind = None
    for batch in batches:
        kind = batch.schema.field("id").type
        if batch.num_rows:
            _search_batch(batch, asked, weights, k, scale, best)
    rows = [(number, key[2], -key[0]) for number, own in zip(numbers.tolist(), best) for key in own]
    if rows:
        number, found, score = zip(*rows)
        arrays = [pa.array(number, pa.int64()), pa.array(found, kind), pa.array(score, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["query", "id", "score"])


def _search_batch(batch: pa.RecordBatch, asked: list, weights: np.ndarray, k: int, scale: int, best: list[list[tuple]]) -> None:
    # Rows stand in the order of their ids, null last, so that of equal scores the first ones win.
    batch = batch.sort_by("id")
    ids = batch["id"].to_pylist()
    known = _array(ids[: len(ids) - batch["id"].null_count])
    postings = _postings(_weights(batch["vector"], scale))
    terms = range(min(len(weights), len(postings)))
    largest = max((int(np.abs(weight).max()) for _, weight in postings if len(weight)), default=0)
    reach = int(np.abs(weights).sum(axis=0).max(initial=0)) * largest
    exact = np.int64 if reach < 2**62 else object
    for at in range(0, len(asked), TOGETHER):
        some = weights[:, at : at + TOGETHER].astype(exact, copy=False)
        scores = np.zeros((some.shape[1], len(ids)), exact)
        for term in terms:
            places, weight = postings[term]
            has = np.flatnonzero(some[term])
            if len(has) == len(some[term]) and places is None:
                scores += np.multiply.outer(some[term], weight.astype(exact, copy=False))
            elif len(has) and len(weight):
                every = slice(None) if places is None else places
                for query in has:
                    scores[query, every] += some[term, query] * weight.astype(exact, copy=False)
        if exact is object:
            scores = np.clip(scores, -MOST, MOST).astype(np.int64)
        for query, score in enumerate(scores):
            own = asked[at + query]
            if own is not None:
                score[np.searchsorted(known, own, "left") : np.searchsorted(known, own, "right")] = NONE
            _keep(best, at + query, score, ids, k)


def _array(ids: list) -> np.ndarray:
    if ids and isinstance(ids[0], int):
        return np.array(ids, np.int64)
    out = np.empty(len(ids), object)
    out[:] = ids
    return out


def _postings(weights: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """For each component the rows that have it, None for nearly all, and their weights."""
    out = []
    for row in weights:
        places = np.flatnonzero(row)
        out.append((None, row) if 2 * len(places) > len(row) else (places, row[places]))
    return out


def _keep(best: list[list[tuple]], query: int, score: np.ndarray, ids: list, k: int) -> None:
    """Partition the batch's scores at the k-th, and merge what is above with the best so far."""
    mine = best[query]
    limit = np.partition(score, len(score) - k)[len(score) - k] if len(score) > k else NONE
    if len(mine) == k:
        limit = max(limit, -mine[-1][0])
    above = np.flatnonzero(score > limit)
    level = np.flatnonzero(score == limit)[:k] if limit > NONE else above[:0]
    if len(above) or len(level):
        new = [(-int(score[i]), ids[i] is None, ids[i]) for i in (*above, *level)]
        best[query] = sorted(mine + new, key=_order)[:k]


def _order(key: tuple) -> tuple:
    return key if key[2] is not None else (*key[:2], 0)
