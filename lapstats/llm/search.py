"""Exact top-k inner-product search with MaxScore (operator 7).

A query's terms are its non-zero components; the postings of a term are the candidates with
a non-zero component there. Per block of candidates every term has a bound on what it can
add. Terms are ordered by that bound and split: the non-essential ones are the longest tail
whose bounds together stay below the k-th best score so far, so a candidate that appears in
no essential posting cannot enter. The essential postings are traversed for the whole block;
then the other terms are probed, strongest first, only for candidates whose score plus the
bounds still to come is competitive. The threshold starts from the exact scores of the
candidates that lead after the essential terms. Block results (k rows a query) are merged by
a ranking per query.

Candidates are packed into blocks by the tasks that read them, queries likewise; every query
block meets every candidate block, which is the work that the exact search asks for. Candidate
blocks are dealt over the tasks once; the query blocks are files of the shared folder, which a
task reads one by one for each of its candidate blocks. So nothing is joined, copied for a join,
collected or broadcast (the driver has the file names), and a task holds one block of each
kind. Scores are integers: products are summed in float64 while that is exact, otherwise as
Python integers.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no
part; vectors of different lengths are not compared; a query with fewer candidates returns
all; ties go to the smaller id, and rows that repeat an id are ranked each.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, materialise, open_fs

CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 256
STEP = 8                  # terms probed between two checks of the threshold


def quantise(vector, scale: int) -> list[int] | None:
    """floor(scale * x) of each component, or None for a vector that takes no part."""
    if not vector or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * x) for x in vector]


def pack(df: DataFrame, id_col: str, vector: str, scale: int, rows: int) -> DataFrame:
    """Blocks (dim, n, block): ids and an integer matrix, ``rows`` vectors at most in each."""

    def run(batches):
        held: dict[int, tuple[list, list]] = {}

        def block(dim):
            ids, vecs = held.pop(dim)
            return pa.RecordBatch.from_pylist([{"dim": dim, "n": len(ids), "block": pickle.dumps((ids, small(exact(vecs))), 5)}],
                                              schema=pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("block", pa.binary())]))

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                q = None if i is None else quantise(v, scale)
                if q is None:
                    continue
                ids, vecs = held.setdefault(len(q), ([], []))
                ids.append(i)
                vecs.append(q)
                if len(ids) == rows:
                    yield block(len(q))
        for dim in list(held):
            yield block(dim)

    return map_arrow(df.select(F.col(id_col).cast("long"), F.col(vector).cast("array<double>")), run,
                     "dim int, n int, block binary")


def exact(vectors: list[list[int]]) -> np.ndarray:
    """Float64 where every product and sum stays exact, else Python integers."""
    top = max((abs(x) for v in vectors for x in v), default=0)
    return np.array(vectors, np.float64 if top < 1 << 20 else object)


def small(vectors: np.ndarray) -> np.ndarray:
    """The numbers of ``exact`` in the fewest bytes, as a block is written."""
    if vectors.dtype == object:
        return vectors
    return vectors.astype(np.int16 if np.abs(vectors).max(initial=0) < 1 << 15 else np.int32)


def unpacked(block: bytes) -> tuple[list[int], np.ndarray]:
    """Ids and ``exact`` numbers of a block."""
    ids, vectors = pickle.loads(block)
    return ids, vectors if vectors.dtype == object else vectors.astype(np.float64)


def query_blocks(files: list[str]):
    """The rows (dim, block) of Parquet files in the shared folder, a few at a time; used inside tasks."""
    for file in files:
        store, path = open_fs(file)
        with store.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(16, columns=["dim", "block"]):
                yield from zip(batch.column(0).to_pylist(), batch.column(1))


def maxscore(query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray,
             own, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k best rows of a block, ties to smaller ids; rows with id ``own`` are
    left out. ``low`` and ``high`` are the block's extremes of each component."""
    bound = np.maximum(np.maximum(query * low, query * high), 0)
    order = np.argsort(-bound.astype(np.float64), kind="stable")
    order = order[query[order] != 0]
    rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)      # bounds from a place on
    alive = np.flatnonzero(ids != own)
    k = min(k, len(alive))
    if not k:
        return []
    # a first threshold: rows that lead on the strongest terms, scored in full
    lead = min(len(order), STEP)
    terms = vectors.T                                             # a term's postings lie together
    score = query[order[:lead]] @ terms[order[:lead]]
    first = alive
    if len(alive) > 4 * k:
        first = alive[np.argpartition(-score[alive].astype(np.float64), 4 * k)[:4 * k]]
    floor = np.sort(vectors[first][:, order] @ query[order])[-k] if len(order) else 0
    # essential terms: without them a row reaches less than the threshold
    split = lead
    while split < len(order) and rest[split] >= floor:
        split += 1
    if split > lead:
        score = score + query[order[lead:split]] @ terms[order[lead:split]]
    at = split
    alive = alive[score[alive] + rest[at] >= floor]
    score = score[alive]
    while at < len(order) and len(alive) > k:
        probe = order[at:at + STEP]
        score = score + vectors[np.ix_(alive, probe)] @ query[probe]
        at = min(at + STEP, len(order))
        stay = score + rest[at] >= floor
        alive, score = alive[stay], score[stay]
    if at < len(order):
        score = score + vectors[np.ix_(alive, order[at:])] @ query[order[at:]]
    found = sorted(zip((-int(s) for s in score), ids[alive].tolist()))[:k]
    return [(-s, i) for s, i in found]


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` its k best rows of
    ``candidates`` other than those with its own id."""
    asked = materialise(pack(queries, id_col, vector, scale, QUERY_BLOCK), "query-blocks")
    files = asked.inputFiles()
    # by number, so that small blocks with much work are not put together again
    tasks = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = pack(candidates, id_col, vector, scale, CANDIDATE_BLOCK).select("dim", "block").repartition(
        tasks, F.xxhash64("block"))

    def run(batches):
        for batch in batches:
            for dim, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, vectors = unpacked(block.as_py())
                vectors = np.asfortranarray(vectors)
                ready = np.array(ids), vectors, vectors.min(axis=0), vectors.max(axis=0)
                for qdim, asked in query_blocks(files):
                    if qdim != dim:
                        continue
                    out = ([], [], [])
                    for qid, query in zip(*unpacked(asked.as_py())):
                        for score, i in maxscore(query, *ready, qid, k):
                            for col, v in zip(out, (qid, i, score)):
                                col.append(v)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out],
                                                     names=["query_id", "vec_id", "score"])

    found = map_arrow(blocks, run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_maxscore_search(spark, sf_dir) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(rows, rows.where("vec_id % 50 = 0"))


SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM e q, e c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
