"""Exact top-k by inner product with bounds from segment statistics.

A vector is cut into segments; the mean and deviation of each segment bound the distance to another
vector from below: n ((mean difference)^2 + (deviation difference)^2) per segment of n components. With
the norms this bounds the inner product from above. Few long segments are tried first, more short ones
on what is left, and the exact product only on what could still be among the best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.stage import stage
from tallybook.llm.vectors import finite_vectors

RESOLUTIONS = (4, 16)
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 1024


def integers(matrix: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(matrix * scale)


def statistics(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations per segment, times the root of its length."""
    found = []
    for part in np.array_split(np.arange(matrix.shape[1]), min(segments, max(1, matrix.shape[1]))):
        root = len(part) ** 0.5
        found += [matrix[:, part].mean(axis=1) * root, matrix[:, part].std(axis=1) * root] if len(part) else []
    return np.stack(found, axis=1) if found else np.zeros((len(matrix), 0))


class Best:
    """The k best candidates of every query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.float64)
        self.worst = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids, score = (np.concatenate(x) for x in ((self.query, query), (self.ids, ids), (self.score, score)))
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        start = np.searchsorted(query, query, "left")
        rank = np.arange(len(query)) - start
        keep = rank < self.k
        full = rank == self.k - 1
        self.worst[query[full]] = score[full]
        self.query, self.ids, self.score = query[keep], ids[keep], score[keep]


def search_block(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray,
                 best: Best, numbers: np.ndarray) -> None:
    """Adds to ``best`` what ``candidates`` hold; ``numbers`` are the queries' places in it."""
    norms = [np.einsum("nd,nd->n", x, x) for x in (queries, candidates)]
    base = (norms[0][:, None] + norms[1][None, :]) / 2
    # Rounding must not push a bound below the product it bounds.
    slack = 1e-9 * base + 1e-6
    levels = [(statistics(queries, s), statistics(candidates, s)) for s in RESOLUTIONS]
    coarse_q, coarse_c = levels[0]
    distance = np.maximum(
        np.einsum("nd,nd->n", coarse_q, coarse_q)[:, None] + np.einsum("nd,nd->n", coarse_c, coarse_c)[None, :]
        - 2 * coarse_q @ coarse_c.T, 0)
    left = base - distance / 2 + slack >= best.worst[numbers][:, None]
    left &= query_ids[:, None] != ids[None, :]
    q, c = np.nonzero(left)
    for fine_q, fine_c in levels[1:]:
        keep = np.zeros(len(q), dtype=bool)
        for k in range(0, len(q), 1 << 16):
            at = slice(k, k + (1 << 16))
            gap = fine_q[q[at]] - fine_c[c[at]]
            bound = base[q[at], c[at]] - np.einsum("nd,nd->n", gap, gap) / 2 + slack[q[at], c[at]]
            keep[at] = bound >= best.worst[numbers[q[at]]]
        q, c = q[keep], c[keep]
    score = np.concatenate([np.einsum("nd,nd->n", queries[q[k:k + (1 << 16)]], candidates[c[k:k + (1 << 16)]])
                            for k in range(0, len(q), 1 << 16)] or [np.zeros(0)])
    enough = score >= best.worst[numbers[q]]
    best.add(numbers[q[enough]], ids[c[enough]], score[enough])


def _searched(batches, sent, k: int, scale: float):
    query_ids, by_length = sent.value
    best = Best(len(query_ids), k)
    for batch in batches:
        known = np.asarray(batch.column(0).is_valid())
        all_ids = np.asarray(batch.column(0).fill_null(0), dtype=np.int64)
        for length, (rows, matrix) in finite_vectors(batch.column(1)).items():
            if length not in by_length:
                continue
            numbers, queries = by_length[length]
            matrix, rows = matrix[known[rows]], rows[known[rows]]
            matrix = integers(matrix, scale)
            for at in range(0, len(rows), CANDIDATE_BLOCK):
                for q in range(0, len(numbers), CANDIDATE_BLOCK):
                    part = numbers[q:q + CANDIDATE_BLOCK]
                    search_block(queries[q:q + CANDIDATE_BLOCK], query_ids[part], matrix[at:at + CANDIDATE_BLOCK],
                                 all_ids[rows[at:at + CANDIDATE_BLOCK]], best, part)
    yield pa.RecordBatch.from_arrays(
        [pa.array(best.query), pa.array(query_ids[best.query]), pa.array(best.ids), pa.array(best.score.astype(np.int64))],
        names=["number", "query_id", "vec_id", "score"])


def top_k(queries: DataFrame, candidates: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
          k: int = 10, scale: float = 1024.0) -> DataFrame:
    """The ``k`` best candidates of each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Components become floor(``scale`` x); the score is the integer inner product, defined while it fits
    a double's 53 bits. Ties go to the smaller id; a row with the query's own id is no candidate. Rows
    with a null id, or whose vector is null or has a null or non-finite component, take no part; nor do
    candidates of another length. Repeated candidates all count, and each query row is answered.

    Queries are broadcast in blocks of about ``QUERY_BLOCK``, one pass over the candidates for each; a
    task keeps k rows per query.
    """
    spark = candidates.sparkSession
    asked = stage(queries.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull())
                  .select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector")), "queries")
    rows = candidates.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    found = None
    for block in range(blocks):
        # About QUERY_BLOCK rows, by the hash of the row.
        part = asked.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)) == block).toArrow()
        by_length = {length: (at, integers(matrix, scale)) for length, (at, matrix) in
                     finite_vectors(part.column("vector")).items()} if len(part) else {}
        sent = spark.sparkContext.broadcast((np.asarray(part.column("vec_id"), dtype=np.int64), by_length))
        answers = stage(rows.mapInArrow(lambda b, sent=sent: _searched(b, sent, k, scale),
                                        "number long, query_id long, vec_id long, score long"), "answers")
        sent.destroy()
        answers = answers.withColumn("block", F.lit(block))
        found = answers if found is None else found.unionByName(answers)
    order = Window.partitionBy("block", "number").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
