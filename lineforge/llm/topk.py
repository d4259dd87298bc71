"""Exact top-k inner-product search by columnar branch and bound.

Vectors become integers, ``floor(64 * x)``. Queries and candidates are dealt into blocks, and each
pair of blocks is one cell of a grid, scored by itself: a query block meets every candidate block
exactly once, nothing is collected and no cell outgrows its two blocks. In a cell, candidates lie
dimension by dimension (columns). Scores are accumulated one block of dimensions after the other for
all pairs still alive; what a pair can still gain is at most the product of the two vectors'
remaining lengths (Cauchy-Schwarz). Pairs that cannot reach their query's k-th best score so far are
dead; as soon as few are left they are compacted, and only they read the further blocks. The k-th best score
starts from a few candidates scored in full, those with the largest scores on the first block. The best
k of each cell meet in a final ranking per query.

Sums are exact: products run in float32 or float64 where no sum can pass 2^24 or 2^53. Vectors with larger
components are scored apart, in integers of any size.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do
those with a component whose 64-fold reaches 2^63 in size; vectors of different lengths are compared as if
padded with zeros; of equal scores the smaller ``vec_id`` comes first; a query skips every row with its
own ``vec_id``; rows with a null ``vec_id`` take no part; a repeated ``vec_id`` is a candidate (or
query) once per row, ranked one after the other. A score beyond a long is the long's end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RESULT = "query_id long, vec_id long, score long, query_row long"


@dataclass(frozen=True)
class SearchSettings:
    k: int = 20
    query_block: int = 1024
    candidate_block: int = 8192
    dimensions: int = 16
    seeds: int = 4
    # Share of a cell's pairs below which they are compacted and followed one by one.
    sparse: float = 0.02


def _matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return np.floor(out * 64)


def search_cell(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, s: SearchSettings) -> tuple:
    """(query index, candidate index, score) of a superset of each query's best k in this cell."""
    # No sum of products of components below this passes 2^53.
    safe = np.sqrt(2.0**52 / max(q.shape[1], 1))
    small_q, small_c = (np.abs(m).max(axis=1, initial=0) <= safe for m in (q, c))
    if small_q.all() and small_c.all():
        return _search_small(q, q_ids, c, c_ids, s)
    found = []
    for rows, columns, search in (
        (small_q, small_c, _search_small), (~small_q, np.ones(len(c), bool), _score_large), (small_q, ~small_c, _score_large)
    ):
        rows, columns = np.flatnonzero(rows), np.flatnonzero(columns)
        if len(rows) and len(columns):
            qi, ci, score = search(q[rows], q_ids[rows], c[columns], c_ids[columns], s)
            found.append((rows[qi], columns[ci], score))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _score_large(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, s: SearchSettings) -> tuple:
    """All pairs, in Python's integers."""
    columns = _integers(c).T
    found = []
    for i, row in enumerate(_integers(q)):
        ci = np.flatnonzero(c_ids != q_ids[i])
        score = np.clip(row @ columns[:, ci], -(1 << 63), (1 << 63) - 1).astype(np.int64) if len(ci) else np.zeros(0, np.int64)
        # Candidates lie by vec_id, so a stable order by score settles ties.
        best = np.sort(np.lexsort((ci, ~score))[: s.k])
        found.append((np.full(len(best), i), ci[best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _integers(m: np.ndarray) -> np.ndarray:
    out = np.empty(m.shape, object)
    out[:] = [[int(x) for x in row] for row in m]
    return out


def _search_small(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, s: SearchSettings) -> tuple:
    """As ``search_cell``, where every sum fits a float64."""
    width = q.shape[1]
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(width, 1)
    kind = np.float32 if exact < 2**24 else np.float64
    q, columns = q.astype(kind), np.ascontiguousarray(c.T.astype(kind))
    own = q_ids[:, None] == c_ids[None, :]

    def rest(m: np.ndarray, start: int) -> np.ndarray:
        # Rounded up, so that the bound never falls short.
        return np.sqrt((m[:, start:].astype(float) ** 2).sum(axis=1) * (1 + 1e-5)).astype(kind)

    score = q[:, : s.dimensions] @ columns[: s.dimensions]
    score[own] = -np.inf
    # k-th best so far: the most promising candidates of the first block, scored in full.
    n = min(s.seeds * s.k, c.shape[0])
    seeds = np.argpartition(score, c.shape[0] - n, axis=1)[:, c.shape[0] - n :]
    full = np.matmul(columns.T[seeds], q[:, :, None])[:, :, 0]
    full[np.take_along_axis(own, seeds, 1)] = -np.inf
    kth = np.sort(full, axis=1)[:, -s.k] if n >= s.k else np.full(len(q), -np.inf, kind)
    least, done = (kth - 1)[:, None], s.dimensions
    while True:
        # All pairs in columns, until few enough are alive to go on with those alone.
        alive = score + np.outer(rest(q, done), rest(c, done)) >= least
        if done >= width or np.count_nonzero(alive) <= s.sparse * alive.size:
            break
        score += q[:, done : done + s.dimensions] @ columns[done : done + s.dimensions]
        done += s.dimensions
    alive &= ~own
    qi, ci = np.nonzero(alive)
    score = score[alive]
    while done < width:
        for d in range(done, min(done + s.dimensions, width)):
            score += q[qi, d] * columns[d][ci]
        done += s.dimensions
        alive = score + rest(q, done)[qi] * rest(c, done)[ci] >= least[qi, 0]
        qi, ci, score = qi[alive], ci[alive], score[alive]
    return qi, ci, score.astype(np.int64)


def top_k(vectors: DataFrame, is_query: F.Column, settings: SearchSettings = SearchSettings()) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest scores among all other rows."""
    s = settings
    x = F.col("embedding")
    # A power of two: the 64-fold of a double is exact or infinite.
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(64 * v.cast("double")) >= float(1 << 63)))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda v: v.cast("double")).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    n, n_queries = rows.agg(F.count("*"), F.count_if("is_query")).first()
    query_blocks = max(1, -(-n_queries // s.query_block))
    candidate_blocks = max(1, -(-n // s.candidate_block))
    spread = lambda blocks: F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = (
        rows.where("is_query")
        .select("vec_id", "v", spread(query_blocks).alias("qb"), F.monotonically_increasing_id().alias("row"))
        .select("vec_id", "v", "row", "qb", every(candidate_blocks).alias("cb"))
    )
    candidates = rows.select("vec_id", "v", spread(candidate_blocks).alias("cb")).select(
        "vec_id", "v", "cb", every(query_blocks).alias("qb")
    )

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "query_row": []}).astype("int64")
        right = right.sort_values("vec_id")
        q_ids, c_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        width = max(left["v"].map(len).max(), right["v"].map(len).max())
        qi, ci, score = search_cell(_matrix(list(left["v"]), width), q_ids, _matrix(list(right["v"]), width), c_ids, s)
        # Candidates lie by vec_id, so a stable order by score settles ties.
        order = np.lexsort((ci, ~score, qi))
        qi, ci, score = qi[order], ci[order], score[order]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        best = place < s.k
        qi, ci = qi[best], ci[best]
        return pd.DataFrame(
            {"query_id": q_ids[qi], "vec_id": c_ids[ci], "score": score[best].astype(np.int64), "query_row": left["row"].to_numpy()[qi]}
        )

    found = queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb")).applyInPandas(cell, RESULT)
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
