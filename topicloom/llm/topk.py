"""Exact top-k by inner product with the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from topicloom.llm import blocks

# Rows read from each list in the first step; every further step reads as many as all before it together.
FIRST_READ = 64
# Largest magnitude of a sum of products that doubles hold exactly.
EXACT = float(1 << 52)


def _lists(matrix: np.ndarray) -> bytes:
    """For each dimension the rows of the block from the smallest component to the largest."""
    return np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32).tobytes()


def threshold_scan(block: dict, query: np.ndarray, skip: int, kth: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block that can be among the best ``k``, with their exact scores.

    Each list is read from the end that the query's sign prefers. Rows seen for the first time are scored at once;
    what the last read values would score together bounds every unseen row. Reading stops when that bound is below the
    k-th score, the one known before (``kth``) included; a bound equal to it could still hide a tie.
    """
    lists, m, n = block["extra"], block["m"], block["n"]
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    unseen = np.ones(n, bool)
    if skip >= 0:
        unseen[skip] = False
    if not len(up) and not len(down):
        # All scores are 0 and only ids decide, so every row has to be looked at.
        rows = np.flatnonzero(unseen)
        return rows, np.zeros(len(rows), np.int64)
    found, scores, depth, end = np.zeros(0, np.int64), np.zeros(0), 0, min(n, FIRST_READ)
    low = -np.inf if kth is None else float(kth)
    while True:
        fresh = np.zeros(n, bool)
        fresh[lists[up, n - end : n - depth]] = True
        fresh[lists[down, depth:end]] = True
        fresh &= unseen
        rows = np.flatnonzero(fresh)
        if len(rows):
            unseen[rows] = False
            # Gathering most rows costs more than one pass over the block.
            got = (m @ query)[rows] if 4 * len(rows) > n else m[rows] @ query
            found, scores = np.concatenate([found, rows]), np.concatenate([scores, got])
            if len(scores) >= k:
                low = max(low, float(np.partition(scores, len(scores) - k)[len(scores) - k]))
            keep = scores >= low
            found, scores = found[keep], scores[keep]
        bound = float(query[up] @ m[lists[up, n - end], up]) + float(query[down] @ m[lists[down, end - 1], down])
        if bound < low or end == n:
            return found, scores.astype(np.int64)
        depth, end = end, min(n, 2 * end)


def top_k_search(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = blocks.BLOCK_ROWS, query_rows: int = blocks.QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for every vector whose id is divisible by ``every``.

    Components become floor(scale * x); the score is their integer inner product, ties go to the smaller id (null
    last), and a query's own row is no candidate. Vectors that are null or hold null or non-finite components take no
    part. Shorter vectors count as padded with zeros, empty ones as all zero. Repeated ids or rows are candidates of
    their own and queries of their own. Scores have to stay below 2^52 in magnitude (an error otherwise). Blocks of the table
    are cut to ``block_rows`` rows and pass packs of ``query_rows`` queries; the result does not depend on either.
    """

    def prepare(matrix: np.ndarray) -> tuple[np.ndarray, bytes]:
        whole = np.floor(matrix * scale)
        if len(whole) and float(np.abs(whole).max()) ** 2 * whole.shape[1] >= EXACT:
            raise ValueError("components are too large for exact integer scores")
        return whole, _lists(whole)

    def unpack(extra: bytes, n: int, d: int) -> np.ndarray:
        return np.frombuffer(extra, np.int32).reshape(d, n)

    def look(block: dict, query: np.ndarray, skip: int, kth: int | None) -> tuple[np.ndarray, np.ndarray]:
        return threshold_scan(block, query, skip, kth, k)

    packed = blocks.pack(blocks.usable(vectors, id_col, vector_col), prepare, block_rows, "topk-blocks")
    return blocks.search(packed, "float64", every, k, "int64", look, unpack, query_rows)


TOPK_SQL = """WITH v AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
c AS (SELECT r, vec_id, list_transform(e, lambda x: floor(64 * x)::BIGINT) AS e FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM c q JOIN c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM k WHERE rank <= 20"""
