"""Approximate nearest neighbours by counting collisions in sorted one-dimensional projections."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm import blocks

PROJECTIONS = 48
# Width of a window at radius 1, and the factor by which radii grow (virtual rehashing: the arrays stay, windows widen).
WIDTH = 2.72
GROWTH = 1.3
# First radius, as a share of the common length of the vectors.
FIRST_RADIUS = 0.2
# Share of the projections in which a vector must fall into the window before it is verified. A vector at the current
# radius collides in 0.83 of them on average.
THRESHOLD = 0.76
SEED = 29


def directions(d: int, count: int, seed: int) -> np.ndarray:
    """``count`` unit directions in ``d`` dimensions, orthogonal within each run of ``d``; the same on every machine."""
    made = []
    rng = np.random.RandomState(seed)
    while sum(x.shape[1] for x in made) < count:
        made.append(np.linalg.qr(rng.standard_normal((d, d)))[0])
    # Orthonormal columns have components of 1 / sqrt(d) of a Gaussian one; this brings them back to unit variance.
    return np.hstack(made)[:, :count] * np.sqrt(d)


def collision_scan(block: dict, query: np.ndarray, skip: int, kth: float | None, k: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block that collide with the query often enough, with their exact inner products.

    All vectors are lifted to one length, so the largest inner product is the smallest distance. Windows around the
    query's projections grow by a factor per round, only newly covered rows are counted, and rows past the threshold
    are verified. The search ends when the distance of the k-th best lies within the radius that the windows stand
    for, or the windows cover the block. A k-th score known from other blocks (``kth``) sets the first radius.
    """
    e, n = block["extra"], block["n"]
    order, placed, top = e["order"], e["sorted"], e["top"]
    count = len(order)
    need = max(1, int(np.ceil(threshold * count)))
    length = float(np.sqrt(np.sum(query * query)))

    def apart(score: float) -> float:
        return float(np.sqrt(max(0.0, 2.0 * top * top - 2.0 * score * top / length)))

    # The query scaled to the common length; its lifted component is zero.
    at = (query @ e["plane"][:-1]) * (top / length)
    hits, unseen = np.zeros(n, np.int64), np.ones(n, bool)
    if skip >= 0:
        unseen[skip] = False
    left = right = None
    found, scores = np.zeros(0, np.int64), np.zeros(0)
    bound = kth
    radius = FIRST_RADIUS * top if kth is None else max(FIRST_RADIUS * top, apart(kth))
    while True:
        half = 0.5 * WIDTH * radius
        low = [int(np.searchsorted(placed[j], at[j] - half)) for j in range(count)]
        high = [int(np.searchsorted(placed[j], at[j] + half)) for j in range(count)]
        if left is None:
            pieces = [order[j, low[j] : high[j]] for j in range(count)]
        else:
            pieces = [order[j, low[j] : left[j]] for j in range(count)] + [order[j, right[j] : high[j]] for j in range(count)]
        left, right = low, high
        hits += np.bincount(np.concatenate(pieces), minlength=n)
        rows = np.flatnonzero((hits >= need) & unseen)
        if len(rows):
            unseen[rows] = False
            found = np.concatenate([found, rows])
            # Row by row sums, so that equal vectors get equal scores wherever they stand.
            scores = np.concatenate([scores, np.sum(block["m"][rows] * query, axis=1)])
            if len(scores) >= k:
                best = float(np.partition(scores, len(scores) - k)[len(scores) - k])
                bound = best if kth is None else max(best, kth)
        if bound is not None and apart(bound) <= radius or min(b - a for a, b in zip(left, right)) >= n:
            return found, scores
        radius *= GROWTH


def nearest_neighbours(vectors: DataFrame, k: int = 20, every: int = 20, projections: int = PROJECTIONS, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = blocks.BLOCK_ROWS, query_rows: int = blocks.QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for every vector whose id is divisible by ``every``.

    Nearest is the largest inner product of the original vectors, in double precision; ties go to the smaller id (null
    last). Vectors that are null, zero, empty or hold null or non-finite components take no part, and a query's own
    row is no candidate. Shorter vectors count as padded with zeros; repeated ids or rows are rows of their own. Every
    other row is indexed. With fewer than ``k`` candidates all are returned. The index holds, per block, the rows in
    the order of each projection.
    """
    usable = blocks.usable(vectors, id_col, vector_col).where(F.exists("v", lambda x: x != 0))

    def prepare(matrix: np.ndarray) -> tuple[np.ndarray, bytes]:
        squares = np.sum(matrix * matrix, axis=1)
        top = float(np.sqrt(squares.max()))
        lifted = np.hstack([matrix, np.sqrt(np.maximum(0.0, top * top - squares))[:, None]])
        plane = directions(matrix.shape[1] + 1, projections, SEED)
        placed = lifted @ plane
        order = np.argsort(placed, axis=0, kind="stable").T.astype(np.int32)
        return matrix, order.tobytes() + np.float64(top).tobytes()

    def unpack(extra: bytes, n: int, d: int) -> dict:
        order = np.frombuffer(extra, np.int32, count=projections * n).reshape(projections, n)
        return {"order": order, "top": float(np.frombuffer(extra[-8:], np.float64)[0]), "plane": directions(d + 1, projections, SEED)}

    def look(block: dict, query: np.ndarray, skip: int, kth: float | None) -> tuple[np.ndarray, np.ndarray]:
        e = block["extra"]
        if "sorted" not in e:
            m = block["m"]
            squares = np.sum(m * m, axis=1)
            lifted = np.hstack([m, np.sqrt(np.maximum(0.0, e["top"] ** 2 - squares))[:, None]])
            e["sorted"] = np.take_along_axis((lifted @ e["plane"]).T, e["order"], axis=1)
        return collision_scan(block, query, skip, kth, k, threshold)

    packed = blocks.pack(usable, prepare, block_rows, "ann-blocks")
    return blocks.search(packed, "float64", every, k, "float64", look, unpack, query_rows)
