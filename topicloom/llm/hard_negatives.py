"""Hard negatives by the threshold algorithm over sorted per-dimension lists.

Rows are dealt evenly into blocks. A block sorts its candidates once per dimension; every anchor reads these lists from
the end its signs prefer, scores each row when it is first seen, and what the last read values would score together
bounds all rows not seen. Blocks stay where they are: the anchors, a small share of the rows, travel to them, first for
their positives, then with the score windows that these span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.session import materialize

BLOCK_ROWS = 4096
# Rows read from each list in the first step; every step reads about half as many again as all before it.
FIRST_READ = 8
# Sums of products below this magnitude are exact in doubles.
EXACT = float(1 << 53)
NULL_ID = np.iinfo(np.int64).max

_ROWS = "block int, turn int, key long, place int, anchor_id long, label long, ids binary, labels binary, wide int, vectors binary, lows array<long>, highs array<long>"
_FOUND = "key long, window int, id long, score long"


def sorted_lists(matrix: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each dimension the given rows, from the smallest component to the largest."""
    return rows[np.argsort(matrix[rows], axis=0, kind="stable").T] if len(rows) else np.zeros((matrix.shape[1], 0), np.int64)


def threshold_scan(matrix: np.ndarray, lists: np.ndarray, query: np.ndarray, skip: np.ndarray, lows: list[int], highs: list[int | None], k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows that hold the best ``k`` of every window, their scores, and how many rows were scored.

    A window takes scores from ``low`` (-inf if None) to ``high`` (unbounded if None). It is done once the bound on all
    unseen rows falls strictly below its k-th score, or below ``low``. ``skip`` marks rows that are no candidates.
    """
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    size = lists.shape[1]
    unseen = ~skip
    left = int(unseen[lists[0]].sum()) if len(lists) else 0
    found, scores, scored = [], [], 0
    low = np.array([-np.inf if x is None else x for x in lows], float)
    high = np.array([np.inf if x is None else x for x in highs], float)
    open_windows = np.ones(len(low), bool)
    depth, end = 0, min(size, FIRST_READ if len(up) or len(down) else size)
    while left and open_windows.any():
        fresh = np.zeros(len(matrix), bool)
        if len(up) or len(down):
            fresh[lists[up, size - end : size - depth]] = True
            fresh[lists[down, depth:end]] = True
        else:
            # A zero anchor prefers no end: every score is 0.
            fresh[lists[0]] = True
        fresh &= unseen
        rows = np.flatnonzero(fresh)
        unseen[rows] = False
        left -= len(rows)
        scored += len(rows)
        found.append(rows)
        scores.append(matrix[rows] @ query)
        all_scores = np.concatenate(scores)
        bound = float(query[up] @ matrix[lists[up, size - end], up]) + float(query[down] @ matrix[lists[down, end - 1], down])
        for w in np.flatnonzero(open_windows):
            inside = all_scores[(all_scores >= low[w]) & (all_scores <= high[w])]
            kth = np.partition(inside, len(inside) - k)[len(inside) - k] if len(inside) >= k else -np.inf
            open_windows[w] = not (bound < kth or bound < low[w])
        depth, end = end, min(size, end + max(1, end // 2))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    return np.concatenate(found), np.concatenate(scores).astype(np.int64), scored


def _blocks(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float, block_rows: int) -> tuple[DataFrame, int]:
    """Rows of ``_ROWS`` with turn 0, one per block, written to the shared folder, and their number."""
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(NULL_ID))).alias("id"), F.col(label_col).cast("bigint").alias("label"), v.alias("v")).where(F.col("label").isNotNull() & fine)
    parts = max(1, -(-rows.count() // block_rows))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, labels, mats = [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("v")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            matrix = np.zeros((len(sizes), max(1, int(sizes.max()))))
            matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
            ids.append(batch.column("id").to_numpy())
            labels.append(batch.column("label").to_numpy())
            mats.append(matrix)
        if not ids:
            return
        wide = max(m.shape[1] for m in mats)
        matrix = np.vstack([np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in mats])
        if float(np.abs(matrix).max()) ** 2 * wide >= EXACT:
            raise ValueError("components are too large for exact integer scores")
        kept = matrix.astype(np.int16 if np.abs(matrix).max() < 1 << 15 else np.int32 if np.abs(matrix).max() < 1 << 31 else np.int64)
        body = bytes([kept.dtype.itemsize]) + kept.tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([0], pa.int32()), *(pa.nulls(1, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())),
             pa.array([np.concatenate(ids).tobytes()], pa.binary()), pa.array([np.concatenate(labels).tobytes()], pa.binary()), pa.array([wide], pa.int32()), pa.array([body], pa.binary()),
             pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int64()))],
            names=[c.split()[0] for c in _ROWS.split(", ")],
        )

    return materialize(rows.repartition(parts).mapInArrow(build, _ROWS), "mining-blocks"), parts


def _matrix(body: bytes, wide: int) -> np.ndarray:
    return np.frombuffer(body, f"<i{body[0]}", offset=1).reshape(-1, wide)


def _anchors(blocks: DataFrame, every: int) -> DataFrame:
    """Rows of ``_ROWS`` with turn 1: one per row whose id is divisible by ``every``; key is block and place."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                matrix = _matrix(row["vectors"], row["wide"])
                at = np.flatnonzero((ids % every == 0) & (ids != NULL_ID))
                n = len(at)
                none = pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["block"], np.int32)), pa.array(np.ones(n, np.int32)), pa.array((row["block"] << 32) + at), pa.array(at.astype(np.int32)), pa.array(ids[at]), pa.array(labels[at]),
                     pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.array(np.full(n, row["wide"], np.int32)),
                     pa.array([row["vectors"][:1] + matrix[i].tobytes() for i in at], pa.binary()), none, none],
                    names=batch.schema.names,
                )

    return materialize(blocks.mapInArrow(pick, _ROWS), "mining-anchors")


def _visits(blocks: DataFrame, anchors: DataFrame, parts: int, k: int, same_label: bool) -> DataFrame:
    """``_FOUND`` of every block: the best ``k`` rows of each window of each anchor, of its own label or of other ones."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["turn"] == 0:
                    now = {"block": row["block"], "ids": np.frombuffer(row["ids"], np.int64), "labels": np.frombuffer(row["labels"], np.int64), "m": _matrix(row["vectors"], row["wide"]).astype(float), "lists": {}}
                    continue
                if now is None or now["block"] != row["block"]:
                    continue  # a partition that held no rows has no block
                m, labels, d = now["m"], now["labels"], now["m"].shape[1]
                query = np.zeros(max(d, row["wide"]))
                query[: row["wide"]] = _matrix(row["vectors"], row["wide"])[0]
                query = query[:d]
                own = labels == row["label"]
                of = row["label"] if same_label else None
                if of not in now["lists"]:
                    now["lists"][of] = sorted_lists(m, np.flatnonzero(own) if same_label else np.arange(len(m)))
                skip = ~own if same_label else own.copy()
                if row["key"] >> 32 == row["block"]:
                    skip[row["place"]] = True
                lows, highs = row["lows"] or [None], row["highs"] or [None]
                rows, scores, _ = threshold_scan(m, now["lists"][of], query, skip, lows, highs, k)
                for w, (low, high) in enumerate(zip(lows, highs)):
                    inside = np.flatnonzero((scores >= low) & (scores <= high)) if low is not None else np.arange(len(rows))
                    best = inside[np.lexsort((now["ids"][rows[inside]], -scores[inside]))[:k]]
                    out.append((np.full(len(best), row["key"]), np.full(len(best), w, np.int32), now["ids"][rows[best]], scores[best]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["key", "window", "id", "score"])

    sent = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = blocks.unionByName(sent).repartition(parts, "block").sortWithinPartitions("block", "turn", "key")
    return met.mapInArrow(scan, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each key and window, with their rank from 1; ties by id."""
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_negatives(
    vectors: DataFrame, positives: int = 5, k: int = 5, every: int = 100, scale: float = 256.0, low: int = 80, high: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank.

    Components become floor(scale * x), a score is the integer inner product with the anchor, higher ones come first
    and ties go to the smaller id (null last). Anchors are the rows whose id is divisible by ``every``; an anchor's
    positives are its first ``positives`` other rows of the same label, and each positive gets the first ``k`` rows of
    other labels with low * positive_score <= 100 * score <= high * positive_score (all, if fewer; none where nothing
    lies in the window, as with negative positive scores). Rows whose label or vector is null, or whose vector holds a
    null or non-finite component, take no part. Shorter vectors count as padded with zeros, empty ones as all zero.
    Repeated rows and ids are rows of their own: each is an anchor, a positive and a negative for itself, and only the
    row itself is left out. An empty table gives no rows. Other columns are ignored. Scores have to stay below 2^53 in
    magnitude (an error otherwise). Labels are whole numbers. The result does not depend on ``block_rows``.
    """
    blocks, parts = _blocks(vectors, id_col, vector_col, label_col, scale, block_rows)
    anchors = _anchors(blocks, every)
    near = materialize(_best(_visits(blocks, anchors, parts, positives, True), positives), "mining-positives")
    # The smallest and the largest whole score of a window: -(-x) rounded down is x rounded up.
    down = lambda x: f"(({x}) - pmod({x}, 100)) div 100"
    ends = F.sort_array(F.collect_list(F.struct("rank", F.expr(f"-({down(f'{-low} * score')})").alias("low"), F.expr(down(f"{high} * score")).alias("high"))))
    spans = near.groupBy("key").agg(ends.alias("e")).select("key", F.col("e.low").alias("lows"), F.col("e.high").alias("highs"))
    asking = anchors.drop("lows", "highs").join(spans, "key")
    met = _best(_visits(blocks, asking, parts, k, False), k)
    owners = near.join(anchors.select("key", "anchor_id"), "key").select("key", "anchor_id", F.col("rank").alias("positive_rank"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    rows = met.withColumn("positive_rank", F.col("window") + 1).join(owners, ["key", "positive_rank"])
    real = lambda c: F.when(F.col(c) != F.lit(int(NULL_ID)), F.col(c))
    return rows.select("anchor_id", real("positive_id").alias("positive_id"), "rank", real("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), "positive_rank")


MINING_SQL = """WITH v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
c AS (SELECT r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(e, lambda x: floor(256 * x)::BIGINT) AS e FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM c a JOIN c ON a.r <> c.r WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s WHERE same QUALIFY place <= 5),
n AS (SELECT p.r, p.anchor_id, p.place, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s ON p.r = s.r AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
