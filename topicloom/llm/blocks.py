"""Vectors packed into blocks, and query blocks that meet every block of the table one after the other."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.session import materialize

BLOCK_ROWS = 8192
QUERY_ROWS = 256
# Bytes of blocks that a task passes to its packs, and the tasks that share the packs, unless each gets more than MOST_PACKS.
GROUP_BYTES = 32 << 20
PACK_TASKS = 24
MOST_PACKS = 16
# Stands for a null id, so that it comes last among ties.
NULL_ID = np.iinfo(np.int64).max

_BLOCK = "block long, n int, d int, ids binary, vectors binary, extra binary"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (array of double) of the rows whose vector is not null and has only finite components."""
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(NULL_ID))).alias("id"), v.alias("v")).where(fine)


def pack(rows: DataFrame, prepare: Callable[[np.ndarray], tuple[np.ndarray, bytes]], block_rows: int = BLOCK_ROWS, name: str = "blocks") -> DataFrame:
    """id, v -> one row per block of at most ``block_rows`` vectors, written to the shared folder.

    ``prepare`` turns the double matrix of a block into the matrix to keep and whatever is to travel with it. Rows are
    dealt round robin, so equal vectors or ids do not meet in one block. Shorter vectors count as padded with zeros.
    """
    parts = max(1, -(-rows.count() // block_rows))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def emit(ids: list, parts: list, number: int) -> pa.RecordBatch:
            wide = max(p.shape[1] for p in parts)
            matrix = np.vstack([np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in parts])
            kept, extra = prepare(matrix)
            key = (TaskContext.get().partitionId() << 20) + number
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int64()), pa.array([len(flat)], pa.int32()), pa.array([kept.shape[1]], pa.int32()), pa.array([flat.tobytes()], pa.binary()), pa.array([np.ascontiguousarray(kept).tobytes()], pa.binary()), pa.array([extra], pa.binary())],
                names=["block", "n", "d", "ids", "vectors", "extra"],
            )

        ids, mats, held, number = [], [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, min(block_rows - held, batch.num_rows - at))
                at += piece.num_rows
                held += piece.num_rows
                lists = piece.column("v").to_numpy(zero_copy_only=False)
                wide = max(len(x) for x in lists)
                matrix = np.zeros((len(lists), max(1, wide)))
                for i, x in enumerate(lists):
                    matrix[i, : len(x)] = x
                ids.append(piece.column("id").to_numpy())
                mats.append(matrix)
                if held == block_rows:
                    yield emit(ids, mats, number)
                    ids, mats, held, number = [], [], 0, number + 1
        if held:
            yield emit(ids, mats, number)

    return materialize(rows.repartition(parts).mapInArrow(build, _BLOCK), name)


def search(
    blocks: DataFrame,
    dtype: str,
    every: int,
    k: int,
    score_type: str,
    look: Callable[[dict, np.ndarray, np.ndarray, float], tuple[np.ndarray, np.ndarray]],
    unpack: Callable[[bytes, int, int], object],
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of the table for each vector whose id is divisible by ``every``.

    Every group of blocks meets every share of the packs in a task of its own. Blocks are read where they were written
    and never copied for a pack; they pass each pack one by one, and only the best ``k`` of every query are kept, then
    the best of all groups. ``look(block, query, skip, kth)`` returns rows of the block and their scores: at least all
    that can still beat ``kth``, without the row ``skip``.
    """

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                matrix = np.frombuffer(row["vectors"], dtype).reshape(row["n"], row["d"])
                asked = np.flatnonzero((ids % every == 0) & (ids != NULL_ID))
                for start in range(0, len(asked), query_rows):
                    some = asked[start : start + query_rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(row["block"] << 20) + start], pa.int64()), pa.array([row["block"]], pa.int64()), pa.array([some.astype(np.int64).tobytes()], pa.binary()), pa.array([ids[some].tobytes()], pa.binary()), pa.array([matrix[some].tobytes()], pa.binary()), pa.array([row["d"]], pa.int32())],
                        names=["pack", "home", "places", "asked", "wanted", "wide"],
                    )

    packs = materialize(blocks.mapInArrow(queries, "pack long, home long, places binary, asked binary, wanted binary, wide int"), "query-packs")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if now is None or row["pack"] != now["pack"]:
                    if now is not None:
                        yield shown(now, best)
                    places = np.frombuffer(row["places"], np.int64)
                    now = {"pack": row["pack"], "places": (row["home"] << 20) + places, "asked": np.frombuffer(row["asked"], np.int64)}
                    best = [(np.zeros(0, np.int64), np.zeros(0, score_type)) for _ in now["asked"]]
                n, d = row["n"], row["d"]
                block = {"n": n, "d": d, "ids": np.frombuffer(row["ids"], np.int64), "m": np.frombuffer(row["vectors"], dtype).reshape(n, d), "extra": unpack(row["extra"], n, d)}
                places = np.frombuffer(row["places"], np.int64)
                wanted = np.frombuffer(row["wanted"], dtype).reshape(len(places), row["wide"])
                if row["wide"] != d:
                    both = max(d, row["wide"])
                    wanted = np.pad(wanted, ((0, 0), (0, both - row["wide"])))[:, :d]
                for q in range(len(places)):
                    ids, scores = best[q]
                    kth = scores[-1] if len(scores) == k else None
                    at, got = look(block, wanted[q], places[q] if row["home"] == row["block"] else -1, kth)
                    if len(at):
                        ids, scores = np.concatenate([ids, block["ids"][at]]), np.concatenate([scores, got])
                        order = np.lexsort((ids, -scores))[:k]
                        best[q] = (ids[order], scores[order])
        if now is not None:
            yield shown(now, best)

    def shown(now: dict, best: list) -> pa.RecordBatch:
        sizes = [len(ids) for ids, _ in best]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(now["places"], sizes)), pa.array(np.repeat(now["asked"], sizes)), pa.array(np.concatenate([ids for ids, _ in best])), pa.array(np.concatenate([s for _, s in best]))],
            names=["place", "query_id", "vec_id", "score"],
        )

    # A task holds one group at a time. Its blocks keep their order, on which an approximate search depends.
    size = blocks.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("ids") + F.octet_length("vectors") + F.octet_length("extra")), F.lit(0)).alias("bytes")).first()
    asked = packs.count()
    groups = min(max(1, size["n"]), -(-size["bytes"] // GROUP_BYTES) or 1)
    shares = max(1, min(asked, max(PACK_TASKS, -(-asked // MOST_PACKS))))
    grouped = blocks.repartitionByRange(groups, "block").sortWithinPartitions("block").withColumn("turn", F.monotonically_increasing_id())
    met = packs.repartition(shares).hint("shuffle_replicate_nl").crossJoin(grouped)
    number = "long" if score_type == "int64" else "double"
    found = met.mapInArrow(scan, f"place long, query_id long, vec_id long, score {number}")
    # Zeros of either sign are equal scores.
    best_first = Window.partitionBy("place").orderBy((F.col("score") + F.lit(0).cast(number)).desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(int(NULL_ID))).alias("vec_id"), "score")
