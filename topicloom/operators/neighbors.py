"""Exact nearest neighbours and similar pairs by cosine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from topicloom.functions.vectors import to_matrix
from topicloom.operators.blocks import Cells, column_of, pick, steps
from topicloom.operators.centroids import best_columns
from topicloom.session import materialize


def _edge_schema(cells: Cells) -> T.StructType:
    grp, node = cells.points.schema["grp"].dataType, cells.points.schema["id"].dataType
    return T.StructType(
        [
            T.StructField("grp", grp),
            T.StructField("src", node),
            T.StructField("dst", node),
            T.StructField("sim", T.DoubleType()),
        ]
    )


def _sortable(ids: pa.Array) -> np.ndarray:
    values = ids.to_numpy(zero_copy_only=False)
    return np.asarray(values.tolist(), dtype=str) if values.dtype == object else values


class NearestSoFar:
    """The ``count`` most similar points of other blocks for each point of a pack; smaller ids win ties."""

    def __init__(self, count: int, grp: pa.DataType):
        self.count, self.grp_type = count, grp

    def begin(self, grp: object, rows: pa.StructArray, matrix: np.ndarray) -> None:
        self.grp, self.ids, self.matrix = grp, rows.field("id"), matrix
        self.near = np.zeros((len(rows), self.count), _sortable(self.ids).dtype)
        self.sims = np.full((len(rows), self.count), -np.inf)

    def meet(self, rows: pa.StructArray, matrix: np.ndarray, spans: list[tuple[int, int]], own: int | None) -> None:
        names = _sortable(rows.field("id"))
        if not self.count:
            return
        if names.dtype.kind == "U" and names.dtype.itemsize > self.near.dtype.itemsize:
            self.near = self.near.astype(names.dtype)
        for start, stop in steps(spans, len(names)):
            here = self.matrix[start:stop] @ matrix.T
            if own is not None:
                # The rows of this stretch that are rows of the partner.
                mine = np.arange(max(start, own), min(stop, own + len(names)))
                here[mine - start, mine - own] = -np.inf
            # Only what reaches the last one a row has can change its list.
            last = self.sims[start:stop, -1]
            flat = np.flatnonzero(here >= last[:, None])
            at, col = np.divmod(flat, len(names))
            hits = np.bincount(at, minlength=stop - start)
            many = hits > 4 * self.count
            if many.any():
                where, scores = best_columns(here[many], self.count)
                self._take(np.flatnonzero(many) + start, names[where], scores)
                few = ~many[at]
                at, col = at[few], col[few]
            if len(at):
                hit, first, n = np.unique(at, return_index=True, return_counts=True)
                line = np.repeat(np.arange(len(hit)), n)
                rank = np.arange(len(at)) - np.repeat(first, n)
                near, sims = np.zeros((len(hit), n.max()), names.dtype), np.full((len(hit), n.max()), -np.inf)
                near[line, rank], sims[line, rank] = names[col], here[at, col]
                self._take(hit + start, near, sims)

    def _take(self, at: np.ndarray, near: np.ndarray, sims: np.ndarray) -> None:
        """Better entries for the rows at the given places."""
        near, sims = np.hstack([self.near[at], near]), np.hstack([self.sims[at], sims])
        order = np.lexsort((near, -sims), axis=1)[:, : self.count]
        self.near[at], self.sims[at] = np.take_along_axis(near, order, axis=1), np.take_along_axis(sims, order, axis=1)

    def finish(self):
        real = np.isfinite(self.sims)
        rows, place = np.nonzero(real)
        yield pa.RecordBatch.from_arrays(
            [pa.array([self.grp] * len(rows), self.grp_type), pick(self.ids, rows), pa.array(self.near[real].tolist(), self.ids.type), pa.array(self.sims[real]), pa.array((place + 1).astype(np.int32))],
            names=["grp", "src", "dst", "sim", "rank"],
        )


def nearest_neighbors(posts: DataFrame, k: int, block_rows: int | None = None, probes: int | None = None) -> DataFrame:
    """``src, dst, sim, rank``: the ``k - 1`` most similar other posts of each post (a post counts as one of its k).

    Exact without ``probes``: a first pass inside the blocks gives each cell a similarity that partners must reach; the
    second pass meets only the cells that can reach it, and every post gives its neighbours once. With ``probes`` a
    cell meets that many cells at most, the most promising first, and the result is approximate.
    """
    return grouped_neighbors(posts.withColumn("grp", F.lit(0)), k, block_rows, probes).drop("grp")


def grouped_neighbors(posts: DataFrame, k: int, block_rows: int | None = None, probes: int | None = None) -> DataFrame:
    """Nearest neighbours among the posts of the same ``grp``."""
    points = posts.select("grp", F.col("post_id").alias("id"), "embedding")
    cells = Cells(points, block_rows) if block_rows else Cells(points)
    schema = T.StructType([*_edge_schema(cells).fields, T.StructField("rank", T.IntegerType())])
    grp = to_arrow_type(schema["grp"].dataType)
    reducer = lambda: NearestSoFar(k - 1, grp)
    bounds = None
    if len(cells.pivots) > 1:
        inside = cells.streamed(reducer, schema, cells.cell_pairs(own_only=True), diagonal=True)
        reach = inside.groupBy("grp", F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("low"))
        reach = cells.points.select("grp", "id", "cell").join(reach, ["grp", "id"], "left")
        full = F.when(F.col("n") >= k - 1, F.col("low")).otherwise(F.lit(-1.0))
        bounds = materialize(reach.groupBy("grp", "cell").agg(F.min(full).alias("bound")), "bounds")
    return cells.streamed(reducer, schema, cells.cell_pairs(bounds=bounds), probes=probes)


def similar_pairs(points: DataFrame, min_sim: float, limit: int | None = None) -> DataFrame:
    """``a < b`` with cosine at least ``min_sim``; with ``limit`` only the most similar ones.

    Meant for centroid tables, where the pairs are the result. With a limit every block keeps just its own best.
    """
    cells = Cells(points.select(F.lit(0).alias("grp"), F.col("topic").alias("id"), F.col("centroid").alias("embedding")))

    def kernel(a: pa.Table, b: pa.Table, same: bool) -> pa.Table:
        sims = to_matrix(a.column("vec")) @ to_matrix(b.column("vec")).T
        keep = sims >= min_sim
        if same:
            keep &= np.triu(np.ones_like(keep), 1)
        i, j = np.nonzero(keep)
        if limit is not None and len(i) > limit:
            best = np.argsort(-sims[i, j], kind="stable")
            edge = sims[i, j][best[limit - 1]]
            still = sims[i, j] >= edge
            i, j = i[still], j[still]
        left, right = pick(column_of(a, "id"), i), pick(column_of(b, "id"), j)
        return pa.table({"grp": pick(column_of(a, "grp"), i), "src": left, "dst": right, "sim": sims[i, j]})

    found = cells.self_join(kernel, _edge_schema(cells), cells.cell_pairs(min_sim=min_sim))
    pairs = found.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "sim")
    return pairs if limit is None else pairs.orderBy(F.desc("sim"), "a", "b").limit(limit)
