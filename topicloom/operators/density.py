"""Density clustering with noise on the cosine similarity graph, for many settings and many groups at once.

A post is a core of a setting when at least ``min_samples`` other posts of its group have similarity ``min_sim`` or
more. Clusters are the connected cores; other posts join their most similar core if it is near enough; clusters of
fewer than ``min_cluster_size`` posts become noise. Blocks return counts and spanning links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from topicloom.functions.vectors import to_matrix
from topicloom.operators.blocks import Cells, pick, steps
from topicloom.operators.components import connected_components
from topicloom.operators.neighbors import _sortable
from topicloom.operators.ranking import dense_ids
from topicloom.session import materialize


@dataclass(frozen=True)
class DensitySetting:
    """One parameter choice; ``run`` names it in the result.

    Without ``min_sim`` clusters come from a density tree over the ``neighbors`` nearest posts (itself among them).
    """

    run: int
    min_sim: float | None
    min_samples: int
    min_cluster_size: int
    neighbors: int | None = None

    def graph_neighbors(self) -> int:
        return max(self.min_samples + 1, self.neighbors or 2 * self.min_samples + 1)


class CountsSoFar:
    """How many other points reach each similarity limit (rising), per point of a pack."""

    def __init__(self, limits: Sequence[float], grp: pa.DataType):
        self.limits, self.grp_type = limits, grp

    def begin(self, grp: object, rows: pa.StructArray, matrix: np.ndarray) -> None:
        self.grp, self.ids, self.matrix = grp, rows.field("id"), matrix
        self.counts = np.zeros((len(self.limits), len(rows)), np.int64)

    def meet(self, rows: pa.StructArray, matrix: np.ndarray, spans: list[tuple[int, int]], own: int | None) -> None:
        for start, at, _, sims in _near(self.matrix, matrix, spans, own, self.limits[0]):
            for i, limit in enumerate(self.limits):
                some = np.bincount(at if not i else at[sims >= limit])
                self.counts[i, start : start + len(some)] += some

    def finish(self):
        yield pa.RecordBatch.from_arrays(
            [pa.array([self.grp] * len(self.ids), self.grp_type), self.ids, *(pa.array(c) for c in self.counts)],
            names=["grp", "id", *(f"c{i}" for i in range(len(self.limits)))],
        )


def _near(mine: np.ndarray, matrix: np.ndarray, spans: list[tuple[int, int]], own: int | None, limit: float):
    """``start, row - start, column, similarity`` of the pairs that reach ``limit``, stretch by stretch; no row meets itself."""
    for start, stop in steps(spans, len(matrix)):
        sims = mine[start:stop] @ matrix.T
        if own is not None:
            same = np.arange(max(start, own), min(stop, own + len(matrix)))
            sims[same - start, same - own] = -np.inf
        flat = np.flatnonzero(sims >= limit)
        at, col = np.divmod(flat, len(matrix))
        yield start, at, col, sims.ravel()[flat]


def _joined(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Flat parents (of the smallest place) once the places ``x`` and ``y`` are joined pair by pair."""
    while True:
        x, y = parent[x], parent[y]
        apart = x != y
        if not apart.any():
            return parent
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent[parent] != parent).any():
            parent = parent[parent]


class LinksSoFar:
    """Links that connect what the pairs of cores connect, and for posts at the border their best core, per setting.

    Links inside a pack are kept as a forest and given at the end; to a partner goes one link for each of its cores.
    """

    def __init__(self, settings: Sequence[DensitySetting], grp: pa.DataType, node: pa.DataType):
        self.settings, self.grp_type, self.node_type = settings, grp, node

    def begin(self, grp: object, rows: pa.StructArray, matrix: np.ndarray) -> None:
        self.grp, self.ids, self.matrix = grp, rows.field("id"), matrix
        self.core = to_matrix(rows.field("core")) > 0
        self.parent = [np.arange(len(rows)) for _ in self.settings]
        self.lowest = min(s.min_sim for s in self.settings)
        names = _sortable(self.ids)
        self.best = [np.full(len(rows), -np.inf) for _ in self.settings]
        self.at = [np.zeros(len(rows), names.dtype) for _ in self.settings]

    def meet(self, rows: pa.StructArray, matrix: np.ndarray, spans: list[tuple[int, int]], own: int | None):
        ids, core = rows.field("id"), to_matrix(rows.field("core")) > 0
        names, own_names = _sortable(ids), None
        first = np.full((len(self.settings), len(rows)), -1)
        edge_sim = np.full((len(self.settings), len(rows)), -np.inf)
        edge_row = np.zeros((len(self.settings), len(rows)), np.int64)
        for start, at, col, sims in _near(self.matrix, matrix, spans, own, self.lowest):
            row = at + start
            for i, setting in enumerate(self.settings):
                reach = sims >= setting.min_sim
                a, b = self.core[row, i], core[col, i]
                r, c = row[reach & a & b], col[reach & a & b]
                if own is not None:
                    self.parent[i] = _joined(self.parent[i], r, c + own)
                elif len(r):
                    fresh = first[i, c] < 0
                    first[i, c[fresh][::-1]] = r[fresh][::-1]
                    self.parent[i] = _joined(self.parent[i], r, first[i, c])
                touch = reach & ~a & b
                if touch.any():
                    self._border(i, row[touch], sims[touch], names[col[touch]])
                touch = reach & a & ~b
                if touch.any():
                    own_names = _sortable(self.ids) if own_names is None else own_names
                    r, c, s = row[touch], col[touch], sims[touch]
                    if own is not None:
                        self._border(i, c + own, s, own_names[r])
                        continue
                    r, c, s = np.concatenate([r, edge_row[i, np.unique(c)]]), np.concatenate([c, np.unique(c)]), np.concatenate([s, edge_sim[i, np.unique(c)]])
                    order = np.lexsort((own_names[r], -s, c))
                    order = order[np.concatenate([[True], np.diff(c[order]) != 0])]
                    edge_row[i, c[order]], edge_sim[i, c[order]] = r[order], s[order]
        for i, setting in enumerate(self.settings):
            linked = np.flatnonzero(first[i] >= 0)
            if len(linked):
                yield self._batch(setting.run, pick(ids, linked), pick(self.ids, first[i, linked]), None)
            edge = np.flatnonzero(np.isfinite(edge_sim[i]))
            if len(edge):
                yield self._batch(setting.run, pick(ids, edge), pick(self.ids, edge_row[i, edge]), edge_sim[i, edge])

    def _border(self, i: int, row: np.ndarray, sims: np.ndarray, names: np.ndarray) -> None:
        """The best core so far of posts at the border: the most similar, then the smallest id."""
        order = np.lexsort((names, -sims, row))
        order = order[np.concatenate([[True], np.diff(row[order]) != 0])]
        row, sims, names = row[order], sims[order], names[order]
        if names.dtype.kind == "U" and names.dtype.itemsize > self.at[i].dtype.itemsize:
            self.at[i] = self.at[i].astype(names.dtype)
        better = (sims > self.best[i][row]) | ((sims == self.best[i][row]) & (names < self.at[i][row]))
        self.best[i][row[better]], self.at[i][row[better]] = sims[better], names[better]

    def finish(self):
        for i, setting in enumerate(self.settings):
            moved = np.flatnonzero(self.parent[i] != np.arange(len(self.ids)))
            if len(moved):
                yield self._batch(setting.run, pick(self.ids, moved), pick(self.ids, self.parent[i][moved]), None)
            edge = np.flatnonzero(np.isfinite(self.best[i]))
            if len(edge):
                yield self._batch(setting.run, pick(self.ids, edge), pa.array(self.at[i][edge].tolist(), self.node_type), self.best[i][edge])

    def _batch(self, run: int, src: pa.Array, dst: pa.Array, sim: np.ndarray | None) -> pa.RecordBatch:
        n = len(src)
        sims = pa.nulls(n, pa.float64()) if sim is None else pa.array(sim, pa.float64())
        columns = [pa.array(np.full(n, run), pa.int32()), pa.array([self.grp] * n, self.grp_type), src, dst, sims]
        return pa.RecordBatch.from_arrays(columns, names=["run", "grp", "src", "dst", "sim"])


def threshold_links(points: DataFrame, min_sim: float, block_rows: int | None = None) -> DataFrame:
    """``part, src, dst``: links that connect the same points as all pairs of one ``grp`` with similarity ``min_sim`` or more.

    ``points`` needs ``grp, id, embedding``. A pack gives a forest of its points and one link at most for each point of
    a partner, so the links grow with the points and not with the pairs.
    """
    cells = Cells(points, block_rows) if block_rows else Cells(points)
    grp, node = cells.points.schema["grp"], cells.points.schema["id"]
    every = cells.points.withColumn("core", F.array(F.lit(1.0).cast("float")))
    types = to_arrow_type(grp.dataType), to_arrow_type(node.dataType)
    one = [DensitySetting(0, min_sim, 0, 0)]
    found = cells.streamed(lambda: LinksSoFar(one, *types), _link_schema(grp, node), cells.cell_pairs(min_sim=min_sim), once=True, points=every)
    return found.select(F.col("grp").alias("part"), "src", "dst")


def _link_schema(grp: T.StructField, node: T.StructField) -> T.StructType:
    ends = [T.StructField("src", node.dataType), T.StructField("dst", node.dataType), T.StructField("sim", T.DoubleType())]
    return T.StructType([T.StructField("run", T.IntegerType()), grp, *ends])


def density_runs(posts: DataFrame, settings: Sequence[DensitySetting], block_rows: int | None = None) -> DataFrame:
    """``grp, post_id, run, root``: the cluster of each post per setting by its smallest core; noise has no row.

    ``posts`` needs ``grp, post_id, embedding``. Two passes over the blocks serve every setting.
    """
    points = posts.select("grp", F.col("post_id").alias("id"), "embedding")
    cells = Cells(points, block_rows) if block_rows else Cells(points)
    grp, node = cells.points.schema["grp"], cells.points.schema["id"]
    limits = sorted({s.min_sim for s in settings})
    pairs = cells.cell_pairs(min_sim=limits[0])

    counts_schema = T.StructType([grp, node] + [T.StructField(f"c{i}", T.LongType()) for i in range(len(limits))])
    # One row per post, whatever the number of blocks.
    grp_type = to_arrow_type(grp.dataType)
    degree = cells.streamed(lambda: CountsSoFar(limits, grp_type), counts_schema, pairs)
    flags = F.array(*[(F.col(f"c{limits.index(s.min_sim)}") >= s.min_samples).cast("float") for s in settings])
    flagged = materialize(cells.points.join(degree.select("grp", "id", flags.alias("core")), ["grp", "id"]), "cores")

    link_schema = _link_schema(grp, node)
    node_type = to_arrow_type(node.dataType)
    found = cells.streamed(lambda: LinksSoFar(settings, grp_type, node_type), link_schema, pairs, once=True, points=flagged)
    links = materialize(found, "density-links")

    # The same id may appear in several groups, so a component lives in one (run, grp).
    part = F.struct("run", "grp")
    trees = connected_components(links.where(F.col("sim").isNull()).select(part.alias("part"), "src", "dst"))
    trees = trees.select("part.run", "part.grp", F.col("id"), "root")
    numbered = F.explode(F.arrays_zip(F.array(*[F.lit(s.run) for s in settings]).alias("run"), F.col("core").alias("on")))
    cores = flagged.select("grp", "id", numbered.alias("s")).where(F.col("s.on") > 0).select(F.col("s.run").alias("run"), "grp", "id")
    rooted = cores.join(trees, ["run", "grp", "id"], "left").withColumn("root", F.coalesce("root", "id"))
    # Best core per border post: the highest similarity, then the smallest core id.
    border = links.where(F.col("sim").isNotNull()).groupBy("run", "grp", F.col("src").alias("id")).agg(
        F.max("sim").alias("sim")
    )
    ties = links.where(F.col("sim").isNotNull()).select("run", "grp", F.col("src").alias("id"), "dst", "sim")
    border = border.join(ties, ["run", "grp", "id", "sim"]).groupBy("run", "grp", "id").agg(F.min("dst").alias("core"))
    border = border.join(rooted.withColumnRenamed("id", "core"), ["run", "grp", "core"]).select("run", "grp", "id", "root")
    members = materialize(rooted.select("run", "grp", "id", "root").unionByName(border), "members")

    sizes = members.groupBy("run", "grp", "root").agg(F.count(F.lit(1)).alias("size"))
    floors = _setting_table(cells.spark, settings)
    kept = sizes.join(F.broadcast(floors), "run").where(F.col("size") >= F.col("min_cluster_size"))
    kept = kept.select("run", "grp", "root", "size")
    return members.join(kept, ["run", "grp", "root"]).select("grp", F.col("id").alias("post_id"), "run", "root", "size")


def _setting_table(spark, settings: Sequence[DensitySetting]) -> DataFrame:
    rows = [(s.run, float(s.min_sim), s.min_samples, s.min_cluster_size) for s in settings]
    return spark.createDataFrame(rows, "run int, min_sim double, min_samples int, min_cluster_size int")


def number_clusters(members: DataFrame) -> DataFrame:
    """Adds ``topic``: 0, 1, … per (run, grp) by size, largest first, then smallest root."""
    sizes = members.groupBy("run", "grp", "root").agg(F.first("size").alias("size")).withColumn("minus", -F.col("size"))
    ids = dense_ids(sizes, ["run", "grp", "minus", "root"], "place").select("run", "grp", "root", "place")
    first = ids.groupBy("run", "grp").agg(F.min("place").alias("first"))
    ids = ids.join(first, ["run", "grp"]).select("run", "grp", "root", (F.col("place") - F.col("first")).cast("int").alias("topic"))
    return members.join(ids, ["run", "grp", "root"])


def density_cluster_labels(posts: DataFrame, settings: Sequence[DensitySetting], block_rows: int | None = None) -> DataFrame:
    """``post_id, run, topic`` with noise as -1 for every setting over all posts."""
    base = posts.select("post_id", "embedding").withColumn("grp", F.lit(0))
    found = number_clusters(density_runs(base, settings, block_rows)).select("post_id", "run", "topic")
    runs = F.explode(F.array(*[F.lit(s.run) for s in settings])).alias("run")
    everyone = posts.select("post_id", runs)
    return everyone.join(found, ["post_id", "run"], "left").withColumn("topic", F.coalesce("topic", F.lit(-1)))
