"""Clusters of varying density without a similarity limit: a condensed tree over a minimum spanning forest.

Points are joined by mutual reachability (the larger of their distance and the distances at which each of them has
``min_samples`` neighbours). Taking the forest's edges from short to long, components grow; a cluster is what a
component of at least ``min_cluster_size`` points is between the edge that makes it and the edge that joins it to
another one of that size, and the clusters that last longest over all levels are chosen.

Only clusters are ever handled in one task (at most points / min_cluster_size of them at the bottom). Where a point
enters the tree is found by rounds over components that are still too small, all at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.operators.components import connected_components
from topicloom.operators.density import DensitySetting, number_clusters
from topicloom.operators.forest import climbed, merge_tree, spanning_forest
from topicloom.operators.neighbors import grouped_neighbors
from topicloom.session import discard, materialize

MAX_ROUNDS = 500
# Distances below this count as this much, so that copies do not last for ever.
DISTANCE_FLOOR = 1e-6


def mutual_reachability(near: DataFrame, min_samples: int) -> DataFrame:
    """``a, b, w`` for the pairs of ``src, dst, sim, rank`` neighbours; a point with fewer neighbours takes its last one."""
    # Rounded, so that a distance is the same number from both ends and in every layout of blocks.
    pairs = near.withColumn("d", F.round(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("sim"))), 9))
    core = pairs.where(F.col("rank") <= min_samples).groupBy(F.col("src").alias("id")).agg(F.max("d").alias("core"))
    both = pairs.join(core.withColumnsRenamed({"id": "src", "core": "core_src"}), "src").join(core.withColumnsRenamed({"id": "dst", "core": "core_dst"}), "dst")
    return both.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), F.greatest("d", "core_src", "core_dst").alias("w"))


def _entries(forest: DataFrame, size: int) -> DataFrame:
    """``id, key``: the edge by which the component of a point first has ``size`` points.

    A small component's next merge is its first edge. Two that share their first edge merge with each other; one that
    leads into another component joins it after that one's own merge. So a component is settled by its first edge if it
    and those its first edges lead through have ``size`` points together; the others merge in pairs and try again.
    """
    key = "struct(w, a, b)"
    points = forest.selectExpr("a AS id").union(forest.selectExpr("b AS id")).distinct()
    members = materialize(points.selectExpr("id", "id AS comp"), "entry-members")
    nodes = materialize(members.selectExpr("comp", "1L AS size"), "entry-nodes")
    left = materialize(forest.selectExpr("a", "b", "w", "a AS ca", "b AS cb"), "entry-edges")
    settled = []
    hops = max(1, int(np.ceil(np.log2(size))))
    for _ in range(MAX_ROUNDS):
        ends = left.selectExpr("ca AS comp", f"struct({key} AS key, cb AS to) AS e").union(left.selectExpr("cb AS comp", f"struct({key} AS key, ca AS to) AS e"))
        first = ends.groupBy("comp").agg(F.min("e").alias("e")).join(nodes, "comp").selectExpr("comp", "size", "e.key AS key", "e.to AS to")
        # A target that is no longer a small component has its size already.
        facing = nodes.selectExpr("comp AS to", "size AS to_size")
        first = materialize(first.join(facing, "to", "left"), "entry-first")
        if first.isEmpty():
            break
        back = first.selectExpr("comp AS to", "key AS back_key")
        paired = first.join(back, "to", "left").selectExpr("comp", "size", "key", "to", "to_size", "coalesce(back_key = key, false) AS mutual")
        # A pair goes by its smaller name, has the size of both and leads nowhere.
        chain = materialize(
            paired.selectExpr("comp", "key", "mutual", "if(mutual, least(comp, to), comp) AS name", "if(mutual, size + to_size, size) AS total", "if(mutual, null, to) AS to", f"if(mutual, null, if(to_size IS NULL, {size}L, 0L)) AS more"),
            "entry-chain",
        )
        walk = chain.selectExpr("comp", "total + coalesce(more, 0L) AS total", "if(more > 0, null, to) AS to")
        for _ in range(hops):
            step = walk.selectExpr("comp AS to", "total AS further", "to AS next")
            walk = walk.join(step, "to", "left").selectExpr("comp", f"least(total + coalesce(further, 0L), {size}L) AS total", "next AS to")
        known = materialize(chain.join(walk.selectExpr("comp", f"total >= {size} AS done"), "comp").selectExpr("comp", "name", "key", "total AS size", "done"), "entry-known")
        placed = materialize(members.join(known.select("comp", "name", "key", "done"), "comp"), "entry-placed")
        settled.append(placed.where("done").select("id", "key"))
        before = (members, nodes, left, first, chain)
        live = known.where("NOT done")
        members = materialize(placed.where("NOT done").selectExpr("id", "name AS comp"), "entry-members")
        nodes = materialize(live.selectExpr("name AS comp", "size").distinct(), "entry-nodes")
        renamed = live.selectExpr("comp", "name")
        # Edges between components that are both settled are read no more.
        at_a, at_b = renamed.selectExpr("comp AS ca", "name AS na"), renamed.selectExpr("comp AS cb", "name AS nb")
        turned = left.join(at_a, "ca", "left").join(at_b, "cb", "left").where("(na IS NOT NULL OR nb IS NOT NULL) AND NOT (na <=> nb)")
        left = materialize(turned.selectExpr("a", "b", "w", "coalesce(na, ca) AS ca", "coalesce(nb, cb) AS cb"), "entry-edges")
        for table in before:
            discard(table)
    else:
        raise RuntimeError("small components did not settle")
    found = settled[0] if settled else members.join(nodes, "comp").selectExpr("id", "struct(0D AS w, id AS a, id AS b) AS key")
    for more in settled[1:]:
        found = found.unionByName(more)
    return found


def _homes(points: DataFrame, tree: DataFrame) -> DataFrame:
    """``id, c, lam``: the cluster that each point falls out of, going from long edges to short, and the level at which it does."""
    return climbed(points, tree).selectExpr("id", "c", f"1 / greatest(key.w, {DISTANCE_FLOOR}D) AS lam")


def _chosen(tree: DataFrame, homes: DataFrame, single: bool, grouped: bool) -> DataFrame:
    """``c, choice``: the chosen cluster that cluster ``c`` is or lies in. One row per cluster, in one task."""
    grp = "leaf.grp" if grouped else "if(leaf IS NULL, null, 0)"
    held = homes.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("lam").alias("total"))
    rows = tree.join(held, "c", "left").selectExpr("c", f"{grp} AS grp", "parent", f"1 / greatest(key.w, {DISTANCE_FLOOR}D) AS lam", "coalesce(n, 0L) AS n", "coalesce(total, 0D) AS total")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by("c")
        count = table.num_rows
        parent, n, total = (table.column(c).to_numpy() for c in ("parent", "n", "total"))
        split = np.nan_to_num(table.column("lam").to_numpy())
        born = np.where(parent >= 0, split[parent], 0.0)
        size = n.copy()
        # Children stand before their parents.
        for c in range(count):
            if parent[c] >= 0:
                size[parent[c]] += size[c]
        lasting = total - n * born
        for c in range(count):
            if parent[c] >= 0:
                lasting[parent[c]] += size[c] * (split[parent[c]] - born[parent[c]])
        inside, own = np.zeros(count), np.ones(count, bool)
        # The group of a bottom cluster is that of all above it.
        group = np.nan_to_num(table.column("grp").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False), nan=-1).astype(np.int64)
        for c in range(count):
            if parent[c] >= 0:
                group[parent[c]] = group[c]
        roots = np.bincount(group[parent < 0])
        leaf = np.ones(count, bool)
        leaf[parent[parent >= 0]] = False
        for c in range(count):
            barred = parent[c] < 0 and roots[group[c]] == 1 and not single
            own[c] = not barred and (leaf[c] or lasting[c] >= inside[c])
            if parent[c] >= 0:
                inside[parent[c]] += lasting[c] if own[c] else inside[c]
        choice = np.full(count, -1, np.int64)
        for c in range(count - 1, -1, -1):
            up = choice[parent[c]] if parent[c] >= 0 else -1
            choice[c] = up if up >= 0 else (c if own[c] else -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count, dtype=np.int32)), pa.array(choice.astype(np.int32))], names=["c", "choice"])

    return materialize(rows.coalesce(1).mapInArrow(choose, "c int, choice int"), "choices")


def forest_clusters(forest: DataFrame, min_cluster_size: int, single: bool = False, grouped: bool = False) -> DataFrame:
    """``id, cluster, lam`` for the points of a written ``a, b, w`` forest that are in a chosen cluster; all others are noise.

    ``lam`` is one over the distance at which the point leaves its last cluster. Trees of the forest are clusters of
    their own; where there is but one, it is no answer unless ``single``. With ``grouped`` the ids are structs with a
    field ``grp``, edges stay within groups, and that rule holds for each group. Points that are in no edge are noise.
    """
    if min_cluster_size < 2:
        raise ValueError("min_cluster_size must be 2 or more")
    points = materialize(_entries(forest, min_cluster_size), "entries")
    at_a, at_b = points.selectExpr("id AS a", "key AS key_a"), points.selectExpr("id AS b", "key AS key_b")
    # An edge joins two clusters if both were large enough before it.
    marked = materialize(forest.join(at_a, "a").join(at_b, "b").selectExpr("a", "b", "w", "struct(w, a, b) > greatest(key_a, key_b) AS splits"), "marked-edges")
    bottoms = connected_components(marked.where("NOT splits").selectExpr("0 AS part", "a AS src", "b AS dst")).selectExpr("id", "root AS leaf")
    bottoms = materialize(bottoms, "bottoms")
    ends = bottoms.selectExpr("id AS a", "leaf AS leaf_a"), bottoms.selectExpr("id AS b", "leaf AS leaf_b")
    skeleton = marked.where("splits").join(ends[0], "a").join(ends[1], "b")
    tree = merge_tree(skeleton, bottoms.select("leaf").distinct())
    homes = materialize(_homes(points.join(bottoms, "id"), tree), "homes")
    chosen = _chosen(tree, homes, single, grouped)
    return homes.join(chosen.where("choice >= 0"), "c").selectExpr("id", "choice AS cluster", "lam")


def tree_clusters(edges: DataFrame, min_cluster_size: int, single: bool = False) -> DataFrame:
    """``forest_clusters`` of the minimum spanning forest of ``a, b, w`` edges."""
    return forest_clusters(materialize(spanning_forest(edges), "forest"), min_cluster_size, single)


def tree_runs(posts: DataFrame, settings: Sequence[DensitySetting], near: DataFrame | None = None, grouped: bool = True, single: bool = False) -> DataFrame:
    """``grp, post_id, run, root, size`` like ``density_runs``, from density trees: ``min_sim`` plays no part.

    ``posts`` needs ``grp, post_id, embedding``. Distances are those of unit vectors. The graph joins each post to its
    ``neighbors - 1`` nearest others of its group (``near`` may hold ``grp, src, dst, sim, rank`` already); with as many
    as there are posts the tree is that of all pairs, with fewer the longest edges are left out and far groups of posts
    become separate trees. Neighbours are found once, forests once per ``min_samples``. Without ``grouped`` all posts
    are in one group.
    """
    if near is None:
        near = materialize(grouped_neighbors(posts, max(s.graph_neighbors() for s in settings)), "neighbors")
    name = (lambda c: F.struct("grp", F.col(c).alias("id"))) if grouped else F.col
    runs = None
    forests: dict[tuple[int, int], DataFrame] = {}
    for s in settings:
        k = s.graph_neighbors()
        if (s.min_samples, k) not in forests:
            pairs = near.where(F.col("rank") < k).select(name("src").alias("src"), name("dst").alias("dst"), "sim", "rank")
            forests[s.min_samples, k] = materialize(spanning_forest(mutual_reachability(pairs, s.min_samples)), "forest")
        found = materialize(forest_clusters(forests[s.min_samples, k], s.min_cluster_size, single, grouped), "tree-clusters")
        whole = found.groupBy("cluster").agg(F.min("id").alias("root"), F.count(F.lit(1)).alias("size"))
        grp, plain = (F.col("id.grp"), lambda c: F.col(f"{c}.id")) if grouped else (F.lit(0), F.col)
        one = found.join(whole, "cluster").select(grp.alias("grp"), plain("id").alias("post_id"), F.lit(s.run).alias("run"), plain("root").alias("root"), "size")
        runs = one if runs is None else runs.unionByName(one)
    return runs


def density_tree_labels(posts: DataFrame, settings: Sequence[DensitySetting], near: DataFrame | None = None, single: bool = False) -> DataFrame:
    """``post_id, run, topic`` like ``density_cluster_labels`` (0, 1, ... by size; noise -1) without any similarity limit."""
    base = posts.select("post_id", "embedding").withColumn("grp", F.lit(0))
    found = number_clusters(tree_runs(base, settings, near, grouped=False, single=single)).select("post_id", "run", "topic")
    runs = F.explode(F.array(*[F.lit(s.run) for s in settings])).alias("run")
    return posts.select("post_id", runs).join(found, ["post_id", "run"], "left").withColumn("topic", F.coalesce("topic", F.lit(-1)))
