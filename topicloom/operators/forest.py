"""Minimum spanning forests of large edge tables, and the order in which their edges join groups.

Edges are ordered by weight, then by their ends, so every forest is unique. The forest gathers no component: rounds of
joins and combined minima work on all components at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.session import discard, materialize

MAX_ROUNDS = 200
# Ancestors of a cluster are listed at distances 1, 2, 4, ...
LIFTS = 32


def _pointed(points: DataFrame) -> DataFrame:
    """``comp, root``: where the chains of ``comp, to`` end; of two that point at each other the smaller is the end."""
    back = points.selectExpr("comp AS to", "to AS back")
    ends = points.join(back, "to", "left").selectExpr("comp", "if(back <=> comp AND comp < to, comp, to) AS root")
    table = materialize(ends.selectExpr("comp", "root", "true AS moved"), "pointers")
    while True:
        # Two doublings of all pointers in one job.
        longer = table.select("comp", "root")
        for _ in range(2):
            hop = longer.selectExpr("comp AS root", "root AS next")
            longer = longer.join(hop, "root", "left").selectExpr("comp", "coalesce(next, root) AS root", "next IS NOT NULL AND next <> root AS moved")
        longer = materialize(longer, "pointers")
        discard(table)
        if longer.where("moved").isEmpty():
            return longer.drop("moved")
        table = longer


def spanning_forest(edges: DataFrame) -> DataFrame:
    """``a, b, w`` of the minimum spanning forest of ``a, b, w`` edges (``a < b``; ties by ``a``, ``b``).

    Every round each component takes its first edge to another one, and the components so joined become one; edges
    inside a component are dropped. Repeated edges count with their smallest weight, edges from a node to itself and
    null weights not at all.
    """
    plain = edges.where("a <> b AND w IS NOT NULL").selectExpr("least(a, b) AS a", "greatest(a, b) AS b", "w")
    left = materialize(plain.groupBy("a", "b").agg(F.min("w").alias("w")).selectExpr("a", "b", "w", "a AS ca", "b AS cb"), "forest-edges")
    taken = []
    for _ in range(MAX_ROUNDS):
        ends = left.selectExpr("ca AS comp", "struct(w, a, b, cb AS to) AS e").union(left.selectExpr("cb AS comp", "struct(w, a, b, ca AS to) AS e"))
        first = materialize(ends.groupBy("comp").agg(F.min("e").alias("e")), "first-edges")
        if first.isEmpty():
            break
        # Written, because the first edges of all rounds make up the answer.
        taken.append(first.select("e.a", "e.b", "e.w"))
        roots = _pointed(first.selectExpr("comp", "e.to AS to"))
        # Components without an edge to another one are in no edge that is left, so every end has a root.
        at_a, at_b = roots.selectExpr("comp AS ca", "root AS ra"), roots.selectExpr("comp AS cb", "root AS rb")
        before, left = left, materialize(left.join(at_a, "ca").join(at_b, "cb").where("ra <> rb").selectExpr("a", "b", "w", "ra AS ca", "rb AS cb"), "forest-edges")
        discard(before)
        discard(roots)
    else:
        raise RuntimeError("the spanning forest did not settle")
    found = taken[0] if taken else left.select("a", "b", "w")
    for more in taken[1:]:
        found = found.unionByName(more)
    # Two components may have taken the same edge.
    return found.distinct()


def merge_tree(skeleton: DataFrame, leaves: DataFrame) -> DataFrame:
    """``c, leaf, parent, key, ups``: clusters from the bottom up, by the edges between bottom clusters.

    ``leaf`` names bottom clusters, ``key`` is the edge that joined the two children of the others, ``ups`` the
    ancestors at distances 1, 2, 4, ... One row per cluster, in one task.
    """
    node = leaves.schema["leaf"].dataType
    rows = leaves.selectExpr("leaf", "null AS other", "null AS key").union(skeleton.selectExpr("leaf_a", "leaf_b", "struct(w, a, b)"))
    key = rows.schema["key"].dataType
    schema = T.StructType([T.StructField("c", T.IntegerType()), T.StructField("leaf", node), T.StructField("parent", T.IntegerType()), T.StructField("key", key), T.StructField("ups", T.ArrayType(T.IntegerType()))])

    def plain(name):
        return tuple(name.values()) if isinstance(name, dict) else name

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        edge = np.asarray(table.column("key").is_valid())
        names = sorted(table.column("leaf").filter(pa.array(~edge)).to_pylist(), key=plain)
        joins = table.filter(pa.array(edge)).to_pylist()
        joins.sort(key=lambda r: (r["key"]["w"], plain(r["key"]["a"]), plain(r["key"]["b"])))
        number = {plain(n): i for i, n in enumerate(names)}
        top = list(range(len(names) + len(joins)))
        parent = np.full(len(top), -1, np.int64)

        def root(x: int) -> int:
            while top[x] != x:
                top[x] = x = top[top[x]]
            return x

        for c, row in enumerate(joins, len(names)):
            for side in (row["leaf"], row["other"]):
                child = root(number[plain(side)])
                parent[child] = c
                top[child] = c
        ups, lift = [], parent
        for _ in range(LIFTS):
            if (lift < 0).all():
                break
            ups.append(lift)
            lift = np.where(lift >= 0, lift[lift], -1)
        listed = np.array(ups).T.tolist() if ups else [[] for _ in top]
        yield pa.RecordBatch.from_pylist(
            [{"c": c, "leaf": n, "parent": int(parent[c]), "key": None, "ups": listed[c]} for c, n in enumerate(names)]
            + [{"c": c, "leaf": None, "parent": int(parent[c]), "key": row["key"], "ups": listed[c]} for c, row in enumerate(joins, len(names))],
            schema=pa.schema([("c", pa.int32()), ("leaf", table.schema.field("leaf").type), ("parent", pa.int32()), ("key", table.schema.field("key").type), ("ups", pa.list_(pa.int32()))]),
        )

    return materialize(rows.coalesce(1).mapInArrow(build, schema), "merge-tree")


def climbed(points: DataFrame, tree: DataFrame) -> DataFrame:
    """``id, key, c``: for each point (``id, key, leaf``) the cluster of its leaf once all edges before ``key`` have joined theirs."""
    start = points.join(tree.where("leaf IS NOT NULL").selectExpr("leaf", "c"), "leaf").select("id", "key", "c")
    lifts = tree.agg(F.coalesce(F.max(F.size("ups")), F.lit(0)).alias("n")).first()["n"]
    for i in reversed(range(lifts)):
        # The ancestor 2^i above is the home, or below it, if its children had been joined before the point came.
        above = tree.selectExpr("c", f"ups[{i}] AS up").where("up >= 0").join(tree.selectExpr("c AS up", "key AS joined"), "up")
        start = start.join(above, "c", "left").selectExpr("id", "key", "if(joined < key, up, c) AS c")
    return start
