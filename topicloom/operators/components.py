"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.session import discard, materialize

MAX_ROUNDS = 100


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are disjoint stars: every node points at most once, and no node is both pointer and target."""
    ends = edges.selectExpr("part", "u AS node", "1 AS out", "0 AS into").union(edges.selectExpr("part", "v AS node", "0 AS out", "1 AS into"))
    per_node = ends.groupBy("part", "node").agg(F.expr("sum(out) AS out"), F.expr("max(into) AS into"))
    return per_node.where("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``part, src, dst`` links -> ``part, id, root`` for every linked node; the root is the smallest id.

    Each round points all larger neighbours of a node, then the node itself, at the smallest neighbour. Minima are
    combined before the shuffle and neighbours never gathered, so a hub with most of the links stays cheap. Links that
    are stars already need no round.
    """
    start = links.where("src <> dst").selectExpr("part", "greatest(src, dst) AS u", "least(src, dst) AS v")
    edges = materialize(start.distinct(), "links")
    for _ in range(MAX_ROUNDS):
        if _settled(edges):
            break
        both = edges.union(edges.selectExpr("part", "v AS u", "u AS v"))
        low = both.groupBy("part", "u").agg(F.expr("min(v) AS m")).selectExpr("part", "u", "least(u, m) AS m")
        large = both.where("v > u").join(low, ["part", "u"]).selectExpr("part", "v AS u", "m AS v").distinct()
        least = large.groupBy("part", "u").agg(F.expr("min(v) AS m"))
        down = large.join(least, ["part", "u"]).where("v <> m").selectExpr("part", "v AS u", "m AS v")
        before, edges = edges, materialize(down.union(least.selectExpr("part", "u", "m AS v")).distinct(), "links")
        discard(before)
    else:
        raise RuntimeError("components did not settle")
    members = edges.selectExpr("part", "u AS id", "v AS root")
    return members.union(members.selectExpr("part", "root AS id", "root").distinct())
