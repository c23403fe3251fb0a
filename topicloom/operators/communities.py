"""Modularity communities of a similarity graph, as rounds of joins and aggregates over its edges."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.operators.components import connected_components
from topicloom.operators.ranking import dense_ids
from topicloom.session import discard, materialize, merged

# A level ends after PATIENCE rounds in a row that gain less than MIN_GAIN; the best moves go first, so a weak round
# tells that the rest is weak. Searches that reach MAX_ROUNDS or MAX_LEVELS while they still gain say so in a warning.
MIN_GAIN = 1e-4
PATIENCE = 1
# Nor is a round worth much that gains less than this share of what its level has gained; the next level gains more.
LEVEL_SHARE = 0.01
# Joins with tables of at least this many rows shuffle both sides: what all rounds broadcast would pass the driver.
SHUFFLED_ROWS = 4096
MAX_ROUNDS = 60
MAX_LEVELS = 20


def simple_graph(neighbors: DataFrame) -> DataFrame:
    """One weighted edge per pair of neighbours (``a < b``); weight is the similarity."""
    edges = _ordered(neighbors).groupBy("a", "b").agg(F.max("sim").alias("w"))
    return edges.where(F.col("w") > 0)


def multi_graph(neighbors: DataFrame) -> DataFrame:
    """Edges of weight 1 for one-sided neighbours and 2 for mutual ones."""
    return _ordered(neighbors).groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("w"))


def _ordered(neighbors: DataFrame) -> DataFrame:
    return neighbors.where(F.col("src") != F.col("dst")).select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "sim")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), "w").unionByName(
        edges.select(F.col("b").alias("src"), F.col("a").alias("dst"), "w")
    )


def modularity(edges: DataFrame, members: DataFrame) -> DataFrame:
    """One row ``q``: modularity of ``id, comm`` on ``a, b, w`` edges."""
    ends = edges.join(members.select(F.col("id").alias("a"), F.col("comm").alias("comm_a")), "a").join(
        members.select(F.col("id").alias("b"), F.col("comm").alias("comm_b")), "b"
    )
    inside = ends.agg(F.sum(F.when(F.col("comm_a") == F.col("comm_b"), F.col("w")).otherwise(0.0)).alias("inside"), F.sum("w").alias("m"))
    halves = ends.select(F.explode(F.array("comm_a", "comm_b")).alias("comm"), "w").groupBy("comm").agg(F.sum("w").alias("tot"))
    return inside.join(F.broadcast(halves.agg(F.sum(F.col("tot") * F.col("tot")).alias("squares")))).select(
        (F.col("inside") / F.col("m") - F.col("squares") / (4 * F.col("m") * F.col("m"))).alias("q")
    )


def _roles(state: DataFrame) -> DataFrame:
    """``name, takes`` for the communities that nodes want to leave or enter: what its best such move asks of each.

    The best move of all is always possible, and no community gives and takes nodes in the same round.
    """
    wishes = state.where("wants")
    sides = wishes.selectExpr("comm AS name", "struct(lead, id, false AS takes) AS wish").union(wishes.selectExpr("target AS name", "struct(lead, id, true AS takes) AS wish"))
    return sides.groupBy("name").agg(F.max("wish").alias("wish")).selectExpr("name", "wish.takes AS takes")


def _side(nodes: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """How a side of a join that has about a row per node is joined."""
    return merged if nodes.count() >= SHUFFLED_ROWS else (lambda side: side)


def _local_moves(edges: DataFrame, nodes: DataFrame, total: float, min_gain: float, patience: int, max_rounds: int, refine: bool = False, trace: list[float] | None = None) -> tuple[DataFrame, float]:
    """Move nodes between communities until modularity settles; the state reached (``id, loop, deg, comm``) and its modularity.

    ``edges``: ``src, dst, w`` both ways. ``nodes``: ``id, loop, deg, comm``. In a round a community either gives or
    takes nodes, whichever its best move asks for, so nodes never swap places and those a node moves to stay where they
    are. Only nodes next to a move, or that still want to move, are looked at again; once these settle, all are
    looked at once more. A round after which modularity is lower is taken back and tried with half of its moves.

    With ``refine`` the nodes also have ``held`` (weight to the community that is being refined) and ``whole`` (its
    total degree): only nodes that are still alone and well connected to that community move, to well-connected groups.
    """
    more = ["held", "whole"] if refine else []
    nodes = materialize(nodes.selectExpr("id", "loop", "deg", "comm", *more, "0D AS inside", "true AS active"), "community-nodes")
    side = _side(nodes)
    full, idle, retries = True, 0, 0
    kept, kept_q, began = None, None, None
    for _ in range(max_rounds):
        sums = ["sum(deg) AS tot", "count(1) AS n", *(["sum(held - inside) AS out", "first(whole) AS around"] if refine else [])]
        totals = nodes.groupBy(F.col("comm").alias("near")).agg(*map(F.expr, sums))
        asked = nodes.where("active").selectExpr("id AS src", "deg", "comm", *more)
        met = edges.join(side(asked.select("src")), "src").join(side(nodes.selectExpr("id AS dst", "comm AS near")), "dst").select("src", "near", "w")
        options = met.union(asked.selectExpr("src", "comm AS near", "0D AS w")).groupBy("src", "near").agg(F.expr("sum(w) AS k"))
        gain = f"round(k - deg * (tot - if(near = comm, deg, 0D)) / {total!r}D, 10)"
        open_to = f"out >= tot * (around - tot) / {total!r}D" if refine else "true"
        ready = f"held >= deg * (whole - deg) / {total!r}D" if refine else "true"
        scored = options.join(side(totals), "near").join(side(asked), "src").selectExpr("src", "near", "k", "n", "near = comm AS here", f"{gain} AS gain", f"near <> comm AND {open_to} AS fits", f"{ready} AS ready")
        choice = scored.groupBy("src").agg(
            *map(
                F.expr,
                (
                    "min(if(fits, struct(-gain AS minus, near), null)) AS best",
                    "max(if(here, gain, null)) AS stay",
                    "max(if(here, k, null)) AS inside_now",
                    "max(if(here, n, null)) AS n",
                    "first(ready) AS ready",
                ),
            )
        )
        free = "ready AND n = 1" if refine else "ready"
        wants = f"coalesce(-best.minus > stay AND {free}, false)"
        seen_state = nodes.join(side(choice.withColumnRenamed("src", "id")), "id", "left").selectExpr(
            "id", "loop", "deg", "comm", *more, "if(active, inside_now, inside) AS inside", f"{wants} AS wants", "best.near AS target", "-best.minus - stay AS lead"
        )
        state = materialize(seen_state, "community-moves")
        per = state.groupBy("comm").agg(*map(F.expr, ("sum(inside + loop) AS within", "sum(deg) AS tot", "count_if(wants) AS wants")))
        seen = per.selectExpr("sum(within) AS within", "sum(tot * tot) AS squares", "sum(wants) AS wants").first()
        q = (seen["within"] or 0.0) / total - (seen["squares"] or 0.0) / (total * total)
        discard(nodes)
        if kept_q is not None and q < kept_q:
            # Too many moves at once: back to the state before, with fewer of them.
            discard(state)
            retries += 1
            if retries > 8:
                break
            nodes = _next_nodes(kept, edges, f"pmod(xxhash64(id, {retries}), {1 << retries}) = 0", more, False, side)
            continue
        if trace is not None:
            trace.append(q)
        if kept is not None:
            discard(kept)
        began = q if began is None else began
        idle = idle + 1 if kept_q is not None and q - kept_q < max(min_gain, LEVEL_SHARE * (q - began)) else 0
        kept, kept_q, retries = state, q, 0
        if idle >= patience or (not seen["wants"] and full):
            break
        full = not seen["wants"]
        nodes = _next_nodes(state, edges, "true", more, full, side)
    else:
        if idle == 0:
            warnings.warn(f"communities still change after {max_rounds} rounds", stacklevel=2)
    return kept.selectExpr("id", "loop", "deg", "comm"), kept_q


def _next_nodes(state: DataFrame, edges: DataFrame, among: str, more: list[str], full: bool, side: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The nodes after the moves; active are those that moved, their neighbours, and those that could not move yet.

    Without wishes there are no moves, and with ``full`` all nodes are active.
    """
    if full:
        after = state
    else:
        roles = _roles(state)
        own, there = roles.where("NOT takes").selectExpr("name AS comm", "true AS gives"), roles.where("takes").selectExpr("name AS target", "takes")
        moved = f"coalesce(wants AND gives AND takes AND {among}, false)"
        after = state.join(side(own), "comm", "left").join(side(there), "target", "left").selectExpr("id", "loop", "deg", f"if({moved}, target, comm) AS comm", *more, "inside", f"{moved} AS moved", "wants")
    if full:
        return materialize(after.selectExpr("id", "loop", "deg", "comm", *more, "inside", "true AS active"), "community-nodes")
    touched = edges.join(side(after.where("moved").selectExpr("id AS src")), "src").selectExpr("dst AS id").distinct().withColumn("near_move", F.lit(True))
    return materialize(after.join(side(touched), "id", "left").selectExpr("id", "loop", "deg", "comm", *more, "inside", "moved OR wants OR near_move IS NOT NULL AS active"), "community-nodes")


def _within(edges: DataFrame, members: DataFrame) -> DataFrame:
    """``part, src, dst, w``: the edges whose ends are in the same community of ``id, comm``."""
    side = _side(members)
    at_src = members.select(F.col("id").alias("src"), F.col("comm").alias("part"))
    at_dst = members.select(F.col("id").alias("dst"), F.col("comm").alias("part_dst"))
    return edges.join(side(at_src), "src").join(side(at_dst), "dst").where(F.col("part") == F.col("part_dst")).select("part", "src", "dst", "w")


def _refined(edges: DataFrame, state: DataFrame, total: float, limits: tuple[float, int, int]) -> DataFrame:
    """``id, loop, deg, comm, sub``: the nodes of each community grouped anew, starting alone, along its own edges only."""
    side = _side(state)
    inside = materialize(_within(edges, state).select("src", "dst", "w"), "inside")
    held = inside.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("held"))
    whole = state.groupBy("comm").agg(F.sum("deg").alias("whole"))
    alone = state.join(side(held), "id", "left").join(side(whole), "comm").selectExpr("id", "loop", "deg", "id AS comm", "coalesce(held, 0D) AS held", "whole")
    parts, _ = _local_moves(inside, alone, total, *limits, refine=True)
    return materialize(state.join(side(parts.select("id", F.col("comm").alias("sub"))), "id"), "refined")


def communities(
    nodes: DataFrame,
    edges: DataFrame,
    connected: bool = False,
    min_gain: float = MIN_GAIN,
    patience: int = PATIENCE,
    max_rounds: int = MAX_ROUNDS,
    max_levels: int = MAX_LEVELS,
    trace: list[float] | None = None,
) -> DataFrame:
    """``id, comm`` for every node of ``nodes`` (``id``) on ``a, b, w`` edges.

    Local moves, then contraction to one node per community, until modularity stops growing. With ``connected`` the
    nodes of each community are grouped anew inside it first, well-connected ones only, and those groups are
    contracted; they start the next level in their community and may leave it. In the end single nodes may move once
    more, and communities are cut into their connected parts. Nodes without edges stay alone. ``trace`` gets the modularity after every round; it never falls.
    """
    limits = (min_gain, patience, max_rounds)
    base = materialize(edges, "graph")
    whole = links = materialize(_both_ways(base), "links")
    total = links.agg(F.coalesce(F.sum("w"), F.lit(0.0)).alias("t")).first()["t"]
    everyone = materialize(nodes.select("id").distinct(), "nodes")
    side = _side(everyone)
    members = everyone.withColumn("node", F.col("id"))
    answer = everyone.withColumn("comm", F.col("id"))
    if not total:
        return answer
    degree = links.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("deg"))
    level = everyone.join(side(degree), "id", "left").select(
        "id", F.lit(0.0).alias("loop"), F.coalesce("deg", F.lit(0.0)).alias("deg"), F.col("id").alias("comm")
    )
    level = bottom = materialize(level, "level")
    last_q = None
    for _ in range(max_levels):
        state, q = _local_moves(links, level, total, *limits, trace=trace)
        if last_q is not None and q - last_q < min_gain:
            break
        last_q = q
        state = _refined(links, state, total, limits) if connected else state.withColumn("sub", F.col("comm"))
        placed = members.join(side(state.select(F.col("id").alias("node"), "comm", "sub")), "node")
        placed = materialize(placed.select("id", "comm", F.col("sub").alias("node")), "members")
        answer, members = placed.select("id", "comm"), placed.select("id", "node")
        at_src, at_dst = (state.select(F.col("id").alias(side), F.col("sub").alias(f"c_{side}")) for side in ("src", "dst"))
        summed = links.join(side(at_src), "src").join(side(at_dst), "dst").groupBy("c_src", "c_dst").agg(F.sum("w").alias("w"))
        summed = materialize(summed, "contracted")
        inner = summed.where(F.col("c_src") == F.col("c_dst")).select(F.col("c_src").alias("id"), F.col("w").alias("inner"))
        grown = state.groupBy(F.col("sub").alias("id")).agg(F.sum("loop").alias("loop"), F.sum("deg").alias("deg"), F.min("comm").alias("comm"))
        # A community is named by one of the nodes that make it up now.
        names = grown.groupBy("comm").agg(F.min("id").alias("name"))
        grown = grown.join(side(names), "comm").join(side(inner), "id", "left")
        level = materialize(
            grown.select("id", (F.col("loop") + F.coalesce("inner", F.lit(0.0))).alias("loop"), "deg", F.col("name").alias("comm")), "level"
        )
        links = summed.where(F.col("c_src") != F.col("c_dst")).select(F.col("c_src").alias("src"), F.col("c_dst").alias("dst"), "w")
        if links.isEmpty():
            break
    else:
        warnings.warn(f"communities still grow after {max_levels} levels", stacklevel=2)
    # Single nodes once more, from where the levels left them: groups that moved as one may hold some that belong elsewhere.
    settled, _ = _local_moves(whole, bottom.drop("comm").join(side(answer), "id"), total, *limits, trace=trace)
    answer = settled.select("id", "comm")
    if not connected:
        return answer
    roots = connected_components(_within(whole, answer).select("part", "src", "dst")).select("id", "root")
    return materialize(answer.join(side(roots), "id", "left").select("id", F.coalesce("root", "id").alias("comm")), "connected")


def number_communities(members: DataFrame) -> DataFrame:
    """``post_id, topic``: communities numbered from 0 by size, largest first, then smallest member."""
    sizes = members.groupBy("comm").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low")).withColumn("minus", -F.col("size"))
    ids = dense_ids(sizes, ["minus", "low"], "topic").select("comm", "topic")
    return members.join(ids, "comm").select(F.col("id").alias("post_id"), "topic")
