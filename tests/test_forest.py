"""Spanning forests and density trees against brute force."""

import numpy as np
import pytest

from topicloom.operators.density import DensitySetting
from topicloom.operators.density_tree import density_tree_labels, tree_clusters, tree_runs
from topicloom.operators.forest import spanning_forest


def kruskal(edges):
    root, found = {}, []

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for w, a, b in sorted((w, min(a, b), max(a, b)) for a, b, w in edges if w is not None and a != b):
        if top(a) != top(b):
            root[max(top(a), top(b))] = min(top(a), top(b))
            found.append((a, b, w))
    return sorted(found)


@pytest.mark.parametrize("seed,weights", [(1, 1000), (2, 3), (3, 1)])
def test_forest_equals_kruskal(spark, seed, weights):
    rng = np.random.RandomState(seed)
    edges = [(int(a), int(b), float(w)) for a, b, w in zip(rng.randint(0, 120, 260), rng.randint(0, 120, 260), rng.randint(0, weights, 260))]
    edges += [(i, i + 1, float(i)) for i in range(200, 260)] + [(300, i, 1.0) for i in range(301, 360)] + [(5, 5, 0.0), (1, 2, None)]
    got = spanning_forest(spark.createDataFrame(edges, "a long, b long, w double")).collect()
    assert sorted(map(tuple, got)) == kruskal(edges)


def test_empty_forest(spark):
    assert spanning_forest(spark.createDataFrame([], "a long, b long, w double")).count() == 0


def condensed(edges, m, single=False):
    """Clusters of the condensed tree by recursion over the forest, as sets of points."""
    forest = sorted((w, a, b) for a, b, w in kruskal(edges))
    nodes = {x for _, a, b in forest for x in (a, b)}

    def parts(points, inside):
        near = {p: [] for p in points}
        for _, a, b in inside:
            near[a].append(b)
            near[b].append(a)
        seen, out = set(), []
        for p in sorted(points):
            if p not in seen:
                group, todo = {p}, [p]
                while todo:
                    for q in near[todo.pop()]:
                        if q not in group:
                            group.add(q)
                            todo.append(q)
                seen |= group
                out.append((group, [e for e in inside if e[1] in group]))
        return out

    def lam(w):
        return 1 / max(w, 1e-6)

    def grow(points, inside, born):
        """(stability, chosen clusters) of the cluster that starts as ``points``."""
        total, now, rest = 0.0, set(points), list(inside)
        while rest:
            w, a, b = rest[-1]
            pieces = parts(now, rest[:-1])
            big = [p for p in pieces if len(p[0]) >= m]
            if len(big) == 2:
                total += len(now) * (lam(w) - born)
                below = [grow(*p, lam(w)) for p in big]
                inner = sum(s for s, _ in below)
                return (total, [set(points)]) if total >= inner else (inner, [c for _, cs in below for c in cs])
            lost = now - set().union(*[p[0] for p in big])
            total += len(lost) * (lam(w) - born)
            if not big:
                return total, [set(points)]
            now, rest = big[0]
        raise AssertionError("a cluster of one point")

    trees = [p for p in parts(nodes, forest) if len(p[0]) >= m]
    if len(trees) != 1 or single:
        return [c for p in trees for c in grow(*p, 0.0)[1]]
    # A tree that is alone may be no cluster, so its first split is forced.
    now, rest = trees[0]
    while rest:
        big = [p for p in parts(now, rest[:-1]) if len(p[0]) >= m]
        if len(big) == 2:
            return [c for p in big for c in grow(*p, lam(rest[-1][0]))[1]]
        if not big:
            return []
        now, rest = big[0]
    return []


def reach(x, min_samples):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = u @ u.T
    d = np.sqrt(np.maximum(0, 2 - 2 * sims))
    np.fill_diagonal(d, np.inf)
    core = np.sort(d, axis=1)[:, min_samples - 1]
    d = np.round(d, 9)
    core = np.round(core, 9)
    w = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    return [(a, b, float(w[a, b])) for a in range(len(x)) for b in range(a + 1, len(x))]


def test_tree_equals_brute_force_on_all_pairs(spark):
    rng = np.random.RandomState(8)
    spread = [0.05, 0.1, 0.2, 0.05, 0.3]
    x = np.concatenate([rng.normal(size=6) + s * rng.normal(size=(50, 6)) for s in spread] + [rng.normal(size=(50, 6))])
    posts = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "post_id long, embedding array<double>")
    got = density_tree_labels(posts, [DensitySetting(0, None, 5, 12, len(x))]).toPandas()
    assert len(got) == len(x)
    want = condensed(reach(x, 5), 12)
    assert sorted(map(sorted, want)) == sorted(sorted(g) for t, g in got[got.topic >= 0].groupby("topic").post_id.apply(list).items())
    assert len(want) >= 4 and (got.topic == -1).sum() > 10


@pytest.mark.parametrize("m,single", [(3, False), (4, True)])
def test_tree_of_awkward_graphs(spark, m, single):
    rng = np.random.RandomState(m)
    edges = [(int(a), int(b), float(w)) for a, b, w in zip(rng.randint(0, 60, 140), rng.randint(0, 60, 140), rng.randint(0, 12, 140))]
    edges += [(100 + i, 101 + i, float(i + 1)) for i in range(40)] + [(200, 200 + i, 0.0) for i in range(1, 20)] + [(300, 301, 1.0)]
    edges += [(41, 100, 7.5), (140, 200, 3.5)] if single else []
    got = tree_clusters(spark.createDataFrame(edges, "a long, b long, w double"), m, single).toPandas()
    assert sorted(sorted(g) for g in got.groupby("cluster").id.apply(list)) == sorted(map(sorted, condensed(edges, m, single)))


def test_tree_without_points(spark):
    assert tree_clusters(spark.createDataFrame([], "a long, b long, w double"), 5).count() == 0
    posts = spark.createDataFrame([(1, [1.0, 0.0])], "post_id long, embedding array<double>")
    assert [tuple(r) for r in density_tree_labels(posts, [DensitySetting(0, None, 2, 5)]).collect()] == [(1, 0, -1)]
    with pytest.raises(ValueError):
        tree_clusters(spark.createDataFrame([], "a long, b long, w double"), 1)


def test_trees_of_groups_are_those_of_each_group(spark):
    rng = np.random.RandomState(3)
    blobs = [rng.normal(size=4) + 0.2 * rng.normal(size=(20, 4)) for _ in range(5)]
    groups = {"x": np.concatenate(blobs[:2]), "y": np.concatenate(blobs[2:]), "z": blobs[0][:3]}
    rows = [(g, i, [float(v) for v in row]) for g, x in groups.items() for i, row in enumerate(x)]
    posts = spark.createDataFrame(rows, "grp string, post_id long, embedding array<double>")
    got = tree_runs(posts, [DensitySetting(7, None, 3, 6, 100)]).toPandas()
    for g, x in groups.items():
        mine = got[got.grp == g]
        assert sorted(map(sorted, mine.groupby("root").post_id.apply(list))) == sorted(map(sorted, condensed(reach(x, min(3, len(x) - 1)), 6)))
        assert all(size == (mine.root == root).sum() for root, size in zip(mine.root, mine["size"]))


def test_asked_pairs_equal_a_sequential_walk(spark):
    from topicloom.plans.refinement import asked_pairs

    rng = np.random.RandomState(6)
    pairs = sorted({tuple(sorted(p)) for p in rng.randint(0, 25, (90, 2)).tolist() if p[0] != p[1]}, key=lambda p: hash((p[0] * 7, p[1])))
    rows = [(a, b, i + 1, bool(rng.randint(0, 2))) for i, (a, b) in enumerate(pairs)]
    group, want = {i: i for i in range(25)}, []
    for a, b, rank, merge in rows:
        if group[a] != group[b]:
            want.append(rank)
            if merge:
                group = {k: group[a] if g == group[b] else g for k, g in group.items()}
    got = asked_pairs(spark.createDataFrame(rows, "topic_a int, topic_b int, rank int, merge boolean")).collect()
    assert sorted(r["rank"] for r in got) == want and len(want) < len(rows)
    assert asked_pairs(spark.createDataFrame([(1, 2, 1, False)], "topic_a int, topic_b int, rank int, merge boolean")).count() == 1


def test_dense_ids_equal_row_numbers(spark):
    from topicloom.operators.ranking import dense_ids

    rng = np.random.RandomState(1)
    rows = [(int(a), i) for i, a in enumerate(rng.randint(0, 9, 700))]
    ids = dense_ids(spark.createDataFrame(rows, "a int, b int").repartition(7), ["a", "b"], "n", 10)
    assert "SinglePartition" not in ids._jdf.queryExecution().toString()
    got = {(r.a, r.b): r.n for r in ids.collect()}
    assert [got[k] for k in sorted(rows)] == list(range(10, 710))
    assert dense_ids(spark.createDataFrame([], "a int"), ["a"]).count() == 0
