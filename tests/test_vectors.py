"""Similarity, clustering, comparison and refinement against brute force on small inputs."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topicloom.operators.agreement import clustering_metrics, compare_clusterings, consensus, jaccard, map_to_base
from topicloom.operators.anchors import assign_anchors
from topicloom.operators.blocks import PACKS, Cells
from topicloom.operators.centroids import nearest_topic, reassign_noise, top_n_topics, topic_centroids
from topicloom.operators.communities import communities, modularity
from topicloom.operators.components import connected_components
from topicloom.operators.density import DensitySetting, density_cluster_labels, threshold_links
from topicloom.operators.neighbors import nearest_neighbors, similar_pairs
from topicloom.operators.split import _packed, _round, split_topics
from topicloom.operators.ward import ward_groups, ward_merges
from topicloom.plans.refinement import asked_pairs, refine

VEC = "post_id long, embedding array<float>"


def table(spark, matrix, topics=None, first=0):
    rows = [(first + i, [float(x) for x in v]) + ((int(topics[i]),) if topics is not None else ()) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, VEC + (", topic int" if topics is not None else ""))


def blobs(seed=3, centers=6, per=40, dim=8, spread=0.25):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(centers, dim))
    points = np.concatenate([b + spread * rng.normal(size=(per, dim)) for b in base])
    return points[rng.permutation(len(points))].astype(np.float32)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_top_n(spark):
    posts = table(spark, [[1, 0], [0, 1]])
    centers = spark.createDataFrame([(10, [1.0, 0.0]), (20, [0.0, 1.0])], "topic int, centroid array<double>")
    rows = top_n_topics(posts, centers, 1).orderBy("post_id").collect()
    assert [r["top_n_topics"] for r in rows] == [[10], [20]]
    assert all(r["top_n_scores"][0] > 0.9 for r in rows)


@pytest.mark.parametrize("size", [40, 100, 1 << 20])
def test_top_n_in_passes_keeps_every_row(spark, size):
    x = blobs()
    posts = table(spark, x, np.arange(len(x)) % 23)
    centers = topic_centroids(posts).collect()
    units = {r["topic"]: np.array(r["centroid"]) / np.linalg.norm(r["centroid"]) for r in centers}
    # Ids that repeat or are missing are rows like any other.
    odd = posts.withColumn("post_id", F.when(F.col("post_id") % 3 == 0, None).when(F.col("post_id") % 3 == 1, 1).otherwise(F.col("post_id")))
    got = top_n_topics(odd.withColumn("at", F.col("embedding")), topic_centroids(posts), 4, keep=("post_id", "at"), shipped_bytes=size).collect()
    assert len(got) == len(x)
    for r in got:
        sims = {t: float(np.dot(u, r["at"]) / max(np.linalg.norm(r["at"]), 1e-300)) for t, u in units.items()}
        best = sorted(sims, key=lambda t: (-round(sims[t], 12), t))[:4]
        assert np.allclose(r["top_n_scores"], [sims[t] for t in best]) and len(set(r["top_n_topics"])) == 4


def test_no_topics_and_zero_vectors(spark):
    posts = table(spark, [[0, 0], [1, 0]], [-1, -1])
    assert [r["top_n_topics"] for r in top_n_topics(posts, topic_centroids(posts), 3).collect()] == [[], []]
    centers = spark.createDataFrame([(3, [1.0, 0.0])], "topic int, centroid array<double>")
    got = {r["post_id"]: r["score_near"] for r in nearest_topic(posts, centers).collect()}
    assert got == {0: 0.0, 1: 1.0}
    assert {r["topic"] for r in reassign_noise(posts, topic_centroids(posts), 0.1).collect()} == {-1}


def test_noise_takes_the_nearest_topic(spark):
    posts = table(spark, [[0, 1], [0, 1]], [-1, 0])
    centers = spark.createDataFrame([(0, [0.0, 1.0])], "topic int, centroid array<double>")
    got = {r["post_id"]: r["topic"] for r in reassign_noise(posts, centers, 1.0).collect()}
    assert got == {0: 0, 1: 0}


@pytest.mark.parametrize("block_rows", [1000, 64, 17])
def test_neighbours_match_brute_force(spark, block_rows):
    x = blobs()
    sims = unit(x.astype(float)) @ unit(x.astype(float)).T
    np.fill_diagonal(sims, -np.inf)
    want = np.argsort(-sims, axis=1, kind="stable")[:, :5]
    got = {(r["src"], r["rank"]): r["dst"] for r in nearest_neighbors(table(spark, x), 6, block_rows).collect()}
    assert got == {(i, j + 1): int(want[i, j]) for i in range(len(x)) for j in range(5)}


@pytest.mark.parametrize("block_rows", [64, 17])
def test_neighbour_rows_do_not_grow_with_blocks(spark, block_rows):
    x = blobs()
    found = nearest_neighbors(table(spark, x), 6, block_rows)
    assert found.count() == 5 * len(x)
    some = nearest_neighbors(table(spark, x), 6, block_rows, probes=8)
    exact, near = ({(r["src"], r["dst"]) for r in rows.collect()} for rows in (found, some))
    assert len(exact & near) / len(exact) >= 0.9 and some.count() <= 5 * len(x)


@pytest.mark.parametrize("once, most", [(False, PACKS), (True, PACKS / 2 + 1)])
def test_copies_of_a_row_do_not_grow_with_blocks(spark, once, most):
    class Arrivals:
        """Counts the rows of its own and those it was sent."""

        def begin(self, grp, rows, matrix):
            self.own, self.sent = len(rows), 0

        def meet(self, rows, matrix, spans, own):
            self.sent += len(rows)

        def finish(self):
            yield pa.RecordBatch.from_arrays([pa.array([self.own], pa.int64()), pa.array([self.sent], pa.int64())], names=["own", "sent"])

    x = blobs(per=100)
    points = table(spark, x).select(F.lit(0).alias("grp"), F.col("post_id").alias("id"), "embedding")
    cells = Cells(points, 4)
    assert cells.points.select("cell", "part").distinct().count() > 5 * PACKS
    got = cells.streamed(Arrivals, "own long, sent long", cells.cell_pairs(), once=once).agg(F.sum("own"), F.sum("sent")).first()
    assert got[0] == len(x) and got[1] <= most * len(x)


@pytest.mark.parametrize("block_rows", [1000, 17])
def test_threshold_links_connect_what_pairs_connect(spark, block_rows):
    x = blobs(per=30, spread=0.5)
    sims = unit(x.astype(float)) @ unit(x.astype(float)).T
    pairs = [(i, j) for i, j in itertools.combinations(range(len(x)), 2) if sims[i, j] >= 0.8]
    points = table(spark, x).select(F.lit(0).alias("grp"), F.col("post_id").alias("id"), "embedding")
    links = [(r["src"], r["dst"]) for r in threshold_links(points, 0.8, block_rows).collect()]
    assert roots(links, range(len(x))) == roots(pairs, range(len(x)))
    assert all(sims[a, b] >= 0.8 or roots(pairs, range(len(x)))[a] == roots(pairs, range(len(x)))[b] for a, b in links)
    assert len(links) <= (PACKS / 2 + 1) * len(x) and (block_rows < 1000 or len(links) < len(x) < len(pairs))


def test_neighbours_with_text_ids(spark):
    x = blobs(per=6)
    named = table(spark, x).withColumn("post_id", F.format_string("p%03d", "post_id"))
    plain = {(f"p{r['src']:03d}", r["rank"]): f"p{r['dst']:03d}" for r in nearest_neighbors(table(spark, x), 4, 10).collect()}
    assert {(r["src"], r["rank"]): r["dst"] for r in nearest_neighbors(named, 4, 10).collect()} == plain


def test_cells_rule_out_pairs(spark):
    x = blobs(spread=0.02)
    cells = Cells(table(spark, x).select(F.lit(0).alias("grp"), F.col("post_id").alias("id"), "embedding"), 30)
    every, some = cells.cell_pairs().count(), cells.cell_pairs(min_sim=0.95).count()
    assert some < every and cells.points.groupBy("cell", "part").count().agg(F.max("count")).first()[0] <= 60


def test_similar_pairs(spark):
    x = blobs(per=4)
    points = table(spark, x).select(F.col("post_id").alias("topic"), F.col("embedding").alias("centroid"))
    sims = unit(x.astype(float)) @ unit(x.astype(float)).T
    want = {(i, j) for i, j in itertools.combinations(range(len(x)), 2) if sims[i, j] >= 0.8}
    assert {(r["a"], r["b"]) for r in similar_pairs(points, 0.8).collect()} == want
    best = sorted(itertools.combinations(range(len(x)), 2), key=lambda p: (-sims[p], p))[:7]
    assert [(r["a"], r["b"]) for r in similar_pairs(points, -1.0, 7).collect()] == best


def roots(links, nodes):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


@pytest.mark.parametrize("kind", ["path", "star", "random", "cycle"])
def test_components(spark, kind):
    rng = np.random.default_rng(5)
    n = 120
    links = {
        "path": [(int(a), int(b)) for a, b in itertools.pairwise(rng.permutation(n))],
        "star": [(60, i) for i in range(n) if i != 60],
        "random": [tuple(int(v) for v in rng.integers(0, n, 2)) for _ in range(80)],
        "cycle": [(i, (i + 1) % n) for i in range(n)],
    }[kind]
    df = spark.createDataFrame([(p, a, b) for p in ("x", "y") for a, b in links], "part string, src long, dst long")
    nodes = {v for a, b in links if a != b for v in (a, b)}
    want = roots([l for l in links if l[0] != l[1]], nodes)
    got = {(r["part"], r["id"]): r["root"] for r in connected_components(df).collect()}
    assert got == {(p, k): v for p in ("x", "y") for k, v in want.items()}


def dense_brute(x, s):
    sims = unit(x.astype(float)) @ unit(x.astype(float)).T
    np.fill_diagonal(sims, -np.inf)
    near = sims >= s.min_sim
    core = near.sum(axis=1) >= s.min_samples
    ids = np.nonzero(core)[0].tolist()
    root = roots([(i, j) for i in ids for j in ids if near[i, j]], ids)
    for i in range(len(x)):
        if not core[i] and (near[i] & core).any():
            root[i] = root[int(np.argmax(np.where(near[i] & core, sims[i], -np.inf)))]
    sizes = {}
    for r in root.values():
        sizes[r] = sizes.get(r, 0) + 1
    kept = sorted((r for r in sizes if sizes[r] >= s.min_cluster_size), key=lambda r: (-sizes[r], r))
    number = {r: k for k, r in enumerate(kept)}
    return [number.get(root.get(i), -1) for i in range(len(x))]


@pytest.mark.parametrize("block_rows", [1000, 31])
def test_density_matches_brute_force(spark, block_rows):
    x = blobs(spread=0.45)
    settings = [DensitySetting(0, 0.9, 4, 3), DensitySetting(1, 0.8, 6, 10), DensitySetting(2, 0.9, 2, 1)]
    got = {(r["run"], r["post_id"]): r["topic"] for r in density_cluster_labels(table(spark, x), settings, block_rows).collect()}
    for s in settings:
        assert [got[(s.run, i)] for i in range(len(x))] == dense_brute(x, s)


def test_density_with_a_hot_group(spark):
    # A third of all posts are copies of one vector: blocks return counts and links, not the pairs.
    x = np.concatenate([blobs(per=20), np.tile(np.eye(8, dtype=np.float32)[0], (60, 1))])
    s = DensitySetting(0, 0.95, 5, 5)
    got = {r["post_id"]: r["topic"] for r in density_cluster_labels(table(spark, x), [s], 25).collect()}
    assert [got[i] for i in range(len(x))] == dense_brute(x, s)


def test_mapping_to_base(spark):
    def case(base, run, threshold):
        b = spark.createDataFrame(list(enumerate(base)), "post_id long, topic int")
        r = spark.createDataFrame([(i, v, 1) for i, v in enumerate(run)], "post_id long, topic int, run int")
        return {x["topic"]: x["base_topic"] for x in map_to_base(b, r, threshold).collect()}

    assert case([1, 1, 2, 2, -1], [10, 10, 20, 20, -1], 0.5) == {10: 1, 20: 2}
    assert case([1, 1, 2, 2, -1, -1], [10, 10, 10, 20, 20, 20], 0.8) == {10: -1, 20: -1}
    assert case([2, 1, -1], [5, 5, 6], 0.1) == {5: 2, 6: -1}


def test_consensus(spark):
    base = spark.createDataFrame(list(enumerate([1, 1, 2, 2, -1])), "post_id long, topic int")
    runs = [(1, [1, 1, 2, -1, -1]), (2, [1, 1, -1, 2, -1])]
    mapped = spark.createDataFrame([(r, i, v) for r, vs in runs for i, v in enumerate(vs)], "run int, post_id long, topic int")
    assert [r["topic"] for r in consensus(base, mapped, 2).orderBy("post_id").collect()] == [1, 1, 2, 2, -1]


def test_jaccard_and_metrics(spark):
    df = spark.createDataFrame([([], []), ([1, 2], [2, 3])], "a array<int>, b array<int>")
    assert [round(r[0], 6) for r in df.select(jaccard(F.col("a"), F.col("b"))).collect()] == [1.0, round(1 / 3, 6)]
    labels = spark.createDataFrame([(i, t) for i, t in enumerate([-1, -1])], "post_id long, topic int")
    assert tuple(clustering_metrics(labels).first()) == (0, 100.0, 0.0, 0.0)


def test_comparison_of_equal_and_single_clusterings(spark):
    rows = [(i, i % 3, [i % 3], [1.0]) for i in range(30)]
    same = spark.createDataFrame(rows, "post_id long, topic int, top_n_topics array<int>, top_n_scores array<double>")
    assert tuple(compare_clusterings(same, same).first()) == (30, 1.0, 1.0, 1.0, 100.0)
    one = same.withColumn("topic", F.lit(0)).withColumn("top_n_topics", F.array().cast("array<int>"))
    assert tuple(compare_clusterings(one, one).first()) == (30, 1.0, 1.0, 1.0, 0.0)


def test_anchors(spark):
    posts = table(spark, [[1, 0], [0, 1], [1, 1], [-1, -1], [1, 0]], [7, 7, 7, 7, 8])
    anchors = spark.createDataFrame([(7, 0, [1.0, 0.0]), (7, 1, [0.0, 1.0])], "l2_topic int, l3_topic int, embedding array<double>")
    got = {r["post_id"]: (r["topic"], r["top_n_topics"]) for r in assign_anchors(posts, anchors).collect()}
    assert got == {0: (0, [0, 1]), 1: (1, [0, 1]), 2: (0, [0, 1]), 3: (-1, [0, 1])}


def test_equal_vectors_give_two_halves(spark):
    posts = table(spark, [[1.0, 2.0]] * 6 + [[0.0, 0.0], [0.0, 1.0], [9.0, 9.0], [9.0, 8.0]], [1] * 6 + [2] * 4)
    sides = {}
    for r in split_topics(posts, posts.select("topic")).collect():
        sides.setdefault(r["topic"], []).append(r["side"])
    assert len(sides[1]) == 6 and set(sides[1]) == {0, 1} and sorted(sides[2]) == [0, 0, 1, 1]


def test_split_in_two(spark):
    rng = np.random.default_rng(1)
    far = np.concatenate([rng.normal(size=(20, 3)) + 10, rng.normal(size=(30, 3)) - 10])
    small = rng.normal(size=(3, 3))
    posts = table(spark, np.concatenate([far, small]), [1] * 50 + [2] * 3)
    sides = {r["post_id"]: r["side"] for r in split_topics(posts, posts.select("topic")).collect()}
    assert set(sides) == set(range(50))
    assert len({sides[i] for i in range(20)}) == 1 and len({sides[i] for i in range(20, 50)}) == 1 and sides[0] != sides[49]
    again = {r["post_id"]: r["side"] for r in split_topics(posts.repartition(7), posts.select("topic")).collect()}
    assert again == sides


def ward_brute(x, k):
    groups = [([i], v) for i, v in enumerate(x)]
    while len(groups) > k:
        cost = lambda a, b: 2 * len(a[0]) * len(b[0]) / (len(a[0]) + len(b[0])) * ((a[1] - b[1]) ** 2).sum()
        i, j = min(itertools.combinations(range(len(groups)), 2), key=lambda p: cost(groups[p[0]], groups[p[1]]))
        a, b = groups[i], groups[j]
        mean = (a[1] * len(a[0]) + b[1] * len(b[0])) / (len(a[0]) + len(b[0]))
        groups = [g for n, g in enumerate(groups) if n not in (i, j)] + [(a[0] + b[0], mean)]
    return {frozenset(g[0]) for g in groups}


def test_ward_matches_the_greedy_tree(spark):
    x = np.random.default_rng(4).normal(size=(14, 3))
    centers = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "topic int, centroid array<double>")
    assert ward_merges(centers).count() == 13
    rows = ward_groups(centers, 4).collect()
    found = {}
    for r in rows:
        found.setdefault(r["l1_id"], set()).add(r["topic"])
    assert {frozenset(g) for g in found.values()} == ward_brute(x, 4)
    assert [min(found[i]) for i in sorted(found)] == sorted(min(g) for g in found.values())


def test_communities_find_planted_blocks(spark):
    rng = np.random.default_rng(2)
    edges = [
        (i, j, 1.0) for i, j in itertools.combinations(range(40), 2) if rng.random() < (0.7 if i // 10 == j // 10 else 0.02)
    ]
    graph = spark.createDataFrame(edges, "a long, b long, w double")
    nodes = spark.range(41)
    members = {r["id"]: r["comm"] for r in communities(nodes, graph, connected=True).collect()}
    assert len(members) == 41
    assert all(len({members[i] for i in range(b * 10, b * 10 + 10)}) == 1 for b in range(4))
    assert len({members[b * 10] for b in range(4)} | {members[40]}) == 5
    q = modularity(graph, spark.createDataFrame(list(members.items()), "id long, comm long")).first()["q"]
    m = len(edges)
    degree = np.zeros(41)
    for a, b, _ in edges:
        degree[[a, b]] += 1
    want = sum(members[a] == members[b] for a, b, _ in edges) / m - sum(
        (sum(degree[i] for i in members if members[i] == c) / (2 * m)) ** 2 for c in set(members.values())
    )
    assert abs(q - want) < 1e-9


def test_pairs_already_joined_are_not_asked(spark):
    rows = [(1, 2, 0.9, 1, True), (2, 3, 0.8, 2, True), (1, 3, 0.7, 3, False), (3, 4, 0.6, 4, False), (1, 4, 0.5, 5, True)]
    decided = spark.createDataFrame(rows, "topic_a int, topic_b int, similarity double, rank int, merge boolean")
    assert sorted(r["rank"] for r in asked_pairs(decided).collect()) == [1, 2, 4, 5]


def test_refine_with_decision_tables(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(10, 4)) * 0.1 + c for c in ([5, 0, 0, 0], [-5, 0, 0, 0], [0, 5, 0, 0], [0, 5, 0.2, 0])])
    topics = [4] * 20 + [6] * 10 + [8] * 9 + [-1]
    posts = table(spark, x).withColumn("text", F.concat(F.lit("t"), "post_id"))
    clusters = table(spark, x, topics).select("post_id", "topic")
    splits = spark.createDataFrame([(4, "split", "two themes"), (6, "keep", "")], "topic int, action string, reason string")
    merges = spark.createDataFrame([(6, 8, True, "same")], "topic_a int, topic_b int, merge boolean, reason string")
    done = refine(posts, clusters, splits, merges, split_min_size=10, merge_similarity=0.9)
    got = {r["post_id"]: r["topic"] for r in done.clusters.collect()}
    assert [got[i] for i in (0, 10, 20, 30, 39)] == [0, 1, 2, 2, -1]
    shown = ("action", "topic", "new_topic", "topic_a", "topic_b", "decision")
    assert {tuple(r[c] for c in shown) for r in done.report.collect()} == {
        ("split_check", 4, None, None, None, "split"),
        ("split_check", 6, None, None, None, "keep"),
        ("split_apply", 4, 9, None, None, None),
        ("split_apply", 4, 10, None, None, None),
        ("merge_check", None, None, 6, 8, "true"),
        ("merge_apply", None, None, None, None, None),
    }


def test_split_rounds_read_packed_rows(spark):
    x = blobs(per=30)
    posts = table(spark, x, np.arange(len(x)) % 3).withColumn("embedding", F.col("embedding").cast("array<double>"))
    packs = _packed(posts)
    # One row per batch, whatever the number of posts.
    assert packs.count() <= 4 * posts.rdd.getNumPartitions() < len(x)
    centers = np.stack([x[[i, i + 3]] for i in range(3)]).astype(float)
    got = _round(packs, np.arange(3), centers)
    for t in range(3):
        rows = x[np.arange(len(x)) % 3 == t].astype(float)
        side = ((rows - centers[t, 1]) ** 2).sum(1) < ((rows - centers[t, 0]) ** 2).sum(1)
        assert np.allclose(got[t, 0], rows[~side].mean(0)) and np.allclose(got[t, 1], rows[side].mean(0))
