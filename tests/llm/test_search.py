"""Exact and approximate vector search against brute force."""

import numpy as np
import pytest

from topicloom.llm import ann, blocks, topk


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")


def awkward(seed, n=240, d=6):
    rng = np.random.RandomState(seed)
    rows = [(i, [float(x) for x in rng.randint(-4, 5, d) / 8], 0) for i in range(n)]
    rows += [(20, rows[40][1], 0), (None, rows[40][1], 0), (7, None, 0), (8, [0.1, None], 0), (9, [float("nan")] * d, 0), (10, [float("inf")] * d, 0)]
    rows += [(60, rows[60][1], 0), (60, rows[60][1], 0), (300, [0.0] * d, 0), (301, [], 0), (302, [1.0, -1.0], 0)]
    return rows


def brute(rows, k, every, turn, score):
    good = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    d = max(len(v) for _, v in good)
    kept = [(i, turn(np.array(list(v) + [0.0] * (d - len(v))))) for i, v in good]
    out = []
    for a, (i, q) in enumerate(kept):
        if i is None or i % every:
            continue
        near = sorted(((-score(q, v), j is None, j or 0, j) for b, (j, v) in enumerate(kept) if a != b))[:k]
        out += [(i, r + 1, j, -s) for r, (s, _, _, j) in enumerate(near)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_rows,query_rows", [(8192, 256), (50, 4)])
def test_top_k_equals_brute_force(spark, block_rows, query_rows):
    rows = awkward(1)
    got = topk.top_k_search(table(spark, rows), k=7, every=20, block_rows=block_rows, query_rows=query_rows).collect()
    want = brute(rows, 7, 20, lambda v: np.floor(64 * v), lambda a, b: int(a @ b))
    assert sorted((tuple(r) for r in got), key=str) == want


def test_top_k_empty_and_few(spark):
    assert topk.top_k_search(table(spark, [])).count() == 0
    got = topk.top_k_search(table(spark, [(0, [0.5], 0), (1, [0.25], 0)])).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 32 * 16)]


def test_neighbours_small_tables_are_complete(spark):
    rows = [r for r in awkward(2, 90) if r[1] is None or any(r[1])]
    found = ann.nearest_neighbours(table(spark, rows), k=200, every=20, block_rows=40).collect()
    want = brute(rows, 200, 20, lambda v: v, lambda a, b: float(np.sum(a * b)))
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found if r.vec_id is not None) == sorted((a, b, c) for a, b, c, _ in want if c is not None)


def test_neighbours_recall_and_scores(spark):
    rng = np.random.RandomState(3)
    centers = rng.standard_normal((20, 24))
    vectors = centers[rng.randint(0, 20, 3000)] + 0.7 * rng.standard_normal((3000, 24))
    vectors *= rng.uniform(0.5, 2.0, (3000, 1))
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)] + [(5000, [0.0] * 24, 0), (5020, None, 0)]
    got = ann.nearest_neighbours(table(spark, rows), block_rows=700, query_rows=32).collect()
    sims = vectors[::20] @ vectors.T
    sims[np.arange(len(sims)), np.arange(0, 3000, 20)] = -np.inf
    want = {(int(q * 20), int(j)) for q, row in enumerate(sims) for j in np.argsort(-row)[:20]}
    assert len(want & {(r.query_id, r.vec_id) for r in got}) / len(want) >= 0.9
    for r in got[:200]:
        assert r.score == float(np.sum(vectors[r.vec_id] * vectors[r.query_id]))
    assert ann.nearest_neighbours(table(spark, [])).count() == 0


@pytest.mark.parametrize("search", [topk.top_k_search, ann.nearest_neighbours])
def test_blocks_are_not_copied_for_packs(spark, monkeypatch, search):
    # Several groups of blocks, several packs each.
    monkeypatch.setattr(blocks, "GROUP_BYTES", 20000)
    rows = [r for r in awkward(4) if r[1] is None or any(r[1])]
    found = search(table(spark, rows), k=400, every=20, block_rows=50, query_rows=4)
    turn = (lambda v: np.floor(64 * v)) if search is topk.top_k_search else (lambda v: v)
    want = brute(rows, 400, 20, turn, lambda a, b: float(np.sum(a * b)))
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    # What is sent after blocks have met packs are the best rows of queries.
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    meeting = next(i for i, x in enumerate(lines) if "MapInArrow" in x)
    below = lines[meeting + 1 :]
    product = next(i for i, x in enumerate(below) if "CartesianProduct" in x or "Join" in x)
    assert not any("Exchange" in x for x in below[:product])
