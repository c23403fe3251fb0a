"""Hard negatives against brute force."""

import numpy as np
import pytest

from topicloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 0, 0) for i, v, label in rows], SCHEMA)


def awkward(seed, n=300, d=5, labels=3):
    rng = np.random.RandomState(seed)
    rows = [(i, [float(x) for x in rng.randint(-3, 4, d) / 8], int(rng.randint(labels))) for i in range(n)]
    rows += [(100, rows[100][1], rows[100][2])] * 2 + [(200, rows[3][1], rows[200][2]), (None, rows[100][1], rows[100][2]), (None, rows[100][1], (rows[100][2] + 1) % labels)]
    rows += [(400, None, 1), (500, rows[0][1], None), (600, [0.5, None], 1), (700, [float("nan")] * d, 1), (800, [float("inf")] * d, 1)]
    return rows + [(900, [0.0] * d, 1), (1000, [], 1), (1100, [0.5, -0.25], 2), (1200, [1.0] * d, 99), (1300, [-x for x in rows[0][1]], 0)]


def brute(rows, positives=5, k=5, every=100):
    good = [(i, v, c) for i, v, c in rows if v is not None and c is not None and all(x is not None and np.isfinite(x) for x in v)]
    d = max((len(v) for _, v, _ in good), default=0)
    whole = np.array([list(v) + [0.0] * (d - len(v)) for _, v, _ in good]).reshape(len(good), d)
    whole = np.floor(256 * whole).astype(np.int64)
    out = []
    for a, (i, _, label) in enumerate(good):
        if i is None or i % every:
            continue
        scores = whole @ whole[a]
        first = sorted((b for b in range(len(good)) if b != a), key=lambda b: (-scores[b], good[b][0] is None, good[b][0] or 0))
        for p in [b for b in first if good[b][2] == label][:positives]:
            fit = [b for b in first if good[b][2] != label and 80 * scores[p] <= 100 * scores[b] <= 100 * scores[p]][:k]
            out += [(i, good[p][0], r + 1, good[b][0], int(scores[p]), int(scores[b])) for r, b in enumerate(fit)]
    return sorted(out, key=str)


def mined(frame, **given):
    return sorted((tuple(r)[:6] for r in hard_negatives.mine_negatives(frame, **given).collect()), key=str)


@pytest.mark.parametrize("seed,block_rows,labels", [(1, 4096, 3), (2, 40, 3), (3, 16, 40)])
def test_equals_brute_force(spark, seed, block_rows, labels):
    rows = awkward(seed, labels=labels)
    assert mined(table(spark, rows), block_rows=block_rows) == brute(rows)


def test_empty_one_label_and_no_anchor(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(100, [1.0], 1), (1, [1.0], 1)])) == []
    assert mined(table(spark, [(1, [1.0], 1), (2, [1.0], 2)])) == []
    assert mined(table(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)])) == brute([(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) != []


def test_hot_label_and_equal_rows(spark):
    rows = [(i, [0.5, 0.25], 1) for i in range(400)] + [(i, [0.5, 0.2], 2) for i in range(400, 600)]
    assert mined(table(spark, rows), block_rows=64) == brute(rows)


def test_too_large_components(spark):
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mine_negatives(table(spark, [(0, [1e9], 1), (1, [1e9], 2)]))


def test_scan_stops_early_where_the_lists_allow_it():
    rng = np.random.RandomState(4)
    matrix = np.floor(256 * np.abs(rng.standard_normal((4000, 3))) ** 3)
    lists, skip = hard_negatives.sorted_lists(matrix, np.arange(4000)), np.zeros(4000, bool)
    for query in (np.array([5.0, 0.0, 1.0]), np.array([1.0, -2.0, 0.0])):
        want = np.sort(matrix @ query)[::-1][:5]
        rows, scores, scored = hard_negatives.threshold_scan(matrix, lists, query, skip, [None], [None], 5)
        assert np.array_equal(np.sort(scores)[::-1][:5], want) and scored < 2000


def test_scan_keeps_ties_at_the_bound():
    matrix = np.array([[4.0], [4.0], [4.0], [3.0], [3.0]] + [[1.0]] * 30)
    rows, scores, _ = hard_negatives.threshold_scan(matrix, hard_negatives.sorted_lists(matrix, np.arange(35)), np.array([2.0]), np.zeros(35, bool), [None, 6], [None, 6], 2)
    assert (scores == 8).sum() == 3 and (scores == 6).sum() == 2
