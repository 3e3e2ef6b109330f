import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from omnimart.llm import multi_index

VECTORS = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], VECTORS)


def exact(rows, queries, k=10):
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], dtype=np.float32).astype(float)
    found = {}
    for q in queries:
        score = np.sqrt(((v - v[ids == q][0]) ** 2).sum(axis=1))
        order = [k_ for k_ in np.lexsort((ids, score)) if ids[k_] != q][:k]
        found[q] = [(int(ids[o]), float(score[o])) for o in order]
    return found


def results(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def test_recall_on_clusters_and_exact_scores(spark):
    draw = np.random.RandomState(1)
    centres = draw.randn(30, 16) * 3
    rows = [(i, centres[i % 30] + draw.randn(16)) for i in range(3000)]
    found = results(multi_index.search(table(spark, rows), F.col("vec_id") % 100 == 0))
    truth = exact(rows, range(0, 3000, 100))
    assert set(found) == set(truth) and all(len(x) == 10 for x in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert hits >= 0.9 * 300
    ids = dict(rows)
    for q, own in found.items():
        for i, score in own:
            a, b = (np.array(ids[x], np.float32).astype(float) for x in (q, i))
            assert score == pytest.approx(math.sqrt(((a - b) ** 2).sum()), rel=1e-14)


def test_pairs_come_in_order_of_summed_distance():
    draw = np.random.RandomState(2)
    near, far = draw.rand(9), draw.rand(13)
    sums = [near[i] + far[j] for i, j in multi_index.cells_in_order(near, far)]
    assert len(sums) == 117 and sums == sorted(sums)


def test_few_rows_copies_and_ties(spark):
    rows = [(i, (1.0, 0.0, 0.0, 1.0)) for i in range(200)] + [(i, (0.0, 1.0, 0.5, float(i % 3))) for i in range(200, 230)]
    assert results(multi_index.search(table(spark, rows), F.col("vec_id") % 100 == 0)) == exact(rows, (0, 100, 200))
    few = [(100, (1, 2)), (7, (1, 3)), (8, (1, 1))]
    assert results(multi_index.search(table(spark, few), F.col("vec_id") % 100 == 0)) == {100: [(7, 1.0), (8, 1.0)]}
    assert results(multi_index.search(table(spark, few[:1]), F.col("vec_id") % 100 == 0)) == {}


def test_unusable_vectors_take_no_part(spark):
    good = [(100, (1, 2)), (1, (1, 3)), (2, (2, 2))]
    bad = [(200, None), (3, (0, 0)), (4, (None, 1)), (5, (float("nan"), 1)), (6, (float("inf"), 1)), (7, (1, 2, 3)), (8, ()), (None, (1, 2)), (1, (1, 3))]
    found = results(multi_index.search(table(spark, good + bad), F.col("vec_id") % 100 == 0))
    assert found == {100: [(1, 1.0), (2, 1.0)]}


def test_empty_table_and_clashing_columns(spark):
    assert multi_index.search(table(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert multi_index.search(table(spark, [(100, None)]), F.col("vec_id") % 100 == 0).count() == 0
    rows = spark.createDataFrame([(100, [1.0, 2.0], 1, 2), (1, [2.0, 2.0], 1, 2)], "vec_id long, embedding array<float>, cell int, v int")
    assert results(multi_index.search(rows, F.col("vec_id") % 100 == 0)) == {100: [(1, 1.0)]}
