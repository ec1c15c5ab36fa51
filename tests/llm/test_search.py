"""Nearest neighbours against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import ann


def vectors(seed, n, size, lengths=False):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, size))
    x = centres[draw.integers(0, 12, n)] + 0.6 * draw.standard_normal((n, size))
    if not lengths:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1.0) for i, v in rows], "vec_id long, embedding array<double>, query_id string, score double")


def search(spark, rows, k=10, **options):
    found = ann.nearest(frame(spark, rows), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k, **options).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    for q, near in by.items():
        assert [r.rank for r in near] == list(range(1, len(near) + 1))
        assert [(-r.score, r.vec_id) for r in near] == sorted((-r.score, r.vec_id) for r in near)
        assert q not in {r.vec_id for r in near}
    return by


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_and_exact_scores(spark, lengths):
    x = vectors(1, 3000, 24, lengths)
    got = search(spark, [(i, v.tolist()) for i, v in enumerate(x)], block_rows=700)
    assert set(got) == set(range(0, 3000, 20))
    hits = 0
    for q, near in got.items():
        product = (x * x[q]).sum(axis=1)
        assert all(r.score == product[r.vec_id] for r in near) and len(near) == 10
        product[q] = -np.inf
        hits += len(set(np.argsort(-product)[:10].tolist()) & {r.vec_id for r in near})
    assert hits >= 0.9 * 10 * len(got)


def test_ties_go_to_the_smaller_id_and_a_hot_vector_is_whole(spark):
    same = [0.6, 0.8, 0.0]
    rows = [(i, same) for i in range(400)] + [(1000 + i, v.tolist()) for i, v in enumerate(vectors(2, 100, 3))]
    got = search(spark, rows, k=5, block_rows=120)
    assert [r.vec_id for r in got[0]] == [1, 2, 3, 4, 5] and [r.vec_id for r in got[20]] == [0, 1, 2, 3, 4]


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0])]
    rows += [(6, [1.0, None]), (7, []), (None, [1.0, 0.0]), (20, [0.0, 0.0]), (40, [1.0, 2.0, 3.0]), (60, [-1.0, 0.0])]
    got = search(spark, rows)
    assert [r.vec_id for r in got[0]] == [1, 60] and [r.vec_id for r in got[60]] == [1, 0] and set(got) == {0, 60}


def test_no_rows_no_queries_and_fewer_candidates(spark):
    assert search(spark, []) == {}
    assert search(spark, [(1, [1.0]), (2, [2.0])]) == {}
    assert [r.vec_id for r in search(spark, [(20, [1.0]), (2, [2.0]), (2, [2.0])])[20]] == [2]


def test_repeated_queries_and_candidates_are_one_each(spark):
    x = vectors(3, 200, 6, True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    other = [(i, (-v).tolist()) for i, v in enumerate(x) if i % 10 == 0]  # ids with two vectors
    got = search(spark, rows + rows + other + other, k=7, block_rows=60)
    both = {}
    for i, v in rows + other:
        both.setdefault(i, []).append(np.array(v))
    for q, near in got.items():
        score = {i: max(float((a * b).sum()) for a in both[q] for b in own) for i, own in both.items() if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:7]
        assert len({r.vec_id for r in near}) == len(near) == 7
        assert len(set(best) & {r.vec_id for r in near}) >= 6
        assert all(np.isclose(r.score, score[r.vec_id]) for r in near)


def test_a_hot_row_is_spread(spark):
    hot = [0.6, 0.8]
    rows = [(20, hot)] * 3000 + [(7, [0.1 * i, 1.0]) for i in range(500)] + [(40, [1.0, 0.0])]
    got = search(spark, rows, k=3, block_rows=50)
    assert [r.vec_id for r in got[20]] == [7, 40] and [r.vec_id for r in got[40]] == [7, 20]


def test_candidates_are_a_small_part_of_clustered_rows():
    draw = np.random.default_rng(9)
    centres = draw.standard_normal((40, 32))
    x = centres[draw.integers(0, 40, 8000)] + 0.35 * draw.standard_normal((8000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    block = ann.Block(np.arange(8000), x)
    asked = np.arange(0, 8000, 40)
    hits = 0
    for q, (near, _) in zip(asked, block.nearest(asked, x[asked], 20)):
        product = x @ x[q]
        product[q] = -np.inf
        hits += len(set(np.argsort(-product)[:20].tolist()) & set(near.tolist()))
    assert hits >= 0.95 * 20 * len(asked)
    assert block.verified <= len(x) * len(asked) / 3


def test_threshold_is_the_largest_with_the_wanted_recall():
    p = 0.866385597462284
    tail = lambda least: sum(ann.math.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(least, 65))
    assert tail(ann.threshold()) >= ann.RECALL > tail(ann.threshold() + 1)
