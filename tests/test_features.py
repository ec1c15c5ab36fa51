import pytest
from pyspark.sql import functions as F

from ratingloom.operators import features


def test_matrix_cells(spark, rows):
    encoded = spark.createDataFrame([(0, 0, 4.0), (1, 1, 3.0), (0, 0, 4.0)], "user_idx long, item_idx long, rating double")
    assert rows(features.interaction_matrix(encoded)) == [(0, 0, 8.0), (1, 1, 3.0)]


def test_matrix_stats(spark, rows):
    matrix = spark.createDataFrame([(0, 0, 1.0), (99, 99, 1.0)], "user_idx long, item_idx long, value double")
    hundred = spark.range(100)
    assert rows(features.matrix_stats(matrix, hundred, hundred)) == [(100, 100, 2, 0.02)]


def test_mean_centering(ratings, rows):
    out = features.normalize_ratings(ratings([(1, i, v, 1) for i, v in enumerate([3.0, 4.0, 5.0])]))
    assert rows(out, "rating_normalized") == [(-1.0,), (0.0,), (1.0,)]


def test_z_score_edge_cases(ratings, rows):
    values = [(1, 1, 3.0, 1), (1, 2, 4.0, 1), (1, 3, 5.0, 1), (2, 1, 4.0, 1), (3, 1, 4.0, 1), (3, 2, 4.0, 1)]
    out = features.normalize_ratings(ratings(values), "z_score")
    assert rows(out, "user_id", "rating_normalized") == [
        (1, -1.0), (1, 0.0), (1, 1.0), (2, 0.0), (3, None), (3, None)
    ]


def test_min_max(ratings, rows):
    out = features.normalize_ratings(ratings([(1, i, v, 1) for i, v in enumerate([1.0, 3.0, 5.0])]), "min_max")
    assert rows(out, "rating_normalized") == [(0.0,), (0.5,), (1.0,)]
    constant = features.normalize_ratings(ratings([(1, 1, 3.0, 1)]), "min_max")
    assert rows(constant, "rating_normalized") == [(None,)]


def test_unknown_method(ratings):
    with pytest.raises(ValueError):
        features.normalize_ratings(ratings([(1, 1, 3.0, 1)]), "other")


POPULAR = [(1, 1, 4.0, 100), (2, 1, 5.0, 200), (3, 1, 3.0, 300), (1, 2, 4.0, 400), (2, 2, 4.0, 500)]


def test_popularity_without_decay(ratings, rows):
    out = features.item_popularity(ratings(POPULAR), time_decay=False)
    assert rows(out, "item_id", "popularity_score") == [(1, 1.0), (2, 0.666667)]
    counts = [(1, 1, 4.0, 1), (2, 1, 4.0, 1), (3, 1, 4.0, 1), (1, 2, 4.0, 1)]
    assert rows(features.item_popularity(ratings(counts), time_decay=False), "popularity_score") == [(0.333333,), (1.0,)]


def test_popularity_with_decay(ratings, rows):
    out = features.item_popularity(ratings(POPULAR))
    assert rows(out, "item_id", "popularity_score") == [(1, 1.0), (2, 0.787913)]


@pytest.mark.parametrize("value, alpha, expected", [(1.0, 10, 11.0), (1.0, 100, 101.0), (0.0, 40, 1.0)])
def test_binary_confidence(spark, rows, value, alpha, expected):
    encoded = spark.createDataFrame([(0, 0, value)], "user_idx long, item_idx long, interaction double")
    assert rows(features.confidence_matrix(encoded, alpha), "confidence") == [(expected,)]


def test_rating_confidence(spark, rows):
    encoded = spark.createDataFrame([(0, 0, 5.0), (0, 1, 2.5)], "user_idx long, item_idx long, rating double")
    assert rows(features.confidence_matrix(encoded), "confidence") == [(21.0,), (41.0,)]
    assert rows(features.confidence_stats(encoded)) == [(31.0, 41.0)]


def test_metadata(ratings, spark):
    row = features.feature_metadata(ratings([(1, 1, 2.0, 1), (2, 1, 4.0, 1)]), spark.range(2), spark.range(1)).first()
    assert (row.n_users, row.n_items, row.n_interactions, row.rating_min, row.rating_max, row.rating_mean) == (2, 1, 2, 2.0, 4.0, 3.0)
    assert round(row.rating_std, 6) == 1.414214


def test_hot_user_join_has_no_window(ratings):
    """Normalisation aggregates and joins; a window over users would put a heavy user in one task."""
    plan = features.normalize_ratings(ratings(POPULAR), "z_score")._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_popularity_scans_once_per_maximum(ratings):
    out = features.item_popularity(ratings(POPULAR))
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert out.where(F.col("popularity_score") > 1).count() == 0
