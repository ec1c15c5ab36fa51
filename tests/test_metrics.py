import math
import random

import pytest
from pyspark.ml.evaluation import RankingEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from ratingloom.operators import metrics


@pytest.fixture
def lists(spark):
    """(recs, relevant) tables from python lists per user."""

    def make(recommended, relevant):
        recs = [(u, i, r) for u, items in enumerate(recommended) for r, i in enumerate(items, 1)]
        rel = [(u, i) for u, items in enumerate(relevant) for i in items]
        return (
            spark.createDataFrame(recs, "user long, item long, rank int"),
            spark.createDataFrame(rel, "user long, item long"),
        )

    return make


def value(df, column):
    return round(df.first()[column], 6)


def test_errors(spark):
    pairs = spark.createDataFrame(list(zip([4.0, 3.0, 5.0, 2.0], [3.5, 3.2, 4.8, 2.5])), "y_true double, y_pred double")
    assert value(metrics.rmse(pairs), "rmse") == 0.380789
    assert value(metrics.mae(pairs), "mae") == 0.35
    spark_rmse = RegressionEvaluator(labelCol="y_true", predictionCol="y_pred").evaluate(pairs)
    assert round(spark_rmse, 6) == 0.380789
    same = pairs.select("y_true", F.col("y_true").alias("y_pred"))
    assert metrics.rmse(same).first()["rmse"] == 0.0


def test_precision_and_recall(lists):
    recs, relevant = lists([[1, 4, 2, 5, 3]], [[1, 2, 3]])
    assert value(metrics.precision_at_k(recs, relevant, 5), "precision") == 0.6
    assert value(metrics.precision_at_k(recs, relevant, 3), "precision") == 0.666667
    recs, relevant = lists([[1, 6, 2, 7, 3]], [[1, 2, 3, 4, 5]])
    assert value(metrics.recall_at_k(recs, relevant, 5), "recall") == 0.6


def test_short_list_divides_by_k(lists):
    recs, relevant = lists([[1]], [[1, 2]])
    assert value(metrics.precision_at_k(recs, relevant, 5), "precision") == 0.2


def test_repeated_item_counts_once(lists):
    recs, relevant = lists([[1, 1, 2]], [[1, 2]])
    assert value(metrics.precision_at_k(recs, relevant, 3), "precision") == 0.666667


def test_ndcg(lists):
    recs, relevant = lists([[1, 2, 3, 4, 5]], [[1, 2, 3]])
    assert value(metrics.ndcg_at_k(recs, relevant, 5), "ndcg") == 1.0
    recs, relevant = lists([[1, 4, 2, 5, 3]], [[1, 2, 3]])
    assert value(metrics.ndcg_at_k(recs, relevant, 5), "ndcg") == 0.88546


def test_graded_ndcg(spark, lists):
    recs, _ = lists([[2, 1, 9, 3]], [[]])
    graded = spark.createDataFrame([(0, 1, 3.0), (0, 2, 2.0), (0, 3, 1.0)], "user long, item long, grade double")
    assert value(metrics.graded_ndcg(recs, graded, 4), "ndcg") == 0.907936


def test_dcg(spark):
    listed = spark.createDataFrame([(0, 1, 3.0), (0, 2, 0.0), (0, 3, 1.0)], "user long, rank int, relevance double")
    assert value(metrics.dcg(listed, 3), "dcg") == 3.5
    assert value(metrics.dcg(listed, 2), "dcg") == 3.0


def test_all_metrics(lists):
    recs, relevant = lists([[1, 3, 5], [3, 5, 4]], [[1, 2], [3, 4]])
    row = metrics.all_metrics(recs, relevant, [3]).first()
    got = tuple(round(row[c], 6) for c in ("precision_at_3", "recall_at_3", "ndcg_at_3", "map_at_3", "mrr"))
    assert got == (0.5, 0.75, 0.766434, 0.666667, 1.0)
    assert row.n_users_evaluated == 2


def test_user_without_list_counts_as_zero(lists):
    recs, relevant = lists([[1]], [[1], [2]])
    row = metrics.all_metrics(recs, relevant, [1]).first()
    assert (row.precision_at_1, row.mrr, row.n_users_evaluated) == (0.5, 0.5, 2)


def test_nothing_to_evaluate(lists):
    recs, relevant = lists([[1]], [[]])
    row = metrics.all_metrics(recs, relevant, [5]).first()
    assert (row.precision_at_5, row.ndcg_at_5, row.map_at_5, row.mrr, row.n_users_evaluated) == (0.0, 0.0, 0.0, 0.0, 0)


def test_reciprocal_rank_reads_the_whole_list(lists):
    recs, relevant = lists([[9, 8, 7, 6, 1]], [[1]])
    assert value(metrics.reciprocal_rank(recs, relevant), "rr") == 0.2
    assert metrics.all_metrics(recs, relevant, [2]).first().mrr == 0.2


def test_against_ranking_evaluator(spark, lists):
    rng = random.Random(2)
    recommended = [rng.sample(range(40), 12) for _ in range(30)]
    wanted = [rng.sample(range(40), rng.randrange(1, 9)) for _ in range(30)]
    recs, relevant = lists(recommended, wanted)
    ours = metrics.all_metrics(recs, relevant, [5]).first()
    pairs = spark.createDataFrame(
        [([float(i) for i in r], [float(i) for i in w]) for r, w in zip(recommended, wanted)],
        "prediction array<double>, label array<double>",
    )
    for name, column in (("precisionAtK", "precision_at_5"), ("recallAtK", "recall_at_5"), ("ndcgAtK", "ndcg_at_5"), ("meanAveragePrecisionAtK", "map_at_5")):
        theirs = RankingEvaluator(metricName=name, k=5).evaluate(pairs)
        assert math.isclose(ours[column], theirs, abs_tol=1e-9), name


def test_by_k(lists, rows):
    recs, relevant = lists([[1, 3, 5], [3, 5, 4]], [[1, 2], [3, 4]])
    wide = metrics.all_metrics(recs, relevant, [3])
    assert rows(metrics.by_k(wide, [3, 7])) == [(3, 0.5, 0.75, 0.766434, 0.666667), (7, 0.0, 0.0, 0.0, 0.0)]


def test_bad_k(lists):
    recs, relevant = lists([[1]], [[1]])
    with pytest.raises(ValueError):
        metrics.user_metrics(recs, relevant, [0])
