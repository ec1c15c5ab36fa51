"""Evaluation of a model on held-out interactions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from ratingloom.operators.metrics import average_metrics, user_metrics
from ratingloom.staging import stage

# recommend(users, k) -> (user_idx, item_idx, score, rank) without train items
Recommend = Callable[[DataFrame, int], DataFrame]

IMPLICIT_THRESHOLD = 0.5


def relevant_pairs(matrix: DataFrame, threshold: float = 3.5) -> DataFrame:
    """``(user, item)`` with a value of at least ``threshold``."""
    liked = matrix.where((F.col("value") >= threshold) & ~F.isnan("value"))
    return liked.select(F.col("user_idx").alias("user"), F.col("item_idx").alias("item"))


def relevant_summary(relevant: DataFrame) -> DataFrame:
    """Number of users with relevant items and the mean size of their sets."""
    sizes = relevant.distinct().groupBy("user").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("n_users"), F.round(F.coalesce(F.avg("n"), F.lit(0.0)), 2).alias("avg_items_per_user")
    )


def first_users(matrix: DataFrame, n_users: int) -> DataFrame:
    """The ``n_users`` smallest user indices of a matrix."""
    return matrix.select("user_idx").distinct().orderBy("user_idx").limit(n_users)


def evaluate_users(
    recommend: Recommend,
    test: DataFrame,
    k_values: Sequence[int] = (5, 10, 20),
    threshold: float = 3.5,
    n_candidates: int | None = None,
    n_users: int | None = None,
) -> DataFrame:
    """Per-user metrics of a model over a held-out matrix ``(user_idx, item_idx, value)``."""
    if n_users is not None:
        test = test.join(first_users(test, n_users), "user_idx", "left_semi")
    relevant = stage(relevant_pairs(test, threshold), "relevant")
    users = stage(relevant.select(F.col("user").alias("user_idx")).distinct(), "test-users")
    recs = recommend(users, n_candidates or max(k_values)).select(
        F.col("user_idx").alias("user"), F.col("item_idx").alias("item"), "rank"
    )
    return user_metrics(stage(recs, "test-recs"), relevant, k_values)


def evaluate_model(
    recommend: Recommend,
    test: DataFrame,
    k_values: Sequence[int] = (5, 10, 20),
    threshold: float = 3.5,
    n_users: int | None = None,
) -> DataFrame:
    """Averaged metrics of a model, one row."""
    return average_metrics(evaluate_users(recommend, test, k_values, threshold, n_users=n_users))
