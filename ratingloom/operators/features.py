"""Matrix, normalisation, popularity and confidence features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratingloom.staging import one_value, stage

DAY = 24 * 3600


def interaction_matrix(encoded: DataFrame, value: str = "rating", unique: bool = False) -> DataFrame:
    """Coordinate form ``(user_idx, item_idx, value)``; repeated cells are summed, zeros stay.

    Cells known to be ``unique``, as after cleaning, need no aggregation and hence no shuffle.
    """
    if unique:
        return encoded.select("user_idx", "item_idx", F.col(value).cast("double").alias("value"))
    return encoded.groupBy("user_idx", "item_idx").agg(F.sum(F.col(value).cast("double")).alias("value"))


def matrix_stats(matrix: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    n_users, n_items = one_value(users, F.count("*")), one_value(items, F.count("*"))
    return matrix.agg(F.count("*").alias("nnz")).select(
        n_users.alias("n_users"),
        n_items.alias("n_items"),
        "nnz",
        F.round(F.try_divide(F.col("nnz") * 100, n_users.cast("double") * n_items), 4).alias("density_pct"),
    )


def user_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id").agg(F.avg("rating").alias("mean"))


def user_stats(ratings: DataFrame) -> DataFrame:
    """Mean and sample deviation per user; a single rating has deviation 1."""
    return ratings.groupBy("user_id").agg(
        F.avg("rating").alias("mean"),
        F.coalesce(F.stddev_samp("rating"), F.lit(1.0)).alias("std"),
    )


def normalize_ratings(ratings: DataFrame, method: str = "mean_centering", co_located: bool = False) -> DataFrame:
    """Add ``rating_normalized``.

    Per-user methods aggregate first, store the per-user table and join it back. The aggregate
    combines map-side, and the join with a stored table is either broadcast by size or can
    split a heavy user, which a window over users could not. Ratings that are stored in buckets of the user are
    ``co_located``: the per-user table then keeps their partitions, and nothing is shuffled or stored.
    """
    rating = F.col("rating")
    per_user = (lambda table, name: table) if co_located else stage
    if method == "mean_centering":
        joined = ratings.join(per_user(user_means(ratings), "user-means"), "user_id")
        normalized = rating - F.col("mean")
    elif method == "z_score":
        joined = ratings.join(per_user(user_stats(ratings), "user-stats"), "user_id")
        normalized = F.try_divide(rating - F.col("mean"), F.col("std"))
    elif method == "min_max":
        joined = ratings
        low, high = one_value(ratings, F.min("rating")), one_value(ratings, F.max("rating"))
        normalized = F.try_divide(rating - low, high - low)
    else:
        raise ValueError(f"unknown normalisation method: {method}")
    return joined.withColumn("rating_normalized", normalized).select(*ratings.columns, "rating_normalized")


def normalization_metadata(ratings: DataFrame) -> DataFrame:
    return ratings.agg(
        F.avg("rating").alias("global_mean"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
    )


def item_stats(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("item_id").agg(
        F.count("user_id").alias("interaction_count"),
        F.avg("rating").alias("avg_rating"),
        F.max("timestamp").alias("last_timestamp"),
    )


def item_popularity(
    interactions: DataFrame, time_decay: bool = True, decay: float = 0.95, recency_weight: float = 0.3
) -> DataFrame:
    """Popularity of every item, at most 1, from count, mean rating and age of the last event.

    The interactions are read and aggregated once into a stored item table; the global maxima
    are scalar subqueries over that table.
    """
    stats = stage(item_stats(interactions), "item-stats")
    count_score = F.col("interaction_count") / one_value(stats, F.max("interaction_count"))
    rating_score = (F.col("avg_rating") - 1) / 4  # ratings from 1 to 5
    score = count_score * rating_score
    if time_decay:
        newest = one_value(stats, F.max("last_timestamp"))
        days = (newest - F.col("last_timestamp")) / DAY
        score = (1 - recency_weight) * score + recency_weight * F.pow(F.lit(decay), days)
    scored = stats.withColumn("raw_score", score)
    best = one_value(scored, F.max("raw_score"))
    return scored.select(
        "item_id",
        F.try_divide("raw_score", best).alias("popularity_score"),
        "interaction_count",
        "avg_rating",
    )


def _confidence(encoded: DataFrame, alpha: float) -> DataFrame:
    if "interaction" in encoded.columns:
        base = F.col("interaction")
    else:
        base = F.try_divide(F.col("rating"), one_value(encoded, F.max("rating")))
    return encoded.withColumn("confidence", 1 + F.lit(float(alpha)) * base)


def confidence_matrix(encoded: DataFrame, alpha: float = 40.0) -> DataFrame:
    """``1 + alpha * interaction``, or ``1 + alpha * rating / max`` without the binary column."""
    return (
        _confidence(encoded, alpha)
        .groupBy("user_idx", "item_idx")
        .agg(F.sum("confidence").alias("confidence"))
    )


def confidence_stats(encoded: DataFrame, alpha: float = 40.0) -> DataFrame:
    return _confidence(encoded, alpha).agg(
        F.round(F.avg("confidence"), 2).alias("mean_confidence"),
        F.round(F.max("confidence"), 2).alias("max_confidence"),
    )


def feature_metadata(
    train: DataFrame, users: DataFrame, items: DataFrame, feedback_type: str = "explicit"
) -> DataFrame:
    """One row of counts and rating statistics; the id lists are the encoder tables."""
    return train.agg(
        F.count("*").alias("n_interactions"),
        F.min("rating").alias("rating_min"),
        F.max("rating").alias("rating_max"),
        F.avg("rating").alias("rating_mean"),
        F.stddev_samp("rating").alias("rating_std"),
    ).select(
        one_value(users, F.count("*")).alias("n_users"),
        one_value(items, F.count("*")).alias("n_items"),
        F.lit(feedback_type).alias("feedback_type"),
        "n_interactions",
        "rating_min",
        "rating_max",
        "rating_mean",
        "rating_std",
    )
