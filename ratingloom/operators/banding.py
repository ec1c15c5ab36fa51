"""Distributions of display bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratingloom.functions import bands


def score_band_counts(recs: DataFrame) -> DataFrame:
    return recs.groupBy(bands.score_band(F.col("score")).alias("band")).agg(F.count("*").alias("n"))


def similarity_band_counts(similar: DataFrame) -> DataFrame:
    value = F.col("similarity")
    return similar.groupBy(
        bands.similarity_band(value).alias("band"), bands.similarity_percent(value).alias("percent")
    ).agg(F.count("*").alias("n"))


def rating_band_counts(ratings: DataFrame, key: str = "item_id") -> DataFrame:
    """Counted stars and bands per item (or user)."""
    rating = F.col("rating")
    return ratings.groupBy(
        key,
        bands.rating_band(rating).alias("band"),
        bands.full_stars(rating).alias("full_stars"),
        bands.half_star(rating).alias("half_star"),
        bands.empty_stars(rating).alias("empty_stars"),
    ).agg(F.count("*").alias("n"))
