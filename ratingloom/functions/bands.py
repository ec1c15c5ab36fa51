"""Column expressions that sort scores, similarities and ratings into display bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: band names and their lower bounds
SCORE_BANDS = (("Tres recommande", 0.8), ("Recommande", 0.6))
SCORE_REST = "A decouvrir"
SIMILARITY_BANDS = (("Tres similaire", 0.8), ("Similaire", 0.6))
SIMILARITY_REST = "A explorer"
RATING_BANDS = (("high", 4.0), ("medium", 3.0))
RATING_REST = "low"
STARS = 5


def _banded(value: Column, bands: tuple[tuple[str, float], ...], rest: str) -> Column:
    label = F.lit(rest)
    for name, bound in reversed(bands):
        label = F.when(value >= bound, F.lit(name)).otherwise(label)
    return label


def score_band(score: Column) -> Column:
    return _banded(score, SCORE_BANDS, SCORE_REST)


def similarity_band(similarity: Column) -> Column:
    return _banded(similarity, SIMILARITY_BANDS, SIMILARITY_REST)


def similarity_percent(similarity: Column) -> Column:
    """Whole percent, truncated towards zero."""
    return (similarity * 100).cast("int")


def rating_band(rating: Column) -> Column:
    return _banded(rating, RATING_BANDS, RATING_REST)


def full_stars(rating: Column) -> Column:
    return rating.cast("int")


def half_star(rating: Column) -> Column:
    return (rating - full_stars(rating) >= 0.5).cast("int")


def empty_stars(rating: Column) -> Column:
    return F.lit(STARS) - full_stars(rating) - half_star(rating)
