"""Cleaning and standardising of ratings and items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import DoubleType, FloatType

from ratingloom.functions.titles import title_without_year, year_of
from ratingloom.staging import one_value, stage


def drop_incomplete(ratings: DataFrame) -> DataFrame:
    """Drop rows with a null or NaN in any column."""
    return ratings.dropna()


def keep_valid_range(ratings: DataFrame, low: float = 0.5, high: float = 5.0) -> DataFrame:
    # NaN sorts above every number in Spark, so the upper bound also rejects it.
    return ratings.where(F.col("rating").between(low, high))


def latest_per_pair(ratings: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Keep the newest row of every (user, item); equal times keep the higher rating.

    Aggregates rather than a window: every map task keeps one row per pair, so a pair
    repeated any number of times never gathers in one task. The four usual columns take two hash
    aggregates. Further columns are part of the order after the rating, and need one sorted aggregate.
    """
    rest = [c for c in ratings.columns if c not in (user, item, "timestamp", "rating")]
    if not rest:
        when = F.coalesce("timestamp", F.lit(-(2**63)))  # a missing time is before all others
        best = ratings.groupBy(user, item, "timestamp").agg(F.max("rating").alias("rating"))
        newest = best.groupBy(user, item).agg(F.max("timestamp").alias("timestamp"), F.max_by("rating", when).alias("rating"))
        return newest.select(*ratings.columns)
    newest = F.max(F.struct("timestamp", "rating", *rest)).alias("_newest")
    kept = ratings.groupBy(user, item).agg(newest)
    return kept.select(*[c if c in (user, item) else F.col(f"_newest.{c}") for c in ratings.columns])


def clean_ratings(ratings: DataFrame, low: float = 0.5, high: float = 5.0) -> DataFrame:
    """Incomplete rows, then invalid ratings, then older duplicates: invalid rows never win a pair."""
    return latest_per_pair(keep_valid_range(drop_incomplete(ratings), low, high))


def _complete(df: DataFrame) -> Column:
    checks = [F.col(f.name).isNotNull() for f in df.schema.fields]
    checks += [~F.isnan(f.name) for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return reduce(lambda a, b: a & b, checks)


def cleaning_audit(ratings: DataFrame, low: float = 0.5, high: float = 5.0) -> DataFrame:
    """Row counts before and after cleaning, in one pass over the raw table."""
    valid = _complete(ratings) & F.col("rating").between(low, high)
    pairs = ratings.groupBy("userId", "movieId").agg(
        F.count("*").alias("n"), F.max(F.when(valid, 1).otherwise(0)).alias("kept")
    )
    initial, final = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("kept"), F.lit(0))
    return pairs.agg(
        initial.alias("initial_count"), final.alias("final_count"), (initial - final).alias("removed")
    )


def cleaned_with_audit(ratings: DataFrame, low: float = 0.5, high: float = 5.0) -> tuple[DataFrame, DataFrame]:
    """The stored cleaned table, and the audit of the same pass: the raw rows are counted as the scan of the one write
    reads them, the others as they are written. If a lost executor makes Spark scan a part again, its raw rows may
    count twice; ``cleaning_audit`` counts on its own."""
    raw, kept = Observation("raw rows"), Observation("clean rows")
    cleaned = clean_ratings(ratings.observe(raw, F.count(F.lit(1)).alias("n")), low, high)
    stored = stage(cleaned.observe(kept, F.count(F.lit(1)).alias("n")), "clean")
    initial, final = raw.get["n"], kept.get["n"]
    schema = "initial_count long, final_count long, removed long"
    return stored, ratings.sparkSession.createDataFrame([(initial, final, initial - final)], schema)


def to_implicit(ratings: DataFrame, threshold: float = 3.5) -> DataFrame:
    """Add the 0/1 column ``interaction``; a NaN rating counts as below the threshold."""
    liked = (F.col("rating") >= threshold) & ~F.isnan("rating")
    return ratings.withColumn("interaction", F.coalesce(liked.cast("int"), F.lit(0)))


def implicit_ratio(ratings: DataFrame, threshold: float = 3.5) -> DataFrame:
    flag = F.col("interaction")
    return to_implicit(ratings, threshold).agg(
        F.sum(flag).alias("positive_interactions"),
        F.count("*").alias("total_interactions"),
        F.round(F.avg(flag), 3).alias("positive_ratio"),
    )


def binarize(ratings: DataFrame, threshold: float = 3.5) -> DataFrame:
    """The same flag as a float, the value type of a matrix."""
    return to_implicit(ratings, threshold).withColumn("interaction", F.col("interaction").cast("float"))


def standardise_ratings(
    ratings: DataFrame, feedback_type: str = "explicit", threshold: float = 3.5
) -> DataFrame:
    """Library column names, plus the binary flag for implicit feedback. Order rows at a sink only."""
    renamed = ratings.withColumnsRenamed({"userId": "user_id", "movieId": "item_id"})
    return to_implicit(renamed, threshold) if feedback_type == "implicit" else renamed


def add_year(items: DataFrame) -> DataFrame:
    return items.withColumn("year", year_of(F.col("title")))


def add_clean_title(items: DataFrame) -> DataFrame:
    return items.withColumn("title_clean", title_without_year(F.col("title")))


def standardise_items(items: DataFrame) -> DataFrame:
    return add_clean_title(add_year(items.withColumnRenamed("movieId", "item_id")))


def dataset_summary(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Exact sizes of both tables in one row."""
    return interactions.agg(
        F.count("*").alias("n_interactions"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
    ).select(
        "*",
        one_value(items, F.count("*")).alias("n_catalogue"),
        one_value(items, F.count("year")).alias("n_with_year"),
    )
