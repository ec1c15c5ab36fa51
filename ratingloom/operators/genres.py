"""Genres of items and genre preferences of users, in long form.

Items are grouped by *signature*, their sorted set of genres. Everything that depends on an
item only through its genres is computed once per signature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ratingloom.functions.titles import genre_list
from ratingloom.operators.ordering import global_rank
from ratingloom.staging import stage


def genre_vocabulary(items: DataFrame) -> DataFrame:
    """Stored ``(genre, genre_idx)``: the distinct genres of all items in sorted order, from 0."""
    genres = items.select(F.explode(genre_list(F.col("genres"))).alias("genre")).distinct()
    ranked = global_rank(genres, F.col("genre"), name="position")
    return stage(ranked.select("genre", (F.col("position") - 1).alias("genre_idx")), "genres")


def unique_items(items: DataFrame) -> DataFrame:
    """One row ``(item_id, title, genres)`` per id; of a repeated id the smallest row is kept."""
    row = F.min(F.struct("title", "genres")).alias("row")
    return items.groupBy("item_id").agg(row).select("item_id", "row.title", "row.genres")


def item_genres(item_encoder: DataFrame, items: DataFrame) -> DataFrame:
    """``(item_idx, genres array)`` for every encoded item; no genres when the catalogue lacks it."""
    known = item_encoder.select(F.col("idx").alias("item_idx"), F.col("id").alias("item_id"))
    return known.join(unique_items(items), "item_id", "left").select("item_idx", genre_list(F.col("genres")).alias("genres"))


def genre_features(item_encoder: DataFrame, items: DataFrame) -> DataFrame:
    """The one-hot genre matrix in long form ``(item_idx, genre)``."""
    return item_genres(item_encoder, items).select("item_idx", F.explode("genres").alias("genre"))


class GenreIndex:
    """Stored signature tables of one catalogue.

    ``item_signatures`` ``(item_idx, sig)``, ``signatures`` ``(sig, genre_ids, size)`` and
    ``signature_genres`` ``(sig, genre_idx, size)``. Signature 0.. in sorted order.
    """

    def __init__(self, item_encoder: DataFrame, items: DataFrame):
        self.vocabulary = genre_vocabulary(items)
        listed = stage(item_genres(item_encoder, items), "item-genres")
        distinct = global_rank(listed.select("genres").distinct(), F.col("genres"), name="position")
        named = stage(distinct.select("genres", (F.col("position") - 1).alias("sig")), "signature-names")
        self.item_signatures = stage(listed.join(named, "genres").select("item_idx", "sig"), "item-signatures")
        exploded = named.select("sig", F.size("genres").alias("size"), F.explode("genres").alias("genre"))
        self.signature_genres = stage(
            exploded.join(self.vocabulary, "genre").select("sig", "genre_idx", "size"), "signature-genres"
        )
        grouped = self.signature_genres.groupBy("sig").agg(F.array_sort(F.collect_list("genre_idx")).alias("genre_ids"))
        empty = F.array().cast("array<long>")
        self.signatures = stage(
            named.select("sig", F.size("genres").alias("size"))
            .join(grouped, "sig", "left")
            .withColumn("genre_ids", F.coalesce("genre_ids", empty)),
            "signatures",
        )


def signature_weights(matrix: DataFrame, index: GenreIndex) -> DataFrame:
    """``(user_idx, sig, weight, n_seen)``: liking weight and rated items per user and signature.

    The weight grows from 0 at a rating of 2.5 to 1 at 5.
    """
    weight = F.greatest(F.lit(0.0), (F.col("value") - 2.5) / 2.5)
    rated = F.col("value") > 0
    return (
        matrix.join(index.item_signatures, "item_idx")
        .groupBy("user_idx", "sig")
        .agg(
            F.sum(F.when(rated, weight).otherwise(0.0)).alias("weight"),
            F.count_if(rated).alias("n_rated"),
            F.count("*").alias("n_seen"),
        )
    )


def preferences(weights: DataFrame, index: GenreIndex) -> DataFrame:
    """``(user_idx, genre_idx, pref)``: unit preference vectors, zero entries left out."""
    raw = (
        weights.where(F.col("weight") > 0)
        .join(index.signature_genres, "sig")
        .groupBy("user_idx", "genre_idx")
        .agg(F.sum("weight").alias("weight"))
    )
    # At most one row per genre and user, so the window is bounded by the vocabulary.
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("user_idx")))
    return raw.select("user_idx", "genre_idx", (F.col("weight") / norm).alias("pref"))


def user_genre_preferences(matrix: DataFrame, index: GenreIndex) -> DataFrame:
    """Named preferences ``(user_idx, genre, pref)``."""
    prefs = preferences(signature_weights(matrix, index), index)
    return prefs.join(index.vocabulary, "genre_idx").select("user_idx", "genre", "pref")


def content_scores(pairs: DataFrame, prefs: DataFrame, index: GenreIndex) -> DataFrame:
    """Content score of given (user, item) pairs; 0 when they share no genre."""
    pairs = pairs.select("user_idx", "item_idx")
    wanted = pairs.join(index.item_signatures, "item_idx")
    # Score every distinct (user, signature) once; pairs that share it reuse the result.
    distinct = wanted.select("user_idx", "sig").distinct()
    scored = (
        distinct.join(index.signature_genres, "sig")
        .join(prefs, ["user_idx", "genre_idx"])
        .groupBy("user_idx", "sig")
        .agg((F.sum("pref") / F.sqrt(F.max("size"))).alias("content"))
    )
    # Stored, so that a (user, signature) with very many pairs can be split in the join.
    scored = stage(scored, "content")
    return wanted.join(scored, ["user_idx", "sig"], "left").select(
        "user_idx", "item_idx", F.coalesce("content", F.lit(0.0)).alias("content")
    )
