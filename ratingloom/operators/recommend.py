"""Batch forms of the recommendation requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from ratingloom.operators.encoding import decode, lookup, page
from ratingloom.sources.bucketed import rows_of_keys
from ratingloom.staging import one_value, stage

Recommend = Callable[[DataFrame, int], DataFrame]


def check_k(k: int) -> int:
    if not 1 <= k <= 100:
        raise ValueError("k must be 1..100")
    return k


def add_metadata(rows: DataFrame, catalogue: DataFrame, prefix: str | None = None, column: str = "item_id") -> DataFrame:
    """Left join title and genres; with ``prefix`` items outside the catalogue are titled ``<prefix><id>``.

    ``catalogue`` ``(item_id, title, genres)`` has unique ids.
    """
    joined = rows.join(catalogue.withColumnRenamed("item_id", column), column, "left")
    if prefix is None:
        return joined
    default = F.concat(F.lit(prefix), F.col(column).cast("string"))
    return joined.withColumns({"title": F.coalesce("title", default), "genres": F.coalesce("genres", F.lit(""))})


def recommend_known(
    requests: DataFrame,
    users: DataFrame,
    items_encoder: DataFrame,
    catalogue: DataFrame,
    recommend: Recommend,
    k: int = 10,
) -> DataFrame:
    """``(user_id, rank, item_id, score, title, genres)`` for requested users the model knows."""
    check_k(k)
    known = stage(
        lookup(requests.select("user_id").distinct(), users, "user_id", "user_idx").where(
            F.col("user_idx").isNotNull()
        ),
        "known-users",
    )
    recs = recommend(known.select("user_idx"), k)
    named = decode(recs, items_encoder, "item_idx", "item_id").join(known, "user_idx")
    return add_metadata(named, catalogue, "Item ").select("user_id", "rank", "item_id", "score", "title", "genres")


def popular_items(popularity: DataFrame, catalogue: DataFrame, n: int = 10) -> DataFrame:
    """``(rank, item_id, score, title, genres)``: the n most popular items, lower id first on ties."""
    order = [F.desc("popularity_score"), F.asc("item_id")]
    top = popularity.orderBy(*order).limit(n)
    ranked = top.select(  # the window sees n rows
        F.row_number().over(Window.orderBy(*order)).alias("rank"), "item_id", F.col("popularity_score").alias("score")
    )
    described = catalogue.join(F.broadcast(ranked.select("item_id")), "item_id", "left_semi")  # n rows
    return ranked.join(described, "item_id", "left").select("rank", "item_id", "score", "title", "genres")


def recommend_cold(
    requests: DataFrame, users: DataFrame, popularity: DataFrame, catalogue: DataFrame, k: int = 10
) -> DataFrame:
    """The popular list for every requested user the model does not know."""
    check_k(k)
    unknown = requests.select("user_id").distinct().join(
        users.select(F.col("id").alias("user_id")), "user_id", "left_anti"
    )
    ranks = F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank")
    listed = F.broadcast(popular_items(popularity, catalogue, k))  # k rows
    return unknown.select("user_id", ranks).join(listed, "rank").select(
        "user_id", "rank", "item_id", "score", "title", "genres"
    )


def similar_items(
    requests: DataFrame,
    items_encoder: DataFrame,
    catalogue: DataFrame,
    similar: Callable[[DataFrame, int], DataFrame],
    k: int = 10,
) -> DataFrame:
    """``(item_id, rank, similar_item_id, similarity, title, genres)``; unknown items give no rows."""
    check_k(k)
    known = stage(
        lookup(requests.select("item_id").distinct(), items_encoder, "item_id", "item_idx").where(
            F.col("item_idx").isNotNull()
        ),
        "known-items",
    )
    found = similar(known.select("item_idx"), k).join(known, "item_idx")
    named = decode(found, items_encoder, "similar_idx", "similar_item_id")
    return add_metadata(named, catalogue, column="similar_item_id").select(
        "item_id", "rank", "similar_item_id", "similarity", "title", "genres"
    )


def user_history(
    requests: DataFrame, matrix: DataFrame, users: DataFrame, items_encoder: DataFrame, catalogue: DataFrame
) -> DataFrame:
    """``(user_id, item_id, rating, title)`` of the train items of the requested users."""
    known = stage(
        lookup(requests.select("user_id").distinct(), users, "user_id", "user_idx").where(
            F.col("user_idx").isNotNull()
        ),
        "known-users",
    )
    mine = matrix.join(known, "user_idx")
    named = decode(mine, items_encoder, "item_idx", "item_id").withColumnRenamed("value", "rating")
    default = F.concat(F.lit("Item "), F.col("item_id").cast("string"))
    titles = catalogue.select("item_id", F.coalesce("title", default).alias("title"))
    return named.join(titles, "item_id", "left").select("user_id", "item_id", "rating", "title")


def history_of(
    requests: DataFrame, clustered: DataFrame, users: DataFrame, items_encoder: DataFrame, catalogue: DataFrame
) -> DataFrame:
    """``user_history`` of a few users from a matrix that ``store_clustered`` wrote by ``user_idx``: their indices are a filter
    of the scan, which reads the row groups that may hold them."""
    known = lookup(requests.select("user_id").distinct(), users, "user_id", "user_idx").where(F.col("user_idx").isNotNull())
    mine = rows_of_keys(clustered, "user_idx", known.select("user_idx"))
    return user_history(requests, mine, users, items_encoder, catalogue)


def items_page(items_encoder: DataFrame, catalogue: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of known items with title and genres."""
    rows = page(items_encoder, limit, offset).withColumnRenamed("id", "item_id")
    return add_metadata(rows, catalogue, "Film #").select("item_id", "title", "genres", "count")


def model_counts(users: DataFrame, items_encoder: DataFrame) -> DataFrame:
    return users.agg(F.count("*").alias("n_users")).select(
        "n_users", one_value(items_encoder, F.count("*")).alias("n_items")
    )
