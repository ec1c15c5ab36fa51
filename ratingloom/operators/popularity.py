"""Popularity model: one ranked list for everybody."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratingloom.operators.ordering import global_rank
from ratingloom.operators.unseen import first_unseen
from ratingloom.staging import one_value, stage


def item_scores(matrix: DataFrame, item_encoder: DataFrame) -> DataFrame:
    """``(item_idx, total, score)``: sum of values per item, divided by the largest sum."""
    totals = stage(matrix.groupBy("item_idx").agg(F.sum("value").alias("total")), "item-totals")
    known = item_encoder.select(F.col("idx").alias("item_idx"))
    every = known.join(totals, "item_idx", "left").select(
        "item_idx", F.coalesce("total", F.lit(0.0)).alias("total")
    )
    return every.withColumn("score", F.try_divide("total", one_value(every, F.max("total"))))


def ranked_items(scores: DataFrame) -> DataFrame:
    """Stored ``(item_idx, score, total, pos)``; ties go to the higher index."""
    return stage(global_rank(scores, F.desc("total"), F.desc("item_idx"), name="pos"), "ranked-items")


def recommend_popular_unseen(users: DataFrame, ranked: DataFrame, seen: DataFrame | None, k: int = 10) -> DataFrame:
    """``(user_idx, item_idx, score, rank)``: the same order for all users minus what each has seen."""
    if seen is None:
        positions = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(k).cast("long"))).alias("pos")
        head = F.broadcast(ranked.where(F.col("pos") <= k))  # k rows
        return (
            users.select("user_idx", positions)
            .join(head, "pos")
            .select("user_idx", "item_idx", "score", F.col("pos").cast("int").alias("rank"))
        )
    picked = first_unseen(users.select("user_idx"), ranked, seen, k, carry=("score",))
    return picked.select("user_idx", "item_idx", "score", "rank")


def similar_popular(items: DataFrame, ranked: DataFrame, n: int = 10) -> DataFrame:
    """Fallback neighbours ``(item_idx, similar_idx, similarity, rank)``: the most popular others.

    Only the first n + 1 entries can appear, so the plan has no shuffle.
    """
    head = ranked.where(F.col("pos") <= n + 1)
    own = F.broadcast(head.select("item_idx", F.col("pos").alias("_own")))
    listed = F.broadcast(head.select(F.col("item_idx").alias("similar_idx"), F.col("score").alias("similarity"), "pos"))
    positions = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n + 1).cast("long"))).alias("pos")
    rank = F.col("pos") - F.coalesce((F.col("pos") > F.col("_own")).cast("int"), F.lit(0))
    return (
        items.select("item_idx")
        .join(own, "item_idx", "left")
        .select("item_idx", "_own", positions)
        .where(F.col("_own").isNull() | (F.col("pos") != F.col("_own")))
        .withColumn("rank", rank.cast("int"))
        .where(F.col("rank") <= n)
        .join(listed, "pos")
        .select("item_idx", "similar_idx", "similarity", "rank")
    )
