"""Popularity blended with the user's genre preferences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.operators.genres import GenreIndex, preferences, signature_weights
from ratingloom.operators.ordering import global_rank
from ratingloom.operators.signature_blocks import promising_signatures
from ratingloom.operators.topk import score_key, with_rank
from ratingloom.operators.unseen import first_unseen, unseen_candidates
from ratingloom.staging import BROADCAST_ROWS, stage


def _of_users(rows: DataFrame, users: DataFrame, n_users: int) -> DataFrame:
    """Drop rows of other users where that needs no shuffle; later joins on the user drop the rest."""
    return rows.join(F.broadcast(users), "user_idx", "left_semi") if n_users <= BROADCAST_ROWS else rows


class HybridModel:
    """Stored tables of the blended model for one training matrix.

    An item's content score depends on its genre signature alone, so inside a signature items
    are ordered by popularity. ``lists`` ``(sig, pos, item_idx, score, place)`` holds these orders,
    with the item's place in the order of all items, which also breaks ties of the final score.
    """

    def __init__(self, matrix: DataFrame, ranked: DataFrame, index: GenreIndex, weight: float = 0.6):
        self.places, self.index, self.weight = ranked.withColumn("place", F.col("pos")), index, weight
        self.seen = matrix.select("user_idx", "item_idx")
        self.weights = stage(signature_weights(matrix, index), "signature-weights")
        self.preferences = stage(preferences(self.weights, index), "preferences")
        joined = ranked.withColumnRenamed("pos", "place").join(index.item_signatures, "item_idx")
        placed = global_rank(joined.select("sig", "item_idx", "score", "place"), F.asc("sig"), F.asc("place"), name="_at")
        starts = stage(placed.groupBy("sig").agg(F.min("_at").alias("_first")), "signature-starts")
        lists = placed.join(starts, "sig").withColumn("pos", F.col("_at") - F.col("_first") + 1)
        self.lists = stage(lists.select("sig", "pos", "item_idx", "score", "place"), "signature-lists")
        best = self.lists.where(F.col("pos") == 1).select("sig", "score", "place")
        named = index.signatures.where(F.col("size") > 0)
        self.best = stage(named.join(best, "sig"), "signature-best")
        # A user without any rating above 0 has no preferences at all and keeps the plain score.
        self.raters = stage(self.weights.where(F.col("n_rated") > 0).select("user_idx").distinct(), "raters")

    def recommend(self, users: DataFrame, k: int = 10, exclude_seen: bool = True) -> DataFrame:
        """``(user_idx, item_idx, score, rank)`` for the given users, a stored table of distinct rows."""
        users = users.select("user_idx")
        n_users = users.count()
        seen = _of_users(self.seen, users, n_users) if exclude_seen else self.seen.where(F.lit(False))
        candidates = self._from_signatures(users, n_users, seen, k, exclude_seen).unionByName(
            self._from_popularity(users, seen, k)
        )
        order = [F.desc("_key"), F.asc("place")]
        keyed = candidates.withColumn("_key", score_key(F.col("score")))
        return with_rank(keyed, ["user_idx"], order, k).select("user_idx", "item_idx", "score", "rank")

    def _blend(self, popularity: Column, content: Column) -> Column:
        return self.weight * popularity + (1 - self.weight) * content

    def _from_signatures(
        self, users: DataFrame, n_users: int, seen: DataFrame, k: int, exclude_seen: bool
    ) -> DataFrame:
        """Candidates that share a genre with the user.

        The best item of a signature stands for it. The best items of wholly unseen signatures
        ahead of a signature all come before its items, so with a of them only its first k - a
        unseen items can matter, and none when a reaches k.
        """
        prefs = self.preferences.join(users, "user_idx", "left_semi")
        touched = self.weights.select("user_idx", "sig").where(F.lit(exclude_seen))
        scored = promising_signatures(prefs, _of_users(touched, users, n_users), self.best, k, self.weight, n_users)
        best = self.best.select("sig", F.col("score").alias("_score"), F.col("place").alias("_place"))
        scored = scored.join(best, "sig")
        scored = scored.withColumn("_key", score_key(self._blend(F.col("_score"), F.col("content"))))
        order = Window.partitionBy("user_idx").orderBy(F.desc("_key"), F.asc("_place"))
        ahead = F.coalesce(F.sum(1 - F.col("touched")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        chosen = stage(
            scored.withColumn("quota", (k - ahead).cast("int"))
            .where(F.col("quota") > 0)
            .select("user_idx", "sig", "content", "quota"),
            "chosen-signatures",
        )
        picked = unseen_candidates(
            chosen.select("user_idx", "sig", "quota"), self.lists, seen, k, by=("sig",), carry=("score", "place")
        )
        return picked.join(chosen, ["user_idx", "sig"]).select(
            "user_idx", "item_idx", self._blend(F.col("score"), F.col("content")).alias("score"), "place"
        )

    def _from_popularity(self, users: DataFrame, seen: DataFrame, k: int) -> DataFrame:
        """Candidates that share no genre with the user, among them all items for users without preferences.

        These score by popularity alone, so only the user's first k unseen items can matter.
        """
        picked = first_unseen(users, self.places, seen, k, carry=("score", "place"))
        listed = picked.join(self.index.item_signatures, "item_idx")
        sharing = (
            listed.select("user_idx", "sig")
            .distinct()
            .join(self.index.signature_genres, "sig")
            .join(self.preferences, ["user_idx", "genre_idx"])
            .select("user_idx", "sig")
        )
        score = F.when(F.col("_rates"), self.weight * F.col("score")).otherwise(F.col("score"))
        return (
            listed.join(sharing, ["user_idx", "sig"], "left_anti")
            .join(self.raters.withColumn("_rates", F.lit(True)), "user_idx", "left")
            .select("user_idx", "item_idx", score.alias("score"), "place")
        )
