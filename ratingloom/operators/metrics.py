"""Ranking and error metrics as one distributed aggregation.

Inputs are long tables: ``recs`` ``(user, item, rank)`` and ``relevant`` ``(user, item[, grade])``.
Averages run over users with a relevant item; users without recommendations count as 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log2

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.operators.topk import with_rank


def rmse(pairs: DataFrame) -> DataFrame:
    error = F.col("y_true") - F.col("y_pred")
    return pairs.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def mae(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"))


def _discount(rank: Column) -> Column:
    return F.log2(rank + 1)


def dcg(relevances: DataFrame, k: int) -> DataFrame:
    """Discounted gain per user of ``(user, rank, relevance)``."""
    gain = F.col("relevance") / _discount(F.col("rank"))
    inside = F.when(F.col("rank") <= k, gain).otherwise(0.0)
    return relevances.groupBy("user").agg(F.sum(inside).alias("dcg"))


def _hits(recs: DataFrame, relevant: DataFrame, max_k: int) -> DataFrame:
    """Recommended relevant items with the running number of hits in the first ``max_k`` ranks."""
    hits = recs.join(relevant, ["user", "item"])
    # A repeated item counts once for precision and recall.
    first = F.row_number().over(Window.partitionBy("user", "item").orderBy("rank")) == 1
    # Later ranks only matter for the reciprocal rank. Cutting every list into stretches of
    # max_k ranks keeps each window group that small, however long a list is.
    stretch = F.ceil(F.col("rank") / max_k)
    running = F.count("*").over(Window.partitionBy("user", stretch).orderBy("rank"))
    return hits.withColumn("first", first).withColumn("running", running)


def _ideal(n_relevant: Column, k: int) -> Column:
    """Ideal gain of min(n, k) ones, from a lookup with k + 1 entries."""
    sums, total = [0.0], 0.0
    for rank in range(1, k + 1):
        total += 1.0 / log2(rank + 1)
        sums.append(total)
    return F.element_at(F.array(*[F.lit(s) for s in sums]), (F.least(n_relevant, F.lit(k)) + 1).cast("int"))


def user_metrics(recs: DataFrame, relevant: DataFrame, k_values: Sequence[int]) -> DataFrame:
    """Per-user precision, recall, NDCG and AP at every k, and the reciprocal rank."""
    if not k_values or min(k_values) <= 0:
        raise ValueError("every k must be positive")
    relevant = relevant.select("user", "item").distinct()
    recs = recs.select("user", "item", "rank")
    counts = relevant.groupBy("user").agg(F.count("*").alias("n_relevant"))
    rank, sums = F.col("rank"), []
    for k in k_values:
        inside = rank <= k
        sums += [
            F.count_if(inside & F.col("first")).alias(f"hits_{k}"),
            F.sum(F.when(inside, 1 / _discount(rank)).otherwise(0.0)).alias(f"dcg_{k}"),
            F.sum(F.when(inside, F.col("running") / rank).otherwise(0.0)).alias(f"ap_{k}"),
        ]
    sums.append(F.min("rank").alias("first_rank"))
    per_user = _hits(recs, relevant, max(k_values)).groupBy("user").agg(*sums)
    joined = counts.join(per_user, "user", "left")
    n = F.col("n_relevant")
    columns = ["user", "n_relevant"]
    for k in k_values:
        columns += [
            F.coalesce(F.col(f"hits_{k}") / k, F.lit(0.0)).alias(f"precision_at_{k}"),
            F.coalesce(F.col(f"hits_{k}") / n, F.lit(0.0)).alias(f"recall_at_{k}"),
            F.coalesce(F.col(f"dcg_{k}") / _ideal(n, k), F.lit(0.0)).alias(f"ndcg_at_{k}"),
            F.coalesce(F.col(f"ap_{k}") / F.least(n, F.lit(k)), F.lit(0.0)).alias(f"map_at_{k}"),
        ]
    return joined.select(*columns, F.coalesce(1 / F.col("first_rank"), F.lit(0.0)).alias("rr"))


def _single(name: str):
    def metric(recs: DataFrame, relevant: DataFrame, k: int = 10) -> DataFrame:
        return user_metrics(recs, relevant, [k]).select("user", F.col(f"{name}_at_{k}").alias(name))

    metric.__doc__ = f"Per-user ``(user, {name})`` at k."
    return metric


precision_at_k, recall_at_k, ndcg_at_k, average_precision_at_k = (
    _single(name) for name in ("precision", "recall", "ndcg", "map")
)


def reciprocal_rank(recs: DataFrame, relevant: DataFrame) -> DataFrame:
    """Per-user ``(user, rr)`` over the whole list."""
    return user_metrics(recs, relevant, [1]).select("user", "rr")


def mean_metric(per_user: DataFrame, name: str) -> DataFrame:
    """Macro average of one per-user metric, 0.0 without users."""
    return per_user.agg(F.coalesce(F.avg(name), F.lit(0.0)).alias(name))


def average_metrics(per_user: DataFrame) -> DataFrame:
    """Macro average in one row; 0.0 everywhere when no user was evaluated."""
    names = [c for c in per_user.columns if "_at_" in c]
    averages = [F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in names]
    return per_user.agg(
        *averages, F.coalesce(F.avg("rr"), F.lit(0.0)).alias("mrr"), F.count("*").alias("n_users_evaluated")
    )


def all_metrics(
    recs: DataFrame, relevant: DataFrame, k_values: Sequence[int] = (5, 10, 20), pairs: DataFrame | None = None
) -> DataFrame:
    """All ranking metrics in one row, with RMSE and MAE when prediction pairs are given."""
    row = average_metrics(user_metrics(recs, relevant, k_values))
    if pairs is None:
        return row
    return row.select("*", rmse(pairs).scalar().alias("rmse"), mae(pairs).scalar().alias("mae"))


def graded_ndcg(recs: DataFrame, graded: DataFrame, k: int) -> DataFrame:
    """Per-user NDCG with grades; the ideal list is the user's grades in falling order."""
    ideal = (
        with_rank(graded, ["user"], [F.desc("grade"), F.asc("item")], k, name="place")
        .groupBy("user")
        .agg(F.sum(F.col("grade") / _discount(F.col("place"))).alias("ideal"))
    )
    got = (
        recs.where(F.col("rank") <= k)
        .join(graded, ["user", "item"])
        .groupBy("user")
        .agg(F.sum(F.col("grade") / _discount(F.col("rank"))).alias("dcg"))
    )
    value = F.when(F.col("ideal") == 0, 0.0).otherwise(F.coalesce(F.col("dcg"), F.lit(0.0)) / F.col("ideal"))
    return ideal.join(got, "user", "left").select("user", value.alias("ndcg"))


def by_k(metrics: DataFrame, k_values: Sequence[int]) -> DataFrame:
    """The wide row as rows ``(k, precision, recall, ndcg, map)``; missing values are 0."""

    def value(name: str, k: int) -> Column:
        column = f"{name}_at_{k}"
        return F.coalesce(F.col(column), F.lit(0.0)) if column in metrics.columns else F.lit(0.0)

    names = ("precision", "recall", "ndcg", "map")
    rows = [F.struct(F.lit(k).alias("k"), *[value(m, k).alias(m) for m in names]) for k in k_values]
    return metrics.select(F.explode(F.array(*rows)).alias("row")).select("row.*")
