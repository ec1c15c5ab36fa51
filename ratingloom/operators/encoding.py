"""Dense 0-based indices for user and item ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratingloom.operators.ordering import global_rank
from ratingloom.staging import stage


def fit_encoder(train: DataFrame, column: str) -> DataFrame:
    """Stored table ``(id, idx)``: the distinct ids in ascending order, numbered from 0."""
    ids = train.select(F.col(column).alias("id")).distinct()
    ranked = global_rank(ids, F.col("id"), name="position")
    return stage(ranked.select("id", (F.col("position") - 1).alias("idx")), f"encoder-{column}")


def encode(
    df: DataFrame, users: DataFrame, items: DataFrame, unknown: str = "ignore"
) -> DataFrame:
    """Add ``user_idx`` and ``item_idx``; unknown ids drop the row or, with ``"error"``, raise."""
    how = "inner" if unknown == "ignore" else "left"
    out = df
    for encoder, column, index in ((users, "user_id", "user_idx"), (items, "item_id", "item_idx")):
        lookup = encoder.select(F.col("id").alias(column), F.col("idx").alias(index))
        out = out.join(lookup, column, how)
        if how == "left":
            message = F.concat(F.lit(f"unknown {column}: "), F.col(column).cast("string"))
            out = out.withColumn(index, F.coalesce(F.col(index), F.raise_error(message).cast("long")))
    return out.select(*df.columns, "user_idx", "item_idx")


def decode(df: DataFrame, encoder: DataFrame, index: str, column: str) -> DataFrame:
    """Add the original id of an index column."""
    lookup = encoder.select(F.col("idx").alias(index), F.col("id").alias(column))
    return df.join(lookup, index)


def lookup(ids: DataFrame, encoder: DataFrame, column: str = "id", index: str = "idx") -> DataFrame:
    """Index of every requested id, null when unknown."""
    table = encoder.select(F.col("id").alias(column), F.col("idx").alias(index))
    return ids.join(table, column, "left")


def page(encoder: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """One page of known ids with the total count. The index is the position, so nothing is sorted."""
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("limit must be 1..1000 and offset not negative")
    total = encoder.agg(F.count("*").alias("n")).scalar()
    inside = encoder.where(F.col("idx").between(offset, offset + limit - 1))
    return inside.select("id", total.alias("count"))
