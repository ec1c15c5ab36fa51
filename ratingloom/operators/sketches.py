"""Distinct counts from stored sketches that merge: approximate sizes of any range of days without the interactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LG_REGISTERS = 14  # 2^14 registers; the relative error is below 2 % at three standard deviations


def day_of(timestamp: Column) -> Column:
    """Day of epoch seconds."""
    return F.to_date(F.timestamp_seconds(timestamp))


def daily_sketches(interactions: DataFrame, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """``(day, n_interactions, users, items)``: rows and two sketches a day. Sketches are built in the map tasks and merged by
    day; new days are appended to a stored table, and a day that was written twice only doubles its rows."""
    return interactions.groupBy(day_of(F.col("timestamp")).alias("day")).agg(
        F.count("*").alias("n_interactions"),
        F.hll_sketch_agg("user_id", lg_registers).alias("users"),
        F.hll_sketch_agg("item_id", lg_registers).alias("items"),
    )


def merged_sizes(sketches: DataFrame, *by: Column) -> DataFrame:
    """``(*by, n_interactions, n_users, n_items)`` of stored daily sketches: exact rows, estimated distinct ids."""
    merged = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("n_interactions"), F.lit(0)).alias("n_interactions"),
        F.hll_union_agg("users").alias("users"),
        F.hll_union_agg("items").alias("items"),
    )
    names = [c for c in merged.columns if c not in ("n_interactions", "users", "items")]
    size = lambda c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).alias(f"n_{c}")
    return merged.select(*names, "n_interactions", size("users"), size("items"))
