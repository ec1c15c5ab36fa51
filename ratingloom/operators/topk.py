"""Top rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


SCORE_SCALE = 1e9


def score_key(score: Column) -> Column:
    """Score as whole billionths, the value scores are ranked by.

    Sums in another order differ in the last bits only, so they cannot reorder ties. Integer
    arithmetic stays in generated code, unlike decimal rounding.
    """
    return F.floor(score * SCORE_SCALE + 0.5)


def with_rank(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows per key with their 1-based rank.

    Spark limits every key to k rows before the shuffle (WindowGroupLimit), so a heavy key
    never gathers in one task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, position).where(F.col(name) <= k)
