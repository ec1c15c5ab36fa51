"""Exact train/validation/test splits.

Only the few rows at the cut positions are looked for; the split itself is a row-wise
comparison with their keys, so the interactions are neither sorted nor shuffled.
Inputs should be stored tables, since finding the cuts scans them a few times.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from ratingloom.operators.ordering import follows, keys_at, precedes
from ratingloom.staging import stage

PARTS = ("train", "val", "test")
TIME_KEYS = ["timestamp", "user_id", "item_id"]
HASH_KEYS = ["_hash", "user_id", "item_id"]
HASH_BOUNDS = (0, 16**15 - 1)


def _check(ratios: Sequence[float]) -> None:
    if abs(sum(ratios) - 1.0) > 1e-6:
        raise ValueError(f"ratios must sum to 1.0, got {sum(ratios)}")


@dataclass(frozen=True)
class Cuts:
    """Key tuples of the first rows of all parts but the first, in the order by ``keys``."""

    keys: list[str]
    names: Sequence[str]
    at: list[tuple | None]

    def label(self, df: DataFrame) -> DataFrame:
        """Add ``split`` to every row."""
        part = F.lit(self.names[-1])
        for name, cut in reversed(list(zip(self.names, self.at))):
            part = F.when(precedes(self.keys, cut), F.lit(name)).otherwise(part)
        return df.withColumn("split", part)

    def part(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of one part, by comparisons that reach the scan."""
        i = list(self.names).index(name)
        rows = df.where(follows(self.keys, self.at[i - 1])) if i else df
        return rows.where(precedes(self.keys, self.at[i])) if i < len(self.at) else rows


def _cuts(
    df: DataFrame,
    keys: list[str],
    ends: Callable[[int], list[int]],
    names: Sequence[str],
    bounds: tuple[int, int] | None = None,
) -> Cuts:
    return Cuts(keys, names, keys_at(df, keys, ends, bounds))


def _hashed(df: DataFrame, seed: int) -> DataFrame:
    """A seeded 60-bit hash of the pair: an order that depends on the row alone."""
    text = F.concat_ws("#", F.lit(str(seed)), F.col("user_id").cast("string"), F.col("item_id").cast("string"))
    digits = F.substring(F.md5(text.cast("binary")), 1, 15)
    return df.withColumn("_hash", F.conv(digits, 16, 10).cast("long"))


def _three_ends(train: float, val: float) -> Callable[[int], list[int]]:
    return lambda n: [int(n * train), int(n * (train + val))]


def temporal_split(
    interactions: DataFrame, train: float = 0.8, val: float = 0.1, test: float = 0.1
) -> DataFrame:
    """Add ``split``: oldest rows are train, the next validation, the newest test."""
    return temporal_cuts(interactions, train, val, test).label(interactions)


def temporal_cuts(interactions: DataFrame, train: float = 0.8, val: float = 0.1, test: float = 0.1) -> Cuts:
    """Where a temporal split cuts."""
    _check((train, val, test))
    return _cuts(interactions, TIME_KEYS, _three_ends(train, val), PARTS)


def random_split(
    interactions: DataFrame, train: float = 0.8, val: float = 0.1, test: float = 0.1, seed: int = 42
) -> DataFrame:
    """The same cut rule over a seeded random order that does not depend on the partitioning."""
    _check((train, val, test))
    hashed = stage(_hashed(interactions, seed), "hashed")
    return _cuts(hashed, HASH_KEYS, _three_ends(train, val), PARTS, HASH_BOUNDS).label(hashed).drop("_hash")


def nway_split(interactions: DataFrame, ratios: Sequence[float], seed: int = 42) -> DataFrame:
    """Add ``part`` 0..len(ratios)-1; every part but the last has ``int(n * ratio)`` rows."""
    _check(ratios)

    def ends(n: int) -> list[int]:
        return list(accumulate(int(n * ratio) for ratio in ratios[:-1]))

    names = [str(i) for i in range(len(ratios))]
    hashed = stage(_hashed(interactions, seed), "hashed")
    labelled = _cuts(hashed, HASH_KEYS, ends, names, HASH_BOUNDS).label(hashed)
    return labelled.withColumn("part", F.col("split").cast("int")).drop("_hash", "split")


def split_summary(labelled: DataFrame) -> DataFrame:
    """Size and end of every part."""
    end = F.timestamp_seconds(F.max("timestamp"))
    return labelled.groupBy("split").agg(F.count("*").alias("size"), F.to_date(end).alias("end_date"))


def part_of(labelled: DataFrame, name: str) -> DataFrame:
    return labelled.where(F.col("split") == name).drop("split")
