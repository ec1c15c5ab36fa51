"""Dense core of users and items, by propagated degrees."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F

from ratingloom.staging import broadcast_if_small, stage

BUCKETS = 64  # of a copy of the edges, by the id of one side
FULL_SCANS = 3  # of a side's edges, before it is worth a copy in buckets


class _Edges:
    """The edges of one side, read by the ids that drop out.

    The first rounds drop many ids and scan the whole table; when a side is still losing ids after that, its
    edges are stored once in buckets of its id, and a round reads only the buckets of the ids it drops.
    """

    def __init__(self, edges: DataFrame, key: str, visits: Callable[[str, int], None]):
        self.edges, self.key, self.visits, self.scans = edges, key, visits, 0

    def of(self, ids: DataFrame) -> DataFrame:
        edges, self.scans = self.edges, self.scans + 1
        if self.scans > FULL_SCANS:
            bucket = F.pmod(F.xxhash64(self.key), F.lit(BUCKETS)).cast("int")
            if "bucket" not in edges.columns:
                dealt = edges.withColumn("bucket", bucket).repartition(BUCKETS, "bucket")
                self.edges = edges = stage(dealt, f"edges-{self.key}", partition_by=("bucket",))
            wanted = sorted(r["b"] for r in ids.select(bucket.alias("b")).distinct().collect())  # BUCKETS rows at most
            edges = edges.where(F.col("bucket").isin(wanted))
            self.visits(self.key, len(wanted))
        else:
            self.visits(self.key, BUCKETS)
        return edges.join(broadcast_if_small(ids), self.key, "left_semi")


def core_filter(
    interactions: DataFrame, min_user: int = 5, min_item: int = 5, visits: Callable[[str, int], None] = lambda key, buckets: None
) -> DataFrame:
    """Largest sub-table in which every user has ``min_user`` rows and every item ``min_item``.

    Degrees are counted once. A round takes the ids of one side that fell below the minimum and joins only their edges,
    which lowers degrees of the other side; what falls below the minimum there is the next round. An id is dropped
    once, so each edge is met once from either end, and any chain settles. ``interactions`` should be a stored
    table. ``visits`` is told of each round, its side and how many of ``BUCKETS`` buckets it read.
    """
    return _peel(interactions, min_user, min_item, visits)[0]


def core_with_audit(interactions: DataFrame, min_user: int = 5, min_item: int = 5) -> tuple[DataFrame, DataFrame]:
    """The stored core, and its audit without another scan: ids are counted in the tables of degrees and of dropped ids, the
    rows that stay as they are written."""
    core, degrees, gone = _peel(interactions, min_user, min_item, lambda key, buckets: None)
    kept = Observation("core rows")
    stored = stage(core.observe(kept, F.count(F.lit(1)).alias("n")), "core")
    rows = kept.get["n"]
    before = degrees["user_id"].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()["rows"]
    all_ids = {key: table.count() for key, table in degrees.items()}
    out = {key: gone[key].count() if key in gone else 0 for key in degrees}
    left = {key: all_ids[key] - out[key] for key in degrees}
    names = ["interactions_removed", "users_removed", "items_removed", "final_interactions", "final_users", "final_items"]
    row = (before - rows, out["user_id"], out["item_id"], rows, left["user_id"], left["item_id"])
    return stored, interactions.sparkSession.createDataFrame([row], ", ".join(f"{name} long" for name in names))


def _peel(
    interactions: DataFrame, min_user: int, min_item: int, visits: Callable[[str, int], None]
) -> tuple[DataFrame, dict[str, DataFrame], dict[str, DataFrame]]:
    """The core, the degrees of all ids, and the ids that were dropped, by side."""
    minimum = {"user_id": min_user, "item_id": min_item}
    other = {"user_id": "item_id", "item_id": "user_id"}
    pairs = interactions.select("user_id", "item_id")
    edges = {key: _Edges(pairs, key, visits) for key in minimum}
    degrees = {key: stage(pairs.groupBy(key).agg(F.count("*").alias("n")), f"degrees-{key}") for key in minimum}
    waiting = {key: [stage(degrees[key].where(F.col("n") < least).select(key), f"rare-{key}")] for key, least in minimum.items()}
    waiting = {key: [ids for ids in parts if not ids.isEmpty()] for key, parts in waiting.items()}
    dropped: dict[str, list[DataFrame]] = {key: [] for key in minimum}
    lost: dict[str, DataFrame] = {}
    while any(waiting.values()):
        key = max(waiting, key=lambda k: bool(waiting[k]))
        side = other[key]
        now = reduce(DataFrame.unionByName, waiting[key])
        dropped[key] += waiting[key]
        waiting[key] = []
        new = edges[key].of(now).groupBy(side).agg(F.count("*").alias("new"))
        new = stage(new.join(lost[side], side, "left") if side in lost else new.withColumn("old", F.lit(0).cast("long")), f"lost-{side}")
        left = F.col("n") - F.coalesce("old", F.lit(0))
        fell = (left >= minimum[side]) & (left - F.col("new") < minimum[side])
        ids = stage(degrees[side].join(new, side).where(fell).select(side), f"rare-{side}")
        if not ids.isEmpty():
            waiting[side].append(ids)
        total = new.select(side, (F.coalesce("old", F.lit(0)) + F.col("new")).alias("old"))
        if side in lost:
            total = total.unionByName(lost[side].join(new, side, "left_anti"))
            total = stage(total, f"total-{side}")
        lost[side] = total
    kept, gone = interactions, {}
    for key, parts in dropped.items():
        if parts:
            gone[key] = stage(reduce(DataFrame.unionByName, parts), f"dropped-{key}") if len(parts) > 1 else parts[0]
            kept = kept.join(gone[key], key, "left_anti")
    return kept, degrees, gone


def core_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """What the core filter removed and kept, one row."""

    def sizes(df: DataFrame, prefix: str) -> DataFrame:
        return df.agg(
            F.count("*").alias(f"{prefix}_interactions"),
            F.count_distinct("user_id").alias(f"{prefix}_users"),
            F.count_distinct("item_id").alias(f"{prefix}_items"),
        )

    first, last = sizes(before, "b"), sizes(after, "final")
    columns = []
    for what in ("interactions", "users", "items"):
        initial = first.select(f"b_{what}").scalar()
        columns.append((initial - F.col(f"final_{what}")).alias(f"{what}_removed"))
    return last.select(*columns, "final_interactions", "final_users", "final_items")
