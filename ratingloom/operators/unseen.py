"""First unseen entries of ranked lists, for many users at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ratingloom.operators.topk import with_rank
from ratingloom.staging import BROADCAST_ROWS, broadcast_if_small, stage

CHUNK = 65_536  # longest array built when positions are expanded


def _expand(requests: DataFrame, keys: list[str], upto: str, limit: int) -> DataFrame:
    """Rows ``keys + pos`` for pos = 1..upto, in bounded pieces when ``upto`` may be long."""
    if limit <= CHUNK:
        return requests.select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), F.col(upto))).alias("pos"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({upto} - 1) div {CHUNK}")))
    pieces = requests.select(*keys, upto, starts.alias("_piece")).repartition(*keys, "_piece")
    low = F.col("_piece") * CHUNK + 1
    high = F.least(F.col(upto), (F.col("_piece") + 1) * CHUNK)
    return pieces.select(*keys, F.explode(F.sequence(low, high)).alias("pos"))


def unseen_candidates(
    requests: DataFrame,
    ranked: DataFrame,
    seen: DataFrame,
    k: int,
    by: tuple[str, ...] = (),
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Unseen entries of ranked lists that include the first ones every request asks for.

    ``requests`` ``(user_idx, *by[, quota])`` distinct, with at most ``k`` entries wanted per row
    (``quota`` lowers that); ``ranked`` stored ``(*by, pos, item_idx, *carry)`` with pos 1.. per
    list and every item in one list only; ``seen`` distinct ``(user_idx, item_idx)``.
    Returns ``(user_idx, *by, item_idx, pos, *carry)``.

    Nearly all users are served by the head of the list. Only seen pairs on items of that head
    matter, which drops almost all of ``seen`` before any shuffle. A user with c seen entries
    among the first ``cut`` needs positions up to k + c. Users whose head has fewer than k unseen
    entries go to a round with a longer head, until the list ends, so the result is exact and a
    user costs in proportion to what they have seen.
    """
    keys = ["user_idx", *by]
    if "quota" not in requests.columns:
        requests = requests.withColumn("quota", F.lit(k))
    longest = ranked.agg(F.max("pos")).first()[0] or 0
    cut = max(2 * k, 32)
    rounds = []
    while True:
        head = ranked.where(F.col("pos") <= cut)
        if by:
            head = broadcast_if_small(head)
        elif cut <= BROADCAST_ROWS:  # one list: at most ``cut`` rows
            head = F.broadcast(head)
        in_head = seen.join(head.select("item_idx", "pos", *by), "item_idx").select(*keys, "pos")
        # Other users' history does not count.
        seen_head = stage(in_head.join(requests.select(*keys), keys, "left_semi"), "seen-head")
        counts = seen_head.groupBy(*keys).agg(F.count("*").alias("_c"))
        needs = requests.join(counts, keys, "left").withColumn("_c", F.coalesce("_c", F.lit(0)))
        ready = F.lit(True) if cut >= longest else F.col("_c") <= cut - k
        upto = F.least(F.col("_c") + F.col("quota"), F.lit(cut)).cast("long").alias("_upto")
        candidates = _expand(needs.where(ready).select(*keys, upto), keys, "_upto", cut)
        free = candidates.join(seen_head, [*keys, "pos"], "left_anti")
        rounds.append(free.join(head, [*by, "pos"]).select(*keys, "item_idx", "pos", *carry))
        if cut >= longest:
            break
        # Only requests with many seen entries in the head are left.
        crowded = needs.where(F.col("_c") > cut - k).drop("_c")
        requests = stage(crowded, "requests")
        if requests.isEmpty():
            break
        users = stage(requests.select("user_idx").distinct(), "crowded-users")
        seen = seen.join(users, "user_idx", "left_semi")
        cut *= 4
    return reduce(DataFrame.unionByName, rounds)


def first_unseen(
    requests: DataFrame, ranked: DataFrame, seen: DataFrame, k: int, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(user_idx, item_idx, *carry, rank)``: the first ``k`` unseen entries of one list per user."""
    every = unseen_candidates(requests, ranked, seen, k, carry=carry)
    return with_rank(every, ["user_idx"], [F.asc("pos")], k).drop("pos")
