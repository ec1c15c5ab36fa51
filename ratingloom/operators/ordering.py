"""Exact positions in a global order without a single-task sort."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.staging import stage

BUCKETS = 4096  # histogram size collected per refinement step
SMALL = 10_000  # a bucket of at most this many rows is sorted directly


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Add the 1-based position of every row in the order given by ``order``.

    Rows are range-partitioned on the whole sort key and stored in order with their
    (partition, offset) position; the rank then only needs the running sum over the
    partition sizes, a table with one row per partition. The key should be unique: any
    leading value, however frequent, is then spread over partitions.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # monotonically_increasing_id is partition << 33 | offset in the partition
    stored = stage(ordered.withColumn("_at", F.monotonically_increasing_id()), f"ranked-{name}")
    part = F.shiftright("_at", 33).alias("_part")
    sizes = stored.groupBy(part).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    placed = stored.select("*", part).join(F.broadcast(starts), "_part")
    offset = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*df.columns, (F.col("_start") + offset + 1).alias(name))


def keys_at(
    df: DataFrame,
    keys: list[str],
    positions: Callable[[int], list[int]],
    bounds: tuple[int, int] | None = None,
) -> list[tuple | None]:
    """Key tuples of the rows at given 0-based positions of the order by ``keys``.

    Selection instead of sorting: a histogram over the first key finds the bucket that holds a
    position, and only that bucket is refined, key by key. Every step is a column-pruned,
    range-filtered scan whose result is at most ``BUCKETS`` rows, so no step depends on how the
    rows are spread: a single value holding most rows is refined by the next key.

    ``keys`` are integer columns, unique as a tuple and without nulls; ``positions`` gets the
    number of rows; ``bounds`` is the range of the first key when known. A position past the end
    gives None.
    """
    table = df.select(*keys)
    if bounds:
        n, (low, high) = table.count(), bounds
    else:
        missing = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
        n, low, high, nulls = table.agg(F.count("*"), F.min(keys[0]), F.max(keys[0]), F.count_if(missing)).first()
        if nulls:
            raise ValueError(f"{nulls} rows have a null in {keys}; clean them first")
    wanted = positions(n)
    found: dict[int, tuple] = {}
    # (rows, depth of the current key, its range, number of rows, [(position, offset in the rows)])
    tasks = [([], 0, low, high, n, [(p, p) for p in sorted(set(wanted)) if 0 <= p < n])]
    small: list[tuple[list[tuple[int, int, int]], list[tuple[int, int]]]] = []
    while tasks:
        path, depth, low, high, size, inside = tasks.pop()
        if not inside:
            continue
        ranges = [*path, (depth, low, high)]
        if size <= SMALL:
            small.append((ranges, inside))
            continue
        part = table.where(_within(keys, ranges))
        if low == high:
            if depth + 1 == len(keys):  # equal tuples
                found.update({p: tuple(bound for _, bound, _ in ranges) for p, _ in inside})
                continue
            following = keys[depth + 1]
            below, above = part.agg(F.min(following), F.max(following)).first()
            tasks.append((ranges, depth + 1, below, above, size, inside))
            continue
        width = -(-(high - low + 1) // BUCKETS)
        bucket = F.expr(f"(`{keys[depth]}` - ({low}L)) div {width}L")  # exact integer division
        passed = 0
        for b, count in sorted(part.groupBy(bucket.alias("b")).count().collect()):
            here = [(p, o - passed) for p, o in inside if passed <= o < passed + count]
            left = low + b * width
            tasks.append((path, depth, left, min(high, left + width - 1), count, here))
            passed += count
    if small:  # one scan for all small buckets: at most SMALL rows per position
        conditions = [_within(keys, ranges) for ranges, _ in small]
        rows = sorted(tuple(r) for r in table.where(reduce(lambda a, b: a | b, conditions)).collect())
        for ranges, inside in small:
            bucket_rows = [r for r in rows if all(low <= r[depth] <= high for depth, low, high in ranges)]
            found.update({p: bucket_rows[offset] for p, offset in inside})
    return [found.get(p) for p in wanted]


def _within(keys: list[str], ranges: list[tuple[int, int, int]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(keys[depth]).between(low, high) for depth, low, high in ranges])


def precedes(keys: list[str], cut: tuple | None) -> Column:
    """Whether a row's key tuple sorts before ``cut`` (everything does when there is no cut)."""
    if cut is None:
        return F.lit(True)

    def compare(i: int) -> Column:
        here = F.col(keys[i]) < F.lit(cut[i])
        return here if i + 1 == len(keys) else here | ((F.col(keys[i]) == F.lit(cut[i])) & compare(i + 1))

    # As a filter, the plain bound on the first key is pushed down to the scan.
    return (F.col(keys[0]) <= F.lit(cut[0])) & compare(0)


def follows(keys: list[str], cut: tuple | None) -> Column:
    """Whether a row's key tuple is ``cut`` or sorts after it (nothing does when there is no cut)."""
    if cut is None:
        return F.lit(False)
    return (F.col(keys[0]) >= F.lit(cut[0])) & ~precedes(keys, cut)

