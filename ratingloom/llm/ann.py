"""Approximate nearest neighbours by collision counting over single-projection sorted arrays.

Vectors are dealt by a hash of their id to blocks of bounded memory (``BLOCK_BYTES``). A task holds the index of one
block at a time: for each of ``PROJECTIONS`` random directions the rows sorted by their projection. A query
puts a window around its own projection in each sorted array and counts for each row the windows it lies in; rows
in enough windows are candidates, and their exact inner products are computed. Virtual rehashing widens
all windows by one factor, and only the rows that enter are counted, until k verified rows lie within the radius the
windows stand for, or all rows are verified. Nothing caps the candidates.

A row at the radius lies in a window with the probability of ``HALF_WIDTH`` under the normal law; the threshold is the
largest count that such a row reaches with probability ``RECALL``.

Largest inner product becomes smallest distance by one more coordinate: sqrt(M^2 - |x|^2) for a row (M:
the block's largest norm), 0 for a query.

Every query meets every block, once; a block needs no copy of the others, and is held by as many tasks as it takes
to use the cluster, each with a part of the queries. Each returns k rows for a query at most, of which a window
takes the k best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_BYTES = 64 << 20
MOST_ROWS = (1 << 16) - 1  # of a block, whose ranks are 16 bits
PROJECTIONS = 64
HALF_WIDTH = 1.5  # of a window, in radii
RECALL = 0.97  # of the rows at the radius
WIDEN = 1.08
LADDER = 8  # radii whose windows are looked up at once
QUERIES = 1024  # at a time
PROBE = 256  # rows whose distances give the first radius
SEED = 20_24


def threshold(projections: int = PROJECTIONS, half_width: float = HALF_WIDTH, recall: float = RECALL) -> int:
    """Windows in which a row at the radius lies with probability ``recall`` at least."""
    p = math.erf(half_width / math.sqrt(2))
    held, least = 0.0, projections
    while least > 1:
        held += math.comb(projections, least) * p**least * (1 - p) ** (projections - least)
        if held >= recall:
            break
        least -= 1
    return least


class Block:
    """Rows sorted along each direction, and search; ``verified`` counts the candidates of all searches."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.several = bool((self.ids[1:] == self.ids[:-1]).any())  # vectors of one id
        self.short = self.rows.astype(np.float32)
        norms = (self.rows**2).sum(axis=1)
        self.largest = norms.max()
        lifted = np.concatenate([self.rows, np.sqrt(np.maximum(self.largest - norms, 0))[:, None]], axis=1)
        self.directions = np.random.default_rng(SEED).standard_normal((lifted.shape[1], PROJECTIONS))
        places = lifted @ self.directions
        n = len(self.ids)
        self.order = np.ascontiguousarray(np.argsort(places, axis=0, kind="stable").T.astype(np.int32))
        self.sorted = np.take_along_axis(places.T, self.order, axis=1)
        self.ranks = np.empty((PROJECTIONS, n), np.uint16)
        np.put_along_axis(self.ranks, self.order, np.arange(n, dtype=np.uint16)[None, :], axis=1)
        self.probe = np.arange(0, n, max(1, n // PROBE))
        self.lifted = lifted[self.probe]
        self.least = threshold()
        self.verified = 0

    def windows(self, places: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the windows of one query, by direction and radius."""
        half = HALF_WIDTH * radii
        low = np.array([own.searchsorted(at - half) for own, at in zip(self.sorted, places)])
        high = np.array([own.searchsorted(at + half, "right") for own, at in zip(self.sorted, places)])
        return low, high

    def _count(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """By row, the windows it lies in."""
        inside = (self.ranks - low.astype(np.uint16)[:, None]) < (high - low).astype(np.uint16)[:, None]
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)

    def _entering(self, low: np.ndarray, high: np.ndarray, old_low: np.ndarray, old_high: np.ndarray) -> np.ndarray:
        """The rows that the wider windows add, once for each window."""
        bounds = zip(self.order, low.tolist(), old_low.tolist(), old_high.tolist(), high.tolist())
        return np.concatenate([part for own, a, b, c, d in bounds for part in (own[a:b], own[c:d])])

    def _near(self, rows: np.ndarray) -> int:
        return len(np.unique(self.ids[rows])) if self.several else len(rows)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query, ids and inner products of the k nearest ids found, best first, ties by id."""
        lifted = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        places = lifted @ self.directions
        square = (queries**2).sum(axis=1)
        gap = square[:, None] + (self.lifted**2).sum(axis=1) - 2 * lifted @ self.lifted.T
        gap[(self.ids[self.probe] == query_ids[:, None]) | (gap <= 1e-9 * self.largest)] = np.inf
        first = np.sqrt(gap.min(axis=1))
        first[~np.isfinite(first)] = max(float(np.sqrt(self.largest)), 1e-9)
        for i, query in enumerate(queries.astype(np.float32)):
            rows, product = self._search(int(query_ids[i]), query, places[i], float(first[i]), float(square[i]), k)
            if len(rows) > k and not self.several:  # single precision leaves out only what cannot be among the k best
                last = -np.partition(-product, k - 1)[k - 1]
                rows = rows[product >= last - 1e-4 * np.sqrt(square[i] * self.largest)]
            # a row's sum does not depend on the rows around it, so equal rows tie exactly
            exact = (self.rows[rows] * queries[i]).sum(axis=1)
            best = np.lexsort((self.ids[rows], -exact))
            if self.several:
                best = best[np.sort(np.unique(self.ids[rows[best]], return_index=True)[1])]
            best = best[:k]
            yield self.ids[rows[best]], exact[best]

    def _search(self, query_id: int, query: np.ndarray, places: np.ndarray, radius: float, square: float, k: int):
        """Rows verified for one query, but for those of its own id, and their products."""
        n = len(self.ids)
        known = np.zeros(n, bool)
        rows, product = np.zeros(0, np.int64), np.zeros(0, np.float32)
        count = bounds = None
        while True:
            radii = radius * WIDEN ** np.arange(LADDER)
            lows, highs = self.windows(places, radii)
            for low, high, r in zip(lows.T, highs.T, radii.tolist()):
                if count is None:
                    count = self._count(low, high)
                    new = np.flatnonzero(count >= self.least)
                else:
                    entering = self._entering(low, high, *bounds)
                    count = count + np.bincount(entering, minlength=n).astype(np.uint8)
                    new = np.flatnonzero((count >= self.least) & ~known)
                bounds = low, high
                if len(new):
                    known[new] = True
                    self.verified += len(new)
                    new = new[self.ids[new] != query_id]
                    rows = np.concatenate([rows, new])
                    product = np.concatenate([product, self.short[new] @ query])
                if len(rows) >= k and self._near(rows[square + self.largest - 2 * product <= r * r]) >= k or known.all():
                    return rows, product
            radius = radii[-1] * WIDEN


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def _block_rows(size: int) -> int:
    """Rows of vectors of this length whose index fits the bound."""
    return max(1, min(MOST_ROWS, BLOCK_BYTES // (20 * size + 14 * PROJECTIONS)))


def nearest(df: DataFrame, key: str, vector: str, queries: Column, k: int, block_rows: int | None = None) -> DataFrame:
    """The k nearest rows found of each row for which ``queries`` holds: query_id, rank (from 1), vec_id, score.

    Nearness is the largest inner product in double precision, ties go to the smaller id; a row is never its own
    neighbour, nor is another row with the same id. Rows with a null id take no part, nor do vectors that are not
    ``usable``; a vector only meets vectors of its length. A query without any candidate has no row. Rows with one id are
    one query and one neighbour, with the best score among their vectors.
    """
    rows = df.select(df[f"`{key}`"].cast("long").alias("id"), df[f"`{vector}`"].cast("array<double>").alias("v"), queries.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    # copies combine in the map tasks, so neither they nor the vectors of one id gather in a block
    rows = rows.groupBy("id", "v").agg(F.max("q").alias("q")).withColumn("size", F.size("v"))
    found = rows.agg(F.count("*").alias("n"), F.coalesce(F.max("size"), F.lit(1)).alias("longest")).first()
    most = min(MOST_ROWS, block_rows or _block_rows(found["longest"]))
    # dealt by a hash, blocks differ by a few standard deviations
    blocks = max(1, math.ceil(found["n"] / max(1, 0.8 * most)))
    parts = max(1, -(-df.sparkSession.sparkContext.defaultParallelism // blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")
    placed = rows.select("size", own.alias("block"), every(parts).alias("share"), F.lit(0).alias("kind"), "id", "v")
    share = F.pmod(F.xxhash64(F.lit(1), "id", "v"), F.lit(parts)).cast("int")
    asked = rows.where(F.col("q")).select("size", every(blocks).alias("block"), share.alias("share"), F.lit(1).alias("kind"), "id", "v")
    # the number of a task is the key of the range partitioning, so each has a partition of its own
    both = placed.unionByName(asked).withColumn("block", F.col("block") * parts + F.col("share")).drop("share")
    dealt = both.repartitionByRange(blocks * parts, "block").sortWithinPartitions("block", "size", "kind", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        for batch in batches:
            size, block, kind, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            values = batch.column(4).flatten().to_numpy(zero_copy_only=False)
            begins = np.cumsum(size) - size
            change = np.flatnonzero(np.diff(size) | np.diff(block) | np.diff(kind)) + 1
            out: list[list] = [[], [], []]
            for a, b in zip(np.append(0, change).astype(int), np.append(change, len(ids)).astype(int)):
                if a == b:
                    continue
                if at != (size[a], block[a]):
                    at, held, index = (size[a], block[a]), [], None
                vectors = values[begins[a] : begins[a] + (b - a) * size[a]].reshape(b - a, size[a])
                if kind[a] == 0:
                    held.append((ids[a:b].copy(), vectors.copy()))
                    continue
                if index is None and held:
                    index, held = Block(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])), []
                steps = range(a, b, QUERIES)
                found = () if index is None else chain.from_iterable(
                    index.nearest(ids[c : min(b, c + QUERIES)], vectors[c - a : min(b, c + QUERIES) - a], k) for c in steps
                )
                for query_id, (near, product) in zip(ids[a:b].tolist(), found):
                    out[0] += [query_id] * len(near)
                    out[1] += near.tolist()
                    out[2] += product.tolist()
            if out[0]:
                arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # one exchange serves both: the rows of a query, and of a query and a neighbour
    found = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
