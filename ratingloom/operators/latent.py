"""Implicit-feedback factor model on Spark ML's ALS."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.operators.neighbours import blocked_top_n, count_above, similar_by_dot
from ratingloom.staging import stage, work_folder

BLOCK_CELLS = 5_000_000  # cells per user or item block
LEAST_BLOCKS = 4
GRAM_TASKS = 64  # matrices of rank x rank that reach the driver


def checkpoint_folder(spark: SparkSession) -> None:
    """Give the session a checkpoint folder in the work folder, unless it has one."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_folder(spark))


def fit_als(
    matrix: DataFrame,
    factors: int = 64,
    regularization: float = 0.01,
    iterations: int = 15,
    alpha: float = 40.0,
    seed: int = 42,
    block_cells: int = BLOCK_CELLS,
) -> ALSModel:
    """Factorise raw values; Spark applies the confidence ``1 + alpha * value`` itself.

    ``matrix`` is a stored table. Spark ML ids are ints: a larger index fails the cast instead of
    wrapping. A block holds about ``block_cells`` cells, however many blocks that takes (Spark groups the cells
    by pairs of blocks, so very large inputs want larger blocks). One user's or item's cells are in one
    block, as Spark's solver has it. The lineage is cut every ten iterations in the checkpoint folder.
    """
    checkpoint_folder(matrix.sparkSession)
    blocks = max(LEAST_BLOCKS, -(-matrix.count() // block_cells))
    als = ALS(
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=10,
        rank=factors,
        regParam=regularization,
        maxIter=iterations,
        alpha=alpha,
        seed=seed,
        implicitPrefs=True,
        coldStartStrategy="drop",
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="value",
    )
    ids = [F.col(c).cast("int").alias(c) for c in ("user_idx", "item_idx")]
    return als.fit(matrix.select(*ids, F.col("value").cast("float").alias("value")))


class FactorModel:
    """Stored factors with top-n queries."""

    def __init__(self, model: ALSModel):
        self.model, self.rank = model, model.rank
        self.users = stage(model.userFactors.select(F.col("id").cast("long").alias("qid"), F.col("features").alias("qvec")), "user-factors")
        self.items = stage(model.itemFactors.select(F.col("id").cast("long").alias("cid"), F.col("features").alias("cvec")), "item-factors")

    def factors(self) -> DataFrame:
        """``(kind, idx, features)`` of both sides."""
        users = self.users.select(F.lit("user").alias("kind"), F.col("qid").alias("idx"), F.col("qvec").alias("features"))
        items = self.items.select(F.lit("item").alias("kind"), F.col("cid").alias("idx"), F.col("cvec").alias("features"))
        return users.unionByName(items)

    def recommend(self, users: DataFrame, seen: DataFrame | None = None, k: int = 10) -> DataFrame:
        """``(user_idx, item_idx, score, rank)``; seen pairs are left out inside the product."""
        wanted = users.select(F.col("user_idx").alias("qid"))
        queries = stage(self.users.join(wanted, "qid", "left_semi"), "query-factors")
        pairs = None
        if seen is not None:
            pairs = seen.select(F.col("user_idx").alias("qid"), F.col("item_idx").alias("cid"))
            pairs = pairs.join(wanted, "qid", "left_semi")
        found = blocked_top_n(queries, self.items, k, self.rank, exclude=pairs)
        return found.select(
            F.col("qid").alias("user_idx"), F.col("cid").alias("item_idx"), "score", "rank"
        )

    def similar_items(self, n: int = 10, items: DataFrame | None = None) -> DataFrame:
        """``(item_idx, similar_idx, similarity, rank)`` by raw dot product of factors."""
        return similar_by_dot(self.items, self.rank, n, "cid", "cvec", items)

    def user_residuals(self, matrix: DataFrame, alpha: float, regularization: float) -> DataFrame:
        """``(user_idx, residual)``: how far each user's factors are from solving the user's ridge system for
        the stored item factors, relative to its right side. The last half-step of a fit solves all of them.
        """
        rank = self.rank

        def squares(batches):
            total = np.zeros((rank, rank))
            for batch in batches:
                y = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, rank).astype(float)
                total += y.T @ y
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["m"])

        few = self.items.select("cvec").coalesce(GRAM_TASKS)
        parts = few.mapInArrow(squares, "m binary").collect()  # one row per task
        gram = sum((np.frombuffer(r["m"]).reshape(rank, rank) for r in parts), np.zeros((rank, rank)))
        cells = matrix.where(F.col("value") != 0).join(self.items.withColumnRenamed("cid", "item_idx"), "item_idx")
        cells = cells.join(self.users.withColumnRenamed("qid", "user_idx"), "user_idx").select("user_idx", "value", "cvec", "qvec")

        def residuals(batches):
            at, x, left, right, liked = None, None, None, None, 0

            def done():
                gap = left + gram @ x + regularization * liked * x - right
                return at, float(np.abs(gap).max() / max(np.abs(right).max(), 1e-12))

            for batch in batches:
                user, value = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                y, own = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, rank).astype(float) for i in (2, 3))
                confidence = alpha * np.abs(value)
                positive = value > 0
                moved = (confidence * (y * own).sum(axis=1))[:, None] * y
                target = (positive * (1 + confidence))[:, None] * y
                begins = np.append(0, np.flatnonzero(np.diff(user)) + 1) if len(user) else np.zeros(0, int)
                rows = []
                for b, e in zip(begins, np.append(begins[1:], len(user))):
                    if at != user[b]:
                        if at is not None:
                            rows.append(done())
                        at, x, left, right, liked = int(user[b]), own[b], 0.0, 0.0, 0
                    left, right, liked = left + moved[b:e].sum(axis=0), right + target[b:e].sum(axis=0), liked + int(positive[b:e].sum())
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["user_idx", "residual"])
            if at is not None:
                last = done()
                yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]])], names=["user_idx", "residual"])

        dealt = cells.repartition("user_idx").sortWithinPartitions("user_idx")
        return dealt.mapInArrow(residuals, "user_idx long, residual double")

    def list_checks(self, lists: DataFrame, left_out: DataFrame, among_items: bool = False) -> DataFrame:
        """``(qid, n, sound, best)`` of stored lists ``(qid, cid, score, rank)``: their length; whether ranks are 1..n, scores
        fall and are the dot products of the stored factors; and whether no row but those listed and the pairs
        ``left_out`` ``(qid, cid)`` has a product above the last listed one, by all products."""
        side = self.items.select(F.col("cid").alias("qid"), F.col("cvec").alias("qvec")) if among_items else self.users
        product = F.aggregate(
            F.zip_with("qvec", "cvec", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x
        )
        rows = lists.join(side, "qid").join(self.items, "cid")
        near = F.abs(product - F.col("score")) <= 1e-6 * (1 + F.abs(product))
        listed = F.array_sort(F.collect_list(F.struct("rank", "score")))  # k rows
        found = rows.groupBy("qid").agg(F.count("*").alias("n"), F.min(near).alias("near"), listed.alias("l"))
        ranks = F.col("l.rank") == F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda r: r)
        falling = F.col("l.score") == F.reverse(F.array_sort("l.score"))
        # scores are ranked in whole billionths, so two of those are a real gap
        limit = F.element_at("l.score", -1) + 2e-9
        found = stage(found.select("qid", "n", (F.col("near") & ranks & falling).alias("sound"), limit.alias("limit")), "list-ends")
        queries = stage(side.join(found.select("qid", "limit"), "qid"), "list-queries")
        above = count_above(queries, self.items, self.rank)
        out = left_out.join(queries, "qid").join(self.items, "cid").where(product > F.col("limit"))
        out = out.groupBy("qid").agg(F.count("*").alias("out"))
        joined = found.join(above, "qid").join(out, "qid", "left")
        best = F.col("above") - F.coalesce("out", F.lit(0)) < F.col("n")
        return joined.select("qid", "n", "sound", best.alias("best"))

    def predict(self, pairs: DataFrame) -> DataFrame:
        """Add ``prediction`` to (user_idx, item_idx) pairs; pairs without factors are dropped."""
        ids = {c: F.col(c).cast("int") for c in ("user_idx", "item_idx")}
        return self.model.transform(pairs.withColumns(ids))
