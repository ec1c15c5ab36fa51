"""Plans that must hold when one key owns a third of the rows."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import encoding, features, splits
from ratingloom.operators.cleaning import latest_per_pair
from ratingloom.operators.core_filter import core_filter
from ratingloom.operators.genres import GenreIndex, signature_weights
from ratingloom.params import Params
from ratingloom.plans.workspace import Workspace
from ratingloom.staging import stage, work_folder

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark):
    """Joins never broadcast and thresholds are scaled down to the test table."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot(skewed):
    """A stored table in which user 7 and item 3 each own about a third of the rows."""
    rng = random.Random(0)
    rows = [(7, i, rng.randrange(1, 11) / 2, i) for i in range(1000, 13_000)]
    rows += [(u, 3, rng.randrange(1, 11) / 2, u) for u in range(1000, 13_000)]
    rows += [(rng.randrange(1000, 13_000), rng.randrange(1000, 13_000), 3.0, 5) for _ in range(12_000)]
    rng.shuffle(rows)
    table = skewed.createDataFrame(rows, "user_id long, item_id long, rating double, timestamp long")
    return stage(latest_per_pair(table, "user_id", "item_id").repartition(12), "hot")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("method", ["mean_centering", "z_score"])
def test_heavy_user_is_split_in_normalisation(hot, method):
    assert "skew=true" in final_plan(features.normalize_ratings(hot, method))


def test_heavy_ids_are_split_in_encoding(hot):
    users, items = encoding.fit_encoder(hot, "user_id"), encoding.fit_encoder(hot, "item_id")
    encoded = encoding.encode(hot, users, items)
    assert final_plan(encoded).count("skew=true") >= 2
    assert encoded.count() == hot.count()


def test_heavy_ids_are_split_in_the_core(hot):
    kept = core_filter(hot, 2, 2)
    assert "skew=true" in final_plan(kept)


def test_heavy_item_is_split_before_signature_sums(hot):
    users, items = encoding.fit_encoder(hot, "user_id"), encoding.fit_encoder(hot, "item_id")
    matrix = features.interaction_matrix(encoding.encode(hot, users, items))
    matrix = stage(matrix.repartition(12), "matrix")  # a partition is split along its map tasks
    catalogue = items.select(
        F.col("id").alias("item_id"), F.lit("t").alias("title"), F.concat(F.lit("G"), F.pmod("id", F.lit(9))).alias("genres")
    )
    weights = signature_weights(matrix, GenreIndex(items, catalogue))
    assert "skew=true" in final_plan(weights)


def test_counts_combine_before_the_shuffle(hot):
    for plan in (features.item_stats(hot), features.user_stats(hot), features.user_means(hot)):
        assert "partial_" in plan._jdf.queryExecution().toString()


def test_split_neither_sorts_nor_shuffles(hot):
    for labelled in (splits.temporal_split(hot), splits.random_split(hot), splits.nway_split(hot, [0.5, 0.5])):
        plan = labelled._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan


def test_train_part_pushes_the_time_bound_down(hot):
    raw = hot.withColumnsRenamed({"user_id": "userId", "item_id": "movieId"})
    items = hot.sparkSession.createDataFrame([(1, "a (2000)", "x")], "movieId long, title string, genres string")
    run = Workspace(raw, items, Params(min_user_interactions=1, min_item_interactions=1))
    for frame, bound in ((run.train, "LessThanOrEqual(timestamp"), (run.cuts.part(run.kept, "test"), "GreaterThanOrEqual(timestamp")):
        plan = frame.select("rating")._jdf.queryExecution().executedPlan().toString()
        assert bound in plan.split("PushedFilters:")[1].split("]")[0]


def test_a_cluster_needs_a_shared_folder():
    """Without a setting a local folder is only used in local mode."""
    context = SimpleNamespace(master="yarn", applicationId="a", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(SimpleNamespace(conf={}, sparkContext=context))
    shared = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://shared/"}, sparkContext=context)
    assert work_folder(shared) == "hdfs://shared/ratingloom-a"
