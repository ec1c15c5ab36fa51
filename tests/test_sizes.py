"""Stored tables are broadcast by what their rows take in memory, not by their files."""

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import metrics
from ratingloom.staging import BROADCAST_BYTES, broadcast_if_small, sized, stage


@pytest.fixture(scope="module")
def lists(spark):
    """Long lists of a few popular items, and what is relevant, of which the files are larger."""
    recs = spark.range(3_000_000).select(F.expr("id div 40").alias("user"), (F.col("id") % 40).alias("item"), (F.col("id") % 20 + 1).cast("int").alias("rank"))
    relevant = spark.range(400_000).select((F.col("id") % 75_000).alias("user"), F.xxhash64("id").alias("item"))
    return stage(recs, "lists"), stage(relevant, "relevant")


@pytest.fixture
def between(spark, lists):
    """The threshold lies between the files of the two tables."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    recs, relevant = (t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() for t in lists)
    assert int(recs) < BROADCAST_BYTES // 8 and int(recs) < int(relevant)
    spark.conf.set(key, str(int(recs) + 1))
    yield spark
    spark.conf.set(key, before)


def planned(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_many_packed_rows_are_not_broadcast(between, spark, lists):
    path = lists[0].inputFiles()[0].rsplit("/", 1)[0]
    plain = spark.read.parquet(path)
    recs = sized(plain, path)
    assert "BroadcastHashJoin" in planned(plain.join(lists[1], ["user", "item"]))  # as by its files
    assert "BroadcastHashJoin" not in planned(recs.join(lists[1], ["user", "item"]))
    assert "Broadcast" not in planned(metrics._hits(recs, lists[1], 10))
    assert recs.count() == 3_000_000 and recs.schema == plain.schema


def test_small_tables_and_filters_are_still_broadcast(between, lists):
    recs, relevant = lists
    few = stage(relevant.limit(1000), "few")
    assert "BroadcastHashJoin" in planned(relevant.join(few, "user"))
    head = broadcast_if_small(recs.where("rank = 1 AND user < 1000"))
    assert "BroadcastHashJoin" in planned(relevant.join(head, "user"))
