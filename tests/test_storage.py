"""Buckets, clustered tables, observed audits, the registry log and merged sketches."""

import threading

import pytest
from pyspark.sql import functions as F

from ratingloom import staging
from ratingloom.operators import cleaning, core_filter, encoding, features, recommend, sketches
from ratingloom.operators.registry_log import RegistryLog
from ratingloom.plans.catalog import file_marks
from ratingloom.sources import bucketed

EVENT = "model_name string, version string, stage string, run_id string, metric string, value double"


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark):
    rows = [(u, i, float(1 + (u * i) % 9) / 2, 1000 * u + i) for u in range(40) for i in range(0, 60, 1 + u % 4)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double, timestamp long")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_rows_are_not_shuffled(spark, table, no_broadcast):
    stored = bucketed.store_bucketed(table, "ratings", "user_id", 8)
    users = bucketed.store_bucketed(encoding.fit_encoder(table, "user_id"), "users", "id", 8)
    items = F.broadcast(encoding.fit_encoder(table, "item_id"))
    encoded = encoding.encode(stored, users, items)
    centred, scored = (features.normalize_ratings(stored, m, co_located=True) for m in ("mean_centering", "z_score"))
    for df in (encoded, centred, scored):
        assert "Exchange hashpartitioning" not in plan(df) and "BroadcastNestedLoop" not in plan(df)
    assert "Exchange hashpartitioning" in plan(encoding.encode(table, users, items))
    assert sorted(encoded.collect()) == sorted(encoding.encode(table, encoding.fit_encoder(table, "user_id"), items).collect())
    rounded = lambda df: {(r.user_id, r.item_id, round(r.rating_normalized or 0, 9)) for r in df.collect()}
    assert rounded(scored) == rounded(features.normalize_ratings(table, "z_score"))
    matrix = encoded.select("user_id", "user_idx", "item_idx", F.col("rating").alias("value"))
    by_index = bucketed.store_bucketed(matrix, "matrix", "user_idx", 8)
    wanted = bucketed.store_bucketed(users.select(F.col("idx").alias("user_idx")).where("user_idx < 5"), "wanted", "user_idx", 8)
    assert "Exchange hashpartitioning" not in plan(by_index.join(wanted, "user_idx"))
    bucketed.drop_bucketed(spark, wanted)


def scanned(df):
    """Rows that the scans of a plan gave."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.startswith("Scan parquet") and node.metrics().contains("numOutputRows"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if name.endswith("QueryStage"):
            todo.append(node.plan())
    return found


def test_a_few_keys_read_a_few_row_groups(spark, tmp_path):
    matrix = spark.range(400_000).selectExpr("id % 4000 AS user_idx", "id div 4000 AS item_idx", "CAST(id % 5 AS double) AS value")
    stored = bucketed.store_clustered(matrix, str(tmp_path / "m"), "user_idx", rows_per_file=100_000, group_bytes=64 << 10)
    ten = spark.createDataFrame([(u,) for u in (5, 6, 7, 8, 9, 10, 11, 12, 13, None)], "k long")
    few = bucketed.rows_of_keys(stored, "user_idx", ten)
    assert few.count() == 900 and scanned(few) < 40_000
    assert bucketed.rows_of_keys(stored, "user_idx", ten, most=3).count() == 900
    assert bucketed.rows_of_keys(stored, "user_idx", ten.where("k < 0")).count() == 0


def test_history_of_a_few_users_is_that_of_all(spark, table, tmp_path):
    users, items = encoding.fit_encoder(table, "user_id"), encoding.fit_encoder(table, "item_id")
    matrix = staging.stage(features.interaction_matrix(encoding.encode(table, users, items)), "matrix")
    catalogue = spark.createDataFrame([(i, f"t{i}", "A") for i in range(0, 60, 2)], "item_id long, title string, genres string")
    stored = bucketed.store_clustered(matrix, str(tmp_path / "m"), "user_idx")
    asked = spark.createDataFrame([(3,), (7,), (7,), (999,)], "user_id long")
    got = recommend.history_of(asked, stored, users, items, catalogue).collect()
    assert sorted(got) == sorted(recommend.user_history(asked, matrix, users, items, catalogue).collect()) and len(got) > 20


def test_audits_of_the_write_equal_those_of_a_scan(spark):
    rows = [(u, i, r, t) for u in range(12) for i in range(9) for r, t in ((4.0, 5), (0.0, 9), (3.0, 2))][:300] + [(1, None, 3.0, 1)] * 5
    raw = spark.createDataFrame(rows, "userId long, movieId long, rating double, timestamp long")
    stored, audit = cleaning.cleaned_with_audit(raw)
    assert audit.collect() == cleaning.cleaning_audit(raw).collect()
    assert sorted(stored.collect()) == sorted(cleaning.clean_ratings(raw).collect())
    kept = cleaning.standardise_ratings(stored)
    for least in (1, 9, 40):
        core, audit = core_filter.core_with_audit(kept, least, least)
        assert audit.collect() == core_filter.core_audit(kept, core_filter.core_filter(kept, least, least)).collect()
        assert core.count() == audit.first().final_interactions


def event(spark, version, stage="None"):
    return spark.createDataFrame([("m", version, stage, f"run {version}", "ndcg", 0.5)], EVENT)


def test_two_writers_leave_one_holder(spark, tmp_path):
    log = RegistryLog(spark, str(tmp_path / "log"))
    for version in ("v1", "v2"):
        log.commit(lambda events, version=version: event(spark, version))
    failed = []

    def promote(version):
        try:
            RegistryLog(spark.newSession(), log.path).promote(version, "Production", "m")
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=promote, args=(v,)) for v in ("v1", "v2")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and log.latest() == 4
    stages = {r.version: r.stage for r in log.stages().collect()}
    assert sorted(stages.values()) == ["Archived", "Production"]


@pytest.mark.parametrize("first, second", [("v1", "v2"), ("v2", "v1")])
def test_a_commit_that_came_second_is_made_again(spark, tmp_path, first, second):
    log = RegistryLog(spark, str(tmp_path / "log"))
    log.commit(lambda events: event(spark, "v1").union(event(spark, "v2")))
    seen = []

    def late(events):
        seen.append(events.count())
        if len(seen) == 1:  # another writer is faster
            RegistryLog(spark, log.path).promote(first, "Production", "m")
        return event(spark, second, "Production")

    assert log.commit(late) == 3 and seen == [2, 3]
    assert {r.version: r.stage for r in log.stages().collect()} == {first: "Archived", second: "Production"}
    assert log.commit(lambda events: events.where("false")) == 3
    with pytest.raises(ValueError, match="unknown version"):
        log.promote("v9", "Production", "m")


def test_merged_sketches_are_near_the_exact_sizes(spark):
    rows = spark.range(200_000).selectExpr("id % 30011 AS user_id", "id % 709 AS item_id", "1.0D AS rating", "id * 60 AS timestamp")
    days = staging.stage(sketches.daily_sketches(rows), "days")
    whole = sketches.merged_sizes(days).first()
    assert whole.n_interactions == 200_000 and abs(whole.n_users - 30_011) < 0.02 * 30_011 and abs(whole.n_items - 709) < 0.02 * 709
    assert sketches.merged_sizes(days.where("day < '1970-02-01'")).first().n_interactions == 31 * 1440
    assert sketches.merged_sizes(days.where("false")).first().n_users == 0


def test_marks_of_a_folder_change_with_its_files(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "a.parquet"))
    before = file_marks(spark, str(tmp_path))
    assert before == file_marks(spark, str(tmp_path))
    spark.range(6).write.mode("overwrite").parquet(str(tmp_path / "a.parquet"))
    assert before != file_marks(spark, str(tmp_path))


def test_discarded_tables_are_gone(spark, tmp_path):
    stored, other = (staging.stage(spark.range(3), name) for name in ("one", "two"))
    spark.range(4).write.parquet(str(tmp_path / "own"))
    outside = spark.read.parquet(str(tmp_path / "own"))
    staging.discard(stored, outside)
    assert other.count() == 3 and spark.read.parquet(str(tmp_path / "own")).count() == 4
    with pytest.raises(Exception):
        stored.collect()
