"""Registered queries over the order and part tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom import schemas
from ratingloom.operators import (
    banding,
    cleaning,
    encoding,
    evaluation,
    features,
    genres,
    metrics,
    neighbours,
    popularity,
    recommend,
    registry,
    sketches,
    splits,
    tuning,
)
from ratingloom.operators.core_filter import core_audit, core_filter, core_with_audit
from ratingloom.operators.registry_log import RegistryLog
from ratingloom.params import Params
from ratingloom.plans.workspace import Workspace
from ratingloom.session import tune_session
from ratingloom.sources import bucketed, driver_tables, files
from ratingloom.staging import stage, work_folder

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6  # published doubles
TOP = 10
DEPTH = 20  # list length behind the metric queries
TABLE_BUCKETS = 16

_workspaces: dict[tuple, Workspace] = {}


def file_marks(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the files below a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def workspace(spark: SparkSession, folder: str, variant: str = "main") -> Workspace:
    """One workspace per application, variant and state of the folder's files, so that queries share stored steps and tables
    that change are read again."""
    key = (spark.sparkContext.applicationId, folder, file_marks(spark, folder), variant)
    if key not in _workspaces:
        tune_session(spark)
        params = {
            "main": Params(),
            # A short training period leaves users and items that the model does not know.
            "early": Params(train_ratio=0.1, val_ratio=0.1, test_ratio=0.8),
            "random": Params(temporal_split=False),
            "implicit": Params(feedback_type="implicit"),
        }[variant]
        sibling = None if variant == "main" else workspace(spark, folder)
        ratings, items = driver_tables.dirty_ratings(spark, folder), driver_tables.part_items(spark, folder)
        _workspaces[key] = Workspace(ratings, items, params, sibling=sibling)
    return _workspaces[key]


def published(df: DataFrame) -> DataFrame:
    """Round doubles for publication; adding 0.0 removes negative zero."""
    rounded = [
        (F.round(name, DIGITS) + 0.0).alias(name) if kind in ("double", "float") else F.col(name)
        for name, kind in df.dtypes
    ]
    return df.select(*rounded)


REGISTERED: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tune_session(spark)
        return published(fn(spark, folder))

    REGISTERED[fn.__name__] = run
    return fn


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return driver_tables.dirty_ratings(spark, folder)


def _stored_copy(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/copy-{name}-{uuid.uuid4().hex}"


# --- sources and cleaning -------------------------------------------------------------------


@query
def scan_ratings(spark, folder):
    return driver_tables.order_ratings(spark, folder)


@query
def scan_csv_ratings(spark, folder):
    """The ratings written as CSV with the columns in another order, and read back by name."""
    path = _stored_copy(spark, "ratings-csv")
    files.write_csv(driver_tables.order_ratings(spark, folder).select("timestamp", "movieId", "rating", "userId"), path)
    return files.read_ratings_csv(spark, path)


@query
def scan_csv_items(spark, folder):
    path = _stored_copy(spark, "items-csv")
    files.write_csv(driver_tables.part_items(spark, folder).select("genres", "movieId", "title"), path)
    return files.read_items_csv(spark, path)


@query
def csv_audit(spark, folder):
    """Rows of a file in which some ratings and ids are no numbers, by the column that could not be read."""
    path = _stored_copy(spark, "broken-csv")
    rows = driver_tables.order_ratings(spark, folder)
    rating = F.when(F.col("movieId") % 10 == 3, "good").otherwise(F.col("rating").cast("string"))
    user = F.when(F.col("movieId") % 10 == 4, F.concat(F.col("userId").cast("string"), F.lit(".5"))).otherwise(
        F.concat(F.col("userId").cast("string"), F.lit(".0"))
    )
    files.write_csv(rows.withColumn("rating", rating).withColumn("userId", user), path)
    return files.csv_audit(spark, path, schemas.RATINGS)


@query
def parquet_copy(spark, folder):
    path = _stored_copy(spark, "parquet")
    files.write_parquet(driver_tables.order_ratings(spark, folder), path)
    return files.read_parquet(spark, path, schemas.RATINGS)


@query
def json_copy(spark, folder):
    path = _stored_copy(spark, "json")
    files.write_json(driver_tables.part_items(spark, folder), path)
    return files.read_json(spark, path, schemas.ITEMS)


@query
def scan_items(spark, folder):
    return driver_tables.part_items(spark, folder)


@query
def clean_dropna(spark, folder):
    return cleaning.drop_incomplete(_raw(spark, folder))


@query
def clean_range(spark, folder):
    return cleaning.keep_valid_range(_raw(spark, folder), 1.0, 4.5)


@query
def clean_latest(spark, folder):
    return cleaning.latest_per_pair(driver_tables.order_ratings(spark, folder))


@query
def clean_ratings(spark, folder):
    return cleaning.clean_ratings(_raw(spark, folder), 1.0, 4.5)


@query
def clean_audit(spark, folder):
    """Rows before and after, counted in the pass that writes the clean table."""
    return cleaning.cleaned_with_audit(_raw(spark, folder), 1.0, 4.5)[1]


@query
def clean_audit_alone(spark, folder):
    return cleaning.cleaning_audit(_raw(spark, folder), 1.0, 4.5)


@query
def interactions(spark, folder):
    return cleaning.standardise_ratings(cleaning.clean_ratings(_raw(spark, folder)))


@query
def to_implicit(spark, folder):
    return cleaning.to_implicit(workspace(spark, folder).interactions)


@query
def implicit_ratio(spark, folder):
    return cleaning.implicit_ratio(workspace(spark, folder).interactions)


@query
def binarize(spark, folder):
    return cleaning.binarize(workspace(spark, folder).interactions)


@query
def item_year(spark, folder):
    return cleaning.add_year(driver_tables.part_items(spark, folder)).select("movieId", "year")


@query
def item_title_clean(spark, folder):
    return cleaning.add_clean_title(driver_tables.part_items(spark, folder)).select("movieId", "title_clean")


@query
def items(spark, folder):
    return cleaning.standardise_items(driver_tables.part_items(spark, folder))


@query
def dataset_summary(spark, folder):
    w = workspace(spark, folder)
    return cleaning.dataset_summary(w.interactions, w.items)


@query
def summary_sketches(spark, folder):
    """Sizes by month from stored daily sketches, and whether they are as near to the exact ones as the sketch promises."""
    ratings = workspace(spark, folder).interactions
    days = stage(sketches.daily_sketches(ratings), "daily-sketches")
    month = lambda day: F.date_format(day, "yyyy-MM").alias("month")
    near = sketches.merged_sizes(days, month(F.col("day")))
    exact = ratings.groupBy(month(sketches.day_of(F.col("timestamp")))).agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("item_id").alias("items")
    )
    close = lambda c: (F.abs(F.col(f"n_{c}") - F.col(c)) <= 1 + 0.03 * F.col(c)).alias(f"{c}_close")
    return near.join(exact, "month").select("month", "n_interactions", close("users"), close("items"))


# --- core, splits, encoding -----------------------------------------------------------------


@query
def kcore_20_20(spark, folder):
    return core_filter(workspace(spark, folder).interactions, 20, 20)


@query
def kcore_5_5(spark, folder):
    return core_filter(workspace(spark, folder).interactions, 5, 5)


@query
def kcore_audit(spark, folder):
    return core_with_audit(workspace(spark, folder).interactions, 20, 20)[1]


@query
def kcore_audit_alone(spark, folder):
    before = workspace(spark, folder).interactions
    return core_audit(before, core_filter(before, 20, 20))


@query
def split_temporal(spark, folder):
    return splits.temporal_split(workspace(spark, folder).interactions)


@query
def split_random(spark, folder):
    return splits.random_split(workspace(spark, folder).interactions)


@query
def split_nway(spark, folder):
    return splits.nway_split(workspace(spark, folder).interactions, [0.5, 0.2, 0.2, 0.1], seed=7)


@query
def split_summary(spark, folder):
    summary = splits.split_summary(workspace(spark, folder).labelled)
    return summary.withColumn("end_date", F.date_format("end_date", "yyyy-MM-dd"))


@query
def encode_users(spark, folder):
    return encoding.fit_encoder(workspace(spark, folder).train, "user_id")


@query
def encode_items(spark, folder):
    return encoding.fit_encoder(workspace(spark, folder).train, "item_id")


@query
def encode_ignore(spark, folder):
    w = workspace(spark, folder, "early")
    return encoding.encode(splits.part_of(w.labelled, "test"), w.users, w.item_ids)


@query
def encode_checked(spark, folder):
    """Training rows under the raising encoder."""
    w = workspace(spark, folder)
    return encoding.encode(w.train, w.users, w.item_ids, unknown="error")


@query
def encoder_copy(spark, folder):
    path = _stored_copy(spark, "encoder")
    files.save_encoder(workspace(spark, folder).item_ids, path)
    return files.load_encoder(spark, path)


@query
def encode_bucketed(spark, folder):
    """Training rows and user ids in buckets of the user, which are joined without moving the rows."""
    w = workspace(spark, folder)
    rows = bucketed.store_bucketed(w.train, "train", "user_id", TABLE_BUCKETS)
    users = bucketed.store_bucketed(w.users, "users", "id", TABLE_BUCKETS)
    return encoding.encode(rows, users, w.item_ids)


@query
def norm_zscore_bucketed(spark, folder):
    w = workspace(spark, folder)
    rows = bucketed.store_bucketed(w.train, "train", "user_id", TABLE_BUCKETS)
    return features.normalize_ratings(rows, "z_score", co_located=True)


@query
def matrix_copy(spark, folder):
    path = _stored_copy(spark, "matrix")
    files.save_matrix(workspace(spark, folder).matrix, path)
    return files.load_matrix(spark, path)


@query
def decode_items(spark, folder):
    w = workspace(spark, folder)
    return encoding.decode(w.matrix, w.item_ids, "item_idx", "item_id")


@query
def lookup_idx(spark, folder):
    w = workspace(spark, folder, "early")
    wanted = driver_tables.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    return encoding.lookup(wanted, w.users)


# --- features -------------------------------------------------------------------------------


@query
def interaction_matrix(spark, folder):
    return features.interaction_matrix(workspace(spark, folder).encoded_part("train"))


@query
def matrix_stats(spark, folder):
    w = workspace(spark, folder)
    return features.matrix_stats(w.matrix, w.users, w.item_ids)


@query
def norm_mean_center(spark, folder):
    return features.normalize_ratings(workspace(spark, folder).train, "mean_centering")


@query
def user_means(spark, folder):
    return features.user_means(workspace(spark, folder).train)


@query
def norm_zscore(spark, folder):
    return features.normalize_ratings(workspace(spark, folder).train, "z_score")


@query
def user_stats(spark, folder):
    return features.user_stats(workspace(spark, folder).train)


@query
def norm_minmax(spark, folder):
    return features.normalize_ratings(workspace(spark, folder).train, "min_max")


@query
def norm_metadata(spark, folder):
    return features.normalization_metadata(workspace(spark, folder).train)


@query
def item_stats(spark, folder):
    return features.item_stats(workspace(spark, folder).train)


@query
def popularity_decay(spark, folder):
    return features.item_popularity(workspace(spark, folder).train)


@query
def popularity_static(spark, folder):
    return features.item_popularity(workspace(spark, folder).train, time_decay=False)


@query
def confidence_implicit(spark, folder):
    return features.confidence_matrix(cleaning.binarize(workspace(spark, folder).encoded_part("train")))


@query
def confidence_explicit(spark, folder):
    return features.confidence_matrix(workspace(spark, folder).encoded_part("train"))


@query
def confidence_events(spark, folder):
    """Event counts as implicit feedback: one interaction per event, event types as items."""
    events = driver_tables.table(spark, folder, "events").select("user_id", F.col("event_type").alias("item_id"))
    users, kinds = encoding.fit_encoder(events, "user_id"), encoding.fit_encoder(events, "item_id")
    return features.confidence_matrix(encoding.encode(events.withColumn("interaction", F.lit(1)), users, kinds))


@query
def confidence_stats(spark, folder):
    return features.confidence_stats(workspace(spark, folder).encoded_part("train"))


@query
def rating_stats(spark, folder):
    w = workspace(spark, folder)
    return features.feature_metadata(w.train, w.users, w.item_ids)


# --- models ---------------------------------------------------------------------------------


@query
def pop_model_scores(spark, folder):
    w = workspace(spark, folder)
    return popularity.item_scores(w.matrix, w.item_ids).select("item_idx", "score")


def _all_users(w: Workspace) -> DataFrame:
    return w.users.select(F.col("idx").alias("user_idx"))


def _all_items(w: Workspace) -> DataFrame:
    return w.item_ids.select(F.col("idx").alias("item_idx"))


@query
def rec_popularity(spark, folder):
    w = workspace(spark, folder)
    return popularity.recommend_popular_unseen(_all_users(w), w.ranked, w.seen, TOP)


@query
def genre_vocab(spark, folder):
    return genres.genre_vocabulary(workspace(spark, folder).items)


@query
def genre_features(spark, folder):
    w = workspace(spark, folder)
    return genres.genre_features(w.item_ids, w.items)


@query
def user_genre_prefs(spark, folder):
    w = workspace(spark, folder)
    return genres.user_genre_preferences(w.matrix, w.genre_index)


@query
def content_scores(spark, folder):
    """Content score of every rated pair, trained on or held out."""
    w = workspace(spark, folder)
    return genres.content_scores(w.encoded, w.hybrid.preferences, w.genre_index)


@query
def rec_hybrid(spark, folder):
    w = workspace(spark, folder)
    return w.hybrid.recommend(_all_users(w), TOP)


@query
def als_factors(spark, folder):
    return workspace(spark, folder).als.factors()


@query
def rec_als(spark, folder):
    w = workspace(spark, folder)
    return w.als.recommend(_all_users(w), w.seen, TOP)


@query
def similar_als(spark, folder):
    return workspace(spark, folder).als.similar_items(TOP)


@query
def similar_dot(spark, folder):
    vectors = driver_tables.table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.similar_by_dot(vectors, 64, TOP, "vec_id", "embedding")


@query
def similar_genre(spark, folder):
    w = workspace(spark, folder)
    return neighbours.similar_by_genre(_all_items(w), w.genre_index, TOP)


@query
def similar_popular(spark, folder):
    w = workspace(spark, folder)
    return popularity.similar_popular(_all_items(w), w.ranked, TOP)


@query
def tuning_trials(spark, folder):
    """Every drawn trial of the parameter search, with the value of the last rung it reached."""
    return tuning.final_trials(workspace(spark, folder).rungs).drop("promoted")


@query
def tuning_draws(spark, folder):
    """Drawn parameters of all trials, and whether every rung promoted the best by its stored values."""
    checked = tuning.rung_checks(workspace(spark, folder).rungs)
    return checked.groupBy("trial", *tuning.NAMES).agg(F.min("sound").alias("sound"))


@query
def tuning_rungs(spark, folder):
    """Size of each rung, its longest fit, and how many trials it promoted."""
    checked = tuning.rung_checks(workspace(spark, folder).rungs)
    return checked.groupBy("rung").agg(
        F.count("*").alias("n_trials"), F.count_if("promoted").alias("n_promoted"), F.min("sound").alias("sound")
    )


@query
def als_factors_check(spark, folder):
    """Whether each user's factors solve that user's system for the final item factors."""
    w = workspace(spark, folder)
    p = w.params
    found = w.als.user_residuals(w.matrix, p.alpha, p.regularization)
    return found.select("user_idx", (F.col("residual") <= 1e-3).alias("solved"))


@query
def rec_als_check(spark, folder):
    """Whether each user's list has the right length, rising ranks, falling scores that are dot products, no seen item,
    and no unseen item that scores above the last listed one."""
    w = workspace(spark, folder)
    recs = stage(w.als.recommend(_all_users(w), w.seen, TOP), "als-lists")
    pairs = recs.select(F.col("user_idx").alias("qid"), F.col("item_idx").alias("cid"), "score", "rank")
    left_out = w.seen.select(F.col("user_idx").alias("qid"), F.col("item_idx").alias("cid"))
    checked = w.als.list_checks(pairs, left_out).withColumnRenamed("qid", "user_idx")
    seen = recs.join(w.seen, ["user_idx", "item_idx"], "left_semi").groupBy("user_idx").agg(F.count("*").alias("n_seen"))
    known = w.seen.groupBy("user_idx").agg(F.count("*").alias("n_known"))
    n_items = w.als.items.agg(F.count("*")).scalar()
    rows = checked.join(known, "user_idx").join(seen, "user_idx", "left")
    right = F.col("n") == F.least(F.lit(TOP), n_items - F.col("n_known"))
    return rows.select("user_idx", (F.col("sound") & F.col("best") & right & F.col("n_seen").isNull()).alias("sound"))


@query
def similar_als_check(spark, folder):
    """The same for each item's neighbours, among which the item itself may not be."""
    w = workspace(spark, folder)
    found = stage(w.als.similar_items(TOP), "als-neighbours")
    pairs = found.select(F.col("item_idx").alias("qid"), F.col("similar_idx").alias("cid"), F.col("similarity").alias("score"), "rank")
    own = w.als.items.select(F.col("cid").alias("qid"), "cid")
    checked = w.als.list_checks(pairs, own, among_items=True).withColumnRenamed("qid", "item_idx")
    named = found.where("item_idx = similar_idx").groupBy("item_idx").agg(F.count("*").alias("named"))
    n_items = w.als.items.agg(F.count("*")).scalar()
    right = (F.col("n") == F.least(F.lit(TOP), n_items - 1)) & F.col("named").isNull()
    rows = checked.join(named, "item_idx", "left")
    return rows.select("item_idx", (F.col("sound") & F.col("best") & right).alias("sound"))


# --- requests -------------------------------------------------------------------------------


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return driver_tables.table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    return driver_tables.table(spark, folder, "part").select(F.col("p_partkey").alias("item_id"))


@query
def recommend_batch(spark, folder):
    w = workspace(spark, folder)
    requests = _customers(spark, folder)
    return recommend.recommend_known(requests, w.users, w.item_ids, w.catalogue, w.hybrid.recommend, TOP)


@query
def recommend_with_seen(spark, folder):
    w = workspace(spark, folder)

    def with_seen(users: DataFrame, k: int) -> DataFrame:
        return w.hybrid.recommend(users, k, exclude_seen=False)

    return recommend.recommend_known(_customers(spark, folder), w.users, w.item_ids, w.catalogue, with_seen, TOP)


@query
def recommend_popular(spark, folder):
    w = workspace(spark, folder)
    return recommend.popular_items(w.popularity, w.catalogue, TOP)


@query
def recommend_cold(spark, folder):
    w = workspace(spark, folder, "early")
    return recommend.recommend_cold(_customers(spark, folder), w.users, w.popularity, w.catalogue, TOP)


@query
def recommend_all(spark, folder):
    """Known users by the model, unknown users by the popular list."""
    w = workspace(spark, folder, "early")
    requests = _customers(spark, folder)
    known = recommend.recommend_known(requests, w.users, w.item_ids, w.catalogue, w.recommend, TOP)
    return known.unionByName(recommend.recommend_cold(requests, w.users, w.popularity, w.catalogue, TOP))


@query
def similar_items_batch(spark, folder):
    w = workspace(spark, folder)

    return recommend.similar_items(_parts(spark, folder), w.item_ids, w.catalogue, w.similar, TOP)


@query
def user_history(spark, folder):
    w = workspace(spark, folder)
    return recommend.user_history(_customers(spark, folder), w.matrix, w.users, w.item_ids, w.catalogue)


@query
def history_by_key(spark, folder):
    """The history of ten users from a matrix that is clustered by user."""
    w = workspace(spark, folder)
    stored = bucketed.store_clustered(w.matrix, _stored_copy(spark, "clustered"), "user_idx")
    ten = _customers(spark, folder).where("user_id % 97 = 5").orderBy("user_id").limit(10)
    return recommend.history_of(ten, stored, w.users, w.item_ids, w.catalogue)


@query
def list_users(spark, folder):
    return encoding.page(workspace(spark, folder).users, limit=50, offset=20)


@query
def list_items(spark, folder):
    return encoding.page(workspace(spark, folder).item_ids, limit=50, offset=20)


@query
def list_items_meta(spark, folder):
    w = workspace(spark, folder)
    return recommend.items_page(w.item_ids, w.catalogue, limit=50, offset=20)


@query
def model_counts(spark, folder):
    w = workspace(spark, folder)
    return recommend.model_counts(w.users, w.item_ids)


# --- metrics --------------------------------------------------------------------------------


def _test_lists(w: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(recs, relevant, graded) of the popularity model for all users with a relevant test item."""
    if not hasattr(w, "_lists"):
        graded = w.test_matrix.where(F.col("value") >= w.params.rating_threshold).select(
            F.col("user_idx").alias("user"), F.col("item_idx").alias("item"), F.col("value").alias("grade")
        )
        graded = stage(graded, "graded")
        users = graded.select(F.col("user").alias("user_idx")).distinct()
        recs = popularity.recommend_popular_unseen(users, w.ranked, w.seen, DEPTH).select(
            F.col("user_idx").alias("user"), F.col("item_idx").alias("item"), "rank"
        )
        w._lists = (stage(recs, "test-lists"), graded.select("user", "item"), graded)
    return w._lists


def _prediction_pairs(w: Workspace) -> DataFrame:
    """Test ratings with the mean train rating of their item as prediction."""
    means = stage(features.item_stats(w.train).select("item_id", F.col("avg_rating").alias("y_pred")), "item-means")
    test = splits.part_of(w.labelled, "test")
    return test.join(means, "item_id").select(F.col("rating").alias("y_true"), "y_pred")


@query
def metric_rmse(spark, folder):
    return metrics.rmse(_prediction_pairs(workspace(spark, folder)))


@query
def metric_mae(spark, folder):
    return metrics.mae(_prediction_pairs(workspace(spark, folder)))


@query
def metric_precision(spark, folder):
    recs, relevant, _ = _test_lists(workspace(spark, folder))
    return metrics.precision_at_k(recs, relevant, 10)


@query
def metric_recall(spark, folder):
    recs, relevant, _ = _test_lists(workspace(spark, folder))
    return metrics.recall_at_k(recs, relevant, 10)


@query
def metric_dcg(spark, folder):
    recs, relevant, _ = _test_lists(workspace(spark, folder))
    marked = recs.join(relevant.withColumn("_hit", F.lit(1.0)), ["user", "item"], "left")
    return metrics.dcg(marked.select("user", "rank", F.coalesce("_hit", F.lit(0.0)).alias("relevance")), 10)


@query
def metric_ndcg(spark, folder):
    recs, relevant, _ = _test_lists(workspace(spark, folder))
    return metrics.ndcg_at_k(recs, relevant, 10)


@query
def metric_ndcg_graded(spark, folder):
    recs, _, graded = _test_lists(workspace(spark, folder))
    return metrics.graded_ndcg(recs, graded, 10)


@query
def metric_ap(spark, folder):
    recs, relevant, _ = _test_lists(workspace(spark, folder))
    return metrics.average_precision_at_k(recs, relevant, 10)


@query
def metric_map(spark, folder):
    recs, relevant, _ = _test_lists(workspace(spark, folder))
    return metrics.mean_metric(metrics.average_precision_at_k(recs, relevant, 10), "map")


@query
def metric_rr(spark, folder):
    recs, relevant, _ = _test_lists(workspace(spark, folder))
    return metrics.reciprocal_rank(recs, relevant)


@query
def metric_mrr(spark, folder):
    recs, relevant, _ = _test_lists(workspace(spark, folder))
    return metrics.mean_metric(metrics.reciprocal_rank(recs, relevant), "rr").withColumnRenamed("rr", "mrr")


@query
def metrics_all(spark, folder):
    w = workspace(spark, folder)
    recs, relevant, _ = _test_lists(w)
    return metrics.all_metrics(recs, relevant, w.params.k_values, _prediction_pairs(w))


@query
def evaluate_model(spark, folder):
    return workspace(spark, folder).metrics


@query
def evaluate_full_chain(spark, folder):
    """Cleaning, dense core, split, encoding, popularity model and its evaluation, from the raw tables on."""
    ratings, items = driver_tables.dirty_ratings(spark, folder), driver_tables.part_items(spark, folder)
    return Workspace(ratings, items).metrics


@query
def evaluate_sample(spark, folder):
    w = workspace(spark, folder)
    return evaluation.evaluate_model(w.recommend, w.test_matrix, w.params.k_values, n_users=100)


@query
def evaluate_users(spark, folder):
    w = workspace(spark, folder)
    per_user = evaluation.evaluate_users(w.recommend, w.test_matrix, w.params.k_values, n_candidates=100)
    names = [f"{m}_at_{k}" for k in w.params.k_values for m in ("precision", "recall", "ndcg")]
    return per_user.select("user", *names)


@query
def evaluate_hybrid(spark, folder):
    w = workspace(spark, folder)
    return evaluation.evaluate_model(w.hybrid.recommend, w.test_matrix, w.params.k_values)


@query
def evaluate_implicit(spark, folder):
    """Binary feedback: popularity counts likes, and a held-out like is relevant."""
    return workspace(spark, folder, "implicit").metrics


@query
def evaluate_als(spark, folder):
    w = workspace(spark, folder)

    def by_factors(users: DataFrame, k: int) -> DataFrame:
        return w.als.recommend(users, w.seen, k)

    return evaluation.evaluate_model(by_factors, w.test_matrix, w.params.k_values)


@query
def relevant_items(spark, folder):
    return evaluation.relevant_pairs(workspace(spark, folder).test_matrix).distinct()


@query
def relevant_summary(spark, folder):
    return evaluation.relevant_summary(evaluation.relevant_pairs(workspace(spark, folder).test_matrix))


@query
def metrics_by_k(spark, folder):
    w = workspace(spark, folder)
    return metrics.by_k(w.metrics, w.params.k_values)


# --- runs, registry, bands ------------------------------------------------------------------


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    """Metric rows of the popularity model on the temporal and on the random split."""
    main, shuffled = workspace(spark, folder), workspace(spark, folder, "random")
    rows = registry.metric_rows(main.metrics, "popularity-temporal")
    return rows.unionByName(registry.metric_rows(shuffled.metrics, "popularity-random"))


@query
def best_run(spark, folder):
    return registry.best_run(_runs(spark, folder), "ndcg_at_10")


# run, metric of the version, stage, time: promotions, demotions and promotions again
EVENTS = [
    ("popularity-temporal", "ndcg_at_10", "Production", 1),
    ("popularity-random", "ndcg_at_10", "Production", 2),
    ("popularity-random", "ndcg_at_10", "Staging", 3),
    ("popularity-temporal", "ndcg_at_10", "Staging", 4),
    ("popularity-random", "ndcg_at_10", "Production", 5),
    ("popularity-temporal", "precision_at_10", "Production", 6),
    ("popularity-random", "ndcg_at_10", "Archived", 7),
    ("popularity-temporal", "ndcg_at_10", "Production", 8),
    ("popularity-random", "precision_at_10", "Production", 9),
    ("popularity-random", "precision_at_10", "Archived", 10),
    ("popularity-temporal", "precision_at_10", "Staging", 11),
    ("popularity-random", "ndcg_at_10", "Production", 12),
]


@query
def registry_current(spark, folder):
    """Stages after the events above, with a metric kept beside the one that names the version."""
    rows = stage(_runs(spark, folder), "run-rows")
    kept = registry.all_metrics(rows)
    events = None
    for run_id, metric, name, at in EVENTS:
        own = rows.where((F.col("run_id") == run_id) & (F.col("key") == metric))
        run = own.select("run_id", F.col("key").alias("metric"), F.round("number", DIGITS).alias("value"))
        event = registry.register(run, Params().model_name, name, F.lit(at), kept)
        events = event if events is None else events.unionByName(event)
    current = registry.current_stages(stage(events, "registry-events"))
    recall = F.col("metrics")["recall_at_10"].alias("recall_at_10")
    return current.select("model_name", "version", "stage", "run_id", "metric", "value", "registered_at", recall)


@query
def registry_commits(spark, folder):
    """The same events as commits of a registry log, one by one, and the stages they leave."""
    rows = stage(_runs(spark, folder), "run-rows")
    log = RegistryLog(spark, _stored_copy(spark, "registry-log"))
    for run_id, metric, name, at in EVENTS:
        own = rows.where((F.col("run_id") == run_id) & (F.col("key") == metric))
        run = own.select("run_id", F.col("key").alias("metric"), F.round("number", DIGITS).alias("value"))
        event = registry.register(run, Params().model_name, name, F.lit(at))
        log.commit(lambda events, event=event: event)
    return log.stages().withColumnRenamed("commit", "registered_at")


@query
def run_metrics(spark, folder):
    """The stored rows of both runs, appended one after the other."""
    path = _stored_copy(spark, "runs")
    for name in ("popularity-temporal", "popularity-random"):
        registry.append_rows(_runs(spark, folder).where(F.col("run_id") == name), path)
    rows = spark.read.schema(registry.RUNS).parquet(path)
    return rows.where(F.col("key").isin("ndcg_at_10", "precision_at_10", "recall_at_10")).select("run_id", "kind", "key", "number")


@query
def score_bands(spark, folder):
    w = workspace(spark, folder)
    return banding.score_band_counts(w.hybrid.recommend(_all_users(w), TOP))


@query
def similarity_bands(spark, folder):
    w = workspace(spark, folder)
    return banding.similarity_band_counts(neighbours.similar_by_genre(_all_items(w), w.genre_index, TOP))


@query
def rating_bands(spark, folder):
    return banding.rating_band_counts(workspace(spark, folder).interactions)
