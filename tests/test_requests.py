import pytest
from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.functions import bands
from ratingloom.operators import banding, encoding, recommend, registry, tuning
from ratingloom.params import Params
from ratingloom.plans import outputs
from ratingloom.plans.workspace import Workspace
from ratingloom.sources import files
from ratingloom.staging import stage

RATINGS = [
    (1, 10, 5.0, 1), (1, 20, 3.0, 2), (2, 10, 4.0, 3), (2, 30, 2.0, 4), (3, 20, 4.0, 5),
    (3, 30, 5.0, 6), (1, 30, 4.0, 7), (4, 10, 4.0, 8), (2, 20, 5.0, 9), (3, 10, 4.0, 10),
]
ITEMS = [(10, "Ten (1990)", "A|B"), (20, "Twenty (2000)", "B"), (40, "Forty", "C")]


@pytest.fixture(scope="module")
def space(spark):
    ratings = spark.createDataFrame(RATINGS, schemas.RATINGS)
    return Workspace(ratings, spark.createDataFrame(ITEMS, schemas.ITEMS), Params(), core=False)


def requests(spark, ids, column="user_id"):
    return spark.createDataFrame([(i,) for i in ids], f"{column} long")


def test_known_users_get_titles_and_defaults(spark, space, rows):
    recs = recommend.recommend_known(
        requests(spark, [4, 99]), space.users, space.item_ids, space.catalogue, space.recommend, 5
    )
    assert rows(recs, "user_id", "rank", "item_id", "title", "genres") == [
        (4, 1, 30, "Item 30", ""),
        (4, 2, 20, "Twenty (2000)", "B"),
    ]


def test_unknown_users_get_popular_items(spark, space, rows):
    cold = recommend.recommend_cold(requests(spark, [4, 99, 98, 99]), space.users, space.popularity, space.catalogue, 2)
    got = rows(cold, "user_id", "rank", "item_id")
    assert [g[:2] for g in got] == [(98, 1), (98, 2), (99, 1), (99, 2)]
    popular = rows(recommend.popular_items(space.popularity, space.catalogue, 2), "rank", "item_id")
    assert [g[1:] for g in got[:2]] == popular


def test_popular_ties_take_the_lower_id(spark, rows):
    scores = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 0.5)], "item_id long, popularity_score double")
    items = spark.createDataFrame([(1, "a", "x")], "item_id long, title string, genres string")
    assert rows(recommend.popular_items(scores, items, 2)) == [(1, 1, 1.0, "a", "x"), (2, 3, 1.0, None, None)]


@pytest.mark.parametrize("k", [0, 101])
def test_k_is_checked(spark, space, k):
    with pytest.raises(ValueError):
        recommend.recommend_known(requests(spark, [1]), space.users, space.item_ids, space.catalogue, space.recommend, k)


def test_similar_items(spark, space, rows):
    from ratingloom.operators.neighbours import similar_by_genre

    found = recommend.similar_items(
        requests(spark, [10, 40], "item_id"),
        space.item_ids,
        space.catalogue,
        lambda items, k: similar_by_genre(items, space.genre_index, k),
        1,
    )
    assert rows(found, "item_id", "rank", "similar_item_id", "similarity", "title") == [
        (10, 1, 20, 0.707107, "Twenty (2000)")
    ]


def test_history(spark, space, rows):
    history = recommend.user_history(requests(spark, [2, 99]), space.matrix, space.users, space.item_ids, space.catalogue)
    assert rows(history) == [(2, 10, 4.0, "Ten (1990)"), (2, 30, 2.0, None)]


def test_pages_and_counts(spark, space, rows):
    assert rows(encoding.page(space.users, 2, 1)) == [(2, 4), (3, 4)]
    listed = rows(recommend.items_page(space.item_ids, space.catalogue, 2, 1), "item_id", "title", "genres", "count")
    assert listed == [(20, "Twenty (2000)", "B", 3), (30, "Film #30", "", 3)]
    assert rows(recommend.model_counts(space.users, space.item_ids)) == [(4, 3)]


def test_parameters():
    with pytest.raises(ValueError):
        Params(model_type="svd")
    with pytest.raises(ValueError):
        Params(feedback_type="other")
    sections = {"feedback": {"type": "implicit"}, "split": None, "eval": {"k_values": [3]}, "other": {"x": 1}}
    params = Params.from_sections(sections)
    assert (params.feedback_type, params.k_values, params.train_ratio) == ("implicit", (3,), 0.8)


def test_similar_by_model(spark, space, rows):
    wanted = stage(spark.createDataFrame([(0,)], "item_idx long"), "items")
    by_genre = space.similar(wanted, 1)
    factors = Workspace(
        space.raw_ratings, space.raw_items, Params(model_type="als", factors=2, iterations=2), False, sibling=space
    )
    plain = Workspace(space.raw_ratings, space.raw_items.withColumn("genres", F.lit("")), Params(), core=False)
    for found in (by_genre, factors.similar(wanted, 1), plain.similar(wanted, 1)):
        assert [(r.item_idx, r["rank"]) for r in found.collect()] == [(0, 1)]


def test_saved_run(spark, space, tmp_path, rows):
    outputs.save_run(space, str(tmp_path), "run-1")
    assert spark.read.parquet(f"{tmp_path}/interactions").count() == 10
    assert {r.split for r in spark.read.parquet(f"{tmp_path}/splits").select("split").distinct().collect()} == {
        "train", "val", "test"
    }
    assert rows(files.load_encoder(spark, f"{tmp_path}/items-encoder"), "id") == [(10,), (20,), (30,)]
    assert files.load_matrix(spark, f"{tmp_path}/train-matrix").count() == 8
    assert files.read_json(spark, f"{tmp_path}/metadata").first().n_interactions == 8
    by_k = files.read_csv(spark, f"{tmp_path}/metrics-by-k", "k int, precision double, recall double, ndcg double, map double")
    assert [r.k for r in by_k.orderBy("k").collect()] == [5, 10, 20]
    outputs.save_run(space, str(tmp_path), "run-2")
    assert spark.read.parquet(f"{tmp_path}/runs").select("run_id").distinct().count() == 2


def test_whole_chain(spark, tmp_path):
    values = [(u, i, float(1 + (u * i) % 5), 1000 + (u * 17 + i * 31) % 997) for u in range(30) for i in range(20) if (u + i) % 3]
    ratings = spark.createDataFrame(values, schemas.RATINGS)
    items = spark.createDataFrame([(i, f"T{i} (199{i % 10})", "A|B" if i % 2 else "C") for i in range(20)], schemas.ITEMS)
    for params in (Params(), Params(model_type="hybrid"), Params(feedback_type="implicit", temporal_split=False)):
        space = Workspace(ratings, items, params)
        row = space.metrics.first()
        assert 0 <= row.precision_at_5 <= 1 and row.n_users_evaluated > 0
        event = space.register("run-1").first()
        assert event.run_id == "run-1" and len(event.version) == 8 and event.stage == "Production"


# --- runs and registry --------------------------------------------------------


def test_runs_and_best(spark, tmp_path, rows):
    path = str(tmp_path / "runs")
    registry.append_rows(registry.run_rows(spark, "a", {"k": 5, "grid": [1, 2]}, {"ndcg": 0.2, "rmse": 1.0}), path)
    registry.append_rows(registry.run_rows(spark, "b", {"k": 6}, {"ndcg": 0.3, "rmse": 2.0}), path)
    runs = spark.read.parquet(path)
    assert rows(runs.where("run_id = 'a' and kind = 'param'"), "key", "value") == [("grid", "[1, 2]"), ("k", "5")]
    assert rows(registry.best_run(runs, "ndcg")) == [("b", "ndcg", 0.3)]
    assert rows(registry.best_run(runs, "rmse", maximize=False)) == [("a", "rmse", 1.0)]
    assert rows(registry.best_run(runs, "missing")) == []


def test_promotion_archives_the_previous_holder(spark, rows):
    events = spark.createDataFrame(
        [("m", "v1", "Production", 1), ("m", "v2", "Staging", 2), ("m", "v2", "Production", 3), ("n", "v1", "Production", 1)],
        "model_name string, version string, stage string, registered_at int",
    )
    now = registry.current_stages(events)
    assert rows(now, "model_name", "version", "stage") == [
        ("m", "v1", "Archived"), ("m", "v2", "Production"), ("n", "v1", "Production")
    ]


# --- tuning -------------------------------------------------------------------


def test_drawn_parameters_stay_in_the_space():
    drawn = list(tuning.draw_parameters(50, seed=1))
    assert drawn == list(tuning.draw_parameters(50, seed=1)) != list(tuning.draw_parameters(50, seed=2))
    for p in drawn:
        assert p["factors"] in tuning.FACTORS and p["iterations"] in tuning.ITERATIONS and p["alpha"] in tuning.ALPHA
        assert 0.001 <= p["regularization"] <= 0.1
    assert tuning.metric_depth("ndcg_at_20") == 20 and tuning.metric_depth("mrr") == 10


def test_search_returns_a_trial_per_set(spark, space):
    small = [{"factors": 4, "regularization": 0.1, "iterations": 2, "alpha": a} for a in (1.0, 10.0)]
    trials = tuning.search(space.matrix, space.matrix, parameters=small, metric="precision_at_5")
    assert trials.count() == 2
    assert tuning.best_parameters(trials)["factors"] == 4


def test_rungs_halve_the_trials(spark, space):
    """Eight trials, three of the next rung, then one: each rung keeps the best and fits longer."""
    drawn = [{"factors": 2, "regularization": 0.1, "iterations": i, "alpha": a} for i in (1, 9) for a in (1.0, 5.0, 20.0, 40.0)]
    trials = tuning.search(space.matrix, space.matrix, parameters=drawn, metric="ndcg_at_5", eta=3, least_iterations=1, parallel=3)
    found = sorted(trials.collect())
    by_rung = {k: [r for r in found if r.rung == k] for k in range(3)}
    assert [len(by_rung[k]) for k in range(3)] == [8, 3, 1] and len(found) == 12
    assert all(r.fitted == min(r.iterations, 3**r.rung) for r in found if r.rung < 2) and by_rung[2][0].fitted == by_rung[2][0].iterations
    for k in (0, 1):
        best = sorted(by_rung[k], key=lambda r: (-r.value, r.trial))[: len(by_rung[k + 1])]
        assert {r.trial for r in best} == {r.trial for r in by_rung[k] if r.promoted} == {r.trial for r in by_rung[k + 1]}
    assert all(r.sound for r in tuning.rung_checks(trials).collect())
    assert tuning.final_trials(trials).count() == 8


def test_equal_and_missing_values_are_promoted_in_order(spark):
    schema = "rung int, trial int, value double"
    rung = spark.createDataFrame([(0, 3, 0.5), (0, 1, 0.5), (0, 0, None), (0, 2, 0.1)], schema)
    kept = lambda quota: {r.trial for r in tuning.promote(rung, quota).where("promoted").collect()}
    assert kept(1) == {1} and kept(2) == {1, 3} and kept(3) == {1, 2, 3} and kept(4) == {0, 1, 2, 3}
    wrong = tuning.promote(rung, 1).withColumn("promoted", F.col("trial") == 3)
    assert not all(r.sound for r in tuning.rung_checks(wrong).collect())


def test_tuned_run_takes_the_best_trial(spark, space):
    params = Params(model_type="als", factors=2, iterations=1, search_metric="precision_at_5")
    run = Workspace(space.raw_ratings, space.raw_items, params, False, sibling=space)
    small = [{"factors": f, "regularization": 0.1, "iterations": 2, "alpha": 1.0} for f in (4, 6)]
    trials = run.tune(parameters=small)
    tuned = run.tuned(trials)
    assert tuned.params.factors == tuning.best_parameters(trials)["factors"] in (4, 6)
    assert tuned.als.rank == tuned.params.factors and tuned.encoded is run.encoded
    assert space.tuned() is space


# --- bands --------------------------------------------------------------------


def test_bands(spark, rows):
    table = spark.createDataFrame([(0.8,), (0.79,), (0.6,), (0.1,)], "score double")
    got = {r.band: r.n for r in banding.score_band_counts(table).collect()}
    assert got == {"Tres recommande": 1, "Recommande": 2, "A decouvrir": 1}
    similar = spark.createDataFrame([(0.999,), (0.805,)], "similarity double")
    assert rows(banding.similarity_band_counts(similar)) == [("Tres similaire", 80, 1), ("Tres similaire", 99, 1)]
    rated = spark.createDataFrame([(1, 4.5), (1, 3.0), (1, 0.5)], "item_id long, rating double")
    assert rows(banding.rating_band_counts(rated)) == [(1, "high", 4, 1, 0, 1), (1, "low", 0, 1, 4, 1), (1, "medium", 3, 0, 2, 1)]


def test_rounded_stars(spark):
    row = spark.createDataFrame([(2.25,), (2.75,)], "r double").select(bands.half_star(F.col("r")).alias("h")).collect()
    assert [r.h for r in row] == [0, 1]


# --- files --------------------------------------------------------------------


def test_csv_round_trip(spark, tmp_path, rows):
    path = str(tmp_path / "items.csv")
    items = spark.createDataFrame([(1, 'A "quoted", title (1999)', "X|Y"), (2, "Plain", "Z")], schemas.ITEMS)
    files.write_csv(items, path)
    assert rows(files.read_items_csv(spark, path)) == rows(items)
    ratings = spark.createDataFrame([(1, 2, 3.5, 4)], schemas.RATINGS)
    files.write_csv(ratings, str(tmp_path / "ratings.csv"))
    assert rows(files.read_ratings_csv(spark, str(tmp_path / "ratings.csv"))) == rows(ratings)


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        files.read_ratings_csv(spark, str(tmp_path / "nothing.csv")).collect()


def test_parquet_json_matrix_and_encoder(spark, tmp_path, rows):
    frame = spark.createDataFrame([(1, "a", 0.5)], "k long, name string, value double")
    files.write_parquet(frame, str(tmp_path / "p"))
    assert rows(files.read_parquet(spark, str(tmp_path / "p"))) == rows(frame)
    files.write_json(frame, str(tmp_path / "j"))
    assert rows(files.read_json(spark, str(tmp_path / "j"), frame.schema)) == rows(frame)
    matrix = spark.createDataFrame([(0, 1, 2.0), (1, 0, 0.0)], "user_idx long, item_idx long, value double")
    files.save_matrix(matrix, str(tmp_path / "m"))
    assert rows(files.load_matrix(spark, str(tmp_path / "m"))) == rows(matrix)
    encoder = spark.createDataFrame([(10, 0)], "id long, idx long")
    files.save_encoder(encoder, str(tmp_path / "e"))
    assert rows(files.load_encoder(spark, str(tmp_path / "e"))) == [(10, 0)]


def test_als_model_round_trip(spark, tmp_path, space):
    from ratingloom.operators.latent import fit_als

    model = fit_als(space.matrix, factors=4, iterations=2)
    files.save_als(model, str(tmp_path / "als"))
    assert files.load_als(str(tmp_path / "als")).userFactors.count() == model.userFactors.count()


def test_nested_recommendations(spark):
    recs = spark.createDataFrame([(1, 2, 20), (1, 1, 10)], "user_id long, rank int, item_id long")
    row = files.nested_recommendations(recs).first()
    assert [(r["rank"], r.item_id) for r in row.recommendations] == [(1, 10), (2, 20)]


def test_wrong_page_and_version(spark):
    runs = spark.createDataFrame([("r", "ndcg", 0.5)], "run_id string, metric string, value double")
    event = registry.register(runs, "m", "Staging", F.lit(1)).first()
    import hashlib

    assert event.version == hashlib.md5(b"m|r|ndcg|500000").hexdigest()[:8]
