"""CSV files by header name, and rejected rows."""

import pytest
from pyspark.sql import functions as F

from ratingloom import schemas, staging
from ratingloom.operators import neighbours, registry
from ratingloom.operators.signature_blocks import block_rows, promising_signatures
from ratingloom.sources import files


def written(tmp_path, text, name="file.csv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_columns_are_matched_by_name(spark, tmp_path):
    path = written(tmp_path, "movieId,extra,userId,rating,timestamp\n10,x,1,4.5,100\n20,y,2,3,200\n")
    assert rows_of(files.read_ratings_csv(spark, path)) == [(1, 10, 4.5, 100), (2, 20, 3.0, 200)]


def test_whole_numbers_in_other_spellings(spark, tmp_path):
    path = written(tmp_path, "userId,movieId,rating,timestamp\n2.0,10,4,1e3\n 3 ,20,1e0,9007199254740993\n,30,2,5\n")
    got = {r.movieId: tuple(r) for r in files.read_ratings_csv(spark, path).collect()}
    assert got == {10: (2, 10, 4.0, 1000), 20: (3, 20, 1.0, 9007199254740993), 30: (None, 30, 2.0, 5)}


def test_bad_rows_are_counted_not_lost(spark, tmp_path):
    lines = ["1,10,4,1", "1.5,10,4,1", "x,10,4,1", "1,10,good,1", "1,10,4", "1,10,4,1,9", "1,10,,1"]
    path = written(tmp_path, "userId,movieId,rating,timestamp\n" + "\n".join(lines) + "\n")
    audit = {r.reason: r.n_rows for r in files.csv_audit(spark, path, schemas.RATINGS).collect()}
    assert audit == {None: 2, "userId": 2, "rating": 1, "number of values": 2}
    assert files.read_ratings_csv(spark, path).count() == 2


def test_missing_columns_and_paths_raise(spark, tmp_path):
    path = written(tmp_path, "userId,movieId,timestamp\n1,2,3\n")
    with pytest.raises(ValueError, match="rating"):
        files.read_ratings_csv(spark, path)
    with pytest.raises(Exception, match="(?i)path"):
        files.read_ratings_csv(spark, str(tmp_path / "none.csv"))


def test_files_of_one_folder_must_agree(spark, tmp_path):
    written(tmp_path, "userId,movieId,rating,timestamp\n1,10,4,1\n", "a.csv")
    written(tmp_path, "movieId,userId,rating,timestamp\n10,1,4,1\n", "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_ratings_csv(spark, str(tmp_path)).collect()


def test_quotes_and_line_ends_inside_values(spark, tmp_path):
    path = written(tmp_path, 'movieId,title,genres\n1,"A ""b"", c (1990)",x|y\n2,"two\nlines",z\n')
    got = rows_of(files.read_csv(spark, path, schemas.ITEMS, multiline=True))
    assert got == [(1, 'A "b", c (1990)', "x|y"), (2, "two\nlines", "z")]


def events(spark, rows):
    return spark.createDataFrame([("m", *r) for r in rows], "model_name string, version string, stage string, registered_at int")


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("A", "Production", 1), ("B", "Production", 2), ("B", "Archived", 3)], {"A": "Archived", "B": "Archived"}),
        ([("A", "Production", 1), ("B", "Production", 2), ("B", "Staging", 3)], {"A": "Archived", "B": "Staging"}),
        ([("A", "Production", 1), ("B", "Production", 2), ("A", "Production", 3)], {"A": "Production", "B": "Archived"}),
        ([("A", "Production", 1), ("B", "Staging", 2)], {"A": "Production", "B": "Staging"}),
        ([("A", "Production", 1), ("B", "Production", 1)], {"A": "Production", "B": "Archived"}),
    ],
)
def test_archived_versions_stay_archived(spark, rows, expected):
    assert {r.version: r.stage for r in registry.current_stages(events(spark, rows)).collect()} == expected


def test_registration_keeps_all_metrics(spark):
    rows = registry.run_rows(spark, "r", {"a": 1}, {"x": 0.5, "y": 0.25})
    event = registry.register(registry.best_run(rows, "x"), "m", "Staging", F.lit(1), registry.all_metrics(rows)).first()
    assert event.metric == "x" and event.metrics == {"x": 0.5, "y": 0.25}


def test_tied_signatures_give_k_untouched_rows(spark):
    n, k = 3000, 10
    signatures = spark.createDataFrame([(i, [0], 1, 0.5, i) for i in range(n)], "sig long, genre_ids array<long>, size int, score double, place long")
    prefs = spark.createDataFrame([(u, 0, 1.0) for u in range(4)], "user_idx long, genre_idx long, pref double")
    touched = spark.createDataFrame([(0, 1), (0, 3), (1, 2999)], "user_idx long, sig long")
    found = promising_signatures(prefs, touched, staging.stage(signatures, "tied"), k, 0.6, 4).collect()
    free = {u: sorted(r.sig for r in found if r.user_idx == u and not r.touched) for u in range(4)}
    assert free[0] == [0, 2, *range(4, 12)] and free[1] == free[2] == list(range(10))
    assert sorted(r.sig for r in found if r.touched) == [1, 3]


def test_blocks_are_sized_for_the_vocabulary(spark):
    assert block_rows(18, 18) == 16_384 and block_rows(20_000, 5) * min(20_000, 5 * block_rows(20_000, 5)) * 8 <= 64 * 1024 * 1024
    words = [(i, [7 * i % 20_000, (7 * i + 1) % 20_000]) for i in range(2_000)]
    vectors = staging.stage(spark.createDataFrame(words, "id long, v array<long>"), "words")
    queries, corpus = vectors.selectExpr("id AS qid", "array_sort(v) AS qvec"), vectors.selectExpr("id AS cid", "array_sort(v) AS cvec")
    found = neighbours.blocked_top_n(queries, corpus, 2, 2, kernel="set_cosine", exclude_self=True, rows=block_rows(20_000, 2))
    near = {(r.qid, r.rank): r.cid for r in found.collect()}
    assert len(near) == 4_000 and near[(0, 1)] == 1_999


def test_stages_keep_their_folder_and_can_be_deleted(spark, tmp_path):
    before = staging.work_folder(spark)
    app = spark.sparkContext.applicationId
    try:
        staging.use_folder(spark, str(tmp_path))
        stored = staging.stage(spark.range(3), "three")
        assert stored.count() == 3 and staging.work_folder(spark) == f"{tmp_path}/ratingloom-{app}"
        assert staging.drop_staged(spark) and not (tmp_path / f"ratingloom-{app}").exists()
    finally:
        staging.use_folder(spark, before.rsplit("/", 1)[0])
