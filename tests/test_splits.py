import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import encoding, ordering, splits
from ratingloom.operators import core_filter as core_module
from ratingloom.operators.core_filter import core_audit, core_filter


def sizes(labelled, column="split"):
    return {r[0]: r[1] for r in labelled.groupBy(column).count().collect()}


def test_core_drops_thin_users(ratings):
    values = [(u, i, 4.0, 1) for u in (1, 3) for i in range(1, 6)] + [(2, i, 4.0, 1) for i in (1, 2)]
    kept = core_filter(ratings(values), 5, 1)
    assert {r.user_id for r in kept.collect()} == {1, 3}


def test_core_keeps_dense_table(ratings):
    values = [(u, i, 4.0, 1) for u in range(5) for i in range(2)]
    assert core_filter(ratings(values), 1, 5).count() == 10


def test_core_cascade_empties(ratings):
    # user 3 goes, then item 2 falls below two rows, then user 2, then item 1, then user 1
    values = [(1, 1, 4.0, 1), (1, 0, 4.0, 1), (2, 1, 4.0, 1), (2, 2, 4.0, 1), (3, 2, 4.0, 1)]
    before = ratings(values)
    kept = core_filter(before, 2, 2)
    assert kept.count() == 0
    assert core_audit(before, kept).first().asDict()["interactions_removed"] == 5


def test_core_equals_brute_force(ratings):
    rng = random.Random(3)
    pairs = {(int(rng.paretovariate(0.8)) % 60, int(rng.paretovariate(0.7)) % 60) for _ in range(700)}
    expected = set(pairs)
    while True:
        users = {u for u, _ in expected if sum(p[0] == u for p in expected) >= 4}
        items = {i for _, i in expected if sum(p[1] == i for p in expected) >= 4}
        smaller = {(u, i) for u, i in expected if u in users and i in items}
        if smaller == expected:
            break
        expected = smaller
    kept = core_filter(ratings([(u, i, 1.0, 1) for u, i in pairs]), 4, 4)
    assert {(r.user_id, r.item_id) for r in kept.collect()} == expected


def test_core_of_a_long_chain_is_empty(ratings):
    """Every removal starts the next one: no number of rounds is too many."""
    chain = [(i, i + side, 1.0, i) for i in range(12) for side in (0, 1)]
    assert core_filter(ratings(chain), 2, 2).count() == 0


def test_part_of_a_split_is_the_labelled_part(ratings):
    table = ratings([(i % 7, i % 11, 4.0, i // 9) for i in range(77)])
    cuts = splits.temporal_cuts(table, 0.6, 0.2, 0.2)
    labelled = cuts.label(table)
    for name in splits.PARTS:
        want = sorted(tuple(r) for r in splits.part_of(labelled, name).collect())
        assert sorted(tuple(r) for r in cuts.part(table, name).collect()) == want
    assert splits.temporal_cuts(table, 1.0, 0.0, 0.0).part(table, "test").count() == 0


def test_temporal_sizes_and_order(ratings):
    table = ratings([(i % 7, i, 4.0, i) for i in range(100)])
    labelled = splits.temporal_split(table, 0.8, 0.1, 0.1)
    assert sizes(labelled) == {"train": 80, "val": 10, "test": 10}
    bounds = {r.split: (r.lo, r.hi) for r in labelled.groupBy("split").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).collect()}
    assert bounds["train"][1] < bounds["val"][0] and bounds["val"][1] < bounds["test"][0]


def test_temporal_small(ratings):
    labelled = splits.temporal_split(ratings([(1, i, 4.0, i) for i in range(3)]), 0.34, 0.33, 0.33)
    assert sizes(labelled) == {"train": 1, "val": 1, "test": 1}


def test_bad_ratios(ratings):
    table = ratings([(1, 1, 4.0, 1)])
    for call in (splits.temporal_split, splits.random_split):
        with pytest.raises(ValueError):
            call(table, 0.8, 0.1, 0.2)
    with pytest.raises(ValueError):
        splits.nway_split(table, [0.5, 0.2])


@pytest.mark.parametrize("small", [1, 50, 10_000])
def test_cuts_inside_one_hot_time(ratings, monkeypatch, small):
    """Two thirds of the rows share a time and most of those a user."""
    monkeypatch.setattr(ordering, "SMALL", small)
    monkeypatch.setattr(ordering, "BUCKETS", 8)
    rng = random.Random(1)
    values = [(5, i, 4.0, 1000) for i in range(500)] + [(u, 1, 4.0, 1000) for u in range(6, 120)]
    values += [(u, 2, 3.0, rng.randrange(5000)) for u in range(300)]
    rng.shuffle(values)
    labelled = splits.temporal_split(ratings(values), 0.5, 0.25, 0.25)
    ordered = sorted((t, u, i) for u, i, _, t in values)
    n = len(values)
    expected = {"train": ordered[: int(n * 0.5)], "val": ordered[int(n * 0.5) : int(n * 0.75)], "test": ordered[int(n * 0.75) :]}
    got = {}
    for r in labelled.collect():
        got.setdefault(r.split, []).append((r.timestamp, r.user_id, r.item_id))
    assert {k: sorted(v) for k, v in got.items()} == expected


def test_negative_times(ratings, monkeypatch):
    monkeypatch.setattr(ordering, "SMALL", 1)
    monkeypatch.setattr(ordering, "BUCKETS", 4)
    labelled = splits.temporal_split(ratings([(1, i, 4.0, i * 1000 - 50_000) for i in range(100)]))
    assert sizes(labelled) == {"train": 80, "val": 10, "test": 10}


def test_random_split_ignores_partitioning(ratings, rows):
    table = ratings([(u, i, 4.0, 1) for u in range(30) for i in range(10)])
    first = splits.random_split(table, seed=7)
    second = splits.random_split(table.repartition(7), seed=7)
    assert sizes(first) == {"train": 240, "val": 30, "test": 30}
    assert rows(first) == rows(second)
    assert rows(first) != rows(splits.random_split(table, seed=8))


def test_nway_rounding(ratings):
    # 10 rows: int(3.3) twice, the last part takes the rest
    table = ratings([(u, 1, 4.0, 1) for u in range(10)])
    assert sizes(splits.nway_split(table, [0.33, 0.33, 0.34]), "part") == {0: 3, 1: 3, 2: 4}


def test_empty_part(ratings):
    labelled = splits.temporal_split(ratings([(1, i, 4.0, i) for i in range(5)]), 1.0, 0.0, 0.0)
    assert sizes(labelled) == {"train": 5}


def test_global_rank_with_hot_value(spark):
    rng = random.Random(5)
    values = [(7, i) for i in range(3000)] + [(rng.randrange(100), 10_000 + i) for i in range(3000)]
    rng.shuffle(values)
    table = spark.createDataFrame(values, "a long, b long").repartition(6)
    ranked = ordering.global_rank(table, F.asc("a"), F.desc("b")).collect()
    expected = sorted(values, key=lambda v: (v[0], -v[1]))
    assert [(r.a, r.b) for r in sorted(ranked, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in ranked) == list(range(1, 6001))


def test_encoders(ratings, rows):
    train = ratings([(u, i, 4.0, 1) for u, i in [(1, 10), (2, 20), (3, 30), (1, 20), (2, 30)]])
    users, items = encoding.fit_encoder(train, "user_id"), encoding.fit_encoder(train, "item_id")
    assert rows(users, "id", "idx") == [(1, 0), (2, 1), (3, 2)]
    assert rows(items, "id", "idx") == [(10, 0), (20, 1), (30, 2)]
    test = ratings([(1, 10, 4.0, 1), (2, 20, 4.0, 1), (99, 10, 4.0, 1)])
    assert rows(encoding.encode(test, users, items), "user_idx", "item_idx") == [(0, 0), (1, 1)]
    with pytest.raises(Exception, match="unknown user_id: 99"):
        encoding.encode(test, users, items, "error").collect()
    known = encoding.encode(test.where("user_id < 99"), users, items, "error")
    assert rows(known, "user_idx", "item_idx") == [(0, 0), (1, 1)]
    assert rows(encoding.lookup(test.select(F.col("user_id").alias("id")), users), "id", "idx") == [(1, 0), (2, 1), (99, None)]
    assert rows(encoding.decode(users.select("idx"), users, "idx", "user_id"), "user_id") == [(1,), (2,), (3,)]


def test_page(ratings, rows):
    encoder = encoding.fit_encoder(ratings([(u, 1, 4.0, 1) for u in range(1, 6)]), "user_id")
    assert rows(encoding.page(encoder, 2, 1)) == [(2, 5), (3, 5)]
    with pytest.raises(ValueError):
        encoding.page(encoder, 0)


def test_core_unravels_a_long_chain(ratings):
    """One end of a path starts a cascade that removes it row by row, until half is rewritten and all is gone."""
    path = [(n // 2, (n + 1) // 2, 1.0, 1) for n in range(40)]
    block = [(100 + u, 100 + i, 1.0, 1) for u in range(2) for i in range(2)]
    kept = core_filter(ratings(path + block), 2, 2)
    assert {(r.user_id, r.item_id) for r in kept.collect()} == {(u, i) for u, i, _, _ in block}


def test_null_times_are_refused(ratings):
    with pytest.raises(ValueError, match="1 rows have a null"):
        splits.temporal_split(ratings([(1, 1, 4.0, None), (1, 2, 4.0, 3)]))


def test_no_rows(ratings):
    assert splits.temporal_split(ratings([])).count() == 0
    assert splits.random_split(ratings([])).count() == 0


def test_core_rounds_read_only_buckets_of_dropped_ids(ratings):
    """A long path falls one end at a time, beside a block that stays; late rounds read a few buckets."""
    path = [(u, i, 1.0, 1) for u in range(60) for i in (u, u + 1)]  # the first item has one user
    block = [(1000 + u, 1000 + i, 1.0, 1) for u in range(12) for i in range(12)]
    seen = []
    kept = core_filter(ratings(path + block), 2, 2, visits=lambda key, n: seen.append((key, n)))
    assert kept.count() == 144 and kept.where("user_id < 1000").count() == 0
    late = [n for _, n in seen[2 * core_module.FULL_SCANS :]]
    assert len(late) > 20 and max(late) <= 2 and {n for _, n in seen[:6]} == {core_module.BUCKETS}
