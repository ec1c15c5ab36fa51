"""Models against plain Python on small random data."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import neighbours, popularity, unseen
from ratingloom.operators.genres import GenreIndex, content_scores, genre_features, genre_vocabulary
from ratingloom.operators.hybrid import HybridModel
from ratingloom.operators.latent import FactorModel, fit_als
from ratingloom.staging import stage

CELLS = "user_idx long, item_idx long, value double"


def encoder(spark, n):
    return stage(spark.range(n).select(F.col("id"), F.col("id").alias("idx")), "encoder")


def cells(spark, dense):
    rows = [(u, i, float(v)) for u, line in enumerate(dense) for i, v in enumerate(line) if v]
    return stage(spark.createDataFrame(rows, CELLS), "matrix")


def users_of(spark, n):
    return stage(spark.range(n).select(F.col("id").alias("user_idx")), "users")


# --- popularity ---------------------------------------------------------------


def test_item_scores(spark, rows):
    matrix = cells(spark, [[1, 0], [1, 1], [1, 0]])
    assert rows(popularity.item_scores(matrix, encoder(spark, 2)), "item_idx", "score") == [(0, 1.0), (1, 0.333333)]


def test_item_without_rows_scores_zero(spark, rows):
    matrix = cells(spark, [[2, 0, 0]])
    assert rows(popularity.item_scores(matrix, encoder(spark, 3)), "item_idx", "score") == [(0, 1.0), (1, 0.0), (2, 0.0)]


def test_ties_go_to_the_higher_index(spark, rows):
    matrix = cells(spark, [[1, 0, 0.5], [1, 1, 0], [1, 0, 0.5]])
    ranked = popularity.ranked_items(popularity.item_scores(matrix, encoder(spark, 3)))
    recs = popularity.recommend_popular_unseen(users_of(spark, 1), ranked, None, 2)
    assert rows(recs, "rank", "item_idx") == [(1, 0), (2, 2)]


def test_seen_items_are_left_out(spark, rows):
    matrix = cells(spark, [[1, 0.5, 0.3]])
    ranked = popularity.ranked_items(popularity.item_scores(matrix, encoder(spark, 3)))
    seen = spark.createDataFrame([(0, 0)], "user_idx long, item_idx long")
    recs = popularity.recommend_popular_unseen(users_of(spark, 1), ranked, seen, 2)
    assert rows(recs, "rank", "item_idx") == [(1, 1), (2, 2)]


@pytest.mark.parametrize("chunk", [7, 65_536])
def test_unseen_equals_brute_force(spark, monkeypatch, chunk):
    """Users have seen nothing, a bit, the whole head, nearly everything and everything."""
    monkeypatch.setattr(unseen, "CHUNK", chunk)
    n_items, k = 700, 5
    rng = random.Random(4)
    seen_of = {0: set(), 1: {0, 3}, 2: set(range(40)), 3: set(range(600)), 4: set(range(n_items)), 5: set(range(n_items - 2))}
    for u in range(6, 30):
        seen_of[u] = set(rng.sample(range(n_items), rng.choice([1, 20, 300])))
    ranked = stage(spark.range(n_items).select(F.col("id").alias("item_idx"), (F.col("id") + 1).alias("pos")), "ranked")
    seen = stage(
        spark.createDataFrame([(u, i) for u, s in seen_of.items() for i in s], "user_idx long, item_idx long"), "seen"
    )
    got = {}
    for r in unseen.first_unseen(users_of(spark, 30), ranked, seen, k).collect():
        got.setdefault(r.user_idx, []).append((r["rank"], r.item_idx))
    for u, s in seen_of.items():
        expected = [i for i in range(n_items) if i not in s][:k]
        assert [i for _, i in sorted(got.get(u, []))] == expected, u
        assert [r for r, _ in sorted(got.get(u, []))] == list(range(1, len(expected) + 1))


def test_similar_popular(spark, rows):
    matrix = cells(spark, [[4, 3, 2, 1]])
    ranked = popularity.ranked_items(popularity.item_scores(matrix, encoder(spark, 4)))
    items = encoder(spark, 4).select(F.col("idx").alias("item_idx"))
    got = rows(popularity.similar_popular(items, ranked, 2), "item_idx", "rank", "similar_idx")
    assert got == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 0), (2, 2, 1), (3, 1, 0), (3, 2, 1)]


# --- genres and the blend -----------------------------------------------------

GENRE_TEXTS = ["A|B", "B", " A | C", "(no genres listed)", "", None, "A|B", "C|B|A", "D"]


def catalogue(spark, texts):
    return spark.createDataFrame([(i, f"t{i}", t) for i, t in enumerate(texts)], "item_id long, title string, genres string")


def test_vocabulary_and_features(spark, rows):
    items = catalogue(spark, GENRE_TEXTS)
    assert rows(genre_vocabulary(items), "genre", "genre_idx") == [("A", 0), ("B", 1), ("C", 2), ("D", 3)]
    got = rows(genre_features(encoder(spark, 11), items), "item_idx", "genre")
    assert [g for g in got if g[0] in (2, 3, 4, 5, 9, 10)] == [(2, "A"), (2, "C")]


class Plain:
    """The blend over every user and item, in Python."""

    def __init__(self, dense, texts):
        self.dense, self.n = dense, len(texts)
        self.genres = [
            set() if t in (None, "", "(no genres listed)") else {g.strip() for g in t.split("|")} for t in texts
        ]
        totals = [sum(line[i] for line in dense) for i in range(self.n)]
        self.totals, top = totals, max(totals)
        self.pop = [t / top for t in totals]

    def prefs(self, u):
        weights = {}
        for i, v in enumerate(self.dense[u]):
            if v > 0:
                for g in self.genres[i]:
                    weights[g] = weights.get(g, 0.0) + max(0.0, (v - 2.5) / 2.5)
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {g: w / norm for g, w in weights.items()} if norm else {}

    def scores(self, u):
        prefs = self.prefs(u)
        rated = any(v > 0 for v in self.dense[u])
        content = [
            sum(prefs.get(g, 0.0) for g in gs) / math.sqrt(len(gs)) if gs else 0.0 for gs in self.genres
        ]
        return [0.6 * p + 0.4 * c for p, c in zip(self.pop, content)] if rated else self.pop

    def recommend(self, u, k, seen):
        scores = self.scores(u)
        rest = [i for i in range(self.n) if i not in seen]
        rest.sort(key=lambda i: (-math.floor(scores[i] * 1e9 + 0.5), -self.totals[i], -i))
        return [(i, round(scores[i], 6)) for i in rest[:k]]

    def similar(self, i, n):
        def cosine(j):
            a, b = self.genres[i], self.genres[j]
            return len(a & b) / (math.sqrt(max(len(b), 1)) * math.sqrt(len(a)) + 1e-8)

        rest = sorted((j for j in range(self.n) if j != i), key=lambda j: (-math.floor(cosine(j) * 1e9 + 0.5), -j))
        return [(j, round(cosine(j), 6)) for j in rest[:n]]


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(90):
        pool = "ABCDEFG"[: rng.choice([2, 4, 7])]
        texts.append("|".join(rng.sample(pool, rng.randrange(1, 3))) if rng.random() > 0.1 else "(no genres listed)")
    texts[5:45] = ["A|B"] * 40  # one signature holds nearly half of the items
    dense = [[0.0] * 90 for _ in range(14)]
    for u in range(2, 14):
        for i in rng.sample(range(90), rng.choice([3, 15, 40])):
            dense[u][i] = rng.randrange(1, 11) / 2
    dense[1] = [1.5 if i % 3 == 0 else 0.0 for i in range(90)]  # only low ratings: no preferences
    dense[2] = [5.0 if i not in (7, 60, 61) else 0.0 for i in range(90)]  # has seen nearly everything
    dense[3] = [4.5 if 5 <= i < 44 else 0.0 for i in range(90)]  # has seen the large signature
    matrix = cells(spark, dense)
    items = encoder(spark, 90)
    ranked = popularity.ranked_items(popularity.item_scores(matrix, items))
    index = GenreIndex(items, catalogue(spark, texts))
    return Plain(dense, texts), matrix, index, HybridModel(matrix, ranked, index), dense


@pytest.mark.parametrize("k, exclude", [(1, True), (10, True), (30, True), (10, False)])
def test_blend_equals_brute_force(spark, world, k, exclude):
    plain, _, _, model, dense = world
    got = {}
    for r in model.recommend(users_of(spark, 14), k, exclude).collect():
        got.setdefault(r.user_idx, []).append((r["rank"], r.item_idx, round(r.score, 6)))
    for u in range(14):
        seen = {i for i, v in enumerate(dense[u]) if v} if exclude else set()
        assert [(i, s) for _, i, s in sorted(got.get(u, []))] == plain.recommend(u, k, seen), u


def test_blend_for_some_users_only(spark, world):
    plain, _, _, model, dense = world
    wanted = stage(spark.createDataFrame([(4,), (6,)], "user_idx long"), "users")
    assert {r.user_idx for r in model.recommend(wanted, 3).collect()} == {4, 6}


def test_blend_over_many_blocks(spark, world, monkeypatch):
    from ratingloom.operators import signature_blocks

    plain, _, _, model, dense = world
    for name, value in (("USER_BLOCK", 3), ("SIGNATURE_BLOCK", 5), ("CHUNK_CELLS", 10)):
        monkeypatch.setattr(signature_blocks, name, value)
    got = {}
    for r in model.recommend(users_of(spark, 14), 4).collect():
        got.setdefault(r.user_idx, []).append((r["rank"], r.item_idx))
    for u in range(14):
        seen = {i for i, v in enumerate(dense[u]) if v}
        assert [i for _, i in sorted(got.get(u, []))] == [i for i, _ in plain.recommend(u, 4, seen)], u


def test_users_leave_the_scan_when_the_popular_ones_are_enough(monkeypatch):
    """The popular signatures decide: the product meets a small part of all cells, and nothing is lost."""
    import numpy as np
    import pandas as pd

    from ratingloom.operators import signature_blocks

    rng = np.random.default_rng(3)
    n, k, weight = 600, 4, 0.6
    sets = [np.sort(rng.choice(9, rng.integers(1, 4), replace=False)) for _ in range(n)]
    score = np.sort(rng.random(n) ** 6)[::-1]
    signatures = pd.DataFrame({"sig": rng.permutation(n), "genre_ids": sets, "size": [len(s) for s in sets], "score": score, "place": np.arange(n)})
    prefs = rng.random((30, 9)) * (rng.random((30, 9)) < 0.6)
    prefs /= np.maximum(np.sqrt((prefs**2).sum(1, keepdims=True)), 1e-9)
    seen = [rng.choice(n, rng.integers(0, 40), replace=False) for _ in range(30)]
    genres = [np.flatnonzero(p) for p in prefs]
    users = pd.DataFrame({"user_idx": np.arange(30), "genres": genres, "prefs": [p[g] for p, g in zip(prefs, genres)], "touched": seen})
    users = users[[len(g) > 0 for g in genres]]
    cells = []
    monkeypatch.setattr(signature_blocks.np, "floor", lambda x, floor=np.floor: cells.append(x.size if x.ndim == 2 else 0) or floor(x))
    got = signature_blocks._promising(k, weight, 10_000, 16, 1e9)(users, signatures)
    assert sum(cells) < 0.5 * n * len(users)
    for u in users["user_idx"]:
        rows = []
        for i, (sig, members) in enumerate(zip(signatures["sig"], sets)):
            content = prefs[u][members].sum() / math.sqrt(len(members))
            if content > 0:
                rows.append((-math.floor((weight * score[i] + (1 - weight) * content) * 1e9 + 0.5), i, sig))
        want, free = set(), 0
        for _, _, sig in sorted(rows):
            if free < k:
                want.add(sig)
            free += sig not in seen[u]
        assert set(got[got["user_idx"] == u]["sig"]) == want, u


def test_content_scores(spark, world):
    plain, matrix, index, model, dense = world
    pairs = spark.createDataFrame([(u, i) for u in range(14) for i in range(90)], "user_idx long, item_idx long")
    for r in content_scores(pairs, model.preferences, index).collect():
        prefs, genres = plain.prefs(r.user_idx), plain.genres[r.item_idx]
        expected = sum(prefs.get(g, 0.0) for g in genres) / math.sqrt(len(genres)) if genres else 0.0
        assert math.isclose(r.content, expected, abs_tol=1e-9)


@pytest.mark.parametrize("n", [1, 8])
def test_similar_by_genre_equals_brute_force(spark, world, n):
    plain, _, index, _, _ = world
    items = encoder(spark, 90).select(F.col("idx").alias("item_idx"))
    got = {}
    for r in neighbours.similar_by_genre(items, index, n).collect():
        got.setdefault(r.item_idx, []).append((r["rank"], r.similar_idx, round(r.similarity, 6)))
    for i in range(90):
        assert [(j, s) for _, j, s in sorted(got[i])] == plain.similar(i, n), i


# --- blocked products ---------------------------------------------------------


@pytest.mark.parametrize("block_bytes", [800, 32 * 1024 * 1024])
def test_blocked_products_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(neighbours, "CHUNK_CELLS", 200)
    rng = random.Random(6)
    vectors = {i: [float(rng.randrange(-3, 4)) for _ in range(4)] for i in range(120)}
    table = stage(spark.createDataFrame(list(vectors.items()), "id long, vector array<double>"), "vectors")
    got = {}
    for r in neighbours.similar_by_dot(table, 4, 7).collect():
        got.setdefault(r.item_idx, []).append((r["rank"], r.similar_idx))
    for i, v in vectors.items():
        dots = {j: sum(a * b for a, b in zip(v, w)) for j, w in vectors.items() if j != i}
        assert [j for _, j in sorted(got[i])] == sorted(dots, key=lambda j: (-dots[j], -j))[:7]


def test_blocked_products_leave_pairs_out(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 400)
    rng = random.Random(8)
    corpus = {i: [rng.random() for _ in range(3)] for i in range(50)}
    queries = {i: [rng.random() for _ in range(3)] for i in range(20)}
    skipped = {(q, c) for q in range(20) for c in range(50) if rng.random() < 0.5} | {(0, c) for c in range(50)}
    found = neighbours.blocked_top_n(
        stage(spark.createDataFrame(list(queries.items()), "qid long, qvec array<double>"), "q"),
        stage(spark.createDataFrame(list(corpus.items()), "cid long, cvec array<double>"), "c"),
        5,
        3,
        exclude=spark.createDataFrame(sorted(skipped), "qid long, cid long"),
    )
    got = {}
    for r in found.collect():
        got.setdefault(r.qid, []).append((r["rank"], r.cid))
    for q, v in queries.items():
        dots = {c: sum(a * b for a, b in zip(v, w)) for c, w in corpus.items() if (q, c) not in skipped}
        assert [c for _, c in sorted(got.get(q, []))] == sorted(dots, key=lambda c: (-dots[c], -c))[:5]


def nearest(spark, queries, corpus, n, **kwargs):
    seen = []
    found = neighbours.blocked_top_n(
        stage(spark.createDataFrame(list(queries.items()), "qid long, qvec array<double>"), "q"),
        stage(spark.createDataFrame(list(corpus.items()), "cid long, cvec array<double>"), "c"),
        n,
        3,
        visits=lambda q, b: seen.append((q, b)),
        **kwargs,
    )
    got = {}
    for r in found.collect():
        got.setdefault(r.qid, []).append((r["rank"], r.cid))
    return {q: [c for _, c in sorted(v)] for q, v in got.items()}, seen


def plain_nearest(queries, corpus, n, skipped=()):
    key = lambda v, c: math.floor(sum(a * b for a, b in zip(v, corpus[c])) * 1e9 + 0.5)
    return {q: sorted((c for c in corpus if (q, c) not in skipped), key=lambda c: (-key(v, c), -c))[:n] for q, v in queries.items()}


@pytest.mark.parametrize("chunk", [3, 1024])
def test_queries_leave_when_the_norms_ahead_are_too_small(spark, monkeypatch, chunk):
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", chunk)
    rng = random.Random(3)
    # few long vectors, many short ones
    corpus = {i: [rng.random() * (10.0 / (1 + i)) for _ in range(3)] for i in range(160)}
    queries = {i: [rng.random() for _ in range(3)] for i in range(40)} | {98: [0.0, 0.0, 0.0], 99: [-1.0, -1.0, -1.0]}
    skipped = {(3, c) for c in range(150)} | {(4, 0), (4, 1)}
    pairs = spark.createDataFrame(sorted(skipped), "qid long, cid long")
    got, seen = nearest(spark, queries, corpus, 5, rows=10, exclude=pairs)
    assert got == plain_nearest(queries, corpus, 5, skipped)
    assert sum(q * b for q, b in seen) < 0.4 * len(queries) * 16


def test_equal_norms_and_ties_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 4)
    rng = random.Random(4)
    axes = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, -1.0]]
    corpus = {i: rng.choice(axes) for i in range(90)} | {200 + i: [0.0, 0.0, 0.0] for i in range(20)}
    queries = {i: rng.choice([*axes, [0.6, 0.8, 0.0], [0.0, 0.0, 1.0]]) for i in range(25)}
    got, seen = nearest(spark, queries, corpus, 7, rows=9)
    assert got == plain_nearest(queries, corpus, 7)
    assert nearest(spark, queries, corpus, 200, rows=9)[0] == plain_nearest(queries, corpus, 200)


# --- factors ------------------------------------------------------------------


@pytest.fixture(scope="module")
def factors(spark):
    rng = random.Random(1)
    dense = [[rng.choice([0, 0, 1, 3, 5]) for _ in range(20)] for _ in range(10)]
    matrix = cells(spark, dense)
    return matrix, FactorModel(fit_als(matrix, factors=8, iterations=3)), dense


def test_factor_shapes(factors):
    _, model, _ = factors
    counts = {r.kind: r["count"] for r in model.factors().groupBy("kind").count().collect()}
    assert counts == {"user": 10, "item": 20}
    assert {len(r.features) for r in model.factors().collect()} == {8}


def test_factor_recommendations(spark, factors):
    matrix, model, dense = factors
    recs = model.recommend(users_of(spark, 10), None, 5)
    assert {r["count"] for r in recs.groupBy("user_idx").count().collect()} == {5}
    unseen_recs = model.recommend(users_of(spark, 10), matrix.select("user_idx", "item_idx"), 5).collect()
    assert all(dense[r.user_idx][r.item_idx] == 0 for r in unseen_recs)
    predicted = {(r.user_idx, r.item_idx): r.prediction for r in model.predict(recs.select("user_idx", "item_idx")).collect()}
    for r in recs.collect():
        assert math.isclose(predicted[(r.user_idx, r.item_idx)], r.score, rel_tol=1e-4, abs_tol=1e-5)


def test_list_checks_find_a_better_row_left_out(spark, factors):
    matrix, model, _ = factors
    seen = matrix.select("user_idx", "item_idx")
    pairs = seen.select(F.col("user_idx").alias("qid"), F.col("item_idx").alias("cid"))
    lists = model.recommend(users_of(spark, 10), seen, 4).select(F.col("user_idx").alias("qid"), F.col("item_idx").alias("cid"), "score", "rank")
    assert all(r.sound and r.best for r in model.list_checks(stage(lists, "lists"), pairs).collect())
    without = lists.where("rank > 1").withColumn("rank", F.col("rank") - 1)
    checked = model.list_checks(stage(without, "lists"), pairs).collect()
    assert len(checked) > 5 and all(r.sound and not r.best for r in checked)


def test_factor_neighbours(factors):
    _, model, _ = factors
    similar = model.similar_items(5).collect()
    assert len(similar) == 100 and all(r.item_idx != r.similar_idx for r in similar)


def test_training_recalls_liked_items(spark):
    """Two groups with separate tastes: nobody is recommended the other group's items."""
    rng = random.Random(12)
    dense = [[5.0 if (u < 15) == (i < 10) and rng.random() < 0.7 else 0.0 for i in range(20)] for u in range(30)]
    matrix = cells(spark, dense)
    model = FactorModel(fit_als(matrix, factors=2, iterations=8))
    recs = model.recommend(users_of(spark, 30), matrix.select("user_idx", "item_idx"), 1).collect()
    unfinished = {u for u in range(30) if sum(v > 0 for v in dense[u]) < 10}
    own = [(r.user_idx < 15) == (r.item_idx < 10) for r in recs if r.user_idx in unfinished]
    assert len(own) > 20 and all(own)
