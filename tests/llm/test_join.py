"""Near duplicates against all pairs by sets, and components against a walk."""


import numpy as np
import pytest
from pyspark.sql import functions as F
from text_cases import brute_classes as brute, grams

from ratingloom.llm import jaccard_join
from ratingloom.llm.components import connected_components
from ratingloom.llm.jaccard_join import Join


def edited(draw, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[draw.randrange(len(words))] = draw.choice(["alpha", "beta", "gamma"]) + str(draw.randrange(1000))
    return " ".join(words)


def found(spark, values, join=Join()):
    df = spark.createDataFrame([(k, t, 0) for k, t in values], "doc_id long, text string, class_id int")
    return {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.similar_texts(df, "doc_id", "text", join).collect()}


def sample(draw, prose):
    values, k = [], 0
    for size in (1, 1, 2, 3, 5, 20):
        for _ in range(6):
            base = prose(draw.randint(30, 160))
            for _ in range(size):
                values.append((k, edited(draw, base, draw.randint(0, 4))))
                k += 1
    shared = prose(60)
    values += [(k + i, shared + " " + prose(draw.randint(5, 80))) for i in range(60)]
    k += 60
    values += [(k, None), (k + 1, ""), (k + 2, "!!!"), (k + 3, "two words"), (k + 4, "Two, Words."), (k + 5, "two"), (k + 6, values[0][1].upper())]
    values += [(k + 10 + i, "the same text over and over again") for i in range(40)]
    return values


def test_links_and_classes_are_those_of_all_pairs(spark, draw, prose):
    values = sample(draw, prose)
    assert found(spark, values) == brute(values)


def test_wide_nodes_are_split_and_lose_nothing(spark, draw, prose):
    base = prose(70)
    values = [(i, edited(draw, base, draw.randint(0, 3))) for i in range(150)]
    shared = prose(40)
    values += [(1000 + i, shared + " " + prose(draw.randint(10, 120))) for i in range(150)]
    values += [(2000 + i, values[150 + i][1] + " end") for i in range(0, 150, 3)]
    assert found(spark, values, Join(small=8, block=16)) == brute(values)


def test_bands_hold_sets_of_one_size_once_and_every_similar_pair(spark, draw):
    wide = [(0, i, 100 + i % 3) for i in range(300)] + [(2, i, draw.randint(1, 400)) for i in range(300)] + [(4, i, s) for i, s in enumerate((5, 5, 40, 90, 91))]
    rows = spark.createDataFrame(wide, "node long, set long, n long").withColumn("tokens", F.lit(b""))
    bands = {}
    for r in jaccard_join._banded(rows, Join()).collect():
        bands.setdefault(r["node"], []).append(r["set"])
    assert sum(len(b) for b in bands.values() if len(b) == 300) == 300  # once, not in two bands
    places = {}
    root = {r["node"]: r["root"] for r in _roots_of_bands(rows)}
    for node, held in bands.items():
        for s in held:
            places.setdefault((root[node], s), set()).add(node)
    for root_node in (0, 2, 4):
        own = [(s, n) for node, s, n in wide if node == root_node]
        for s, n in own:
            assert all(places[root_node, s] & places[root_node, t] for t, m in own if 4 * max(n, m) <= 5 * min(n, m))


def _roots_of_bands(rows):
    """Every band node that a root may have, and that root."""
    bands = rows.select(F.col("node").alias("root")).distinct().crossJoin(rows.sparkSession.range(0, 64).select(F.col("id").alias("band")))
    return bands.select(F.xxhash64("root", "band").bitwiseAND(F.lit(-2).cast("long")).alias("node"), "root").collect()


def test_copies_of_a_third_of_all_rows(spark, prose):
    hot = prose(50)
    values = [(i, hot) for i in range(300)] + [(1000 + i, prose(50)) for i in range(600)]
    got = found(spark, values)
    assert all(got[i] == (0, 299) for i in range(300)) and all(got[1000 + i] == (1000 + i, 0) for i in range(600))


def test_one_of_each_class_stays(spark, draw, prose):
    values = sample(draw, prose)
    classes = brute(values)
    df = spark.createDataFrame([(k, t, "x") for k, t in values], "doc_id long, text string, print string")
    kept = jaccard_join.keep_one(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({root for root, _ in classes.values()})


def test_repeated_rows_and_null_keys(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_links) for r in jaccard_join.similar_texts(df, "doc_id", "text").collect())
    assert got == [(0, 0), (0, 2), (1, 2), (1, 2)]
    assert jaccard_join.keep_one(df, "doc_id", "text").count() == 2


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.similar_texts(df, "doc_id", "text").count() == 0
    assert jaccard_join.keep_one(df, "doc_id", "text").count() == 0


def test_another_threshold(spark, draw, prose):
    base = prose(60)
    values = [(i, edited(draw, base, i % 12)) for i in range(40)]
    sets = {k: grams(t) for k, t in values}
    want = {a: sum(2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b]) for b in sets if b != a) for a in sets}
    got = found(spark, values, Join(threshold=(1, 2)))
    assert {k: n for k, (_, n) in got.items()} == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7), (9, 8), (8, 9), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.u: r.v for r in connected_components(df, "a", "b").collect()}
    want = {i: 100 for i in range(101, 161)} | {500 + i: 500 for i in range(1, 40)} | {9: 8}
    assert got == want
    assert connected_components(df.where("a < 0"), "a", "b").count() == 0


def test_minhash_estimates_jaccard(draw, prose):
    from ratingloom.llm.text import slices
    import pyarrow as pa

    base = prose(400)
    texts = [base, edited(draw, base, 10)]
    ((_, _, data, offsets),) = slices(pa.array(texts))
    h, owner = jaccard_join.shingles(data, offsets, 5)
    sets = [set(h[owner == i].tolist()) for i in (0, 1)]
    assert len(sets[0]) == len(grams(texts[0])) and len(sets[0] & sets[1]) == len(grams(texts[0]) & grams(texts[1]))
    assert jaccard_join.chance(1, 0.8) == 0.8 and np.isclose(jaccard_join.chance(2, 0.8), 0.8 * (1 - np.exp(-1)))


@pytest.mark.parametrize("n", [0, 3])
def test_no_words_no_sets(spark, n):
    df = spark.createDataFrame([(i, "... !!") for i in range(n)], "doc_id long, text string")
    assert [r.n_links for r in jaccard_join.similar_texts(df, "doc_id", "text").collect()] == [0] * n
    assert df.select(F.count("*")).first()[0] == n


def test_positions_are_used_up_before_one_is_used_again():
    """Ten positions are enough for trees of depth 2, and a position that is used twice counts for less."""
    used = np.zeros(jaccard_join.COORDINATES, int)
    used[:10] = 1
    assert jaccard_join.missed(used, 2, 0.8) <= 1 - jaccard_join.RECALL < jaccard_join.missed(used[:9], 2, 0.8)
    again = np.array([2, 2] + [1] * 6)
    assert jaccard_join.missed(again, 2, 0.8) > jaccard_join.missed(np.ones(10), 2, 0.8)
    draw = np.random.default_rng(3)
    met = 0
    for _ in range(20_000):  # pairs that agree in a position with 0.8, and meet below with what depth 2 gives
        agree = draw.random(8) < 0.8
        below = draw.random(10) < jaccard_join.reached(2)
        met += any(agree[p] and below[t] for t, p in enumerate([0, 0, 1, 1, 2, 3, 4, 5, 6, 7]))
    assert abs(1 - met / 20_000 - jaccard_join.missed(again, 2, 0.8)) < 0.001


def test_sets_of_one_hash_are_told_apart_by_the_other(spark):
    rows = [(1, 5, 7, 70), (2, 5, 7, 70), (3, 5, 8, 71), (4, 6, 1, 72), (5, None, None, 73)]
    table = spark.createDataFrame(rows, "id long, set long, other long, print long")
    found = {r.id: r.set for r in jaccard_join._apart(table).collect()}
    assert found[1] == found[2] != found[3] and found[4] == 6 and found[5] is None and 5 not in (found[1], found[3])
