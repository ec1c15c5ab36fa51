"""Language identification, toxicity and language model scores."""

import collections
import math
import os
import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from text_cases import plain_words, sentence

from ratingloom import staging
from ratingloom.llm import dealt, language_id, suffix_tree, toxicity

LANGUAGES = {"xa": "the of and was with ing tion er".split(), "xb": "der und ein ich sch keit ung zu".split(), "xc": "él ñor ción que los mente ado ía".split()}


def foreign(draw, name, n):
    return " ".join("".join(draw.choice(LANGUAGES[name]) for _ in range(draw.randint(1, 3))) for _ in range(n))


def test_languages_of_held_out_texts(spark):
    draw = random.Random(1)
    rows = [(i, foreign(draw, n, draw.randint(3, 60)), n) for i, n in enumerate(draw.choices(list(LANGUAGES), [8, 2, 1], k=900))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = language_id.held_out(F.col("doc_id"), 4, 2)
    model = language_id.fit(df.where(~held), "text", "lang")
    got = language_id.identify(df.where(held), "text", model).collect()
    assert len(got) > 100 and np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 < r.score <= 1 for r in got)


def test_texts_without_letters_are_unknown(spark):
    df = spark.createDataFrame([(1, "abc abc", "xa"), (2, "ñññ", "xb"), (3, "no", None)], "doc_id long, text string, lang string")
    model = language_id.fit(df, "text", "lang")
    odd = [(1, None, "s"), (2, "", "s"), (3, "12 — !!", "s"), (4, "abc", "s"), (5, "…ñ", "s"), (6, "𝒳" * 3, "s"), (6, "abc " * 200_000, "s")]
    asked = spark.createDataFrame(odd, "doc_id long, text string, score string")
    got = {(r.doc_id, (r.text or "")[:3]): (r.lang_pred, r.score) for r in language_id.identify(asked, "text", model).collect()}
    assert [got[k][0] for k in sorted(got)] == ["und", "und", "und", "xa", "xb", "xa", got[(6, "𝒳𝒳𝒳")][0]]
    assert got[(1, "")][1] == 0.0 and got[(6, "𝒳𝒳𝒳")][0] in ("xa", "xb")


def test_no_labelled_rows_no_language(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = language_id.fit(df, "text", "lang")
    assert language_id.identify(df, "text", model).first().lang_pred == "und"
    assert language_id.identify(df.where("false"), "text", model).count() == 0


def test_language_features_match_a_plain_count():
    table = language_id.letter_table()
    text = "Ab, é1 É"
    data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
    feature, owner = language_id.grams(data, offsets, table)
    folded = re.sub(r"[^a-zé]+", " ", text.lower())
    letters = len(folded.replace(" ", ""))
    assert len(feature) == letters + (len(folded) - 1) + (len(folded) - 2) and set(owner.tolist()) == {0}


BAD = ["vileword", "nastyterm", "uglyname"]


def labelled(n, seed):
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = draw.random() < 0.15
        words = sentence(draw, draw.randint(10, 80)).split()
        if bad:
            for _ in range(draw.randint(1, 4)):
                words.insert(draw.randrange(len(words)), draw.choice(BAD) + draw.choice(["", "s", "ish", "!"]))
        rows.append((i, " ".join(words)))
        if draw.random() < 0.5:
            labels.append((i, int(bad), int(bad)))
    return rows, labels


def test_toxic_texts_from_positive_and_unlabelled_ones(spark):
    rows, labels = labelled(3000, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1, 1), (5, None, 0)], "doc_id long, toxic int, text int")
    held = language_id.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(df.where(~held), "doc_id", "text", marks.where(~held), "doc_id", "toxic")
    truth = {i: int(any(b in t for b in BAD)) for i, t in rows}
    got = toxicity.score(df.where(held), "text", model).collect()
    hit = [(truth[r.doc_id], int(r.score >= 0.5)) for r in got]
    assert all(0 <= r.score <= 1 for r in got)
    assert np.mean([a == b for a, b in hit]) > 0.97
    assert sum(a & b for a, b in hit) >= 0.9 * sum(a for a, _ in hit)


def test_toxicity_of_odd_texts_and_without_positives(spark):
    rows, labels = labelled(800, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, x int")
    model = toxicity.fit(df, "doc_id", "text", marks, "doc_id", "toxic")
    odd = [(1, None, "a"), (2, "", "a"), (3, "... 12", "a"), (3, "... 12", "a"), (4, "lo ka " * 100_000 + BAD[0] + " " + BAD[1], "a")]
    scored = toxicity.score(spark.createDataFrame(odd, "doc_id long, text string, score string"), "text", model)
    got = [r.score for r in scored.orderBy("doc_id").collect()]
    assert len(set(got[:4])) == 1 and got[0] < 0.5 <= got[4]
    assert toxicity.fit(df, "doc_id", "text", marks.where("toxic = 0"), "doc_id", "toxic") is None
    assert {r.score for r in toxicity.score(df, "text", None).collect()} == {0.0}
    assert toxicity.score(df.where("false"), "text", model).count() == 0


def test_risk_gradient_is_that_of_the_loss():
    """With a non-negative second term, one step from zero lowers the estimator."""
    draw = np.random.default_rng(0)
    rows = lambda n, p: toxicity.Rows(np.flatnonzero(draw.random((n, 6)) < p) % 6, np.arange(1, n + 1))
    positive = toxicity.Rows(np.array([0, 1] * 50), np.arange(2, 102, 2))
    unlabelled = toxicity.Rows(np.concatenate([[0, 1] * 10, [2, 3] * 90]), np.arange(2, 202, 2))
    w, b = toxicity.train(positive, unlabelled, 6, 0.1, 0)
    assert w[0] > 0 and w[1] > 0 and w[0] + w[1] + b > 0 > w[2] + w[3] + b and w[4] == 0 and rows(3, 0.5).ends[-1] == 3


@pytest.mark.parametrize("prior, below", [(0.2, False), (0.9, True)])
def test_risk_gradient_equals_a_numeric_one(prior, below):
    draw = np.random.default_rng(5)
    batch = lambda n: (draw.integers(0, 6, 4 * n), np.repeat(np.arange(n), 4), n)
    unlabelled, positive = batch(30), batch(20)
    w = draw.standard_normal(7) + (np.array([0] * 6 + [2.0]) if below else 0)
    if below:  # positive rows far on the positive side, unlabelled ones on the other
        unlabelled, positive = (unlabelled[0] % 3, *unlabelled[1:]), (3 + positive[0] % 3, *positive[1:])
        w[:3], w[3:6] = -2.0, 2.0

    def parts(w):
        margin = lambda side: np.bincount(side[1], w[side[0]], side[2]) + w[-1]
        gu, gp = margin(unlabelled), margin(positive)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        return prior * np.logaddexp(0, -gp).mean(), negative

    assert (parts(w)[1] < 0) == below
    risk = (lambda w: -parts(w)[1]) if below else (lambda w: sum(parts(w)))
    step = 1e-6 * np.eye(7)
    numeric = np.array([(risk(w + d) - risk(w - d)) / 2e-6 for d in step])
    assert np.allclose(toxicity.risk_gradient(w, unlabelled, positive, prior), numeric, atol=1e-7)


def test_toxic_texts_are_found_where_more_of_them_are_unlabelled_than_the_prior_says():
    draw = np.random.default_rng(4)

    def rows(n, toxic):
        marks = [np.flatnonzero(draw.random(20) < (0.25 if t else 0.01)) for t in np.arange(n) < toxic]
        return toxicity.Rows(np.concatenate(marks), np.cumsum([len(m) for m in marks]))

    positive, harmless, unlabelled = rows(600, 600), rows(1_000, 0), rows(2_000, 800)
    w, bias = toxicity.train(positive, unlabelled, 20, 0.1, 0)
    found = lambda texts, w, bias: np.mean([w[c].sum() + bias >= 0 for c in np.split(texts.columns, texts.ends[:-1])])
    assert found(positive, w, bias) < 0.7
    w, bias = toxicity.calibrated(w, bias, positive, harmless)
    assert found(positive, w, bias) > 0.9
    assert found(harmless, w, bias) < 0.1


def test_the_drivers_samples_are_held_end_to_end():
    """Rows come in the order of their bytes, empty ones too, and scores of many rows need memory for a few at a time."""
    draw = np.random.default_rng(6)
    parts = [np.sort(draw.choice(5_000, n, replace=False)).astype("<i4") for n in [0, 0, 1, *draw.integers(300, 700, 2_000)]]
    rows = toxicity.gathered(bytearray(p.tobytes()) for p in parts)
    expected = sorted(p.tobytes() for p in parts)
    assert [c.tobytes() for c in np.split(rows.columns, rows.ends[:-1])] == expected
    assert [len(toxicity.gathered(iter(x))) for x in ([], [b"", b""])] == [0, 2]
    w = draw.standard_normal(5_000)
    sums = [w[np.frombuffer(p, "<i4")].sum() for p in expected]
    tracemalloc.start()
    found, _ = toxicity.calibrated(w, 0.0, rows, rows)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(rows.totals(w), sums) and found.shape == w.shape
    assert most < 8 * len(rows.columns)  # a number a column and row


def test_a_hot_text_is_one_text_of_the_samples(spark):
    """A text that a third of the rows copy neither fills the samples nor crowds out a language."""
    rows, labels = labelled(900, 4)
    hot = [(10_000 + i, "ka lo mi " * 30) for i in range(450)]
    df = spark.createDataFrame(rows + hot, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, x int")
    model = toxicity.fit(df, "doc_id", "text", marks, "doc_id", "toxic", unlabelled=300)
    got = {r.doc_id: r.score for r in toxicity.score(df, "text", model).collect()}
    truth = {i: any(b in t for b in BAD) for i, t in rows}
    assert np.mean([(got[i] >= 0.5) == bad for i, bad in truth.items()]) > 0.95 and got[10_000] < 0.5
    draw = random.Random(2)
    texts = [(foreign(draw, n, 30), n) for n in ("xa", "xb", "xc") for _ in range(60)] + [("der und ein " * 9, "xb")] * 300
    table = spark.createDataFrame(texts, "text string, lang string")
    known = language_id.fit(table, "text", "lang", per_language=25)
    found = language_id.identify(table, "text", known).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97


def test_dirty_language_values_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 5)
    df = spark.createDataFrame([("some text", f"l{i}") for i in range(9)], "text string, lang string")
    with pytest.raises(ValueError, match="more than 5 languages"):
        language_id.fit(df, "text", "lang")


def test_scores_are_those_of_a_plain_naive_bayes(spark):
    draw = random.Random(8)
    train = [(foreign(draw, n, draw.randint(2, 25)), n) for n in ("xa", "xb", "xc") for _ in range(30)] + [("Ab, é1 É", "xc")]
    asked = [foreign(draw, draw.choice(list(LANGUAGES)), 12) for _ in range(30)] + ["ABC  def", "é", "1 a 1"]
    table = language_id.letter_table()

    def plain_grams(text):
        data = text.encode()
        return language_id.grams(np.frombuffer(data, np.uint8), np.array([0, len(data)]), table)[0].tolist()

    counts = {n: collections.Counter() for n in LANGUAGES}
    for text, n in train:
        counts[n].update(plain_grams(text))
    rows = collections.Counter(n for _, n in train)
    total = {n: sum(c.values()) + language_id.SMOOTHING * language_id.BUCKETS for n, c in counts.items()}
    model = language_id.fit(spark.createDataFrame(train, "text string, lang string"), "text", "lang")
    df = spark.createDataFrame([(t,) for t in asked], "text string")
    for r in language_id.identify(df, "text", model).collect():
        log = {
            n: math.log(rows[n] / len(train)) + sum(math.log((counts[n][g] + language_id.SMOOTHING) / total[n]) for g in plain_grams(r.text))
            for n in LANGUAGES
        }
        best = max(sorted(log), key=log.get)
        assert r.lang_pred == best
        assert math.isclose(r.score, 1 / sum(math.exp(v - log[best]) for v in log.values()), rel_tol=1e-3)


def tokens(text):
    return plain_words(text, r"[^\x20\x09-\x0D]+")


def base_scores(train, asked):
    count = collections.Counter()
    for t in train:
        count.update(tokens(t))
        count[None] += 1
    n, v = sum(count.values()), len(count)
    out = {}
    for k, t in asked:
        own = [*tokens(t), None]
        out[k] = (len(own), sum(count[w] > 0 for w in own), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
    return out


def test_base_scores_are_add_one_estimates(spark, monkeypatch):
    draw = random.Random(4)
    train = [sentence(draw, draw.randint(0, 40)) for _ in range(300)] + [None, "", "Rare\tONE\x0bTwo\nthree"]
    asked = [(i, t) for i, t in enumerate([*train[:20], None, "", "unseen words here", "ka", "rare one", "x " * 50_000])]
    schema = "doc_id long, text string, score string"
    learn = spark.createDataFrame([(i, t, "s") for i, t in enumerate(train)], schema)
    for share in (suffix_tree.HEAD_SHARE, 0.01):  # all words broadcast, or most of them joined
        monkeypatch.setattr(suffix_tree, "HEAD_SHARE", share)
        tree, counts = suffix_tree.fit(learn, "text")
        got = suffix_tree.score(spark.createDataFrame([(i, t, "s") for i, t in asked], schema), "doc_id", "text", tree, counts).collect()
        for r in got:
            want = base_scores(train, asked)[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and math.isclose(r.base_score, want[3], rel_tol=1e-9)


def plain_tree(train, share):
    """Next-symbol probability by the definition, with dictionaries."""
    grams = collections.Counter()
    texts = [[None, *tokens(t), False] for t in train]
    for w in texts:
        for n in range(1, suffix_tree.DEPTH + 2):
            for i in range(len(w) - n + 1):
                grams[tuple(w[i : i + n])] += 1
    count = {g[0]: c for g, c in grams.items() if len(g) == 1 and g[0] is not None}
    n_tokens, v = sum(count.values()), len(count)
    least = max(suffix_tree.LEAST_COUNT, share * n_tokens)
    states = {}

    def p(context, x):
        while context and context not in states:
            context = context[1:]
        if not context:
            return (count.get(x, 0) + 1) / (n_tokens + v + 1)
        known, rest, total = states[context]
        return (known[x] - suffix_tree.DISCOUNT) / total * (x in known) + rest * p(context[1:], x) if x in known else rest * p(context[1:], x)

    for depth in range(1, suffix_tree.DEPTH + 1):
        level = collections.defaultdict(dict)
        for g, c in grams.items():
            if len(g) == depth + 1 and c >= least:
                level[g[:-1]][g[-1]] = c
        kept = {}
        for s, known in level.items():
            total = grams[s]
            below = {x: p(s[1:], x) for x in known}
            gain = sum(c / total * math.log(c / total / below[x]) for x, c in known.items())
            other, other_below = 1 - sum(known.values()) / total, max(1 - sum(below.values()), 1e-12)
            gain += other * math.log(other / other_below) if other > 1e-12 else 0
            if total * gain >= suffix_tree.GAIN + len(known):
                kept[s] = (known, max(1 - sum(c - suffix_tree.DISCOUNT for c in known.values()) / total, 1e-12), total)
        states.update(kept)
    return p, count


def test_scores_are_those_of_the_definition(spark):
    draw = random.Random(6)
    phrase = sentence(draw, 6)
    train = [" ".join([sentence(draw, draw.randint(1, 12)), phrase, sentence(draw, 3)]) for _ in range(60)]
    train += [draw.choice(["aa bb cc", "aa bb dd", "ee bb ff"]) for _ in range(200)]
    learn = spark.createDataFrame(list(enumerate(train)), "doc_id long, text string").repartition(3)
    tree, counts = suffix_tree.fit(learn, "text")
    assert sum(len(x[0]) for x in tree.rests.values()) > 5
    p, _ = plain_tree(train, suffix_tree.SHARE)
    asked = [*train[:15], *train[-15:], "zz aa bb cc", "", "bb", phrase + " " + phrase]
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    for r in suffix_tree.score(df, "doc_id", "text", tree, counts).collect():
        w = [None, *tokens(asked[r.doc_id]), False]
        want = sum(math.log10(p(tuple(w[max(0, i - suffix_tree.DEPTH) : i]), w[i])) for i in range(1, len(w)))
        assert math.isclose(r.score, want, rel_tol=1e-6), (asked[r.doc_id], r.score, want)


@pytest.mark.parametrize("head_nodes, head_share, mark_bits", [(None, None, None), (0, 0.01, None), (40, 0.01, None), (20, None, None), (40, 0.01, 1 << 9)])
def test_scores_use_every_ngram_whatever_its_share(spark, monkeypatch, head_nodes, head_share, mark_bits):
    if mark_bits:  # a map that is full lets everything pass
        monkeypatch.setattr(dealt, "MOST_MARK_BITS", mark_bits)
    monkeypatch.setattr(suffix_tree, "SHARE", 0.01)  # no n-gram below a share of the tokens may be lost
    if head_nodes is not None:  # most of the tree is joined
        monkeypatch.setattr(suffix_tree, "HEAD_NODES", head_nodes)
    if head_share is not None:
        monkeypatch.setattr(suffix_tree, "HEAD_SHARE", head_share)
    draw = random.Random(6)
    phrases = [sentence(draw, 6) for _ in range(8)]
    train = [" ".join([sentence(draw, draw.randint(1, 12)), draw.choice(phrases), sentence(draw, 3)]) for _ in range(160)]
    train += [draw.choice(["aa bb cc", "aa bb dd", "ee bb ff"]) for _ in range(200)]
    learn = spark.createDataFrame(list(enumerate(train)), "doc_id long, text string").repartition(3)
    tree, counts = suffix_tree.fit(learn, "text")
    p, _ = plain_tree(train, 0)
    asked = [*train[:15], *train[-15:], "zz aa bb cc", "", "bb", *phrases, phrases[0] + " " + phrases[1]]
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = suffix_tree.score(df, "doc_id", "text", tree, counts).collect()
    assert len(got) == len(asked)
    for r in got:
        w = [None, *tokens(asked[r.doc_id]), False]
        want = sum(math.log10(p(tuple(w[max(0, i - suffix_tree.DEPTH) : i]), w[i])) for i in range(1, len(w)))
        assert math.isclose(r.score, want, rel_tol=1e-6), (asked[r.doc_id], r.score, want)
        assert math.isclose(r.base_score, base_scores(train, [(0, asked[r.doc_id])])[0][3], rel_tol=1e-9)
    if head_nodes is not None:
        assert sum(len(x[0]) for x in [*tree.entries.values(), *tree.rests.values()]) <= head_nodes and tree.tail.count()


def test_the_map_is_asked_only_for_what_the_head_does_not_hold(monkeypatch):
    data = np.frombuffer(b"a b c a b d a b c", np.uint8)
    offsets = np.array([0, len(data)])
    words, owner = suffix_tree.symbols(data, offsets)
    pairs = np.unique([g for n, g, _ in suffix_tree._grams(words, owner, 2)][1])[::2]
    tables = suffix_tree._Tables.__new__(suffix_tree._Tables)
    tables.words = suffix_tree.Lookup(np.sort(np.unique(words))[:2], np.array([3, 4]))
    tables.entries, tables.rests = {2: suffix_tree.Lookup(pairs, np.full(len(pairs), -0.5))}, {}
    tables.marks, tables.flat = np.zeros((64, 8), np.uint8), 1.0
    asked = []
    monkeypatch.setattr(suffix_tree, "marked", lambda marks, keys: (asked.extend(keys.tolist()), np.ones(len(keys), bool))[1])
    p = suffix_tree._Places(tables, data, offsets)
    assert asked and not set(pairs.tolist()) & set(asked)
    (at, code, ids), = p.open
    assert code == 2 and len(at) == len(asked) and not set(at.tolist()) & set(np.flatnonzero(p.best == 2).tolist())
    plain = np.where(p.count >= 0, np.log10(np.maximum(p.count, 0) + 1.0) - 1.0, 0.0)
    assert (p.root == plain).all()


def test_entries_are_looked_for_behind_states_alone(monkeypatch):
    data = np.frombuffer(b"a b c a b d a b c", np.uint8)
    offsets = np.array([0, len(data)])
    words, owner = suffix_tree.symbols(data, offsets)
    states = np.unique(words)[:2]
    tables = suffix_tree._Tables.__new__(suffix_tree._Tables)
    tables.words = suffix_tree.Lookup(np.unique(words), np.ones(len(np.unique(words))))
    none = np.zeros(0, np.uint64), np.zeros(0)
    tables.entries, tables.rests = {2: suffix_tree.Lookup(*none)}, {1: suffix_tree.Lookup(states, np.full(2, -0.5))}
    tables.marks, tables.flat = np.zeros((64, 8), np.uint8), 1.0
    pairs = [g for n, g, _ in suffix_tree._grams(words, owner, 2)][1]
    monkeypatch.setattr(suffix_tree, "marked", lambda marks, keys: np.isin(keys, pairs))
    asked = {code: at for at, code, _ in suffix_tree._Places(tables, data, offsets).open}
    assert len(asked[-1]) == 0 and set(asked[2]) == set(np.flatnonzero(np.isin(words[:-1], states)) + 1)


def test_each_part_of_the_counts_has_a_task_of_its_own(spark):
    draw = random.Random(9)
    texts = spark.createDataFrame([(" ".join(sentence(draw, 9) for _ in range(20)),) for _ in range(40)] * 4, "t string").repartition(2)
    grams = suffix_tree._gram_counts(texts, 2, spark.sparkContext.broadcast(None), 16).withColumn("task", F.spark_partition_id()).collect()
    parts = dealt.part_of(np.array([r.gram for r in grams]).view(np.uint64), 16)
    assert len(set(parts.tolist())) == 16 and all(r.task == part for r, part in zip(grams, parts.tolist()))


def test_tables_of_a_length_are_gone_when_the_next_is_counted(spark, monkeypatch):
    there, store = {}, suffix_tree._stage

    def watched(df, name):
        folder = staging.work_folder(spark)
        there[name] = {x.rsplit("-", 1)[0] for x in os.listdir(folder)} - before if os.path.isdir(folder) else set()
        return store(df, name)

    before = {x.rsplit("-", 1)[0] for x in os.listdir(staging.work_folder(spark))} if os.path.isdir(staging.work_folder(spark)) else set()
    monkeypatch.setattr(staging, "stage", lambda df, name, stage=staging.stage: stage(df, f"own-{name}"))
    monkeypatch.setattr(suffix_tree, "_stage", watched)
    learn = spark.createDataFrame([(i, "aa bb cc dd ee ff") for i in range(9)], "doc_id long, text string")
    tree, counts = suffix_tree.fit(learn, "text")
    last = suffix_tree.DEPTH + 1
    for n in range(3, last + 1):
        assert there[f"grams{n}"] == {"own-words", f"own-level{n - 1}", *(f"own-nodes{k}" for k in range(2, n))}
    assert f"own-grams{last}" not in there[f"states{last - 1}"] and f"own-level{last - 1}" not in there[f"level{last}"]
    assert suffix_tree.score(learn, "doc_id", "text", tree, counts).count() == 9


def test_nothing_broadcast_is_kept_after_the_scores(spark, monkeypatch):
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append((send(self, value), type(value))) or sent[-1][0])
    learn = spark.createDataFrame([(i, "aa bb cc") for i in range(9)], "doc_id long, text string")
    scored = suffix_tree.score(learn, "doc_id", "text", *suffix_tree.fit(learn, "text"))
    own = [x for x, kind in sent if kind is not bytes]  # bytes are a function that Spark sends
    assert len(own) > suffix_tree.DEPTH and not any(x._jbroadcast.isValid() for x in own)
    assert scored.count() == 9


def test_a_lookup_tells_keys_of_one_range_apart():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 500).astype(np.uint64))
    keys = np.append(keys, np.uint64(2**64 - 1))
    for own in (keys, suffix_tree._turned(keys), keys[:0]):
        asked = np.append(own, keys + np.uint64(1))
        held = dict(zip(own.tolist(), range(len(own))))
        hit, values = suffix_tree.Lookup(own, np.arange(len(own))).find(asked)
        assert hit.tolist() == [i for i, k in enumerate(asked.tolist()) if k in held]
        assert values.tolist() == [held[k] for k in asked[hit].tolist()]


def test_a_state_is_a_distribution():
    draw = random.Random(8)
    train = [draw.choice(["aa bb cc", "aa bb dd", "aa cc"]) for _ in range(80)]
    p, count = plain_tree(train, suffix_tree.SHARE)
    total = sum(p(("aa", "bb"), x) for x in [*count, "never seen"])
    assert math.isclose(total, 1, rel_tol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_scores_with_little_or_nothing_learned(spark, rows):
    learn = spark.createDataFrame(rows, "doc_id long, text string")
    tree, counts = suffix_tree.fit(learn, "text")
    asked = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    got = suffix_tree.score(asked, "doc_id", "text", tree, counts).collect()
    assert len(got) == 3 and all(math.isclose(r.score, r.base_score) and r.score <= 0 for r in got)
    assert suffix_tree.score(asked.where("false"), "doc_id", "text", tree, counts).count() == 0
