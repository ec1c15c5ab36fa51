"""Spelling variants against all pairs of words."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from text_cases import lower

from ratingloom.llm import spelling

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def brute_counts(rows, damage=97, least=5):
    found = collections.Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if damage and h % damage == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= least:
                found[run] += 1
    return found


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts, least=3, ratio=2):
    kept = {w: n for w, n in counts.items() if n >= least}
    around = {w: [] for w in kept}
    for a, b in itertools.combinations(kept, 2):
        if near(a, b):
            around[a].append(b)
            around[b].append(a)
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda x: (-kept[x], x), default=None)
        form[w] = best if best and kept[best] >= ratio * kept[w] else None
    out = set()
    for w in kept:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, kept[w], len(around[w]), kept.get(form[w])))
    return out


def groups(spark, counts, **kwargs):
    words = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, form string")
    return {tuple(r) for r in spelling.group_spellings(words, **kwargs).collect()}


def drawn_words(draw, letters, n, longest=9):
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(3, longest))) for _ in range(n)}
    return {w: draw.choice([1, 2, 3, 4, 6, 8, 12, 24, 48, 200]) for w in sorted(words)}


@pytest.mark.parametrize("letters", ["abc", "abcdefghé", "xyzÿß日本"])
def test_groups_are_those_of_all_pairs(spark, letters):
    counts = drawn_words(random.Random(letters), letters, 700)
    assert groups(spark, counts) == brute_groups(counts)


def test_small_blocks_and_chunks(spark, monkeypatch):
    for name, value in {"BLOCK_WORDS": 3, "CHUNK_WORDS": 2, "GRAM_ROWS": 2, "CHUNK_LETTERS": 40}.items():
        monkeypatch.setattr(spelling, name, value)
    counts = drawn_words(random.Random(5), "ab", 150, 8)
    assert groups(spark, counts, least_count=1) == brute_groups(counts, 1)


def test_ways_of_several_forms(spark):
    counts = {"aaaaaa": 3, "aaaaab": 6, "aaaabb": 12, "aaabbb": 24, "aabbbb": 48, "abbbbb": 96, "bbbbbb": 192, "cbbbbb": 192, "zzzzz": 5}
    found = {r[0]: r for r in groups(spark, counts)}
    assert found["aaaaaa"][2] == "bbbbbb" and found["zzzzz"][1:3] == (None, "zzzzz")
    assert groups(spark, counts) == brute_groups(counts)


def test_word_counts_with_planted_errors(spark, draw):
    texts = [" ".join(draw.choice(["Grande", "élan", "niño!", "tres-bien", "Über", "a", "×÷×÷×", "日本語", "x1yyyyyy"]) for _ in range(60)) for _ in range(120)]
    rows = list(enumerate(texts)) + [(5, texts[5]), (None, "grande grande"), (7, None), (8, ""), (9, "q" * 3000 + "é" * 70 + " " + "w" * 64 + " " + "v" * 65)]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n long")
    for damage in (0, 3, 97):
        got = {r.word: r.n for r in spelling.word_counts(df, "text", "doc_id", damage).collect()}
        assert got == brute_counts(rows, damage)


def test_checksums_are_those_of_the_library():
    draw = random.Random(2)
    spans = [bytes(draw.randrange(256) for _ in range(draw.choice([0, 1, 5, 9, 63, 64, 65, 300]))) for _ in range(200)]
    ends = np.cumsum([len(s) for s in spans])
    before = [zlib.crc32(bytes([i])) for i in range(200)]
    got = spelling.checksums(np.frombuffer(b"".join(spans), np.uint8), ends - [len(s) for s in spans], ends, np.array(before, np.uint32))
    assert got.tolist() == [zlib.crc32(s, b) for s, b in zip(spans, before)]


def test_long_words(spark):
    base = "ab" * 3000
    counts = {base: 10, base[:2999] + base[3000:]: 4, base[:17] + "c" + base[18:]: 5, base + "ab": 9}
    assert groups(spark, counts) == brute_groups(counts)


def test_no_words(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    words = spelling.word_counts(df, "text", "doc_id", 97)
    assert words.count() == 0 and spelling.group_spellings(words).count() == 0
    odd = spark.createDataFrame([(None, 9), ("", 9), ("short", None)], "word string, n long")
    assert spelling.group_spellings(odd).count() == 0


def test_a_block_split_over_batches():
    words = ["aaaaa", "aaaab", "aaaac", "aaaad"]
    rows = [(1, 0, False, w, 3) for w in words] + [(1, 0, True, "aaaae", 9), (2, 0, False, "bbbbb", 3)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(["cell", "part", "right", "word", "n"], r))]) for r in rows]
    found = collections.Counter()
    for batch in spelling._compare(iter(batches)):
        for r in batch.to_pylist():
            found[r["word"]] += r["near"]
    assert found == {**{w: 4 for w in words}, "aaaae": 4}
