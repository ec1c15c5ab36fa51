"""Token counts and packing against the tokenizer itself."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from ratingloom.llm import packing, pieces, token_counts
from ratingloom.llm.packing import Limits

ALPHABET = [" ", "  ", "\n", "\t", "\r\n", "\x1c", "a", "bc", "'s", "é", "1", "²", "!", "<|endoftext|>", "中", "…", "\u0085", "　", "🙂", "the"]


def texts():
    draw = random.Random(3)
    odd = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 14))) for _ in range(1500)]
    long = " ".join("".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 9))) for _ in range(9000))
    return odd + [None, "", " ", "x" * 5000, long, long, "same", "same"]


def library_ids(path, values):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(path).encode_batch([v or "" for v in values], add_special_tokens=False)]


def frame(spark, values):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType())])
    return spark.createDataFrame([(i, v, "clash") for i, v in enumerate(values)], schema)


def test_counts_are_the_librarys(spark, tokenizer_file):
    values = texts()
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame(spark, values), "text", tokenizer_file).collect()}
    assert got == {i: len(x) for i, x in enumerate(library_ids(tokenizer_file, values))}


def test_counts_of_an_empty_table(spark, tokenizer_file):
    df = token_counts.count_tokens(frame(spark, ["a"]).where("doc_id < 0"), "text", tokenizer_file)
    assert df.columns == ["doc_id", "text", "n_tokens"] and df.count() == 0


def test_counts_of_a_sentencepiece_model(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece

    path = tokenizers.path("piece_bpe_32k.model")
    values = ["a little text", None, "", "día  niño 中"]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame(spark, values), "text", path).collect()}
    assert got == {i: len(model.encode(v or "")) for i, v in enumerate(values)}


def test_counts_of_another_kind_of_tokenizer(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    path = tokenizers.path("word_bpe_49k.json")
    values = ["A Little  text", None, "", "Día niño 中\n!"]
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame(spark, values), "text", path).collect()}
    assert got == {i: len(x) for i, x in enumerate(library_ids(path, values))}


def test_the_driver_holds_no_tokenizer(spark, tokenizer_file, monkeypatch):
    """The table of frequent pieces is learned in a task; the driver only passes it on."""
    values = ["day after day after day", "", None, "zwölf 中"]
    first = pieces.frequent_pieces(pieces.Encoder(tokenizer_file), pa.array([v for v in values if v is not None]), 100)

    driver, real = os.getpid(), pieces.Encoder.__init__

    def elsewhere(self, *a):
        assert os.getpid() != driver
        real(self, *a)

    df = frame(spark, values)
    expected = {i: len(x) for i, x in enumerate(library_ids(tokenizer_file, values))}
    monkeypatch.setattr(pieces.Encoder, "__init__", elsewhere)
    got = token_counts.first_tier(df, "text", tokenizer_file, 100).value
    assert all((a == b).all() for a, b in zip(got, first, strict=True))
    assert token_counts.first_tier(df.where("false"), "text", tokenizer_file).value is None
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, "text", tokenizer_file).collect()} == expected


def check_sequences(rows, limits):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for pieces in by.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces[:-1]]).tolist()
        assert sum(r.length for r in pieces) <= limits.max_tokens and len(pieces) <= limits.max_segments
    return by


def test_packing_keeps_every_id_once_with_little_padding(spark, tokenizer_file):
    values, limits = texts(), Limits()
    rows = packing.pack_texts(frame(spark, values).repartition(3), "doc_id", "text", tokenizer_file, end_id=1).collect()
    want = [[*x, 1] for x in library_ids(tokenizer_file, values)]
    held = {i: np.full(len(x), -1) for i, x in enumerate(want)}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and r.doc_tokens == len(want[r.doc_id])
        part = held[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and (part == -1).all()
        part[:] = ids
    assert all(held[i].tolist() == x for i, x in enumerate(want))
    by = check_sequences(rows, limits)
    lengths = [sum(r.length for r in p) for p in by.values()]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths)
    assert padding <= 0.02 * sum(lengths)


def test_packing_a_null_key_and_no_rows(spark, tokenizer_file):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    rows = packing.pack_texts(df, "doc_id", "text", tokenizer_file, end_id=1).collect()
    assert {r.doc_id for r in rows} == {None} and sum(r.length for r in rows) == 4
    assert {r.doc_tokens for r in rows} == {1, 3}
    assert packing.pack_texts(df.where("false"), "doc_id", "text", tokenizer_file, end_id=1).count() == 0
    assert packing.pack_texts(df.where("text is null"), "doc_id", "text", tokenizer_file, end_id=None).count() == 0


def test_crc_of_the_ids_column(spark, tokenizer_file):
    df = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    row = packing.pack_texts(df, "doc_id", "text", tokenizer_file, end_id=1).select("ids", F.crc32("ids").alias("c")).first()
    ids = np.array([*library_ids(tokenizer_file, ["some words here"])[0], 1], "<u4")
    assert row.c == zlib.crc32(ids.tobytes())


def test_examples_keep_all_limits(spark):
    draw = random.Random(5)
    limits = Limits(max_tokens=64, max_segments=4, max_loss=30, window=32, min_cut=4)
    examples = []
    for i in range(300):
        n = draw.randint(0, 150)
        examples.append((i, [draw.randint(0, 9) for _ in range(n)], [draw.random() < 0.5 for _ in range(n)]))
    examples += [(300, None, None), (301, [], [])]
    df = spark.createDataFrame(examples, "key long, ids array<long>, loss array<boolean>").repartition(2)
    rows = packing.pack_examples(df, "key", "ids", "loss", limits).collect()
    by = check_sequences(rows, limits)
    flags = {k: loss or [] for k, _, loss in examples}
    for pieces in by.values():
        assert sum(sum(flags[r.key][r.start : r.start + r.length]) for r in pieces) <= 30
    for k, ids, _ in examples:
        own = sorted((r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows if r.key == k)
        assert [x for _, part in own for x in part] == (ids or [])
        assert [s for s, _ in own] == np.cumsum([0] + [len(p) for _, p in own])[:-1].tolist()


def test_last_sequence_is_cut_at_powers_of_two():
    pieces = [packing.Piece("a", 0, np.arange(7), None, 7), packing.Piece("b", 0, np.arange(6), None, 6)]
    parts = list(packing.powers(pieces))
    assert [sum(len(p.ids) for p in part) for part in parts] == [8, 4, 1]
    assert [(p.key, p.start, len(p.ids)) for part in parts for p in part] == [("a", 0, 7), ("b", 0, 1), ("b", 1, 4), ("b", 5, 1)]
