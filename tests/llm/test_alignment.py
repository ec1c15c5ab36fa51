"""Token alignment against the two libraries and plain interval overlaps."""

import collections
import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import alignment, pieces

ALPHABET = [" ", "  ", "   ", "\n", "\t", "\r\n", "a", "bc", "'s", "é", "1", "²", "!", "<|endoftext|>", "<s>", "</s>", "<0x41>", "中", "…", "　", "🙂", "the", "\x00", "ing", "Ü"]


@pytest.fixture(scope="module")
def files():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")


def texts():
    draw = random.Random(11)
    odd = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(1, 14))) for _ in range(700)]
    long = " ".join("".join(draw.choice("abcdeéo") for _ in range(draw.randint(1, 9))) for _ in range(6000))
    return odd + [None, "", " ", "   ", "x" * 3000, "a▁b", "▁", " ▁ ", "end ", "end  ", long, "same text", "same text"]


def brute(files, values):
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(files[0]), sentencepiece.SentencePieceProcessor(model_file=files[1])
    first.encode_special_tokens = True
    with open(files[0], encoding="utf-8") as f:
        entries = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    letters = pieces.byte_letters()

    def spans(tokens):
        out, at = [], 0
        for i, raw in tokens:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out, b"".join(raw for _, raw in tokens)

    def piece(i):
        return bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()

    linked, rows = collections.Counter(), []
    for value in values:
        want = (" " + (value or "")).encode()
        a, joined_a = spans([(i, bytes(letters[c] for c in entries[i])) for i in first.encode(" " + (value or ""), add_special_tokens=False).ids])
        b, joined_b = spans([(i, piece(i)) for i in second.encode(value or "")])
        if not value or joined_a != want or joined_b != want:
            rows.append(([], [], [], ""))
            continue
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 3000 else sweep(a, b)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        side = collections.defaultdict(lambda: ([], []))
        for k, tokens in enumerate((a, b)):
            for e, i in ends_of(tokens, ends):
                side[e][k].append(str(i))
        groups = [",".join(side[e][0]) + "|" + ",".join(side[e][1]) for e in ends]
        linked.update(links)
        rows.append((a, b, links, ";".join(groups)))
    top = collections.defaultdict(int)
    for (_, y), c in linked.items():
        top[y] = max(top[y], c)
    out = []
    for a, b, links, groups in rows:
        best = sum(linked[p] == top[p[1]] for p in links)
        out.append((len(a), len(b), groups.count("|") if groups else 0, len(links), best, sum(linked[p] for p in links), groups))
    return out


def sweep(a, b):
    out, k = [], 0
    for x in a:
        while b[k][2] <= x[1]:
            k += 1
        j = k
        while j < len(b) and b[j][1] < x[2]:
            out.append((x[0], b[j][0]))
            j += 1
    return out


def ends_of(tokens, ends):
    out, k = [], 0
    for x in tokens:
        while ends[k] < x[2]:
            k += 1
        out.append((ends[k], x[0]))
    return out


def aligned(spark, files, values, **kwargs):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(values)], "doc_id long, text string, groups string, row int")
    found = alignment.align(df, "doc_id", "text", *files, **kwargs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return [tuple(r)[1:] for r in found.orderBy("doc_id").collect()]


def test_links_and_groups_are_those_of_the_libraries(spark, files):
    values = texts()
    want = brute(files, values)
    assert aligned(spark, files, values) == want
    # with few pairs in the broadcast, or none, the rest is joined
    assert aligned(spark, files, values, head_pairs=50) == want
    assert aligned(spark, files, values, head_pairs=0) == want


def test_digest_and_empty_table(spark, files):
    df = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id long, text string")
    digest = lambda g: F.when(g != "", F.sha2(g, 256)).otherwise("")
    got = {r.doc_id: r.groups for r in alignment.align(df, "doc_id", "text", *files, digest).collect()}
    assert got == {1: hashlib.sha256(brute(files, ["some words here"])[0][-1].encode()).hexdigest(), 2: ""}
    assert alignment.align(df.where("doc_id < 0"), "doc_id", "text", *files).count() == 0


def test_digits_of_ids_come_from_a_table_and_links_from_starts_alone():
    ids = np.array([0, 9, 10, 99, 100, 1023, 1022, 7])
    side = lambda ids, starts, ends: alignment.Side(ids, np.repeat([0, 2], len(ids) // 2), np.array(starts), np.array(ends))
    a = side(ids, range(0, 16, 2), range(2, 17, 2))
    b = side(ids[::-2], [0, 4, 8, 12], [4, 8, 12, 16])
    assert list(a.table("a").columns) == ["at", "a"]
    left, right = alignment.overlaps(a, b)
    assert sorted(zip(left.tolist(), right.tolist())) == [(i, i // 2) for i in range(8)]
    group_a, group_b, _ = alignment.group_numbers(a, b, 16)
    before = alignment._numbers.cache_info().misses
    for _ in range(3):
        shown = alignment.group_texts(a, b, group_a, group_b, 3).to_pylist()
        assert shown == ["0,9|7;10,99|1023", "", "100,1023|99;1022,7|9"]
    assert alignment._numbers.cache_info().misses <= before + 1


def test_segments_are_cut_only_where_the_model_never_joins(files):
    import sentencepiece

    encoder, model = pieces.SpaceEncoder(files[1]), sentencepiece.SentencePieceProcessor(model_file=files[1])
    assert encoder.by_pieces
    values = [v for v in texts() if v and "▁" not in v]
    for by_pieces in (True, False):
        encoder.by_pieces = by_pieces
        found = []
        for _, _, sizes, ids in encoder.encode(pa.array([" " + v for v in values]), True):
            found += [x.tolist() for x in np.split(ids, sizes.cumsum()[:-1])]
        assert found == model.encode(values)
