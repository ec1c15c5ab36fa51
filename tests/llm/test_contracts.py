"""The registered queries on the smallest tables: columns, types, folds and what a plain computation gives."""

import collections
import math
import os
import struct
import zlib

import duckdb
import numpy as np
import pytest
from test_alignment import brute as brute_alignment
from test_spelling import brute_counts, brute_groups
from text_cases import brute_classes, plain_words

from ratingloom.llm.queries import QUERIES

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

KINDS = {
    "op1_nearest_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
    "op2_jaccard_join": "doc_id bigint, class_id bigint, copy_id bigint, n_links bigint",
    "op3_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op4_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op6_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op8_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op9_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op11_token_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    "op12_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}


def table(name, columns="*"):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def found(spark):
    held = {}

    def rows(name):
        if name not in held:
            df = QUERIES[name](spark, FOLDER)
            held[name] = df.dtypes, df.collect()
        kinds, out = held[name]
        for column in KINDS[name].split(", "):
            assert tuple(column.split(" ")) in kinds, (name, kinds)
        return out

    return rows


@pytest.fixture(scope="module")
def documents():
    return dict(table("documents", "doc_id, text"))


def fold(key, folds):
    return zlib.crc32(str(key).encode()) % folds


@pytest.mark.parametrize("name", sorted(KINDS))
def test_columns_and_one_row_a_document(found, documents, name):
    rows = found(name)
    if "doc_id" in KINDS[name] and name != "op5_packing":
        assert sorted(r.doc_id for r in rows) == sorted(documents)


def test_neighbours_are_nearly_the_true_ones(found):
    vectors = {i: np.array(v, float) for i, v in table("embeddings", "vec_id, embedding") if v is not None}
    usable = {i: v for i, v in vectors.items() if np.isfinite(v).all() and v.any()}
    lists = collections.defaultdict(list)
    for r in found("op1_nearest_neighbours"):
        assert r.vec_id != r.query_id and math.isclose(r.score, usable[r.query_id] @ usable[r.vec_id], rel_tol=1e-12)
        lists[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(lists) == {i for i in usable if i % 20 == 0}
    hits = 0
    for q, own in lists.items():
        true = sorted(((-(usable[q] @ v), i) for i, v in usable.items() if i != q))[:20]
        assert [x[0] for x in sorted(own)] == list(range(1, len(true) + 1))
        assert [x[1:] for x in sorted(own)] == sorted((x[1:] for x in own), key=lambda x: (-x[1], x[0]))
        hits += len({i for _, i in true} & {i for _, i, _ in own})
    assert hits >= 0.9 * sum(len(own) for own in lists.values())


def test_classes_are_those_of_all_pairs(found, documents):
    want = brute_classes(list(documents.items()))
    assert {r.doc_id: (r.class_id, r.n_links) for r in found("op2_jaccard_join")} == want


def test_folds(found):
    for name, folds, held in (("op3_lm_scoring", 7, 2), ("op4_toxicity", 5, 0), ("op9_language_id", 4, 2)):
        assert all(r.held_out == (fold(r.doc_id, folds) == held) for r in found(name))


def test_base_scores(found, documents):
    words = {k: plain_words(t, r"[^\x20\x09-\x0D]+") + [None] for k, t in documents.items()}
    count = collections.Counter(w for k, own in words.items() if fold(k, 7) != 2 for w in own)
    n, v = sum(count.values()), len(count)
    for r in found("op3_lm_scoring"):
        own = words[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(count[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r.score < 0


def test_toxicity_and_language_bounds(found):
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found("op4_toxicity"))
    learned = {lang for k, lang in table("documents", "doc_id, lang") if lang is not None and fold(k, 4) != 2}
    assert all(0 <= r.score <= 1 and r.lang_pred in learned | {"und"} for r in found("op9_language_id"))


def test_pieces_cover_every_document_once(found, documents, tokenizer_file):
    from tokenizers import Tokenizer

    keys = list(documents)
    encoded = Tokenizer.from_file(tokenizer_file).encode_batch([documents[k] or "" for k in keys], add_special_tokens=False)
    ids = {k: [*e.ids, 1] for k, e in zip(keys, encoded)}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in found("op5_packing"):
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(struct.pack(f"<{len(own)}I", *own)) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans, whole in ((pieces, {k: len(x) for k, x in ids.items()}), (sequences, None)):
        for k, own in spans.items():
            at = 0
            for start, length in sorted(own):
                assert start == at
                at += length
            assert at == whole[k] if whole else at <= 2048
    assert set(pieces) == set(ids)
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found("op6_token_counts")}
    assert counts == {k: (len((documents[k] or "").encode()), len(x) - 1, len(x) - 1 > 512) for k, x in ids.items()}


def test_pages(found):
    pages = dict(table("pages", "page_id, url"))
    rows = found("op8_html_extraction")
    assert {r.page_id: r.url for r in rows} == pages and len(rows) == len(pages)
    assert all(r.n_chars == len(r.text) and r.text == " ".join(r.text.split()) for r in rows)


def test_alignment(found, documents, tokenizer_file):
    import hashlib

    import public_tokenizers

    keys = sorted(documents)
    want = brute_alignment((tokenizer_file, public_tokenizers.path("piece_bpe_32k.model")), [documents[k] for k in keys])
    for r, own in zip(sorted(found("op11_token_alignment")), want):
        digest = hashlib.sha256(own[-1].encode()).hexdigest() if own[-1] else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (*own[:-1], digest), r.doc_id


def test_spelling(found, documents):
    assert {tuple(r) for r in found("op12_spelling_variants")} == brute_groups(brute_counts(documents.items()))
