"""Alignment of the tokens of two tokenizers over the same bytes.

The first is byte-level (a tokenizers file), the second a sentencepiece model, which puts a space before a text; the
first reads the text with that space, so both cut the same bytes. In each batch, ``pandas.merge_asof`` finds for
each token's start the covering token of the other side; the bytes of a batch are numbered over all its texts, and
both sides cover the same texts from their first bytes on, so it is one of the same text. Both directions together are
all overlaps. Where tokens of both sides end at one byte, a group ends.

Overlaps are links between ids. Their counts over the corpus are partly summed in the tasks and shuffled by
pair of ids. A second pass aligns again and adds up, by document, the counts of its links: the ``HEAD_PAIRS`` most
frequent pairs are broadcast, what a document links beyond them is joined with the stored counts.

Every text is tokenised and aligned in one task, in slices of half a megabyte (a longer text is a slice of its own).
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ratingloom import staging
from ratingloom.llm.pieces import Encoder, SpaceEncoder, byte_letters
from ratingloom.llm.text import slices

HEAD_PAIRS = 1_000_000
HELD_PAIRS = 1 << 21
ROW_BITS = 33
SHIFT = np.int64(32)


class Vocabulary:
    """Bytes of each id, one after the other."""

    def __init__(self, tokens: list[bytes]):
        size = np.array([len(t) for t in tokens], np.int64)
        self.size = size
        self.begin = np.cumsum(size) - size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)


def byte_level_bytes(path: str) -> list[bytes]:
    """Bytes of the entries of a byte-level vocabulary by id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    entries = dict(spec["model"]["vocab"])
    out = [b""] * (max([*entries.values(), *(t["id"] for t in spec.get("added_tokens", []))], default=-1) + 1)
    for token, i in entries.items():
        out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else b""
    return out


def piece_bytes(model) -> list[bytes]:
    """Bytes of the pieces of a sentencepiece model by id: U+2581 is a space, <0xHH> a byte; control pieces have none."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            out.append(b"")
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


@dataclass
class Side:
    """Tokens of some texts in order: id, text number, first byte and byte after the last."""

    ids: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, words: Vocabulary, sizes: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> Side:
        length = words.size[ids]
        text = np.repeat(np.arange(len(sizes)), sizes)
        total = np.append(0, np.cumsum(length))
        first = np.append(0, np.cumsum(sizes))
        start = offsets[text] + total[:-1] - total[first[text]]
        return cls(ids, text, start, start + length)

    def keep(self, good: np.ndarray) -> Side:
        some = good[self.text]
        return Side(self.ids[some], self.text[some], self.start[some], self.end[some])

    def whole(self, words: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts are the joined bytes of their tokens."""
        n = len(offsets) - 1
        good = np.bincount(self.text, self.end - self.start, n) == np.diff(offsets)
        # a token of no bytes covers nothing
        good[self.text[self.end == self.start]] = False
        own = self.keep(good)
        length = own.end - own.start
        before = np.cumsum(length) - length
        place = np.arange(length.sum())
        if len(place) < len(data):
            data = data[np.repeat(own.start - before, length) + place]
        wrong = words.bytes[np.repeat(words.begin[own.ids] - before, length) + place] != data
        if wrong.any():
            good[np.repeat(own.text, length)[wrong]] = False
        return good

    def table(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"at": self.start, name: np.arange(len(self.ids))})


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of both sides, which cover the same texts, that share a byte, each pair once."""
    if not len(a.ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = a.table("a"), b.table("b")
    to_b = pd.merge_asof(left, right, on="at")["b"].to_numpy().astype(np.int64)
    to_a = pd.merge_asof(right, left, on="at")["a"].to_numpy().astype(np.int64)
    inside = a.start[to_a] != b.start  # equal starts were found from the other side
    return np.concatenate([np.arange(len(to_b)), to_a[inside]]), np.concatenate([to_b, np.flatnonzero(inside)])


def group_numbers(a: Side, b: Side, n_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each token of both sides, counted over all texts, and the text of each group."""
    ends_a, ends_b = np.zeros(n_bytes + 1, bool), np.zeros(n_bytes + 1, bool)
    ends_a[a.end], ends_b[b.end] = True, True
    both = ends_a & ends_b
    before = np.cumsum(both) - both
    text = a.text[both[a.end]]
    return before[a.end], before[b.end], text


@functools.cache
def _numbers(most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each number up to ``most`` its decimal digits, right-aligned in a row of fixed width with a place for a mark
    behind, which places of the row are shown, and how many."""
    wide = len(str(most))
    values = np.arange(most + 1)
    power = 10 ** np.arange(wide - 1, -1, -1)
    row = np.zeros((most + 1, wide + 1), np.uint8)
    row[:, :wide] = values[:, None] // power % 10 + 0x30
    size = np.maximum(1, wide - (values[:, None] < power).sum(1))
    return row, np.arange(wide + 1) >= (wide - size)[:, None], size + 1


def group_texts(a: Side, b: Side, group_a: np.ndarray, group_b: np.ndarray, n: int) -> pa.Array:
    """By text, its groups as ``a1,a2|b1;a3|b2,b3``."""
    total = len(a.ids) + len(b.ids)
    groups = int(group_a[-1]) + 1 if len(group_a) else 0
    count_a, count_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    before_a, before_b = np.cumsum(count_a) - count_a, np.cumsum(count_b)
    at_a = np.arange(len(a.ids)) + (before_b - count_b)[group_a]
    at_b = np.arange(len(b.ids)) + (before_a + count_a)[group_b]
    ids, text = np.empty(total, np.int64), np.empty(total, np.int64)
    mark = np.full(total, ord(","), np.uint8)
    ids[at_a], ids[at_b], text[at_a], text[at_b] = a.ids, b.ids, a.text, b.text
    last_a, last_b = at_a[np.cumsum(count_a) - 1], at_b[before_b - 1]
    mark[last_a], mark[last_b] = ord("|"), ord(";")
    rows, places, sizes = _numbers((1 << int(ids.max(initial=0)).bit_length()) - 1)
    row, shown, size = rows[ids], places[ids], sizes[ids]
    row[:, -1] = mark
    if total:
        last = np.flatnonzero(np.append(text[1:] != text[:-1], True))  # no mark after a text's last group
        shown[last, -1] = False
        size[last] -= 1
    ends = np.append(0, np.cumsum(size))[np.cumsum(np.bincount(text, minlength=n))]
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.append(0, ends)), pa.py_buffer(row[shown]))


def _aligned(path_a: str, path_b: str) -> Callable[[pa.Array], Iterator[tuple]]:
    """A function from a column of texts to, by slice: first row, row after the last, both sides' tokens, the links
    and the number of bytes."""
    first, second = Encoder(path_a, specials=False), SpaceEncoder(path_b)
    words_a, words_b = Vocabulary(byte_level_bytes(path_a)), Vocabulary(piece_bytes(second.library))

    def work(column: pa.Array):
        texts = pc.fill_null(column, "").cast(pa.large_string())
        spaced = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
        for (at, to, data, offsets), (*_, size_a, ids_a), (*_, size_b, ids_b) in zip(slices(spaced), first.encode(spaced, True), second.encode(spaced, True)):
            a, b = Side.of(words_a, size_a, ids_a.astype(np.int64), offsets), Side.of(words_b, size_b, ids_b.astype(np.int64), offsets)
            good = a.whole(words_a, data, offsets) & b.whole(words_b, data, offsets)
            if not good.all():
                a, b = a.keep(good), b.keep(good)
            yield at, to, a, b, overlaps(a, b), len(data)

    return work


def _codes(a: Side, b: Side, links: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return a.ids[links[0]] << SHIFT | b.ids[links[1]]


def pair_counts(df: DataFrame, text: str, path_a: str, path_b: str) -> DataFrame:
    """Stored ``code`` (first id * 2^32 + second id), ``c`` (links between the two ids in all texts) and ``best`` (whether
    no other pair of the second id has more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _aligned(path_a, path_b)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            code, which = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return code, np.bincount(which, np.concatenate([h[1] for h in held]), len(code)).astype(np.int64)

        def batch_of(code: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(count)], names=["code", "c"])

        for batch in batches:
            for _, _, a, b, links, _ in work(batch.column(0)):
                held.append(np.unique(_codes(a, b, links), return_counts=True))
                if sum(len(h[0]) for h in held) >= HELD_PAIRS:
                    held[:] = [merged()]
                    if len(held[0][0]) >= HELD_PAIRS // 2:
                        yield batch_of(*held.pop())
        if held:
            yield batch_of(*merged())

    texts = df.select(df[f"`{text}`"].cast("string").alias("t"))
    counts = staging.stage(texts.mapInArrow(run, "code long, c long").groupBy("code").agg(F.sum("c").alias("c")), "pairs")
    second = F.col("code").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(second.alias("b")).agg(F.max("c").alias("most"))  # a row an id of the second vocabulary
    return staging.stage(counts.withColumn("b", second).join(F.broadcast(most), "b").select("code", "c", (F.col("c") == F.col("most")).alias("best")), "counts")


def _least_of_head(counts: DataFrame, most: int) -> int:
    """The count above which pairs are broadcast, so that they are ``most`` at most; 0 if all are."""
    steps = counts.groupBy(F.ceil(F.log2("c") * 8).alias("step")).agg(F.count("*").alias("n"), F.max("c").alias("c")).collect()
    held = 0
    for _, n, c in sorted(steps, reverse=True):
        held += n
        if held > most:
            return c
    return 0


def align(
    df: DataFrame, key: str, text: str, path_a: str, path_b: str, shown: Callable[[Column], Column] = lambda groups: groups,
    head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_a`` and ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose
    count is the highest of their second id, ties included), ``count_sum`` (of the counts of all links) and ``groups``, the
    ids of each group as ``a1,a2|b1;a3|b2,b3`` (or what ``shown`` makes of them, which then is all that is stored).

    Null and empty texts, and texts that are not the joined bytes of the tokens of either side, have no tokens: zeros
    and an empty ``groups``. Special tokens' strings are plain text. Repeated rows are rows of their own and count
    as often. Other columns are not read. An empty table gives no rows.
    """
    counts = pair_counts(df, text, path_a, path_b)
    least = _least_of_head(counts, head_pairs)
    head = counts.where(F.col("c") > least).select("code", "c", "best").toArrow()
    order = np.argsort(head.column("code").to_numpy())
    known = df.sparkSession.sparkContext.broadcast(
        (head.column("code").to_numpy()[order], head.column("c").to_numpy()[order], head.column("best").to_numpy()[order])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _aligned(path_a, path_b)
        codes, count, best = known.value
        row = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            for at, to, a, b, links, n_bytes in work(batch.column(1)):
                n = to - at
                group_a, group_b, group_text = group_numbers(a, b, n_bytes)
                asked, which = np.unique(_codes(a, b, links), return_inverse=True)
                place = np.minimum(np.searchsorted(codes, asked), max(0, len(codes) - 1))
                hit = codes[place] == asked if len(codes) else np.zeros(len(asked), bool)
                c, top = np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
                c[hit], top[hit] = count[place[hit]], best[place[hit]]
                owner = a.text[links[0]]
                sums = np.zeros(n, np.int64)
                np.add.at(sums, owner, c[which])
                late = np.flatnonzero(~hit[which])
                late = late[np.argsort(owner[late], kind="stable")]
                cuts = np.append(0, np.cumsum(np.bincount(owner[late], minlength=n))).astype(np.int32)
                per_text = lambda who: pa.array(np.bincount(who, minlength=n).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)),
                        batch.column(0).slice(at, n),
                        per_text(a.text),
                        per_text(b.text),
                        per_text(group_text),
                        per_text(owner),
                        per_text(owner[top[which]]),
                        pa.array(sums),
                        group_texts(a, b, group_a, group_b, n),
                        pa.ListArray.from_arrays(cuts, pa.array(asked[which[late]])),
                    ],
                    names=["row", "id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "late"],
                )
                row += n

    kind = df.schema[key].dataType.simpleString()
    schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, late array<long>"
    texts = df.select(df[f"`{key}`"].alias("id"), df[f"`{text}`"].cast("string").alias("t"))
    parts = staging.stage(texts.mapInArrow(run, schema).withColumn("groups", shown(F.col("groups"))), "aligned")
    out = parts
    if least:
        late = parts.select("row", F.explode("late").alias("code")).groupBy("row", "code").agg(F.count("*").alias("times"))
        found = late.join(counts.where(F.col("c") <= least), "code")
        sums = found.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("late_best"), F.sum(F.col("times") * F.col("c")).alias("late_sum")
        )
        out = parts.join(sums, "row", "left")
        add = lambda name, more: (F.col(name) + F.coalesce(more, F.lit(0))).alias(name)
    else:
        add = lambda name, more: F.col(name)
    return out.select(
        F.col("id").alias(key), "n_a", "n_b", "n_groups", "n_links", add("n_best", "late_best"), add("count_sum", "late_sum"), "groups"
    )
