"""Grouping of spelling variants: words one edit apart, found by blocked products of letter counts.

Words are runs of Latin letters, counted over all texts with partial counts in the tasks. One inserted, deleted
or replaced letter changes the letter counts of a word by a squared distance of one or two, so of two words
only those at most two apart are compared letter by letter.

Blocks. The letters are dealt to ``CLASSES`` classes of like weight. A word's cell is the number of its letters
in each class, and with their sum its length. A neighbour stands in the same cell, in one with a letter more in
one class (the adjacent length), or in one with a letter more in one class and less in another. A cell of more than
``BLOCK_WORDS`` words is split, so a block is bounded, and every pair of words one edit apart meets in one block:
each word stands in its own block, and is sent once to every block of the cells before its own.

Within a block, the Gram matrix of letter counts gives all squared distances, in chunks of bounded size. Of the
verified pairs a task returns by word the number of near words and the best of them; pairs are never written.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ratingloom import staging
from ratingloom.llm.text import LOWER, run_spans, slices, spans_hash

LEAST_CHARS = 5
LEAST_COUNT = 3
RATIO = 2
CLASSES = 5
BLOCK_WORDS = 4096
CHUNK_WORDS = 8192
CHUNK_LETTERS = 1 << 22
GRAM_ROWS = 512
HELD_WORDS = 1 << 20
LONG_RUN = 64  # bytes from which a run's checksum is made on its own
EXACT_LENGTH = 2048  # squared norms below 2^22 are exact in single precision


def _checksum_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


CHECKSUM = _checksum_table()
#: Columns of letter counts: a-z and U+00C0 to U+00FF have their own, other code points share these (a shared
#: column only brings words nearer); the last one takes the padding.
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)])
COLUMN = np.arange(256) % len(LETTERS)
COLUMN[LETTERS] = np.arange(len(LETTERS))
COLUMN[0] = len(LETTERS)


def latin_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text in lower-case A-Z, and start, end and text number of each run of [A-Za-z] and U+00C0 to U+00FF, whose
    first byte is 0xC3."""
    low = LOWER[data]
    lead = low == 0xC3
    inside = (low >= 0x61) & (low <= 0x7A) | lead
    inside[1:] |= lead[:-1]
    return low, *run_spans(inside, offsets)


def checksums(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each span, carried on from the checksum ``before`` it; all spans go byte by byte together."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    begin, size = starts[order], size[order]
    state = before[order] ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-size, -LONG_RUN, "right"))
    for i in range(long):
        state[i] = zlib.crc32(low[begin[i] : begin[i] + size[i]].tobytes(), int(before[order[i]])) ^ 0xFFFFFFFF
    for k in range(int(size[long]) if long < len(size) else 0):
        to = int(np.searchsorted(-size, -k, "left"))
        own = state[long:to]
        state[long:to] = CHECKSUM[(own ^ low[begin[long:to] + k]) & np.uint32(0xFF)] ^ (own >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def word_counts(df: DataFrame, text: str, key: str | None = None, damage: int = 0, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, for words of at least ``least_chars`` code points.

    Null texts have no words. With ``damage``, a run of the row with id ``key`` (null: the empty string) loses the
    code point h % length if ``damage`` divides h, the CRC-32 of "key:run"; this plants errors for measurements.
    """
    name = F.coalesce(df[f"`{key}`"].cast("string"), F.lit("")) if key else F.lit("")
    rows = df.select(name.alias("k"), df[f"`{text}`"].cast("string").alias("t"))

    def one_slice(names: list[str], data: np.ndarray, offsets: np.ndarray):
        """Different words of a slice, their hashes and counts; and counts of damaged words."""
        low, starts, ends, text_of = latin_runs(data, offsets)
        inner = np.zeros(len(low) + 1, np.int64)
        np.cumsum((low & 0xC0) == 0x80, out=inner[1:])
        chars = (ends - starts) - (inner[ends] - inner[starts])
        enough = chars >= least_chars
        starts, ends, text_of, chars = starts[enough], ends[enough], text_of[enough], chars[enough]
        damaged: Counter[str] = Counter()
        if damage and len(starts):
            before = np.array([zlib.crc32(f"{n}:".encode()) for n in names], np.uint32)
            h = checksums(low, starts, ends, before[text_of])
            hit = h % np.uint32(damage) == 0
            for a, b, i in zip(starts[hit].tolist(), ends[hit].tolist(), (h[hit] % chars[hit]).tolist()):
                run = low[a:b].tobytes().decode()
                damaged[run[:i] + run[i + 1 :]] += 1
            starts, ends = starts[~hit], ends[~hit]
        hashes, first, count = np.unique(spans_hash(low, starts, ends), return_index=True, return_counts=True)
        size = ends[first] - starts[first]
        to = np.cumsum(size)
        letters = low[np.repeat(starts[first] - (to - size), size) + np.arange(to[-1] if len(to) else 0)]
        words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(np.append(0, to).astype(np.int64)), pa.py_buffer(letters))
        return hashes, count, words, damaged

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        typos: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            if held:
                _, first, which = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
                count = np.bincount(which, np.concatenate([h[1] for h in held]), len(first)).astype(np.int64)
                words = pa.concat_arrays([h[2] for h in held]).take(pa.array(first))
            else:
                words, count = pa.array([], pa.large_string()), np.zeros(0, np.int64)
            other = [w for w in typos if len(w) >= least_chars]
            words = pa.concat_arrays([words, pa.array(other, pa.large_string())]).cast(pa.string())
            count = np.append(count, np.array([typos[w] for w in other], np.int64))
            held.clear()
            typos.clear()
            return pa.RecordBatch.from_arrays([words, pa.array(count)], names=["word", "n"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for at, to, data, offsets in slices(batch.column(1)):
                *found, more = one_slice(names[at:to], data, offsets)
                held.append(tuple(found))
                typos.update(more)
                if sum(len(h[0]) for h in held) >= HELD_WORDS:
                    yield counted()
        if held or typos:
            yield counted()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def codes_of(words: pa.Array) -> np.ndarray:
    """Code points by row, padded with zeros."""
    found = np.array(words.to_pylist(), dtype=np.str_)
    return found.view(np.uint32).reshape(len(found), -1) if found.dtype.itemsize else np.zeros((len(found), 1), np.uint32)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    wide = len(LETTERS) + 1
    column = np.where(codes < 256, COLUMN[np.minimum(codes, 255)], codes % len(LETTERS))
    at = column + np.arange(len(codes))[:, None] * wide
    return np.bincount(at.ravel(), minlength=len(codes) * wide).reshape(len(codes), wide)[:, :-1]


def _letter_classes(words: DataFrame) -> np.ndarray:
    """Class of each letter: by falling number of occurrences, dealt forth and back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(LETTERS), np.int64)
        for batch in batches:
            if batch.num_rows:
                total += letter_counts(codes_of(batch.column(0))).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["letter", "n"])

    counted = words.select("word").mapInArrow(run, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    total = np.zeros(len(LETTERS), np.int64)
    for r in counted.collect():  # a row a letter
        total[r["letter"]] = r["n"]
    rank = np.empty(len(LETTERS), np.int64)
    rank[np.argsort(-total, kind="stable")] = np.arange(len(LETTERS))
    turn, place = np.divmod(rank, CLASSES)
    return np.where(turn % 2 == 0, place, CLASSES - 1 - place)


def _with_cells(words: DataFrame) -> DataFrame:
    """``words`` with the number of letters in each class."""
    classes = _letter_classes(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = (classes[:, None] == np.arange(CLASSES)).astype(np.int64)
        for batch in batches:
            if batch.num_rows:
                counts = (letter_counts(codes_of(batch.column(0))) @ one).astype(np.int32)
                cuts = pa.array(np.arange(0, CLASSES * len(counts) + 1, CLASSES), pa.int32())
                cells = pa.ListArray.from_arrays(cuts, pa.array(counts.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=["word", "n", "counts"])

    return staging.stage(words.select("word", "n").mapInArrow(run, "word string, n long, counts array<int>"), "cells")


def _steps_before() -> list[list[int]]:
    """From a word's cell to the others it is compared with: a letter less in one class, or also one more in a later one."""
    unit = lambda i: [int(k == i) for k in range(CLASSES)]
    less = [[-x for x in unit(i)] for i in range(CLASSES)]
    moved = [[b - a for a, b in zip(unit(i), unit(j))] for i in range(CLASSES) for j in range(i + 1, CLASSES)]
    return less + moved


def _blocks(words: DataFrame) -> DataFrame:
    """Rows of all blocks: ``cell``, ``part``, ``right`` (whether the word is only compared with those of the block), word, n."""
    celled = _with_cells(words)
    counts = F.col("counts")
    chars = F.aggregate(counts, F.lit(0), lambda a, x: a + x)
    own = celled.select(F.xxhash64(counts).alias("cell"), "word", "n", "counts")
    # longer words are wider rows, so fewer make a block
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(CHUNK_LETTERS) / F.max(chars))))
    sizes = celled.groupBy(F.xxhash64(counts).alias("cell")).agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    sizes = staging.broadcast_if_small(staging.stage(sizes, "blocks"), staging.BROADCAST_ROWS // 4)
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    placed = own.join(sizes, "cell").select("cell", "word", "n", "counts", part.alias("part"), "parts")
    left = placed.select("cell", "part", F.lit(False).alias("right"), "word", "n")
    later = placed.where("part + 1 < parts").select("cell", F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1)).alias("part"), F.lit(True).alias("right"), "word", "n")
    steps = F.array(*(F.array(*(F.lit(x) for x in step)) for step in _steps_before()))
    goals = F.transform(steps, lambda step: F.xxhash64(F.zip_with(counts, step, lambda a, b: a + b)))
    sent = own.select(F.explode(goals).alias("cell"), "word", "n").join(sizes, "cell")
    sent = sent.select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("right"), "word", "n")
    return left.union(later).union(sent)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of ``a`` and the same row of ``b``, as long or one longer, differ by one edit."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    length = a.shape[1]
    head, tail = a == b[:, :length], (a == b[:, 1:])[:, ::-1]
    run = lambda same: np.where(same.all(1), length, same.argmin(1))
    return run(head) + run(tail) >= length


def near_pairs(left: np.ndarray, right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows of ``left`` and ``right`` (None: of ``left`` and later rows of it) that are one edit apart.
    Rows hold code points, those of ``right`` as many or one more."""
    exact = np.float32 if left.shape[1] < EXACT_LENGTH else np.float64
    a = letter_counts(left).astype(exact)
    b = a if right is None else letter_counts(right).astype(exact)
    other = left if right is None else right
    a_norm, b_norm = (a * a).sum(1), (b * b).sum(1)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    step = max(1, CHUNK_LETTERS // left.shape[1])
    for at in range(0, len(a), GRAM_ROWS):
        distance = a[at : at + GRAM_ROWS] @ b.T
        distance *= -2
        distance += a_norm[at : at + GRAM_ROWS, None]
        distance += b_norm
        i, j = np.nonzero(distance < 2.5)
        i += at
        if right is None:
            i, j = i[j > i], j[j > i]
        for k in range(0, len(i), step):
            x, y = i[k : k + step], j[k : k + step]
            same = _one_edit(left[x], other[y])
            found.append((x[same], y[same]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _best(words: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """By word of a pair: its near words of these pairs, and the one of largest n, ties by code points."""
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(words, kind="stable")] = np.arange(len(words))
    word, other = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((rank[other], -n[other], word))
    word, other = word[order], other[order]
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
    near = np.diff(np.append(first, len(word)))
    columns = [words[word[first]].tolist(), near, n[other[first]], words[other[first]].tolist()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "near", "best_n", "best"])


def _rows(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = words.view(np.uint32).reshape(len(words), -1)
    return codes, (codes > 0).sum(1)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the words of each block; rows come block by block, its own words first."""
    block: tuple[int, int] | None = None
    left = np.zeros(0, np.str_)
    left_n = np.zeros(0, np.int64)
    begun = False  # whether the block's own words are complete
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def compared(words: np.ndarray, n: np.ndarray, own: bool) -> Iterator[pa.RecordBatch]:
        codes, size = _rows(left)
        length = int(size.max())
        both, counts = (left, left_n) if own else (np.concatenate([left, words]), np.concatenate([left_n, n]))
        pairs = []
        if own:
            pairs.append(near_pairs(codes[:, :length], None))
        else:
            right, right_size = _rows(words)
            for more in (0, 1):
                rows = np.flatnonzero(right_size == length + more)
                if len(rows):
                    i, j = near_pairs(codes[:, :length], right[rows, : length + more])
                    pairs.append((i, len(left) + rows[j]))
        i, j = np.concatenate([p[0] for p in pairs or [(np.zeros(0, np.int64),) * 2]]), np.concatenate([p[1] for p in pairs or [(np.zeros(0, np.int64),) * 2]])
        if len(i):
            yield _best(both, counts, i, j)

    def flush(own: bool) -> Iterator[pa.RecordBatch]:
        nonlocal left, left_n
        if not held:
            return
        words, n = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        held.clear()
        if own:
            left, left_n = words, n
            yield from compared(left, left_n, True)
        elif len(left):
            yield from compared(words, n, False)

    for batch in batches:
        if not batch.num_rows:
            continue
        cell, part, n = (batch.column(i).to_numpy() for i in (0, 1, 4))
        right = batch.column(2).to_numpy(zero_copy_only=False)
        new = np.append(True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (right[1:] != right[:-1]))
        cuts = np.append(np.flatnonzero(new), batch.num_rows)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if block != (cell[a], part[a]):
                yield from flush(not begun)
                block, begun, left = (cell[a], part[a]), False, left[:0]
            if right[a] and not begun:
                yield from flush(True)
                begun = True
            at = a
            while at < b:
                to = b
                if right[a]:  # a block's own words are bounded, what it is compared with goes in chunks
                    to = min(b, at + max(1, CHUNK_WORDS - sum(len(h[0]) for h in held)))
                words = np.array(batch.column(3).slice(at, to - at).to_pylist(), dtype=np.str_)
                held.append((words, n[at:to]))
                if right[a] and (sum(len(h[0]) for h in held) >= CHUNK_WORDS or sum(h[0].nbytes for h in held) >= 4 * CHUNK_LETTERS):
                    yield from flush(False)
                at = to
    yield from flush(not begun)


def _forms(words: DataFrame, ratio: int) -> DataFrame:
    """Stored words with ``n_near``, and ``form`` and ``form_n`` of those that have one."""
    blocks = _blocks(words).repartition("cell", "part").sortWithinPartitions("cell", "part", "right")
    found = blocks.mapInArrow(_compare, "word string, near long, best_n long, best string")
    best = found.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("b")
    )
    likely = -F.col("b.less") >= ratio * F.col("n")
    joined = words.join(best, "word", "left")
    return staging.stage(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(likely, F.col("b.best")).alias("form"),
            F.when(likely, -F.col("b.less")).alias("form_n"),
        ),
        "forms",
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words that have a form; each round doubles the length of the ways followed.
    The counts grow along a way, so it ends."""
    links = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = staging.stage(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        if links.where("further IS NOT NULL").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def group_spellings(words: DataFrame, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """By ``word`` of a table of distinct words and their counts ``n``: ``form``, the near word (one inserted, deleted
    or replaced code point) of largest n if that is ``ratio`` times the word's n at least, ties to the smaller in
    code-point order; ``root``, where the forms lead, the word itself without one; ``n``, ``n_near`` and ``form_n``.

    Rows with a null or empty word, and words of smaller n than ``least_count``, take no part. Other columns are
    not read. An empty table gives no rows.
    """
    kept = staging.stage(words.where("word <> ''").where(F.col("n") >= least_count).select("word", F.col("n").cast("long").alias("n")), "words")
    forms = _forms(kept, ratio)
    out = forms.join(_roots(forms), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
