"""Vector bin packing of examples into sequences under limits on tokens, segments and loss-bearing tokens.

Each task packs the examples of its own input partition, so nothing is shuffled, and a task that
is run again packs the same way. An example that is over a limit by itself is cut into pieces that
are full and a rest. One sequence is open at a time: of a window of pieces, the one that fits and
whose demand has the largest dot product with what is left of the limits (both as shares of the
limits) is placed next. When nothing fits, a piece is cut to fill the gap if that is long enough.
The last sequence of a task, which nothing is left to fill, is cut into sequences whose lengths
are powers of two, so that it needs no padding either.

Memory is bounded by the window: ``window`` pieces of at most ``max_tokens`` ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from ratingloom.llm.pieces import Encoder
from ratingloom.llm.text import bound_batches
from ratingloom.llm.token_counts import first_tier

OUTPUT_IDS = 1 << 20
ID_BITS = 33  # sequences of a task


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold, the pieces to choose from, and the shortest gap worth a cut."""

    max_tokens: int = 2048
    max_segments: int = 256
    max_loss: int = 2048
    window: int = 2048
    min_cut: int = 32


@dataclass
class Piece:
    key: object
    start: int
    ids: np.ndarray
    loss: np.ndarray | None  # None: every token bears loss
    total: int

    def demand(self) -> tuple[int, int, int]:
        return len(self.ids), 1, len(self.ids) if self.loss is None else int(self.loss.sum())

    def cut(self, n: int) -> tuple[Piece, Piece]:
        halves = [None, None] if self.loss is None else [self.loss[:n], self.loss[n:]]
        return (
            Piece(self.key, self.start, self.ids[:n], halves[0], self.total),
            Piece(self.key, self.start + n, self.ids[n:], halves[1], self.total),
        )

    def longest(self, tokens: int, loss: int) -> int:
        """Length of the longest head within both limits."""
        n = min(len(self.ids), tokens)
        return min(n, loss) if self.loss is None else int(np.searchsorted(np.cumsum(self.loss[:n]), loss, "right"))


class Packer:
    """Packs a stream of pieces; ``take`` and ``finish`` yield closed sequences as lists of pieces."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.full = np.array([limits.max_tokens, limits.max_segments, limits.max_loss], float)
        self.demand = np.zeros((limits.window, 3))
        self.held: list[Piece | None] = [None] * limits.window
        self.alive = np.zeros(limits.window, bool)
        self.free = list(range(limits.window))[::-1]

    def hold(self, piece: Piece) -> None:
        slot = self.free.pop()
        self.held[slot], self.alive[slot] = piece, True
        self.demand[slot] = piece.demand()

    def drop(self, slot: int) -> Piece:
        piece, self.held[slot], self.alive[slot] = self.held[slot], None, False
        self.free.append(slot)
        return piece

    def take(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids):
            n = piece.longest(self.limits.max_tokens, self.limits.max_loss)
            if n == 0:
                raise ValueError("a limit of a sequence is 0")
            if n == len(piece.ids) and n < self.limits.max_tokens:
                break
            head, piece = piece.cut(n)
            if n == self.limits.max_tokens:
                yield [head]
                continue
            if not self.free:
                yield self.fill()
            self.hold(head)
        if len(piece.ids):
            if not self.free:
                yield self.fill()
            self.hold(piece)

    def fill(self) -> list[Piece]:
        left, chosen = self.full.copy(), []
        while True:
            fits = self.alive & (self.demand <= left).all(axis=1)
            if not fits.any():
                break
            value = (self.demand / self.full) @ (left / self.full)
            slot = int(np.argmax(np.where(fits, value, -1.0)))
            left -= self.demand[slot]
            chosen.append(self.drop(slot))
        gap = int(min(left[0], left[2]))
        if gap >= self.limits.min_cut and left[1] >= 1 and self.alive.any():
            slot = int(np.argmax(np.where(self.alive, self.demand[:, 0], -1.0)))
            piece = self.held[slot]
            n = piece.longest(int(left[0]), int(left[2]))
            if n >= self.limits.min_cut:
                head, rest = self.drop(slot).cut(n)
                chosen.append(head)
                self.hold(rest)
        return chosen

    def finish(self) -> Iterator[list[Piece]]:
        while self.alive.any():
            sequence = self.fill()
            if self.alive.any():
                yield sequence
            else:
                yield from powers(sequence)


def powers(sequence: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces in order, dealt to sequences whose lengths are falling powers of two."""
    rest = sum(len(p.ids) for p in sequence)
    queue = sequence[::-1]
    while rest:
        room = size = 1 << (rest.bit_length() - 1)
        part = []
        while room:
            piece = queue.pop()
            if len(piece.ids) > room:
                piece, tail = piece.cut(room)
                queue.append(tail)
            part.append(piece)
            room -= len(piece.ids)
        rest -= size
        yield part


def _schema(df: DataFrame, key: str) -> T.StructType:
    long = lambda name: T.StructField(name, T.LongType())
    return T.StructType(
        [T.StructField(key, df.schema[key].dataType), long("start"), long("length"), T.StructField("ids", T.BinaryType())]
        + [long("doc_tokens"), long("sequence_id"), long("offset")]
    )


def _packed(pieces: Iterator[Piece], limits: Limits, schema: T.StructType, key_type: pa.DataType):
    """Batches of placed pieces, with the ids as little-endian 32-bit numbers."""
    packer = Packer(limits)
    first = TaskContext.get().partitionId() << ID_BITS
    rows, held, number = [], 0, 0

    def batch() -> pa.RecordBatch:
        types = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def closed() -> Iterator[list[Piece]]:
        for piece in pieces:
            yield from packer.take(piece)
        yield from packer.finish()

    for sequence in closed():
        offset = 0
        for p in sequence:
            rows.append((p.key, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), p.total, first + number, offset))
            offset += len(p.ids)
        number += 1
        held += offset
        if held >= OUTPUT_IDS:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def pack_texts(df: DataFrame, key: str, text: str, path: str, end_id: int | None, limits: Limits = Limits()) -> DataFrame:
    """Tokenise whole texts, add ``end_id`` to each, and pack them; all tokens bear loss.

    One row per piece: ``key``, start and length within its text's ids, ``ids`` (little-endian 32-bit
    numbers), ``doc_tokens`` (ids of the text with its end), ``sequence_id`` and ``offset`` there.
    Null is the empty text, whose only id is the end; without ``end_id`` it has no row. Null keys and
    repeated rows are packed like others. Other columns are not returned, so none can clash.
    """
    frequent = first_tier(df, text, path)
    schema = _schema(df, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, frequent.value)
        end = np.zeros(0, np.int32) if end_id is None else np.array([end_id], np.int32)
        key_type = []

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                key_type[:] = [batch.column(0).type]
                keys = batch.column(0).to_pylist()
                for at, to, sizes, ids in encoder.encode(batch.column(1), True):
                    stops = np.cumsum(sizes)
                    for i, a, b in zip(range(at, to), (stops - sizes).tolist(), stops.tolist()):
                        whole = np.concatenate([ids[a:b], end])
                        yield Piece(keys[i], 0, whole, None, len(whole))

        stream = pieces()
        head = next(stream, None)
        if head is not None:
            yield from _packed(_chain(head, stream), limits, schema, key_type[0])

    rows = bound_batches(df).select(df[f"`{key}`"], df[f"`{text}`"].cast("string").alias("__text"))
    return rows.mapInArrow(run, schema)


def pack_examples(df: DataFrame, key: str, ids: str, loss: str, limits: Limits = Limits()) -> DataFrame:
    """Pack tokenised instruction examples: ``ids`` and ``loss`` are arrays of numbers and of flags of the same
    length. Rows as of ``pack_texts``. Null or empty ids give no row; null flags bear no loss."""
    schema = _schema(df, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = []

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                key_type[:] = [batch.column(0).type]
                for name, numbers, flags in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    numbers = np.array(numbers or [], np.int64)
                    marked = np.array([bool(f) for f in (flags or [])], bool)
                    if len(marked) != len(numbers):
                        raise ValueError(f"example {name}: {len(numbers)} ids and {len(marked)} loss flags")
                    yield Piece(name, 0, numbers, marked, len(numbers))

        stream = pieces()
        head = next(stream, None)
        if head is not None:
            yield from _packed(_chain(head, stream), limits, schema, key_type[0])

    return bound_batches(df).select(*(df[f"`{c}`"] for c in (key, ids, loss))).mapInArrow(run, schema)


def _chain(head: Piece, rest: Iterator[Piece]) -> Iterator[Piece]:
    yield head
    yield from rest
