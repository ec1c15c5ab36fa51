"""Arrays dealt by hash: many small records cross a shuffle as a few rows of packed arrays.

A task that has counted or asked for millions of hashes splits its arrays by ``part``, a range of the hash, and hands
Spark one row a part, which holds the arrays as bytes. Spark deals the rows by ``part``; the task that gets
a part reads them back as arrays. Parts are made as many as keep one of them small, and where
each row would hold a few records only, it simply does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_U = np.uint64


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each 64-bit hash, by its upper 32 bits."""
    return ((hashes >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)


def deal(part: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[list[bytes]]]:
    """The parts that have records, and by column the records of each as bytes."""
    if not (part[1:] >= part[:-1]).all():
        short = part.astype(np.uint16) if part.max() < 1 << 16 else part  # is sorted by its digits
        order = np.argsort(short, kind="stable")
        part, columns = part[order], [column[order] for column in columns]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    cuts = np.append(first, len(part)).tolist()
    packed = []
    for column in columns:
        packed.append([column[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])])
    return part[first], packed


def unpack(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x or b"", kind) for x in column.to_pylist()]


#: Bits of a map for each of its hashes, of which ``PROBES`` are set: about one hash in 10^6 passes without being held.
MARK_BITS = 32
PROBES = 10
MOST_MARK_BITS = 1 << 28
MARKED_AT_ONCE = 1 << 18
SEGMENT_BITS = 6  # upper bits of a hash that name the segment of the map that it is in


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ _U(0xA0761D6478BD642F)) * _U(0xE7037ED1A0B428DB)
    h ^= h >> _U(32)
    h *= _U(0x8EBC6AF09C88C6E3)
    return h ^ (h >> _U(29))


def _segment(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - SEGMENT_BITS)).astype(np.int64)


def mark_map(rows: DataFrame, column: str) -> np.ndarray:
    """Bit map of the 64-bit hashes in a column of a stored table, one row of bytes a segment, 32 MB at most; beyond
    about 10^7 hashes it grows denser and lets more pass, but misses none. It is drawn by segments in the tasks."""
    wanted = max(1 << 16, MARK_BITS * rows.count())
    size = min(MOST_MARK_BITS, 1 << (wanted - 1).bit_length()) >> SEGMENT_BITS

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(_U)
            segment, (packed,) = deal(_segment(hashes), [hashes])
            yield pa.RecordBatch.from_arrays([pa.array(segment, pa.int64()), pa.array(packed, pa.binary())], names=["segment", "hashes"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, hashes in zip(batch.column(0).to_pylist(), unpack(batch.column(1), _U)):
                own = held.setdefault(segment, np.zeros(size, bool))
                step = _mix(hashes)
                for k in range(PROBES):
                    own[_place(hashes, step, k, size)] = True
        if held:
            drawn = [np.packbits(x, bitorder="little").tobytes() for x in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(drawn, pa.binary())], names=["segment", "bits"])

    segments = 1 << SEGMENT_BITS
    out = np.zeros((segments, size // 8), np.uint8)
    dealt = rows.select(column).mapInArrow(place, "segment long, hashes binary").repartition(segments, "segment")
    for r in dealt.mapInArrow(draw, "segment long, bits binary").collect():
        out[r["segment"]] = np.frombuffer(r["bits"], np.uint8)
    return out


def _place(hashes: np.ndarray, step: np.ndarray, k: int, size: int) -> np.ndarray:
    return (hashes + _U(k) * (step | _U(1))) & _U(size - 1)


def marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be held by the map."""
    flat, width = marks.ravel(), 8 * marks.shape[1]
    shift = _U(width.bit_length() - 1)

    def set_at(own: np.ndarray, place: np.ndarray) -> np.ndarray:
        bit = (own >> _U(64 - SEGMENT_BITS) << shift) | place
        return (flat[(bit >> _U(3)).view(np.int64)] >> (bit & _U(7)).astype(np.uint8) & np.uint8(1)).view(bool)

    out = np.zeros(len(hashes), bool)
    for begin in range(0, len(hashes), MARKED_AT_ONCE):
        own = hashes[begin : begin + MARKED_AT_ONCE]
        near = np.flatnonzero(set_at(own, own & _U(width - 1)))
        own = own[near]
        step = _mix(own)
        for k in range(1, PROBES):
            found = set_at(own, _place(own, step, k, width))
            near, own, step = near[found], own[found], step[found]
        out[begin + near] = True
    return out
