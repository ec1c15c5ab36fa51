"""Vectorised text kernels over Arrow columns, and helpers that run them inside Spark tasks.

A column of texts is seen as one byte array and the offsets of its texts. Words are found by a
table over byte values and hashed by differences of a running polynomial, so no Python code runs
per word. Long columns are cut at text borders into slices of half a megabyte, which bounds the
memory of a task whatever the size of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

SLICE_BYTES = 1 << 19
BATCH_ROWS = 1_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_STEP = _U(0xD6E8FEB86659FD93)


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def _word_table() -> np.ndarray:
    """Digits, lower-case letters and all bytes of characters beyond ASCII."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table


LOWER = _lower_table()
SPACE = _space_table()
ALNUM = _word_table()
NOT_SPACE = ~SPACE


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts with about ``limit`` bytes at most (a longer text is a run of its own):
    first row, row after the last, bytes, offsets from 0."""
    data, offsets = flat(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, _U(base))
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[:] = tables
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    sums = total[1:]
    np.add(data, _U(1), out=sums, dtype=_U)
    np.multiply(sums, power[: len(data)], out=sums)
    np.cumsum(sums, out=sums)
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(_U) * _STEP)


def word_spans(low: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word: a longest run of bytes that ``table`` accepts."""
    return run_spans(table[low], offsets)


def run_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each longest run of marked bytes within a text."""
    n = len(inside)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def windows(words: np.ndarray, text_of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words within a text, and the number of each one's first word."""
    if len(words) < n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    m = len(words) - n + 1
    h = np.zeros(m, _U)
    for k in range(n):
        h = h * _STEP + words[k : k + m]
    first = np.flatnonzero(text_of[:m] == text_of[n - 1 :])
    return mix(h[first] + _U(n)), first


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    while name in df.columns:
        name = f"_{name}"
    return name


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends at most ``BATCH_ROWS`` rows to Python at once unless it is set otherwise:
    rows hold whole texts, and Spark's default of 10,000 rows is meant for short ones."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))
    return df


def with_fields(
    df: DataFrame, column: str, fields: list[T.StructField], start: Callable[[], Callable[[pa.Array], list]]
) -> DataFrame:
    """``df`` with new columns computed from the text ``column`` in Python, without a shuffle.

    ``start`` runs once per task and returns the function from a string column to the arrays of
    the new fields. Columns of ``df`` that carry a new field's name are replaced.
    """
    new = {f.name for f in fields}
    kept = [c for c in df.columns if c not in new]
    schema = T.StructType([f for f in df.schema.fields if f.name in kept] + fields)
    text = df[f"`{column}`"].cast("string").alias(free_name(df, "text"))
    carried = bound_batches(df).select(*(df[f"`{c}`"] for c in kept), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            if batch.num_rows:
                arrays = [batch.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(arrays + make(batch.column(len(kept))), names=schema.names)
        pa.default_memory_pool().release_unused()

    return carried.mapInArrow(run, schema)
