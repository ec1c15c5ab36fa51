"""Token counts by a two-tier lookup inside the map tasks; no pre-token is ever shuffled.

The first tier is a compact hash table of the ids of frequent pieces (``pieces.py``), built by a
task from a bounded sample of texts and broadcast; its size is ``FREQUENT`` entries at most. A
piece that it lacks goes to the worker's own table, and only what that lacks is encoded, each
distinct piece of a slice once. The sample decides speed alone: counts are exact for whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from ratingloom.llm.pieces import Encoder, frequent_pieces
from ratingloom.llm.text import with_fields

FREQUENT = 100_000
SAMPLE_TEXTS = 1_000
SAMPLE_TEXT_BYTES = 32_768


def first_tier(df: DataFrame, text: str, path: str, most: int = FREQUENT) -> Broadcast:
    """Broadcast table of the most frequent pieces of at most ``SAMPLE_TEXTS`` texts of moderate length. One task encodes
    them, so the driver never holds the tokenizer, only the table; its value is None where there is nothing to hold."""
    spark = df.sparkSession
    short = df.select(df[f"`{text}`"].cast("string").alias("t")).where(F.octet_length("t") <= SAMPLE_TEXT_BYTES)
    sample = short.limit(SAMPLE_TEXTS).collect()
    kinds = {"hashes": "<u8", "sizes": "<i8", "places": "<i8", "ids": "<i4"}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [batch.column(0) for batch in batches]
        found = frequent_pieces(Encoder(path), pa.concat_arrays(texts), most) if texts else None
        if found is not None:
            parts = [pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in zip(found, kinds.values())]
            yield pa.RecordBatch.from_arrays(parts, names=list(kinds))

    frequent = None
    if sample:
        schema = ", ".join(f"{name} binary" for name in kinds)
        for r in spark.createDataFrame(sample, "t string").coalesce(1).mapInArrow(learn, schema).collect():
            frequent = tuple(np.frombuffer(r[name], kind) for name, kind in kinds.items())
    return spark.sparkContext.broadcast(frequent)


class SentencePieces:
    """Counts by a sentencepiece model; its pieces depend on whole texts, so there is no table."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, column: pa.Array) -> list[int]:
        return [len(self.model.encode(t or "")) for t in column.to_pylist()]


def count_tokens(df: DataFrame, text: str, path: str, name: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of the whole column ``text``, as the library of the file ``path``
    counts them (tokenizers for .json, sentencepiece for .model; no begin, end or added special tokens).

    Null counts as the empty text, which has no tokens. Every row is kept, repeated rows too. A
    column of ``df`` called ``name`` is replaced. An empty table gives an empty table.
    """
    field = [T.StructField(name, T.LongType())]
    if str(path).endswith(".model"):

        def start_model():
            model = SentencePieces(path)
            return lambda column: [pa.array(model.counts(column), pa.int64())]

        return with_fields(df, text, field, start_model)
    frequent = first_tier(df, text, path)

    def start():
        encoder = Encoder(path, frequent.value)

        def make(column: pa.Array) -> list:
            return [pa.array([n for _, _, sizes, _ in encoder.encode(column, False) for n in sizes.tolist()], pa.int64())]

        return make

    return with_fields(df, text, field, start)
