"""Language identification by multinomial naive Bayes over hashed character n-grams.

Letters are folded to lower case, every run of other characters to one space; the 1-, 2- and
3-grams of what results are hashed to ``BUCKETS`` features. The log-probability matrix (features x
languages) is broadcast: its size is fixed by the number of languages. Batches are scored by
gathering the matrix rows of all n-grams and summing them by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratingloom.llm.text import bound_batches, slices, with_fields

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
TRAIN_TEXTS = 2_000  # of each language
MOST_LANGUAGES = 1_000
COUNTING_TASKS = 4
SMOOTHING = 0.5
MIN_SCORE = 0.5
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    table = np.full(0x110000, 0x20, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def grams(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature and text number of each n-gram; texts without a letter have none."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    starts = leads[offsets]
    text_of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(starts))
    letters = table[points]
    space = letters == 0x20
    again = np.zeros(len(space), bool)
    again[1:] = space[1:] & space[:-1] & (text_of[1:] == text_of[:-1])
    letters, text_of, space = letters[~again], text_of[~again], space[~again]
    features, owners = [], []
    for n in ORDERS:
        m = max(len(letters) - n + 1, 0)
        h = np.full(m, n, np.uint32)
        for k in range(n):
            h = (h ^ letters[k : k + m]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        one = ~space[:m] if n == 1 else text_of[:m] == text_of[n - 1 : n - 1 + m]
        features.append((h & np.uint32(BUCKETS - 1))[one])
        owners.append(text_of[:m][one])
    lettered = np.zeros(len(offsets) - 1, bool)
    lettered[text_of[~space]] = True
    keep = [lettered[o] for o in owners]
    return np.concatenate([f[k] for f, k in zip(features, keep)]), np.concatenate([o[k] for o, k in zip(owners, keep)])


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # log, by language
    weights: np.ndarray  # log-probabilities, languages x features


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Rows whose key, as text, has this remainder of its CRC-32; a null key has that of the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold


def fit(df: DataFrame, text: str, language: str, per_language: int = TRAIN_TEXTS) -> Model:
    """Learn from about ``per_language`` different texts of each non-null language, drawn by a hash of the text, so that
    copies of one text count once in the sample, however many there are.

    The class sizes are those of all rows. N-grams are counted in the tasks; one vector of
    ``BUCKETS`` counts for each task and language comes to the driver. Without labelled rows the
    model knows no language; more than ``MOST_LANGUAGES`` values are no languages, and are refused.
    """
    rows = bound_batches(df).select(df[f"`{text}`"].cast("string").alias("t"), df[f"`{language}`"].cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull())
    different = F.approx_count_distinct(F.xxhash64("t")).alias("different")
    found = rows.groupBy("lang").agg(F.count("*").alias("n"), different).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"column {language} holds more than {MOST_LANGUAGES} languages")
    sizes = {r["lang"]: r["n"] for r in found}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, BUCKETS)))
    share = F.lit(0.0)
    for r in found:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, per_language / max(1, r["different"])))).otherwise(share)
    drawn = F.pmod(F.xxhash64("t", "lang"), F.lit(1 << 30)) < share * (1 << 30)
    # few tasks, since each sends the driver a vector a language
    sample = rows.where(F.col("t").isNotNull() & drawn).distinct().repartition(COUNTING_TASKS)
    schema = "lang string, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = letter_table(), {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            for at, to, data, offsets in slices(batch.column(0)):
                feature, owner = grams(data, offsets, table)
                own = names[at:to]
                for name in set(own.tolist()):
                    mine = (own == name)[owner]
                    counts[name] = counts.get(name, 0) + np.bincount(feature[mine], minlength=BUCKETS)
        for name, vector in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([vector.astype("<i8").tobytes()])], names=["lang", "counts"])

    total = np.zeros((len(languages), BUCKETS))
    for r in sample.mapInArrow(count, schema).collect():
        total[languages.index(r["lang"])] += np.frombuffer(r["counts"], "<i8")
    total += SMOOTHING
    weights = np.log(total) - np.log(total.sum(axis=1, keepdims=True))
    seen = np.array([sizes[name] for name in languages], float)
    return Model(languages, np.log(seen / seen.sum()), weights.astype(np.float32))


def identify(df: DataFrame, text: str, model: Model) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (its posterior probability) for each whole text.

    A text that is null or has no letter is ``und`` with score 0, as is every text if the model knows
    no language; ties go to the first language in order. Rows and other columns stay as they
    are; columns of ``df`` called ``lang_pred`` or ``score`` are replaced.
    """
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    known = df.sparkSession.sparkContext.broadcast(model)

    def start():
        table, model = letter_table(), known.value

        def make(column: pa.Array) -> list:
            names, scores = [], []
            for at, to, data, offsets in slices(column):
                feature, owner = grams(data, offsets, table)
                found = np.zeros(to - at, bool)
                found[owner] = True
                if not model.languages:
                    found[:] = False
                total = np.empty((to - at, max(1, len(model.languages))))
                for k, weights in enumerate(model.weights):
                    total[:, k] = model.prior[k] + np.bincount(owner, weights[feature], to - at)
                best = total.argmax(axis=1) if model.languages else np.zeros(to - at, int)
                with np.errstate(all="ignore"):
                    top = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                names += [model.languages[b] if f else UNKNOWN for b, f in zip(best.tolist(), found.tolist())]
                scores += np.where(found, top, 0.0).tolist()
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return make

    return with_fields(df, text, fields, start)


def accepted(min_score: float = MIN_SCORE) -> Column:
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)
