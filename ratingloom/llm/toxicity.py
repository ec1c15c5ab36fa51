"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a sample of all texts is unlabelled and holds hidden toxic
ones in the share of the class prior. Linear classifiers in numpy minimise the estimator

    prior * loss of positives as positive + max(0, loss of unlabelled as negative - prior * loss of positives as negative)

with logistic loss; where the second term falls below zero in a batch, its gradient is turned, as
the non-negative estimator asks. Features are the distinct words of a text and their first letters
(``HEADS``), hashed; those are kept that stand in significantly more of the positive texts than of the
unlabelled ones. Where the labels confirm harmless texts too, the scores of each classifier are put to scale by
those and the positives: what the estimator makes of hidden positives follows the share it is told, and where the
unlabelled sample holds more of them than that, scores of toxic texts stay below one half. All samples are
bounded, drawn by a hash, and go to the driver as features; scoring covers whole texts in the tasks, with the weights broadcast (fixed size).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratingloom import staging
from ratingloom.llm.text import LOWER, bound_batches, slices, spans_hash, with_fields, word_spans

FEATURE_BITS = 18
HEADS = (4, 5, 6)  # bytes
POSITIVES = 6_000
HARMLESS = 6_000
UNLABELLED = 8_000
SAMPLE_BYTES = 64 << 20  # of each sample's features, on the driver
MODELS = 3
EPOCHS = 120
BATCH = 4_096  # of unlabelled rows
SHARE = 2_048  # of positive rows in a batch
RATE = 0.1
DECAY = 3e-2
PIECE = 256  # rows at a time
LEAST_TEXTS, LEAST_RATIO, LEAST_Z = 4, 2.0, 4.0

LETTERS = np.zeros(256, bool)
LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature and text number of each word and each head of a word that is longer."""
    low = LOWER[data]
    starts, ends, text_of = word_spans(low, offsets, LETTERS)
    mask = np.uint64((1 << FEATURE_BITS) - 1)
    found, owners = [(spans_hash(low, starts, ends) & mask)], [text_of]
    for n in HEADS:
        long = ends - starts > n
        hashes = spans_hash(low, starts[long], starts[long] + n) ^ np.uint64(n * 0x51ED27)
        found.append(hashes & mask)
        owners.append(text_of[long])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


@dataclass
class Model:
    weights: np.ndarray  # models x features
    bias: np.ndarray  # by model


@dataclass
class Rows:
    """Sparse rows of zeros and ones: columns of all rows in order, and where each row ends."""

    columns: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.ends)

    def only(self, columns: np.ndarray) -> Rows:
        """The rows with these (sorted) columns alone, numbered anew."""
        number = np.full(1 << FEATURE_BITS, -1, np.int32)
        number[columns] = np.arange(len(columns))
        place = number[self.columns]
        return Rows(place[place >= 0], np.append(0, np.cumsum(place >= 0, dtype=np.int32))[self.ends])

    def counts(self) -> np.ndarray:
        """Rows with each column, counted in pieces to save memory."""
        total = np.zeros(1 << FEATURE_BITS, np.int64)
        for at in range(0, len(self.columns), 1 << 20):
            total += np.bincount(self.columns[at : at + (1 << 20)], minlength=len(total))
        return total

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns of some rows, and which of those rows each belongs to."""
        begins = np.append(0, self.ends[:-1])[rows]
        size = self.ends[rows] - begins
        which = np.repeat(np.arange(len(rows)), size)
        return self.columns[np.repeat(begins - (np.cumsum(size) - size), size) + np.arange(size.sum())], which

    def totals(self, w: np.ndarray) -> np.ndarray:
        """Each row's sum of the weights ``w`` of its columns, taken in pieces to save memory."""
        total = np.zeros(len(self))
        for rows in np.array_split(np.arange(len(self)), len(self) // PIECE + 1):
            columns, which = self.take(rows)
            total[rows] = np.bincount(which, w[columns], len(rows))
        return total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def telling(positive: Rows, unlabelled: Rows) -> np.ndarray:
    """Features that mark the positive texts: enough of them, at a ratio and a significance."""
    n, m = len(positive), len(unlabelled)
    p, u = positive.counts(), unlabelled.counts()
    chance = (p + u) / (n + m)
    with np.errstate(all="ignore"):
        z = (p / n - u / m) / np.sqrt(chance * (1 - chance) * (1 / n + 1 / m))
        return np.flatnonzero((p >= LEAST_TEXTS) & (p / n >= LEAST_RATIO * u / m) & (z >= LEAST_Z))


def risk_gradient(w: np.ndarray, unlabelled: tuple, positive: tuple, prior: float) -> np.ndarray:
    """Gradient by weights and bias (the last one) of the non-negative risk of a batch, whose sides are features, their
    rows and the number of rows: ``prior`` times the mean loss of the positive rows as positive, and the loss of the
    negative rows, estimated as that of the unlabelled rows less ``prior`` times that of the positive ones. Where
    this estimate is below zero, the step goes against its gradient alone."""
    (u, u_of, n_u), (p, p_of, n_p) = unlabelled, positive
    gu = np.bincount(u_of, w[u], n_u) + w[-1]
    gp = np.bincount(p_of, w[p], n_p) + w[-1]
    negative_part = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    du = _sigmoid(gu) / n_u
    if negative_part >= 0:
        dp = np.full(n_p, -prior / n_p)
    else:
        du, dp = -du, prior * _sigmoid(gp) / n_p
    grad = np.bincount(u, du[u_of], len(w)) + np.bincount(p, dp[p_of], len(w))
    grad[-1] += du.sum() + dp.sum()
    return grad


def train(positive: Rows, unlabelled: Rows, size: int, prior: float, seed: int) -> tuple[np.ndarray, float]:
    """One classifier over ``size`` features, by Adam on batches of both samples."""
    draw = np.random.default_rng(seed)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    steps = max(1, -(-len(unlabelled) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(unlabelled))
        for k in range(steps):
            u_rows, p_rows = order[k * BATCH : (k + 1) * BATCH], draw.integers(0, len(positive), SHARE)
            u, u_of = unlabelled.take(u_rows)
            p, p_of = positive.take(p_rows)
            grad = risk_gradient(w, (u, u_of, len(u_rows)), (p, p_of, len(p_rows)), prior)
            step += 1
            mean = 0.9 * mean + 0.1 * grad
            square = 0.999 * square + 0.001 * grad * grad
            w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            w[:-1] *= 1 - RATE * DECAY
    return w[:-1], float(w[-1])


def calibrated(w: np.ndarray, bias: float, positive: Rows, harmless: Rows) -> tuple[np.ndarray, float]:
    """The classifier with its scores put to scale: logistic regression of the label on the score, by Newton's method, with
    equal weight for both classes and targets a little inside of 0 and 1 (Platt), so that it ends where they part."""
    n, m = len(positive), len(harmless)
    x = np.stack([np.concatenate([positive.totals(w), harmless.totals(w)]) + bias, np.ones(n + m)])
    target = np.repeat([(n + 1) / (n + 2), 1 / (m + 2)], [n, m])
    weight = np.repeat([0.5 / n, 0.5 / m], [n, m])
    loss = lambda line: float((weight * (np.logaddexp(0, line @ x) - target * (line @ x))).sum())
    line = np.array([1.0, 0.0])
    for _ in range(50):
        chance = _sigmoid(line @ x)
        grad = x @ (weight * (chance - target))
        step = np.linalg.solve((x * (weight * chance * (1 - chance))) @ x.T + 1e-9 * np.eye(2), grad)
        size = 1.0
        while size > 1e-6 and loss(line - size * step) > loss(line):
            size /= 2
        line = line - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    if line[0] <= 0:  # the scores tell nothing
        return w, bias
    return line[0] * w, float(line[0] * bias + line[1])


def _drawn(key: Column, most: int, total: int) -> Column:
    """About ``most`` of ``total`` values, by a hash of the value; null is like any other."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < min(1.0, most / max(total, 1)) * (1 << 30)


def gathered(parts: Iterable[bytes]) -> Rows:
    """The rows, each the bytes of its columns, in the order of their bytes. They are held end to end, since
    thousands of small objects leave the driver's memory in pieces that it does not give back."""
    held, ends = bytearray(), [0]
    for part in parts:
        held += part
        ends.append(len(held))
    row = lambda i: held[ends[i] : ends[i + 1]]
    order = sorted(range(len(ends) - 1), key=cmp_to_key(lambda i, j: (row(i) > row(j)) - (row(i) < row(j))))
    columns = np.frombuffer(held, "<i4") if held else np.zeros(0, "<i4")
    begins = np.array(ends) // 4
    stops = np.cumsum(np.diff(begins)[np.array(order, int)])
    out = np.empty_like(columns)
    for i, stop in zip(order, stops.tolist()):
        own = columns[begins[i] : begins[i + 1]]
        out[stop - len(own) : stop] = own
    return Rows(out, stops)


def _sample(texts: DataFrame) -> Rows:
    """Features of the different texts of a drawn sample, thinned by a hash of the text to ``SAMPLE_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in slices(batch.column(1)):
                feature, owner = features(data, offsets)
                key = np.unique(owner.astype(np.int64) << FEATURE_BITS | feature)
                own = key & ((1 << FEATURE_BITS) - 1)
                stops = np.searchsorted(key >> FEATURE_BITS, np.arange(to - at), "right")
                parts = [own[a:b].astype("<i4").tobytes() for a, b in zip(np.append(0, stops[:-1]), stops)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(parts, pa.binary())], names=["h", "f"])

    different = texts.select("t").distinct().select(F.xxhash64(F.lit(1), "t").alias("h"), "t")
    stored = staging.stage(different.mapInArrow(run, "h long, f binary"), "features")
    total = stored.agg(F.coalesce(F.sum(F.octet_length("f")), F.lit(0)).alias("n")).first()["n"]
    rows = stored.where(_drawn(F.col("h"), SAMPLE_BYTES, total)).select("f").toLocalIterator()
    return gathered(r["f"] for r in rows)


def fit(
    df: DataFrame,
    key: str,
    text: str,
    labels: DataFrame,
    label_key: str,
    label: str,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    harmless: int = HARMLESS,
    prior: float | None = None,
) -> Model | None:
    """Learn from the texts of ``df`` that ``labels`` marks with 1, and from all of ``df`` as unlabelled texts; the texts
    marked with 0, if any, serve to put the scores to scale.

    ``prior``: share of toxic texts; if not given, that of label 1 among the keys with a label, where
    a key with several labels has the largest. None if there is no positive text: then nothing is
    known to be toxic. Null texts are empty; null keys and labels mark nothing.

    About ``positives`` and ``harmless`` keys are drawn from the labels alone, so the texts are joined with few keys and never shuffled;
    about ``unlabelled`` different texts are drawn by a hash. Copies of a text are one text of a sample, and the
    features of each sample take ``SAMPLE_BYTES`` on the driver.
    """
    known = labels.select(labels[f"`{label_key}`"].alias("k"), labels[f"`{label}`"].cast("int").alias("y")).dropna()
    known = known.groupBy("k").agg(F.max("y").alias("y"))
    seen = known.agg(F.count("*").alias("all"), F.count_if(F.col("y") == 1).alias("toxic"), F.count_if(F.col("y") == 0).alias("clean")).first()
    if not seen["toxic"]:
        return None
    if prior is None:
        prior = seen["toxic"] / seen["all"]
    prior = min(max(prior, 1e-4), 0.9)
    rows = bound_batches(df).select(df[f"`{key}`"].alias("k"), F.coalesce(df[f"`{text}`"].cast("string"), F.lit("")).alias("t"))
    marked = lambda y, most, total: F.broadcast(known.where((F.col("y") == y) & _drawn(F.col("k"), most, total)).select("k"))
    toxic = _sample(rows.join(marked(1, positives, seen["toxic"]), "k"))
    different = rows.agg(F.approx_count_distinct(F.xxhash64("t")).alias("n")).first()["n"]
    mixed = _sample(rows.where(_drawn(F.col("t"), unlabelled, different)))
    if not len(toxic) or not len(mixed):
        return None
    columns = telling(toxic, mixed)
    few = toxic.only(columns), mixed.only(columns), len(columns)
    del toxic, mixed
    clean = _sample(rows.join(marked(0, harmless, seen["clean"]), "k")).only(columns) if seen["clean"] and len(columns) else ()
    found = [train(*few, prior, seed) for seed in range(MODELS)]
    if len(clean):
        found = [calibrated(w, b, few[0], clean) for w, b in found]
    weights = np.zeros((MODELS, 1 << FEATURE_BITS), np.float32)
    weights[:, columns] = [w for w, _ in found]
    return Model(weights, np.array([b for _, b in found]))


def score(df: DataFrame, text: str, model: Model | None, name: str = "score") -> DataFrame:
    """``df`` with the probability that the whole ``text`` is toxic: the mean of the models.

    Null is the empty text; a text without words gets what the bias says. Without a model all
    scores are 0. Rows and other columns stay; a column called ``name`` is replaced.
    """
    known = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model = known.value
        heavy = None if model is None else np.abs(model.weights).max(axis=0) > 0

        def make(column: pa.Array) -> list:
            scores = []
            for at, to, data, offsets in slices(column):
                if model is None:
                    scores += [0.0] * (to - at)
                    continue
                feature, owner = features(data, offsets)
                kept = heavy[feature]
                key = np.unique(owner[kept].astype(np.int64) << FEATURE_BITS | feature[kept])
                feature, owner = key & ((1 << FEATURE_BITS) - 1), key >> FEATURE_BITS
                total = np.zeros(to - at)
                for w, b in zip(model.weights, model.bias):
                    total += _sigmoid(np.bincount(owner, w[feature], to - at) + b)
                scores += (total / len(model.bias)).tolist()
            return [pa.array(scores, pa.float64())]

        return make

    return with_fields(df, text, [T.StructField(name, T.DoubleType())], start)


def toxic(name: str = "score") -> Column:
    return F.col(name) >= 0.5
