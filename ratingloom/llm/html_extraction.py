"""Main text of HTML pages: a linear-chain conditional random field over the leaf blocks of the DOM.

Each block is content or not. Features are the ancestors' tags, the words of their class, id and
role, and the shape of the text; they are hashed, so the weights have a fixed size. The field is
trained by maximum likelihood (forward-backward, Adam) on drawn layouts and on the semantic
markup of at most ``MARKED_PAGES`` different pages of at most ``MARKED_PAGE_BYTES`` bytes, drawn by a hash of the page;
it is broadcast, and decodes each page by Viterbi. The features of an element's ancestors are summed once an
element, so a page takes time in proportion to its length.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ratingloom.llm.html_blocks import Block, Element, blocks
from ratingloom.llm.html_training import drawn_pages, marked_pages
from ratingloom.llm.text import with_fields

BITS = 13
MASK = (1 << BITS) - 1
DRAWN_PAGES = 1_200
MARKED_PAGES = 300
MARKED_PAGE_BYTES = 100_000
EPOCHS = 14
BATCH = 64
RATE = 0.05
DECAY = 1e-3
SEED = 11

SIGNS = re.compile(r"[©|·»«→]|\d{4}")


@dataclass
class Model:
    weights: np.ndarray  # of a feature in a content block
    step: np.ndarray  # from label to label
    first: np.ndarray


def _element_codes(element: Element | None) -> list[int]:
    """Features that an element adds to those of the elements around it."""
    if element is None:
        return []
    names = [f"a={element.new_tag}"] if element.new_tag else []
    return [zlib.crc32(x.encode()) & MASK for x in names + [f"c={w}" for w in element.new_words]]


def _near_codes(element: Element | None) -> list[int]:
    """Features of the place of a block's text."""
    tag, outer = (element.tag, element.outer_tag) if element else (None, None)
    names = ["bias", f"t={tag or 'none'}", f"t2={outer or 'none'}>{tag or 'none'}"]
    return [zlib.crc32(x.encode()) & MASK for x in names + [f"o={w}" for w in (element.own if element else ())]]


def _text_codes(found: list[Block], i: int) -> list[int]:
    """Features of a block's text."""
    text, n = found[i].text, len(found[i].text)
    words = text.count(" ") + 1
    share = found[i].linked / n
    names = [
        f"chars={min(n.bit_length(), 12)}",
        f"words={min(words.bit_length(), 8)}",
        f"links={0 if share == 0 else 1 + int(share * 3)}",
        f"end={text[-1] in '.!?:;»\"'}",
        f"upper={text[:40].isupper()}",
        f"signs={SIGNS.search(text[:60]) is not None}",
        f"commas={min(text.count(','), 3)}",
        f"place={min(i, 3)},{min(len(found) - 1 - i, 3)}",
    ]
    return [zlib.crc32(x.encode()) & MASK for x in names]


def block_features(found: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all blocks in order, and the place of each block's first."""
    flat: list[int] = []
    begins, cache = [], {}
    for i, b in enumerate(found):
        begins.append(len(flat))
        near = cache.get(id(b.element))
        if near is None:
            near = cache[id(b.element)] = _near_codes(b.element) + [c for e in b.path() for c in _element_codes(e)]
        flat += near
        flat += _text_codes(found, i)
    return np.array(flat, np.int64), np.array(begins, np.int64)


def emissions(found: list[Block], weights: np.ndarray) -> list[float]:
    """The sum of the weights of each block's features; those of the elements around it are summed once."""
    around: dict[int, float] = {id(None): 0.0}
    near: dict[int, float] = {}
    flat: list[int] = []
    begins, base = [], []
    for i, b in enumerate(found):
        path, element = [], b.element
        while id(element) not in around:
            path.append(element)
            element = element.parent
        for e in reversed(path):
            around[id(e)] = around[id(e.parent)] + sum(weights[c] for c in _element_codes(e))
        if id(b.element) not in near:
            near[id(b.element)] = around[id(b.element)] + sum(weights[c] for c in _near_codes(b.element))
        base.append(near[id(b.element)])
        begins.append(len(flat))
        flat += _text_codes(found, i)
    return (np.add.reduceat(weights[np.array(flat)], begins) + base).tolist()


def train(pages: list[tuple[list[Block], list[int]]]) -> Model:
    """Maximise the likelihood of the labels."""
    rows = []
    for found, labels in pages:
        flat, begins = block_features(found)
        rows.append((flat, begins, np.array(labels)))
    draw = np.random.default_rng(SEED)
    size = 1 << BITS
    w = np.zeros(size + 6)  # emissions, steps (2 x 2), first (2)
    mean, square, count = np.zeros_like(w), np.zeros_like(w), 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            chosen = [rows[i] for i in order[k : k + BATCH]]
            length = np.array([len(r[2]) for r in chosen])
            longest = length.max()
            emit, gold = np.zeros((len(chosen), longest)), np.zeros((len(chosen), longest), int)
            for i, (flat, begins, labels) in enumerate(chosen):
                emit[i, : len(labels)] = np.add.reduceat(w[flat], begins)
                gold[i, : len(labels)] = labels
            gap, step, first = _gradients(emit, gold, length, w[size : size + 4].reshape(2, 2), w[size + 4 :])
            grad = np.zeros_like(w)
            for i, (flat, begins, labels) in enumerate(chosen):
                per = np.repeat(gap[i, : len(labels)], np.diff(np.append(begins, len(flat))))
                grad += np.bincount(flat, per, len(w))
            grad[size : size + 4], grad[size + 4 :] = step.ravel(), first
            grad /= length.sum()
            count += 1
            mean = 0.9 * mean + 0.1 * grad
            square = 0.999 * square + 0.001 * grad * grad
            w -= RATE * (mean / (1 - 0.9**count)) / (np.sqrt(square / (1 - 0.999**count)) + 1e-8)
            w *= 1 - RATE * DECAY
    return Model(w[:size].copy(), w[size : size + 4].reshape(2, 2).copy(), w[size + 4 :].copy())


def _gradients(emit: np.ndarray, gold: np.ndarray, length: np.ndarray, step: np.ndarray, first: np.ndarray):
    """Gradients of the negative log likelihood by emission, step and first label, by forward-backward."""
    n, longest = emit.shape
    score = np.stack([np.zeros_like(emit), emit], axis=2)
    inside = np.arange(longest)[None, :] < length[:, None]
    ahead, back = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    ahead[:, 0] = first + score[:, 0]
    for t in range(1, longest):
        ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + step, axis=1) + score[:, t]
    for t in range(longest - 2, -1, -1):
        after = np.logaddexp.reduce(step + (score[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
        back[:, t] = np.where(inside[:, t + 1, None], after, 0.0)
    rows = np.arange(n)
    total = np.logaddexp.reduce(ahead[rows, length - 1], axis=1)
    single = np.exp(ahead + back - total[:, None, None]) * inside[:, :, None]
    gap = single[:, :, 1] - gold * inside
    grad_step = np.zeros((2, 2))
    if longest > 1:
        pair = ahead[:, :-1, :, None] + step + (score[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
        both = inside[:, 1:]
        grad_step = (np.exp(pair) * both[:, :, None, None]).sum(axis=(0, 1))
        np.subtract.at(grad_step, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    grad_first = single[:, 0].sum(axis=0) - np.bincount(gold[:, 0], minlength=2)
    return gap, grad_step, grad_first


def decode(emit: list[float], model: Model) -> list[int]:
    """Labels of the best path by Viterbi; ties go to no content."""
    (s00, s01), (s10, s11) = model.step.tolist()
    a, b = model.first.tolist()
    b += emit[0]
    came = []
    for e in emit[1:]:
        came.append((int(b + s10 > a + s00), int(b + s11 > a + s01)))
        a, b = max(a + s00, b + s10), max(a + s01, b + s11) + e
    label = int(b > a)
    path = [label]
    for back in reversed(came):
        label = back[label]
        path.append(label)
    return path[::-1]


def main_text(page: str, model: Model) -> str:
    found = blocks(page)
    if not found:
        return ""
    return " ".join(b.text for b, label in zip(found, decode(emissions(found, model.weights), model)) if label)


def fit(df: DataFrame, page: str, marked: int = MARKED_PAGES, drawn: int = DRAWN_PAGES) -> Model:
    """Train on drawn layouts, and on those of at most ``marked`` different pages of moderate size that mark their article:
    the ones of smallest hash, so neither the order of the rows nor copies of a page matter."""
    rows = df.select(df[f"`{page}`"].cast("string").alias("p")).where(F.octet_length("p") <= MARKED_PAGE_BYTES)
    rows = rows.withColumn("h", F.xxhash64("p"))
    wanted = rows.select("h").distinct().orderBy("h").limit(marked)
    pages = rows.join(F.broadcast(wanted), "h", "left_semi").groupBy("h").agg(F.min("p").alias("p"))
    given = sorted(r["p"] for r in pages.collect())
    return train(drawn_pages(drawn, SEED) + marked_pages(given))


def extract(df: DataFrame, page: str, model: Model, name: str = "text") -> DataFrame:
    """``df`` with the main text of the HTML column ``page``: content blocks in page order, joined by a space.

    References are decoded, white space inside a block is one space. Null, empty and content-free pages
    give an empty text. Rows and other columns stay; a column called ``name`` is replaced.
    """
    known = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model = known.value
        return lambda column: [pa.array([main_text(p or "", model) for p in column.to_pylist()], pa.string())]

    return with_fields(df, page, [T.StructField(name, T.StringType())], start)
