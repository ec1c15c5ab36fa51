"""Similarity join of texts on word n-grams (Jaccard), by chosen paths.

Every text is a set of hashed ``WORDS``-grams; texts with equal sets form a copy class, which counts as one set
with a weight. A set is embedded in ``COORDINATES`` MinHash tokens. A run samples each token position
with probability 1 / (threshold * COORDINATES) and sends a set to one node per sampled position, keyed by its
token there, so two sets meet where they share a sampled token. Nodes of up to ``SMALL`` sets are compared by brute
force. A larger node is cut by set size first. Then sets whose mean similarity to witnesses of the node is over
``CROWDED`` times the threshold (splitting would not part them) are compared with the whole node, in blocks; the
others are split again on tokens that the node samples. Runs are added until the chance to have met is at
least ``recall`` for a pair at the threshold, given the sampled positions and the depth of the splits.

Pairs are never rows. A pair that meets in several nodes belongs to the smallest one; both sides carry their
list of nodes, so each node knows its own pairs. Where a sketch lets a pair pass, the texts
themselves are fetched, and n-gram sets are compared exactly; a node returns the number of links of each
set and a spanning forest of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ratingloom import staging
from ratingloom.llm.components import connected_components
from ratingloom.llm.text import ALNUM, LOWER, bound_batches, free_name, mix, slices, spans_hash, windows, word_spans

WORDS = 5
THRESHOLD = (4, 5)  # numerator and denominator
COORDINATES = 64
SMALL = 256
BLOCK = 512
WITNESSES = 8
CROWDED = 0.6
RECALL = 0.999
SLACK = 0.25  # a pair passes the sketch if its estimate is at most this much below the threshold
MARK_BITS, MOST_MARKS, MARK_SEGMENT = 16, 1 << 29, 1 << 15
PAIR_WORDS = 1 << 21  # 64-bit words of pair bit sets at a time
SEED = 0x5EED

_U = np.uint64


@dataclass(frozen=True)
class Join:
    """Parameters of the join."""

    words: int = WORDS
    threshold: tuple[int, int] = THRESHOLD
    recall: float = RECALL
    small: int = SMALL
    block: int = BLOCK

    @property
    def similarity(self) -> float:
        return self.threshold[0] / self.threshold[1]

    @property
    def sample(self) -> float:
        return 1 / (self.similarity * COORDINATES)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, and their text numbers, in text order. A text of fewer
    words has one n-gram of all its words, if any."""
    low = LOWER[data]
    starts, ends, text_of = word_spans(low, offsets, ALNUM)
    words = spans_hash(low, starts, ends)
    texts = len(offsets) - 1
    count = np.bincount(text_of, minlength=texts)
    hashes, owners = [], []
    for k in range(1, n + 1):
        chosen = slice(None) if k == n else count[text_of] == k
        found, first = windows(words[chosen], text_of[chosen], k)
        hashes.append(found)
        owners.append(text_of[chosen][first])
    h, owner = np.concatenate(hashes), np.concatenate(owners).astype(np.int64)
    bits = _U(max(1, texts.bit_length()))
    order = np.argsort(owner.astype(_U) << (_U(64) - bits) | h >> bits, kind="stable")
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]


def coordinate_seeds() -> np.ndarray:
    return mix(np.arange(1, COORDINATES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def _sets(df: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """For each row its id, a hash of its text, its set's two hashes (null without words) and size, and the MinHash tokens."""
    longs = [T.StructField(n, T.LongType()) for n in ("print", "set", "other", "n")]
    schema = T.StructType([T.StructField("id", df.schema[key].dataType), *longs, T.StructField("tokens", T.BinaryType())])
    words = join.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = coordinate_seeds()
        for batch in batches:
            for at, to, data, offsets in slices(batch.column(2)):
                h, owner = shingles(data, offsets, words)
                rows = to - at
                n = np.bincount(owner, minlength=rows)
                full = np.flatnonzero(n)
                begins = (np.cumsum(n) - n)[full]
                name, other, tokens = np.zeros(rows, _U), np.zeros(rows, _U), np.zeros((rows, COORDINATES), "<u4")
                if len(full):
                    name[full] = mix(np.add.reduceat(mix(h ^ _U(SEED)), begins) + n[full].astype(_U))
                    other[full] = mix(np.add.reduceat(mix(h + _U(SEED) * _U(0x9E3779B97F4A7C15)), begins) ^ n[full].astype(_U))
                    for i, seed in enumerate(seeds):
                        tokens[full, i] = np.minimum.reduceat((h * seed >> _U(32)).astype(np.uint32), begins)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, rows),
                        batch.column(1).slice(at, rows),
                        pa.array(name.view(np.int64), pa.int64(), mask=n == 0),
                        pa.array(other.view(np.int64), pa.int64(), mask=n == 0),
                        pa.array(n, pa.int64()),
                        pa.array([t.tobytes() for t in tokens], pa.binary()),
                    ],
                    names=schema.names,
                )

    rows = bound_batches(df).select(df[f"`{key}`"].alias("id"), F.xxhash64(df[f"`{text}`"]).alias("print"), df[f"`{text}`"].cast("string").alias("t"))
    return rows.mapInArrow(run, schema)


def _apart(table: DataFrame) -> DataFrame:
    """``table`` with another ``set`` where two different sets have the same one: sets are told apart by 128 bits."""
    different = table.where(F.col("set").isNotNull()).groupBy("set").agg(F.min("other").alias("low"), F.max("other").alias("high"))
    same = staging.stage(different.where("low < high").select("set"), "same")
    if same.isEmpty():
        return table
    again = table.join(F.broadcast(same.withColumn("again", F.lit(True))), "set", "left")  # a few pairs in 10^10 sets
    name = F.when(F.col("again"), F.xxhash64("set", "other")).otherwise(F.col("set"))
    return staging.stage(again.withColumn("set", name).select(*table.columns), "texts")


def _matrix(column: pa.Array, kind: str = "<u4", width: int = COORDINATES) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


NODE_ROWS = "node long, set long"


def _roots(sets: DataFrame, slots: list[tuple[int, int]]) -> DataFrame:
    """The nodes of the first level: one for each sampled position of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _matrix(batch.column(1)).astype(_U)
            for number, position in slots:
                node = mix(mix(tokens[:, position] + _U((number + 1) << 40)) ^ _U(SEED)) & ~_U(1)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), batch.column(0)], names=["node", "set"])

    return sets.select("set", "tokens").mapInArrow(run, NODE_ROWS)


def _sized(rows: DataFrame) -> DataFrame:
    """The rows of nodes with two sets at least, with the node's size."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes, "node")


def _banded(wide: DataFrame, join: Join) -> DataFrame:
    """Nodes cut by set size: a set goes to the band of its size and to the next one. Similar sets differ in size by
    the threshold's factor at most, so they share a band, and nothing is lost. Of the bands that hold sets of one size band
    alone, those are left out whose sets are all in another, so sets of about one size are in one band, not in two."""
    band = F.floor(F.log(F.col("n")) / math.log(1 / join.similarity) + 1e-9)
    held = wide.groupBy("node").agg(F.collect_set(band).alias("held"))
    has = lambda b: F.array_contains("held", b)
    bands = F.filter(F.array(band, band + 1), lambda b: has(b) & (has(b - 1) | ~has(b + 1)))
    placed = wide.join(held, "node").select("node", "set", "tokens", F.explode(bands).alias("band"))
    return placed.select(F.xxhash64("node", "band").bitwiseAND(F.lit(-2).cast("long")).alias("node"), "set", "tokens")


LEVEL_ROWS = "node long, set long, size long, crowded boolean, child long, tokens binary"


def _level(rows: DataFrame, join: Join) -> DataFrame:
    """One level of nodes ``(node, set, tokens)``: for each set its node's size and whether it is crowded there
    (always so in small nodes), and, with ``child`` not null, the children of the sets that are not."""
    drawn = F.pmod(F.xxhash64("set", "node"), F.lit(WITNESSES))
    order = F.xxhash64("set")
    witnesses = [F.min_by("tokens", F.when(drawn == w, order)).alias(f"w{w}") for w in range(WITNESSES)]
    known = rows.groupBy("node").agg(F.count("*").alias("size"), *witnesses).where("size > 1")
    listed = F.when(F.col("size") > join.small, F.array_compact(F.array(*(f"w{w}" for w in range(WITNESSES)))))
    known = known.select("node", "size", listed.alias("witnesses"))
    limit, sample, small = CROWDED * join.similarity, join.sample, join.small

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "set", "size", "crowded", "child", "tokens"]
        positions = mix(np.arange(1, COORDINATES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                batch = whole.slice(at, 2_000)
                rows = batch.num_rows
                wide = np.flatnonzero(batch.column(2).to_numpy() > small)
                crowded = np.ones(rows, bool)
                extra, child = wide[:0], np.zeros(0, _U)
                if len(wide):
                    part = batch.take(pa.array(wide))
                    node = part.column(0).to_numpy().view(_U)
                    tokens, lists = _matrix(part.column(3)), part.column(4)
                    size = np.diff(lists.offsets.to_numpy())
                    same = (_matrix(lists.flatten()) == np.repeat(tokens, size, axis=0)).mean(axis=1)
                    crowded[wide] = np.add.reduceat(same, np.cumsum(size) - size) / size >= limit
                    own = mix(node[:, None] + positions[None, :])
                    row, position = np.nonzero((own < _U(int(sample * 2.0**64))) & ~crowded[wide][:, None])
                    child = mix(own[row, position] ^ mix(tokens[row, position].astype(_U))) & ~_U(1)
                    extra = wide[row]
                children = np.concatenate([np.zeros(rows, np.int64), child.view(np.int64)])
                chosen = pa.array(np.concatenate([np.arange(rows), extra]))
                new = np.arange(len(chosen)) >= rows
                carried = batch.column(3).take(pa.array(np.concatenate([np.zeros(rows, np.int64), extra]), mask=~new))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).take(chosen) for i in range(3)),
                        pa.array(np.concatenate([crowded, np.zeros(len(extra), bool)])),
                        pa.array(children, mask=~new),
                        carried,
                    ],
                    names=names,
                )

    joined = rows.join(known, "node").select("node", "set", "size", "tokens", "witnesses")
    return joined.mapInArrow(run, LEVEL_ROWS)


def reached(depth: int) -> float:
    """That a pair that agrees at the root meets in a tree of this depth."""
    out = 1.0
    for _ in range(depth - 1):
        out = 1 - math.exp(-out)
    return out


def chance(depth: int, similarity: float) -> float:
    """That a pair at the threshold, in a tree of this depth, meets through one position sampled at the root."""
    return similarity * reached(depth)


def missed(slots: np.ndarray, depth: int, similarity: float) -> float:
    """That a pair at the threshold meets through none of the positions; ``slots`` counts the trees of each position, which
    the pair enters together or not at all."""
    return float(np.prod(1 - similarity + similarity * (1 - reached(depth)) ** slots))


def _paths(sets: DataFrame, join: Join) -> DataFrame:
    """Nodes to compare: node, set, size, crowded (compare it with the whole node; always so in small nodes).

    The first batch of runs is enough for trees of depth 2. Sets that were in deeper trees so often that
    the rest of their nodes is not enough go through further runs, as many as their depth asks for.
    """
    order = np.random.default_rng(SEED).permutation(COORDINATES).tolist()
    parts, depth, before = [], 2, 0
    used = np.zeros(COORDINATES, np.int64)
    while sets is not None:
        slots: list[tuple[int, int]] = []
        while missed(used, depth, join.similarity) > 1 - join.recall:
            # each position once, then each once more
            position = order[(before + len(slots)) % COORDINATES]
            slots.append((before + len(slots), position))
            used[position] += 1
        first = staging.stage(_sized(_roots(sets, slots)), "nodes")
        small = F.col("size") <= join.small
        parts.append(first.where(small).select("node", "set", "size", F.lit(True).alias("crowded")))
        wide = first.where(~small)
        level, deep = 0, None
        rows = None if wide.isEmpty() else _banded(wide.join(sets.select("set", "n", "tokens"), "set"), join)
        while rows is not None:
            level += 1
            found = staging.stage(_level(rows, join), "level")
            own = found.where(F.col("child").isNull())
            held = own.groupBy("node").agg(F.max("crowded").alias("any")).where("any").select("node")
            parts.append(own.join(held, "node", "left_semi").select("node", "set", "size", "crowded"))
            if level == 1:
                # a set may be in two bands for one slot
                deep = own.where(~F.col("crowded")).groupBy("set").agg(F.count("*").alias("times"))
            children = found.where(F.col("child").isNotNull())
            rows = None if children.isEmpty() else children.select(F.col("child").alias("node"), "set", "tokens")
        levels = max(level, 1)  # the cut by size loses nothing
        before += len(slots)
        if deep is None or levels <= depth:
            break
        depth = levels
        short = math.log1p(-chance(depth, join.similarity)) - math.log1p(-join.similarity)
        left = before * math.log1p(-join.similarity) + F.least(F.col("times"), F.lit(before)) * short
        sets = staging.stage(sets.join(deep.where(left > math.log(1 - join.recall)), "set", "left_semi"), "again")
        if sets.isEmpty():
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _by_mark(source: DataFrame, wanted: DataFrame, column: str = "print") -> tuple[DataFrame, DataFrame]:
    """The rows of ``source`` whose ``column`` may be among the prints ``wanted``, and those in which it is not: a bit map
    of ``MARK_BITS`` bits a print, and of ``MOST_MARKS`` bits at most, is broadcast, so only the first need a shuffle."""
    bits = min(MOST_MARKS, max(1 << 16, MARK_BITS * wanted.count()))
    bits -= bits % MARK_SEGMENT
    place = F.pmod(F.col("print"), F.lit(bits)).alias("place")
    number = free_name(source, "place")
    marks = wanted.select(place).select((F.col("place") / MARK_SEGMENT).cast("long").alias("segment"), "place")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for k in np.unique(segment).tolist():
                own = held.setdefault(k, np.zeros(MARK_SEGMENT, bool))
                own[at[segment == k] - k * MARK_SEGMENT] = True
        if held:
            parts = [np.packbits(x).tobytes() for x in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(parts, pa.binary())], names=["segment", "bits"])

    whole = np.zeros(bits // 8, np.uint8)
    for r in marks.repartition("segment").mapInArrow(draw, "segment long, bits binary").collect():
        whole[r["segment"] * MARK_SEGMENT // 8 :][: MARK_SEGMENT // 8] |= np.frombuffer(r["bits"], np.uint8)
    known = source.sparkSession.sparkContext.broadcast(whole)
    numbered = source.withColumn(number, F.pmod(F.col(f"`{column}`"), F.lit(bits)))

    def kept(marked: bool) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = known.value
            for batch in batches:
                at = batch.column(batch.num_columns - 1).to_numpy()
                inside = ((held[at >> 3] >> (7 - (at & 7))) & 1).astype(bool)
                yield batch.filter(pa.array(inside == marked))

        return numbered.mapInArrow(keep, numbered.schema).drop(number)

    return kept(True), kept(False)


def _dealt(rows: DataFrame, join: Join, columns: list[str]) -> DataFrame:
    """Nodes cut into blocks, and each row sent to every pair of blocks that holds its own."""
    blocks = F.when(F.col("size") <= join.small, 1).otherwise(F.ceil(F.col("size") / join.block)).cast("int")
    own = F.pmod(F.xxhash64("set"), blocks.cast("long")).cast("int")
    cut = rows.withColumn("blocks", blocks).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = cut.select("*", other)
    return pairs.select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", *columns)


def _grouped(rows: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Run ``work`` on the rows of each (node, a, b); a group is two blocks at most."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        mark = None
        out: list[dict] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(names.index(c)).to_numpy() for c in ("node", "a", "b")])
            change = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            for i, j in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                now = tuple(ids[:, i].tolist())
                if now != mark and held:
                    out += work(pa.Table.from_batches(held))
                    held = []
                mark = now
                held.append(batch.slice(i, j - i))
            if len(out) >= 10_000:
                yield from pa.Table.from_pylist(out, arrow).to_batches()
                out = []
        if held:
            out += work(pa.Table.from_batches(held))
        if out:
            yield from pa.Table.from_pylist(out, arrow).to_batches()

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    parsed = T.StructType.fromDDL(schema)
    arrow = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in parsed.fields])
    return rows.repartition("node", "a", "b").sortWithinPartitions("node", "a", "b", "set").mapInArrow(run, parsed)


def _own_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that this node compares: the smaller one in row order, and the other."""
    node, a, b = (table.column(c)[0].as_py() for c in ("node", "a", "b"))
    crowded = table.column("crowded").to_numpy()
    n = len(crowded)
    pairs = np.triu(crowded[:, None] | crowded[None, :], 1)
    if a != b:
        own = table.column("own").to_numpy()
        pairs &= own[:, None] != own[None, :]
    lists = table.column("entries").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    entries = lists.flatten().to_numpy().astype(np.int64)
    holder = np.repeat(np.arange(n), sizes)
    place = entries & ~np.int64(1)
    earlier = place < node
    place, holder, flag = place[earlier], holder[earlier], (entries[earlier] & 1).astype(bool)
    if len(place):
        order = np.argsort(place, kind="stable")
        place, holder, flag = place[order], holder[order], flag[order]
        cuts = np.flatnonzero(np.diff(place)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)]):
            if j - i > 1:
                who, how = holder[i:j], flag[i:j]
                pairs[np.ix_(who, who)] &= ~(how[:, None] | how[None, :])
    return np.nonzero(pairs)


def _active(join: Join) -> Callable[[pa.Table], list[dict]]:
    """Members of a group with a pair that passes the sketch."""
    least = join.similarity - SLACK
    up, down = join.threshold

    def work(table: pa.Table) -> list[dict]:
        i, j = _own_pairs(table)
        if not len(i):
            return []
        n = table.column("n").to_numpy()
        fits = down * np.minimum(n[i], n[j]) >= up * np.maximum(n[i], n[j])
        i, j = i[fits], j[fits]
        sketch = _matrix(table.column("sketch").combine_chunks(), np.uint8)
        found = np.zeros(table.num_rows, bool)
        step = max(1, PAIR_WORDS * 8 // COORDINATES)
        for k in range(0, len(i), step):
            close = (sketch[i[k : k + step]] == sketch[j[k : k + step]]).mean(axis=1) >= least
            found[i[k : k + step][close]] = found[j[k : k + step][close]] = True
        rows = np.flatnonzero(found)
        values = {c: table.column(c).to_numpy()[rows].tolist() for c in ("node", "a", "b", "own", "set", "crowded")}
        return [dict(zip(values, r)) for r in zip(*values.values())]

    return work


def _links(join: Join) -> Callable[[pa.Table], list[dict]]:
    """Links of each member of a group by exact comparison, and the smallest member it is connected to here."""
    words = join.words
    up, down = join.threshold

    def work(table: pa.Table) -> list[dict]:
        i, j = _own_pairs(table)
        if not len(i):
            return []
        hashes, sizes = [], []
        for _, _, data, offsets in slices(table.column("t").combine_chunks()):
            h, owner = shingles(data, offsets, words)
            hashes.append(h)
            sizes.append(np.bincount(owner, minlength=len(offsets) - 1))
        h, size = np.concatenate(hashes), np.concatenate(sizes)
        member = np.repeat(np.arange(len(size)), size)
        fits = down * np.minimum(size[i], size[j]) >= up * np.maximum(size[i], size[j])
        i, j = i[fits], j[fits]
        if not len(i):
            return []
        _, which, count = np.unique(h, return_inverse=True, return_counts=True)
        shared = count > 1
        column = (np.cumsum(shared) - 1)[which][shared[which]]
        member = member[shared[which]]
        width = int(shared.sum())
        both = np.zeros(len(i), np.int64)
        chunk = 1 << 16  # columns at a time
        for c in range(0, width, chunk):
            inside = (column >= c) & (column < c + chunk)
            bits = np.zeros((len(size), (min(chunk, width - c) + 63) // 64 * 64), bool)
            bits[member[inside], column[inside] - c] = True
            packed = np.packbits(bits, axis=1).view(_U)
            step = max(1, PAIR_WORDS // packed.shape[1])
            for k in range(0, len(i), step):
                both[k : k + step] += np.bitwise_count(packed[i[k : k + step]] & packed[j[k : k + step]]).sum(axis=1, dtype=np.int64)
        similar = down * both >= up * (size[i] + size[j] - both)
        i, j = i[similar], j[similar]
        if not len(i):
            return []
        weight = table.column("copies").to_numpy()
        links = np.bincount(i, weight[j], len(size)) + np.bincount(j, weight[i], len(size))
        root = np.arange(len(size))
        while True:
            least = np.minimum(root[i], root[j])
            after = root.copy()
            np.minimum.at(after, i, least)
            np.minimum.at(after, j, least)
            after = after[after]
            if (after == root).all():
                break
            root = after
        names = table.column("set").to_numpy()
        linked = np.flatnonzero(links)
        return [
            {"set": s, "links": int(x), "root": r}
            for s, x, r in zip(names[linked].tolist(), links[linked].tolist(), names[root[linked]].tolist())
        ]

    return work


def similar_texts(df: DataFrame, key: str, text: str, join: Join = Join()) -> DataFrame:
    """One row per row of ``df``: ``key``, ``print`` (a hash of the text), ``copy_id`` (smallest key with the same n-gram
    set), ``class_id`` (smallest key of its component under links), ``class_print`` (the smallest print of that key),
    ``n_links`` (rows whose n-gram sets have a Jaccard similarity of the threshold at least, copies included).

    Null texts and texts without words have no n-grams: they link to nothing and are classes of their own. Repeated rows
    are copies of each other. Other columns are not read.
    """
    table = _apart(staging.stage(_sets(df, key, text, join), "texts"))
    named = table.where(F.col("set").isNotNull())
    sets = staging.stage(
        named.groupBy("set").agg(
            F.count("*").alias("copies"), F.min(F.struct("id", "print")).alias("least"), F.first("n").alias("n"), F.first("tokens").alias("tokens")
        ),
        "sets",
    )
    nodes = staging.stage(_paths(sets, join), "paths")
    entry = F.col("node").bitwiseOR(F.col("crowded").cast("long"))
    cards = nodes.groupBy("set").agg(F.collect_list(entry).alias("entries"))
    # the last byte of each token
    sketch = F.unhex(F.regexp_replace(F.hex("tokens"), "(..)......", "$1")).alias("sketch")
    cards = staging.stage(cards.join(sets.select("set", "n", "copies", "least", sketch), "set"), "cards")
    sketched = nodes.join(cards.select("set", "entries", "n", "sketch"), "set")
    dealt = _dealt(sketched, join, ["node", "set", "crowded", "entries", "n", "sketch"])
    active = staging.stage(_grouped(dealt, _active(join), "node long, a int, b int, own int, set long, crowded boolean"), "active")
    wanted = staging.stage(active.select("set").distinct().join(cards.select("set", "least"), "set"), "wanted")
    source = df.select(df[f"`{key}`"].alias("id"), F.xxhash64(df[f"`{text}`"]).alias("print"), df[f"`{text}`"].cast("string").alias("t"))
    source, _ = _by_mark(source, wanted.select("least.print"))
    same = source["id"].eqNullSafe(wanted["least"]["id"]) & (source["print"] == wanted["least"]["print"])
    texts = staging.stage(source.join(wanted, same).select("set", "t").dropDuplicates(["set"]), "found")
    compared = active.join(cards.select("set", "entries", "copies"), "set").join(texts, "set")
    links = staging.stage(_grouped(compared, _links(join), "set long, links long, root long"), "links")
    roots = connected_components(links.select("set", "root"), "set", "root")
    counts = links.groupBy("set").agg(F.sum("links").alias("links"))
    component = sets.select("set", "copies", "least").join(roots, F.col("set") == F.col("u"), "left")
    component = component.withColumn("v", F.coalesce("v", "set"))
    first = component.groupBy("v").agg(F.min("least").alias("first"))
    known = component.join(first, "v").join(counts, "set", "left")
    known = staging.stage(known.select("set", "copies", "least", "first", F.coalesce("links", F.lit(0)).alias("links")), "classes")
    alone = F.struct("id", "print")
    return (
        table.join(known, "set", "left")
        .withColumn("least", F.coalesce("least", alone))
        .withColumn("first", F.coalesce("first", alone))
        .select(
            F.col("id").alias(key),
            "print",
            F.col("least.id").alias("copy_id"),
            F.col("first.id").alias("class_id"),
            F.col("first.print").alias("class_print"),
            F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        )
    )


def keep_one(df: DataFrame, key: str, text: str, join: Join = Join()) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each class the row with the smallest key stays (of rows that also share
    the key, one with the smallest hash of the text). Rows and columns are otherwise as they came. Only rows that may go
    are shuffled."""
    found = staging.stage(similar_texts(df, key, text, join).select(F.col(key).alias("id"), "print", "class_id", "class_print"), "members")
    first = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("print") == F.col("class_print"))
    gone = staging.stage(found.where(~first).select("id", "print").distinct(), "gone")
    repeated = found.where(first).groupBy("id", "print").agg(F.count("*").alias("n")).where("n > 1")
    doubtful = staging.stage(gone.select("print").unionByName(repeated.select("print")).distinct(), "doubtful")
    name = free_name(df, "print")
    maybe, sure = _by_mark(df.withColumn(name, F.xxhash64(df[f"`{text}`"])), doubtful, name)
    same = maybe[f"`{key}`"].eqNullSafe(gone["id"]) & (maybe[name] == gone["print"])
    once = maybe.join(gone, same, "left_anti").dropDuplicates([key, name])
    return sure.unionByName(once).select(*(f"`{c}`" for c in df.columns))
