"""Benchmark decontamination: windows of test items found in documents, hits verified, spans or documents removed.

Both sides are lower-cased in A-Z and cut into words (runs of digits, letters and characters
beyond ASCII). The windows of an item are its runs of ``width`` words, or all its words if they
are fewer. Their hashes are broadcast as a set; a task hashes the windows of its documents,
and compares the words themselves for each hit. Nothing is shuffled.

The broadcast is bounded: a benchmark of more than ``SLICE_BENCHMARK`` bytes of text is not broadcast, but a bit map of
its windows is, of 32 MB at most. The documents then pass once, and are stored with the windows that the map lets
through, which a join with the stored windows of the benchmark verifies on the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratingloom import staging
from ratingloom.llm.dealt import mark_map, marked
from ratingloom.llm.text import ALNUM, LOWER, free_name, slices, spans_hash, windows, with_fields, word_spans

WIDTH = 13
SLICE_BENCHMARK = 2 << 20
FLAG_BITS = 20

RANGES = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


class Items:
    """Windows of some items: a flag table and sorted hashes by length, and the items of each window's words."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.by_words: dict[bytes, list[str]] = {}
        for name, text in items:
            low = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            starts, ends, _ = word_spans(low, np.array([0, len(low)]), ALNUM)
            words = [low[a:b].tobytes() for a, b in zip(starts, ends)]
            n = min(width, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                owners = self.by_words.setdefault(b" ".join(words[i : i + n]), [])
                if name is not None and name not in owners:
                    owners.append(name)
        self.by_length = {}
        keys = sorted(self.by_words)
        lengths = np.array([k.count(b" ") + 1 for k in keys], np.int64)
        for n in np.unique(lengths).tolist():
            data = b"\x20".join(k for k, m in zip(keys, lengths) if m == n)
            hashes = np.unique(self.hashed(np.frombuffer(data, np.uint8), n))
            flags = np.zeros(1 << FLAG_BITS, bool)
            flags[(hashes & np.uint64(len(flags) - 1)).astype(np.int64)] = True
            self.by_length[n] = flags, hashes

    @staticmethod
    def hashed(data: np.ndarray, n: int) -> np.ndarray:
        starts, ends, text_of = word_spans(data, np.array([0, len(data)]), ALNUM)
        return windows(spans_hash(data, starts, ends), text_of, n)[0].reshape(-1)[::n]

    def hits(self, words: np.ndarray, text_of: np.ndarray):
        """First word and length of each window whose hash is that of an item's window."""
        for n, (flags, hashes) in self.by_length.items():
            found, first = windows(words, text_of, n)
            near = np.flatnonzero(flags[(found & np.uint64(len(flags) - 1)).astype(np.int64)])
            near = near[np.isin(found[near], hashes)]
            for i in first[near].tolist():
                yield i, n


class Words:
    """Words of some texts: their hashes, bytes and text numbers, and the code points before each byte."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low, self.offsets = LOWER[data], offsets
        self.starts, self.ends, self.text_of = word_spans(self.low, offsets, ALNUM)
        self.hashes = spans_hash(self.low, self.starts, self.ends)
        self.first = np.searchsorted(self.text_of, np.arange(len(offsets) - 1))  # word of each text
        self._points = np.append(0, np.cumsum((data & 0xC0) != 0x80))

    def joined(self, i: int, n: int) -> bytes:
        return b" ".join(self.low[a:b].tobytes() for a, b in zip(self.starts[i : i + n], self.ends[i : i + n]))

    def span(self, text: int, a: int, b: int) -> dict[str, int]:
        """Code points of a text from its word ``a`` to before its word ``b``."""
        base, first = self._points[self.offsets[text]], self.first[text]
        start, end = self._points[self.starts[first + a]], self._points[self.ends[first + b - 1]]
        return {"start": int(start - base), "end": int(end - base)}


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _arrow_ranges() -> pa.DataType:
    return pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


ADDED = ("n_words", "n_hit", "hit_spans", "item_ids")
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hit_spans", RANGES),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
]


def _scan(df: DataFrame, text: str, items: Items, spans: bool) -> DataFrame:
    """Find the windows of a broadcast benchmark."""
    value = df.sparkSession.sparkContext.broadcast(items)

    def start():
        found = value.value

        def make(column: pa.Array) -> list:
            counts, hits, places, names = [], [], [], []
            for at, to, data, offsets in slices(column):
                words = Words(data, offsets)
                counts += np.bincount(words.text_of, minlength=to - at).tolist()
                own_ranges, own_names = {}, {}
                for i, n in found.hits(words.hashes, words.text_of):
                    owners = found.by_words.get(words.joined(i, n))
                    if owners is not None:
                        row = int(words.text_of[i])
                        begin = i - int(words.first[row])
                        own_ranges.setdefault(row, []).append((begin, begin + n))
                        own_names.setdefault(row, set()).update(owners)
                for row in range(to - at):
                    merged = merge(own_ranges.get(row, []))
                    hits.append(sum(b - a for a, b in merged))
                    places.append([words.span(row, a, b) for a, b in merged] if spans else None)
                    names.append(sorted(own_names.get(row, ())))
            types = [pa.int64(), pa.int64(), _arrow_ranges(), pa.list_(pa.string())]
            return [pa.array(x, t) for x, t in zip((counts, hits, places, names), types)]

        return make

    return with_fields(df, text, FIELDS, start)


def _item_windows(named: DataFrame, width: int) -> DataFrame:
    """Distinct ``h``, ``n``, ``words`` and ``name`` of the windows of all items, in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners = batch.column(0).to_pylist()
            for at, to, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets)
                size = np.bincount(words.text_of, minlength=to - at)
                out: list[list] = [[], [], [], []]
                for n in np.unique(np.minimum(size, width)).tolist():
                    if not n:
                        continue
                    hashes, first = windows(words.hashes, words.text_of, n)
                    own = np.minimum(size, width)[words.text_of[first]] == n
                    for h, i in zip(hashes[own].view(np.int64).tolist(), first[own].tolist()):
                        for column, x in zip(out, (h, n, words.joined(i, n).decode(), owners[at + int(words.text_of[i])])):
                            column.append(x)
                kinds = (pa.int64(), pa.int32(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=["h", "n", "words", "name"])

    return named.select("name", "t").mapInArrow(run, "h long, n int, words string, name string").distinct()


def _scan_once(df: DataFrame, text: str, named: DataFrame, width: int, spans: bool) -> DataFrame:
    """Find the windows of a benchmark that is not broadcast: one stored pass, then a join on the windows that a bit map
    lets through."""
    table = staging.stage(_item_windows(named, width), "benchmark-windows")
    lengths = [r["n"] for r in table.select("n").distinct().collect()]  # ``width`` at most
    value = df.sparkSession.sparkContext.broadcast(mark_map(table, "h"))
    seen = "array<struct<i:int,n:int,h:bigint,words:string,start:int,end:int>>"
    fields = [T.StructField("n_words", T.LongType()), T.StructField("seen", T.DataType.fromDDL(seen))]

    def start():
        def make(column: pa.Array) -> list:
            counts, found = [], []
            for at, to, data, offsets in slices(column):
                words = Words(data, offsets)
                counts += np.bincount(words.text_of, minlength=to - at).tolist()
                own: list[list[dict]] = [[] for _ in range(to - at)]
                for n in lengths:
                    hashes, first = windows(words.hashes, words.text_of, n)
                    near = np.flatnonzero(marked(value.value, hashes))
                    for h, i in zip(hashes[near].view(np.int64).tolist(), first[near].tolist()):
                        row = int(words.text_of[i])
                        begin = i - int(words.first[row])
                        place = words.span(row, begin, begin + n)
                        own[row].append({"i": begin, "n": n, "h": h, "words": words.joined(i, n).decode(), **place})
                found += own
            kind = pa.struct([("i", pa.int32()), ("n", pa.int32()), ("h", pa.int64()), ("words", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
            return [pa.array(counts, pa.int64()), pa.array(found, pa.list_(kind))]

        return make

    held = df.drop(*ADDED)
    row, extra = free_name(held, "row"), free_name(held, "seen")
    fields[1].name = extra
    scanned = with_fields(held, text, fields, start)
    scanned = staging.stage(scanned.withColumn(row, F.monotonically_increasing_id()), "contamination")
    asked = scanned.where(F.size(extra) > 0).select(F.col(row).alias("row"), F.explode(extra).alias("w")).select("row", "w.*")
    hits = staging.stage(asked.join(table, ["h", "n", "words"]), "hits")
    ranges = hits.select("row", "i", "n", "start", "end").distinct().groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("i", (F.col("i") + F.col("n")).alias("j"), "start", "end"))).alias("r")
    )
    names = hits.groupBy("row").agg(F.array_sort(F.collect_set("name")).alias("item_ids"))
    found = staging.stage(ranges.join(names, "row").select("row", _union("r").alias("u"), "item_ids"), "found")
    both = scanned.join(staging.broadcast_if_small(found, staging.BROADCAST_ROWS // 20), scanned[row] == found["row"], "left")
    n_hit = F.aggregate(found["u"], F.lit(0).cast("long"), lambda n, r: n + (r["j"] - r["i"]))
    places = F.transform(found["u"], lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    none = F.lit(None).cast(RANGES) if not spans else F.coalesce(places, F.array().cast(RANGES))
    return both.select(
        *(scanned[f"`{c}`"] for c in held.columns),
        scanned["n_words"],
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        none.alias("hit_spans"),
        F.coalesce(found["item_ids"], F.array().cast("array<string>")).alias("item_ids"),
    )


def _union(ranges: str) -> Column:
    """Union of an array of ranges (i, j, start, end) sorted by i."""
    kind = "array<struct<i:int,j:int,start:int,end:int>>"

    def step(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        longer = r["j"] > last["j"]
        joined = F.struct(
            last["i"].alias("i"),
            F.greatest(last["j"], r["j"]).alias("j"),
            last["start"].alias("start"),
            F.when(longer, r["end"]).otherwise(last["end"]).alias("end"),
        )
        head = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        touches = (F.size(done) > 0) & (r["i"] <= F.get(done, F.size(done) - 1)["j"])
        return F.when(touches, F.concat(head, F.array(joined))).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(ranges, F.array().cast(kind), step)


def find_contamination(
    df: DataFrame,
    text: str,
    benchmark: DataFrame,
    item: str,
    item_text: str,
    width: int = WIDTH,
    slice_bytes: int = SLICE_BENCHMARK,
    spans: bool = True,
) -> DataFrame:
    """``df`` with ``n_words``, ``n_hit`` (words inside an occurrence of an item's window), ``hit_spans``
    (character ranges of the hit passages; null without ``spans``) and ``item_ids`` (items with an occurring window,
    sorted as strings).

    Null and empty texts have no words; an item without words has no window; an item whose id is null
    hits, but is not listed. Repeated rows stay rows, repeated items count once. Columns of ``df`` with these
    names are replaced, all others kept. With an empty benchmark nothing is hit.
    """
    named = benchmark.select(benchmark[f"`{item}`"].cast("string").alias("name"), benchmark[f"`{item_text}`"].cast("string").alias("t"))
    named = staging.stage(named.where(F.col("t").isNotNull()).distinct(), "benchmark")
    total = named.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first()["n"]
    if text in ADDED:
        raise ValueError(f"the text column may not be called {text}")
    if total <= slice_bytes:
        return _scan(df, text, Items([(r["name"], r["t"]) for r in named.collect()], width), spans)
    return _scan_once(df, text, named, width, spans)


def contaminated() -> Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(df: DataFrame, text: str, benchmark: DataFrame, item: str, item_text: str) -> DataFrame:
    """The rows of ``df`` that are not contaminated, with the columns they came with."""
    held = {}
    for name in (c for c in ADDED if c in df.columns):
        held[name] = free_name(df, f"held_{name}")
    back = {new: old for old, new in held.items()}
    found = find_contamination(df.withColumnsRenamed(held), held.get(text, text), benchmark, item, item_text, spans=False)
    return found.where(~contaminated()).drop(*ADDED).withColumnsRenamed(back).select(*(f"`{c}`" for c in df.columns))


def cut_contamination(df: DataFrame, text: str, benchmark: DataFrame, item: str, item_text: str) -> DataFrame:
    """``df`` with the hit passages removed from ``text``; other columns as of ``find_contamination``."""
    found = find_contamination(df, text, benchmark, item, item_text)
    column = F.col(f"`{text}`")
    start = F.lit(0).alias("at")
    pieces = F.aggregate(
        "hit_spans",
        F.struct(F.lit("").alias("kept"), start),
        lambda s, r: F.struct(
            F.concat(s["kept"], F.substring(column, s["at"] + 1, r["start"] - s["at"])).alias("kept"), r["end"].alias("at")
        ),
        lambda s: F.concat(s["kept"], F.substring(column, s["at"] + 1, F.char_length(column))),
    )
    return found.withColumn(text, F.when(F.size("hit_spans") > 0, pieces).otherwise(column))
