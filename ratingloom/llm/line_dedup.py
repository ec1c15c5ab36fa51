"""Removal of lines that many documents share, in DataFrame functions only.

A line's key is the line without white space at both ends, A-Z in lower case. The lines of all documents
are exploded as hashes of their keys and counted:

1. rows by 64-bit hash, each document giving a hash once, so counts combine in the map tasks;
2. for hashes that reach the threshold, distinct documents by 128 bits of hash, so that no two keys meet;
3. the places of the lines to drop, grouped by document into a mask of one byte a line.

Only then are texts moved, once, to meet their masks, and the lines that stay are joined in their order. A document
is known by its id and its text's hash, which a repeated task finds again; rows equal in both lose the same lines.

Nothing is collected: a line that every document holds is one row per document in step 2, dealt by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratingloom import staging
from ratingloom.llm.text import free_name

THRESHOLD = 10
LEAST_CHARS = 1
BROADCAST_KEYS = 200_000  # rows of three longs

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP = "1"


def lines(text: Column) -> Column:
    """Null and empty texts have one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def _prints(text: Column, least_chars: int) -> Column:
    """128 bits of hash by line, null where the key is too short."""
    keys = F.transform(lines(text), line_key)
    pair = lambda key: F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))
    return F.transform(keys, lambda key: F.when(F.char_length(key) >= least_chars, pair(key)))


def shared_lines(prints: DataFrame, threshold: int) -> DataFrame:
    """Stored hashes ``a``, ``b`` of the keys in at least ``threshold`` documents. ``prints``: a stored table of
    ``id`` and the array ``prints`` by document."""
    first = prints.select(F.explode(F.array_distinct(F.transform("prints", lambda p: p["a"]))).alias("a")).where("a IS NOT NULL")
    # rows of one document count once here, but two rows may be one document: an upper bound
    often = staging.stage(first.groupBy("a").count().where(F.col("count") >= threshold).select("a"), "often")
    both = prints.select("id", F.explode("prints").alias("p")).select("id", "p.a", "p.b")
    met = both.join(staging.broadcast_if_small(often, BROADCAST_KEYS), "a", "left_semi")
    documents = met.distinct().groupBy("a", "b").count()
    return staging.stage(documents.where(F.col("count") >= threshold).select("a", "b"), "shared")


def drop_shared_lines(
    df: DataFrame, key: str, text: str, threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """``df`` with ``text`` less all lines whose key has ``least_chars`` code points and stands in ``threshold``
    distinct documents, and with ``n_lines`` (before) and ``n_dropped``.

    A null text is read as empty and becomes empty; a text that loses all lines becomes empty. Rows with the same
    ``key`` are one document when documents are counted, null keys together; each row keeps its place as a row.
    Other columns are kept, those called ``n_lines`` or ``n_dropped`` are replaced. An empty table gives none.
    """
    print_name, mask = free_name(df, "text_print"), free_name(df, "mask")
    added = [F.struct(df[f"`{key}`"].alias("id")).alias("id"), F.xxhash64(df[f"`{text}`"].cast("string")).alias("t")]
    prints = staging.stage(df.select(*added, _prints(df[f"`{text}`"], least_chars).alias("prints")), "prints")
    shared = staging.broadcast_if_small(shared_lines(prints, threshold), BROADCAST_KEYS)
    places = prints.select("id", "t", F.posexplode("prints").alias("place", "p")).where("p IS NOT NULL")
    hits = places.select("id", "t", "place", "p.a", "p.b").join(shared, ["a", "b"], "left_semi")
    masks = hits.groupBy("id", "t").agg(F.array_sort(F.collect_set("place")).alias("places"))
    # from places to bytes, which are reached by position at no cost
    gap = lambda p, i: F.repeat(F.lit("0"), p - F.when(i == 0, -1).otherwise(F.get("places", i - 1)) - 1)
    masks = masks.select(
        "id", "t", F.encode(F.array_join(F.transform("places", lambda p, i: F.concat(gap(p, i), F.lit(DROP))), ""), "UTF-8").alias(mask)
    )
    kept = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    keyed = df.withColumn(print_name, F.xxhash64(df[f"`{text}`"].cast("string")))
    same = (F.struct(keyed[f"`{key}`"].alias("id")) == masks["id"]) & (keyed[print_name] == masks["t"])
    met = keyed.join(masks, same, "left")
    all_lines = lines(keyed[f"`{text}`"])
    bit = lambda i: F.substring(masks[mask], i + 1, F.lit(1))
    stay = F.filter(all_lines, lambda line, i: F.coalesce(bit(i) != F.encode(F.lit(DROP), "UTF-8"), F.lit(True)))
    kept_text = F.array_join(stay, "\n")
    columns = [kept_text.alias(c) if c == text else keyed[f"`{c}`"] for c in kept]
    n_lines = F.size(all_lines).cast("long")
    dropped = F.coalesce(F.regexp_count(F.decode(masks[mask], "UTF-8"), F.lit(DROP)), F.lit(0)).cast("long")
    return met.select(*columns, n_lines.alias("n_lines"), dropped.alias("n_dropped"))
