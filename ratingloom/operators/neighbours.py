"""Exact top-n neighbours by blocked products, in the order of falling norms.

Both sides are cut into blocks of bounded size, and every pair of blocks is one group. A group multiplies two
blocks and returns at most n rows per query, so no product of all pairs is ever shuffled or stored; the block
results are merged by a ranked window.

No dot product with a vector exceeds the product of the norms. The corpus is therefore ordered by norm: a group takes
its block chunk by chunk, and blocks are visited in rounds of one, two, four and more; a query whose n-th score is above
what the norms ahead allow leaves, and is sent to no further block.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.operators.ordering import global_rank
from ratingloom.operators.signature_blocks import block_rows
from ratingloom.operators.topk import SCORE_SCALE, score_key, with_rank
from ratingloom.staging import broadcast_if_small, stage

BLOCK_BYTES = 32 * 1024 * 1024  # vectors of one block
CHUNK_CELLS = 4_000_000  # scores held at once inside a task
CHUNK_ROWS = 1024  # corpus rows between two looks at the bounds
SLACK = 1e-9  # relative, for the rounding of norms and products

PRODUCTS = "qid long, cid long, score double"


def _best_of_block(kernel: str, n: int, cells: int, chunk: int, scale: float, slack: float):
    """Function from two blocks to the n best corpus rows of every query.

    Everything it calls is defined inside, so that workers need no copy of this package.
    """

    def dot(queries: list[np.ndarray], corpus: list[np.ndarray]):
        left, right = np.vstack(queries).astype(np.float64), np.vstack(corpus).astype(np.float64)
        norms = [np.sqrt((side * side).sum(axis=1)) for side in (left, right)]
        return lambda rows, columns: left[rows] @ right[columns].T, *norms

    def set_cosine(queries: list[np.ndarray], corpus: list[np.ndarray]):
        # Cosine of 0/1 vectors given as lists of set positions; the small term keeps empty sets at 0.
        owners = np.repeat(np.arange(len(corpus)), [len(c) for c in corpus])
        members = np.concatenate(corpus) if len(owners) else np.empty(0, dtype=np.int64)
        norm = np.sqrt(np.array([len(c) or 1 for c in corpus], dtype=np.float64))
        # Only members of this block become dense columns; the block is sized for them.
        names, at = np.unique(members, return_inverse=True)
        right = np.zeros((len(names), len(corpus)))
        right[at, owners] = 1.0

        def scores(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
            part = [queries[i] for i in rows.tolist()]
            own = np.sqrt(np.array([len(p) for p in part], dtype=np.float64))
            left = np.zeros((len(part), len(names)))
            values = np.concatenate(part) if part else np.empty(0)
            if len(names) and len(values):
                row = np.repeat(np.arange(len(part)), [len(p) for p in part])
                place = np.minimum(np.searchsorted(names, values), len(names) - 1)
                known = names[place] == values
                left[row[known], place[known]] = 1.0
            return (left @ right[:, columns]) / (own[:, None] * norm[None, columns] + 1e-8)

        return scores, np.ones(len(queries)), np.ones(len(corpus))

    kernel_of = {"dot": dot, "set_cosine": set_cosine}[kernel]

    def best(queries: pd.DataFrame, corpus: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or corpus.empty:
            return pd.DataFrame({"qid": [], "cid": [], "score": []}).astype({"qid": "int64", "cid": "int64"})
        scores, query_norm, norm = kernel_of(list(queries["qvec"]), list(corpus["cvec"]))
        ids = corpus["cid"].to_numpy()
        skipped = list(queries["skip"])
        bound = queries["bound"].to_numpy().astype(np.float64)
        qids = queries["qid"].to_numpy()
        falling = np.argsort(-norm, kind="stable")
        chunks = [falling[i : i + chunk] for i in range(0, len(ids), chunk)]
        step = max(1, cells // min(chunk, len(ids)))
        out = []
        for start in range(0, len(queries), step):
            stop = min(start + step, len(queries))
            size = stop - start
            best_key, best_id = np.full((size, n), -np.inf), np.full((size, n), -1, dtype=np.int64)
            best_score = np.zeros((size, n))
            least = bound[start:stop].copy()
            live = np.arange(size)
            sizes = [0 if s is None else len(s) for s in skipped[start:stop]]
            owner = np.repeat(np.arange(size), sizes)
            skip = np.concatenate([np.asarray(s) for s, m in zip(skipped[start:stop], sizes) if m]) if sum(sizes) else np.empty(0, np.int64)
            for columns in chunks:
                allowed = np.floor(query_norm[start + live] * norm[columns[0]] * (1 + slack) * scale + 1.5)
                live = live[allowed >= least[live]]
                if not len(live):
                    break
                columns = columns[np.argsort(-ids[columns], kind="stable")]  # equal scores: higher id first
                block = scores(start + live, columns)
                keys = np.floor(block * scale + 0.5)
                if len(skip):
                    rising = ids[columns][::-1]
                    at = np.minimum(np.searchsorted(rising, skip), len(rising) - 1)
                    place = np.full(size, -1)
                    place[live] = np.arange(len(live))
                    here = (rising[at] == skip) & (place[owner] >= 0)
                    keys[place[owner[here]], len(rising) - 1 - at[here]] = -np.inf
                wanted = (keys >= least[live, None]) & (keys > -np.inf)
                crowded = np.flatnonzero(wanted.sum(axis=1) > n)
                if len(crowded):
                    own = keys[crowded]
                    top = -np.partition(-own, n - 1, axis=1)[:, n - 1 : n]
                    above, tied = own > top, own == top
                    places = n - above.sum(axis=1, keepdims=True)
                    wanted[crowded] &= above | tied & (np.cumsum(tied, axis=1) <= places)
                row, column = np.nonzero(wanted)
                if not len(row):
                    continue
                touched = np.unique(row)
                # the best so far of each row that has new ones, with these
                held = live[touched]
                line = np.concatenate([np.repeat(held, n), live[row]])
                key = np.concatenate([best_key[held].ravel(), keys[row, column]])
                cid = np.concatenate([best_id[held].ravel(), ids[columns[column]]])
                score = np.concatenate([best_score[held].ravel(), block[row, column]])
                order = np.lexsort((-cid, -key, line))
                line, key, cid, score = line[order], key[order], cid[order], score[order]
                first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
                rank = np.arange(len(line)) - np.repeat(first, np.diff(np.append(first, len(line))))
                kept = rank < n
                line, rank = line[kept], rank[kept]
                best_key[line, rank], best_id[line, rank], best_score[line, rank] = key[kept], cid[kept], score[kept]
                least[held] = np.maximum(least[held], best_key[held, n - 1])
            row, column = np.nonzero(best_key > -np.inf)
            out.append(pd.DataFrame({"qid": qids[start + row], "cid": best_id[row, column], "score": best_score[row, column]}))
        return pd.concat(out)

    return lambda queries, corpus: best(queries[["qid", "qvec", "skip", "bound"]], corpus[["cid", "cvec"]])


def _block_count(rows: int, width: int, parallel: int) -> int:
    """Blocks that keep a block within its byte bound, and enough of them to use the cluster."""
    by_size = -(-rows * max(width, 1) * 8 // BLOCK_BYTES)
    by_cores = min(parallel, -(-rows // 512))
    return max(1, by_size, by_cores)


def _norm(vector: str) -> Column:
    squares = F.transform(vector, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def blocked_top_n(
    queries: DataFrame,
    corpus: DataFrame,
    n: int,
    width: int,
    kernel: str = "dot",
    exclude: DataFrame | None = None,
    exclude_self: bool = False,
    rows: int | None = None,
    visits: Callable[[int, int], None] = lambda queries, blocks: None,
) -> DataFrame:
    """``(qid, cid, score, rank)``: the n best corpus rows of every query.

    ``queries`` ``(qid, qvec)`` and ``corpus`` ``(cid, cvec)`` are stored tables with unique ids,
    ``width`` the usual vector length, ``exclude`` distinct pairs ``(qid, cid)`` to leave out,
    ``rows`` at most so many rows in a block. ``visits`` is told, for each round, how many queries met how
    many blocks.
    """
    parallel = queries.sparkSession.sparkContext.defaultParallelism
    n_corpus, n_queries = corpus.count(), queries.count()
    n_blocks = _block_count(n_corpus, width, 1)
    if rows:
        n_blocks = max(n_blocks, -(-n_corpus // rows))
    per_block = max(1, -(-n_corpus // n_blocks))
    rounds = n_blocks > 1 and kernel == "dot"
    if rounds:
        ordered = global_rank(corpus.select("cid", "cvec", _norm("cvec").alias("norm")), F.desc("norm"), F.desc("cid"), name="pos")
        placed = stage(ordered.select("cid", "cvec", "norm", F.expr(f"(pos - 1) div {per_block}").alias("cb")), "blocks")
        active = stage(queries.select("qid", "qvec", _norm("qvec").alias("norm"), F.lit(float("-inf")).alias("bound")), "queries")
    else:
        placed = corpus.select("cid", "cvec", F.pmod(F.xxhash64("cid"), F.lit(n_blocks)).alias("cb"))
        active = queries.select("qid", "qvec", F.lit(float("-inf")).alias("bound"))
    block_of = placed.select("cid", "cb")
    done: list[DataFrame] = []
    at, step = 0, 1 if rounds else n_blocks
    while True:
        to = min(n_blocks, at + step)
        visits(n_queries, to - at)
        n_q = _block_count(n_queries, width, parallel)
        if rows:
            n_q = max(n_q, -(-n_queries // rows))
        every = lambda first, last: F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last - 1).cast("long")))
        q_block = F.pmod(F.xxhash64("qid"), F.lit(n_q)).alias("qb")
        left = active.select("qid", "qvec", "bound", q_block, every(at, to).alias("cb"))
        here = placed if to - at == n_blocks else placed.where(F.col("cb").between(at, to - 1))
        right = here.select("cid", "cvec", "cb", every(0, n_q).alias("qb"))
        if exclude is not None:
            # Bounded: per query at most the ids of one corpus block.
            pairs = exclude.select("qid", "cid")
            if rounds:
                near = broadcast_if_small(block_of.where(F.col("cb").between(at, to - 1)))
                pairs = pairs.join(near, "cid").join(active.select("qid"), "qid", "left_semi")
            else:
                pairs = pairs.withColumn("cb", F.pmod(F.xxhash64("cid"), F.lit(n_blocks)))
            left = left.join(pairs.groupBy("qid", "cb").agg(F.collect_list("cid").alias("skip")), ["qid", "cb"], "left")
        else:
            left = left.withColumn("skip", F.array("qid") if exclude_self else F.lit(None).cast("array<long>"))
        work = _best_of_block(kernel, n, CHUNK_CELLS, CHUNK_ROWS, SCORE_SCALE, SLACK)
        best = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(work, PRODUCTS)
        if not rounds:
            done.append(best)
            break
        done.append(stage(best, "products"))
        if to == n_blocks:
            break
        ahead = placed.where(F.col("cb") == to).agg(F.max("norm")).first()[0]
        found = _merged(done, n).groupBy("qid").agg(F.count("*").alias("n"), F.min("_key").cast("double").alias("key"))
        bound = F.when(F.col("n") == n, F.col("key")).otherwise(float("-inf")).alias("bound")
        bounded = active.drop("bound").join(found, "qid", "left").select("qid", "qvec", "norm", F.coalesce(bound, F.lit(float("-inf"))).alias("bound"))
        allowed = score_key(F.col("norm") * (ahead * (1 + SLACK))) + 1
        active = stage(bounded.where(allowed >= F.col("bound")), "queries")
        n_queries = active.count()
        if not n_queries:
            break
        at, step = to, 2 * step
    return _merged(done, n).select("qid", "cid", "score", "rank")


def count_above(queries: DataFrame, corpus: DataFrame, width: int) -> DataFrame:
    """``(qid, above)``: how many corpus rows have a product above ``limit`` with the query ``(qid, qvec, limit)``, by all
    products; it proves lists that were found by bounds."""
    parallel = queries.sparkSession.sparkContext.defaultParallelism
    n_q, n_c = _block_count(queries.count(), width, parallel), _block_count(corpus.count(), width, 1)
    step = max(1, CHUNK_CELLS * width * 8 // BLOCK_BYTES)

    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"qid": [], "above": []}).astype("int64")
        a, b = (np.vstack(list(side)).astype(np.float64) for side in (left["qvec"], right["cvec"]))
        limit = left["limit"].to_numpy()
        found = [(a[i : i + step] @ b.T > limit[i : i + step, None]).sum(axis=1) for i in range(0, len(a), step)]
        return pd.DataFrame({"qid": left["qid"].to_numpy(), "above": np.concatenate(found)})

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    left = queries.select("qid", "qvec", "limit", part("qid", n_q).alias("qb"), every(n_c).alias("cb"))
    right = corpus.select("cid", "cvec", part("cid", n_c).alias("cb"), every(n_q).alias("qb"))
    counted = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(count, "qid long, above long")
    return counted.groupBy("qid").agg(F.sum("above").alias("above"))


def _merged(parts: list[DataFrame], n: int) -> DataFrame:
    keyed = reduce(DataFrame.unionByName, parts).withColumn("_key", score_key(F.col("score")))
    return with_rank(keyed, ["qid"], [F.desc("_key"), F.desc("cid")], n)


def similar_by_dot(
    vectors: DataFrame,
    width: int,
    n: int = 10,
    vec_id: str = "id",
    vector: str = "vector",
    items: DataFrame | None = None,
) -> DataFrame:
    """``(item_idx, similar_idx, similarity, rank)`` by raw dot product, without the row itself.

    ``items`` ``(item_idx)`` limits for which rows neighbours are wanted.
    """
    queries = vectors.select(F.col(vec_id).cast("long").alias("qid"), F.col(vector).alias("qvec"))
    corpus = vectors.select(F.col(vec_id).cast("long").alias("cid"), F.col(vector).alias("cvec"))
    if items is not None:
        wanted = items.select(F.col("item_idx").alias("qid"))
        queries = stage(queries.join(wanted, "qid", "left_semi"), "query-vectors")
    found = blocked_top_n(queries, corpus, n, width, exclude_self=True)
    return found.select(
        F.col("qid").alias("item_idx"), F.col("cid").alias("similar_idx"), F.col("score").alias("similarity"), "rank"
    )


def similar_by_genre(items: DataFrame, index, n: int = 10) -> DataFrame:
    """``(item_idx, similar_idx, similarity, rank)`` by cosine of genre sets; ties go to the higher index.

    Neighbours are found between signatures, represented by their highest item. The first n + 1
    items of the n + 1 nearest signatures hold every item's answer.
    """
    members = index.item_signatures
    top = members.groupBy("sig").agg(F.max("item_idx").alias("rep"))
    described = top.join(index.signatures, "sig").select("rep", "genre_ids")
    described = stage(described, "signature-sets")
    reps = stage(top, "signature-reps")
    longest = index.signatures.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]
    near = blocked_top_n(
        described.select(F.col("rep").alias("qid"), F.col("genre_ids").alias("qvec")),
        described.select(F.col("rep").alias("cid"), F.col("genre_ids").alias("cvec")),
        n + 1,
        max(longest, 1),
        kernel="set_cosine",
        rows=block_rows(index.vocabulary.count(), longest),
    )
    first = with_rank(members, ["sig"], [F.desc("item_idx")], n + 1, name="_pos")
    wanted = (
        near.join(reps.select(F.col("rep").alias("qid"), F.col("sig").alias("sig_of")), "qid")
        .join(reps.select(F.col("rep").alias("cid"), "sig"), "cid")
        .select("sig_of", "sig", F.col("score").alias("similarity"))
    )
    entries = wanted.join(first.select("sig", F.col("item_idx").alias("similar_idx")), "sig")
    order = [F.desc(score_key(F.col("similarity"))), F.desc("similar_idx")]
    lists = stage(
        with_rank(entries, ["sig_of"], order, n + 1, name="_at").select("sig_of", "similar_idx", "similarity", "_at"),
        "signature-neighbours",
    )
    mine = items.select("item_idx").join(members, "item_idx").withColumnRenamed("sig", "sig_of")
    listed = mine.join(lists, "sig_of")
    # An item is in its own list at most once; entries behind it move up by one.
    own = lists.select("sig_of", F.col("similar_idx").alias("item_idx"), F.col("_at").alias("_own"))
    placed = listed.join(own, ["sig_of", "item_idx"], "left").where(
        F.col("item_idx") != F.col("similar_idx")
    )
    rank = F.col("_at") - F.coalesce((F.col("_at") > F.col("_own")).cast("int"), F.lit(0))
    return (
        placed.withColumn("rank", rank).where(F.col("rank") <= n).select("item_idx", "similar_idx", "similarity", "rank")
    )
