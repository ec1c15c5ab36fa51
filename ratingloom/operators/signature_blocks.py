"""Most promising genre signatures per user, by a scan in the order of a bound.

Users and signatures are cut into blocks of bounded size; every pair of blocks is one group. It takes its signatures by
falling popularity, a chunk at a time. No content score exceeds what a user's strongest preferences give, so the popularity
of the next signature bounds all blended scores ahead: a user who has k better ones that are wholly unseen leaves the
scan. Only signatures that can still matter are returned, so the rows of all users times all signatures never exist.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ratingloom.operators.topk import SCORE_SCALE

USER_BLOCK = 8192  # users per block
SIGNATURE_BLOCK = 16_384  # signatures per block
TABLE_BYTES = 64 * 1024 * 1024  # dense table of a block's sets and their members
CHUNK_CELLS = 2_000_000  # scores held at once inside a task
CHUNK_SIGNATURES = 256  # between two looks at the bounds
FOUND = "user_idx long, sig long, content double, touched int"


def _promising(k: int, weight: float, cells: int, chunk: int, scale: float):
    """Function from a user block and a signature block to candidate rows; needs no package on workers."""

    def flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(row of every value, value)."""
        sizes = [0 if v is None else len(v) for v in lists]
        values = [v for v in lists if v is not None and len(v)]
        return np.repeat(np.arange(len(lists)), sizes), np.concatenate(values) if values else np.empty(0)

    def most_content(prefs: list[np.ndarray]) -> np.ndarray:
        """The largest content score any set of genres can have for each user: that of the strongest ones."""
        out = np.zeros(len(prefs))
        for i, own in enumerate(prefs):
            falling = np.sort(np.maximum(own, 0.0))[::-1]
            out[i] = (np.cumsum(falling) / np.sqrt(np.arange(1, len(falling) + 1))).max(initial=0.0)
        return out * (1 + 1e-9)

    def find(users: pd.DataFrame, signatures: pd.DataFrame) -> pd.DataFrame:
        if users.empty or signatures.empty:
            return pd.DataFrame({"user_idx": [], "sig": [], "content": [], "touched": []})
        signatures = signatures.sort_values("place")  # by falling popularity; equal keys: lower place first
        sig = signatures["sig"].to_numpy()
        by_sig = np.argsort(sig)
        popularity = weight * signatures["score"].to_numpy()
        ahead_of = np.maximum.accumulate(popularity[::-1])[::-1]  # the largest from here on
        root = np.sqrt(signatures["size"].to_numpy())
        owner, member = flat(list(signatures["genre_ids"]))
        # Only genres of this block become dense columns; the block is sized for them.
        columns, at = np.unique(member, return_inverse=True)
        right = np.zeros((len(columns), len(sig)))
        right[at, owner] = 1.0
        out = []
        step = max(1, cells // max(min(chunk, len(sig)), len(columns)))
        for start in range(0, len(users), step):
            part = users.iloc[start : start + step]
            row, genre = flat(list(part["genres"]))
            pref = np.concatenate(list(part["prefs"]))
            at = np.minimum(np.searchsorted(columns, genre), len(columns) - 1)
            known = columns[at] == genre
            left = np.zeros((len(part), len(columns)))
            left[row[known], at[known]] = pref[known]
            most = most_content(list(part["prefs"]))
            seen_row, seen = flat(list(part["touched"]))
            at = by_sig[np.minimum(np.searchsorted(sig, seen, sorter=by_sig), len(sig) - 1)]
            same = sig[at] == seen
            seen_row, seen_at = seen_row[same], at[same]
            live, best = np.arange(len(part)), np.full((len(part), k), -np.inf)  # untouched ones, falling
            found = []
            for begin in range(0, len(sig), chunk):
                bound = np.floor((ahead_of[begin] + (1 - weight) * most[live]) * scale + 1.5)
                live = live[bound >= best[live, k - 1]]
                if not len(live):
                    break
                end = min(begin + chunk, len(sig))
                content = (left[live] @ right[:, begin:end]) / root[begin:end]
                key = np.floor((popularity[begin:end] + (1 - weight) * content) * scale + 0.5)
                key[content <= 0] = -np.inf
                place = np.full(len(part), -1)
                place[live] = np.arange(len(live))
                here = (seen_at >= begin) & (seen_at < end) & (place[seen_row] >= 0)
                touched = np.zeros(key.shape, dtype=bool)
                touched[place[seen_row[here]], seen_at[here] - begin] = True
                r, c = np.nonzero((key >= best[live, k - 1 : k]) & (key > -np.inf))
                found.append((live[r], begin + c, key[r, c], content[r, c], touched[r, c]))
                free = np.concatenate([best[live], np.where(touched, -np.inf, key)], axis=1)
                best[live] = -np.sort(np.partition(-free, k - 1, axis=1)[:, :k], axis=1)
            if not found:
                continue
            row, column, key, content, touched = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((column, -key, row))
            row, column, content, touched = row[order], column[order], content[order], touched[order]
            # What k untouched signatures precede cannot matter.
            free = np.cumsum(~touched) - ~touched
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, int)
            ahead = free - np.repeat(free[first], np.diff(np.append(first, len(row))))
            wanted = ahead < k
            ids = part["user_idx"].to_numpy()
            out.append(
                pd.DataFrame(
                    {
                        "user_idx": ids[row[wanted]],
                        "sig": sig[column[wanted]],
                        "content": content[wanted],
                        "touched": touched[wanted].astype("int32"),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame({"user_idx": [], "sig": [], "content": [], "touched": []})

    return find


def block_rows(vocabulary: int, longest: int, most: int = SIGNATURE_BLOCK, table_bytes: int = TABLE_BYTES) -> int:
    """Sets per block whose dense table of members fits ``table_bytes``: its columns are members of the
    block's sets, so there are ``vocabulary`` at most, and at most ``longest`` for each set."""
    cells = table_bytes // 8
    return max(1, min(most, max(cells // max(vocabulary, 1), int((cells / max(longest, 1)) ** 0.5))))


def promising_signatures(
    prefs: DataFrame, touched: DataFrame, signatures: DataFrame, k: int, weight: float, n_users: int
) -> DataFrame:
    """``(user_idx, sig, content, touched)``: signatures sharing a genre that k untouched ones do not all precede.

    ``prefs`` ``(user_idx, genre_idx, pref)``, ``touched`` ``(user_idx, sig)`` signatures with a seen
    item, ``signatures`` stored ``(sig, genre_ids, size, score, place)`` with score and place of the best item, and
    ``n_users`` the number of users, which only sets the number of blocks. The result may hold a few rows more
    than needed, since blocks do not know each other's bounds, but at most k untouched ones per user and block.
    """
    wishes = F.sort_array(F.collect_list(F.struct("genre_idx", "pref")))  # at most the vocabulary
    users = prefs.groupBy("user_idx").agg(wishes.alias("w"))
    users = users.select("user_idx", F.col("w.genre_idx").alias("genres"), F.col("w.pref").alias("prefs"))
    parallel = users.sparkSession.sparkContext.defaultParallelism
    n_u = max(1, -(-n_users // USER_BLOCK), min(parallel, -(-n_users // 512)))
    members = F.explode("genre_ids").alias("g")
    size = signatures.agg(F.count("*").alias("n"), F.coalesce(F.max("size"), F.lit(0)).alias("longest")).first()
    vocabulary = signatures.select(members).distinct().count()
    n_s = max(1, -(-size["n"] // block_rows(vocabulary, size["longest"])))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    block = F.pmod("sig", F.lit(n_s)).cast("int").alias("sb")
    marks = touched.select("user_idx", "sig", block).groupBy("user_idx", "sb").agg(F.collect_list("sig").alias("touched"))
    left = users.select("*", F.pmod(F.xxhash64("user_idx"), F.lit(n_u)).cast("int").alias("ub"), every(n_s).alias("sb"))
    left = left.join(marks, ["user_idx", "sb"], "left")
    right = signatures.select("sig", "genre_ids", "size", "score", "place", block, every(n_u).alias("ub"))
    find = _promising(k, weight, CHUNK_CELLS, CHUNK_SIGNATURES, SCORE_SCALE)
    return left.groupBy("ub", "sb").cogroup(right.groupBy("ub", "sb")).applyInPandas(find, FOUND)
