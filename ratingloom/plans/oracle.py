"""SQL equivalents of the registered queries, for a single-node check.

Each statement is written out from shared common table expressions and takes the direct
route: full sorts, products of users and items, and window ranks.
"""

from __future__ import annotations

import re

ORDERS = """
raw AS (
  SELECT o_custkey AS "userId", l_partkey AS "movieId", ceil(l_quantity / 5) / 2 AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RAW = """
raw AS (
  SELECT o_custkey AS "userId", l_partkey AS "movieId",
         CASE WHEN (o_custkey + l_partkey) % 41 = 0 THEN NULL WHEN (o_custkey + l_partkey) % 43 = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE ceil(l_quantity / 5) / 2 END AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RAW_ITEMS = """
raw_items AS (
  SELECT p_partkey AS "movieId",
         CASE WHEN p_partkey % 17 = 0 THEN p_name ELSE concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') END AS title,
         CASE WHEN p_partkey % 23 = 0 THEN '(no genres listed)' ELSE concat(p_type, '|', replace(p_name, ' ', '|')) END AS genres
  FROM part WHERE p_partkey % 29 <> 0)"""


def _latest(low: float, high: float) -> str:
    return f"""
  SELECT "userId", "movieId", rating, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY "userId", "movieId" ORDER BY "timestamp" DESC, rating DESC) AS rn
    FROM raw WHERE rating BETWEEN {low} AND {high}) WHERE rn = 1"""


INTER = f"""
inter AS MATERIALIZED (
  SELECT "userId" AS user_id, "movieId" AS item_id, rating, "timestamp" FROM ({_latest(0.5, 5.0)}))"""

ITEMS = r"""
items AS (
  SELECT "movieId" AS item_id, title, genres,
         TRY_CAST(nullif(regexp_extract(title, '\((\d{4})\)$', 1), '') AS INTEGER) AS year,
         regexp_replace(title, '\s*\(\d{4}\)$', '') AS title_clean
  FROM raw_items)"""


def _core(source: str, m: int, n: int, rounds: int) -> str:
    """Unrolled rounds; extra rounds after the fixed point change nothing."""
    parts, last = [], source
    for r in range(rounds):
        parts.append(f"""
core{r} AS MATERIALIZED (
  SELECT t.* FROM {last} t
  WHERE user_id IN (SELECT user_id FROM {last} GROUP BY user_id HAVING count(*) >= {m})
    AND item_id IN (SELECT item_id FROM {last} GROUP BY item_id HAVING count(*) >= {n}))""")
        last = f"core{r}"
    parts.append(f"\ncored AS (SELECT * FROM {last})")
    return ",".join(parts)


def _split(source: str, train: float, val: float, order: str) -> str:
    return f"""
ordered AS (
  SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS pos, count(*) OVER () AS n FROM {source}),
labelled AS MATERIALIZED (
  SELECT user_id, item_id, rating, "timestamp",
         CASE WHEN pos < floor(n * CAST({train} AS DOUBLE)) THEN 'train'
              WHEN pos < floor(n * (CAST({train} AS DOUBLE) + CAST({val} AS DOUBLE))) THEN 'val'
              ELSE 'test' END AS split
  FROM ordered),
train AS MATERIALIZED (SELECT user_id, item_id, rating, "timestamp" FROM labelled WHERE split = 'train')"""


TIME_ORDER = '"timestamp", user_id, item_id'


def _hash_order(seed: int) -> str:
    text = f"concat('{seed}#', CAST(user_id AS VARCHAR), '#', CAST(item_id AS VARCHAR))"
    return f"substr(md5({text}), 1, 15), user_id, item_id"


ENCODERS = """
users AS MATERIALIZED (
  SELECT user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM (SELECT DISTINCT user_id FROM train)),
item_ids AS MATERIALIZED (
  SELECT item_id AS id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM (SELECT DISTINCT item_id FROM train)),
encoded AS MATERIALIZED (
  SELECT l.*, u.idx AS user_idx, i.idx AS item_idx
  FROM labelled l JOIN users u ON l.user_id = u.id JOIN item_ids i ON l.item_id = i.id),
matrix AS MATERIALIZED (
  SELECT user_idx, item_idx, sum(rating) AS value FROM encoded WHERE split = 'train' GROUP BY ALL),
test AS MATERIALIZED (
  SELECT user_idx, item_idx, sum(rating) AS value FROM encoded WHERE split = 'test' GROUP BY ALL)"""

SCORES = """
totals AS (
  SELECT i.idx AS item_idx, coalesce(sum(m.value), 0) AS total
  FROM item_ids i LEFT JOIN matrix m ON m.item_idx = i.idx GROUP BY i.idx),
scores AS MATERIALIZED (
  SELECT item_idx, total, total / (SELECT max(total) FROM totals) AS score FROM totals)"""

GENRES = """
item_genres AS MATERIALIZED (
  SELECT DISTINCT i.idx AS item_idx, trim(g.genre) AS genre
  FROM item_ids i JOIN (SELECT item_id, unnest(string_split(genres, '|')) AS genre FROM items WHERE genres <> '(no genres listed)') g ON g.item_id = i.id),
sizes AS (SELECT item_idx, count(*) AS size FROM item_genres GROUP BY item_idx)"""

PREFS = """
raw_prefs AS (
  SELECT user_idx, genre, sum(greatest(0, (value - 2.5) / 2.5)) AS weight
  FROM matrix JOIN item_genres USING (item_idx) WHERE value > 0 GROUP BY ALL),
prefs AS MATERIALIZED (
  SELECT user_idx, genre, weight / sqrt(sum(weight * weight) OVER (PARTITION BY user_idx)) AS pref
  FROM raw_prefs WHERE weight > 0)"""

HYBRID = """
content AS MATERIALIZED (
  SELECT user_idx, item_idx, sum(pref) / sqrt(max(size)) AS content
  FROM prefs JOIN item_genres USING (genre) JOIN sizes USING (item_idx) GROUP BY ALL),
blended AS (
  SELECT u.idx AS user_idx, s.item_idx, s.total,
         0.6e0 * s.score + (1 - 0.6e0) * coalesce(c.content, 0) AS score
  FROM users u CROSS JOIN scores s
  LEFT JOIN content c ON c.user_idx = u.idx AND c.item_idx = s.item_idx)"""


def _top(source: str, name: str, k: int, unseen: bool = True, users: str = "") -> str:
    """First k rows per user of scored pairs."""
    conditions = ["NOT EXISTS (SELECT 1 FROM matrix m WHERE m.user_idx = b.user_idx AND m.item_idx = b.item_idx)"] if unseen else []
    if users:
        conditions.append(f"b.user_idx IN ({users})")
    where = f"WHERE {' AND '.join(conditions)}" if conditions else ""
    return f"""
{name} AS MATERIALIZED (
  SELECT user_idx, item_idx, score, rank FROM (
    SELECT user_idx, item_idx, score, CAST(row_number() OVER (
      PARTITION BY user_idx ORDER BY round(score, 9) DESC, total DESC, item_idx DESC) AS INTEGER) AS rank
    FROM {source} b {where}) WHERE rank <= {k})"""


PLAIN = """
plain AS (
  SELECT u.idx AS user_idx, s.item_idx, s.total, s.score FROM users u CROSS JOIN scores s)"""

RELEVANT = """
graded AS MATERIALIZED (SELECT user_idx AS "user", item_idx AS item, value AS grade FROM test WHERE value >= 3.5),
relevant AS (SELECT "user", item FROM graded)"""

USERS_WITH_TEST = 'SELECT "user" FROM relevant'

PAIRS = """
pairs AS (
  SELECT t.rating AS y_true, s.mean AS y_pred
  FROM labelled t JOIN (SELECT item_id, avg(rating) AS mean FROM train GROUP BY item_id) s USING (item_id)
  WHERE t.split = 'test')"""


def _per_user(lists: str, k_values: tuple[int, ...]) -> str:
    columns = []
    for k in k_values:
        ideal = f"(SELECT sum(1 / log2(r + 1)) FROM range(1, {k + 1}) t(r) WHERE r <= n_relevant)"
        columns.append(f"""
         coalesce(count(*) FILTER (hit AND rank <= {k}), 0) / {k} AS precision_at_{k},
         coalesce(count(*) FILTER (hit AND rank <= {k}), 0) / n_relevant AS recall_at_{k},
         coalesce(sum(1 / log2(rank + 1)) FILTER (hit AND rank <= {k}), 0) / {ideal} AS ndcg_at_{k},
         coalesce(sum(running / rank) FILTER (hit AND rank <= {k}), 0) / least(n_relevant, {k}) AS map_at_{k}""")
    return f"""
counts AS (SELECT "user", count(*) AS n_relevant FROM relevant GROUP BY "user"),
marked AS (
  SELECT c."user", c.n_relevant, l.rank, r.item IS NOT NULL AS hit,
         sum(CASE WHEN r.item IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY c."user" ORDER BY l.rank) AS running
  FROM counts c LEFT JOIN {lists} l ON l.user_idx = c."user"
  LEFT JOIN relevant r ON r."user" = c."user" AND r.item = l.item_idx),
per_user AS MATERIALIZED (
  SELECT "user", n_relevant, {",".join(columns)},
         coalesce(1 / min(rank) FILTER (hit), 0) AS rr
  FROM marked GROUP BY "user", n_relevant)"""


def _averages(k_values: tuple[int, ...]) -> str:
    names = [f"{m}_at_{k}" for k in k_values for m in ("precision", "recall", "ndcg", "map")]
    averages = ", ".join(f"round(coalesce(avg({c}), 0), 6) + 0.0 AS {c}" for c in names)
    return f"{averages}, round(coalesce(avg(rr), 0), 6) + 0.0 AS mrr"


K = (5, 10, 20)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _r(expression: str, name: str | None = None) -> str:
    name = name or re.sub(r'^\w+\.', "", expression)
    return f"round({expression}, 6) + 0.0 AS {name}"


def _chain(train: float = 0.8, val: float = 0.1, order: str = TIME_ORDER) -> list[str]:
    return [RAW, INTER, _core("inter", 5, 5, 8), _split("cored", train, val, order), ENCODERS]


MAIN = _chain()
MAIN_ITEMS = [*MAIN, RAW_ITEMS, ITEMS]
EARLY = _chain(0.1, 0.1)
SPLIT = [RAW, INTER, _core("inter", 5, 5, 8), _split("cored", 0.8, 0.1, TIME_ORDER)]
EVALUATED = [*MAIN, SCORES, PLAIN, RELEVANT, _top("plain", "recs", 20, users=USERS_WITH_TEST), _per_user("recs", K)]
HYBRID_PARTS = [*MAIN_ITEMS, SCORES, GENRES, PREFS, HYBRID]

POPULARITY = """
stats AS (
  SELECT item_id, count(user_id) AS interaction_count, avg(rating) AS avg_rating, max("timestamp") AS last_timestamp
  FROM train GROUP BY item_id),
combined AS (
  SELECT *, 0.7e0 * (interaction_count / (SELECT max(interaction_count) FROM stats)) * ((avg_rating - 1) / 4)
    + 0.3e0 * pow(0.95e0, ((SELECT max(last_timestamp) FROM stats) - last_timestamp) / 86400) AS raw_score
  FROM stats),
popularity AS MATERIALIZED (
  SELECT item_id, raw_score / (SELECT max(raw_score) FROM combined) AS popularity_score, interaction_count, avg_rating
  FROM combined)"""

POPULAR_TEN = """
popular AS (
  SELECT CAST(row_number() OVER (ORDER BY popularity_score DESC, item_id) AS INTEGER) AS rank, item_id, popularity_score AS score
  FROM popularity ORDER BY popularity_score DESC, item_id LIMIT 10)"""

SIMILAR = """
norms AS (
  SELECT i.idx AS item_idx, coalesce(s.size, 0) AS size FROM item_ids i LEFT JOIN sizes s ON s.item_idx = i.idx),
shared AS MATERIALIZED (
  SELECT a.item_idx AS item_idx, b.item_idx AS similar_idx, count(*) AS common
  FROM item_genres a JOIN item_genres b USING (genre) GROUP BY ALL),
similarities AS (
  SELECT a.item_idx, b.item_idx AS similar_idx,
         coalesce(s.common, 0) / (sqrt(greatest(b.size, 1)) * sqrt(a.size) + 1e-8) AS similarity
  FROM norms a JOIN norms b ON a.item_idx <> b.item_idx
  LEFT JOIN shared s ON s.item_idx = a.item_idx AND s.similar_idx = b.item_idx),
nearest AS MATERIALIZED (
  SELECT * FROM (
    SELECT item_idx, similar_idx, similarity, CAST(row_number() OVER (
      PARTITION BY item_idx ORDER BY round(similarity, 9) DESC, similar_idx DESC) AS INTEGER) AS rank
    FROM similarities) WHERE rank <= 10)"""

KNOWN_COLUMNS = f"""c.c_custkey AS user_id, r.rank, i.id AS item_id, {_r('r.score')},
  coalesce(t.title, concat('Item ', CAST(i.id AS VARCHAR))) AS title, coalesce(t.genres, '') AS genres"""
KNOWN_FROM = """FROM customer c JOIN users u ON u.id = c.c_custkey JOIN recs r ON r.user_idx = u.idx
JOIN item_ids i ON i.idx = r.item_idx LEFT JOIN items t ON t.item_id = i.id"""
COLD = f"""SELECT c.c_custkey AS user_id, p.rank, p.item_id, {_r('p.score')}, t.title, t.genres
FROM (SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT id FROM users)) c
CROSS JOIN popular p LEFT JOIN items t ON t.item_id = p.item_id"""

def _run_of(name: str, order: str) -> str:
    """Mean metrics of the popularity model over one split order, as a one-row statement."""
    parts = [*_chain(order=order), SCORES, PLAIN, RELEVANT, _top("plain", "recs", 20, users=USERS_WITH_TEST), _per_user("recs", K)]
    means = ", ".join(f"avg({m}_at_10) AS {m}_at_10" for m in ("ndcg", "precision", "recall"))
    return f"SELECT '{name}' AS run_id, * FROM ({_with(*parts)} SELECT {means} FROM per_user)"


RUN_VALUES = f"""
runs AS MATERIALIZED (
  {_run_of("popularity-temporal", TIME_ORDER)}
  UNION ALL {_run_of("popularity-random", _hash_order(42))})"""

# Versions are told by run and metric.
REGISTRY = """
versions AS (
  SELECT run_id, 'ndcg_at_10' AS metric, ndcg_at_10 AS value, recall_at_10 FROM runs
  UNION ALL SELECT run_id, 'precision_at_10', precision_at_10, recall_at_10 FROM runs),
events(run_id, metric, stage, seq) AS (VALUES
  ('popularity-temporal', 'ndcg_at_10', 'Production', 1), ('popularity-random', 'ndcg_at_10', 'Production', 2),
  ('popularity-random', 'ndcg_at_10', 'Staging', 3), ('popularity-temporal', 'ndcg_at_10', 'Staging', 4),
  ('popularity-random', 'ndcg_at_10', 'Production', 5), ('popularity-temporal', 'precision_at_10', 'Production', 6),
  ('popularity-random', 'ndcg_at_10', 'Archived', 7), ('popularity-temporal', 'ndcg_at_10', 'Production', 8),
  ('popularity-random', 'precision_at_10', 'Production', 9), ('popularity-random', 'precision_at_10', 'Archived', 10),
  ('popularity-temporal', 'precision_at_10', 'Staging', 11), ('popularity-random', 'ndcg_at_10', 'Production', 12)),
latest AS (
  SELECT * FROM events e WHERE seq = (SELECT max(seq) FROM events o WHERE o.run_id = e.run_id AND o.metric = e.metric))"""

IMPLICIT = [
    *SPLIT,
    ENCODERS.replace("sum(rating)", "sum(CASE WHEN rating >= 3.5 THEN 1.0e0 ELSE 0.0e0 END)"),
    SCORES,
    PLAIN,
    RELEVANT.replace("value >= 3.5", "value >= 0.5"),
    _top("plain", "recs", 20, users=USERS_WITH_TEST),
    _per_user("recs", K),
]

SAMPLE = [
    *MAIN,
    SCORES,
    PLAIN,
    """
sample AS (SELECT DISTINCT user_idx FROM test ORDER BY user_idx LIMIT 100)""",
    RELEVANT.replace("WHERE value >= 3.5", "WHERE value >= 3.5 AND user_idx IN (SELECT user_idx FROM sample)"),
    _top("plain", "recs", 20, users=USERS_WITH_TEST),
    _per_user("recs", K),
]

EVALUATED_HYBRID = [*HYBRID_PARTS, RELEVANT, _top("blended", "recs", 20, users=USERS_WITH_TEST), _per_user("recs", K)]

NORMALIZED = 'SELECT user_id, item_id, rating, "timestamp", {} FROM train t'
AVERAGED = f"SELECT {_averages(K)}, count(*) AS n_users_evaluated FROM per_user"

ORACLE: dict[str, str] = {
    "scan_ratings": _with(ORDERS) + "SELECT * FROM raw",
    "scan_items": _with(RAW_ITEMS) + "SELECT * FROM raw_items",
    "scan_csv_ratings": _with(ORDERS) + "SELECT * FROM raw",
    "scan_csv_items": _with(RAW_ITEMS) + "SELECT * FROM raw_items",
    "csv_audit": _with(ORDERS)
    + """SELECT CASE "movieId" % 10 WHEN 3 THEN 'rating' WHEN 4 THEN 'userId' END AS reason, count(*) AS n_rows FROM raw GROUP BY 1""",
    "parquet_copy": _with(ORDERS) + "SELECT * FROM raw",
    "json_copy": _with(RAW_ITEMS) + "SELECT * FROM raw_items",
    "clean_dropna": _with(RAW)
    + 'SELECT * FROM raw WHERE "userId" IS NOT NULL AND "movieId" IS NOT NULL AND rating IS NOT NULL AND NOT isnan(rating) AND "timestamp" IS NOT NULL',
    "clean_range": _with(RAW) + "SELECT * FROM raw WHERE rating BETWEEN 1.0 AND 4.5",
    "clean_latest": _with(ORDERS) + _latest(-1e300, 1e300),
    "clean_ratings": _with(RAW) + _latest(1.0, 4.5),
    "clean_audit": _with(RAW)
    + f"SELECT count(*) AS initial_count, (SELECT count(*) FROM ({_latest(1.0, 4.5)})) AS final_count, count(*) - (SELECT count(*) FROM ({_latest(1.0, 4.5)})) AS removed FROM raw",
    "interactions": _with(RAW, INTER) + "SELECT * FROM inter",
    "to_implicit": _with(RAW, INTER) + "SELECT *, CAST(rating >= 3.5 AS INTEGER) AS interaction FROM inter",
    "implicit_ratio": _with(RAW, INTER)
    + "SELECT CAST(sum(CAST(rating >= 3.5 AS INTEGER)) AS BIGINT) AS positive_interactions, count(*) AS total_interactions, round(avg(CAST(rating >= 3.5 AS INTEGER)), 3) AS positive_ratio FROM inter",
    "binarize": _with(RAW, INTER) + "SELECT *, CAST(rating >= 3.5 AS DOUBLE) AS interaction FROM inter",
    "item_year": _with(RAW_ITEMS, ITEMS) + 'SELECT item_id AS "movieId", year FROM items',
    "item_title_clean": _with(RAW_ITEMS, ITEMS) + 'SELECT item_id AS "movieId", title_clean FROM items',
    "items": _with(RAW_ITEMS, ITEMS) + "SELECT * FROM items",
    "dataset_summary": _with(RAW, INTER, RAW_ITEMS, ITEMS)
    + "SELECT count(*) AS n_interactions, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, (SELECT count(*) FROM items) AS n_catalogue, (SELECT count(year) FROM items) AS n_with_year FROM inter",
    "kcore_20_20": _with(RAW, INTER, _core("inter", 20, 20, 12)) + "SELECT * FROM cored",
    "kcore_5_5": _with(RAW, INTER, _core("inter", 5, 5, 8)) + "SELECT * FROM cored",
    "kcore_audit": _with(RAW, INTER, _core("inter", 20, 20, 12))
    + """SELECT (SELECT count(*) FROM inter) - count(*) AS interactions_removed,
  (SELECT count(DISTINCT user_id) FROM inter) - count(DISTINCT user_id) AS users_removed,
  (SELECT count(DISTINCT item_id) FROM inter) - count(DISTINCT item_id) AS items_removed,
  count(*) AS final_interactions, count(DISTINCT user_id) AS final_users, count(DISTINCT item_id) AS final_items FROM cored""",
    "split_temporal": _with(RAW, INTER, _split("inter", 0.8, 0.1, TIME_ORDER)) + "SELECT * FROM labelled",
    "split_random": _with(RAW, INTER, _split("inter", 0.8, 0.1, _hash_order(42))) + "SELECT * FROM labelled",
    "split_nway": _with(RAW, INTER)
    + f"""SELECT user_id, item_id, rating, "timestamp", CAST(CASE
    WHEN pos < floor(n * 0.5e0) THEN 0
    WHEN pos < floor(n * 0.5e0) + floor(n * 0.2e0) THEN 1
    WHEN pos < floor(n * 0.5e0) + 2 * floor(n * 0.2e0) THEN 2 ELSE 3 END AS INTEGER) AS part
  FROM (SELECT *, row_number() OVER (ORDER BY {_hash_order(7)}) - 1 AS pos, count(*) OVER () AS n FROM inter)""",
    "split_summary": _with(*SPLIT)
    + """SELECT split, count(*) AS size, strftime(make_timestamp(max("timestamp") * 1000000), '%Y-%m-%d') AS end_date FROM labelled GROUP BY split""",
    "encode_users": _with(*MAIN) + "SELECT * FROM users",
    "encode_items": _with(*MAIN) + "SELECT * FROM item_ids",
    "encode_ignore": _with(*EARLY)
    + """SELECT user_id, item_id, rating, "timestamp", user_idx, item_idx FROM encoded WHERE split = 'test'""",
    "encode_checked": _with(*MAIN)
    + """SELECT user_id, item_id, rating, "timestamp", user_idx, item_idx FROM encoded WHERE split = 'train'""",
    "encoder_copy": _with(*MAIN) + "SELECT * FROM item_ids",
    "matrix_copy": _with(*MAIN) + f"SELECT user_idx, item_idx, {_r('value')} FROM matrix",
    "als_factors_check": _with(*MAIN) + "SELECT idx AS user_idx, TRUE AS solved FROM users",
    "tuning_draws": f"""
WITH trial AS (SELECT unnest(range(20)) AS trial),
bits AS (SELECT trial, {", ".join(f"CAST('0x' || substr(md5('42|' || trial || '|{name}'), 1, 8) AS BIGINT) AS {name}" for name in ("factors", "regularization", "iterations", "alpha"))} FROM trial)
SELECT CAST(trial AS INT) AS trial, 16 * (1 + factors % 8) AS factors,
       {_r("exp(ln(0.001) + (ln(0.1) - ln(0.001)) * regularization / 4294967296)", "regularization")},
       5 * (1 + iterations % 6) AS iterations, CAST(10 * (1 + alpha % 10) AS DOUBLE) AS alpha, TRUE AS sound
FROM bits""",
    "tuning_rungs": f"""
WITH RECURSIVE rung(rung, n, budget) AS (
  SELECT 0, 20, 2 UNION ALL
  SELECT rung + 1, CAST(ceil(n / 4.0) AS INT), budget * 4 FROM rung WHERE n > 1 AND budget < 30)
SELECT rung, CAST(n AS BIGINT) AS n_trials,
       CAST(coalesce(lead(n) OVER (ORDER BY rung), 1) AS BIGINT) AS n_promoted, TRUE AS sound FROM rung""",
    "rec_als_check": _with(*MAIN) + "SELECT idx AS user_idx, TRUE AS sound FROM users",
    "similar_als_check": _with(*MAIN) + "SELECT idx AS item_idx, TRUE AS sound FROM item_ids",
    "decode_items": _with(*MAIN)
    + f"SELECT item_idx, user_idx, {_r('value')}, id AS item_id FROM matrix JOIN item_ids ON idx = item_idx",
    "lookup_idx": _with(*EARLY) + "SELECT c_custkey AS id, idx FROM customer LEFT JOIN users ON id = c_custkey",
    "interaction_matrix": _with(*MAIN) + f"SELECT user_idx, item_idx, {_r('value')} FROM matrix",
    "matrix_stats": _with(*MAIN)
    + "SELECT *, round(nnz * 100 / (CAST(n_users AS DOUBLE) * n_items), 4) AS density_pct FROM (SELECT (SELECT count(*) FROM users) AS n_users, (SELECT count(*) FROM item_ids) AS n_items, (SELECT count(*) FROM matrix) AS nnz)",
    "norm_mean_center": _with(*SPLIT)
    + NORMALIZED.format(_r("rating - avg(rating) OVER (PARTITION BY user_id)", "rating_normalized")),
    "user_means": _with(*SPLIT) + f"SELECT user_id, {_r('avg(rating)', 'mean')} FROM train GROUP BY user_id",
    "norm_zscore": _with(*SPLIT)
    + NORMALIZED.format(
        _r(
            "(rating - avg(rating) OVER (PARTITION BY user_id)) / nullif(coalesce(stddev_samp(rating) OVER (PARTITION BY user_id), 1), 0)",
            "rating_normalized",
        )
    ),
    "user_stats": _with(*SPLIT)
    + f"SELECT user_id, {_r('avg(rating)', 'mean')}, {_r('coalesce(stddev_samp(rating), 1)', 'std')} FROM train GROUP BY user_id",
    "norm_minmax": _with(*SPLIT)
    + NORMALIZED.format(
        _r(
            "(rating - (SELECT min(rating) FROM train)) / nullif((SELECT max(rating) - min(rating) FROM train), 0)",
            "rating_normalized",
        )
    ),
    "norm_metadata": _with(*SPLIT)
    + f"SELECT {_r('avg(rating)', 'global_mean')}, min(rating) AS min_rating, max(rating) AS max_rating FROM train",
    "item_stats": _with(*SPLIT, POPULARITY)
    + f"SELECT item_id, interaction_count, {_r('avg_rating')}, last_timestamp FROM stats",
    "popularity_decay": _with(*SPLIT, POPULARITY)
    + f"SELECT item_id, {_r('popularity_score')}, interaction_count, {_r('avg_rating')} FROM popularity",
    "popularity_static": _with(*SPLIT, POPULARITY)
    + f"""SELECT item_id, {_r('s / max(s) OVER ()', 'popularity_score')}, interaction_count, {_r('avg_rating')} FROM (
    SELECT *, interaction_count / (SELECT max(interaction_count) FROM stats) * ((avg_rating - 1) / 4) AS s FROM stats)""",
    "confidence_implicit": _with(*MAIN)
    + "SELECT user_idx, item_idx, sum(CASE WHEN rating >= 3.5 THEN 41e0 ELSE 1e0 END) AS confidence FROM encoded WHERE split = 'train' GROUP BY ALL",
    "confidence_explicit": _with(*MAIN)
    + f"SELECT user_idx, item_idx, {_r('sum(1 + 40e0 * rating / (SELECT max(rating) FROM train))', 'confidence')} FROM encoded WHERE split = 'train' GROUP BY user_idx, item_idx",
    "confidence_events": """
SELECT user_idx, item_idx, count(*) * 41e0 AS confidence FROM (
  SELECT dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx, dense_rank() OVER (ORDER BY event_type) - 1 AS item_idx
  FROM events) GROUP BY user_idx, item_idx""",
    "confidence_stats": _with(*MAIN)
    + "SELECT round(avg(c), 2) AS mean_confidence, round(max(c), 2) AS max_confidence FROM (SELECT 1 + 40e0 * rating / (SELECT max(rating) FROM train) AS c FROM encoded WHERE split = 'train')",
    "rating_stats": _with(*MAIN)
    + f"""SELECT (SELECT count(*) FROM users) AS n_users, (SELECT count(*) FROM item_ids) AS n_items, 'explicit' AS feedback_type,
  count(*) AS n_interactions, min(rating) AS rating_min, max(rating) AS rating_max, {_r('avg(rating)', 'rating_mean')}, {_r('stddev_samp(rating)', 'rating_std')} FROM train""",
    "pop_model_scores": _with(*MAIN, SCORES) + f"SELECT item_idx, {_r('score')} FROM scores",
    "rec_popularity": _with(*MAIN, SCORES, PLAIN, _top("plain", "recs", 10))
    + f"SELECT user_idx, item_idx, {_r('score')}, rank FROM recs",
    "genre_vocab": _with(RAW_ITEMS, ITEMS)
    + "SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS genre_idx FROM (SELECT DISTINCT trim(unnest(string_split(genres, '|'))) AS genre FROM items WHERE genres <> '(no genres listed)')",
    "genre_features": _with(*MAIN_ITEMS, GENRES) + "SELECT * FROM item_genres",
    "user_genre_prefs": _with(*MAIN_ITEMS, GENRES, PREFS) + f"SELECT user_idx, genre, {_r('pref')} FROM prefs",
    "content_scores": _with(*MAIN_ITEMS, GENRES, PREFS)
    + f"""SELECT t.user_idx, t.item_idx, {_r('coalesce(sum(p.pref) / sqrt(max(s.size)), 0)', 'content')}
FROM encoded t LEFT JOIN item_genres g USING (item_idx) LEFT JOIN sizes s USING (item_idx)
LEFT JOIN prefs p ON p.user_idx = t.user_idx AND p.genre = g.genre GROUP BY t.user_idx, t.item_idx""",
    "rec_hybrid": _with(*HYBRID_PARTS, _top("blended", "recs", 10))
    + f"SELECT user_idx, item_idx, {_r('score')}, rank FROM recs",
    "similar_dot": f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT a.vec_id AS item_idx, b.vec_id AS similar_idx, list_dot_product(a.e, b.e) AS similarity
      FROM v a JOIN v b ON a.vec_id <> b.vec_id)
SELECT item_idx, similar_idx, {_r('similarity')}, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_idx ORDER BY round(similarity, 9) DESC, similar_idx DESC) AS INTEGER) AS rank
  FROM p) WHERE rank <= 10""",
    "similar_genre": _with(*MAIN_ITEMS, GENRES, SIMILAR)
    + f"SELECT item_idx, similar_idx, {_r('similarity')}, rank FROM nearest",
    "similar_popular": _with(*MAIN, SCORES)
    + f"""SELECT item_idx, similar_idx, {_r('similarity')}, rank FROM (
  SELECT i.idx AS item_idx, s.item_idx AS similar_idx, s.score AS similarity,
         CAST(row_number() OVER (PARTITION BY i.idx ORDER BY s.total DESC, s.item_idx DESC) AS INTEGER) AS rank
  FROM item_ids i JOIN scores s ON s.item_idx <> i.idx) WHERE rank <= 10""",
    "recommend_batch": _with(*HYBRID_PARTS, _top("blended", "recs", 10)) + f"SELECT {KNOWN_COLUMNS} {KNOWN_FROM}",
    "recommend_with_seen": _with(*HYBRID_PARTS, _top("blended", "recs", 10, unseen=False))
    + f"SELECT {KNOWN_COLUMNS} {KNOWN_FROM}",
    "recommend_popular": _with(*SPLIT, RAW_ITEMS, ITEMS, POPULARITY, POPULAR_TEN)
    + f"SELECT p.rank, p.item_id, {_r('p.score')}, t.title, t.genres FROM popular p LEFT JOIN items t USING (item_id)",
    "recommend_cold": _with(*EARLY, RAW_ITEMS, ITEMS, POPULARITY, POPULAR_TEN) + COLD,
    "recommend_all": _with(*EARLY, SCORES, PLAIN, _top("plain", "recs", 10), RAW_ITEMS, ITEMS, POPULARITY, POPULAR_TEN)
    + f"SELECT {KNOWN_COLUMNS} {KNOWN_FROM} UNION ALL {COLD}",
    "similar_items_batch": _with(*MAIN_ITEMS, GENRES, SIMILAR)
    + f"""SELECT i.id AS item_id, s.rank, j.id AS similar_item_id, {_r('s.similarity')}, t.title, t.genres
FROM part p JOIN item_ids i ON i.id = p.p_partkey JOIN nearest s ON s.item_idx = i.idx
JOIN item_ids j ON j.idx = s.similar_idx LEFT JOIN items t ON t.item_id = j.id""",
    "user_history": _with(*MAIN_ITEMS)
    + f"""SELECT c.c_custkey AS user_id, i.id AS item_id, {_r('m.value', 'rating')}, t.title
FROM customer c JOIN users u ON u.id = c.c_custkey JOIN matrix m ON m.user_idx = u.idx
JOIN item_ids i ON i.idx = m.item_idx LEFT JOIN items t ON t.item_id = i.id""",
    "list_users": _with(*MAIN) + 'SELECT id, (SELECT count(*) FROM users) AS "count" FROM users ORDER BY id LIMIT 50 OFFSET 20',
    "list_items": _with(*MAIN)
    + 'SELECT id, (SELECT count(*) FROM item_ids) AS "count" FROM item_ids ORDER BY id LIMIT 50 OFFSET 20',
    "list_items_meta": _with(*MAIN_ITEMS)
    + """SELECT id AS item_id, coalesce(title, concat('Film #', CAST(id AS VARCHAR))) AS title, coalesce(genres, '') AS genres,
  (SELECT count(*) FROM item_ids) AS "count" FROM item_ids LEFT JOIN items ON item_id = id ORDER BY id LIMIT 50 OFFSET 20""",
    "model_counts": _with(*MAIN) + "SELECT (SELECT count(*) FROM users) AS n_users, (SELECT count(*) FROM item_ids) AS n_items",
    "metric_rmse": _with(*SPLIT, PAIRS) + f"SELECT {_r('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))', 'rmse')} FROM pairs",
    "metric_mae": _with(*SPLIT, PAIRS) + f"SELECT {_r('avg(abs(y_true - y_pred))', 'mae')} FROM pairs",
    "metric_precision": _with(*EVALUATED) + f"""SELECT "user", {_r('precision_at_10', 'precision')} FROM per_user""",
    "metric_recall": _with(*EVALUATED) + f"""SELECT "user", {_r('recall_at_10', 'recall')} FROM per_user""",
    "metric_dcg": _with(*EVALUATED)
    + f"""SELECT l.user_idx AS "user", {_r('coalesce(sum(1 / log2(rank + 1)) FILTER (r.item IS NOT NULL AND rank <= 10), 0)', 'dcg')}
FROM recs l LEFT JOIN relevant r ON r."user" = l.user_idx AND r.item = l.item_idx GROUP BY l.user_idx""",
    "metric_ndcg": _with(*EVALUATED) + f"""SELECT "user", {_r('ndcg_at_10', 'ndcg')} FROM per_user""",
    "metric_ndcg_graded": _with(*EVALUATED)
    + f"""SELECT i."user", {_r('coalesce(d.dcg, 0) / i.ideal', 'ndcg')} FROM (
  SELECT "user", sum(grade / log2(place + 1)) AS ideal FROM (
    SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY grade DESC) AS place FROM graded) WHERE place <= 10 GROUP BY "user") i
LEFT JOIN (
  SELECT l.user_idx, sum(g.grade / log2(l.rank + 1)) AS dcg
  FROM recs l JOIN graded g ON g."user" = l.user_idx AND g.item = l.item_idx WHERE l.rank <= 10 GROUP BY l.user_idx) d
ON d.user_idx = i."user" """,
    "metric_ap": _with(*EVALUATED) + f"""SELECT "user", {_r('map_at_10', 'map')} FROM per_user""",
    "metric_map": _with(*EVALUATED) + f"SELECT {_r('avg(map_at_10)', 'map')} FROM per_user",
    "metric_rr": _with(*EVALUATED) + f"""SELECT "user", {_r('rr')} FROM per_user""",
    "metric_mrr": _with(*EVALUATED) + f"SELECT {_r('avg(rr)', 'mrr')} FROM per_user",
    "metrics_all": _with(*EVALUATED, PAIRS)
    + f"""SELECT {_averages(K)}, count(*) AS n_users_evaluated,
  (SELECT round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 6) FROM pairs) AS rmse,
  (SELECT round(avg(abs(y_true - y_pred)), 6) FROM pairs) AS mae FROM per_user""",
    "evaluate_model": _with(*EVALUATED) + AVERAGED,
    "evaluate_full_chain": _with(*EVALUATED) + AVERAGED,
    "evaluate_sample": _with(*SAMPLE) + AVERAGED,
    "evaluate_users": _with(*EVALUATED)
    + 'SELECT "user", '
    + ", ".join(_r(f"{m}_at_{k}") for k in K for m in ("precision", "recall", "ndcg"))
    + " FROM per_user",
    "evaluate_hybrid": _with(*EVALUATED_HYBRID) + AVERAGED,
    "evaluate_implicit": _with(*IMPLICIT) + AVERAGED,
    "relevant_items": _with(*MAIN, RELEVANT) + "SELECT * FROM relevant",
    "relevant_summary": _with(*MAIN, RELEVANT)
    + """SELECT count(*) AS n_users, round(avg(n), 2) AS avg_items_per_user FROM (SELECT count(*) AS n FROM relevant GROUP BY "user")""",
    "metrics_by_k": _with(*EVALUATED)
    + " UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS k, "
        + ", ".join(_r(f"avg({m}_at_{k})", m) for m in ("precision", "recall", "ndcg", "map"))
        + " FROM per_user"
        for k in K
    ),
    "best_run": _with(RUN_VALUES)
    + f"SELECT run_id, 'ndcg_at_10' AS metric, {_r('ndcg_at_10', 'value')} FROM runs ORDER BY ndcg_at_10 DESC, run_id LIMIT 1",
    "registry_current": _with(RUN_VALUES, REGISTRY)
    + """SELECT 'als_recommender' AS model_name,
  substr(md5(concat('als_recommender|', run_id, '|', metric, '|', CAST(CAST(round(round(value, 6) * 1000000) AS BIGINT) AS VARCHAR))), 1, 8) AS version,
  CASE WHEN stage <> 'Archived' AND EXISTS (
    SELECT 1 FROM events o
    WHERE (o.run_id <> l.run_id OR o.metric <> l.metric) AND o.stage = l.stage AND o.seq > l.seq) THEN 'Archived' ELSE stage END AS stage,
  run_id, metric, round(value, 6) + 0.0 AS value, CAST(seq AS INTEGER) AS registered_at, round(recall_at_10, 6) + 0.0 AS recall_at_10
FROM latest l JOIN versions USING (run_id, metric)""",
    "run_metrics": _with(RUN_VALUES)
    + "UNPIVOT (SELECT run_id, 'metric' AS kind, round(ndcg_at_10, 6) + 0.0 AS ndcg_at_10, round(precision_at_10, 6) + 0.0 AS precision_at_10, round(recall_at_10, 6) + 0.0 AS recall_at_10 FROM runs) ON ndcg_at_10, precision_at_10, recall_at_10 INTO NAME key VALUE number",
    "score_bands": _with(*HYBRID_PARTS, _top("blended", "recs", 10))
    + "SELECT CASE WHEN score >= 0.8 THEN 'Tres recommande' WHEN score >= 0.6 THEN 'Recommande' ELSE 'A decouvrir' END AS band, count(*) AS n FROM recs GROUP BY 1",
    "similarity_bands": _with(*MAIN_ITEMS, GENRES, SIMILAR)
    + """SELECT CASE WHEN similarity >= 0.8 THEN 'Tres similaire' WHEN similarity >= 0.6 THEN 'Similaire' ELSE 'A explorer' END AS band,
  CAST(trunc(similarity * 100) AS INTEGER) AS percent, count(*) AS n FROM nearest GROUP BY ALL""",
    "rating_bands": _with(RAW, INTER)
    + """SELECT item_id, CASE WHEN rating >= 4 THEN 'high' WHEN rating >= 3 THEN 'medium' ELSE 'low' END AS band,
  CAST(trunc(rating) AS INTEGER) AS full_stars, CAST(rating - trunc(rating) >= 0.5 AS INTEGER) AS half_star,
  CAST(5 - trunc(rating) - CAST(rating - trunc(rating) >= 0.5 AS INTEGER) AS INTEGER) AS empty_stars, count(*) AS n
FROM inter GROUP BY ALL""",
}

ORACLE |= {
    "clean_audit_alone": ORACLE["clean_audit"],
    "kcore_audit_alone": ORACLE["kcore_audit"],
    "encode_bucketed": ORACLE["encode_checked"],
    "norm_zscore_bucketed": ORACLE["norm_zscore"],
    "registry_commits": f"SELECT * EXCLUDE (recall_at_10) FROM ({ORACLE['registry_current']})",
    "summary_sketches": _with(RAW, INTER)
    + """SELECT strftime(make_timestamp("timestamp" * 1000000), '%Y-%m') AS month, count(*) AS n_interactions,
  TRUE AS users_close, TRUE AS items_close FROM inter GROUP BY month""",
    "history_by_key": f"""SELECT * FROM ({ORACLE["user_history"]}) WHERE user_id IN (
  SELECT c_custkey FROM customer WHERE c_custkey % 97 = 5 ORDER BY c_custkey LIMIT 10)""",
}
