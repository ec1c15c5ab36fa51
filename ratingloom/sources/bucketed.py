"""Tables stored in buckets of a key, and tables clustered by a key.

Buckets make later joins and aggregates on the key start without a shuffle. Their tables are named in the session's
catalogue and stored in the work folder. A clustered table is a plain Parquet folder whose files and row groups hold
ranges of the key, with Bloom filters of it, so a request for a few keys reads a few row groups.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.staging import discard, work_folder

BUCKETS = 200
MOST_KEYS = 10_000  # of one request; more are joined
ROWS_PER_FILE = 5_000_000
ROW_GROUP_BYTES = 16 << 20


def store_bucketed(df: DataFrame, name: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` in ``buckets`` buckets of ``key``, sorted by it, and return the stored table."""
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    # one task a bucket writes one file
    dealt = df.repartition(buckets, F.col(key))
    writer = dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet")
    writer.option("path", f"{work_folder(df.sparkSession)}/{table}").saveAsTable(table)
    return df.sparkSession.read.table(table)


def store_clustered(df: DataFrame, path: str, key: str, rows_per_file: int = ROWS_PER_FILE, group_bytes: int = ROW_GROUP_BYTES) -> DataFrame:
    """Write ``df`` by ranges of ``key`` with Bloom filters of it, and return the stored table."""
    files = max(1, -(-df.count() // rows_per_file))
    ordered = df.repartitionByRange(files, key).sortWithinPartitions(key)
    writer = ordered.write.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", str(group_bytes))
    writer.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of_keys(stored: DataFrame, key: str, wanted: DataFrame, most: int = MOST_KEYS) -> DataFrame:
    """The rows of a clustered table whose ``key`` is in the one-column table ``wanted``. Up to ``most`` keys become a filter
    that reaches the scan; more are joined. Null keys match nothing."""
    keys = wanted.select(F.col(wanted.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    few = [r[0] for r in keys.limit(most + 1).collect()]
    if len(few) > most:
        return stored.join(keys, key, "left_semi")
    return stored.where(F.col(key).isin(few)) if few else stored.where(F.lit(False))


def drop_bucketed(spark: SparkSession, stored: DataFrame) -> None:
    """Drop the table that ``store_bucketed`` wrote, with its files."""
    for folder in {file.rsplit("/", 1)[0] for file in stored.inputFiles()}:
        spark.sql(f"DROP TABLE IF EXISTS `{folder.rsplit('/', 1)[1]}`")
    discard(stored)
