"""Intermediate tables in the shared work folder.

A staged table cuts lineage: it is written once as Parquet and survives the loss of any
executor. The size of its files is known to the optimizer, which broadcasts it in a join only below
``spark.sql.autoBroadcastJoinThreshold``, and with ``stage`` only if its rows are no more than
``BROADCAST_BYTES`` in memory; above, the join shuffles, and since the stored side
reads straight into the shuffle, adaptive execution can split a skewed key. Joins with
interactions therefore go to stored tables and carry no hint of their own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows of a key or lookup table that may be broadcast. Such tables hold a few
# fixed-width columns, so this bounds the broadcast at some tens of megabytes.
BROADCAST_ROWS = 1_000_000
# What a stored table may take in memory to be broadcast for its small files: repeated values are packed, so that
# lists of popular items take a hundredth of their size on disk.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 16  # of a row in memory, besides its values
MOST_PACKED = 4096  # a page of at most 20,000 values takes tens of bytes

_folders: dict[str, str] = {}


def use_folder(spark: SparkSession, folder: str) -> None:
    """Stage the tables of this application below ``folder``, which all executors share."""
    _folders[spark.sparkContext.applicationId] = folder


def work_folder(spark: SparkSession) -> str:
    """Folder for staged tables: that of ``use_folder``, else the session's checkpoint folder, else, in a
    session without executors of its own, a temporary one. It stays the same for an application."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not folder:
            if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", spark.sparkContext.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="ratingloom-")
        _folders[app] = folder
    return f"{_folders[app].rstrip('/')}/ratingloom-{app}"


def drop_staged(spark: SparkSession) -> bool:
    """Delete all staged tables of this application; frames that read them are of no more use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*stored: DataFrame) -> None:
    """Delete staged tables before the end of the run; only frames made of them after this are of no more use."""
    for table in stored:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if work_folder(spark).rsplit("/", 1)[-1] in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and return the stored table."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return sized(spark.read.schema(df.schema).parquet(path), path)


def sized(stored: DataFrame, path: str) -> DataFrame:
    """A Parquet table that the optimizer would broadcast by the size of its files, although its rows take more than
    ``BROADCAST_BYTES`` in memory, with a hint to sort and merge instead; else the table as it is. A hint to
    broadcast a filter of it goes before."""
    spark = stored.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_bytes = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    most = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if file_bytes > most or file_bytes * MOST_PACKED <= BROADCAST_BYTES:
        return stored
    width = stored._jdf.schema().defaultSize() + ROW_BYTES
    return stored.hint("merge") if stored.count() * width > BROADCAST_BYTES else stored


def fits_broadcast(stored: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table, or a filter of one, of fixed-width columns may be broadcast."""
    return stored.count() <= max_rows


def broadcast_if_small(stored: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint for a *filtered* stored table, whose size the optimizer overestimates. Counts it first."""
    return F.broadcast(stored) if fits_broadcast(stored, max_rows) else stored


def one_value(df: DataFrame, expression: Column) -> Column:
    """A global aggregate of ``df`` as a scalar subquery, usable in any expression."""
    return df.agg(expression.alias("v")).scalar()
