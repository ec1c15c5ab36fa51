"""Run and model-registry tables, append-only."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ratingloom.operators.topk import with_rank

RUNS = "run_id string, kind string, key string, value string, number double"
ARCHIVED = "Archived"


def run_rows(spark: SparkSession, run_id: str, params: Mapping[str, Any], metrics: Mapping[str, float]) -> DataFrame:
    """One row per parameter and metric of a run; nested values are kept as JSON text."""
    rows = [
        (run_id, "param", key, json.dumps(value) if isinstance(value, (dict, list, tuple)) else str(value), None)
        for key, value in params.items()
    ]
    rows += [(run_id, "metric", key, str(value), float(value)) for key, value in metrics.items()]
    return spark.createDataFrame(rows, RUNS)


def metric_rows(metrics: DataFrame, run_id: str) -> DataFrame:
    """The same rows from a one-row metrics table, without collecting it."""
    names = [c for c in metrics.columns if c != "n_users_evaluated"]
    long = metrics.select(*names).unpivot([], names, "key", "number")
    return long.select(
        F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"), "key", F.col("number").cast("string").alias("value"), "number"
    )


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def best_run(runs: DataFrame, metric: str, maximize: bool = True) -> DataFrame:
    """``(run_id, metric, value)`` of the best run; no row when no run has the metric.

    Equal values go to the smaller run id.
    """
    measured = runs.where((F.col("kind") == "metric") & (F.col("key") == metric) & F.col("number").isNotNull())
    order = F.desc("number") if maximize else F.asc("number")
    return (
        measured.orderBy(order, F.asc("run_id"))
        .limit(1)
        .select("run_id", F.col("key").alias("metric"), F.col("number").alias("value"))
    )


def all_metrics(runs: DataFrame) -> DataFrame:
    """``(run_id, metrics)``: every metric of a run as a map; of repeated keys the largest number."""
    measured = runs.where((F.col("kind") == "metric") & F.col("number").isNotNull())
    single = measured.groupBy("run_id", "key").agg(F.max("number").alias("number"))
    entries = F.sort_array(F.collect_list(F.struct("key", "number")))
    return single.groupBy("run_id").agg(F.map_from_entries(entries).alias("metrics"))


def register(runs: DataFrame, model_name: str, stage_name: str, at: Column, metrics: DataFrame | None = None) -> DataFrame:
    """Registry events for runs ``(run_id, metric, value)``; with the runs' ``all_metrics``, those too.

    The version is the head of a hash over the row, with the value in whole millionths.
    """
    if metrics is not None:
        runs = runs.join(metrics, "run_id", "left")
    millionths = F.round(F.col("value") * 1_000_000).cast("long").cast("string")
    text = F.concat_ws("|", F.lit(model_name), "run_id", "metric", millionths)
    return runs.select(
        F.lit(model_name).alias("model_name"),
        F.substring(F.md5(text.cast("binary")), 1, 8).alias("version"),
        F.lit(stage_name).alias("stage"),
        "run_id",
        "metric",
        "value",
        at.alias("registered_at"),
        *(["metrics"] if metrics is not None else []),
    )


def current_stages(events: DataFrame) -> DataFrame:
    """Stage of every version now: its latest event, archived when another version took the stage after it.

    Events are ``(model_name, version, stage, registered_at, ...)``. A version that lost its stage stays archived
    whatever becomes of the one that took it, until an event of its own promotes it again. Of versions that took
    a stage at the same time the smaller one has it.
    """
    latest = with_rank(
        events, ["model_name", "version"], [F.desc("registered_at"), F.asc("stage")], 1, name="_n"
    ).drop("_n")
    taken = events.groupBy("model_name", "stage", "version").agg(F.max("registered_at").alias("_at"))
    order = Window.partitionBy("model_name", "stage").orderBy(F.desc("_at"), F.asc("version"))
    last = taken.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == 1)
    holders = last.select("model_name", "stage", F.col("version").alias("_holder"))
    lost = (F.col("_holder") != F.col("version")) & (F.col("stage") != ARCHIVED)
    now = F.when(lost, ARCHIVED).otherwise(F.col("stage"))
    return latest.join(holders, ["model_name", "stage"]).withColumn("stage", now).select(*events.columns)
