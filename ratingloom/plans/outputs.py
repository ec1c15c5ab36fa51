"""Writes the results of a run into a folder of tables."""

from __future__ import annotations

from dataclasses import asdict

from ratingloom.operators import metrics, registry
from ratingloom.plans.workspace import Workspace
from ratingloom.sources import files


def save_run(run: Workspace, folder: str, run_id: str) -> None:
    """Tables, encoders, matrices, metrics and run rows; ``runs`` and ``registry`` grow, the rest is replaced."""
    spark, p = run.interactions.sparkSession, run.params
    files.write_parquet(run.interactions, f"{folder}/interactions")
    files.write_parquet(run.items, f"{folder}/items")
    files.write_parquet(run.encoded, f"{folder}/splits", partition_by=("split",))
    files.save_encoder(run.users, f"{folder}/users-encoder")
    files.save_encoder(run.item_ids, f"{folder}/items-encoder")
    files.save_matrix(run.matrix, f"{folder}/train-matrix")
    files.save_matrix(run.validation_matrix, f"{folder}/val-matrix")
    files.write_parquet(run.popularity, f"{folder}/popularity")
    files.write_json(run.metadata, f"{folder}/metadata")
    files.write_json(run.metrics, f"{folder}/metrics")
    files.write_csv(metrics.by_k(run.metrics, p.k_values), f"{folder}/metrics-by-k")
    if p.model_type == "als":
        files.save_als(run.als.model, f"{folder}/als-model")
    registry.append_rows(registry.run_rows(spark, run_id, asdict(p), {}), f"{folder}/runs")
    registry.append_rows(registry.metric_rows(run.metrics, run_id), f"{folder}/runs")
    registry.append_rows(run.register(run_id), f"{folder}/registry")
