"""Parameters of the whole chain, with the defaults users expect."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# fixed values: section and key of a parameter file -> field
SECTIONS = {
    ("feedback", "type"): "feedback_type",
    ("feedback", "rating_threshold"): "rating_threshold",
    ("feedback", "min_rating"): "min_rating",
    ("feedback", "max_rating"): "max_rating",
    ("split", "train_ratio"): "train_ratio",
    ("split", "val_ratio"): "val_ratio",
    ("split", "test_ratio"): "test_ratio",
    ("split", "temporal_split"): "temporal_split",
    ("split", "min_user_interactions"): "min_user_interactions",
    ("split", "min_item_interactions"): "min_item_interactions",
    ("features", "popularity_decay"): "popularity_decay",
    ("model", "type"): "model_type",
    ("model", "embedding_dim"): "factors",
    ("model", "regularization"): "regularization",
    ("model", "iterations"): "iterations",
    ("model", "alpha"): "alpha",
    ("train", "random_seed"): "random_seed",
    ("optuna", "enabled"): "search_enabled",
    ("optuna", "n_trials"): "n_trials",
    ("optuna", "metric"): "search_metric",
    ("eval", "k_values"): "k_values",
}


@dataclass(frozen=True)
class Params:
    # fixed values: default parameters
    feedback_type: str = "explicit"
    rating_threshold: float = 3.5
    min_rating: float = 0.5
    max_rating: float = 5.0
    train_ratio: float = 0.8
    val_ratio: float = 0.1
    test_ratio: float = 0.1
    temporal_split: bool = True
    min_user_interactions: int = 5
    min_item_interactions: int = 5
    popularity_decay: float = 0.95
    recency_weight: float = 0.3
    model_type: str = "popularity"
    hybrid_weight: float = 0.6
    factors: int = 64
    regularization: float = 0.01
    iterations: int = 15
    alpha: float = 40.0
    random_seed: int = 42
    search_enabled: bool = True  # applies to ALS only
    n_trials: int = 20
    search_metric: str = "ndcg_at_10"
    model_name: str = "als_recommender"
    stage: str = "Production"
    k_values: tuple[int, ...] = field(default=(5, 10, 20))

    def __post_init__(self) -> None:
        if self.feedback_type not in ("explicit", "implicit"):
            raise ValueError(f"unknown feedback type: {self.feedback_type}")
        if self.model_type not in ("popularity", "hybrid", "als"):
            raise ValueError(f"unknown model type: {self.model_type}")

    @classmethod
    def from_sections(cls, sections: Mapping[str, Mapping[str, Any]]) -> Params:
        """Parameters from the nested mapping of a parameter file; other keys are ignored."""
        values = {
            name: sections[section][key]
            for (section, key), name in SECTIONS.items()
            if key in (sections.get(section) or {})
        }
        if "k_values" in values:
            values["k_values"] = tuple(values["k_values"])
        return cls(**values)
