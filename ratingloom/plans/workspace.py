"""The whole chain from raw tables to models, each step stored once and built on demand."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ratingloom.operators import cleaning, encoding, features, neighbours, popularity, registry, splits, tuning
from ratingloom.operators.core_filter import core_filter
from ratingloom.operators.evaluation import IMPLICIT_THRESHOLD, evaluate_model
from ratingloom.operators.genres import GenreIndex, unique_items
from ratingloom.operators.hybrid import HybridModel
from ratingloom.operators.latent import FactorModel, fit_als
from ratingloom.params import Params
from ratingloom.staging import stage


class Workspace:
    """Stored steps of one run over raw ratings and items.

    ``sibling`` is another run over the same raw tables with the same rating range; its cleaned
    tables are used again.
    """

    def __init__(
        self,
        ratings: DataFrame,
        items: DataFrame,
        params: Params = Params(),
        core: bool = True,
        sibling: Workspace | None = None,
    ):
        self.raw_ratings, self.raw_items, self.params, self.core = ratings, items, params, core
        self.sibling = sibling

    @cached_property
    def interactions(self) -> DataFrame:
        p = self.params
        if self.sibling:
            base = self.sibling.interactions.select("user_id", "item_id", "rating", "timestamp")
            return cleaning.standardise_ratings(base, p.feedback_type, p.rating_threshold)
        cleaned = cleaning.clean_ratings(self.raw_ratings, p.min_rating, p.max_rating)
        return stage(cleaning.standardise_ratings(cleaned, p.feedback_type, p.rating_threshold), "interactions")

    @cached_property
    def items(self) -> DataFrame:
        if self.sibling:
            return self.sibling.items
        return stage(cleaning.standardise_items(self.raw_items), "items")

    @cached_property
    def catalogue(self) -> DataFrame:
        if self.sibling:
            return self.sibling.catalogue
        return stage(unique_items(self.items), "catalogue")

    @cached_property
    def kept(self) -> DataFrame:
        """Interactions of the dense core."""
        p = self.params
        if not self.core:
            return self.interactions
        limits = lambda run: (run.core, run.params.min_user_interactions, run.params.min_item_interactions)
        if self.sibling and limits(self.sibling) == limits(self):
            base = self.sibling.kept.select("user_id", "item_id", "rating", "timestamp")
            return cleaning.standardise_ratings(base, p.feedback_type, p.rating_threshold)
        return stage(core_filter(self.interactions, p.min_user_interactions, p.min_item_interactions), "core")

    @cached_property
    def cuts(self) -> splits.Cuts:
        p = self.params
        return splits.temporal_cuts(self.kept, p.train_ratio, p.val_ratio, p.test_ratio)

    @cached_property
    def labelled(self) -> DataFrame:
        """Interactions of the dense core with their part of the split.

        A temporal split is a cheap row-wise condition over the stored rows and is not stored again.
        """
        p = self.params
        if p.temporal_split:
            return self.cuts.label(self.kept)
        labelled = splits.random_split(self.kept, p.train_ratio, p.val_ratio, p.test_ratio, p.random_seed)
        return stage(labelled, "labelled", partition_by=("split",))

    @cached_property
    def train(self) -> DataFrame:
        if self.params.temporal_split:
            return self.cuts.part(self.kept, "train")
        return splits.part_of(self.labelled, "train")

    @cached_property
    def users(self) -> DataFrame:
        return encoding.fit_encoder(self.train, "user_id")

    @cached_property
    def item_ids(self) -> DataFrame:
        return encoding.fit_encoder(self.train, "item_id")

    @cached_property
    def encoded(self) -> DataFrame:
        """All parts with their indices; rows with an id unknown to train are dropped."""
        return stage(encoding.encode(self.labelled, self.users, self.item_ids), "encoded", partition_by=("split",))

    def encoded_part(self, name: str) -> DataFrame:
        return splits.part_of(self.encoded, name)

    @cached_property
    def value_column(self) -> str:
        return "interaction" if self.params.feedback_type == "implicit" else "rating"

    def _cells(self, part: str, value: str) -> DataFrame:
        # Cleaning has left one row per pair, so the stored part is the matrix.
        return features.interaction_matrix(self.encoded_part(part), value, unique=True)

    @cached_property
    def matrix(self) -> DataFrame:
        return self._cells("train", self.value_column)

    @cached_property
    def validation_matrix(self) -> DataFrame:
        return self._cells("val", self.value_column)

    @cached_property
    def test_matrix(self) -> DataFrame:
        return self._cells("test", self.value_column)

    @cached_property
    def seen(self) -> DataFrame:
        return self.matrix.select("user_idx", "item_idx")

    @cached_property
    def popularity(self) -> DataFrame:
        p = self.params
        decayed = features.item_popularity(self.train, True, p.popularity_decay, p.recency_weight)
        return stage(decayed, "popularity")

    @cached_property
    def scores(self) -> DataFrame:
        return stage(popularity.item_scores(self.matrix, self.item_ids), "item-scores")

    @cached_property
    def ranked(self) -> DataFrame:
        return popularity.ranked_items(self.scores)

    @cached_property
    def genre_index(self) -> GenreIndex:
        return GenreIndex(self.item_ids, self.items)

    @cached_property
    def hybrid(self) -> HybridModel:
        """Preferences come from the ratings, also when the matrix holds binary values."""
        return HybridModel(self._cells("train", "rating"), self.ranked, self.genre_index, self.params.hybrid_weight)

    @cached_property
    def als(self) -> FactorModel:
        p = self.params
        return FactorModel(
            fit_als(self.matrix, p.factors, p.regularization, p.iterations, p.alpha, p.random_seed)
        )

    def recommend(self, users: DataFrame, k: int, exclude_seen: bool = True) -> DataFrame:
        """Top-k of the configured model for users ``(user_idx)``."""
        seen = self.seen if exclude_seen else None
        if self.params.model_type == "popularity":
            return popularity.recommend_popular_unseen(users, self.ranked, seen, k)
        if self.params.model_type == "hybrid":
            return self.hybrid.recommend(users, k, exclude_seen)
        return self.als.recommend(users, seen, k)

    def similar(self, items: DataFrame, k: int) -> DataFrame:
        """Neighbours of items ``(item_idx)``: by factors for ALS, else by genres, else the popular ones."""
        if self.params.model_type == "als":
            return self.als.similar_items(k, items)
        if self.genre_index.vocabulary.isEmpty():
            return popularity.similar_popular(items, self.ranked, k)
        return neighbours.similar_by_genre(items, self.genre_index, k)

    @cached_property
    def metrics(self) -> DataFrame:
        p = self.params
        threshold = p.rating_threshold if p.feedback_type == "explicit" else IMPLICIT_THRESHOLD
        return stage(evaluate_model(self.recommend, self.test_matrix, p.k_values, threshold), "metrics")

    @cached_property
    def rungs(self) -> DataFrame:
        """The stored rungs of the parameter search."""
        return self.tune()

    def tune(self, n_trials: int | None = None, parameters: list[dict] | None = None) -> DataFrame:
        """Rungs of the parameter search on the validation part."""
        p = self.params
        return tuning.search(
            self.matrix,
            self.validation_matrix,
            n_trials or p.n_trials,
            p.search_metric,
            p.random_seed,
            p.rating_threshold if p.feedback_type == "explicit" else IMPLICIT_THRESHOLD,
            parameters,
        )

    def tuned(self, trials: DataFrame | None = None) -> Workspace:
        """This run with the best parameters found, on the same stored steps; itself when there is no search."""
        if self.params.model_type != "als" or not self.params.search_enabled:
            return self
        best = tuning.best_parameters(self.rungs if trials is None else trials)
        other = Workspace(self.raw_ratings, self.raw_items, replace(self.params, **best), self.core, self.sibling)
        changed = {"params", "als", "metrics"}
        other.__dict__.update({name: step for name, step in self.__dict__.items() if name not in changed})
        return other

    @cached_property
    def metadata(self) -> DataFrame:
        return stage(features.feature_metadata(self.train, self.users, self.item_ids, self.params.feedback_type), "metadata")

    def register(self, run_id: str) -> DataFrame:
        """Registry event of this run under the configured model name and stage."""
        p = self.params
        rows = registry.metric_rows(self.metrics, run_id)
        best = registry.best_run(rows, p.search_metric)
        return registry.register(best, p.model_name, p.stage, F.current_timestamp(), registry.all_metrics(rows))
