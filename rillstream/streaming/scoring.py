"""Features and scores kept current from raw transactions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..plans import features as ft
from .maintain import RollingMaintainer
from .store import History, KeyedStore


class FeatureMaintainer(RollingMaintainer):
    """``plans.features.feature_view`` kept current.

    A step reads its cards' transactions within FEATURE_REACH of its own and replaces the features from there on, so a
    late transaction also corrects those of later ones. ``finish`` prepares feature rows for the store.
    """

    def __init__(
        self, history: History, store: KeyedStore, demo: DataFrame, time: str = "trans_date_trans_time",
        finish: Callable[[DataFrame], DataFrame] = ft.feature_table,
    ):
        self.history, self.store, self.keys, self.order = history, store, ["cc_num"], time
        self.demo, self.finish, self.horizon = demo, finish, ft.FEATURE_REACH

    def build(self, context: DataFrame, hot: int | None) -> DataFrame:
        return self.finish(ft.feature_view(context, self.demo, hot, [self.order, "__lo", "__hi"]))


class ScoreMaintainer:
    """Scores each step's new and changed features in the same step; scores of features that go are deleted.

    ``predict`` adds a ``prediction`` to feature rows. A retried step replaces its features and its scores.
    """

    def __init__(self, features: FeatureMaintainer, predict: Callable[[DataFrame], DataFrame], scores: KeyedStore):
        self.features, self.predict, self.scores = features, predict, scores

    def __call__(self, batch: DataFrame, epoch: int) -> DataFrame:
        changed = self.features(batch, epoch)
        gone = F.col("op") == "delete"
        scored = self.predict(changed.filter(~gone)).unionByName(changed.filter(gone), allowMissingColumns=True)
        self.scores.write(scored.select(*self.scores.schema.names, "op"), epoch)
        return self.scores.changes(epoch)
