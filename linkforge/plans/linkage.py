"""Whole runs: retrieval, training, prediction, the heuristic, experiments."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import profile, record_view
from ..operators import blocking, features, metrics, model, split
from ..sources.stages import materialise


def keyed_views(entities: DataFrame, as_id: str) -> DataFrame:
    """Entities (with ``rid`` for ties; src_ord and id stand in) to keyed views."""
    if "rid" not in entities.columns:
        order = F.struct(F.col("src_ord") if "src_ord" in entities.columns else F.lit(0), F.col("entity_id"))
        entities = entities.withColumn("rid", order)
    view = record_view(entities, keep=("rid",)).withColumnRenamed("entity_id", as_id)
    return blocking.with_keys(view)


def retrieve(source1: DataFrame, targets: DataFrame, k: int = 150, cap: int = 200, ranking: str = "sketch", query_cap: int | None = None) -> DataFrame:
    return blocking.candidates(keyed_views(source1, "q_id"), keyed_views(targets, "t_id"), k, cap, ranking, query_cap)


def scored_by_heuristic(cands: DataFrame, source1: DataFrame, targets: DataFrame) -> DataFrame:
    pairs = features.with_profiles(cands, profile(source1), profile(targets))
    return features.heuristic_score(features.pair_features(pairs))


def _first_entities(cands: DataFrame, most: int) -> DataFrame:
    return cands.select("q_id").distinct().orderBy(F.length("q_id"), "q_id").limit(most)


def train(cands: DataFrame, truth: metrics.Truth, source1: DataFrame, targets: DataFrame, max_entities: int = 14_000, max_negatives: int = 25, kind: str = "logistic", seed: int | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit on the first ``max_entities`` entities in the order of their file (their numbers); also returns
    the training set. With ``seed``, entities of that validation split are refused."""
    chosen = _first_entities(cands, max_entities)
    if seed is not None:
        model.check_development(chosen, lambda c: split.validation_member(c, seed))
    data = model.training_set(cands.join(chosen, "q_id", "left_semi"), truth, profile(source1), profile(targets), max_negatives)
    return model.fit(data, kind), data


def predict(fitted: PipelineModel, cands: DataFrame, source1: DataFrame, targets: DataFrame, house: str = "token", name_gate: bool = True) -> DataFrame:
    """Gated pairs with their probability."""
    pairs = features.with_profiles(cands, profile(source1), profile(targets))
    return model.score(fitted, features.gated(pairs, house, name_gate))


def fit_and_score(cands: DataFrame, truth: metrics.Truth, source1: DataFrame, targets: DataFrame, kind: str = "logistic", house: str = "token", name_gate: bool = True) -> DataFrame:
    """Fits on all candidates (``train`` has limits), then what ``predict`` gives; texts meet and features are made once for both."""
    pairs = features.with_profiles(model.labelled(cands, truth), profile(source1), profile(targets), long_texts=True)
    passed = features.country_ok() & features.house_ok(house) & (features.name_ok() if name_gate else F.lit(True))
    made = features.pair_features(pairs).withColumn("passed", passed)
    single = [F.col(c).cast("float").alias(c) for c in features.FEATURES]  # as the models take them
    data = materialise(made.select(*cands.columns, "label", "passed", *single), "features", compression="zstd")
    return model.score(model.fit(data, kind), data.where("passed").drop("label", "passed"))


def prediction_report(entities: DataFrame, cands: DataFrame, scored: DataFrame, threshold: float = 0.40) -> DataFrame:
    """One row: entities, candidate pairs, pairs rejected by gates, matches, share of entities
    without any."""
    hit = (F.col("prob") >= threshold) & (F.col("prob") > 0)
    pairs = scored.groupBy("q_id", "t_id").agg(F.count(F.lit(1)).alias("n"), F.max(hit.cast("int")).alias("hit"))  # as features.matches, each pair once
    each = pairs.groupBy("q_id").agg(F.sum("n").alias("n"), F.sum("hit").alias("hits"))
    found = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("scored"), F.coalesce(F.sum("hits"), F.lit(0)).alias("matches"), F.count_if(F.col("hits") > 0).alias("matched"))
    one = entities.agg(F.count(F.lit(1)).alias("entities")).crossJoin(cands.agg(F.count(F.lit(1)).alias("pairs"))).crossJoin(found)  # single rows
    return one.select("entities", "pairs", (F.col("pairs") - F.col("scored")).alias("gated"), "matches", F.try_divide(F.col("entities") - F.col("matched"), "entities").alias("singleton_fraction"))


def baseline(cands: DataFrame, truth: metrics.Truth, source1: DataFrame, targets: DataFrame) -> DataFrame:
    """Threshold sweep of the heuristic."""
    e = source1.select(F.col("entity_id").alias("q_id"))
    return metrics.threshold_sweep(e, truth, scored_by_heuristic(cands, source1, targets), metrics.BASELINE_THRESHOLDS)
