"""Queries over the test tables, one or more per operator, with their SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import audit, blocking, features, metrics, model, split
from ..operators.truth import KeyTruth
from ..sources import tables
from ..sources.stages import materialise
from . import adapters, linkage

K, CAP = 10, 200


class Setting:
    """An adapter's entities, views, truth and candidates."""

    def __init__(self, spark: SparkSession, sf_dir: str, adapter: str = "part"):
        # documents are written once as entities: otherwise each column that is made of their tokens cuts the text again
        self.entities = adapters.part_entities(spark, sf_dir) if adapter == "part" else materialise(adapters.document_entities(spark, sf_dir), "entities", compression="zstd")
        self.s1, self.targets = adapters.sides(self.entities)
        self._candidates: dict[tuple, DataFrame] = {}

    # Views and candidates are small next to their texts and are read several times by every query. They are
    # written, not cached: a plan shows a cached table's own plan again at each use, and the driver keeps those texts.
    @cached_property
    def q(self) -> DataFrame:
        return materialise(linkage.keyed_views(self.s1, "q_id"), "views-q")

    @cached_property
    def t(self) -> DataFrame:
        return materialise(linkage.keyed_views(self.targets, "t_id"), "views-t")

    @property
    def ids(self) -> DataFrame:
        return self.s1.select(F.col("entity_id").alias("q_id"))

    @property
    def links(self) -> KeyTruth:
        return adapters.links_of(self.entities)

    @property
    def truth(self) -> DataFrame:
        return adapters.truth_of(self.entities)

    def candidates(self, ranking: str = "sketch", query_cap: int | None = None) -> DataFrame:
        key = ranking, query_cap
        if key not in self._candidates:
            self._candidates[key] = materialise(blocking.candidates(self.q, self.t, K, CAP, ranking, query_cap), "candidates")
        return self._candidates[key]

    def pairs(self) -> DataFrame:
        return features.with_profiles(self.candidates(), N.profile(self.s1), N.profile(self.targets))

    def predicted(self, least: float = 6.0) -> DataFrame:
        return self.candidates().where(F.round("score", 6) >= least)


def _joined(*cols: str):
    return [F.array_join(c, " ").alias(c) for c in cols]


def _round(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def tokens_part(spark, d):
    e = adapters.part_entities(spark, d)
    return e.select("entity_id", F.array_join(N.tokens(F.col("business_name"), N.BLOCK_ALIASES), " ").alias("name_tokens"), F.array_join(N.tokens(F.col("business_address"), N.PAIR_ALIASES), " ").alias("address_tokens"))


def tokens_docs(spark, d):
    t = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", N.raw_tokens(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ").cast("binary")).alias("tokens_md5"))


def _view(s: Setting):
    both = s.q.withColumnRenamed("q_id", "entity_id").unionByName(s.t.withColumnRenamed("t_id", "entity_id"))
    return both.select("entity_id", *_joined("nt", "at"), "num", "ctry").withColumnRenamed("at", "ad")


def record_view(spark, d):
    return _view(Setting(spark, d))


def record_view_docs(spark, d):
    return _view(Setting(spark, d, "docs"))


def blocking_keys(spark, d):
    s = Setting(spark, d)
    return blocking.postings(s.q, "q_id").unionByName(blocking.postings(s.t).withColumnRenamed("t_id", "q_id")).withColumnRenamed("q_id", "entity_id")


def key_frequency(spark, d):
    s = Setting(spark, d)
    return blocking.key_frequency(blocking.postings(s.t), blocking.postings(s.q, "q_id"))


def broad_blocks(spark, d):
    return key_frequency(spark, d).where(F.col("n") > CAP)


def pair_evidence(spark, d):
    s = Setting(spark, d)
    return blocking.pair_evidence(s.q, s.t, CAP)


def topk_weight(spark, d):
    return Setting(spark, d).candidates("weight").select("q_id", "t_id", "rank", "weight10", "shared", "mask")


def _topk(s: Setting, ranking="sketch", query_cap=None):
    return s.candidates(ranking, query_cap).select("q_id", "t_id", "rank", F.round("score", 6).alias("score"), "shared", "mask")


def topk_sketch(spark, d):
    return _topk(Setting(spark, d))


def topk_sketch_docs(spark, d):
    return _topk(Setting(spark, d, "docs"))


def topk_batch_iddesc(spark, d):
    return _topk(Setting(spark, d), "batch")


def query_cap(spark, d):
    return _topk(Setting(spark, d), "batch", 60)


def candidate_lists(spark, d):
    s = Setting(spark, d)
    return blocking.candidate_lists(s.q, s.candidates())


def retrieval_report(spark, d):
    s = Setting(spark, d)
    return _round(blocking.retrieval_report(s.q, s.t, s.candidates(), CAP))


def hash_split_md5(spark, d):
    e = adapters.part_entities(spark, d)
    return e.select("entity_id", split.validation_member_md5(F.col("entity_id")).alias("validation"))


def hash_sample_md5(spark, d):
    e, _ = adapters.sides(adapters.part_entities(spark, d))
    return split.select_source1(e, modulus=4, split="all", native=True).select("entity_id")


def hash_split_blake2b(spark, d):
    e, _ = adapters.sides(adapters.part_entities(spark, d))
    return split.select_source1(e, split="validation").select("entity_id")


def target_union(spark, d):
    e = adapters.part_entities(spark, d)
    s2, s3 = (e.where(F.col("entity_id").startswith(p)).drop("truth_key", "rid") for p in ("S2-", "S3-"))
    return tables.union_targets(s2, s3)


def truth_semi(spark, d):
    s = Setting(spark, d)
    wanted = s.ids.where(split.validation_member_md5(F.col("q_id")))
    return s.truth.join(wanted, "q_id", "left_semi").groupBy("q_id").agg(F.array_join(F.array_sort(F.collect_list("t_id")), ",").alias("ids"))


def missed_links_anti(spark, d):
    s = Setting(spark, d)
    return metrics.missed_links(s.truth, s.candidates())


def split_overlap(spark, d):
    """A development split that one validation entity in ten leaks into, and the other way round."""
    s = Setting(spark, d)
    member, number = split.validation_member_md5, F.regexp_extract("q_id", "-(.*)", 1).cast("long")
    development = s.ids.where(~member(F.col("q_id")) | (number % 10 == 0))
    validation = s.ids.where(member(F.col("q_id")) | (number % 35 == 0))
    return audit.split_checks(development, validation, member)


def profiles(spark, d):
    p = N.profile(adapters.part_entities(spark, d))
    return p.select("entity_id", "name_clean", "addr_clean", "ctry", "legal", "house", F.array_join(F.array_sort("nums"), " ").alias("nums"), F.size("name_s").cast("long").alias("name_tokens"), F.size("addr_s").cast("long").alias("addr_tokens"))


def native_features(spark, d):
    p = features.native_features(Setting(spark, d).pairs())
    return _round(p.select("q_id", "t_id", *features.NATIVE))


def gates(spark, d):
    p = Setting(spark, d).pairs()
    return p.select("q_id", "t_id", features.country_ok().alias("country_ok"), features.house_ok().alias("house_ok"), features.house_ok("raw").alias("house_ok_raw"))


def fuzzy_features(spark, d):
    p = features.pair_features(Setting(spark, d).pairs())
    return _round(p.select("q_id", "t_id", *features.EDIT))


def heuristic_scores(spark, d):
    return _round(features.heuristic_score(features.pair_features(Setting(spark, d).pairs())).select("q_id", "t_id", "prob"))


def baseline_sweep(spark, d):
    s = Setting(spark, d)
    return _round(linkage.baseline(s.candidates(), s.links, s.s1, s.targets))


def entity_f05(spark, d):
    s = Setting(spark, d)
    return _round(metrics.per_entity(s.ids, s.links, s.predicted()))


def candidate_quality(spark, d):
    s = Setting(spark, d)
    return _round(metrics.candidate_quality(s.ids, s.links, s.candidates()))


def prediction_metrics(spark, d):
    s = Setting(spark, d)
    return _round(metrics.prediction_metrics(s.ids, s.links, s.predicted()))


def prediction_metrics_all(spark, d):
    s = Setting(spark, d)
    return _round(metrics.prediction_metrics(s.ids, s.links, s.predicted(), all_entities=True))


def threshold_sweep(spark, d):
    s = Setting(spark, d)
    scored = s.candidates().withColumn("prob", F.round(F.col("score") / 10, 4))
    return _round(metrics.threshold_sweep(s.ids, s.links, scored, metrics.MODEL_THRESHOLDS))


def classified_pairs(spark, d):
    s = Setting(spark, d)
    return metrics.classified_pairs(s.truth, s.predicted())


def first_n_examples(spark, d):
    s = Setting(spark, d)
    return metrics.first_examples(metrics.wrong_pairs(s.links, s.predicted()), "fp")


def singleton_stats(spark, d):
    s = Setting(spark, d)
    lists = s.ids.join(s.truth.groupBy("q_id").agg(F.collect_list("t_id").alias("ids")), "q_id", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    return audit.truth_summary(lists)


def audit_counts(spark, d):
    p = adapters.part_entities(spark, d)
    return audit.audit_source(p, "part").unionByName(audit.audit_source(adapters.party_entities(spark, d), "party"))


def table_profile(spark, d):
    return audit.table_profile(tables.read_any(spark, f"{d}/customer.parquet", None), "customer")


def miss_summary(spark, d):
    s = Setting(spark, d)
    return metrics.miss_summary(s.links, s.candidates(), s.s1.withColumnRenamed("entity_id", "q_id"))


def _labelled(s: Setting):
    cands = s.candidates()
    return s.links.mark(cands).select(*cands.columns, F.coalesce("g", F.lit(0)).alias("label"))


def hard_negatives(spark, d):
    return metrics.hard_negatives(_labelled(Setting(spark, d)), 3).select("q_id", "t_id", "rank", "label")


def rank_features(spark, d):
    p = features.native_features(Setting(spark, d).pairs())
    return _round(p.select("q_id", "t_id", "reciprocal_rank", "is_top1", "total_candidates"))


def dedup_order(spark, d):
    """Match lists of two unequal passes over the same pairs: the first rank of a pair counts."""
    s = Setting(spark, d)
    once = s.predicted().select("q_id", "t_id", "rank")
    twice = once.unionByName(once.withColumn("rank", F.col("rank") + 1000))
    return tables.match_lists(s.ids, twice)


def _numbered(lists: DataFrame) -> DataFrame:
    return lists.withColumn("n", F.regexp_extract("q_id", "-(.*)", 1).cast("long"))


def _lists(s: Setting, pairs: DataFrame) -> DataFrame:
    have = pairs.groupBy("q_id").agg(F.array_sort(F.collect_list("t_id")).alias("ids"))
    return _numbered(s.ids.join(have, "q_id", "left").select("q_id", F.coalesce("ids", F.array().cast("array<string>")).alias("ids")))


def _spoiled(lists: DataFrame) -> DataFrame:
    """Lists with every kind of fault: rows that are gone, repeated and unknown, ids that are unknown
    and repeated. All rows of a list are made where it is."""
    n, none = F.col("n"), F.array().cast("array<string>")
    ids = F.concat("ids", F.when(n % 17 == 0, F.array(F.lit("S9-1"))).otherwise(none), F.when(n % 19 == 0, F.slice("ids", 1, 1)).otherwise(none))
    times = F.when(n % 11 == 0, 0).when(n % 13 == 0, 2).otherwise(1) + F.when(n % 23 == 0, 1).otherwise(0)
    copies = lists.withColumn("copy", F.explode(F.slice(F.array(F.lit(0), F.lit(1), F.lit(2)), F.lit(1), times)))
    unknown = (n % 23 == 0) & (F.col("copy") == 0)
    return copies.select(F.when(unknown, F.concat("q_id", F.lit("x"))).otherwise(F.col("q_id")).alias("q_id"), F.when(unknown, F.col("ids")).otherwise(ids).alias("ids"))


def submission_checks(spark, d):
    s = Setting(spark, d)
    # truth as matches: some links are no candidates
    return audit.submission_checks(_spoiled(_numbered(s.links.lists())), _lists(s, s.candidates()).drop("n"), s.ids, s.t.select("t_id"))


def header_checks(spark, d):
    """A candidate file with a wrong header counts as empty."""
    s = Setting(spark, d)
    return audit.submission_checks(s.links.lists(), _lists(s, s.candidates()).drop("n"), s.ids, s.t.select("t_id"), {"candidate": False})


def evaluation_checks(spark, d):
    s = Setting(spark, d)
    return audit.evaluation_checks(_spoiled(_lists(s, s.candidates())), s.ids, require_full=True)


def prediction_checks(spark, d):
    s = Setting(spark, d)
    return audit.prediction_checks(_spoiled(_lists(s, s.predicted())), s.ids, header=False)


def validation_score(spark, d):
    """Of the entities that hash into the validation split."""
    s = Setting(spark, d)
    ids = s.ids.where(split.validation_member_md5(F.col("q_id")))
    inside = lambda df: df.join(ids, "q_id", "left_semi")
    return _round(metrics.validation_score(ids, s.links.only(ids), inside(s.predicted())))


def batch_totals(spark, d):
    s = Setting(spark, d)
    keys = blocking.postings(s.q, "q_id")
    return _round(metrics.batch_totals(s.ids, s.links, s.candidates(), blocking.pair_evidence(s.q, s.t, CAP), blocking.key_frequency(blocking.postings(s.t), keys), keys, CAP))


def missed_examples(spark, d):
    s = Setting(spark, d)
    return metrics.missed_examples(metrics.missed_links(s.truth, s.candidates()), s.s1)


def name_gate(spark, d):
    return features.gated(Setting(spark, d).pairs()).select("q_id", "t_id")


def prediction_report(spark, d):
    s = Setting(spark, d)
    cands = s.candidates()
    scored = features.heuristic_score(features.gated(features.with_profiles(cands, N.profile(s.s1), N.profile(s.targets))))
    return _round(linkage.prediction_report(s.ids, cands, scored, 0.75))


def best_ranking(spark, d):
    """The ranking whose first candidates have the highest macro F0.5."""
    s, rankings = Setting(spark, d), ("sketch", "weight", "batch")
    first = materialise(blocking.firsts(blocking.scored_pairs(s.q, s.t, CAP), rankings), "firsts")  # one pass over pairs for all
    out = None
    for i, ranking in enumerate(rankings):
        chosen = first.select("q_id", F.col(ranking).alias("t_id"))
        one = metrics.prediction_metrics(s.ids, s.links, chosen).select(F.lit(ranking).alias("model"), F.lit(i).alias("position"), F.round("macro_f05", 9).alias("macro_f05"))
        out = one if out is None else out.unionByName(one)
    return _round(metrics.best_model(out))


def _model_scores(spark, d, kind):
    s = Setting(spark, d, "docs")
    return _round(linkage.fit_and_score(s.candidates(), s.links, s.s1, s.targets, kind=kind).select("q_id", "t_id", "rank", "prob"))


def lr_scores(spark, d):
    return _model_scores(spark, d, "logistic")


def gbt_scores(spark, d):
    return _model_scores(spark, d, "boosted")


def training_summary(spark, d):
    s = Setting(spark, d)
    data = metrics.hard_negatives(_labelled(s), 25)
    return _round(model.training_summary(data))


QUERIES = {f.__name__: f for f in (
    tokens_part, tokens_docs, record_view, record_view_docs, blocking_keys, key_frequency, broad_blocks, pair_evidence, topk_weight,
    topk_sketch, topk_sketch_docs, topk_batch_iddesc, query_cap, candidate_lists, retrieval_report, hash_split_md5, hash_sample_md5,
    hash_split_blake2b, target_union, truth_semi, missed_links_anti, split_overlap, profiles, native_features, gates, fuzzy_features,
    heuristic_scores, baseline_sweep, entity_f05, candidate_quality, prediction_metrics, prediction_metrics_all, threshold_sweep,
    classified_pairs, first_n_examples, singleton_stats, audit_counts, table_profile, miss_summary, hard_negatives, rank_features,
    dedup_order, submission_checks, header_checks, evaluation_checks, prediction_checks, validation_score, batch_totals, missed_examples,
    name_gate, prediction_report, best_ranking, lr_scores, gbt_scores, training_summary,
)}
