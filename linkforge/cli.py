"""Command line: ``python -m linkforge.cli COMMAND``. Folders hold {partition}_source{1,2,3}.tsv and,
for training, train_ground_truth.tsv."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.normalize import profile
from .operators import audit, features, metrics, model, split
from .plans import linkage
from .plans.session import ship
from .sources import tables


def _inputs(spark, a):
    read = lambda i: tables.read_tsv(spark, f"{a.data_dir}/{a.partition}_source{i}.tsv", tables.ENTITY)
    s1 = split.select_source1(read(1), a.partition, a.seed, a.sample_modulus, a.split)
    return s1, tables.union_targets(read(2), read(3))


def _truth(spark, a):
    return tables.read_tsv(spark, f"{a.data_dir}/train_ground_truth.tsv", tables.TRUTH)


def _candidates(spark, a):
    return tables.candidate_pairs(tables.read_tsv(spark, a.candidates, tables.CANDIDATES, check=False)).drop("total")


def _say(a, found):
    """To the report's file, if one is named, and to the terminal."""
    if a.report:
        tables.write_json(found, a.report)
    print(json.dumps(found, default=str))


def _lists(spark, path, cols):
    """(q_id, ids) of an output, and whether its header is right."""
    df = tables.read_tsv(spark, path, cols, check=False).select(F.col(cols[0]).alias("q_id"), F.filter(F.split(cols[1], ","), lambda x: x != "").alias("ids"))
    return df, tables.header_of(spark, path) == cols


def _truth_of(spark, a, s1):
    return tables.truth_pairs(_truth(spark, a)).join(_ids(s1), "q_id", "left_semi")


def _ids(s1):
    return s1.select(F.col("entity_id").alias("q_id"))


def run_audit(spark, a):
    read = lambda i: tables.read_tsv(spark, f"{a.data_dir}/{a.partition}_source{i}.tsv", tables.ENTITY)
    rows = [r.asDict() for i in (1, 2, 3) for r in audit.audit_source(read(i), f"source{i}").collect()]
    _say(a, rows)


def run_profile(spark, a):
    for path in tables.find_tables(spark, a.data_dir):
        print(json.dumps([r.asDict() for r in audit.table_profile(tables.read_any(spark, path), path).collect()]))


def run_retrieve(spark, a):
    s1, targets = _inputs(spark, a)
    q, t = linkage.keyed_views(s1, "q_id").persist(), linkage.keyed_views(targets, "t_id").persist()
    found = linkage.blocking.candidates(q, t, a.top_k, a.max_postings, a.ranking)
    lists = linkage.blocking.candidate_lists(q, found).withColumnRenamed("q_id", "source1_entity_id")
    tables.write_tsv(lists.select(*tables.CANDIDATES), a.out, "source1_entity_id")
    if a.evidence_out:
        tables.write_tsv(lists.select(*tables.EVIDENCE), a.evidence_out, "source1_entity_id")


def run_index(spark, a):
    """Writes the targets' keyed views and postings; refuses to overwrite."""
    _, targets = _inputs(spark, a)
    _say(a, {"targets": tables.write_index(linkage.keyed_views(targets, "t_id"), a.index, a.expected)})


def run_evaluate(spark, a):
    s1, targets = _inputs(spark, a)
    lists, header = _lists(spark, a.candidates, tables.CANDIDATES)
    audit.require(audit.evaluation_checks(lists, _ids(s1), header, a.require_full))
    pairs, have = _candidates(spark, a), lists.select("q_id")
    _say(a, metrics.candidate_quality(have, _truth_of(spark, a, s1).join(have, "q_id", "left_semi"), pairs, targets.count()).first().asDict())


def run_score(spark, a):
    """Macro F0.5 of predictions over the selected split."""
    s1, _ = _inputs(spark, a)
    lists, header = _lists(spark, a.matching, tables.MATCHES)
    if a.split == "validation":
        lists = lists.where(split.validation_member(F.col("q_id"), a.seed))
    audit.require(audit.prediction_checks(lists, _ids(s1), header))
    found = lists.select("q_id", F.explode(F.array_distinct("ids")).alias("t_id"))
    _say(a, metrics.validation_score(_ids(s1), _truth_of(spark, a, s1), found).first().asDict())


def run_misses(spark, a):
    """True links that are no candidates: by country, source and number of links, with examples."""
    s1, _ = _inputs(spark, a)
    truth = _truth_of(spark, a, s1)
    cands = _candidates(spark, a).persist()
    rows = [r.asDict() for r in metrics.miss_summary(truth, cands, s1.withColumnRenamed("entity_id", "q_id")).collect()]
    _say(a, {"summary": rows, "examples": [r.asDict() for r in metrics.missed_examples(metrics.missed_links(truth, cands), s1).collect()]})


def run_baseline(spark, a):
    s1, targets = _inputs(spark, a)
    sweep = linkage.baseline(_candidates(spark, a), _truth_of(spark, a, s1), s1, targets)
    _say(a, [r.asDict() for r in sweep.orderBy("threshold").collect()])


def run_experiments(spark, a):
    """Each kind of model, fitted on the candidates of the development split and swept over those of
    the validation split; the best one."""
    s1, targets = _inputs(spark, a)
    cands, truth, member = _candidates(spark, a), _truth_of(spark, a, s1), split.validation_member(F.col("q_id"), a.seed)
    _, data = linkage.train(cands.where(~member), truth, s1, targets, a.max_train_entities, a.max_negatives, "logistic", a.seed)
    pairs = features.gated(features.with_profiles(cands.where(member), profile(s1), profile(targets)), a.house_gate)
    sweeps, _ = model.experiments(data, pairs, _ids(s1).where(member), truth, a.kinds.split(","))
    sweeps = sweeps.persist()
    best = metrics.best_model(sweeps.where("best"))
    _say(a, {"sweeps": [r.asDict() for r in sweeps.collect()], "best": best.first().asDict()})


def run_train(spark, a):
    s1, targets = _inputs(spark, a)
    fitted, data = linkage.train(_candidates(spark, a), tables.truth_pairs(_truth(spark, a)), s1, targets, a.max_train_entities, a.max_negatives, a.kind, a.seed if a.split == "development" else None)
    model.save(fitted, a.model, a.threshold, **model.training_summary(data).first().asDict())


def run_predict(spark, a):
    s1, targets = _inputs(spark, a)
    fitted, _ = model.load(a.model)
    cands = _candidates(spark, a)
    scored = linkage.predict(fitted, cands, s1, targets, a.house_gate)
    tables.write_tsv(tables.match_lists(_ids(s1), features.matches(scored, a.threshold)), a.out, "source1_entity_id")
    if a.report:
        tables.write_json(linkage.prediction_report(_ids(s1), cands, scored, a.threshold), a.report)


def run_validate(spark, a):
    s1, targets = _inputs(spark, a)
    (matching, one), (candidate, two) = _lists(spark, a.matching, tables.MATCHES), _lists(spark, a.candidates, tables.CANDIDATES)
    checks = audit.submission_checks(matching, candidate, _ids(s1), targets.select(F.col("entity_id").alias("t_id")), {"matching": one, "candidate": two})
    print(audit.verdict(checks), json.dumps([r.asDict() for r in checks.where("n > 0").collect()]))


COMMANDS = {f.__name__[4:]: f for f in (run_audit, run_profile, run_index, run_retrieve, run_evaluate, run_misses, run_baseline, run_experiments, run_train, run_predict, run_score, run_validate)}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--data-dir", required=True)
    p.add_argument("--partition", default="train")
    p.add_argument("--split", default="all", choices=["validation", "development", "all"])
    for name in ("candidates", "evidence-out", "matching", "model", "out", "report", "index"):
        p.add_argument(f"--{name}")
    p.add_argument("--ranking", default="sketch", choices=["sketch", "weight", "batch"])
    p.add_argument("--house-gate", default="token", choices=["token", "raw"])
    p.add_argument("--kind", default="logistic", choices=model.KINDS)
    for name, value in (("seed", 2026), ("sample-modulus", 1), ("top-k", 150), ("max-postings", 200), ("max-train-entities", 14_000), ("max-negatives", 25)):
        p.add_argument(f"--{name}", type=int, default=value)
    p.add_argument("--expected", type=int)
    p.add_argument("--require-full", action="store_true")
    p.add_argument("--kinds", default=",".join(model.KINDS))
    p.add_argument("--threshold", type=float, default=0.40)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("linkforge").getOrCreate()
    ship(spark)
    COMMANDS[a.command](spark, a)


if __name__ == "__main__":
    main()
