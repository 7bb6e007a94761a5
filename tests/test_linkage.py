"""Unit cases, parity of every catalogue query with its SQL, and metric invariants."""

import random
import time

import pytest
from pyspark.sql import functions as F

from linkforge.functions import normalize as N
from linkforge.functions import packing
from linkforge.functions import similarity as S
from linkforge.operators import audit, blocking, features, metrics, model, split
from linkforge.operators.truth import KeyTruth
from linkforge.plans import adapters, catalog, linkage, oracle
from linkforge.sources import tables


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_equals_sql(name, same):
    same(catalog.QUERIES[name], oracle.ORACLE_SQL[name])


def test_entity_f05(spark):
    """Against precision and recall written out."""
    counts = [(g, p, h) for g in range(4) for p in range(4) for h in range(min(g, p) + 1)]
    df = spark.createDataFrame(counts, "g long, p long, h long").withColumn("f", metrics.f05(F.col("g"), F.col("p"), F.col("h")))
    for r in df.collect():
        if not r.g and not r.p:
            want = 1.0
        elif not r.h:
            want = 0.0
        else:
            want = 1.25 / (1 / (r.h / r.p) + 0.25 / (r.h / r.g))  # the weighted harmonic mean
        assert r.f == pytest.approx(want)


def test_leaks_are_refused(spark):
    ids = spark.createDataFrame([(f"S1-{i}",) for i in range(60)], "q_id string")
    with pytest.raises(ValueError, match="validation split"):
        model.check_development(ids, split.validation_member)
    model.check_development(ids.where(~split.validation_member(F.col("q_id"))), split.validation_member)


def test_split_is_deterministic(spark):
    assert not split.is_validation("S1-123") and split.is_validation("S1-123") == split.is_validation("S1-123")
    ids = [f"S1-{i}" for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids], "entity_id string")
    got = {r.entity_id for r in split.select_source1(df).collect()}
    assert got == {i for i in ids if split.is_validation(i)} and 60 < len(got) < 140


TOKENS = [
    ("Straße", ["strasse"]), ("x²", ["x2"]), ("Ｆｕｌｌ", ["full"]), ("Acme™ Ltd", ["acme", "limited"]), ("İstanbul", ["istanbul"]),
    ("ಕರ್ನಾಟಕ 12", ["12"]), ("nº5", ["no5"]), ("A & B Co", ["a", "and", "b", "company"]), ("", []), (None, []),
]


def test_tokens(spark):
    df = spark.createDataFrame([(t,) for t, _ in TOKENS], "t string").select(N.tokens(F.col("t"), N.BLOCK_ALIASES).alias("k"))
    assert [r.k for r in df.collect()] == [k for _, k in TOKENS]


def entity(spark, *rows_):
    return spark.createDataFrame([(i, *r) for i, r in rows_], "entity_id string, business_name string, business_address string, country string")


def keys(spark, *record):
    return set(linkage.keyed_views(entity(spark, ("S1-1", record)), "q_id").first()["keys"])


def test_blocking_keys(spark):
    a = keys(spark, "Orelee's Barbershop", "1795 Westchester Drive, High Point, NC", "US")
    b = keys(spark, "Orelees Barber Shop", "1795 Westchester Dr, High Point", "US")
    assert a & b
    assert keys(spark, "Maison Bleue", "25 Rue Victor Hugo", "France")
    assert keys(spark, None, None, None) == set()


def one_pair(spark, left, right, rank, total):
    cands = spark.createDataFrame([("S1-1", f"S2-{i}", i) for i in range(1, total + 1)], "q_id string, t_id string, rank int")
    p = features.with_profiles(cands, N.profile(entity(spark, ("S1-1", left))), N.profile(entity(spark, (f"S2-{rank}", right))))
    return features.pair_features(p).select(*features.FEATURES).first()


def test_features(spark):
    a = ("Acme Corp", "123 Main St", "US")
    r = one_pair(spark, a, a, 1, 5)
    assert len(r) == 26 and r.country_match == r.name_exact == r.addr_exact == r.house_num_status == 1 and r.sketch_score > 5 and r.total_candidates == 5
    r = one_pair(spark, ("Acme Corp", "1037 Cedar Rd", "US"), ("Acme Corp", "1039 Cedar Rd", "US"), 2, 5)
    assert r.house_num_status == -1 and r.numeric_conflict == 1 and r.reciprocal_rank == 0.5 and r.is_top1 == 0
    assert one_pair(spark, a, ("Acme Corp", "123 Main St", "India"), 1, 1).country_match == 0


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_similarities():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc ", k=rng.randrange(12))) for _ in range(2))
        assert S.lcs(a, b) == plain_lcs(a, b)
    assert S.token_sort_ratio("b a", "a b") == 1 and S.token_set_ratio("a b", "a b c") == 1 and S.ratio("", "") == 1
    assert S.token_set_ratio("", "a") == 0


def test_ratios_are_the_plain_ones(spark):
    """The JVM function against its definition in Python; strings of more than one and more than four words, of few letters."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abc7", k=rng.randrange(1, 9))) for _ in range(40)]
    some = lambda: " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 15, 90])))
    pairs = [(some(), some()) for _ in range(500)]
    pairs += [(a, a) for a, _ in pairs[:20]] + [(a, f"{a} x") for a, _ in pairs[:20]] + [(" ".join(reversed(a.split())), a) for a, _ in pairs[:40]]
    pairs += [("a" * n, "a" * m + "b") for n in (63, 64, 65, 128) for m in (1, 63, 64, 127)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    for r in df.select("i", S.ratios(F.col("a"), F.col("b")).alias("r"), S.ratios(F.col("a"), F.col("b"), False).alias("s")).collect():
        a, b = pairs[r.i]
        want = (S.ratio(a, b), S.token_sort_ratio(a, b), S.token_set_ratio(a, b)) if a and b else (0, 0, 0)
        assert tuple(r.r) == want and tuple(r.s) == (*want[:2], None), (a, b)


def test_text_functions_are_the_plain_ones(spark):
    """The JVM functions of whole texts against the column expressions that define them: every character, and made-up texts."""
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(9)
    words = ["st", "co", "LTD", "Road", "Straße", "naïve", "o\u0301", "12", "1234567", "007", "&", "a&b", "Ｆｕｌｌ", "𝐀𝐁1", "李", "-", ".", "\u3000", "inc", "abcde", "abcdf", "dr"]
    texts = [None, "", " ", "one", *(" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(300))]
    texts += ["".join(f"a{c}b " for c in chars[i:i + 5000]) for i in range(0, len(chars), 5000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
    t, block, pair = N.raw_tokens(F.col("t")), N.tokens(F.col("t"), N.BLOCK_ALIASES), N.tokens(F.col("t"), N.PAIR_ALIASES)
    half = F.ceil(F.size(t) / 2).cast("int")
    want = df.select(
        "i", F.array_join(F.slice(t, F.lit(1), half), " "), F.array_join(F.slice(t, half + 1, F.size(t)), " "), N.selected(block, N.LEGAL, 4), N.first_number(block),
        F.array_join(pair, " "), F.try_element_at(F.filter(pair, lambda x: x.isin(N.LEGAL)), F.lit(-1)), N.first_number(pair), F.array_distinct(F.filter(pair, N.is_number)))
    h, v, p = N.halves(F.col("t")), N.viewed(F.col("t"), N.LEGAL, 4), N.profiled(F.col("t"))
    got = df.select("i", h.alias("h"), v.alias("v"), p.alias("p")).select("i", "h.name", "h.address", "v.best", "v.num", "p.clean", "p.legal", "p.house", "p.nums")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_long_texts_travel_packed(spark):
    """Packing gives back each string, in less than half the bytes of a long one; pairs have equal features with it and without."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randrange(3, 10))) for _ in range(80)]
    long = " ".join(rng.choices(vocabulary, k=3000))
    texts = [None, "", "\n", "a", "ü\u0000𝐀", long]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", packing.packed(F.col("t")).alias("p"))
    got = {r.i: (r.t, r.n) for r in df.select("i", packing.unpacked(F.col("p")).alias("t"), F.length("p").alias("n")).collect()}
    assert [got[i][0] for i in range(len(texts))] == texts and got[5][1] * 2 < len(long)
    sides = [[(f"{s}-{i}", (a, b, "US")) for i, (a, b) in enumerate([("", ""), ("x y", ""), ("", "12 main st"), (long, long[:999]), ("a & b co", "9 dr")])] for s in ("S1", "S2")]
    cands = spark.createDataFrame([(f"S1-{i}", f"S2-{j}", j + 1) for i in range(5) for j in range(5)], "q_id string, t_id string, rank int")
    plain, pack = [features.pair_features(features.with_profiles(cands, *[N.profile(entity(spark, *s)) for s in sides], long_texts=b)).select("q_id", "t_id", *features.FEATURES) for b in (False, True)]
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, pack.collect())) and plain.count() == 25


def test_name_gate_drops_pairs_early(spark):
    """Pairs of the gate alone are those that name_ok keeps of all features, with equal features."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 14))) for _ in range(60)]
    name = lambda: " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 12, 40])))
    sides = [[(f"{s}-{i}", (name(), name(), "US")) for i in range(60)] for s in ("S1", "S2")]
    cands = spark.createDataFrame([(f"S1-{i}", f"S2-{j}", j + 1) for i in range(60) for j in range(60)], "q_id string, t_id string, rank int")
    pairs = features.with_profiles(cands, *[N.profile(entity(spark, *s)) for s in sides])
    of = lambda df: sorted(map(tuple, df.select("q_id", "t_id", *features.FEATURES).collect()))
    every = features.pair_features(pairs)
    kept = of(every.where(features.name_ok()))
    assert of(features.pair_features(pairs, F.lit(True))) == kept and 0 < len(kept) < 3600
    assert of(features.pair_features(pairs, F.col("rank") > 30)) == of(every.where(features.name_ok() | (F.col("rank") <= 30)))


def test_documents_need_no_python_workers(spark, sf_dir):
    s = catalog.Setting(spark, sf_dir, "docs")
    for df in (adapters.document_entities(spark, sf_dir), N.record_view(s.entities.drop("country").withColumn("country", F.lit("x"))), N.profile(s.entities.drop("country").withColumn("country", F.lit("x")))):
        plan = df.select([c for c in df.columns if c != "ctry"])._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan


def test_long_pairs_are_compared_in_time(spark):
    """Twenty pairs of long texts in one task take less than ten such pairs take the plain functions."""
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(6_000))
    pairs = [(text(), text()) for _ in range(20)]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(1).cache()
    assert df.count() == 20
    began = time.time()
    want = [f(*pairs[0]) for f in (S.ratio, S.token_sort_ratio, S.token_set_ratio)]
    one, began = time.time() - began, time.time()
    got = {tuple(r.r) for r in df.select(S.ratios(F.col("a"), F.col("b")).alias("r")).collect()}
    assert tuple(want) in got and len(got) == 20 and time.time() - began < 10 * one


def test_fit_and_score_is_train_then_predict(spark, sf_dir):
    s = catalog.Setting(spark, sf_dir, "docs")
    cands = s.candidates()
    fitted, _ = linkage.train(cands, s.links, s.s1, s.targets)
    as_rows = lambda df: {(r.q_id, r.t_id, r["rank"]): r.prob for r in df.collect()}
    two, one = as_rows(linkage.predict(fitted, cands, s.s1, s.targets)), as_rows(linkage.fit_and_score(cands, s.links, s.s1, s.targets))
    assert one and one == {k: pytest.approx(p, abs=1e-6) for k, p in two.items()}


def test_fit_and_score_fits_on_all_candidates(spark, monkeypatch):
    """More entities than ``train`` takes, and one with more negatives than it takes: each pair is trained on."""
    n, more = 14_020, 40
    s1 = entity(spark, *[(f"S1-{i}", (f"shop {i}", f"{i} main st", "US")) for i in range(n)])
    targets = entity(spark, *[(f"S2-{i}", (f"shop {i}", f"{i + i % 2} main st", "US")) for i in range(n)])
    pairs = [(f"S1-{i}", f"S2-{i}", 1) for i in range(n)] + [("S1-7", f"S2-{100 + i}", 2 + i) for i in range(more)]
    cands = spark.createDataFrame(pairs, "q_id string, t_id string, rank int")
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(0, n, 2)], "q_id string, t_id string")
    seen = []
    monkeypatch.setattr(model, "fit", lambda data, kind: seen.append(data))
    monkeypatch.setattr(model, "score", lambda _, pairs: pairs)
    scored = linkage.fit_and_score(cands, truth, s1, targets)
    assert (seen[0].count(), seen[0].where("label = 1").count()) == (n + more, n // 2)
    assert sorted(r.q_id for r in seen[0].select("q_id").collect()) == sorted(q for q, _, _ in pairs)
    assert scored.where("rank = 1").count() == n // 2  # others have another house number


def test_metric_invariants(spark, duck, sf_dir):
    s = catalog.Setting(spark, sf_dir, "docs")
    cands = s.candidates()
    q = metrics.candidate_quality(s.ids, s.truth, cands).first()
    m = metrics.prediction_metrics(s.ids, s.truth, cands.where("rank = 1")).first()
    pairs = duck.execute(f"select count(*) from ({oracle.ORACLE_SQL['topk_sketch_docs']})").fetchone()[0]
    assert (q.entities, q.candidate_pairs, q.true_links, q.links_found) == (67, pairs, 5, 5)
    assert 0 <= m.micro_precision <= 1 and m.macro_f05 <= q.oracle_f05 <= 1


def test_tsv_round_trip(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-2\t"Quoted ""X"" Ltd"\t12 Main St\t India \nS2-3\ta\t\tUS\n', encoding="utf-8")
    got = [tuple(r) for r in tables.read_tsv(spark, str(p), tables.ENTITY).collect()]
    assert got == [("S2-2", 'Quoted "X" Ltd', "12 Main St", " India "), ("S2-3", "a", "", "US")]
    with pytest.raises(ValueError):
        tables.read_tsv(spark, str(p), tables.TRUTH)
    out = str(tmp_path / "m")
    m = spark.createDataFrame([("S1-1", "S2-9", 2), ("S1-1", "S2-8", 1), ("S1-1", "S2-9", 3)], "q_id string, t_id string, rank int")
    lists = tables.match_lists(spark.createDataFrame([("S1-1",), ("S1-2",)], "q_id string"), m)
    tables.write_tsv(lists.coalesce(1), out)
    back = spark.read.text(out).collect()
    assert {r[0] for r in back} == {"source1_entity_id\tmatched_entity_ids", "S1-1\tS2-8,S2-9", "S1-2\t"}
    pairs = tables.candidate_pairs(spark.createDataFrame([("S1-1", "S2-8,S2-9"), ("S1-2", "")], "source1_entity_id string, candidate_entity_ids string"))
    assert [(r.t_id, r["rank"], r.total) for r in pairs.collect()] == [("S2-8", 1, 2), ("S2-9", 2, 2)]


def test_index_and_stream(spark, sf_dir, tmp_path):
    from linkforge.streaming.retrieval import stream_candidates

    s = catalog.Setting(spark, sf_dir)
    path = str(tmp_path / "index")
    n = tables.write_index(s.t, path)
    assert n == s.t.count()
    with pytest.raises(Exception):  # noqa: B017
        tables.write_index(s.t, path)
    source = str(tmp_path / "s1")
    s.s1.drop("truth_key").write.parquet(source)
    stream = spark.readStream.schema(s.s1.drop("truth_key").schema).parquet(source)
    stream_candidates(stream, tables.read_index(spark, path), str(tmp_path / "out"), str(tmp_path / "check"), k=10).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("q_id", "t_id", "rank")
    assert got.exceptAll(s.candidates().select("q_id", "t_id", "rank")).isEmpty() and got.count() == 658


def test_submission_checks_fail(spark):
    ids = lambda rows_: spark.createDataFrame(rows_, "q_id string, ids array<string>")
    s1, t = spark.createDataFrame([("S1-1",), ("S1-2",)], "q_id string"), spark.createDataFrame([("S2-1",)], "t_id string")
    checks = audit.submission_checks(ids([("S1-1", ["S2-1", "S2-1"]), ("S1-1", []), ("S1-9", ["S2-7"])]), ids([("S1-1", []), ("S1-2", [])]), s1, t)
    n = {(r.file, r.check): r.n for r in checks.collect()}
    assert [n["matching", c] for c in ("header", "duplicate_row", "duplicate_id_in_list", "missing_row", "unknown_row", "unknown_id", "not_a_candidate")] == [0, 1, 1, 1, 1, 1, 2]
    assert audit.verdict(checks) == "FAIL"


def test_train_save_predict(spark, sf_dir, tmp_path):
    s = catalog.Setting(spark, sf_dir, "docs")
    cands = s.candidates().persist()
    fitted, data = linkage.train(cands, s.truth, s.s1, s.targets)
    assert model.training_summary(data).first().positives == 5
    model.save(fitted, str(tmp_path / "m"), 0.4)
    again, facts = model.load(str(tmp_path / "m"))
    scored = linkage.predict(again, cands, s.s1, s.targets)
    assert facts["threshold"] == 0.4 and {(r.q_id, r.t_id) for r in features.matches(scored, 0.4).collect()} >= {(r.q_id, r.t_id) for r in s.truth.collect()}
    with pytest.raises(ValueError):
        model.check_split(s.ids, s.ids)
    cands.unpersist()


def test_retrieval_ties_and_empty(spark):
    none = spark.createDataFrame([], "entity_id string, business_name string, business_address string, country string, rid long")
    assert linkage.retrieve(none, none).count() == 0
    e = spark.createDataFrame([("S1-1", "Blue Water Trading", "5 Long Way", "US", 1), ("S2-2", "Blue Water Trading", "5 Long Way", "US", 2), ("S2-3", "Blue Water Trading", "5 Long Way", "US", 3)], "entity_id string, business_name string, business_address string, country string, rid long")
    q, t = e.where("rid = 1"), e.where("rid > 1")
    assert [r.t_id for r in linkage.retrieve(q, t, 1).collect()] == ["S2-2"]
    assert [r.t_id for r in linkage.retrieve(q, t, 1, ranking="batch").collect()] == ["S2-3"]
    assert blocking.pair_evidence(linkage.keyed_views(q, "q_id"), linkage.keyed_views(t, "t_id"), cap=1).count() == 0


def test_models_see_whole_texts(spark, tmp_path):
    """Documents that share no token before the 17th are retrieved by what follows."""
    ends = ["constantinople harbourmaster quarterdeck", "zwetschgenbaum kirchenglocke donaudampfer"]
    starts = [" ".join(f"{c}{i:02d}x" for i in range(16)) for c in "abcd"]
    docs = [(i + 3, f"{starts[i]} {ends[i // 2]}", "en") for i in range(4)]  # ids 3 to 6 are of S1, S2, S3, S1
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    s = catalog.Setting(spark, str(tmp_path), "docs")
    assert {(r.q_id, r.t_id) for r in s.candidates().collect()} == {("S1-3", "S2-4"), ("S1-6", "S3-5")}
    both = s.entities.select(F.concat_ws(" ", "business_name", "business_address").alias("t"))
    assert {r.t for r in both.collect()} == {t for _, t, _ in docs}
    assert {(r.q_id, r.t_id) for r in catalog.lr_scores(spark, str(tmp_path)).collect()} == {("S1-3", "S2-4"), ("S1-6", "S3-5")}


# the driver keeps a plan's text at each step of a run, so its characters are bounded
SMALL_PLANS = {
    "miss_summary": 100_000,  # 1,284,156 before
    "baseline_sweep": 250_000,  # 573,996 before
    "best_ranking": 250_000,  # 674,636 before
    "batch_totals": 150_000,  # 456,722 before
    "candidate_quality": 100_000,  # 232,699 before
    "entity_f05": 100_000,  # 225,209 before
    "first_n_examples": 60_000,  # 218,424 before
    "prediction_metrics": 100_000,  # 237,172 before
    "prediction_metrics_all": 100_000,  # 236,665 before
    "prediction_report": 150_000,  # 1,170,871 before
    "validation_score": 120_000,  # 242,800 before
    "evaluation_checks": 200_000,  # 3,425,013 before
    "submission_checks": 400_000,  # 2,668,622 before
}


@pytest.mark.parametrize("name", SMALL_PLANS)
def test_plans_stay_small(spark, sf_dir, name):
    assert len(catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()) < SMALL_PLANS[name]


@pytest.fixture(scope="module")
def hot(spark):
    """Truth of one key that 400,000,000 links would come from, and three candidates, one of them no link."""
    q = spark.range(20_000).select(F.concat(F.lit("S1-"), "id").alias("q_id"), F.lit("k").alias("key"))
    t = spark.range(20_001).select(F.concat(F.lit("S2-"), "id").alias("t_id"), F.when(F.col("id") < 20_000, "k").otherwise("l").alias("key"))
    cands = spark.createDataFrame([("S1-1", "S2-1", 1), ("S1-1", "S2-20000", 2), ("S1-7", "S2-2", 1)], "q_id string, t_id string, rank int")
    return q.select("q_id", F.lit("US").alias("country")), KeyTruth(q, t), cands


def test_misses_are_counted(hot):
    entities, truth, cands = hot
    got = {(r.dimension, r.value): r.misses for r in metrics.miss_summary(truth, cands, entities).collect()}
    assert got == {("country", "US"): 39_998, ("source", "S2"): 39_998, ("true_links", "20000"): 39_998}


def test_key_truth_is_pair_truth(spark, sf_dir):
    s = catalog.Setting(spark, sf_dir)
    country = s.s1.withColumnRenamed("entity_id", "q_id")
    few = s.candidates().where("rank > 1")
    one, two = (sorted(map(tuple, metrics.miss_summary(t, few, country).collect())) for t in (s.links, s.truth))
    assert one == two and one


def test_hot_key_is_counted(hot):
    entities, truth, cands = hot
    e = {r.q_id: tuple(r)[1:4] for r in metrics.per_entity(entities, truth, cands).where("predicted > 0").collect()}
    assert e == {"S1-1": (20_000, 2, 1), "S1-7": (20_000, 1, 1)}


def test_wrong_pairs(hot):
    _, truth, cands = hot
    assert [tuple(r) for r in metrics.first_examples(metrics.wrong_pairs(truth, cands), "fp").collect()] == [("S1-1", "S2-20000")]


def test_training_summary_of_nothing(spark):
    """As in SQL, a sum of nothing is null."""
    assert tuple(model.training_summary(spark.createDataFrame([], "label int")).first()) == (0, None, None)
