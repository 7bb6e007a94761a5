"""Pair features, contradiction gates and the heuristic score.

Pairs carry the profile columns of both sides with the prefixes ``q_`` and ``t_``, and the rank
and the number of candidates of the query. Gates on columns come first; the function with the
edit similarities runs once per pair that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import raw_house_number
from ..functions.packing import packed, unpacked
from ..functions.similarity import compared, jaccard_of, overlap_of

# Names and order of the features, and the constants of the scores below.
FEATURES = [
    "country_match", "name_exact", "name_jaccard", "name_overlap", "name_fuzz_ratio", "name_token_sort_ratio", "name_token_set_ratio",
    "name_len_diff", "name_token_count_diff", "name_legal_suffix_status", "addr_exact", "addr_jaccard", "addr_overlap", "addr_fuzz_ratio",
    "addr_token_sort_ratio", "addr_len_diff", "addr_missing", "house_num_status", "numeric_jaccard", "numeric_conflict",
    "name_x_addr_jaccard", "name_x_addr_sort", "sketch_score", "reciprocal_rank", "is_top1", "total_candidates",
]
EDIT = ["name_fuzz_ratio", "name_token_sort_ratio", "name_token_set_ratio", "addr_fuzz_ratio", "addr_token_sort_ratio", "name_x_addr_sort"]
NATIVE = [f for f in FEATURES if f not in EDIT]
LEAST = (0.50, 0.55)  # name_overlap or name_token_sort_ratio of the name gate
PROFILE = ["addr_raw", "ctry", "name_clean", "addr_clean", "legal", "house", "nums"]  # tokens are made of the clean strings


def q(c: str) -> Column:
    return F.col(f"q_{c}")


def t(c: str) -> Column:
    return F.col(f"t_{c}")


def with_profiles(cands: DataFrame, q_profiles: DataFrame, t_profiles: DataFrame, long_texts: bool = False) -> DataFrame:
    """Candidates (q_id, t_id, rank, ...) with both profiles. Rank and the number of candidates are
    those of the whole list; a candidate without a profile goes. ``long_texts`` travel packed."""
    total = cands.groupBy("q_id").agg(F.count(F.lit(1)).alias("total"))
    side = lambda df, p: df.select(F.col("entity_id").alias(f"{p}_id"), *[F.col(c).alias(f"{p}_{c}") for c in PROFILE])
    clean, left = ["t_name_clean", "t_addr_clean"], side(t_profiles, "t")
    if long_texts:
        left = left.withColumn("_packed", packed(F.concat_ws("\n", *clean))).drop(*clean)  # no clean string has line breaks
    # the texts of targets travel; the pairs of a query come together, so its tokens are sorted once
    met = cands.join(total, "q_id").join(left, "t_id").join(side(q_profiles, "q"), "q_id")
    if long_texts:
        met = met.withColumn("_text", unpacked(F.col("_packed"))).withColumns({c: F.substring_index("_text", "\n", i) for c, i in zip(clean, (1, -1), strict=True)}).drop("_text", "_packed")
    return met


def country_ok() -> Column:
    return ~((q("ctry") != "") & (t("ctry") != "") & (q("ctry") != t("ctry")))


def house_ok(form: str = "token") -> Column:
    a, b = (q("house"), t("house")) if form == "token" else (raw_house_number(q("addr_raw")), raw_house_number(t("addr_raw")))
    return F.coalesce(a == b, F.lit(True))


def name_ok() -> Column:
    """Needs name_overlap and name_token_sort_ratio."""
    return (F.col("name_overlap") >= LEAST[0]) | (F.col("name_token_sort_ratio") >= LEAST[1])


def flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def status(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).otherwise(-1.0)


def native_features(pairs: DataFrame) -> DataFrame:
    """The features that need no edit similarity."""
    return _native(_compared(pairs, F.lit(0), 0)).drop("_n", "_a")


def pair_features(pairs: DataFrame, name_gate: Column | None = None) -> DataFrame:
    """All features. ``name_gate``: of which pairs only those that pass the name gate are wanted; the others of them go as soon
    as that is known, before most of their similarities are computed."""
    out = _compared(pairs, F.lit(2) if name_gate is None else F.when(name_gate, 3).otherwise(2), 1, name_gate is not None)
    return _edit(_native(out)).drop("_n", "_a")


def _compared(pairs: DataFrame, name: Column, addr: int, some: bool = False) -> DataFrame:
    """Adds the comparisons of names and addresses, each made once."""
    out = pairs.withColumn("_n", compared(q("name_clean"), t("name_clean"), name, *LEAST))
    return (out.where(F.col("_n").isNotNull()) if some else out).withColumn("_a", compared(q("addr_clean"), t("addr_clean"), F.lit(addr)))


def _native(pairs: DataFrame) -> DataFrame:
    diff = lambda x: F.abs(F.octet_length(q(x)) - F.octet_length(t(x))).cast("double")  # noqa: E731 - clean strings are ASCII
    exact = lambda x: flag((q(x) != "") & (q(x) == t(x)))
    both = (F.size(q("nums")) > 0) & (F.size(t("nums")) > 0)
    sets = lambda x: [F.col(f"{x}.{c}") for c in ("shared", "left", "right")]
    pairs = pairs.withColumn("_nums", F.size(F.array_intersect(q("nums"), t("nums"))))  # the sets meet once
    out = pairs.withColumns({
        "country_match": flag((q("ctry") != "") & (q("ctry") == t("ctry"))),
        "name_exact": exact("name_clean"), "name_jaccard": jaccard_of(*sets("_n")), "name_overlap": overlap_of(*sets("_n")),
        "name_len_diff": diff("name_clean"), "name_token_count_diff": F.abs(F.col("_n.lefts") - F.col("_n.rights")).cast("double"),
        "name_legal_suffix_status": status(q("legal"), t("legal")),
        "addr_exact": exact("addr_clean"), "addr_jaccard": jaccard_of(*sets("_a")), "addr_overlap": overlap_of(*sets("_a")),
        "addr_len_diff": diff("addr_clean"), "addr_missing": flag((q("addr_clean") == "") | (t("addr_clean") == "")),
        "house_num_status": status(q("house"), t("house")), "numeric_jaccard": jaccard_of(F.col("_nums"), F.size(q("nums")), F.size(t("nums"))),
        "numeric_conflict": flag(both & (F.col("_nums") == 0)),
        "reciprocal_rank": 1.0 / F.col("rank"), "is_top1": flag(F.col("rank") == 1), "total_candidates": F.col("total").cast("double"),
    })
    return out.withColumns({
        "name_x_addr_jaccard": F.col("name_jaccard") * F.col("addr_jaccard"),
        "sketch_score": F.col("name_jaccard") * 4.0 + F.col("addr_jaccard") * 2.0
        + F.when(F.col("house_num_status") > 0, 0.8).when(F.col("house_num_status") < 0, -0.7).otherwise(0.0)
        + F.when(F.col("country_match") > 0, 0.25).otherwise(0.0),
    }).drop("_nums")


def _edit(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({
        "name_fuzz_ratio": F.col("_n.fuzz"), "name_token_sort_ratio": F.col("_n.sort"), "name_token_set_ratio": F.col("_n.whole"),
        "addr_fuzz_ratio": F.col("_a.fuzz"), "addr_token_sort_ratio": F.col("_a.sort"),
        "name_x_addr_sort": F.col("_n.sort") * F.when(F.col("addr_missing") > 0, 0.6).otherwise(F.col("_a.sort")),
    })


def gated(pairs: DataFrame, house: str = "token", name: bool = True) -> DataFrame:
    """Features of the pairs that pass the country, house-number and (if asked) name gates."""
    return pair_features(pairs.where(country_ok() & house_ok(house)), F.lit(True) if name else None)


def heuristic_score(pairs: DataFrame) -> DataFrame:
    """Adds ``prob``: -1 where a gate rejects, else 0.6 name + 0.4 address, 0.9 at least for equal
    names. Needs the features."""
    name = F.col("name_token_sort_ratio") * 0.5 + F.col("name_token_set_ratio") * 0.3 + F.col("name_jaccard") * 0.2
    addr = F.when(F.col("addr_missing") > 0, 0.65).otherwise(F.col("addr_token_sort_ratio") * 0.6 + F.col("addr_jaccard") * 0.4)
    score = name * 0.6 + addr * 0.4
    score = F.when(F.col("name_exact") > 0, F.greatest(score, F.lit(0.9))).otherwise(score)
    weak = (F.col("name_token_sort_ratio") < 0.60) & (F.col("name_exact") == 0)
    return pairs.withColumn("prob", F.when(~country_ok() | ~house_ok() | weak, -1.0).otherwise(score))


def matches(scored: DataFrame, threshold: float) -> DataFrame:
    """Pairs at the threshold or above, each (query, target) once at its best rank."""
    return scored.where((F.col("prob") >= threshold) & (F.col("prob") > 0)).groupBy("q_id", "t_id").agg(F.min("rank").alias("rank"), F.max("prob").alias("prob"))
