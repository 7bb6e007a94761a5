"""Candidate retrieval: multi-view blocking keys, a capped equi-join on them, evidence per pair,
ranking and top-K.

Key frequencies are counted first (partial counts combine before the shuffle) and keys above the
cap are dropped before any pair is made, so no key, however common, makes more than cap pairs a
query. Pairs are then aggregated by (query, target) and only the best K of a query go on.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import jaccard

# Bit and weight (in tenths, so that sums are exact) of each view.
BITS = {"NX": 1, "N2": 2, "NA": 4, "HN": 8, "AX": 16, "HA": 32, "N1": 64, "NS": 128}
TENTHS = {"NX": 40, "N2": 30, "NA": 25, "HN": 25, "AX": 20, "HA": 15, "N1": 10, "NS": 7}


def blocking_keys(n: Column, a: Column, num: Column, ctry: Column) -> Column:
    """Keys of the eight views of a record (20 at most, without repeats)."""
    none = F.array().cast("array<string>")
    two, one = F.slice(n, 1, 2), F.slice(a, 1, 2)
    key = lambda *parts: F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    whole = lambda tag, x: F.when(F.size(x) > 0, F.array(key(tag, F.array_join(F.array_sort(x), "|")))).otherwise(none)
    pairs = [(F.get(n, F.lit(i)), F.get(n, F.lit(j))) for i, j in combinations(range(4), 2)]
    both = F.array_compact(F.array(*[F.when(y.isNotNull(), key("N2", F.least(x, y), F.greatest(x, y))) for x, y in pairs]))
    return F.array_distinct(F.concat(
        whole("NX", n),
        F.transform(F.filter(two, lambda x: F.length(x) >= 7), lambda x: key("N1", ctry, x)),
        F.transform(F.filter(two, lambda x: F.length(x) >= 5), lambda x: key("NS", ctry, F.substring(x, 1, 5))),
        both,
        F.flatten(F.transform(two, lambda x: F.transform(one, lambda y: key("NA", x, y)))),
        F.when(num.isNotNull(), F.transform(two, lambda x: key("HN", num, x))).otherwise(none),
        F.when(num.isNotNull(), F.transform(one, lambda y: key("HA", num, y))).otherwise(none),
        whole("AX", a),
    ))


def with_keys(view: DataFrame) -> DataFrame:
    return view.withColumn("keys", blocking_keys(F.col("nt"), F.col("at"), F.col("num"), F.col("ctry")))


def view_of(key: Column) -> Column:
    return F.substring_index(key, "|", 1)


def _lookup(values: dict[str, int], tag: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), tag)


def postings(targets: DataFrame, id_col: str = "t_id") -> DataFrame:
    """(key, id) of keyed targets."""
    return targets.select(id_col, F.explode("keys").alias("key"))


def key_frequency(posts: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """(key, n) over targets; with ``asked``, only of keys that occur there."""
    if asked is not None:
        posts = posts.join(asked.select("key").distinct(), "key", "left_semi")
    return posts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def pair_evidence(queries: DataFrame, targets: DataFrame, cap: int = 200, query_cap: int | None = None) -> DataFrame:
    """(q_id, t_id, weight10, shared, mask): sum of view weights in tenths, number of shared keys,
    or of view bits, over keys that have 1 to ``cap`` targets (and up to ``query_cap`` queries)."""
    q, t = postings(queries, "q_id"), postings(targets)
    if query_cap is not None:
        q = q.join(q.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= query_cap).select("key"), "key", "left_semi")
    usable = key_frequency(t, q).where(F.col("n") <= cap).select("key")
    met = q.join(usable, "key", "left_semi").join(t, "key")
    tag = view_of(F.col("key"))
    return met.groupBy("q_id", "t_id").agg(
        F.sum(_lookup(TENTHS, tag)).cast("long").alias("weight10"), F.count(F.lit(1)).alias("shared"),
        F.bit_or(_lookup(BITS, tag)).alias("mask"))


def pair_score(q: str, t: str, shared: Column) -> Column:
    """Preliminary score of a pair of views whose columns carry the prefixes ``q`` and ``t``."""
    c = lambda s, x: F.col(f"{s}{x}")
    nq, nt = c(q, "num"), c(t, "num")
    return (
        jaccard(c(q, "nt"), c(t, "nt")) * 4.0 + jaccard(c(q, "at"), c(t, "at")) * 2.0 + F.least(shared, F.lit(4)).cast("double") * 0.4
        + F.when(nq.isNull() | nt.isNull(), 0.0).when(nq == nt, 0.8).otherwise(-0.7)
        + F.when((c(q, "ctry") != "") & (c(q, "ctry") == c(t, "ctry")), 0.25).otherwise(0.0)
    )


def prefixed(view: DataFrame, p: str, *ids: str) -> DataFrame:
    return view.select(*ids, *[F.col(x).alias(f"{p}{x}") for x in ("nt", "at", "num", "ctry")])


def scored_pairs(queries: DataFrame, targets: DataFrame, cap: int = 200, query_cap: int | None = None) -> DataFrame:
    """Evidence with the preliminary score, and the target's ``rid`` for ties."""
    pairs = pair_evidence(queries, targets, cap, query_cap)
    # tokens of targets travel as one string to each pair: an array has an offset and padding for each
    t = prefixed(targets, "t_", "t_id", "rid").withColumns({c: F.array_join(c, " ") for c in ("t_nt", "t_at")})
    met = pairs.join(t, "t_id").join(prefixed(queries, "q_", "q_id"), "q_id")
    met = met.withColumns({c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, " ")) for c in ("t_nt", "t_at")})
    return met.select("q_id", "t_id", "rid", "weight10", "shared", "mask", pair_score("q_", "t_", F.col("shared")).alias("score"))


ORDERS = {
    "sketch": [("score", False), ("rid", True)],
    "weight": [("weight10", False), ("rid", True)],
    "batch": [("score", False), ("t_id", False)],
}


def top_k(pairs: DataFrame, k: int, ranking: str = "sketch") -> DataFrame:
    """The best k pairs of each query with their 1-based rank; a window limit is pushed below the
    shuffle by the optimizer."""
    w = Window.partitionBy("q_id").orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in ORDERS[ranking]])
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def firsts(pairs: DataFrame, rankings: tuple[str, ...]) -> DataFrame:
    """The first target of each query in each ranking, a column for each; pairs are read once."""
    best = lambda r: F.struct(*[(F.col(c) if up == ORDERS[r][-1][1] else -F.col(c)).alias(f"k{i}") for i, (c, up) in enumerate(ORDERS[r])])
    pick = lambda r: (F.min_by if ORDERS[r][-1][1] else F.max_by)("t_id", best(r)).alias(r)
    return pairs.groupBy("q_id").agg(*[pick(r) for r in rankings])


def candidates(queries: DataFrame, targets: DataFrame, k: int = 150, cap: int = 200, ranking: str = "sketch", query_cap: int | None = None) -> DataFrame:
    """Ranked candidates of keyed views: q_id, t_id, rank, score, shared, mask, weight10."""
    if ranking == "weight":
        return top_k(pair_evidence(queries, targets, cap, query_cap).join(targets.select("t_id", "rid"), "t_id"), k, ranking)
    return top_k(scored_pairs(queries, targets, cap, query_cap), k, ranking)


def candidate_lists(queries: DataFrame, cands: DataFrame) -> DataFrame:
    """One row per query, empty lists too: ids in rank order and their view masks."""
    lists = cands.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct("rank", "t_id", "mask"))).alias("l"))
    return queries.select("q_id").join(lists, "q_id", "left").select(
        "q_id", F.coalesce(F.array_join(F.transform("l", lambda x: x["t_id"]), ","), F.lit("")).alias("candidate_entity_ids"),
        F.coalesce(F.array_join(F.transform("l", lambda x: x["mask"].cast("string")), ","), F.lit("")).alias("candidate_view_masks"))


def retrieval_report(queries: DataFrame, targets: DataFrame, cands: DataFrame, cap: int = 200) -> DataFrame:
    """One row: queries, pairs, pairs a query, reduction ratio, and used and skipped keys, counted
    per occurrence in a query."""
    q = postings(queries, "q_id")
    freq = key_frequency(postings(targets), q)
    used = q.join(freq, "key").agg(
        F.coalesce(F.sum(F.when(F.col("n") <= cap, 1).otherwise(0)), F.lit(0)).alias("used_blocks"),
        F.coalesce(F.sum(F.when(F.col("n") > cap, 1).otherwise(0)), F.lit(0)).alias("skipped_blocks"))
    nq, nt, n = queries.agg(F.count(F.lit(1)).alias("queries")), targets.agg(F.count(F.lit(1)).alias("targets")), cands.agg(F.count(F.lit(1)).alias("candidate_pairs"))
    one = nq.crossJoin(nt).crossJoin(n).crossJoin(used)  # single rows
    return one.select(
        "queries", "targets", "candidate_pairs", F.try_divide("candidate_pairs", "queries").alias("pairs_per_query"),
        (1 - F.try_divide(F.col("candidate_pairs").cast("double"), F.col("queries").cast("double") * F.col("targets"))).alias("reduction_ratio"),
        "used_blocks", "skipped_blocks")
