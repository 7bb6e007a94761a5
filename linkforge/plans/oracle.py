"""DuckDB SQL of the catalogue's queries, put together from common table expressions."""

from __future__ import annotations

from ..functions import normalize as N
from ..operators.blocking import BITS, TENTHS
from ..operators.metrics import BASELINE_THRESHOLDS, MODEL_THRESHOLDS
from .catalog import CAP, K


def _map(d: dict) -> str:
    return "MAP {" + ", ".join(f"'{k}': {v!r}" for k, v in d.items()) + "}"


def _list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _aliased(tokens: str, aliases: dict) -> str:
    return f"list_transform({tokens}, lambda x: coalesce({_map(aliases)}[x], x))"


def _raw(c: str) -> str:
    return f"regexp_extract_all(strip_accents(replace(lower(replace(coalesce({c}, ''), '&', ' and ')), 'ß', 'ss')), '[a-z0-9]+')"


NUM = "regexp_full_match(x, '[0-9]{1,6}')"


def _selected(tokens: str, ignored: list[str], n: int) -> str:
    good = f"list_distinct(list_filter({tokens}, lambda x: length(x) >= 3 AND NOT list_contains({_list(ignored)}, x) AND NOT {NUM}))"
    return f"list_transform(list_sort(list_transform({good}, lambda x: {{'k': -length(x), 'v': x}})), lambda s: s.v)[1:{n}]"


PART = "ent AS (SELECT 'S' || (1 + p_partkey % 3) || '-' || p_partkey AS id, p_partkey AS rid, p_name AS name, CASE WHEN p_partkey % 37 = 0 THEN '' ELSE p_size || ' ' || p_brand || ' ' || p_type END AS addr, lower(p_type) AS ctry, p_name || '|' || p_brand AS tk FROM part)"
DOCS = f"raw AS (SELECT doc_id, lang, md5(text) AS tk, {_raw('text')} AS t FROM documents), ent AS (SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS id, doc_id AS rid, array_to_string(t[1:(len(t) + 1) // 2], ' ') AS name, array_to_string(t[(len(t) + 1) // 2 + 1:len(t)], ' ') AS addr, lang AS ctry, tk FROM raw)"
VIEW = f"""tok AS (SELECT *, {_aliased(_raw("name"), N.BLOCK_ALIASES)} AS n, {_aliased(_raw("addr"), N.BLOCK_ALIASES)} AS a FROM ent),
vw AS (SELECT id, rid, ctry, tk, {_selected("n", N.LEGAL, 4)} AS nt, {_selected("a", N.ADDRESS_GENERIC, 3)} AS ad, list_filter(a, lambda x: {NUM})[1] AS num FROM tok)"""
KEYS = """ks AS (SELECT id, unnest(list_distinct(flatten([
  CASE WHEN len(nt) > 0 THEN ['NX|' || array_to_string(list_sort(nt), '|')] ELSE []::VARCHAR[] END,
  list_transform(list_filter(nt[1:2], lambda x: length(x) >= 7), lambda x: 'N1|' || ctry || '|' || x),
  list_transform(list_filter(nt[1:2], lambda x: length(x) >= 5), lambda x: 'NS|' || ctry || '|' || x[1:5]),
  list_filter([CASE WHEN nt[2] IS NOT NULL THEN 'N2|' || least(nt[1], nt[2]) || '|' || greatest(nt[1], nt[2]) END,
    CASE WHEN nt[3] IS NOT NULL THEN 'N2|' || least(nt[1], nt[3]) || '|' || greatest(nt[1], nt[3]) END,
    CASE WHEN nt[4] IS NOT NULL THEN 'N2|' || least(nt[1], nt[4]) || '|' || greatest(nt[1], nt[4]) END,
    CASE WHEN nt[3] IS NOT NULL THEN 'N2|' || least(nt[2], nt[3]) || '|' || greatest(nt[2], nt[3]) END,
    CASE WHEN nt[4] IS NOT NULL THEN 'N2|' || least(nt[2], nt[4]) || '|' || greatest(nt[2], nt[4]) END,
    CASE WHEN nt[4] IS NOT NULL THEN 'N2|' || least(nt[3], nt[4]) || '|' || greatest(nt[3], nt[4]) END], lambda x: x IS NOT NULL),
  flatten(list_transform(nt[1:2], lambda x: list_transform(ad[1:2], lambda y: 'NA|' || x || '|' || y))),
  CASE WHEN num IS NOT NULL THEN list_transform(nt[1:2], lambda x: 'HN|' || num || '|' || x) ELSE []::VARCHAR[] END,
  CASE WHEN num IS NOT NULL THEN list_transform(ad[1:2], lambda y: 'HA|' || num || '|' || y) ELSE []::VARCHAR[] END,
  CASE WHEN len(ad) > 0 THEN ['AX|' || array_to_string(list_sort(ad), '|')] ELSE []::VARCHAR[] END]))) AS key FROM vw),
qk AS (SELECT id AS q_id, key FROM ks WHERE id LIKE 'S1-%'), tkk AS (SELECT id AS t_id, key FROM ks WHERE id NOT LIKE 'S1-%'),
fr AS (SELECT key, count(*) AS n FROM tkk WHERE key IN (SELECT key FROM qk) GROUP BY key)"""


def _jac(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b})) / len(list_distinct({a} || {b})) ELSE 0 END)::DOUBLE"


def _evidence(query_cap: int | None = None) -> str:
    limit = f" AND key IN (SELECT key FROM qk GROUP BY key HAVING count(*) <= {query_cap})" if query_cap else ""
    return f"""ev AS (SELECT q_id, t_id, sum({_map(TENTHS)}[split_part(key, '|', 1)])::BIGINT AS weight10, count(*) AS shared, bit_or({_map(BITS)}[split_part(key, '|', 1)]::INTEGER) AS mask
FROM qk JOIN tkk USING (key) WHERE key IN (SELECT key FROM fr WHERE n <= {CAP}){limit} GROUP BY q_id, t_id)"""


SCORED = f"""sc AS (SELECT e.*, t.rid, {_jac("q.nt", "t.nt")} * 4.0::DOUBLE + {_jac("q.ad", "t.ad")} * 2.0::DOUBLE + least(shared, 4)::DOUBLE * 0.4::DOUBLE
  + CASE WHEN q.num IS NULL OR t.num IS NULL THEN 0.0::DOUBLE WHEN q.num = t.num THEN 0.8::DOUBLE ELSE -0.7::DOUBLE END
  + CASE WHEN q.ctry <> '' AND q.ctry = t.ctry THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM ev e JOIN vw q ON q.id = e.q_id JOIN vw t ON t.id = e.t_id)"""


def _top(order: str) -> str:
    return f"ca AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY {order})::INTEGER AS rank FROM sc QUALIFY rank <= {K})"


TRUTH = "tr AS (SELECT q.id AS q_id, t.id AS t_id FROM ent q JOIN ent t ON q.tk = t.tk WHERE q.id LIKE 'S1-%' AND t.id NOT LIKE 'S1-%'), s1 AS (SELECT id AS q_id, ctry FROM ent WHERE id LIKE 'S1-%')"
SKETCH = "score DESC, rid"
CANDS = ", ".join([PART, VIEW, KEYS, _evidence(), SCORED, _top(SKETCH), TRUTH])
PRED = "pr AS (SELECT * FROM ca WHERE round(score, 6) >= 6.0)"


def _f05(g: str, p: str, h: str) -> str:
    return f"CASE WHEN {g} = 0 AND {p} = 0 THEN 1.0::DOUBLE WHEN {g} = 0 OR {p} = 0 OR {h} = 0 THEN 0.0::DOUBLE ELSE 1.25::DOUBLE * ({h} / {p}) * ({h} / {g}) / (0.25::DOUBLE * ({h} / {p}) + ({h} / {g})) END"


def _entity(pred: str) -> str:
    return f"""pe AS (SELECT q_id, (SELECT count(*) FROM tr WHERE tr.q_id = s1.q_id) AS gold, (SELECT count(*) FROM {pred} p WHERE p.q_id = s1.q_id) AS predicted,
  (SELECT count(*) FROM {pred} p JOIN tr ON tr.q_id = p.q_id AND tr.t_id = p.t_id WHERE p.q_id = s1.q_id) AS hit FROM s1)"""


TOPK = "SELECT q_id, t_id, rank, round(score, 6) AS score, shared, mask FROM ca"
MEMBER = "('0x' || substr(md5('2026:' || {0}), 1, 8))::BIGINT < 858993459"


def _metrics(on: str) -> str:
    return f"""WITH {CANDS}, {PRED}, {_entity("pr")},
a AS (SELECT count(*) AS entities, avg({_f05("gold", "predicted", "hit")}) AS macro, coalesce(sum(hit) FILTER ({on}), 0)::BIGINT AS tp, coalesce(sum(predicted - hit) FILTER ({on}), 0)::BIGINT AS fp,
  coalesce(sum(gold - hit) FILTER ({on}), 0)::BIGINT AS fn, coalesce(sum(predicted), 0)::BIGINT AS total_predicted,
  coalesce(count(*) FILTER (gold = 0 AND predicted = 0) / nullif(count(*) FILTER (gold = 0), 0), 1.0)::DOUBLE AS sa FROM pe),
b AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 1.0)::DOUBLE AS p, coalesce(tp / nullif(tp + fn, 0), 0.0)::DOUBLE AS r FROM a)
SELECT entities, round(macro, 6) AS macro_f05, tp, fp, fn, total_predicted, round(sa, 6) AS singleton_accuracy, round(p, 6) AS micro_precision, round(r, 6) AS micro_recall,
  round(coalesce(1.25::DOUBLE * p * r / nullif(0.25::DOUBLE * p + r, 0), 0.0), 6) AS micro_f05 FROM b"""


_PROFILE = f"""pf AS (SELECT id, rid, lower(trim(ctry)) AS ctry, {_aliased(_raw("name"), N.PAIR_ALIASES)} AS nt, {_aliased(_raw("addr"), N.PAIR_ALIASES)} AS ad, addr FROM ent),
po AS (SELECT *, array_to_string(nt, ' ') AS nc, array_to_string(ad, ' ') AS ac, list_distinct(nt) AS ns, list_distinct(ad) AS asx, list_filter(nt, lambda x: list_contains({_list(N.LEGAL)}, x))[-1] AS legal,
  list_filter(ad, lambda x: {NUM})[1] AS house, list_distinct(list_filter(ad, lambda x: {NUM})) AS nums,
  list_filter(list_transform(regexp_split_to_array(addr, '\\s+'), lambda w: regexp_replace(w, '^[ ,.\\-#/\\\\]+|[ ,.\\-#/\\\\]+$', '', 'g')), lambda x: {NUM})[1] AS raw_house FROM pf)"""


def _ov(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b})) / least(len({a}), len({b})) ELSE 0 END)::DOUBLE"


def _flag(c: str) -> str:
    return f"CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def _status(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 0.0::DOUBLE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END"


_PAIRS = f"WITH {CANDS}, {_PROFILE}, tot AS (SELECT q_id, count(*) AS total FROM ca GROUP BY q_id), pp AS (SELECT c.q_id, c.t_id, c.rank, total, q, t FROM ca c JOIN tot USING (q_id) JOIN po q ON q.id = c.q_id JOIN po t ON t.id = c.t_id)"
_FEATURES = f"""{_PAIRS}, f AS (SELECT q_id, t_id, rank, total, {_flag("q.ctry <> '' AND q.ctry = t.ctry")} AS country_match, {_flag("q.nc <> '' AND q.nc = t.nc")} AS name_exact, {_jac("q.ns", "t.ns")} AS name_jaccard, {_ov("q.ns", "t.ns")} AS name_overlap,
  abs(length(q.nc) - length(t.nc))::DOUBLE AS name_len_diff, abs(len(q.nt) - len(t.nt))::DOUBLE AS name_token_count_diff, {_status("q.legal", "t.legal")} AS name_legal_suffix_status,
  {_flag("q.ac <> '' AND q.ac = t.ac")} AS addr_exact, {_jac("q.asx", "t.asx")} AS addr_jaccard, {_ov("q.asx", "t.asx")} AS addr_overlap, abs(length(q.ac) - length(t.ac))::DOUBLE AS addr_len_diff,
  {_flag("q.ac = '' OR t.ac = ''")} AS addr_missing, {_status("q.house", "t.house")} AS house_num_status, {_jac("q.nums", "t.nums")} AS numeric_jaccard,
  {_flag("len(q.nums) > 0 AND len(t.nums) > 0 AND NOT list_has_any(q.nums, t.nums)")} AS numeric_conflict, 1.0::DOUBLE / rank AS reciprocal_rank, {_flag("rank = 1")} AS is_top1, total::DOUBLE AS total_candidates FROM pp)"""
_SKETCH_SCORE = "name_jaccard * 4.0::DOUBLE + addr_jaccard * 2.0::DOUBLE + CASE WHEN house_num_status > 0 THEN 0.8::DOUBLE WHEN house_num_status < 0 THEN -0.7::DOUBLE ELSE 0 END + CASE WHEN country_match > 0 THEN 0.25::DOUBLE ELSE 0 END"


def _check(file: str, check: str, bad: str) -> str:
    return f"SELECT '{file}' AS file, '{check}' AS \"check\", count(*) AS n, coalesce(array_to_string(list_sort(list(DISTINCT v))[1:3], ','), '') AS sample FROM ({bad})"


def _file_checks(file: str, t: str, header: bool = True, ids: bool = True) -> list[str]:
    """Of lists ``t`` (q_id, ids)."""
    return [
        _check(file, "header", f"SELECT '{file}' AS v" + (" WHERE false" if header else "")),
        _check(file, "duplicate_row", f"SELECT q_id AS v FROM {t} GROUP BY q_id HAVING count(*) > 1"),
        *([_check(file, "duplicate_id_in_list", f"SELECT q_id AS v FROM {t} WHERE len(ids) <> len(list_distinct(ids))")] if ids else []),
        _check(file, "missing_row", f"SELECT q_id AS v FROM s1 WHERE q_id NOT IN (SELECT q_id FROM {t})"),
        _check(file, "unknown_row", f"SELECT DISTINCT q_id AS v FROM {t} WHERE q_id NOT IN (SELECT q_id FROM s1)"),
    ]


def _unknown_ids(file: str, t: str) -> str:
    return _check(file, "unknown_id", f"SELECT DISTINCT v FROM (SELECT unnest(ids) AS v FROM {t}) WHERE v NOT IN (SELECT id FROM ent WHERE id NOT LIKE 'S1-%')")


def _lists(name: str, pairs: str) -> str:
    return f"{name} AS (SELECT s1.q_id, coalesce(list_sort(list(t_id) FILTER (t_id IS NOT NULL)), []::VARCHAR[]) AS ids, split_part(s1.q_id, '-', 2)::BIGINT AS n FROM s1 LEFT JOIN {pairs} p ON p.q_id = s1.q_id GROUP BY s1.q_id)"


def _spoiled(name: str, lists: str) -> str:
    return f"""{name}_k AS (SELECT q_id, ids || CASE WHEN n % 17 = 0 THEN ['S9-1'] ELSE []::VARCHAR[] END || CASE WHEN n % 19 = 0 THEN ids[1:1] ELSE []::VARCHAR[] END AS ids, n FROM {lists} WHERE n % 11 <> 0),
{name} AS (SELECT q_id, ids FROM {name}_k UNION ALL SELECT q_id, ids FROM {name}_k WHERE n % 13 = 0 UNION ALL SELECT q_id || 'x', ids FROM {lists} WHERE n % 23 = 0)"""


def _submission(matching: str, candidate: str, header: bool) -> str:
    out = [*_file_checks("matching", matching), _unknown_ids("matching", matching), *_file_checks("candidate", candidate, header), _unknown_ids("candidate", candidate)]
    pair = lambda t: f"(SELECT q_id, unnest(ids) AS t_id FROM {t})"
    out.append(_check("matching", "not_a_candidate", f"SELECT DISTINCT q_id AS v FROM {pair(matching)} m ANTI JOIN {pair(candidate)} c USING (q_id, t_id)"))
    return " UNION ALL ".join(out)


_LABELLED = f"WITH {CANDS}, lb AS (SELECT ca.q_id, ca.t_id, rank, CASE WHEN tr.t_id IS NULL THEN 0 ELSE 1 END AS label FROM ca LEFT JOIN tr ON tr.q_id = ca.q_id AND tr.t_id = ca.t_id)"
_MISSED = f"WITH {CANDS}, mi AS (SELECT tr.q_id, tr.t_id FROM tr SEMI JOIN ca USING (q_id) ANTI JOIN ca USING (q_id, t_id))"


def _audit(table: str, name: str) -> str:
    counts = {"rows": "count(*)", "duplicate_ids": "count(*) - count(DISTINCT id)", "missing_business_name": "count(*) FILTER (trim(name) = '')", "missing_business_address": "count(*) FILTER (trim(addr) = '')", "missing_country": "count(*) FILTER (trim(coalesce(ctry, '')) = '')"}
    parts = [f"SELECT '{name}' AS source, '{k}' AS metric, {v} AS value FROM {table}" for k, v in counts.items()]
    parts.append(f"SELECT '{name}', 'country:' || CASE WHEN trim(coalesce(ctry, '')) = '' THEN '<missing>' ELSE ctry END, count(*) FROM {table} GROUP BY 2")
    return " UNION ALL ".join(parts)


def _profile_sql() -> str:
    cols = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
    blank = lambda c, t: f"count(*) FILTER ({c} IS NULL" + (f" OR trim({c}) = ''" if t == "string" else "") + ")"
    one = [f"SELECT 'customer' AS \"table\", '{c}' AS \"column\", '{t}' AS dtype, round({blank(c, t)} / count(*), 6) AS missing_fraction, round((count(DISTINCT {c}) + max(({c} IS NULL)::INT)) / count(*), 6) AS unique_fraction, count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM customer)) AS duplicate_rows FROM customer" for c, t in cols.items()]
    return " UNION ALL ".join(one)


def _sweep(thresholds: list[float], scored: str) -> str:
    values = ", ".join(f"({v}::DOUBLE)" for v in thresholds)
    return f"""th(threshold) AS (VALUES {values}), g AS (SELECT q_id, count(*) AS gold FROM tr GROUP BY q_id), sd AS ({scored}),
pc AS (SELECT threshold, sd.q_id, count(*) AS predicted, count(tr.t_id) AS hit FROM sd JOIN th ON prob >= threshold AND prob > 0 LEFT JOIN tr ON tr.q_id = sd.q_id AND tr.t_id = sd.t_id GROUP BY threshold, sd.q_id),
x AS (SELECT th.threshold, s1.q_id, coalesce(gold, 0) AS gold, coalesce(predicted, 0) AS predicted, coalesce(hit, 0) AS hit FROM s1 CROSS JOIN th LEFT JOIN g ON g.q_id = s1.q_id LEFT JOIN pc ON pc.q_id = s1.q_id AND pc.threshold = th.threshold),
m AS (SELECT threshold, avg({_f05('gold', 'predicted', 'hit')}) AS f, sum(predicted)::BIGINT AS predicted FROM x GROUP BY threshold)
SELECT threshold, round(f, 6) AS macro_f05, predicted, row_number() OVER (ORDER BY round(f, 12) DESC, threshold) = 1 AS best FROM m"""


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of strings of up to 120 characters: a row of bits, one step for
    each character of b."""
    mask = f"coalesce(list_sum(list_transform(list_filter(range(0, length({a})), lambda i: {a}[i + 1] = c), lambda i: (1::HUGEINT << i::INTEGER)))::HUGEINT, 0::HUGEINT)"
    full = f"((1::HUGEINT << length({a})::INTEGER) - 1::HUGEINT)"
    step = f"list_reduce(list_transform(string_split({b}, ''), lambda c: {mask}), lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full}, {full})"
    return f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE length({a}) - bit_count({step}) END)"


def _ratio(a: str, b: str) -> str:
    return f"(2 * {_lcs(a, b)} / (length({a}) + length({b})))::DOUBLE"


_SIDES = ", ".join(
    f"q.{c} AS {x}q, t.{c} AS {x}t, array_to_string(list_sort(q.{s}), ' ') AS {x}sq, array_to_string(list_sort(t.{s}), ' ') AS {x}st" for x, c, s in (("xn", "nc", "nt"), ("xa", "ac", "ad"))
) + ", " + ", ".join(
    f"array_to_string(list_filter(list_sort(list_distinct({a}.nt)), lambda x: {n} list_contains({b}.nt, x)), ' ') AS {name}"
    for name, a, b, n in (("common", "q", "t", ""), ("lf", "q", "t", "NOT"), ("rt", "t", "q", "NOT"))
)
_SET = f"""CASE WHEN xnq = '' OR xnt = '' THEN 0.0::DOUBLE WHEN common <> '' AND (lf = '' OR rt = '') THEN 1.0::DOUBLE
  WHEN common = '' THEN (1 - (length(lf) + length(rt) - 2 * {_lcs("lf", "rt")}) / (length(lf) + length(rt)))::DOUBLE
  ELSE greatest((1 - (length(lf) + length(rt) - 2 * {_lcs("lf", "rt")}) / (2 * length(common) + 2 + length(lf) + length(rt)))::DOUBLE,
    (1 - (1 + length(lf)) / (2 * length(common) + 1 + length(lf)))::DOUBLE, (1 - (1 + length(rt)) / (2 * length(common) + 1 + length(rt)))::DOUBLE) END"""
_either = lambda x, e: f"CASE WHEN {x}q = '' OR {x}t = '' THEN 0.0::DOUBLE ELSE {e} END"
_FUZZY = f"""{_PAIRS}, y AS (SELECT q_id, t_id, rank, {_SIDES}, NOT (q.ctry <> '' AND t.ctry <> '' AND q.ctry <> t.ctry) AND coalesce(q.house = t.house, true) AS ok, {_flag("q.nc <> '' AND q.nc = t.nc")} AS name_exact,
  {_jac("q.ns", "t.ns")} AS name_jaccard, {_ov("q.ns", "t.ns")} AS name_overlap, {_jac("q.asx", "t.asx")} AS addr_jaccard, {_flag("q.ac = '' OR t.ac = ''")} AS addr_missing FROM pp),
z AS (SELECT *, {_either("xn", _ratio("xnq", "xnt"))} AS name_fuzz_ratio, {_either("xn", _ratio("xnsq", "xnst"))} AS name_token_sort_ratio, {_SET} AS name_token_set_ratio, {_either("xa", _ratio("xaq", "xat"))} AS addr_fuzz_ratio, {_either("xa", _ratio("xasq", "xast"))} AS addr_token_sort_ratio FROM y)"""
_HEURISTIC = """h0 AS (SELECT *, (name_token_sort_ratio * 0.5::DOUBLE + name_token_set_ratio * 0.3::DOUBLE + name_jaccard * 0.2::DOUBLE) * 0.6::DOUBLE
  + (CASE WHEN addr_missing > 0 THEN 0.65::DOUBLE ELSE addr_token_sort_ratio * 0.6::DOUBLE + addr_jaccard * 0.4::DOUBLE END) * 0.4::DOUBLE AS sc0 FROM z),
hs AS (SELECT *, CASE WHEN NOT ok OR (name_token_sort_ratio < 0.6::DOUBLE AND name_exact = 0) THEN -1.0::DOUBLE WHEN name_exact > 0 THEN greatest(sc0, 0.9::DOUBLE) ELSE sc0 END AS prob FROM h0)"""

ORACLE_SQL = {
    "tokens_part": f"WITH {PART} SELECT id AS entity_id, array_to_string({_aliased(_raw('name'), N.BLOCK_ALIASES)}, ' ') AS name_tokens, array_to_string({_aliased(_raw('addr'), N.PAIR_ALIASES)}, ' ') AS address_tokens FROM ent",
    "tokens_docs": f"SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT doc_id, {_raw('text')} AS t FROM documents)",
    "record_view": f"WITH {PART}, {VIEW} SELECT id AS entity_id, array_to_string(nt, ' ') AS nt, array_to_string(ad, ' ') AS ad, num, ctry FROM vw",
    "record_view_docs": f"WITH {DOCS}, {VIEW} SELECT id AS entity_id, array_to_string(nt, ' ') AS nt, array_to_string(ad, ' ') AS ad, num, ctry FROM vw",
    "blocking_keys": f"WITH {PART}, {VIEW}, {KEYS} SELECT id AS entity_id, key FROM ks",
    "key_frequency": f"WITH {PART}, {VIEW}, {KEYS} SELECT key, n FROM fr",
    "broad_blocks": f"WITH {PART}, {VIEW}, {KEYS} SELECT key, n FROM fr WHERE n > {CAP}",
    "pair_evidence": f"WITH {PART}, {VIEW}, {KEYS}, {_evidence()} SELECT * FROM ev",
    "topk_weight": f"WITH {', '.join([PART, VIEW, KEYS, _evidence(), SCORED, _top('weight10 DESC, rid')])} SELECT q_id, t_id, rank, weight10, shared, mask FROM ca",
    "topk_sketch": f"WITH {CANDS} {TOPK}",
    "topk_sketch_docs": f"WITH {', '.join([DOCS, VIEW, KEYS, _evidence(), SCORED, _top(SKETCH)])} {TOPK}",
    "topk_batch_iddesc": f"WITH {', '.join([PART, VIEW, KEYS, _evidence(), SCORED, _top('score DESC, t_id DESC')])} {TOPK}",
    "query_cap": f"WITH {', '.join([PART, VIEW, KEYS, _evidence(60), SCORED, _top('score DESC, t_id DESC')])} {TOPK}",
    "candidate_lists": f"WITH {CANDS} SELECT s1.q_id, coalesce(string_agg(t_id, ',' ORDER BY rank), '') AS candidate_entity_ids, coalesce(string_agg(mask::VARCHAR, ',' ORDER BY rank), '') AS candidate_view_masks FROM s1 LEFT JOIN ca USING (q_id) GROUP BY s1.q_id",
    "retrieval_report": f"""WITH {CANDS}, c AS (SELECT (SELECT count(*) FROM s1) AS queries, (SELECT count(*) FROM ent WHERE id NOT LIKE 'S1-%') AS targets, (SELECT count(*) FROM ca) AS candidate_pairs)
SELECT queries, targets, candidate_pairs, round(candidate_pairs / queries, 6) AS pairs_per_query, round(1 - candidate_pairs / (queries * targets), 6) AS reduction_ratio,
  (SELECT count(*) FROM qk JOIN fr USING (key) WHERE n <= {CAP}) AS used_blocks, (SELECT count(*) FROM qk JOIN fr USING (key) WHERE n > {CAP}) AS skipped_blocks FROM c""",
    "hash_split_md5": f"WITH {PART} SELECT id AS entity_id, {MEMBER.format('id')} AS validation FROM ent",
    "hash_sample_md5": f"WITH {PART} SELECT id AS entity_id FROM ent WHERE id LIKE 'S1-%' AND ('0x' || substr(md5('sample:' || id), 1, 8))::BIGINT % 4 = 0",
    "target_union": f"WITH {PART} SELECT id AS entity_id, name AS business_name, addr AS business_address, ctry AS country, CASE WHEN id LIKE 'S2-%' THEN 2 ELSE 3 END AS src_ord FROM ent WHERE id NOT LIKE 'S1-%'",
    "truth_semi": f"WITH {PART}, {TRUTH} SELECT q_id, array_to_string(list_sort(list(t_id)), ',') AS ids FROM tr WHERE {MEMBER.format('q_id')} GROUP BY q_id",
    "missed_links_anti": f"{_MISSED} SELECT * FROM mi",
    "split_overlap": f"""WITH {PART}, i AS (SELECT id, {MEMBER.format("id")} AS v, split_part(id, '-', 2)::BIGINT AS n FROM ent WHERE id LIKE 'S1-%'),
d AS (SELECT * FROM i WHERE NOT v OR n % 10 = 0), w AS (SELECT * FROM i WHERE v OR n % 35 = 0)
SELECT (SELECT count(*) FROM d SEMI JOIN w USING (id)) AS overlap, (SELECT count(*) FROM d WHERE v) AS misplaced_development, (SELECT count(*) FROM w WHERE NOT v) AS misplaced_validation""",
    "profiles": f"WITH {PART}, {_PROFILE} SELECT id AS entity_id, nc AS name_clean, ac AS addr_clean, ctry, legal, house, array_to_string(list_sort(nums), ' ') AS nums, len(ns) AS name_tokens, len(asx) AS addr_tokens FROM po",
    "native_features": f"{_FEATURES} SELECT q_id, t_id, country_match, name_exact, round(name_jaccard, 6) AS name_jaccard, round(name_overlap, 6) AS name_overlap, name_len_diff, name_token_count_diff, name_legal_suffix_status, addr_exact, round(addr_jaccard, 6) AS addr_jaccard, round(addr_overlap, 6) AS addr_overlap, addr_len_diff, addr_missing, house_num_status, round(numeric_jaccard, 6) AS numeric_jaccard, numeric_conflict, round(name_jaccard * addr_jaccard, 6) AS name_x_addr_jaccard, round({_SKETCH_SCORE}, 6) AS sketch_score, round(reciprocal_rank, 6) AS reciprocal_rank, is_top1, total_candidates FROM f",
    "rank_features": f"{_FEATURES} SELECT q_id, t_id, round(reciprocal_rank, 6) AS reciprocal_rank, is_top1, total_candidates FROM f",
    "gates": f"{_PAIRS} SELECT q_id, t_id, NOT (q.ctry <> '' AND t.ctry <> '' AND q.ctry <> t.ctry) AS country_ok, coalesce(q.house = t.house, true) AS house_ok, coalesce(q.raw_house = t.raw_house, true) AS house_ok_raw FROM pp",
    "entity_f05": f"WITH {CANDS}, {PRED}, {_entity('pr')} SELECT q_id, gold, predicted, hit, round({_f05('gold', 'predicted', 'hit')}, 6) AS f05 FROM pe",
    "candidate_quality": f"WITH {CANDS}, {_entity('ca')} SELECT count(*) AS entities, sum(predicted)::BIGINT AS candidate_pairs, sum(gold)::BIGINT AS true_links, sum(hit)::BIGINT AS links_found, round(sum(hit) / nullif(sum(gold), 0), 6) AS recall, round(avg({_f05('gold', 'hit', 'hit')}), 6) AS oracle_f05, count(*) FILTER (gold = 0) AS singletons, count(*) FILTER (gold = 0 AND predicted = 0) AS empty_singletons FROM pe",
    "prediction_metrics": _metrics("gold > 0"),
    "prediction_metrics_all": _metrics("true"),
    "threshold_sweep": f"WITH {CANDS}, {_sweep(MODEL_THRESHOLDS, 'SELECT q_id, t_id, round(score / 10, 4) AS prob FROM ca')}",
    "classified_pairs": f"WITH {CANDS}, {PRED} SELECT coalesce(tr.q_id, pr.q_id) AS q_id, coalesce(tr.t_id, pr.t_id) AS t_id, CASE WHEN tr.q_id IS NULL THEN 'fp' WHEN pr.q_id IS NULL THEN 'fn' ELSE 'tp' END AS outcome FROM tr FULL JOIN pr ON tr.q_id = pr.q_id AND tr.t_id = pr.t_id",
    "first_n_examples": f"WITH {CANDS}, {PRED} SELECT q_id, array_to_string(list_sort(list(t_id)), ',') AS ids FROM pr ANTI JOIN tr USING (q_id, t_id) GROUP BY q_id ORDER BY length(q_id), q_id LIMIT 5",
    "singleton_stats": f"""WITH {PART}, {TRUTH}, n AS (SELECT s1.q_id, count(tr.t_id) AS n FROM s1 LEFT JOIN tr ON tr.q_id = s1.q_id GROUP BY s1.q_id)
SELECT 'rows' AS metric, count(*) AS value FROM n UNION ALL SELECT 'duplicate_ids', count(*) - count(DISTINCT q_id) FROM n UNION ALL SELECT 'links', sum(n)::BIGINT FROM n UNION ALL SELECT 'singletons', count(*) FILTER (n = 0) FROM n UNION ALL SELECT 'matches:' || n, count(*) FROM n GROUP BY n""",
    "audit_counts": f"WITH {PART}, party AS (SELECT 'S1-' || c_custkey AS id, c_name AS name, '' AS addr, n_name AS ctry FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'S2-' || s_suppkey, s_name, '', n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey) {_audit('ent', 'part')} UNION ALL {_audit('party', 'party')}",
    "table_profile": _profile_sql(),
    "miss_summary": f"{_MISSED}, k AS (SELECT mi.*, s1.ctry, (SELECT count(*) FROM tr WHERE tr.q_id = mi.q_id) AS n FROM mi JOIN s1 USING (q_id)) SELECT 'country' AS dimension, ctry AS value, count(*) AS misses FROM k GROUP BY ctry UNION ALL SELECT 'source', split_part(t_id, '-', 1), count(*) FROM k GROUP BY 2 UNION ALL SELECT 'true_links', n::VARCHAR, count(*) FROM k GROUP BY 2",
    "hard_negatives": f"{_LABELLED} SELECT q_id, t_id, rank, label FROM lb QUALIFY label = 1 OR row_number() OVER (PARTITION BY q_id, label ORDER BY rank) <= 3",
    "dedup_order": f"WITH {CANDS}, {PRED} SELECT s1.q_id AS source1_entity_id, coalesce(string_agg(t_id, ',' ORDER BY rank), '') AS matched_entity_ids FROM s1 LEFT JOIN pr USING (q_id) GROUP BY s1.q_id",
    "submission_checks": f"WITH {CANDS}, {_lists('tl', 'tr')}, {_spoiled('ts', 'tl')}, {_lists('cl', 'ca')} {_submission('ts', 'cl', True)}",
    "header_checks": f"WITH {CANDS}, {_lists('tl', 'tr')}, cl AS (SELECT q_id, ids FROM tl WHERE false) {_submission('tl', 'cl', False)}",
    "evaluation_checks": f"WITH {CANDS}, {_lists('cl', 'ca')}, {_spoiled('cs', 'cl')} {' UNION ALL '.join(_file_checks('candidate', 'cs'))}",
    "prediction_checks": f"WITH {CANDS}, {PRED}, {_lists('pl', 'pr')}, {_spoiled('ps', 'pl')} {' UNION ALL '.join(_file_checks('prediction', 'ps', False, False))}",
    "validation_score": f"""WITH {CANDS}, {PRED}, {_entity("pr")}, v AS (SELECT * FROM pe WHERE {MEMBER.format("q_id")})
SELECT count(*) AS validation_entities, round(avg({_f05("gold", "predicted", "hit")}), 6) AS macro_f05, round(count(*) FILTER (gold = 0 AND predicted = 0) / nullif(count(*) FILTER (gold = 0), 0), 6) AS singleton_accuracy, count(*) FILTER (gold = 0) AS singleton_entities FROM v""",
    "batch_totals": f"""WITH {CANDS}, {_entity("ca")}, a AS (SELECT count(*) AS source1_entities, sum(predicted)::BIGINT AS retained_candidate_pairs, sum(gold)::BIGINT AS true_links, sum(hit)::BIGINT AS true_links_retrieved,
  count(*) FILTER (gold > 0) AS nonempty_truth_entities, count(*) FILTER (hit > 0) AS nonempty_truth_entities_with_candidate FROM pe)
SELECT *, (SELECT count(*) FROM ev) AS raw_candidate_pairs, (SELECT count(DISTINCT key) FROM qk) AS query_keys, (SELECT count(*) FROM fr WHERE n <= {CAP}) AS active_keys,
  round(true_links_retrieved / nullif(true_links, 0), 6) AS pair_recall, round(nonempty_truth_entities_with_candidate / nullif(nonempty_truth_entities, 0), 6) AS entity_hit_rate, round(retained_candidate_pairs / source1_entities, 6) AS candidates_per_source1 FROM a""",
    "missed_examples": f"{_MISSED} SELECT q_id, ent.name AS business_name, ent.addr AS business_address, array_to_string(list_sort(list(t_id)), ',') AS missed FROM mi JOIN ent ON ent.id = mi.q_id GROUP BY q_id, ent.name, ent.addr ORDER BY length(q_id), q_id LIMIT 12",
    "fuzzy_features": f"{_FUZZY} SELECT q_id, t_id, round(name_fuzz_ratio, 6) AS name_fuzz_ratio, round(name_token_sort_ratio, 6) AS name_token_sort_ratio, round(name_token_set_ratio, 6) AS name_token_set_ratio, round(addr_fuzz_ratio, 6) AS addr_fuzz_ratio, round(addr_token_sort_ratio, 6) AS addr_token_sort_ratio, round(name_token_sort_ratio * CASE WHEN addr_missing > 0 THEN 0.6::DOUBLE ELSE addr_token_sort_ratio END, 6) AS name_x_addr_sort FROM z",
    "name_gate": f"{_FUZZY} SELECT q_id, t_id FROM z WHERE ok AND (name_overlap >= 0.5 OR name_token_sort_ratio >= 0.55)",
    "heuristic_scores": f"{_FUZZY}, {_HEURISTIC} SELECT q_id, t_id, round(prob, 6) AS prob FROM hs",
    "prediction_report": f"""{_FUZZY}, {_HEURISTIC}, g AS (SELECT * FROM hs WHERE ok AND (name_overlap >= 0.5 OR name_token_sort_ratio >= 0.55))
SELECT (SELECT count(*) FROM s1) AS entities, (SELECT count(*) FROM ca) AS pairs, (SELECT count(*) FROM ca) - (SELECT count(*) FROM g) AS gated, count(*) FILTER (prob >= 0.75) AS matches,
  round(((SELECT count(*) FROM s1) - count(DISTINCT q_id) FILTER (prob >= 0.75)) / (SELECT count(*) FROM s1), 6) AS singleton_fraction FROM g""",
    "baseline_sweep": f"{_FUZZY}, {_HEURISTIC}, {_sweep(BASELINE_THRESHOLDS, 'SELECT q_id, t_id, prob FROM hs')}",
    "best_ranking": f"WITH {', '.join([PART, VIEW, KEYS, _evidence(), SCORED, TRUTH])}, " + ", ".join(
        f"c{i} AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY {o}) = 1), m{i} AS (SELECT '{n}' AS model, {i} AS position, round(avg(f), 9) AS f FROM (SELECT {_f05('gold', 'predicted', 'hit')} AS f FROM (SELECT q_id, (SELECT count(*) FROM tr WHERE tr.q_id = s1.q_id) AS gold, (SELECT count(*) FROM c{i} c WHERE c.q_id = s1.q_id) AS predicted, (SELECT count(*) FROM c{i} c JOIN tr ON tr.q_id = c.q_id AND tr.t_id = c.t_id WHERE c.q_id = s1.q_id) AS hit FROM s1)))"
        for i, (n, o) in enumerate((("sketch", SKETCH), ("weight", "weight10 DESC, rid"), ("batch", "score DESC, t_id DESC")))) + " SELECT model, position, round(f, 6) AS macro_f05 FROM (SELECT * FROM m0 UNION ALL SELECT * FROM m1 UNION ALL SELECT * FROM m2) ORDER BY f DESC, position LIMIT 1",
    "training_summary": f"{_LABELLED}, k AS (SELECT * FROM lb QUALIFY label = 1 OR row_number() OVER (PARTITION BY q_id, label ORDER BY rank) <= 25) SELECT count(*) AS n, sum(label)::BIGINT AS positives, round(sum(label) / count(*), 6) AS positive_rate FROM k",
}
