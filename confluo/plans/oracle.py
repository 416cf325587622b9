"""DuckDB SQL of the registered queries, written out from the same contract."""

from __future__ import annotations

from confluo.functions.text import ADDRESS_ABBREVIATIONS, DOMAIN, LEGAL_SUFFIXES, STREET_WORDS, UNIT_WORDS, char_class, non_latin_ranges
from confluo.operators.assign import GRID
from confluo.operators.features import FEATURES, PAIR
from confluo.plans.catalogue import FAULTY, FEW, SMALL_CAP
from confluo.plans.fixture import RECORDS, TRUTH

S1, CAND = PAIR


def _quoted(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _fold(x: str) -> str:
    return f"replace(translate({x}, 'éèêëçäöüñíóáúàâîôûï', 'eeeecaounioauaaioui'), 'ß', 'ss')"


def _norm(x: str) -> str:
    out = f"replace({_fold(f'lower({x})')}, '&', ' and ')"
    for pattern, to in ((r"\b([a-z])\.(\s|$)", r"\1\2"), ("[''’`]", ""), (r"[\p{P}\p{S}\x00-\x08\x0e-\x1b\x7f]", " "), (r"\s+", " ")):
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return f"trim({out})"


def _postal(tokens: str, k: int) -> str:
    at, letters = f"list_position({tokens}, {tokens}[-{k}])", f"list_transform({tokens}, lambda w: lower(regexp_replace(w, '[^A-Za-z]', '', 'g')))"
    near = f"list_concat({letters}[greatest({at} - 2, 1):{at} - 1], {letters}[{at} + 1:{at} + 2])"
    return (
        f"CASE WHEN len({tokens}) >= {k} AND regexp_matches({tokens}[-{k}], '^\\P{{Nd}}*\\p{{Nd}}{{5,6}}\\P{{Nd}}*$') AND NOT list_has_any({near}, {_quoted(STREET_WORDS)}) "
        f"AND len(list_filter({tokens}[{at} + 1:], lambda w: regexp_matches(w, '\\p{{Nd}}'))) = 0 AND NOT list_has_any({letters}[1:{at} - 1], {_quoted(UNIT_WORDS)}) THEN regexp_extract({tokens}[-{k}], '\\p{{Nd}}{{5,6}}') END"
    )


#: The last word that is no suffix; the first word always stays in the name.
_LAST = f"greatest(1, coalesce(list_max(list_filter(range(1, len(nw) + 1), lambda i: NOT list_contains({_quoted(LEGAL_SUFFIXES)}, nw[i]))), 1))"
_NON_LATIN = char_class(non_latin_ranges())
_EXPANDED = "a0"
for _short, _full in ADDRESS_ABBREVIATIONS.items():
    _EXPANDED = f"regexp_replace({_EXPANDED}, '\\b{_short}\\b', '{_full}', 'g')"
_E = f"e AS ({RECORDS}), truth AS ({TRUTH}), s1 AS (SELECT entity_id AS {S1} FROM e WHERE entity_id LIKE 'S1-%')"
_C = f"""{_E}, n AS (SELECT *, string_split({_norm('business_name')}, ' ') AS nw, {_norm('business_address')} AS a0,
  string_split(list_filter(list_transform(string_split(business_address, ','), lambda p: trim(regexp_replace(p, '\\s+', ' ', 'g'))), lambda p: p <> '')[-1], ' ') AS w FROM e),
c AS (SELECT entity_id, business_name, business_address, country, substr(entity_id, 1, 2) AS src, array_to_string(nw[1:{_LAST}], ' ') AS name_clean, array_to_string(nw[{_LAST} + 1:], ' ') AS name_legal_suffix,
  regexp_matches(trim(business_name), '{DOMAIN}', 'i') AS name_is_domain, {_EXPANDED} AS address_clean, coalesce({_postal('w', 1)}, {_postal('w', 2)}, '') AS postal_code, regexp_matches(business_address, '{_NON_LATIN}') AS has_non_latin_script FROM n),
lim AS (SELECT country, greatest(10, count(*) // (CASE WHEN count(*) > 100000 THEN 200 ELSE 100 END)) AS most FROM c WHERE src <> 'S1' GROUP BY ALL)"""


def _blocks(cap: int = 1000) -> str:
    parts = [_C]
    for tag, column, least in (("na", "name_clean", 1), ("ad", "address_clean", 3)):
        parts += [
            f"t_{tag} AS (SELECT entity_id, src, country, unnest(list_filter(string_split({column}, ' '), lambda x: x <> '')) AS token FROM c)",
            f"com_{tag} AS (SELECT country, token, count(*) AS n FROM t_{tag} JOIN lim USING (country) WHERE src <> 'S1' GROUP BY country, token, most HAVING count(*) > most)",
            f"post_{tag} AS (SELECT country, token, entity_id, src, count(*) AS m FROM (SELECT *, row_number() OVER (PARTITION BY country, token ORDER BY src, entity_id) AS r FROM t_{tag} ANTI JOIN com_{tag} USING (country, token) WHERE src <> 'S1') WHERE r <= {cap} GROUP BY ALL)",
            f"sh_{tag} AS (SELECT a.entity_id AS s1, p.entity_id AS cand, p.src, sum(a.m1 * p.m)::BIGINT AS shared FROM (SELECT entity_id, country, token, count(*) AS m1 FROM t_{tag} WHERE src = 'S1' GROUP BY ALL) a JOIN post_{tag} p USING (country, token) GROUP BY ALL HAVING sum(a.m1 * p.m) >= {least})",
        ]
    return ", ".join(parts)


def _cands(k: int) -> str:
    return f"""{_blocks()}, best AS (SELECT s1, cand, src, min(method) AS method, arg_min(shared, method) AS shared FROM (SELECT *, 0 AS method FROM sh_na UNION ALL SELECT *, 1 FROM sh_ad) GROUP BY ALL),
cands AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1, src ORDER BY method, shared DESC, cand)::INTEGER AS rank FROM best) WHERE rank <= {k})"""


_LISTS = f"{_cands(FEW)}, lists AS (SELECT {S1}, coalesce(string_agg(cand, ',' ORDER BY src, rank), '') AS candidate_entity_ids FROM s1 LEFT JOIN cands ON s1 = {S1} GROUP BY {S1})"


def _gram(x: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({x}) - 2, 1) + 1), lambda i: substr({x}, i, 3)))"


def _words(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda w: w <> ''))"


def _jac(f, c: str) -> str:
    a, b = f(f"a.{c}"), f(f"b.{c}")
    i = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN trim(a.{c}) = '' OR trim(b.{c}) = '' THEN 0.0::DOUBLE ELSE {i}::DOUBLE / (len({a}) + len({b}) - {i}) END"


def _tri(c: str) -> str:
    return f"CASE WHEN trim(a.{c}) = '' OR trim(b.{c}) = '' THEN -1.0::DOUBLE WHEN lower(trim(a.{c})) = lower(trim(b.{c})) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def _lcs(x: str, y: str) -> str:
    """The longest common subsequence's length by a row of bits, for strings of up to 125 characters (beyond, the row overflows and the query fails); {x}c has x's characters."""
    full = f"((1::HUGEINT << length({x})) - 1)"
    mask = f"list_sum(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN {x}c[i] = ch THEN 1::HUGEINT << (i - 1) ELSE 0::HUGEINT END))::HUGEINT"
    masks = f"list_transform(string_split({y}, ''), lambda ch: coalesce({mask}, 0::HUGEINT))"
    return f"(length({x}) - bit_count(list_reduce([{full}] || {masks}, lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full})))"


def _sorted(x: str) -> str:
    return f"array_to_string(list_sort({x}), ' ')"


def _tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


_PART = "1.0::DOUBLE - (gap + {0}) / (n + n + gap + {0})"
#: w0: words of both names; w1: what the ratios compare; w2: lengths; ratios of each pair.
_RATIOS = f"""{_cands(FEW)}, w0 AS (SELECT s1, cand, trim(a.name_clean) = '' OR trim(b.name_clean) = '' AS none, {_tokens('a.name_clean')} AS ta, {_tokens('b.name_clean')} AS tb FROM cands JOIN c a ON a.entity_id = s1 JOIN c b ON b.entity_id = cand),
w1 AS (SELECT s1, cand, none, {_sorted('ta')} AS x, {_sorted('tb')} AS y, {_sorted('list_filter(list_distinct(ta), lambda w: list_contains(tb, w))')} AS common, {_sorted('list_filter(list_distinct(ta), lambda w: NOT list_contains(tb, w))')} AS l, {_sorted('list_filter(list_distinct(tb), lambda w: NOT list_contains(ta, w))')} AS r FROM w0),
wc AS (SELECT *, string_split(x, '') AS xc, string_split(l, '') AS lc FROM w1),
w2 AS (SELECT s1, cand, none, length(x) + length(y) AS xy, {_lcs('x', 'y')} AS same, length(common) AS n, length(l) AS p, length(r) AS q, {_lcs('l', 'r')} AS own, CASE WHEN length(common) > 0 THEN 1 ELSE 0 END AS gap FROM wc),
w3 AS (SELECT *, 1.0::DOUBLE - (p + q - 2 * own) / ((n + gap + p) + (n + gap + q)) AS apart FROM w2),
ratios AS (SELECT s1 AS {S1}, cand AS {CAND}, CASE WHEN none THEN 0.0::DOUBLE WHEN xy = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * same / xy END AS name_token_sort_ratio,
  CASE WHEN none THEN 0.0::DOUBLE WHEN n > 0 AND (p = 0 OR q = 0) THEN 1.0::DOUBLE WHEN n = 0 THEN apart ELSE greatest(apart, {_PART.format('p')}, {_PART.format('q')}) END AS name_token_set_ratio FROM w3)"""
_F = f"""{_cands(FEW)}, f0 AS (SELECT s1 AS {S1}, cand AS {CAND}, {_jac(_gram, 'name_clean')} AS name_char_ngram_jaccard, {_jac(_words, 'address_clean')} AS address_token_jaccard, {_jac(_gram, 'address_clean')} AS address_char_ngram_jaccard,
  {_tri('postal_code')} AS postal_code_match, {_tri('country')} AS country_match, {_tri('name_legal_suffix')} AS legal_suffix_match, (a.name_is_domain OR b.name_is_domain)::INT::DOUBLE AS either_is_domain, (a.has_non_latin_script OR b.has_non_latin_script)::INT::DOUBLE AS either_has_non_latin_script
  FROM cands JOIN c a ON a.entity_id = s1 JOIN c b ON b.entity_id = cand),
f AS (SELECT f0.*, t.{S1} IS NOT NULL AS is_match, round((name_char_ngram_jaccard + address_token_jaccard) / 2, 6) AS score FROM f0 LEFT JOIN (SELECT DISTINCT * FROM truth) t USING ({S1}, {CAND}))"""
_ALL = _F + _RATIOS.removeprefix(_cands(FEW)) + f", fa AS MATERIALIZED (SELECT * FROM f JOIN ratios USING ({S1}, {CAND}))"
_ORDER = "md5({} || '-42')"
_SPLIT = f"{_F}, g AS (SELECT {S1}, count_if(is_match) = 0 AS single FROM f GROUP BY ALL), v AS (SELECT {S1}, row_number() OVER (PARTITION BY single ORDER BY {_ORDER.format(S1)}, {S1}) <= ceil(count(*) OVER (PARTITION BY single) * 0.2) AS is_val FROM g), split AS (SELECT {S1}, {CAND}, is_match, is_val FROM f JOIN v USING ({S1}))"
_COUNTS = f"{_E}, mc AS (SELECT {S1}, count({CAND}) AS matches FROM s1 LEFT JOIN truth USING ({S1}) GROUP BY ALL)"
_SAMPLE = f"""{_COUNTS}, st AS (SELECT *, CASE matches WHEN 0 THEN 'none' WHEN 1 THEN 'one' ELSE 'many' END AS stratum FROM mc),
smp AS (SELECT {S1}, stratum, matches FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {_ORDER.format(S1)}, {S1}) AS r FROM st) WHERE r <= CASE stratum WHEN 'none' THEN 100 WHEN 'one' THEN 10 ELSE 5 END),
own AS (SELECT {CAND} AS entity_id FROM truth SEMI JOIN smp USING ({S1})),
dis AS (SELECT entity_id, src FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY {_ORDER.format('entity_id')}, entity_id) AS r FROM (SELECT *, substr(entity_id, 1, 2) AS src FROM e WHERE entity_id NOT LIKE 'S1-%') ANTI JOIN own USING (entity_id)) WHERE r <= 50)"""
_ASSIGN = f"{_F}, asg AS (SELECT {S1}, {CAND}, score FROM (SELECT *, row_number() OVER (PARTITION BY {CAND} ORDER BY score DESC, {S1}) AS r FROM f WHERE score >= 0.3) WHERE r = 1)"
_LADDER = "CASE WHEN actual = 0 AND predicted = 0 THEN 1.0::DOUBLE WHEN hits = 0 THEN 0.0::DOUBLE ELSE 1.25 * (hits / predicted) * (hits / actual) / (0.25 * (hits / predicted) + hits / actual) END"
_F05 = f"""{_ASSIGN}, ent AS (SELECT {S1}, coalesce(h, 0)::BIGINT AS hits, coalesce(p, 0)::BIGINT AS predicted, coalesce(t, 0)::BIGINT AS actual FROM s1
  LEFT JOIN (SELECT {S1}, count(*) AS p FROM asg GROUP BY ALL) USING ({S1}) LEFT JOIN (SELECT {S1}, count(*) AS t FROM (SELECT DISTINCT * FROM truth) GROUP BY ALL) USING ({S1})
  LEFT JOIN (SELECT {S1}, count(*) AS h FROM asg SEMI JOIN truth USING ({S1}, {CAND}) GROUP BY ALL) USING ({S1}))"""
_SWEEP = f"""{_F}, top AS (SELECT {S1}, {CAND}, score FROM (SELECT *, row_number() OVER (PARTITION BY {CAND} ORDER BY score DESC, {S1}) AS r FROM f) WHERE r = 1),
grid AS (SELECT unnest([{', '.join(f'{g!r}::DOUBLE' for g in GRID)}]) AS threshold), th AS (SELECT {S1}, threshold, count(*) AS predicted, count(t.{CAND}) AS hits FROM grid JOIN top ON score >= threshold LEFT JOIN (SELECT DISTINCT * FROM truth) t USING ({S1}, {CAND}) GROUP BY ALL),
tr AS (SELECT {S1}, count(*) AS n FROM (SELECT DISTINCT * FROM truth) GROUP BY ALL), rows_ AS (SELECT threshold, coalesce(hits, 0) AS hits, coalesce(predicted, 0) AS predicted, coalesce(n, 0) AS actual FROM s1 CROSS JOIN grid LEFT JOIN th USING ({S1}, threshold) LEFT JOIN tr USING ({S1}))"""
_MEANS = ", ".join(f"round(avg({c}), 6) AS {c}" for c in FEATURES)
_DESC = " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS least, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS most FROM fa" for c in FEATURES)
_TAB = f"""{_E}, ln AS ({FAULTY}), sp AS (SELECT line, instr(value, chr(9)) > 0 AS tabbed, trim(CASE WHEN instr(value, chr(9)) > 0 THEN substr(value, 1, instr(value, chr(9)) - 1) ELSE value END) AS {S1},
  list_filter(string_split(CASE WHEN instr(value, chr(9)) > 0 THEN substr(value, instr(value, chr(9)) + 1) ELSE '' END, ','), lambda x: trim(x) <> '') AS ids FROM ln WHERE line > 1 AND trim(value) <> ''),
ok AS (SELECT * FROM sp WHERE tabbed), last AS (SELECT {S1}, arg_max(ids, line) AS ids, count(*) AS times FROM ok GROUP BY ALL), one AS (SELECT {S1}, unnest(ids) AS id FROM ok), prs AS (SELECT DISTINCT {S1}, id FROM (SELECT {S1}, unnest(ids) AS id FROM last))"""


def _rule(rule: str, level: str, body: str) -> str:
    return f"SELECT '{rule}' AS rule, '{level}' AS level, count(*) AS n, coalesce(array_to_string(list_sort(list(v))[1:5], ', '), '') AS examples FROM (SELECT DISTINCT v::VARCHAR AS v FROM ({body}))"


_VALID = " UNION ALL ".join([
    _rule("no_tab", "error", "SELECT line AS v FROM sp WHERE NOT tabbed"),
    _rule("repeated_row", "error", f"SELECT {S1} AS v FROM last WHERE times > 1"),
    _rule("repeated_id", "error", f"SELECT {S1} AS v FROM ok WHERE len(ids) <> len(list_distinct(ids))"),
    _rule("primary_in_list", "error", f"SELECT {S1} AS v FROM one WHERE id LIKE 'S1-%'"),
    _rule("unknown_prefix", "error", "SELECT id AS v FROM one WHERE NOT regexp_matches(id, '^S[123]-')"),
    _rule("missing", "error", f"SELECT {S1} AS v FROM s1 ANTI JOIN last USING ({S1})"),
    _rule("extra", "error", f"SELECT {S1} AS v FROM last ANTI JOIN s1 USING ({S1})"),
    _rule("unknown_id", "error", "SELECT id AS v FROM one WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT entity_id FROM e WHERE entity_id NOT LIKE 'S1-%')"),
    _rule("not_a_candidate", "warning", f"SELECT p.{S1} || ':' || p.id AS v FROM prs p LEFT JOIN truth t ON t.{S1} = p.{S1} AND t.{CAND} = p.id WHERE t.{S1} IS NULL"),
    "SELECT 'rows', 'info', count(*), '' FROM ok", "SELECT 'empty_rows', 'info', count_if(len(ids) = 0)::BIGINT, '' FROM ok", "SELECT 'full_rows', 'info', count_if(len(ids) > 0)::BIGINT, '' FROM ok",
])
_NC = "entity_id, business_name, business_address, country, name_clean, name_legal_suffix, name_is_domain, address_clean, postal_code, has_non_latin_script"

ORACLE_SQL: dict[str, str] = {
    "normalize_text": f"WITH {_C} SELECT entity_id, array_to_string(nw, ' ') AS name, a0 AS address FROM n",
    "transliterate_nfc": f"WITH {_E} SELECT entity_id, {_fold('lower(business_name)')} AS name FROM e",
    "name_suffix": f"WITH {_C} SELECT entity_id, name_clean, name_legal_suffix FROM c",
    "domain_flag": f"SELECT page_id, regexp_matches(trim(url), '{DOMAIN}', 'i') AS is_domain, regexp_matches(trim(split_part(url, '?', 1)), '{DOMAIN}', 'i') AS bare_is_domain FROM pages",
    "postal_code": f"WITH {_C} SELECT entity_id, postal_code FROM c",
    "address_expand": f"WITH {_C} SELECT entity_id, address_clean FROM c",
    "non_latin_flag": f"WITH {_C} SELECT entity_id, has_non_latin_script AS non_latin, regexp_matches(business_name, '{_NON_LATIN}') AS name_non_latin FROM c",
    "clean_records": f"WITH {_C} SELECT {_NC} FROM c",
    "clean_stats": f"WITH {_C} SELECT src, count(*) AS n, count_if(name_is_domain)::BIGINT AS domains, count_if(has_non_latin_script)::BIGINT AS non_latin, count_if(postal_code <> '')::BIGINT AS postal, count_if(trim(business_name) = '')::BIGINT AS blank_name, count_if(trim(business_address) = '')::BIGINT AS blank_address, count_if(trim(country) = '')::BIGINT AS blank_country FROM c GROUP BY src",
    "country_histogram": f"WITH {_E} SELECT substr(entity_id, 1, 2) AS src, country, count(*) AS n FROM e GROUP BY ALL",
    "token_postings": f"WITH {_blocks()} SELECT country, token, count(*) AS n, count(DISTINCT entity_id) AS records FROM t_na GROUP BY ALL",
    "common_tokens": f"WITH {_blocks()} SELECT country, token, n FROM com_ad",
    "posting_cap": f"WITH {_blocks(SMALL_CAP)} SELECT country, token, entity_id, src, m FROM post_na",
    "block_name": f"WITH {_blocks()} SELECT s1, cand, src, shared FROM sh_na",
    "block_address": f"WITH {_blocks()} SELECT s1, cand, src, shared FROM sh_ad",
    "candidate_topk": f"WITH {_cands(50)} SELECT s1, cand, src, method, shared, rank FROM cands",
    "candidate_lists": f"WITH {_LISTS} SELECT {S1}, candidate_entity_ids FROM lists",
    "candidate_stats": f"WITH {_LISTS}, k AS (SELECT CASE WHEN candidate_entity_ids = '' THEN 0 ELSE len(string_split(candidate_entity_ids, ',')) END AS n FROM lists) SELECT count(*) AS s1, sum(n)::BIGINT AS pairs, round(avg(n), 6) AS average, count_if(n = 0)::BIGINT AS without FROM k",
    "explode_pairs": f"WITH {_LISTS} SELECT {S1}, unnest(string_split(candidate_entity_ids, ',')) AS {CAND} FROM lists WHERE candidate_entity_ids <> ''",
    "first_ten_pairs": f"WITH {_E}, few AS ((SELECT entity_id FROM e WHERE entity_id LIKE 'S2-%' ORDER BY 1 LIMIT 10) UNION ALL (SELECT entity_id FROM e WHERE entity_id LIKE 'S3-%' ORDER BY 1 LIMIT 10)) SELECT {S1}, entity_id AS {CAND} FROM s1 CROSS JOIN few",
    "label_pairs": f"WITH {_F} SELECT {S1}, {CAND}, is_match FROM f",
    "name_ngram_jaccard": f"WITH {_F} SELECT {S1}, {CAND}, round(name_char_ngram_jaccard, 6) AS jaccard FROM f",
    "address_jaccard": f"WITH {_F} SELECT {S1}, {CAND}, round(address_token_jaccard, 6) AS tokens, round(address_char_ngram_jaccard, 6) AS grams FROM f",
    "context_features": f"WITH {_F} SELECT {S1}, {CAND}, postal_code_match, country_match, legal_suffix_match, either_is_domain, either_has_non_latin_script FROM f",
    "comparable_postal": f"WITH {_F} SELECT count(*) AS n, count_if(postal_code_match <> -1)::BIGINT AS comparable, round(100.0 * count_if(postal_code_match <> -1)::DOUBLE / count(*), 6) AS percent FROM f",
    "feature_means_by_label": f"WITH {_ALL} SELECT is_match, count(*) AS n, {_MEANS} FROM fa GROUP BY is_match",
    "feature_describe": f"WITH {_ALL} {_DESC}",
    "token_sort_ratio": f"WITH {_RATIOS} SELECT {S1}, {CAND}, round(name_token_sort_ratio, 6) AS ratio FROM ratios",
    "token_set_ratio": f"WITH {_RATIOS} SELECT {S1}, {CAND}, round(name_token_set_ratio, 6) AS ratio FROM ratios",
    "pair_features": f"WITH {_ALL} SELECT {S1}, {CAND}, {', '.join(f'{c}::FLOAT AS {c}' for c in FEATURES)}, is_match FROM fa",
    # A dot goes if a letter stands alone before it and another such letter, white space or the end behind it.
    "acronym_collapse": f"""WITH {_E}, a AS (SELECT entity_id, string_split(lower(concat_ws('.', substr(business_name, 1, 1), substr(country, 1, 1), 'c. ', business_name)), '') AS x FROM e)
SELECT entity_id, array_to_string(list_transform(list_filter(range(1, len(x) + 1), lambda i: NOT (x[i] = '.' AND i > 1 AND regexp_matches(x[i - 1], '[a-z]') AND (i = 2 OR NOT regexp_matches(x[i - 2], '[\\p{{L}}\\p{{N}}_]'))
  AND (i = len(x) OR regexp_matches(x[i + 1], '\\s') OR (i + 2 <= len(x) AND regexp_matches(x[i + 1], '[a-z]') AND x[i + 2] = '.')))), lambda i: x[i]), '') AS name FROM a""",
    "class_balance": f"WITH {_F} SELECT count_if(is_match)::BIGINT AS pos, count_if(NOT is_match)::BIGINT AS neg, round(coalesce(count_if(NOT is_match)::DOUBLE / nullif(count_if(is_match), 0), 1.0), 6) AS weight FROM f",
    "grouped_split": f"WITH {_SPLIT} SELECT * FROM split",
    "split_leakage": f"WITH {_SPLIT} SELECT count(*) AS n FROM (SELECT {S1} FROM split GROUP BY 1 HAVING count(DISTINCT is_val) > 1)",
    "stratified_sample": f"WITH {_SAMPLE} SELECT {S1}, stratum, matches FROM smp",
    "distractors": f"WITH {_SAMPLE} SELECT entity_id, src FROM dis",
    "sample_fixture": f"WITH {_SAMPLE} SELECT {S1} AS entity_id FROM smp UNION SELECT entity_id FROM own UNION SELECT entity_id FROM dis",
    "pair_metrics": f"WITH {_F}, k AS (SELECT count_if(score >= 0.5 AND is_match)::BIGINT AS tp, count_if(score >= 0.5 AND NOT is_match)::BIGINT AS fp, count_if(score < 0.5 AND is_match)::BIGINT AS fn FROM f), q AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM k) SELECT tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 1.25 * p * r / (0.25 * p + r) END, 6) AS f05 FROM q",
    "auc_ap": f"WITH {_F}, k AS (SELECT score, count_if(is_match) AS pos, count_if(NOT is_match) AS neg FROM f GROUP BY score), w AS (SELECT pos, neg, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp FROM k WINDOW d AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) SELECT round((sum(neg * (tp - pos) + neg * pos / 2) / (sum(pos) * sum(neg)))::DOUBLE, 6) AS auc, round((sum(pos * tp / (tp + fp)) / sum(pos))::DOUBLE, 6) AS average_precision FROM w",
    "score_summary": f"WITH {_F} SELECT count(*) AS n, count_if(score IS NULL)::BIGINT AS nulls, round(min(score), 6) AS least, round(max(score), 6) AS most, round(avg(score), 6) AS mean, round(median(score), 6) AS median, count_if(score >= 0.5)::BIGINT AS at_half, count_if(score < 0 OR score > 1)::BIGINT AS outside FROM f",
    "assign_one_to_one": f"WITH {_ASSIGN} SELECT {S1}, {CAND}, score FROM asg",
    "match_lists": f"WITH {_ASSIGN} SELECT {S1}, coalesce(string_agg({CAND}, ',' ORDER BY {CAND}), '') AS matched_entity_ids FROM s1 LEFT JOIN asg USING ({S1}) GROUP BY {S1}",
    "entity_f05": f"WITH {_F05} SELECT {S1}, hits, predicted, actual, round({_LADDER}, 6) AS f05 FROM ent",
    "macro_f05": f"WITH {_F05} SELECT count(*) AS n, round(avg({_LADDER}), 6) AS macro_f05 FROM ent",
    "threshold_sweep": f"WITH {_SWEEP} SELECT threshold, round(avg({_LADDER}), 6) AS macro_f05 FROM rows_ GROUP BY threshold",
    "validate_matches": f"WITH {_TAB} {_VALID}",
    "truth_profile": f"WITH {_E}, k AS (SELECT {S1}, coalesce(count_if({CAND} LIKE 'S2-%'), 0) AS s2, coalesce(count_if({CAND} LIKE 'S3-%'), 0) AS s3 FROM s1 LEFT JOIN truth USING ({S1}) GROUP BY ALL) SELECT count(*) AS n, count_if(s2 = 0 AND s3 = 0)::BIGINT AS singles, round(avg(s2), 6) AS mean_s2, round(avg(s3), 6) AS mean_s3 FROM k",
    "match_histogram": f"WITH {_COUNTS} SELECT matches, count(*) AS n FROM mc GROUP BY matches",
    "owner_conflicts": f"WITH {_E} SELECT {CAND}, count(*) AS owners, min({S1}) AS first_owner FROM (SELECT DISTINCT * FROM truth) GROUP BY {CAND} HAVING count(*) > 1",
    "unmatched": f"WITH {_E} SELECT substr(entity_id, 1, 2) AS src, count(*) AS n FROM e WHERE entity_id NOT LIKE 'S1-%' AND entity_id NOT IN (SELECT {CAND} FROM truth) GROUP BY 1",
    "matched_records": f"WITH {_E} SELECT {S1}, {CAND}, a.business_name AS source1_name, b.business_name AS candidate_name FROM truth JOIN e a ON a.entity_id = {S1} JOIN e b ON b.entity_id = {CAND}",
}
