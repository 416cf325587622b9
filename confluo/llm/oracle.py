"""DuckDB SQL of the operators that SQL can express, written from their definitions: no shards, signatures or packed postings here."""

from __future__ import annotations

from confluo.llm.line_dedup import PERCENT
from confluo.llm.quality_rules import ALPHA, COST, DELTA, MAX_REPEAT_PERCENT, MIN_WORDS, RULES, WINDOW
from confluo.llm.substring_dedup import SPAN

_SPLIT = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _words(text: str) -> str:
    return _SPLIT.format(text)


_DOCS = f"d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS ws FROM documents)"

#: A window's words joined by a space stand for their sequence, as no word holds one.
SUBSTRINGS = f"""WITH {_DOCS},
s AS (SELECT rid, unnest(hs) AS h, generate_subscripts(hs, 1) AS j FROM (SELECT rid, list_transform(range(1, len(ws) - {SPAN - 2}), lambda i: md5(array_to_string(ws[i:i + {SPAN - 1}], ' '))) AS hs FROM d WHERE len(ws) >= {SPAN})),
r AS (SELECT rid, j, (count(*) OVER (PARTITION BY h) > 1)::INT AS again FROM s),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM d),
c AS (SELECT rid, j, word, coalesce(max(again) OVER (PARTITION BY rid ORDER BY j ROWS BETWEEN {SPAN - 1} PRECEDING AND CURRENT ROW), 0) AS gone FROM w LEFT JOIN r USING (rid, j)),
k AS (SELECT rid, sum(gone) AS n, string_agg(word, ' ' ORDER BY j) FILTER (gone = 0) AS kept FROM c GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (rid)"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NEAR = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_words(_LOW)} AS ws FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM d),
p AS (SELECT rid, len(sh) AS n, unnest(sh) AS x FROM s WHERE doc_id IS NOT NULL),
l AS (SELECT a.rid AS a, b.rid AS b FROM p a JOIN p b ON a.x = b.x AND a.rid < b.rid GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT rid AS a, rid AS b FROM s WHERE doc_id IS NOT NULL UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
c AS (SELECT reach.a AS rid, min(s.doc_id) AS component_id FROM reach JOIN s ON s.rid = reach.b GROUP BY reach.a)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM s LEFT JOIN c USING (rid)"""

#: For distinct ids: the order of lines whose place is equal is by hashes that SQL lacks. Candidates share one of their rarest words.
LINES = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM (SELECT doc_id, string_split(t, chr(10)) AS ls FROM d)),
l AS (SELECT *, len(ws) AS n, row_number() OVER (ORDER BY doc_id NULLS LAST, k) AS o FROM (SELECT doc_id, k, line, list_distinct({_words('line')}) AS ws FROM a)),
w AS (SELECT o, n, unnest(ws) AS word FROM l),
q AS (SELECT o, n, word, row_number() OVER (PARTITION BY o ORDER BY f, word) AS r FROM w JOIN (SELECT word, count(*) AS f FROM w GROUP BY word) USING (word)),
z AS (SELECT o, n, word FROM q WHERE r <= n - ({PERCENT} * n + 99) // 100 + 1),
m AS (SELECT DISTINCT x.o AS late, y.o AS early FROM z x JOIN z y ON x.word = y.word AND x.o > y.o AND 100 * x.n >= {PERCENT} * y.n AND 100 * y.n >= {PERCENT} * x.n),
i AS (SELECT late, x.n AS xn, y.n AS yn, len(list_intersect(x.ws, y.ws)) AS same FROM m JOIN l x ON x.o = late JOIN l y ON y.o = early),
g AS (SELECT DISTINCT late AS o FROM i WHERE 100 * same >= {PERCENT} * (xn + yn - same))
SELECT doc_id, count(*) AS n_lines, count(g.o) AS n_removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (g.o IS NULL), '')) AS kept_sha256 FROM l LEFT JOIN g USING (o) GROUP BY doc_id"""


def _count(pattern: str) -> str:
    return f"length(regexp_replace(j, '[^{pattern}]', '', 'g'))"


def _share(a: str, b: str, by: int = 1000) -> str:
    return f"CASE WHEN {b} > 0 THEN {by} * {a} // {b} ELSE 0 END"


_SIGNALS = {"symbols": _share("n_symbols", "word_chars"), "dup_lines": _share("n_dup_lines", "n_lines"), "repeats": _share("n_repeat_words", "n_words"), "marks": _share("n_marks", "word_chars"), "capitals": _share("n_capitals", "word_chars"), "word_length": _share("word_chars", "n_words", 100)}
_P = ALPHA / len(RULES)
_GRID = " UNION ALL ".join(f"SELECT '{rule}' AS rule, unnest({grid}) AS cutoff" for rule, grid in RULES.items())
_LONG = " UNION ALL ".join(f"SELECT rid, '{rule}' AS rule, v_{rule} AS v FROM v" for rule in RULES)
QUALITY = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS ws FROM documents),
x AS (SELECT rid, unnest(hs) AS h, generate_subscripts(hs, 1) AS i FROM (SELECT rid, list_transform(range(1, len(ws) - {WINDOW - 2}), lambda i: array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS hs FROM d WHERE len(ws) >= {WINDOW})),
y AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, h) AS n FROM x) WHERE n > 1),
z AS (SELECT rid, sum(least({WINDOW}, coalesce(after - i, {WINDOW}))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS after FROM y) GROUP BY rid),
b AS (SELECT rid, doc_id, stratum, len(ws) AS n_words, array_to_string(ws, '') AS j, list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS ls, coalesce(n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN z USING (rid)),
c AS (SELECT rid, doc_id, stratum, n_words, length(j) AS word_chars, {_count('#*$%&|<>')} AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, n_repeat_words, {_count('!')} AS n_marks, {_count('A-ZÀ-Þ')} AS n_capitals,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b),
v AS (SELECT *, {', '.join(f'{x} AS v_{rule}' for rule, x in _SIGNALS.items())} FROM c),
known AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
one AS (SELECT * FROM (SELECT v.*, quality, row_number() OVER (PARTITION BY doc_id ORDER BY stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_marks, n_capitals) AS r FROM v JOIN known USING (doc_id) WHERE NOT base_failed) WHERE r = 1),
long AS ({_LONG}),
held AS (SELECT stratum, rule, long.v, one.quality = 1 AS good FROM one JOIN long USING (rid)),
tests AS (SELECT stratum, rule, cutoff, count_if(good)::BIGINT AS n, count_if(good AND held.v > cutoff)::BIGINT AS k, count_if(NOT good AND held.v > cutoff)::BIGINT AS caught FROM held JOIN ({_GRID}) USING (rule) GROUP BY ALL),
level AS (SELECT {DELTA!r}::DOUBLE / nullif(count(DISTINCT stratum) * {sum(map(len, RULES.values()))}, 0) AS most FROM tests),
tails AS (SELECT stratum, rule, cutoff, caught - {COST} * k AS gain, CASE WHEN k > n * {_P!r}::DOUBLE THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp((CASE WHEN n = 0 THEN 0 ELSE lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) END) + i * ln({_P!r}::DOUBLE) + (n - i) * ln(1 - {_P!r}::DOUBLE)))) END AS tail FROM tests),
best AS (SELECT stratum, rule, max({{'gain': gain, 'cutoff': cutoff}}).cutoff AS cutoff FROM tails, level WHERE tail <= most AND gain > 0 GROUP BY ALL),
over AS (SELECT DISTINCT rid FROM v JOIN long USING (rid) JOIN best USING (stratum, rule) WHERE long.v > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND over.rid IS NULL AS kept FROM v LEFT JOIN over USING (rid)"""

ORACLE_SQL = {"op3_substring_dedup": SUBSTRINGS, "op7_lsh_forest": NEAR, "op8_line_dedup": LINES, "op9_quality_rules": QUALITY}
