"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import line_dedup, quality_rules, sharding

#: A bucket of k bits holds all rows with these leading bits; a row's shard is the shortest prefix whose bucket fits.  Rows of one hash that
#: never fit are paged in order of id: small ones by halves of the limit in their running total, larger ones each alone.
_BITS = sharding.HASH_BITS
_SHARDING = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) AS n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash FROM documents),
b AS (SELECT r, n_bytes, k, hash >> ({_BITS} - k) AS node FROM d, (SELECT unnest(range(0, {_BITS + 1})) AS k)),
s AS (SELECT k, node, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes FROM b GROUP BY k, node HAVING sum(n_bytes) <= {sharding.LIMIT}),
m AS MATERIALIZED (SELECT r, min(k) AS bits, arg_min(shard_bytes, k) AS shard_bytes FROM b JOIN s USING (k, node) GROUP BY r),
o AS (
  SELECT *, n_bytes > {sharding.LIMIT // 2} AS large, coalesce(sum(CASE WHEN n_bytes <= {sharding.LIMIT // 2} THEN n_bytes END) OVER w, 0) AS upto, row_number() OVER w AS nth
  FROM d ANTI JOIN m USING (r) WINDOW w AS (PARTITION BY hash ORDER BY doc_id NULLS LAST, n_bytes, r ROWS UNBOUNDED PRECEDING)),
p AS (SELECT doc_id, n_bytes, hash, lpad(bin(hash), {_BITS}, '0') || '/' || CASE WHEN large THEN 'L' || nth ELSE 'P' || (upto // {sharding.LIMIT // 2}) END AS shard FROM o)
SELECT doc_id, n_bytes, hash, substr(lpad(bin(hash), {_BITS}, '0'), 1, CAST(bits AS INTEGER)) AS shard, CAST(bits AS INTEGER) AS bits, shard_bytes FROM d JOIN m USING (r)
UNION ALL SELECT doc_id, n_bytes, hash, shard, {_BITS} AS bits, CAST(sum(n_bytes) OVER (PARTITION BY shard) AS BIGINT) AS shard_bytes FROM p
"""

#: A list of a text's words, and whether a line has one.
_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda y: y <> '')"
_HAS_WORD = r"regexp_matches({0}, '[^\x20\x09-\x0D]')"


def _scope(keys: list[str]) -> str:
    """Limits and medians per group of keys: quantiles are lower edges of buckets."""
    by, q = ", ".join([*keys, "rate"]), quality_rules
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    at = ", ".join(f"min(edge) FILTER (WHERE seen * 100 >= texts * {x}) AS q{x}" for x in (25, 50, 75))
    wide = ", ".join(f"max(q{x}) FILTER (WHERE rate = '{k}') AS {k}_{x}" for k in q.RATES for x in (25, 50, 75))

    def limit(k: str) -> str:
        grain = f"{q.EVENTS[k] * q.SCALE} // median_words" if k in q.EVENTS else f"CAST(floor({q.LENGTH_SCALE} / sqrt(median_words)) AS BIGINT)"
        upper = f"{k}_75 + {q.FENCE} * greatest({k}_75 - {k}_50, {k}_50 - {k}_25, {grain})"
        return f"least({upper}, {k}_50 + {2 * q.FENCE} * greatest({k}_50 - {k}_25, {grain})) AS max_{k}, {k}_50 AS median_{k}"

    return f"""SELECT {''.join(k + ', ' for k in keys)}texts, median_words, {', '.join(map(limit, q.RATES))} FROM (
  SELECT {''.join(k + ', ' for k in keys)}max(texts) AS texts, max(q50) FILTER (WHERE rate = 'n_words') AS median_words, {wide} FROM (
  SELECT {by}, any_value(texts) AS texts, {at} FROM (
    SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY edge) AS seen, sum(n) OVER (PARTITION BY {by}) AS texts FROM (
      SELECT {by}, edge, count(*) AS n FROM buckets GROUP BY {by}, edge)) GROUP BY {by}) {group})"""


_RATES = {k: f"{x} * {quality_rules.SCALE} // n_words" for k, x in (("symbol_rate", "n_symbols"), ("line_rate", "n_dup_lines"), ("repeat_rate", "n_repeat_words"))}
_RATES["length_rate"] = f"word_chars * {quality_rules.LENGTH_SCALE} // n_words"
_LONG = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS rate, {v} AS v FROM m WHERE n_words > 0" for k, v in {**_RATES, "n_words": "n_words"}.items())
_LIMITS = ", ".join(f"CASE WHEN o.texts >= {quality_rules.MIN_GROUP} THEN o.{c} WHEN l.texts >= {quality_rules.MIN_GROUP} THEN l.{c} ELSE e.{c} END AS {c}" for c in quality_rules.LIMITS)
_STEP = f"greatest(length(bin(v)) - {quality_rules.BITS}, 0)"
_WINDOW = " || ' ' || ".join(["x", *[f"lead(x, {i}) OVER o" for i in range(1, quality_rules.WINDOW)]])
_OFF = " OR ".join(f"coalesce(({v} - median_{k}) * least(n_words, median_words) > (max_{k} - median_{k}) * median_words, false)" for k, v in _RATES.items())
_QUALITY = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (SELECT k, {_WORDS.format('text')} AS ws, list_filter(string_split(text, chr(10)), lambda y: {_HAS_WORD.format('y')}) AS ls FROM d),
u AS (SELECT k, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT k, i, {_WINDOW} AS run FROM u WINDOW o AS (PARTITION BY k ORDER BY i)),
t AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, run) AS n FROM g WHERE run IS NOT NULL) WHERE n > 1),
r AS (SELECT k, CAST(sum(least({quality_rules.WINDOW}, coalesce(following - i, {quality_rules.WINDOW}))) AS BIGINT) AS repeats FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS following FROM t) GROUP BY k),
m AS MATERIALIZED (
  SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(repeats, 0) AS n_repeat_words
  FROM d JOIN w USING (k) LEFT JOIN r USING (k)),
buckets AS MATERIALIZED (SELECT lang, source, rate, (v >> {_STEP}) << {_STEP} AS edge FROM ({_LONG})),
own AS ({_scope(['lang', 'source'])}),
by_lang AS ({_scope(['lang'])}),
everywhere AS ({_scope([])}),
z AS (SELECT o.lang, o.source, {_LIMITS} FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang CROSS JOIN everywhere e),
v AS (SELECT m.*, z.* EXCLUDE (lang, source), n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM m LEFT JOIN z ON m.lang IS NOT DISTINCT FROM z.lang AND m.source IS NOT DISTINCT FROM z.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, CASE WHEN base_failed THEN false ELSE NOT ({_OFF}) END AS kept,
  {', '.join(f'CASE WHEN n_words > 0 THEN {c} END AS {c}' for c in quality_rules.LIMITS)} FROM v
"""

#: Lines of a document with a word are numbered j.  Every shortest run of enough words from a line on, and up to a line, is spelt out;
#: where its text occurs earlier (by doc_id, then line), the run's lines go.
_LINE_DEDUP = f"""
WITH n AS MATERIALIZED (SELECT doc_id, text, dense_rank() OVER (ORDER BY doc_id NULLS LAST, md5(text) NULLS LAST) AS k FROM documents),
every AS MATERIALIZED (SELECT k, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM (SELECT DISTINCT k, text FROM n)),
c AS MATERIALIZED (
  SELECT *, sum(words) OVER (PARTITION BY k ORDER BY j) AS upto FROM (
    SELECT k, place, x, row_number() OVER (PARTITION BY k ORDER BY place) AS j, len({_WORDS.format('x')}) AS words FROM every WHERE {_HAS_WORD.format('x')})),
spans AS MATERIALIZED (SELECT s.k, s.j AS lo, e.j AS hi FROM c s JOIN c e ON s.k = e.k AND e.j >= s.j AND e.j < s.j + {line_dedup.MIN_WORDS} AND e.upto - s.upto + s.words >= {line_dedup.MIN_WORDS}),
r AS (SELECT k, lo, min(hi) AS hi FROM spans GROUP BY k, lo UNION SELECT k, max(lo) AS lo, hi FROM spans GROUP BY k, hi),
t AS (SELECT r.k, lo, hi, string_agg(x, chr(10) ORDER BY j) AS run FROM r JOIN c ON r.k = c.k AND j >= lo AND j <= hi GROUP BY r.k, lo, hi),
f AS (SELECT k, lo, hi FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY k, lo) AS copy FROM t) WHERE copy > 1),
g AS MATERIALIZED (SELECT DISTINCT c.k, place, words FROM f JOIN c ON f.k = c.k AND j >= lo AND j <= hi),
h AS (SELECT k, count(*) AS n_deleted, CAST(sum(words) AS BIGINT) AS gone_words, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS deleted_lines FROM g GROUP BY k),
rest AS (SELECT k, string_agg(x, chr(10) ORDER BY place) AS text FROM every ANTI JOIN g USING (k, place) GROUP BY k)
SELECT n.doc_id, CASE WHEN n.text IS NULL THEN NULL WHEN h.k IS NULL THEN n.text ELSE coalesce(rest.text, '') END AS text,
  coalesce(n_deleted, 0) AS n_deleted, coalesce(gone_words, 0) AS gone_words, coalesce(deleted_lines, '') AS deleted_lines
FROM n LEFT JOIN h ON n.k = h.k LEFT JOIN rest ON n.k = rest.k
"""

ORACLE_SQL: dict[str, str] = {"op1_quality_rules": _QUALITY, "op4_sharding": _SHARDING, "op5_line_dedup": _LINE_DEDUP}
