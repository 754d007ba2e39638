"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

from terrella.llm import quality
from terrella.llm.mixing import BLOCK, GOLDEN
from terrella.llm.secrets import RULES

_WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def secret_scan() -> str:
    kinds = []
    for k, r in enumerate(RULES):
        kinds.append(
            f"SELECT d, {k} AS k, unnest(range(1, len(ms) + 1)) AS i, unnest(gaps[1:len(ms)]) AS gap, unnest(ms) AS m, unnest(gs) AS g, {r.least} AS least FROM "
            f"(SELECT d, string_split_regex(t, {_text(r.plain)}) AS gaps, regexp_extract_all(t, {_text(r.plain)}) AS ms, regexp_extract_all(t, {_text(r.plain)}, {r.group}) AS gs FROM docs) WHERE len(ms) > 0"
        )
    named = "[" + ", ".join(f"'{r.kind}'" for r in RULES) + "][k + 1]"
    n_base = sum(r.base for r in RULES)
    counts = ", ".join(f"count(*) FILTER (WHERE k = {k}) AS n_{r.kind}" for k, r in enumerate(RULES) if r.base)
    return f"""WITH docs AS (SELECT doc_id AS d, coalesce(text, '') AS t FROM documents),
 found AS ({' UNION ALL '.join(kinds)}),
 placed AS (SELECT d, k, least, g, length(m) AS n, sum(length(gap) + length(m)) OVER (PARTITION BY d, k ORDER BY i) AS e FROM found),
 spans AS (SELECT d, k, CAST(e - n AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed WHERE length(g) >= least),
 listed AS (SELECT d, k, s, {named} || ':' || CAST(s AS VARCHAR) || ':' || CAST(e AS VARCHAR) AS x FROM spans),
 lists AS (SELECT d, {counts}, string_agg(x, ',' ORDER BY s, k) FILTER (WHERE k < {n_base}) AS base, string_agg(x, ',' ORDER BY s, k) AS spans FROM listed GROUP BY d)
 SELECT docs.d AS doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in RULES if r.base)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN lists ON docs.d = lists.d"""


def quality_rules() -> str:
    lines = f"list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]'))"
    norm = f"trim(lower(regexp_replace(l, '{_GAP}', ' ', 'g')))"
    return f"""WITH docs AS (SELECT doc_id AS d, coalesce(text, '') AS t, text, source AS h FROM documents),
 split AS (SELECT d, text, h, t, regexp_extract_all(t, '{_WORD}') AS w, {lines} AS ls FROM docs),
 each_line AS (SELECT d, text, h, unnest(ls) AS l FROM split),
 normal AS (SELECT d, text, h, {norm} AS l, len(regexp_extract_all(l, '{_WORD}')) AS n FROM each_line),
 texts AS (SELECT h, count(DISTINCT text) AS n FROM docs GROUP BY h),
 often AS (SELECT x.h, x.l FROM (SELECT h, l, count(DISTINCT text) AS n FROM normal GROUP BY h, l) x JOIN texts y ON x.h IS NOT DISTINCT FROM y.h WHERE x.n >= {quality.LEAST} AND x.n > {quality.SHARE} * y.n),
 gone AS (SELECT d, sum(n) AS n FROM normal JOIN often ON normal.h IS NOT DISTINCT FROM often.h AND normal.l = often.l GROUP BY d),
 windows AS (SELECT d, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: list_slice(w, i, i + 7))) AS x FROM split WHERE len(w) >= 8),
 twice AS (SELECT d, i FROM (SELECT d, i, count(*) OVER (PARTITION BY d, x) AS n FROM windows) WHERE n > 1),
 covered AS (SELECT d, count(DISTINCT p) AS n FROM (SELECT d, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY d),
 counts AS (SELECT split.d, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS removed
  FROM split LEFT JOIN covered ON split.d = covered.d LEFT JOIN gone ON split.d = gone.d)
 SELECT d AS doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - removed >= {quality.LEFT} * n_words AS kept, CAST(n_words - removed AS BIGINT) AS words_left FROM counts"""


EMBEDDINGS = """WITH RECURSIVE v AS (SELECT vec_id AS i, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
 n AS (SELECT i, e, sqrt(list_inner_product(e, e)) AS n FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
 pairs AS (SELECT a.i AS a, b.i AS b FROM n a JOIN n b ON a.i <> b.i WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95),
 reach AS (SELECT i, i AS r FROM v UNION SELECT reach.i, pairs.b FROM reach JOIN pairs ON reach.r = pairs.a),
 least AS (SELECT i, min(r) AS c FROM reach GROUP BY i), degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
 SELECT i AS vec_id, coalesce(n, 0) AS n_links, c AS component_id, i = c AS kept FROM least LEFT JOIN degree ON i = a"""

NEAR_DUPLICATES = f"""WITH RECURSIVE docs AS (SELECT doc_id AS d, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
 sets AS (SELECT d, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM docs),
 each_one AS (SELECT d, unnest(s) AS x FROM sets), size AS (SELECT d, len(s) AS n FROM sets),
 common AS (SELECT a.d AS a, b.d AS b, count(*) AS c FROM each_one a JOIN each_one b ON a.x = b.x AND a.d < b.d GROUP BY 1, 2),
 links AS (SELECT a, b FROM common JOIN size x ON a = x.d JOIN size y ON b = y.d WHERE 100 * c >= 80 * (x.n + y.n - c)),
 both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
 reach AS (SELECT d, d AS r FROM docs UNION SELECT reach.d, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
 least AS (SELECT d, min(r) AS c FROM reach GROUP BY d)
 SELECT least.d AS doc_id, n AS n_shingles, c AS component_id, least.d = c AS kept FROM least JOIN size ON least.d = size.d"""

MIX = f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id AS d, source AS s, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS n, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
 sizes AS (SELECT s, CAST(sum(n) AS BIGINT) AS n FROM docs GROUP BY s),
 weighed AS (SELECT s, n, CASE (row_number() OVER (ORDER BY s NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM sizes),
 levels AS (SELECT s, n, w, 2.0::DOUBLE * n / w AS full_at, row_number() OVER (ORDER BY 2.0::DOUBLE * n / w, s) AS k,
  (1.5::DOUBLE * sum(n) OVER () - coalesce(sum(2.0::DOUBLE * n) OVER (ORDER BY 2.0::DOUBLE * n / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (ORDER BY 2.0::DOUBLE * n / w, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
 chosen AS (SELECT level FROM levels WHERE full_at >= level ORDER BY k LIMIT 1),
 targets AS (SELECT s, n, least(2.0::DOUBLE * n, chosen.level * w) AS target, CAST(floor(least(2.0::DOUBLE * n, chosen.level * w)) AS BIGINT) AS goal FROM levels, chosen),
 placed AS (SELECT r, d, docs.s, docs.n, t.n AS whole, target, goal, CAST(coalesce(sum(docs.n) OVER (PARTITION BY docs.s ORDER BY o, d, docs.n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
  FROM docs JOIN targets t ON docs.s IS NOT DISTINCT FROM t.s),
 needs AS (SELECT s, (goal + {BLOCK} - 1) // {BLOCK} AS need FROM targets WHERE goal > 0),
 shares AS (SELECT s, need, total, (upto - need) / CAST(total AS DOUBLE) AS low, upto / CAST(total AS DOUBLE) AS high
  FROM (SELECT s, need, CAST(sum(need) OVER () AS BIGINT) AS total, CAST(sum(need) OVER (ORDER BY s NULLS LAST) AS BIGINT) AS upto FROM needs)),
 points AS (SELECT slot, (slot * {GOLDEN!r}::DOUBLE) % 1.0::DOUBLE AS u FROM (SELECT unnest(range(total + total // 50 + 64)) AS slot FROM (SELECT max(total) AS total FROM shares))),
 dealt AS (SELECT s, need, slot, row_number() OVER (PARTITION BY s ORDER BY slot) - 1 AS rank FROM points JOIN shares ON u >= low AND u < high),
 late AS (SELECT s, total, unnest(range(coalesce(got, 0), need)) AS rank FROM shares LEFT JOIN (SELECT s AS s2, count(*) AS got FROM dealt GROUP BY s) ON s IS NOT DISTINCT FROM s2),
 slots AS (SELECT s, rank, slot FROM dealt WHERE rank < need UNION ALL SELECT s, rank, CAST(trunc(total * 1.1::DOUBLE + 64 + rank) AS BIGINT) FROM late),
 rounds AS (SELECT r, s, unnest([[pos, least(pos + n, goal)], [whole + pos, least(whole + pos + n, goal)]]) AS x FROM placed WHERE n > 0),
 cut AS (SELECT r, s, unnest(range(x[1] // {BLOCK}, (x[2] - 1) // {BLOCK} + 1)) AS rank FROM rounds WHERE x[2] > x[1]),
 held AS (SELECT r, count(DISTINCT cut.rank) AS n_blocks, min(slot) AS first_slot FROM cut JOIN slots ON cut.s IS NOT DISTINCT FROM slots.s AND cut.rank = slots.rank GROUP BY r)
 SELECT d AS doc_id, n AS size, whole AS source_size, target, CASE WHEN whole = 0 THEN 0 ELSE (goal // whole) * n + greatest(0, least(n, goal % whole - pos)) END AS taken,
  coalesce(n_blocks, 0) AS n_blocks, first_slot FROM placed LEFT JOIN held ON placed.r = held.r"""
