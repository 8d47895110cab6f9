"""DuckDB SQL for the queries of this package that SQL can express."""

OP3 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common WHERE 100 * c >= 90 * (nx + ny - c)
  UNION ALL SELECT y, x FROM common WHERE 100 * c >= 90 * (nx + ny - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1),
degree AS (SELECT x, count(*) AS n_links FROM links GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM sets JOIN component USING (doc_id) LEFT JOIN degree ON doc_id = x
"""


def _side(name: str) -> str:
    rendered = f"list_transform({name}[prompt_turns + 1:], lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10))"
    return f"""{name}[prompt_turns + 1:] AS {name}_turns, {rendered} AS {name}_parts"""


def _mask(name: str) -> str:
    before = f"coalesce(list_sum(list_transform({name}_parts[:i - 1], lambda p: length(p))), 0)"
    start = f"CAST({before} + length({name}_turns[i].role) + 5 AS BIGINT)"
    end = f"CAST({before} + length({name}_parts[i]) AS BIGINT)"
    return f"""array_to_string(list_transform(list_filter(range(1, len({name}_parts) + 1), lambda i: {name}_turns[i].role = 'assistant'),
      lambda i: {start} || ':' || {end}), ',') AS {name}_mask"""


OP10 = f"""
WITH whole AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
cut AS (
  SELECT conv_id, list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) AS n, turns FROM whole),
given AS (
  SELECT conv_id, turns[:n] AS chosen, turns[n] AS last, lead(conv_id) OVER (ORDER BY conv_id) AS next FROM cut WHERE n IS NOT NULL),
pairs AS (
  SELECT a.conv_id AS pair_id, a.chosen,
    a.chosen[:len(a.chosen) - 1] || CASE WHEN b.conv_id IS NULL THEN [] ELSE [b.last] END AS rejected
  FROM given a LEFT JOIN given b ON b.conv_id = a.next),
differ AS (
  SELECT *, list_min(list_filter(range(1, least(len(chosen), len(rejected)) + 1),
    lambda i: chosen[i].role <> rejected[i].role OR chosen[i].text <> rejected[i].text)) AS place FROM pairs),
split AS (SELECT *, CAST(coalesce(place - 1, least(len(chosen), len(rejected))) AS INTEGER) AS prompt_turns FROM differ),
parts AS (
  SELECT pair_id, prompt_turns, list_transform(chosen[:prompt_turns],
      lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)) AS prompt_parts,
    {_side('chosen')}, {_side('rejected')} FROM split)
SELECT pair_id, prompt_turns, array_to_string(prompt_parts, '') AS prompt,
  array_to_string(chosen_parts, '') AS chosen, array_to_string(rejected_parts, '') AS rejected,
  {_mask('chosen')}, {_mask('rejected')}
FROM parts
"""


OP12 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
    [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
     regexp_matches(text, '[#$%&*|]'), coalesce(min(words.doc_id) OVER (PARTITION BY text) < words.doc_id, false)] AS f
  FROM words LEFT JOIN marks ON words.doc_id = marks.doc_id),
kinds AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM fails GROUP BY ALL),
orders(o) AS (
  SELECT '' UNION ALL SELECT o || c FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT contains(o, c)),
steps AS (SELECT o AS filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders WHERE length(o) = 5),
seen AS (
  SELECT part, filter_order, step, n, good, bad, f[ascii(filter_order[step]) - 64] AS own,
    len(list_filter(range(1, step), lambda i: f[ascii(filter_order[i]) - 64])) AS before,
    len(list_filter(f, lambda x: x)) AS many FROM kinds, steps)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(sum(CASE WHEN before = 0 AND NOT own THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN before = 0 AND own THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN before > 0 AND own THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN own AND many = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN before = 0 AND own THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN before = 0 AND own THEN bad ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(sum(sum(CASE WHEN before = 0 AND own THEN n ELSE 0 END)) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley
FROM seen GROUP BY part, filter_order, step
"""


OP11 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common WHERE 100 * c >= 80 * (nx + ny - c)
  UNION ALL SELECT y, x FROM common WHERE 100 * c >= 80 * (nx + ny - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN component USING (doc_id)
"""
