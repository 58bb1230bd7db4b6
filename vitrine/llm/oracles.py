"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

# Unsigned crc32 of the decimal id, bit by bit.
_CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


def _climb(name: str, base: str) -> str:
    """All levels of the trees over `base` (tree, pos, h)."""
    return f"""{name} AS (
  SELECT tree, 0 AS lvl, pos, h FROM {base}
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {name}) WHERE c > 1 GROUP BY tree, lvl, pos // 2)"""


def _steps(name: str, base: str, nodes: str) -> str:
    """Side and digest of the siblings on the path of every row of `base`; '' where there is none."""
    return f"""{name} AS (
  SELECT b.tree, b.pos, list(coalesce(CASE WHEN (b.pos >> n.lvl) % 2 = 1 THEN 'l' ELSE 'r' END || s.h, '')
                             ORDER BY n.lvl) FILTER (WHERE n.lvl < t.top) AS steps, any_value(t.root) AS root
  FROM {base} b JOIN (SELECT tree, max(lvl) AS top, max_by(h, lvl) AS root FROM {nodes} GROUP BY tree) t USING (tree)
  JOIN {nodes} n ON n.tree = b.tree AND n.pos = b.pos >> n.lvl
  LEFT JOIN {nodes} s ON s.tree = n.tree AND s.lvl = n.lvl AND s.pos = xor(n.pos, 1)
  GROUP BY b.tree, b.pos)"""


OP13_MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('n_chars')} AS h,
         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf('(n_chars::HUGEINT + 1)')} END AS later
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM hashed),
{_climb('nodes', 'leaves')},
subroots AS (
  SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, max_by(h, lvl) AS h
  FROM nodes GROUP BY tree),
{_climb('top', 'subroots')},
{_steps('inner_steps', 'leaves', 'nodes')},
{_steps('outer_steps', 'subroots', 'top')},
paths AS (
  SELECT l.doc_id, l.h AS leaf, coalesce(l.later, l.h) AS now, i.root AS subroot, o.root,
         coalesce(i.steps, []) || coalesce(o.steps, []) AS steps
  FROM leaves l JOIN inner_steps i USING (tree, pos) JOIN subroots s ON s.name = l.tree
  JOIN outer_steps o ON o.pos = s.pos),
folded AS (
  SELECT *, list_reduce(list_prepend(now, steps), lambda cur, step: CASE WHEN step[1] = 'l'
           THEN sha256(step[2:] || cur) ELSE sha256(cur || step[2:]) END) AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_aggregate([s[2:] FOR s IN steps], 'string_agg', ''), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded"""


_NUMBERS = r"'\A[0-9.]*\z|\]\z'"


def _worth(units: str) -> str:
    return f"""(SELECT CASE WHEN sum(n * (n - 1) * prior * (1 - prior)) > 0 THEN
    1 / greatest(1 / 1001.0, least(1 / 1.5, sum((x - n * prior) * (x - n * prior) - n * prior * (1 - prior))
                                            / sum(n * (n - 1) * prior * (1 - prior)))) - 1 ELSE 2.0 END FROM {units})"""


OP12_URL_REPUTATION = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '\\A([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '\\A[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM parts),
told AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1
                                     WHEN toxic IS NOT NULL OR quality IS NOT NULL THEN 0 END) AS bad
  FROM labels GROUP BY doc_id),
counts AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::DOUBLE AS x FROM parts LEFT JOIN told USING (page_id)
           GROUP BY host),
bare AS (SELECT *, regexp_replace(regexp_replace(host, '\\A.*@', ''), ':[0-9]*\\z', '') AS b FROM counts),
named AS (
  SELECT host, n, x, CASE WHEN regexp_matches(b, {_NUMBERS}) THEN b ELSE coalesce(
    nullif(regexp_extract(b, '([^.]+\\.(?:ac|co|com|edu|gov|net|or|org)\\.[^.][^.])\\z', 1), ''),
    nullif(regexp_extract(b, '([^.]+\\.[^.]+)\\z', 1), ''), b) END AS domain FROM bare),
hosts AS (SELECT *, CASE WHEN regexp_matches(domain, {_NUMBERS}) THEN domain
                         ELSE regexp_extract(domain, '\\A(?:[^.]*\\.)?(.*)\\z', 1) END AS suffix FROM named),
s0 AS (SELECT suffix, sum(n) AS n, sum(x) AS x, (SELECT (sum(x) + 1) / (sum(n) + 2) FROM hosts) AS prior
       FROM hosts GROUP BY suffix),
s1 AS (SELECT suffix, (x + w * prior) / (n + w) AS prior FROM (SELECT *, {_worth('s0')} AS w FROM s0)),
d0 AS (SELECT domain, sum(n) AS n, sum(x) AS x, any_value(prior) AS prior FROM hosts JOIN s1 USING (suffix) GROUP BY domain),
d1 AS (SELECT domain, (x + w * prior) / (n + w) AS prior FROM (SELECT *, {_worth('d0')} AS w FROM d0)),
h0 AS (SELECT host, n, x, prior FROM hosts JOIN d1 USING (domain)),
h1 AS (SELECT host, n, w, (x + w * prior) / (n + w) AS rate FROM (SELECT *, {_worth('h0')} AS w FROM h0)),
judged AS (SELECT host, rate - 1.645 * sqrt(rate * (1 - rate) / (n + w + 1)) > 0.5 AS blocked FROM h1)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN judged USING (host)"""

ORACLES = {"op12_url_reputation": OP12_URL_REPUTATION, "op13_merkle": OP13_MERKLE}
