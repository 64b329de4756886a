"""DuckDB SQL for the queries of this subpackage that SQL can express."""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.top AS dropped
  FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

URL_FILTERS = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), rests AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), places AS (SELECT DISTINCT host, path FROM parts),
best AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host) + length(rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host) + length(rule_path)) AS verdict
  FROM places JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, parts.host, parts.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN best ON parts.host = best.host AND parts.path = best.path
"""

DECONTAMINATION = r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), item_starts AS (
  SELECT item, words, least(len(words), 10) AS n,
         unnest(generate_series(1, len(words) - least(len(words), 10) + 1)) AS pos
  FROM item_words WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item, n, array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS passage FROM item_starts
), doc_words AS (
  SELECT doc_id, coalesce(
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents
), lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, pos, array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS passage
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS pos FROM doc_words, lengths)
), found AS (SELECT p.doc_id, p.n, p.pos, w.item FROM places p JOIN windows w ON p.n = w.n AND p.passage = w.passage),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(pos, pos + n - 1)) AS word FROM (SELECT DISTINCT doc_id, n, pos FROM found))
  GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _clustering(rounds: int = 5) -> str:
    """Every round as a table of its own: each vector's nearest centroid, then the floors of the means."""
    steps = []
    for number in range(rounds + 1):
        steps.append(f"""near{number} AS MATERIALIZED (
  SELECT vec_id, row, arg_min(cluster, distance * 64 + cluster) AS cluster, min(distance) AS distance
  FROM (SELECT p.row, any_value(p.vec_id) AS vec_id, c.cluster, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS distance
        FROM parts p JOIN centroids{number} c ON p.i = c.i GROUP BY p.row, c.cluster)
  GROUP BY vec_id, row)""")
        steps.append(f"""centroids{number + 1} AS MATERIALIZED (
  SELECT c.cluster, c.i, coalesce(m.x, c.x) AS x FROM centroids{number} c LEFT JOIN (
    SELECT n.cluster, p.i,
           CAST((sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) / count(*) AS BIGINT) AS x
    FROM near{number} n JOIN parts p USING (row) GROUP BY n.cluster, p.i
  ) m USING (cluster, i))""")
    return f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS row, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, row, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM kept, (SELECT unnest(generate_series(1, 64)) AS i)
), firsts AS (
  SELECT row, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster FROM kept
), centroids0 AS (SELECT f.cluster, p.i, p.x FROM firsts f JOIN parts p USING (row) WHERE f.cluster < 40),
{", ".join(steps[:-1])},
digests AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
  FROM centroids{rounds} GROUP BY cluster)
SELECT n.vec_id, CAST(n.cluster AS INTEGER) AS cluster, n.distance,
       CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(n.distance) OVER () AS BIGINT) AS inertia, d.centroid_sha256
FROM near{rounds} n JOIN digests d USING (cluster)
"""


ORACLES: dict[str, str] = {
    "op3_url_filters": URL_FILTERS,
    "op4_line_dedup": LINE_DEDUP,
    "op11_decontamination": DECONTAMINATION,
    "op13_clustering": _clustering(),
}
