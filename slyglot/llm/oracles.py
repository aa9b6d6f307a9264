"""DuckDB SQL for the queries that SQL can express."""

ORACLES = {
    # Exact containment of every item in every document, without sketches.
    "op5_benchmark_decontamination": r"""
WITH item AS (
  SELECT w, min(item_id) AS item_id, least(5, len(w)) AS k
  FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark)
  WHERE len(w) > 0 GROUP BY w
), item_shingle AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM item)
), size AS (SELECT item_id, count(*) AS n_shingles FROM item_shingle GROUP BY item_id),
doc AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
doc_shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc, (SELECT DISTINCT k FROM item) WHERE len(w) >= k)
), matched AS (
  SELECT doc_id, item_id, count(*) AS n_matched FROM doc_shingle JOIN item_shingle USING (s) GROUP BY ALL
)
SELECT doc_id, item_id, n_shingles, n_matched, n_matched / n_shingles AS containment
FROM matched JOIN size USING (item_id) WHERE n_matched >= ceil(0.8 * n_shingles - 1e-9)
""",
    # The same models, level by level: counts, Witten-Bell chances, threshold, verdicts.
    "op7_url_filter": r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN url[instr(url, '://') + 3:] END AS rest FROM pages
), parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    '^^^' || regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(coalesce(url, ''), '^[^:/?#]*://', '')),
      '[0-9]', '0', 'g'), '[=&#]', '?', 'g'), '[^a-z0/.\-?]', '~', 'g') AS read
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
), urls AS (
  SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS action,
    md5(read)[1] IN ('0', '1', '2') AS held, row_number() OVER () AS r
  FROM ruled
), different AS (SELECT DISTINCT read, action, held FROM urls),
g4 AS (
  SELECT read[i:i + 3] AS gram, count(*) FILTER (NOT held AND action = 'allow') AS yes, count(*) FILTER (NOT held AND action = 'block') AS no
  FROM (SELECT *, unnest(range(1, length(read) - 2)) AS i FROM different) GROUP BY 1
),
g3 AS (SELECT gram[2:] AS gram, sum(yes) AS yes, sum(no) AS no FROM g4 GROUP BY 1),
g2 AS (SELECT gram[2:] AS gram, sum(yes) AS yes, sum(no) AS no FROM g3 GROUP BY 1),
g1 AS (SELECT gram[2:] AS gram, sum(yes) AS yes, sum(no) AS no FROM g2 GROUP BY 1),
c1 AS (SELECT gram, yes, no, 1.0::DOUBLE / 33 AS qy, 1.0::DOUBLE / 33 AS qn, sum(yes) OVER () AS ny, sum(no) OVER () AS nn,
  count(*) FILTER (yes > 0) OVER () AS ty, count(*) FILTER (no > 0) OVER () AS tn FROM g1),
p1 AS (SELECT gram, CASE WHEN ny + ty = 0 THEN qy ELSE (yes + ty * qy)::DOUBLE / (ny + ty) END AS py, CASE WHEN nn + tn = 0 THEN qn ELSE (no + tn * qn)::DOUBLE / (nn + tn) END AS pn FROM c1),
c2 AS (SELECT a.gram, yes, no, py AS qy, pn AS qn, sum(yes) OVER w AS ny, sum(no) OVER w AS nn, count(*) FILTER (yes > 0) OVER w AS ty,
  count(*) FILTER (no > 0) OVER w AS tn FROM g2 a JOIN p1 b ON a.gram[2:] = b.gram WINDOW w AS (PARTITION BY a.gram[1:1])),
p2 AS (SELECT gram, CASE WHEN ny + ty = 0 THEN qy ELSE (yes + ty * qy)::DOUBLE / (ny + ty) END AS py, CASE WHEN nn + tn = 0 THEN qn ELSE (no + tn * qn)::DOUBLE / (nn + tn) END AS pn FROM c2),
c3 AS (SELECT a.gram, yes, no, py AS qy, pn AS qn, sum(yes) OVER w AS ny, sum(no) OVER w AS nn, count(*) FILTER (yes > 0) OVER w AS ty,
  count(*) FILTER (no > 0) OVER w AS tn FROM g3 a JOIN p2 b ON a.gram[2:] = b.gram WINDOW w AS (PARTITION BY a.gram[1:2])),
p3 AS (SELECT gram, CASE WHEN ny + ty = 0 THEN qy ELSE (yes + ty * qy)::DOUBLE / (ny + ty) END AS py, CASE WHEN nn + tn = 0 THEN qn ELSE (no + tn * qn)::DOUBLE / (nn + tn) END AS pn FROM c3),
c4 AS (SELECT a.gram, yes, no, py AS qy, pn AS qn, sum(yes) OVER w AS ny, sum(no) OVER w AS nn, count(*) FILTER (yes > 0) OVER w AS ty,
  count(*) FILTER (no > 0) OVER w AS tn FROM g4 a JOIN p3 b ON a.gram[2:] = b.gram WINDOW w AS (PARTITION BY a.gram[1:3])),
p4 AS (SELECT gram, CASE WHEN ny + ty = 0 THEN qy ELSE (yes + ty * qy)::DOUBLE / (ny + ty) END AS py, CASE WHEN nn + tn = 0 THEN qn ELSE (no + tn * qn)::DOUBLE / (nn + tn) END AS pn FROM c4),
scored AS (
  SELECT read, coalesce(round(avg(ln(py) - ln(pn)), 9), 0) AS score
  FROM (SELECT read, unnest(range(1, length(read) - 2)) AS i FROM (SELECT DISTINCT read FROM urls)) JOIN p4 ON read[i:i + 3] = gram GROUP BY read
),
bins AS (
  SELECT floor(coalesce(score, 0) * 50) AS bin, count(*) FILTER (action = 'allow') AS yes, count(*) FILTER (action = 'block') AS no
  FROM different LEFT JOIN scored USING (read) WHERE held AND action IS NOT NULL GROUP BY 1
),
gains AS (
  SELECT bin, round(coalesce(sum(no) OVER b, 0)::DOUBLE / nullif(sum(no) OVER (), 0) - coalesce(sum(yes) OVER b, 0)::DOUBLE / nullif(sum(yes) OVER (), 0), 12) AS gain
  FROM bins WINDOW b AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
threshold AS (SELECT coalesce((SELECT bin / 50 FROM gains WHERE gain IS NOT NULL ORDER BY gain DESC, bin LIMIT 1), 0) AS t)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN coalesce(score, 0) >= t THEN 'allow' ELSE 'block' END) AS verdict, coalesce(score, 0) AS score
FROM urls LEFT JOIN scored USING (read), threshold
""",
}
