"""DuckDB SQL with the same rows as the queries, where SQL can say it."""

from __future__ import annotations

SOURCE_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight FROM sources),
shares AS (
  SELECT *, (1.5 * sum(source_size) OVER ()
      - coalesce(sum(2 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighed WINDOW f AS (ORDER BY 2 * source_size / weight, source NULLS LAST)),
goals AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), CAST(max(share) OVER () AS DOUBLE) * weight) AS target
  FROM shares),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM goals),
ordered AS (
  SELECT d.*, b.source_size, b.target, b.times,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto
  FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  size * (times + CASE WHEN upto <= target - times * source_size THEN 1 ELSE 0 END) AS taken
FROM ordered
"""

CHAT_RENDERINGS = r"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, coalesce(nullif(replace(role, '<|', '< |'), ''), 'unknown') AS speaker,
    replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1) // 512 AS part FROM said),
sides AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
blocks AS (
  SELECT m.*, s.perspective, m.speaker = s.perspective AS own,
    '<|im_start|>' || CASE WHEN m.speaker = 'system' THEN 'system' WHEN m.speaker = s.perspective THEN 'assistant'
      ELSE 'user name=' || m.speaker END || chr(10) AS head,
    m.text || '<|im_end|>' AS body
  FROM numbered m JOIN sides s ON m.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
      PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, speaker, text
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start
  FROM blocks)
SELECT conv_id, perspective, part, count(*) AS n_messages, count(*) FILTER (WHERE own) AS n_own,
  string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, speaker, text) AS rendered,
  coalesce(string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + length(body) AS BIGINT) AS VARCHAR), ','
    ORDER BY turn NULLS FIRST, speaker, text) FILTER (WHERE own), '') AS learn
FROM placed GROUP BY conv_id, perspective, part
"""

def _centroid_clusters() -> str:
    """The rounds one by one: distances to eight lists, then floors of means by component."""
    ctes = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64)""",
        """c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c
  FROM (SELECT sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT 8))""",
    ]
    for n in range(11):
        ctes.append(
            f"""a{n} AS MATERIALIZED (
  SELECT r, min(d) AS d, arg_min(k, (d, k)) AS k
  FROM (SELECT r, k, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v, c)]) AS d FROM kept, c{n})
  GROUP BY r)"""
        )
        if n < 10:
            ctes.append(
                f"""c{n + 1} AS MATERIALIZED (
  SELECT o.k, coalesce(m.c, o.c) AS c FROM c{n} o LEFT JOIN (
    SELECT k, list(CAST((s - (((s % n) + n) % n)) // n AS BIGINT) ORDER BY i) AS c
    FROM (SELECT k, i, sum(x) AS s, count(*) AS n
      FROM (SELECT a.k, unnest(v) AS x, unnest(range(64)) AS i FROM kept JOIN a{n} a USING (r)) GROUP BY k, i)
    GROUP BY k) m ON o.k = m.k)"""
            )
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM kept JOIN a10 a USING (r) JOIN c10 c ON a.k = c.k
"""


CHECKS = {
    "op4_hash_threshold_mix": SOURCE_MIX,
    "op9_perspective_rotation": CHAT_RENDERINGS,
    "op13_centroid_clusters": _centroid_clusters(),
}
