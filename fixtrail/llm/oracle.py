"""The corpus queries that SQL can express, as DuckDB SQL."""

from __future__ import annotations

# Sorted running sums give the same cut as the nested histograms.
_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15)
              AS BIGINT) AS h
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w,
         2.0::DOUBLE * source_size AS cap FROM src),
filled AS (
  SELECT *, coalesce(sum(cap) OVER below, 0) AS held, sum(w) OVER () - coalesce(sum(w) OVER below, 0) AS free
  FROM weighed
  WINDOW below AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rate AS (
  SELECT arg_min((1.5 * (SELECT sum(source_size) FROM src) - held) / free, cap / w) AS r FROM filled
  WHERE cap / w >= (1.5 * (SELECT sum(source_size) FROM src) - held) / free),
target AS (SELECT source, source_size, least(cap, w * r) AS target FROM weighed, rate),
ordered AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.h) AS at_hash,
         count(CASE WHEN s.size > 0 THEN 1 END) OVER (PARTITION BY s.source, s.h) AS n
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (
  SELECT *, floor(target) - whole * source_size AS budget, floor(target) - whole * source_size - (upto - at_hash) AS rest
  FROM ordered)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + CASE
         WHEN size = 0 OR rest < 0 THEN 0
         WHEN at_hash <= rest THEN size
         WHEN n = 1 THEN CASE WHEN at_hash - rest < rest THEN size ELSE 0 END
         ELSE least(size, floor(rest / n)) END AS BIGINT) AS taken
FROM cut
"""

_WARC = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""



def _kmeans(rounds: int = 10) -> str:
    """Lloyd's rounds as a chain of common tables, one row for each vector or centroid and dimension."""
    parts = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64),
x AS MATERIALIZED (
  SELECT r, unnest(range(64)) AS d, unnest(list_transform(e, lambda c: CAST(floor(1024 * c) AS BIGINT))) AS v FROM kept),
first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS c FROM kept
  QUALIFY c < 8),
c0 AS MATERIALIZED (SELECT c, d, v FROM first JOIN x USING (r))"""
    ]
    for k in range(rounds + 1):
        parts.append(
            f"""a{k} AS MATERIALIZED (
  SELECT r, arg_min(c, (dist, c)) AS c, min(dist) AS dist
  FROM (SELECT r, c, sum((x.v - m.v) * (x.v - m.v)) AS dist FROM x JOIN c{k} m USING (d) GROUP BY r, c) GROUP BY r)"""
        )
        if k < rounds:
            parts.append(
                f"""c{k + 1} AS MATERIALIZED (
  SELECT c, d, coalesce(n.v, o.v) AS v FROM c{k} o LEFT JOIN (
    SELECT c, d, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS v
    FROM (SELECT c, d, sum(v) AS s, count(*) AS n FROM x JOIN a{k} USING (r) GROUP BY c, d)) n USING (c, d))"""
            )
    last = f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
       CAST(sum(dist) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM a{rounds} a JOIN kept USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h ON a.c = h.c
"""
    return "WITH " + ",\n".join(parts) + last


_STATEMENTS: dict[str, str] = {"op1_mix_sources": _MIX, "op2_warc_round_trip": _WARC, "op11_table_kmeans": _kmeans()}


def statements() -> dict[str, str]:
    return dict(_STATEMENTS)
