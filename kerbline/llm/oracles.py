"""DuckDB twins of the queries that SQL can express."""

import re

from kerbline.llm.mixing import SCHEDULES, position_sql

OP9 = r"""
WITH parsed AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages),
keyed AS (
  SELECT *, CASE WHEN regexp_replace(host, '^www\.', '') <> ''
    THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS canonical
  FROM parsed),
listed AS (
  SELECT DISTINCT canonical FROM keyed
  WHERE regexp_matches(host, 'adult|bets|casino|pills|spam|(^|[.-])ads([.-]|$)') OR substr(md5(canonical), 1, 1) IN ('0', '1')),
rules(action, domain, prefix) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
ruled AS (
  SELECT page_id, host, path, canonical,
    (SELECT arg_max(domain || prefix, length(domain || prefix)) FROM rules
      WHERE (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix)) AS rule,
    (SELECT arg_max(action, length(domain || prefix)) FROM rules
      WHERE (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix)) AS action
  FROM keyed)
SELECT page_id, host, path, rule,
  coalesce(action, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""

def _position():
    """The schedules as SQL; DuckDB wants no suffix on double literals."""
    part = "least(start / nullif(target, 0D), 1D)"
    kinds = " ".join(f"WHEN {k} THEN {position_sql(part, s)}" for k, s in enumerate(SCHEDULES))
    return re.sub(r"\b([0-9.e-]+)D\b", r"CAST(\1 AS DOUBLE)", f"CASE place % {len(SCHEDULES)} {kinds} END")


OP3 = f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT skey, CAST(sum(size) AS BIGINT) AS source_size, CAST(row_number() OVER (ORDER BY skey) - 1 AS INTEGER) AS place
  FROM docs GROUP BY skey),
weighed AS (SELECT *, CAST([3, 1, 2][place % 3 + 1] AS DOUBLE) AS weight FROM sources),
levels AS (
  SELECT (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER (
      ORDER BY 2.0::DOUBLE * source_size / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    AS level
  FROM weighed),
targets AS (
  SELECT skey, place, source_size,
    least(2.0::DOUBLE * source_size, (SELECT max(level) FROM levels) * weight) AS target FROM weighed),
placed AS (
  SELECT d.*, t.place, t.source_size, t.target, CAST(coalesce(sum(size) OVER (
    PARTITION BY d.skey ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM docs d JOIN targets t USING (skey)),
counted AS (
  SELECT *, CASE WHEN size > 0 THEN CAST(2 * start + size < 2 * target AS INTEGER)
    + CAST(2 * source_size + 2 * start + size < 2 * target AS INTEGER) ELSE 0 END AS n FROM placed),
gaps AS (SELECT skey, any_value(target) - sum(n * size) AS gap FROM counted GROUP BY skey),
fitting AS (
  SELECT skey, start, CAST(sign(gap) AS INTEGER) AS change,
    row_number() OVER (PARTITION BY skey ORDER BY abs(abs(gap) - size), start) AS nth
  FROM counted JOIN gaps USING (skey)
  WHERE size > 0 AND (gap > 0 AND n < 2 OR gap < 0 AND n > 0) AND abs(abs(gap) - size) < abs(gap)),
final AS (
  SELECT c.*, n + CASE WHEN size > 0 THEN coalesce(change, 0) ELSE 0 END AS copies
  FROM counted c LEFT JOIN (SELECT * FROM fitting WHERE nth = 1) f USING (skey, start))
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken,
  CASE WHEN copies > 0 THEN round({_position()}, 6) END AS position
FROM final
"""

OP4 = r"""
WITH docs AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER best = 1 AS kept, text_sha256
FROM docs WINDOW best AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id)
"""

ORACLES = {
    "op3_mixing": OP3,
    "op4_exact_dedup": OP4,
    "op9_url_filter": OP9,
}
