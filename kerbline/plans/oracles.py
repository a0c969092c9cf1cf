"""The same results in ANSI SQL, used to check ``queries`` against another engine."""

from kerbline.operators.centers import CITY_CENTERS
from kerbline.plans.queries import EAST, LLOYD_K, LLOYD_ROUNDS, NORTH, PICKUP_CENTERS, many_centers

TRIPS = """trips AS (
  SELECT event_id, ts AS dt,
         40.5 + ((event_id * 7919) % 5000) / CAST(10000 AS DOUBLE) AS lat,
         -74.2 + ((event_id * 104729) % 6000) / CAST(10000 AS DOUBLE) AS lon,
         event_type AS base
  FROM events)"""

CENTERS = "centers(cid, clat, clon) AS (VALUES {})".format(
    ", ".join(
        f"(CAST({i} AS INTEGER), CAST({lat!r} AS DOUBLE), CAST({lon!r} AS DOUBLE))"
        for i, (lat, lon) in enumerate(CITY_CENTERS)
    )
)

MANY = "centers(cid, clat, clon) AS (VALUES {})".format(
    ", ".join(
        f"(CAST({i} AS INTEGER), CAST({lat!r} AS DOUBLE), CAST({lon!r} AS DOUBLE))"
        for i, (lat, lon) in enumerate(many_centers())
    )
)

D2 = "(lat - clat) * (lat - clat) + (lon - clon) * (lon - clon)"

NEAREST = f"""ranked AS (
  SELECT trips.*, cid, clat, clon, {D2} AS d2,
         row_number() OVER (PARTITION BY event_id ORDER BY {D2}, cid) AS place
  FROM trips CROSS JOIN centers),
clustered AS (
  SELECT event_id, dt, lat, lon, base, cid, clat, clon, d2 FROM ranked WHERE place = 1)"""

PICKUPS = f"""centers AS (
  SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS INTEGER) AS cid,
         lat + CAST({NORTH!r} AS DOUBLE) AS clat, lon + CAST({EAST!r} AS DOUBLE) AS clon
  FROM trips ORDER BY event_id LIMIT {PICKUP_CENTERS}),
least AS (SELECT event_id, min({D2}) AS d2 FROM trips CROSS JOIN centers GROUP BY event_id),
near AS (
  SELECT event_id, any_value(lat) AS lat, any_value(lon) AS lon, min(cid) AS cid, any_value(d2) AS d2
  FROM trips JOIN least USING (event_id) CROSS JOIN centers WHERE {D2} = d2 GROUP BY event_id)"""
ON_PICKUPS = f"WITH {TRIPS}, {PICKUPS} "

ON_TRIPS = f"WITH {TRIPS} "
ON_CLUSTERED = f"WITH {TRIPS}, {CENTERS}, {NEAREST} "

MONTH = "CAST(month(dt) AS INTEGER)"
DAY = "CAST(day(dt) AS INTEGER)"
HOUR = "CAST(hour(dt) AS INTEGER)"

HOUR_CLUSTER = f"SELECT {HOUR} AS hour, cid, count(cid) AS count FROM clustered GROUP BY 1, 2"
MDHC = (
    f"SELECT {MONTH} AS month, {DAY} AS day, {HOUR} AS hour, cid, count(cid) AS count "
    "FROM clustered GROUP BY 1, 2, 3, 4"
)
WINDOWS = (
    "SELECT cid, date_trunc('hour', dt) AS window_start, "
    "date_trunc('hour', dt) + INTERVAL 1 HOUR AS window_end, count(*) AS count "
    "FROM clustered WHERE dt IS NOT NULL GROUP BY 1, 2, 3"
)

KEYED = (
    "keyed AS (SELECT event_id, lat, lon, base, CAST(event_id % 20 AS INTEGER) AS cid, "
    "CAST(event_id % 20 AS VARCHAR) || '_' || base || '_' || "
    "CAST(date_trunc('hour', dt) AS VARCHAR) AS rowkey FROM trips), "
    "kv AS (SELECT rowkey, arg_max(lat, event_id) AS lat, arg_max(lon, event_id) AS lon, "
    "max(event_id) AS version FROM keyed GROUP BY rowkey)"
)
ON_KEYED = f"WITH {TRIPS}, {KEYED} "

WORDS = """
SELECT word, count(*) AS count FROM (
  SELECT unnest(CASE WHEN text = '' THEN ['']
                     WHEN rtrim(text, ' ') = '' THEN []
                     ELSE string_split(rtrim(text, ' '), ' ') END) AS word
  FROM documents)
GROUP BY word"""

# Late rows: their window ended at or before the latest time of the parts before theirs, less the watermark.
LATE_ROWS = """parts AS (
  SELECT *, date_trunc('hour', dt) AS window_start, date_trunc('hour', dt) + INTERVAL 1 HOUR AS window_end,
         CASE WHEN event_id % 10 = 0 OR dt >= TIMESTAMP '2024-01-22 00:00:00' THEN 2
              WHEN dt >= TIMESTAMP '2024-01-12 00:00:00' THEN 1 ELSE 0 END AS part
  FROM clustered WHERE dt IS NOT NULL),
marks AS (
  SELECT part, date_trunc('millisecond', max(last) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
               - INTERVAL 5 DAY AS mark
  FROM (SELECT part, max(dt) AS last FROM parts GROUP BY part)),
judged AS (SELECT parts.*, coalesce(window_end <= mark, false) AS late FROM parts JOIN marks USING (part))"""

ENRICHED = "dt, lat, lon, cid, clat, clon, base"


def _lloyd(start, rounds):
    """Unrolled k-means rounds; a centre without pickups stays."""
    steps = [f"c0 AS ({start})"]
    for i in range(rounds):
        steps.append(
            f"""m{i} AS (
  SELECT cid, avg(lat) AS clat, avg(lon) AS clon FROM (
    SELECT lat, lon, cid,
           row_number() OVER (PARTITION BY event_id ORDER BY {D2}, cid) AS place
    FROM trips CROSS JOIN c{i}) WHERE place = 1 GROUP BY cid),
c{i + 1} AS (
  SELECT c{i}.cid, coalesce(m{i}.clat, c{i}.clat) AS clat, coalesce(m{i}.clon, c{i}.clon) AS clon
  FROM c{i} LEFT JOIN m{i} ON c{i}.cid = m{i}.cid)"""
        )
    return (
        ", ".join(steps)
        + f" SELECT cid, round(clat, 6) AS clat, round(clon, 6) AS clon FROM c{rounds}"
    )


def _pivot():
    cells = ", ".join(
        f"CAST(sum(count) FILTER (WHERE cid = {c}) AS BIGINT) AS c{c}"
        for c in range(len(CITY_CENTERS))
    )
    return f"{ON_CLUSTERED} SELECT hour, {cells} FROM ({HOUR_CLUSTER}) GROUP BY hour"


def _bundle():
    def part(name, key, value="count(cid)", where=""):
        return (
            f"SELECT '{name}' AS report, {key} AS key, CAST({value} AS BIGINT) AS count "
            f"FROM clustered {where} GROUP BY 2"
        )

    text = {
        n: f"CAST({e} AS VARCHAR)"
        for n, e in {"m": MONTH, "d": DAY, "h": HOUR, "c": "cid"}.items()
    }
    m, d, h, c = text["m"], text["d"], text["h"], text["c"]
    start = "CAST(date_trunc('hour', dt) AS VARCHAR)"
    parts = [
        part("month_day_hour_cluster", f"concat_ws('/', {m}, {d}, {h}, {c})"),
        part("month_day_hour_cluster_top", f"concat_ws('/', {m}, {d}, {h}, {c})"),
        part("month_day_cluster", f"concat_ws('/', {m}, {d}, {c})"),
        part("hour_cluster", f"concat_ws('/', {h}, {c})"),
        f"SELECT 'hour_cluster_top' AS report, concat_ws('/', CAST(hour AS VARCHAR), CAST(cid AS VARCHAR)) AS key, count "
        f"FROM (SELECT * FROM ({HOUR_CLUSTER}) ORDER BY count DESC, hour, cid LIMIT 20)",
        part("cluster_rows", c, "count(*)"),
        part("cluster", c),
        part("hour", h),
        part("windows", f"concat_ws('/', {start}, {c})", "count(*)", "WHERE dt IS NOT NULL"),
        part("window_totals", c, "count(*)", "WHERE dt IS NOT NULL"),
        "SELECT 'window_listing' AS report, concat_ws('/', CAST(cid AS VARCHAR), strftime(window_end, '%b-%d %H:%M')) AS key, "
        f"count FROM ({WINDOWS})",
        "SELECT 'rows' AS report, '' AS key, count(*) AS count FROM clustered",
    ]
    return ON_CLUSTERED + " UNION ALL ".join(parts)


ORACLES = {
    "cluster_assign": f"{ON_CLUSTERED} SELECT event_id, lat, lon, base, cid FROM clustered",
    "cluster_assign_many": f"WITH {TRIPS}, {MANY}, {NEAREST} SELECT event_id, lat, lon, base, cid FROM clustered",
    "cluster_assign_pickups": f"{ON_PICKUPS} SELECT event_id, cid, d2 FROM near",
    "enrich_pickups": f"{ON_PICKUPS} SELECT cid, clat, clon, count(*) AS count, round(max(pow(lat - clat, 2) "
    "+ pow(lon - clon, 2)), 9) AS farthest FROM near JOIN centers USING (cid) GROUP BY cid, clat, clon",
    "enrich_join": f"{ON_CLUSTERED} SELECT event_id, {ENRICHED} FROM clustered",
    "center_table": f"WITH {TRIPS}, {CENTERS}, " + _lloyd("SELECT * FROM centers", 1),
    "clustering_cost": f"{ON_CLUSTERED} SELECT round(sum(d2), 4) AS cost FROM clustered",
    "lloyd_kmeans": f"WITH {TRIPS}, "
    + _lloyd(
        "SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS INTEGER) AS cid, "
        f"lat AS clat, lon AS clon FROM trips ORDER BY event_id LIMIT {LLOYD_K}",
        LLOYD_ROUNDS,
    ),
    "kmeans_fit_invariants": "SELECT CAST(20 AS INTEGER) AS k, count(*) AS assigned, "
    "CAST(0 AS BIGINT) AS not_nearest, CAST(1 AS INTEGER) AS cheaper, count(*) AS weight FROM events",
    "kmeans_vectors_invariants": "SELECT CAST(10 AS INTEGER) AS k, count(*) AS assigned, "
    "CAST(0 AS BIGINT) AS not_nearest FROM embeddings",
    "kmeans_model_roundtrip": "SELECT CAST(20 AS INTEGER) AS k, CAST(0 AS BIGINT) AS different",
    "hash_split": "SELECT event_id, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) "
    "AS BIGINT) % 100 < 70 AS in_train FROM events",
    "random_split_invariants": "SELECT CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS overlap",
    "count_month_day_hour_cluster": f"{ON_CLUSTERED} {MDHC} ORDER BY day, hour, cid",
    "count_mdh_cluster_top": f"{ON_CLUSTERED} {MDHC} ORDER BY count DESC, cid DESC",
    "count_month_day_cluster": f"{ON_CLUSTERED} SELECT {MONTH} AS month, {DAY} AS day, cid, "
    "count(cid) AS count FROM clustered GROUP BY 1, 2, 3 ORDER BY count DESC",
    "count_hour_cluster": f"{ON_CLUSTERED} {HOUR_CLUSTER} ORDER BY count DESC",
    "topk_hour_cluster": f"{ON_CLUSTERED} SELECT * FROM ({HOUR_CLUSTER}) "
    "ORDER BY count DESC, hour, cid LIMIT 20",
    "count_cluster": f"{ON_CLUSTERED} SELECT cid, count(*) AS count FROM clustered GROUP BY cid",
    "sql_count_cluster": f"{ON_CLUSTERED} SELECT cid, count(cid) AS count FROM clustered "
    "GROUP BY cid ORDER BY count DESC",
    "sql_count_hour": f"{ON_CLUSTERED} SELECT {HOUR} AS hr, count(cid) AS ct FROM clustered "
    "GROUP BY 1",
    "window_count_cluster": f"{ON_CLUSTERED} {WINDOWS}",
    "rollup_window_counts": f"{ON_CLUSTERED} SELECT cid, CAST(sum(count) AS BIGINT) AS total_count "
    f"FROM ({WINDOWS}) GROUP BY cid",
    "window_end_listing": f"{ON_CLUSTERED} SELECT cid, strftime(window_end, '%b-%d %H:%M') AS dt, "
    f"count FROM ({WINDOWS}) ORDER BY window_end, cid",
    "pivot_hour_cluster": _pivot(),
    "row_count": "SELECT count(*) AS count FROM events",
    "limit_n": f"{ON_TRIPS} SELECT * FROM trips ORDER BY event_id LIMIT 5",
    "null_cluster_counts": f"{ON_CLUSTERED} SELECT cid, count(*) AS row_count, "
    "count(cid) AS cid_count FROM (SELECT CASE WHEN base <> 'error' THEN cid END AS cid "
    "FROM clustered) GROUP BY cid",
    "report_bundle": _bundle(),
    "csv_scan": f"{ON_TRIPS} SELECT dt, lat, lon, base FROM trips",
    "json_scan": f"{ON_CLUSTERED} SELECT dt, lat, lon, cid, base FROM clustered",
    "csv_decode": f"{ON_TRIPS} SELECT event_id, dt, lat, lon, base FROM trips",
    "csv_dead_letters": "SELECT event_type AS sent, count(*) AS row_count, "
    "count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS corrupt "
    "FROM events GROUP BY event_type",
    "json_decode": f"{ON_CLUSTERED} SELECT event_id, {ENRICHED} FROM clustered",
    "json_dead_letters": "SELECT event_type AS sent, count(*) AS row_count, "
    "count(*) FILTER (WHERE event_type = 'error') AS corrupt FROM events GROUP BY event_type",
    "json_encode": """SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id ||
  CASE WHEN event_type = 'error' THEN '' ELSE ',"event_type":"' || event_type || '"' END ||
  '}' AS value FROM events""",
    "json_to_map": "SELECT props->>'$.k' AS k, count(*) AS count FROM events GROUP BY 1",
    "json_typed_map": """SELECT event_id,
  CASE event_id % 6 WHEN 0 THEN 'k' WHEN 1 THEN 'k,on' WHEN 2 THEN 'k,on' WHEN 3 THEN 'k,on' END AS keys,
  CASE event_id % 6 WHEN 0 THEN CAST(props->>'$.k' AS DOUBLE) WHEN 1 THEN CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) END AS number,
  CASE event_id % 6 WHEN 0 THEN props->>'$.k' WHEN 1 THEN regexp_replace(CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR), '\\.?0+$', '')
       WHEN 2 THEN '{"tags":["a","' || event_type || '"],"user":' || user_id || '}' WHEN 3 THEN event_type END AS text,
  CASE event_id % 6 WHEN 2 THEN user_id END AS user_id,
  CASE event_id % 6 WHEN 2 THEN event_type END AS tag,
  CASE event_id % 6 WHEN 1 THEN true WHEN 2 THEN false END AS switched FROM events""",
    "map_encode": """SELECT event_id, '{"even":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END ||
  ',"place":{"event_id":' || event_id || ',"user_id":' || user_id || '},"type":' ||
  CASE WHEN event_type = 'error' THEN 'null' ELSE '"' || event_type || '"' END || ',"user":' || user_id || '}' AS value,
  true AS same FROM events""",
    "word_count": WORDS,
    "kv_rowkey": f"{ON_KEYED} SELECT event_id, rowkey FROM keyed",
    "kv_upsert": f"{ON_KEYED} SELECT rowkey, lat, lon, version FROM kv",
    "kv_replay": f"{ON_KEYED} SELECT rowkey, lat, lon, version FROM kv",
    "kv_compact": f"{ON_KEYED} SELECT rowkey, lat, lon, version FROM kv",
    "kv_compact_replay": f"{ON_KEYED} SELECT rowkey, lat, lon, version FROM kv",
    "kv_range_scan": f"{ON_KEYED} SELECT rowkey AS key, lat, lon FROM kv WHERE rowkey <= '11'",
    "kv_prefix_scan": f"{ON_KEYED} SELECT rowkey, lat, lon FROM kv "
    "WHERE starts_with(rowkey, '2_')",
    "kv_cluster_scan": f"{ON_KEYED} SELECT rowkey, lat, lon FROM kv "
    "WHERE CAST(split_part(rowkey, '_', 1) AS INTEGER) < 11",
    "kv_catalog_scan": f"{ON_KEYED} SELECT rowkey AS key, lat AS latitude FROM kv",
    "stream_topic_read": f"{ON_CLUSTERED} SELECT {ENRICHED} FROM clustered",
    "replay_text": "SELECT concat_ws(',', event_id, user_id, event_type, props) AS value "
    "FROM events",
    "stream_enrich": f"{ON_CLUSTERED} SELECT {ENRICHED} FROM clustered",
    "stream_enrich_sorted": f"{ON_CLUSTERED} SELECT {ENRICHED} FROM clustered",
    "stream_batch_counts": f"{ON_CLUSTERED} SELECT cid, window_start, count FROM ({WINDOWS})",
    "stream_window_count": f"{ON_CLUSTERED} {WINDOWS}",
    "stream_word_count": WORDS,
    "stream_window_append": f"{ON_CLUSTERED}, {LATE_ROWS} SELECT cid, window_start, window_end, count(*) AS count "
    "FROM judged WHERE NOT late GROUP BY 1, 2, 3 "
    "HAVING window_end <= (SELECT date_trunc('millisecond', max(dt)) - INTERVAL 5 DAY FROM parts)",
    "stream_late_rows": f"{ON_CLUSTERED}, {LATE_ROWS} SELECT CAST(part AS INTEGER) AS part, count(*) AS input, "
    "count(DISTINCT (cid, window_start)) FILTER (WHERE late) AS late_groups FROM judged GROUP BY part",
    "stream_word_totals": WORDS,
    "stream_row_counts": "SELECT unnest(['batches', 'input', 'good', 'rejected']) AS metric, unnest([120, count(*), "
    "count(*) FILTER (WHERE event_type <> 'error'), count(*) FILTER (WHERE event_type = 'error')]) AS n FROM events",
    "stream_topic_archive": f"{ON_CLUSTERED} SELECT {ENRICHED} FROM clustered",
    "stream_dead_letters": "SELECT CASE event_type WHEN 'error' THEN 'junk' WHEN 'signup' THEN 'incomplete' "
    "ELSE 'good' END AS outcome, count(*) AS n FROM events GROUP BY 1",
    "stream_kv_upsert": f"{ON_KEYED} SELECT cid, count(DISTINCT rowkey) AS keys, "
    "count(*) AS count FROM keyed GROUP BY cid",
    "item_publish": """SELECT '{"id":"' || event_id || '","value":"' || user_id || '"}' AS value
FROM events""",
}
