"""DuckDB SQL that says the same as each query of ``table_queries``, written from the rules rather than from the code."""

from __future__ import annotations

EVENTS_BY_USER = "SELECT user_id, event_id AS o, value FROM events"
EVENTS_BY_USER_TYPE = "SELECT user_id, event_type, event_id AS o, value FROM events"
EVENTS_BY_USER_DAY = "SELECT user_id, CAST(ts AS DATE) AS day, event_id AS o, value FROM events"
LINEITEM = (
    "SELECT l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    "(l_orderkey, l_partkey, l_quantity) AS o, l_quantity AS value FROM lineitem"
)
EMBEDDINGS = (
    "SELECT vec_id, CAST(i AS BIGINT) AS o, CAST(embedding[i] AS DOUBLE) AS value "
    "FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"
)


def numbered(samples: str, keys: str) -> str:
    return f"""numbered AS (
  SELECT {keys}, value, row_number() OVER (PARTITION BY {keys} ORDER BY o) - 1 AS pos,
         count(*) OVER (PARTITION BY {keys}) AS n,
         ntile(16) OVER (PARTITION BY {keys} ORDER BY o) AS segment_index
  FROM ({samples}))"""


def segment_ctes(samples: str, keys: str) -> str:
    return f"""{numbered(samples, keys)},
stats AS (
  SELECT {keys}, segment_index, count(*) AS c, avg(value) AS m, stddev_pop(value) AS s, min(value) AS lo, max(value) AS hi
  FROM numbered GROUP BY {keys}, segment_index),
grid AS (SELECT * FROM (SELECT DISTINCT {keys} FROM numbered), (SELECT unnest(range(1, 17)) AS segment_index)),
segs AS (
  SELECT {keys}, grid.segment_index AS segment_index,
         CASE WHEN grid.segment_index % 2 = 1 THEN 'odd' ELSE 'even' END AS parity_group,
         (grid.segment_index + 1) // 2 AS parity_order, coalesce(c, 0) AS sample_count, m, s, lo, hi
  FROM grid LEFT JOIN stats USING ({keys}, segment_index))"""


def summary_ctes(samples: str, keys: str) -> str:
    return f"""{segment_ctes(samples, keys)},
sides AS (
  SELECT {keys}, count(*) AS record_count, CAST(sum(sample_count) AS BIGINT) AS total_samples,
         sum(m * sample_count) FILTER (parity_group = 'odd') / nullif(sum(sample_count) FILTER (parity_group = 'odd'), 0) AS a,
         sum(m * sample_count) FILTER (parity_group = 'even') / nullif(sum(sample_count) FILTER (parity_group = 'even'), 0) AS b
  FROM segs GROUP BY {keys}),
scored AS (SELECT *, abs(a - b) AS gap, abs(a - b) / greatest(abs(a) + abs(b), 1e-9) AS score FROM sides)"""


SEGMENT_VALUES = """CAST(segment_index AS BIGINT) AS segment_index, parity_group, CAST(parity_order AS BIGINT) AS parity_order,
  CAST(sample_count AS BIGINT) AS sample_count, round(m, 8) AS mean_value, round(s, 6) AS std_value,
  round(lo, 6) AS min_value, round(hi, 6) AS max_value"""
SCORE_VALUES = """CAST(record_count AS BIGINT) AS record_count, total_samples, round(a, 8) AS odd_pattern_mean,
  round(b, 8) AS even_pattern_mean, round(gap, 8) AS odd_even_gap, round(score, 6) AS cpd_score,
  CASE WHEN score >= {threshold} THEN 'REVIEW' ELSE 'PASS' END AS quality_decision"""


def segments(samples: str, keys: str) -> str:
    return f"WITH {segment_ctes(samples, keys)} SELECT {keys}, {SEGMENT_VALUES} FROM segs"


def summary(samples: str, keys: str, threshold: float = 0.35) -> str:
    return f"WITH {summary_ctes(samples, keys)} SELECT {keys}, {SCORE_VALUES.format(threshold=threshold)} FROM scored"


def chunks(samples: str, keys: str, size: int) -> str:
    return f"""WITH {numbered(samples, keys)}
SELECT {keys}, pos // {size} AS chunk_index, (max(n) + {size - 1}) // {size} AS total_chunks,
  (pos // {size}) * {size} AS start_sample, least((pos // {size} + 1) * {size}, max(n)) AS end_sample,
  pos // {size} = (max(n) + {size - 1}) // {size} - 1 AS is_last_chunk, count(*) AS samples,
  round(arg_min(value, pos), 5) AS first_sample, round(arg_max(value, pos), 5) AS last_sample
FROM numbered GROUP BY {keys}, pos // {size}"""


VERSION_VALUES = "user_id, event_type, total_samples, round(score, 6) AS cpd_score, CASE WHEN score >= {t} THEN 'REVIEW' ELSE 'PASS' END AS quality_decision"
ALL_TYPES = "SELECT user_id, 'all' AS event_type, event_id AS o, value FROM events"
UPSERT = f"""
SELECT * FROM (WITH {summary_ctes(EVENTS_BY_USER_TYPE, "user_id, event_type")}
  SELECT {VERSION_VALUES.format(t=0.35)} FROM scored WHERE event_type <> 'click')
UNION ALL
SELECT * FROM (WITH {summary_ctes(EVENTS_BY_USER_TYPE + " WHERE event_type = 'click'", "user_id, event_type")}
  SELECT {VERSION_VALUES.format(t=0.1)} FROM scored)
UNION ALL
SELECT * FROM (WITH {summary_ctes(ALL_TYPES, "user_id, event_type")}
  SELECT {VERSION_VALUES.format(t=0.1)} FROM scored)"""

UPSERT_NULL = f"""
SELECT user_id, nullif(event_type, 'click') AS event_type, * EXCLUDE (user_id, event_type) FROM (
{UPSERT.replace("FROM scored)", "FROM scored WHERE event_type <> 'click' OR user_id % 2 = 0)", 1)}
UNION ALL
SELECT * FROM (WITH {summary_ctes(EVENTS_BY_USER_TYPE, "user_id, event_type")}
  SELECT {VERSION_VALUES.format(t=0.35)} FROM scored WHERE event_type = 'click' AND user_id % 2 = 1))"""

BATCH_PATHS = """paths AS (
  SELECT o_orderkey, CASE o_orderkey % 5
    WHEN 0 THEN printf('/data/%s/out/%d_%s_battery_%03d_laser_a.csv', strftime(o_orderdate, '%Y%m%d'), o_orderkey % 150, strftime(o_orderdate, '%Y%m%d'), o_orderkey)
    WHEN 1 THEN printf('/data/%s/reflect/%s_battery_%d_laser_b.csv', strftime(o_orderdate, '%Y%m%d'), strftime(o_orderdate, '%Y%m%d'), o_orderkey)
    WHEN 2 THEN printf('/data_lake/%s/seam-%d_CH1.csv', strftime(o_orderdate, '%Y%m%d'), o_orderkey)
    WHEN 3 THEN printf('/data/x20998877/concat_reflected_1/%d_Seam%d_LA.csv', o_orderkey % 7, o_orderkey)
    ELSE printf('/data/plain/Battery_%05d.csv', o_orderkey) END AS path
  FROM orders),
named AS (SELECT *, parse_filename(path) AS name, lower(path) AS low, regexp_extract(path, '20[0-9]{6}') AS d FROM paths),
lined AS (SELECT *, CASE WHEN regexp_matches(name, '^[0-9]+_') THEN CAST(regexp_extract(name, '^([0-9]+)_', 1) AS BIGINT) ELSE 1 END AS line,
  replace(name, '.csv', '') AS stem FROM named)"""

INSTANCE_PATHS = """paths AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS d, CASE o_orderkey % 6
    WHEN 0 THEN printf('%s_%06d_%d_WLINE_%02d_04_PROD_%03d_%02d_%s.csv', strftime(o_orderdate, '%Y%m%d'), o_orderkey % 235960, o_orderkey % 9,
      o_orderkey % 4, o_orderkey, o_orderkey % 16 + 1, CASE WHEN o_orderkey % 2 = 0 THEN 'LB' ELSE 'LA' END)
    WHEN 1 THEN printf('out/%s_%06d_%d_W%d_07_P-%d_%02d_CH0.csv', strftime(o_orderdate, '%Y%m%d'), o_orderkey % 1000, o_orderkey % 9,
      o_orderkey % 4, o_orderkey, o_orderkey % 16 + 1)
    WHEN 2 THEN printf('laser_b/%s/%s_battery_%03d_laser_b.csv', strftime(o_orderdate, '%Y%m%d'), strftime(o_orderdate, '%Y%m%d'), o_orderkey)
    WHEN 3 THEN printf('%s_battery_%d_CH1.csv', strftime(o_orderdate, '%Y%m%d'), o_orderkey)
    WHEN 4 THEN printf('%s/Reflect/battery_%d.csv', strftime(o_orderdate, '%Y%m%d'), o_orderkey)
    ELSE printf('3_%s_battery_%d_laser_a.csv', strftime(o_orderdate, '%Y%m%d'), o_orderkey) END AS path
  FROM orders),
f AS (
  SELECT o_orderkey, path, d, regexp_extract(path, '([0-9]{8})_([0-9]{6})_([0-9]+)_([A-Za-z0-9]+)_([0-9]{2})_([A-Za-z0-9_-]+)_([0-9]{2})_(CH[01]|L[AB])[.]csv$',
    ['date', 'time', 'seq', 'line', 'batch', 'product', 'lead', 'chan']) AS p FROM paths)"""

EVENT_FILES = """files AS (
  SELECT 'user_' || user_id AS instance_id, 'product_' || (event_id % 5) AS product_id, printf('LINE_%02d', user_id % 3 + 1) AS line_id,
    strftime(ts, '%Y%m%d') AS batch_id, CAST(event_id AS VARCHAR) AS sequence_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
    event_id % 16 + 1 AS lead_num, (event_id // 16) % 2 AS channel, event_type || '/' || user_id || '/' || event_id || '.csv' AS path,
    [event_type, CAST(user_id AS VARCHAR), event_id || '.csv'] AS parts
  FROM events),
pairs AS (
  SELECT instance_id, lead_num, arg_max(path, parts) FILTER (channel = 0) AS channel_0_path,
    arg_max(path, parts) FILTER (channel = 1) AS channel_1_path,
    greatest(count(*) FILTER (channel = 0) - 1, 0) + greatest(count(*) FILTER (channel = 1) - 1, 0) AS duplicates
  FROM files GROUP BY instance_id, lead_num),
done AS (
  SELECT instance_id, count(*) AS leads_present, count(*) FILTER (channel_0_path IS NOT NULL AND channel_1_path IS NOT NULL) AS channel_pairs,
    CAST(sum(duplicates) AS BIGINT) AS duplicates FROM pairs GROUP BY instance_id),
instances AS (
  SELECT instance_id, arg_min({'product_id': product_id, 'line_id': line_id, 'batch_id': batch_id, 'sequence_id': sequence_id, 'event_time': event_time}, parts) AS x
  FROM files GROUP BY instance_id)"""


def replay(lines: int, total: str, seconds: float = 10, seeds: list[int] | None = None, cap: int | None = None) -> str:
    limit = f"ORDER BY event_time, line_id, instance_id LIMIT {cap}" if cap else ""
    if seeds:
        pool = f"""SELECT *, row_number() OVER (PARTITION BY line_index ORDER BY md5({seeds}[CAST(line_index % {len(seeds)} AS INTEGER) + 1] || ':' || instance_id), instance_id) - 1 AS slot
          FROM chosen, (SELECT unnest(range({lines})) AS line_index)"""
        on = "slot = product_index % (SELECT count(*) FROM chosen) AND pool.line_index = i.line_index"
    else:
        pool = "SELECT *, row_number() OVER (ORDER BY event_time, line_id, instance_id) - 1 AS slot FROM chosen"
        on = "slot = product_index % (SELECT count(*) FROM chosen)"
    line = "pool.line_id" if lines == 1 else "printf('LINE_%02d', i.line_index + 1)"
    number = "CAST(regexp_extract(pool.line_id, '([0-9]+)$', 1) AS BIGINT)" if lines == 1 else "i.line_index + 1"
    return f"""orders_in AS (
  SELECT 'order_' || o_orderkey AS instance_id, 'customer_' || o_custkey AS product_id, printf('LINE_%02d', o_orderkey % 3 + 1) AS line_id,
    o_orderdate AS event_time FROM orders),
chosen AS (SELECT * FROM orders_in {limit}),
pool AS ({pool}),
i AS (SELECT id % {lines} AS line_index, id // {lines} AS product_index FROM range({total}) t(id)),
items AS (
  SELECT pool.instance_id AS original_product_instance_id, pool.product_id AS product_id, {line} AS line_id, {number} AS line_number,
    product_index // (SELECT count(*) FROM chosen) AS replay_iteration,
    product_index // (SELECT count(*) FROM chosen) > 0 OR {line} <> pool.line_id AS is_duplicate,
    strftime((SELECT min(event_time) FROM chosen) + to_microseconds(CAST(product_index * {int(seconds * 1000000)} AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS event_time
  FROM i JOIN pool ON {on}),
published AS (
  SELECT CASE WHEN is_duplicate THEN printf('%s_%s_R%05d', original_product_instance_id, line_id, replay_iteration)
    ELSE original_product_instance_id END AS product_instance_id, * FROM items)"""


PUBLISHED = """SELECT product_instance_id, original_product_instance_id, product_id, line_id, CAST(line_number AS BIGINT) AS line_number,
  event_time, is_duplicate, CAST(replay_iteration AS BIGINT) AS replay_iteration FROM published"""

MESSAGES_BY_USER = f"""{numbered(EVENTS_BY_USER, "user_id")},
chunked AS (
  SELECT user_id, pos // 16 AS chunk_index, max(n) AS n, count(*) AS samples, sum(value) AS total FROM numbered GROUP BY user_id, pos // 16),
seen AS (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY user_id),
messages AS (
  SELECT user_id, chunk_index, n, samples, total, first_ts, (n + 15) // 16 AS total_chunks, 'product_' || (user_id // 2) AS instance,
    (user_id // 2) % 16 + 1 AS lead_num, user_id % 2 AS channel, CASE WHEN user_id % 2 = 0 THEN 'LB' ELSE 'LA' END AS code,
    printf('LINE_%02d', user_id % 4 + 1) AS line_id
  FROM chunked JOIN seen USING (user_id))"""

FAULTS = """faults AS (
  SELECT event_id, CASE event_id % 10 WHEN 0 THEN '' WHEN 1 THEN 'missing:message_id' WHEN 2 THEN 'range:lead_num' WHEN 3 THEN 'enum:channel'
    WHEN 4 THEN 'const:sample_rate_hz' WHEN 5 THEN 'unreadable' WHEN 6 THEN 'unreadable' WHEN 7 THEN 'format:event_time'
    WHEN 8 THEN 'missing:metadata.is_duplicate' ELSE 'unreadable' END AS errors FROM events)"""
ROUTED = f"""WITH {FAULTS} SELECT CASE WHEN errors = '' THEN 'valid' ELSE 'dead' END AS route, errors AS first_error, count(*) AS messages
FROM faults GROUP BY ALL"""

GAPS = f"""{numbered(EVENTS_BY_USER, "user_id")},
all_chunks AS (SELECT user_id, pos // 16 AS chunk_index, max(n) AS n, count(*) AS samples FROM numbered GROUP BY user_id, pos // 16),
arrived AS (SELECT * FROM all_chunks WHERE (user_id + chunk_index) % 7 <> 0),
state AS (
  SELECT user_id, max((n + 15) // 16) AS total_chunks, count(*) AS received_chunks, CAST(sum(samples) AS BIGINT) AS n,
    count(*) = max((n + 15) // 16) AS is_complete
  FROM arrived GROUP BY user_id)"""

PRODUCT_SAMPLES = "SELECT user_id // 2 AS battery, user_id % 2 AS side, event_id AS o, value FROM events"
RUN_FACTS = """'00000000-0000-0000-0000-000000000001' AS run_id, 'SUCCESS' AS status, files + 3 AS total_files, 16 * (files + 1) AS total_segment_rows, files + 1 AS total_summary_rows"""
PUBLISH = """WITH signals AS (
  SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n
  FROM events {where}),
named AS (
  SELECT *, 'battery_' || (user_id // 2) AS product_id, printf('2024010%d_battery_%d', (user_id // 2) % 3 + 1, user_id // 2) AS instance, user_id % 2 AS channel FROM signals)
SELECT printf('LINE_01_%s_L01_%s', instance, CASE WHEN channel = 0 THEN 'LB' ELSE 'LA' END) AS key, instance AS product_instance_id, product_id, 'LINE_01' AS line_id,
  channel, CAST(1 AS BIGINT) AS lead_num, pos // 16 AS chunk_index, (max(n) + 15) // 16 AS total_chunks, (pos // 16) * 16 AS start_sample,
  pos // 16 = (max(n) + 15) // 16 - 1 AS is_last_chunk, false AS is_duplicate, count(*) AS samples, round(sum(CAST(CAST(value AS FLOAT) AS DOUBLE)), 1) AS total_value
FROM named GROUP BY instance, product_id, channel, pos // 16"""

CSV_SAMPLES = "SELECT event_type, event_id // 1000000 AS block, event_id AS o, value FROM events"

CHECKS = {
    "segment_stats": segments(EVENTS_BY_USER, "user_id"),
    "segment_stats_short": segments(EVENTS_BY_USER_DAY, "user_id, day"),
    "segment_stats_lineitem": segments(LINEITEM, "l_suppkey, l_linenumber"),
    "segment_stats_embeddings": segments(EMBEDDINGS, "vec_id"),
    "signal_summary": summary(EVENTS_BY_USER_TYPE, "user_id, event_type"),
    "signal_summary_short": summary(EVENTS_BY_USER_DAY, "user_id, day"),
    "signal_summary_lineitem": summary(LINEITEM, "l_suppkey, l_linenumber"),
    "quality_gate": f"""WITH {summary_ctes(EVENTS_BY_USER_DAY, "user_id, day")}
SELECT user_id, day, CASE WHEN score >= 0.6 THEN 'HOLD' WHEN score >= 0.2 THEN 'WARNING' ELSE 'PASS' END AS gate FROM scored""",
    "parity_pivot": f"""WITH {segment_ctes(EVENTS_BY_USER, "user_id")}
SELECT user_id, CAST(sum(sample_count) FILTER (parity_group = 'odd') AS BIGINT) AS odd_samples,
  CAST(sum(sample_count) FILTER (parity_group = 'even') AS BIGINT) AS even_samples,
  count(*) FILTER (parity_group = 'odd') AS odd_segments, count(*) FILTER (parity_group = 'even') AS even_segments
FROM segs GROUP BY user_id""",
    "hour_window": """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
  count(*) AS events, round(sum(value), 2) AS total_value
FROM events GROUP BY date_trunc('hour', ts)""",
    "oldest_date": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice
FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT min(CAST(o_orderdate AS DATE)) FROM orders)""",
    "top_paths": "SELECT page_id, url FROM pages ORDER BY string_split(url, '/'), page_id LIMIT 50",
    "batch_file_metadata": f"""WITH {BATCH_PATHS}
SELECT o_orderkey, name AS file_name, CASE WHEN d <> '' THEN TRY_CAST(d[1:4] || '-' || d[5:6] || '-' || d[7:8] AS DATE) END AS event_date,
  line AS line_number, printf('LINE_%02d', line) AS line_id,
  CASE WHEN regexp_matches(stem, '(?i)battery_[0-9]+') THEN 'battery_' || CAST(regexp_extract(stem, '(?i)battery_([0-9]+)', 1) AS BIGINT)
    ELSE regexp_replace(regexp_replace(stem, '^[0-9]+_', ''), '(?i)_(CH[01]|laser_[ab]|L[AB])$', '') END AS product_id,
  CAST(CASE WHEN contains(low, 'concat_reflected') OR contains(low, 'laser_b') OR contains(low, '/reflect/') OR contains(low, '_lb') THEN 0
    WHEN contains(low, 'concat_out') OR contains(low, 'laser_a') OR contains(low, '/out/') OR contains(low, '_la') THEN 1 ELSE 0 END AS BIGINT) AS channel
FROM lined""",
    "instance_file_metadata": f"""WITH {INSTANCE_PATHS}
SELECT o_orderkey,
  CASE WHEN o_orderkey % 6 < 2 THEN concat_ws('_', p.date, p.time, p.seq, p.line, p.batch, p.product)
    WHEN o_orderkey % 6 < 5 THEN d || '_battery_' || o_orderkey END AS instance_id,
  CASE WHEN o_orderkey % 6 < 2 THEN p.product WHEN o_orderkey % 6 < 5 THEN 'battery_' || o_orderkey END AS product_id,
  CASE WHEN o_orderkey % 6 < 2 THEN p.line WHEN o_orderkey % 6 < 5 THEN 'LINE_01' END AS line_id,
  CASE WHEN o_orderkey % 6 < 2 THEN p.batch WHEN o_orderkey % 6 < 5 THEN d END AS batch_id,
  CASE WHEN o_orderkey % 6 < 2 THEN p.seq WHEN o_orderkey % 6 = 2 THEN printf('%03d', o_orderkey)
    WHEN o_orderkey % 6 = 3 THEN CAST(o_orderkey AS VARCHAR) WHEN o_orderkey % 6 = 4 THEN 'battery_' || o_orderkey END AS sequence_id,
  CASE WHEN o_orderkey % 6 < 2 THEN TRY_CAST(p.lead AS BIGINT) WHEN o_orderkey % 6 < 5 THEN 1 END AS lead_num,
  CAST(CASE o_orderkey % 6 WHEN 0 THEN CASE p.chan WHEN 'LB' THEN 0 ELSE 1 END WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 1 WHEN 4 THEN 0 END AS BIGINT) AS channel,
  CASE WHEN o_orderkey % 6 < 2 THEN strftime(try_strptime(p.date || p.time, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S')
    WHEN o_orderkey % 6 < 5 THEN strftime(try_strptime(d, '%Y%m%d'), '%Y-%m-%d %H:%M:%S') END AS event_time
FROM f""",
    "parse_event_lines": """WITH t AS (
  SELECT event_id, CASE event_id % 14 WHEN 0 THEN value WHEN 1 THEN value WHEN 3 THEN value
    WHEN 5 THEN CAST('10' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS DOUBLE) WHEN 6 THEN -value / 10 END AS v FROM events)
SELECT event_id, round(v, 6) AS sample, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 6) AS single FROM t""",
    "parse_document_lines": """WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS lines, count(*) FILTER (regexp_full_match(regexp_replace(string_split(line, ',')[-1], '^[\\s\\x{85}\\x{a0}\\x1c-\\x1f]+|[\\s\\x{85}\\x{a0}\\x1c-\\x1f]+$', '', 'g'),
    '[+-]?([0-9](_?[0-9])*([.]([0-9](_?[0-9])*)?)?|[.][0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?')) AS samples
FROM lines GROUP BY doc_id""",
    "product_instances": f"WITH {EVENT_FILES} SELECT instance_id, x.product_id, x.line_id, x.batch_id, x.sequence_id, x.event_time FROM instances",
    "channel_pairing": f"WITH {EVENT_FILES} SELECT * FROM pairs",
    "signal_files": f"""WITH {EVENT_FILES}
SELECT instance_id, lead_num, CAST(0 AS BIGINT) AS channel, channel_0_path AS path FROM pairs WHERE channel_0_path IS NOT NULL
UNION ALL SELECT instance_id, lead_num, 1, channel_1_path FROM pairs WHERE channel_1_path IS NOT NULL""",
    "missing_channels": f"""WITH {EVENT_FILES}
SELECT instance_id, lead_num, CAST(CASE WHEN channel_0_path IS NULL THEN 0 ELSE 1 END AS BIGINT) AS missing_channel
FROM pairs WHERE channel_0_path IS NULL OR channel_1_path IS NULL""",
    "instance_completeness": f"WITH {EVENT_FILES} SELECT *, channel_pairs >= 16 AS is_complete FROM done",
    "only_complete": f"""WITH {EVENT_FILES} SELECT instance_id, x.product_id, x.line_id
FROM instances JOIN done USING (instance_id) WHERE channel_pairs >= 16""",
    "replay_expand": f"WITH {replay(3, '3 * (SELECT count(*) FROM orders)')} {PUBLISHED}",
    "replay_to_target": f"WITH {replay(2, '50000', 2.5)} {PUBLISHED}",
    "replay_one_line": f"WITH {replay(1, 'least(100, (SELECT count(*) FROM orders))', cap=100)} {PUBLISHED}",
    "replay_seeded": f"WITH {replay(3, '3 * (SELECT count(*) FROM orders)', seeds=[7, 11])} {PUBLISHED}",
    "seeded_order": f"WITH {replay(3, '1', seeds=[7, 11])} SELECT instance_id, line_index, slot FROM pool",
    "dry_run_summary": f"""WITH {replay(3, '3 * (SELECT count(*) FROM orders)')}
SELECT count(*) AS product_instances, count(*) FILTER (NOT is_duplicate) AS originals, count(*) FILTER (is_duplicate) AS duplicates,
  string_agg(DISTINCT line_id, ', ' ORDER BY line_id) AS lines FROM published""",
    "chunk_events": chunks(EVENTS_BY_USER, "user_id", 16),
    "chunk_lineitem": chunks(LINEITEM, "l_suppkey, l_linenumber", 25),
    "chunk_embeddings": chunks(EMBEDDINGS, "vec_id", 25),
    "partition_keys": """SELECT event_id,
  printf('LINE_%02d_user_%d_L%02d_%s', user_id % 120, user_id, event_id % 16 + 1, CASE WHEN (event_id // 16) % 2 = 0 THEN 'LB' ELSE 'LA' END) AS partition_key,
  printf('user_%d:L%02d:%s:%06d', user_id, event_id % 16 + 1, CASE WHEN (event_id // 16) % 2 = 0 THEN 'LB' ELSE 'LA' END, event_id) AS message_id,
  CASE WHEN (event_id % 16 + 1) % 2 = 1 THEN 'AL_CU' ELSE 'CU_CU' END AS lead_type,
  CASE WHEN (event_id // 16) % 2 = 0 THEN 'LaserB' ELSE 'LaserA' END AS channel_name, user_id % 120 AS line_number FROM events""",
    "message_json": f"""WITH {MESSAGES_BY_USER}
SELECT printf('%s_%s_L%02d_%s', line_id, instance, lead_num, code) AS key, printf('%s:L%02d:%s:%06d', instance, lead_num, code, chunk_index) AS message_id,
  line_id, CASE WHEN lead_num % 2 = 1 THEN 'AL_CU' ELSE 'CU_CU' END AS lead_type, CASE WHEN code = 'LB' THEN 'LaserB' ELSE 'LaserA' END AS channel_name,
  strftime(first_ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(first_ts, '%f') = '000000' THEN '' ELSE '.' || strftime(first_ts, '%f') END || 'Z' AS event_time,
  chunk_index = total_chunks - 1 AS is_last_chunk, lead_num, channel, chunk_index, total_chunks,
  chunk_index * 16 AS start_sample, least(chunk_index * 16 + 16, n) AS end_sample, CAST(25000 AS BIGINT) AS sample_rate_hz,
  printf('%d_user_%d.csv', user_id % 4 + 1, user_id) AS file_name, false AS is_duplicate, samples, round(total, 2) AS total_value
FROM messages""",
    "validate_messages": f"WITH {FAULTS} SELECT event_id, errors FROM faults",
    "route_messages": ROUTED,
    "exclude_replays": """SELECT printf('event_%d:L%02d:%s:000000', event_id, event_id % 16 + 1, CASE WHEN event_id % 2 = 0 THEN 'LB' ELSE 'LA' END) AS message_id,
  printf('LINE_%02d', user_id % 4 + 1) AS line_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(ts, '%f') = '000000' THEN '' ELSE '.' || strftime(ts, '%f') END || 'Z' AS event_time
FROM events WHERE event_type <> 'error'""",
    "dedup_messages": """SELECT printf('event_%d:L%02d:%s:000000', event_id, event_id % 16 + 1, CASE WHEN event_id % 2 = 0 THEN 'LB' ELSE 'LA' END) AS message_id,
  printf('LINE_%02d', user_id % 4 + 1) AS line_id, value AS sample FROM events""",
    "chunk_completeness": f"WITH {GAPS} SELECT * FROM state",
    "reassemble": f"""WITH {GAPS} SELECT numbered.user_id AS user_id, pos, numbered.n AS n, value FROM numbered JOIN state USING (user_id) WHERE is_complete""",
    "missing_chunks": f"""WITH {GAPS} SELECT user_id, (n + 15) // 16 AS total_chunks, chunk_index FROM all_chunks
WHERE (user_id + chunk_index) % 7 = 0 AND user_id IN (SELECT user_id FROM arrived)""",
    "channel_presence": f"""WITH {MESSAGES_BY_USER},
complete AS (SELECT instance, lead_num, channel FROM messages WHERE (lead_num + channel + chunk_index) % 7 <> 0
  GROUP BY instance, lead_num, channel HAVING count(*) = max(total_chunks))
SELECT instance AS product_instance_id, lead_num, bool_or(channel = 0) AS has_channel_0, bool_or(channel = 1) AS has_channel_1,
  bool_or(channel = 0) AND bool_or(channel = 1) AS has_both FROM complete GROUP BY instance, lead_num""",
    "latest_per_key": """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_by_key": UPSERT,
    "upsert_table_rerun": UPSERT_NULL,
    "append_partitioned_rerun": """SELECT day AS event_date, user_id % 4 AS line_number, 2 * count(DISTINCT user_id) AS rows, 2 * count(*) AS samples
FROM (SELECT user_id, CAST(ts AS DATE) AS day FROM events) GROUP BY ALL""",
    "csv_batch_segments": segments(CSV_SAMPLES, "event_type, block"),
    "csv_batch_summary": f"""WITH {summary_ctes(CSV_SAMPLES, "event_type, block")}
SELECT '00000000-0000-0000-0000-000000000001' AS run_id, event_type, block, {SCORE_VALUES.format(threshold=0.35)},
  '2024-01-01 10:00:00' AS window_start, '2024-01-01 11:00:00' AS window_end FROM scored""",
    "csv_split_change": f"""WITH {numbered("SELECT event_type, event_id AS o, value FROM events", "event_type")}
SELECT event_type, pos, n, value FROM numbered""",
    "key_order": f"""WITH {MESSAGES_BY_USER}
SELECT printf('%s_%s_L%02d_%s', line_id, instance, lead_num, code) AS key, chunk_index, chunk_index AS place, CAST(1 AS BIGINT) AS partitions
FROM messages""",
    "publish_messages": PUBLISH.format(where=""),
    "publish_oldest_date": PUBLISH.format(where="WHERE (user_id // 2) % 3 = 0"),
    "batch_job_run": f"""WITH {summary_ctes(PRODUCT_SAMPLES, "battery, side")}, facts AS (SELECT count(*) AS files FROM scored)
SELECT 'battery_' || battery || '.csv' AS file_name, CAST('2024-01-0' || (battery % 3 + 1) AS DATE) AS event_date, 'LINE_01' AS line_id,
  'battery_' || battery AS product_id, CAST(1 AS BIGINT) AS line_number, side AS channel, CAST(16 AS BIGINT) AS record_count, total_samples,
  round(score, 6) AS cpd_score, CASE WHEN score >= 0.35 THEN 'REVIEW' ELSE 'PASS' END AS quality_decision, {RUN_FACTS}
FROM scored, facts
UNION ALL
SELECT '20249999_battery_5000_laser_a.csv', NULL, 'LINE_20249999', 'battery_5000', 20249999, 1, 16, 2, 0.5, 'REVIEW', {RUN_FACTS}
FROM facts""",
    "batch_job_skipped": """SELECT * FROM (VALUES ('7_empty_laser_a.csv', 'no finite numeric samples'), ('7_broken_laser_a.csv', 'not valid UTF-8'),
  ('20249999_battery_5000_laser_a.csv', 'impossible date')) AS t(file_name, reason)""",
    "incomplete_signals": f"""WITH {GAPS}
SELECT user_id, state.total_chunks AS total_chunks, received_chunks, string_agg(CAST(chunk_index AS VARCHAR), ',' ORDER BY chunk_index) AS missing
FROM state JOIN all_chunks USING (user_id) WHERE NOT is_complete AND (user_id + chunk_index) % 7 = 0 GROUP BY ALL""",
    "stream_hourly": """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
  CASE WHEN value >= 100 THEN 'REVIEW' ELSE 'PASS' END AS quality_decision, count(*) AS signals
FROM events GROUP BY ALL""",
    "stream_route": ROUTED,
    "stream_scores": f"""WITH {summary_ctes(EVENTS_BY_USER, "user_id")},
lost AS (SELECT user_id, (max(n) + 15) // 16 AS total, CAST(len(list_filter(range((max(n) + 15) // 16), lambda i: (user_id + i) % 7 = 0 AND user_id % 5 = 0)) AS BIGINT) AS missing
  FROM numbered GROUP BY user_id),
named AS (SELECT *, 'product_' || (user_id // 2) AS product_instance_id, (user_id // 2) % 16 + 1 AS lead_num, user_id % 2 AS channel FROM lost)
SELECT product_instance_id, lead_num, channel, {SCORE_VALUES.format(threshold=0.35)}, missing
FROM scored JOIN named USING (user_id) WHERE missing = 0
UNION ALL BY NAME
SELECT product_instance_id, lead_num, channel, 'INCOMPLETE' AS quality_decision, missing FROM named WHERE missing > 0 AND missing < total""",
    "drift_cusum": f"""WITH {numbered(EVENTS_BY_USER, "user_id")},
off AS (SELECT user_id, pos, value - avg(value) OVER (PARTITION BY user_id) AS x FROM numbered),
sums AS (SELECT user_id, pos, sum(x - 5) OVER w AS up, sum(-x - 5) OVER w AS down FROM off WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
sides AS (SELECT user_id, pos, up - least(0, min(up) OVER w) AS high, down - least(0, min(down) OVER w) AS fall
  FROM sums WINDOW w AS (PARTITION BY user_id ORDER BY pos))
SELECT user_id, round(max(high), 6) AS cusum_high, round(max(fall), 6) AS cusum_low, min(pos) FILTER (high > 400 OR fall > 400) AS first_alarm
FROM sides GROUP BY user_id""",
    "drift_ks": f"""WITH {numbered(EVENTS_BY_USER, "user_id")},
steps AS (SELECT user_id, value, count(*) FILTER (segment_index % 2 = 1) AS a, count(*) FILTER (segment_index % 2 = 0) AS b
  FROM numbered GROUP BY user_id, value),
upto AS (SELECT user_id, sum(a) OVER w AS ua, sum(b) OVER w AS ub, sum(a) OVER (PARTITION BY user_id) AS na, sum(b) OVER (PARTITION BY user_id) AS nb
  FROM steps WINDOW w AS (PARTITION BY user_id ORDER BY value))
SELECT user_id, CAST(max(na) AS BIGINT) AS n_first, CAST(max(nb) AS BIGINT) AS n_second,
  round(max(abs(CAST(ua AS DOUBLE) / nullif(na, 0) - CAST(ub AS DOUBLE) / nullif(nb, 0))), 8) AS ks FROM upto GROUP BY user_id""",
    "baselines": """SELECT event_type, count(*) AS n, round(avg(value), 8) AS mean, round(stddev_pop(value), 6) AS deviation FROM events
WHERE NOT (event_id % 3 = 0 AND event_type = 'view') AND NOT (event_id % 3 = 2 AND event_type = 'error') GROUP BY event_type""",
    "stream_presence": f"""WITH {MESSAGES_BY_USER},
complete AS (SELECT strftime(first_ts, '%Y-%m-%d') AS day, instance, lead_num, channel FROM messages
  WHERE NOT (user_id % 5 = 0 AND (user_id + chunk_index) % 7 = 0) GROUP BY first_ts, instance, lead_num, channel HAVING count(*) = max(total_chunks))
SELECT day, instance AS product_instance_id, lead_num, bool_or(channel = 0) AS has_channel_0, bool_or(channel = 1) AS has_channel_1,
  bool_or(channel = 0) AND bool_or(channel = 1) AS has_both FROM complete GROUP BY day, instance, lead_num""",
    "stream_topics": f"""WITH {summary_ctes(EVENTS_BY_USER, "user_id")},
whole AS (SELECT user_id FROM numbered GROUP BY user_id
  HAVING len([i FOR i IN range((max(n) + 15) // 16) IF (user_id + i) % 7 = 0 AND user_id % 5 = 0]) = 0),
told AS (SELECT 'product_' || (user_id // 2) || ':' || ((user_id // 2) % 16 + 1) || ':' || (user_id % 2) AS key, total_samples, gap, score
  FROM scored JOIN whole USING (user_id))
SELECT 'features' AS topic, key, total_samples, round(gap, 8) AS odd_even_gap, CAST(NULL AS DOUBLE) AS cpd_score, CAST(NULL AS VARCHAR) AS quality_decision FROM told
UNION ALL
SELECT 'decisions', key, NULL, NULL, round(score, 6), CASE WHEN score >= 0.35 THEN 'REVIEW' ELSE 'PASS' END FROM told""",
    "stream_late": """WITH sent AS (
  SELECT event_id, ts, CASE WHEN event_id % 50 = 0 THEN 3 ELSE event_id * 4 // (max(event_id) OVER () + 1) END AS delivery FROM events),
bounds AS (SELECT d.delivery, max(ts) - INTERVAL 10 MINUTE AS bound FROM (SELECT DISTINCT delivery FROM sent) d JOIN sent s ON s.delivery < d.delivery GROUP BY d.delivery)
SELECT event_id, strftime(bound, '%Y-%m-%d %H:%M:%S.%f') AS bound, 'late' AS reason FROM sent JOIN bounds USING (delivery) WHERE ts < bound""",
    "drift_ewma": f"""WITH {numbered(EVENTS_BY_USER, "user_id")},
off AS (SELECT user_id, pos, value - avg(value) OVER (PARTITION BY user_id) AS x, stddev_pop(value) OVER (PARTITION BY user_id) AS sigma FROM numbered),
means AS (SELECT user_id, pos, sigma, 0.2 * pow(0.8, pos) * sum(x * pow(0.8, -pos)) OVER (PARTITION BY user_id ORDER BY pos) AS e FROM off)
SELECT user_id, round(max(e), 6) AS ewma_high, round(min(e), 6) AS ewma_low, round(arg_max(e, pos), 6) AS ewma_last,
  min(pos) FILTER (abs(e) > 2.7 * sigma * sqrt(0.2 / 1.8 * (1 - pow(0.8, 2 * pos + 2)))) AS first_alarm FROM means GROUP BY user_id""",
    "change_points": f"""WITH RECURSIVE {numbered(EVENTS_BY_USER, "user_id")},
off AS (SELECT user_id, pos, n, avg(value) OVER w AS mean, var_pop(value) OVER w AS var, value - avg(value) OVER w AS x FROM numbered WINDOW w AS (PARTITION BY user_id)),
cells AS (SELECT user_id, pos // ((n + 31) // 32) AS cell, min(pos) AS first, count(*) AS c, sum(x) AS s, sum(x * x) AS q, max(mean) AS mean, max(var) AS var
  FROM off GROUP BY ALL),
sums AS (SELECT user_id, cell, first, mean, var, sum(c) OVER w AS c, sum(s) OVER w AS s, sum(q) OVER w AS q FROM cells WINDOW w AS (PARTITION BY user_id ORDER BY cell)),
lists AS (SELECT user_id, count(*) AS m, max(mean) AS mean, 1e-9 + 1.0 * max(var) * ln(count(*)) AS fine, list(first ORDER BY cell) AS first,
  list_prepend(0, list(c ORDER BY cell)) AS c, list_prepend(0, list(s ORDER BY cell)) AS s, list_prepend(0, list(q ORDER BY cell)) AS q FROM sums GROUP BY user_id),
search AS (
  SELECT user_id, 0 AS t, [-fine] AS best, [CAST(0 AS BIGINT)] AS last FROM lists
  UNION ALL
  SELECT user_id, t + 1, list_append(best, least[1]), list_append(last, CAST(least[2] AS BIGINT)) FROM (
    SELECT user_id, t, best, last, list_min([
      [best[i] + greatest(0, q[t + 2] - q[i] - (s[t + 2] - s[i]) * (s[t + 2] - s[i]) / (c[t + 2] - c[i])) + fine, CAST(i - 1 AS DOUBLE)]
      FOR i IN range(1, t + 2)]) AS least
    FROM search JOIN lists USING (user_id) WHERE t < m)),
walk AS (
  SELECT user_id, m AS upto, last[m + 1] AS start FROM search JOIN lists USING (user_id) WHERE t = m
  UNION ALL
  SELECT w.user_id, w.start, last[w.start + 1] FROM walk w JOIN search USING (user_id) JOIN lists USING (user_id) WHERE t = m AND w.start > 0)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY start) - 1 AS piece, first[start + 1] AS start_pos,
  CAST(c[upto + 1] - c[start + 1] AS BIGINT) AS n, round(mean + (s[upto + 1] - s[start + 1]) / (c[upto + 1] - c[start + 1]), 6) AS mean
FROM walk JOIN lists USING (user_id)""",
    "daily_summary": f"""WITH {summary_ctes(EVENTS_BY_USER_DAY, "user_id, day")},
judged AS (
  SELECT day, CASE WHEN user_id % 10 = 0 THEN 4 ELSE user_id % 4 END AS line, CASE WHEN user_id % 5 = 0 THEN score / 2 ELSE score END AS score,
    CASE WHEN user_id % 5 = 0 THEN score / 2 >= 0.2 ELSE score >= 0.35 END AS review FROM scored)
SELECT day AS event_date, CAST(line AS BIGINT) AS line_number, count(*) AS files, count(*) FILTER (review) AS reviews,
  round(count(*) FILTER (review) / count(*), 6) AS review_share, round(avg(score), 6) AS mean_score, round(max(score), 6) AS max_score
FROM judged GROUP BY day, line""",
    "broker_partitions": """WITH keys AS (
  SELECT event_id, printf('LINE_%02d_user_%d_L%02d_%s', user_id % 120, user_id, event_id % 16 + 1, CASE WHEN (event_id // 16) % 2 = 0 THEN 'LB' ELSE 'LA' END) AS partition_key
  FROM events),
bytes AS (SELECT *, [CAST(ord(substr(partition_key, i, 1)) AS BIGINT) FOR i IN range(1, length(partition_key) + 1)] AS b, length(partition_key) AS size FROM keys),
words AS (SELECT *, [((b[i] + (b[i + 1] << 8) + (b[i + 2] << 16) + (b[i + 3] << 24)) * 1540483477) & 4294967295 FOR i IN range(1, size - 2, 4)] AS w FROM bytes),
mixed AS (SELECT *, list_reduce([(xor(k, k >> 24) * 1540483477) & 4294967295 FOR k IN w], LAMBDA h, k: xor((h * 1540483477) & 4294967295, k),
  xor(2538058380, CAST(size AS BIGINT))) AS h FROM words),
ended AS (SELECT *, CASE WHEN size % 4 = 0 THEN h ELSE (xor(xor(xor(h, CASE WHEN size % 4 = 3 THEN b[size] << 16 ELSE 0 END),
  CASE WHEN size % 4 = 3 THEN b[size - 1] << 8 WHEN size % 4 = 2 THEN b[size] << 8 ELSE 0 END), b[size - size % 4 + 1]) * 1540483477) & 4294967295 END AS t FROM mixed),
last AS (SELECT *, (xor(t, t >> 13) * 1540483477) & 4294967295 AS u FROM ended)
SELECT event_id, partition_key, xor(u, u >> 15) AS hash, (xor(u, u >> 15) & 2147483647) % 12 AS partition FROM last""",
    "message_types": """SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'type:message_id' WHEN 2 THEN 'type:line_id' WHEN 3 THEN 'type:metadata.file_name'
  WHEN 4 THEN 'missing:product_id' WHEN 5 THEN 'type:batch_id' ELSE '' END AS errors FROM events""",
}
