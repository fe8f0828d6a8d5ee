"""Text-source queries: events rendered in the reference's line formats,
written as text files under the shared checkpoint folder, read back with the
text source and parsed."""

from __future__ import annotations


from eventide.plans.registry import query
from eventide.sources import text
from eventide.sources.tables import load



@query(
    "src_text_lines",
    """
SELECT concat_ws(',', user_id, CAST(json_extract_string(props, '$.k') AS BIGINT),
                 CAST(json_extract_string(props, '$.k') AS BIGINT) % 10,
                 CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END,
                 CAST(floor(epoch(ts)) AS BIGINT)) AS value
FROM events
""",
)
def src_text_lines(spark, d):
    """Text file source: one string per line."""
    return text.round_trip(spark, text.behavior_lines(load(spark, d, "events")), "behavior-lines")


@query(
    "parse_behavior_csv",
    f"""
SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
       CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS INTEGER) AS category_id,
       CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior,
       make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS ts
FROM events
""",
)
def parse_behavior_csv(spark, d):
    lines = text.round_trip(spark, text.behavior_lines(load(spark, d, "events")), "behavior-lines")
    return text.parse_behavior_csv(lines)


@query(
    "parse_sensor_csv",
    """
SELECT 'sensor_' || user_id AS id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, value AS temperature FROM events
""",
)
def parse_sensor_csv(spark, d):
    lines = text.round_trip(spark, text.sensor_lines(load(spark, d, "events")), "sensor-lines")
    return text.parse_sensor_csv(lines)


@query(
    "parse_key_time",
    "SELECT event_type AS key, make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS ts FROM events",
)
def parse_key_time(spark, d):
    lines = text.round_trip(spark, text.key_time_lines(load(spark, d, "events")), "key-time-lines")
    return text.parse_key_time(lines)


@query(
    "parse_access_log",
    """
SELECT '10.' || ((user_id // 65536) % 256) || '.' || ((user_id // 256) % 256) || '.' || (user_id % 256) AS ip,
       CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS ts,
       CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method,
       '/p/' || json_extract_string(props, '$.k') AS url
FROM events
""",
)
def parse_access_log(spark, d):
    lines = text.round_trip(spark, text.access_log_lines(load(spark, d, "events")), "access-log")
    return text.parse_access_log(lines)
