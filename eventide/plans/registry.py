"""Query registry: name -> (Spark builder, optional DuckDB oracle SQL).

A builder takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables.  The oracle is an independent SQL statement of the same meaning over
the same tables (registered as views by the checker)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


# --- DuckDB SQL fragments shared by the oracles -----------------------------

BEHAVIOR_CTE = """behavior AS (
  SELECT event_id, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS INTEGER) AS category_id,
         CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior,
         ts
  FROM events)"""


def slide_ends(ts: str, size: str, slide: str) -> str:
    """DuckDB: the ends of every sliding window holding ``ts``."""
    return (
        f"unnest(generate_series(time_bucket(INTERVAL '{slide}', {ts}) + INTERVAL '{slide}', "
        f"time_bucket(INTERVAL '{slide}', {ts}) + INTERVAL '{size}', INTERVAL '{slide}'))"
    )


def tumble_end(ts: str, size: str) -> str:
    """DuckDB tumbling window end (sizes that divide a day are epoch-aligned)."""
    return f"(time_bucket(INTERVAL '{size}', {ts}) + INTERVAL '{size}')"


ARRIVAL = "ts + to_seconds((event_id * 7919) % 10800)"
