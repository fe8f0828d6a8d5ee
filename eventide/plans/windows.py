"""Windowed aggregates and top-N queries over the behaviour, sensor and
marketing views of ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions.udfs import average_aggregate, window_process
from eventide.operators.ranking import top_n_global, top_n_per_group
from eventide.operators.windows import (
    hashed_bitmap_distinct,
    sliding_approx_distinct,
    sliding_count,
    sliding_distinct,
    tumbling,
)
from eventide.plans.registry import BEHAVIOR_CTE, query, slide_ends, tumble_end
from eventide.sources.tables import load, marketing_view, page_views, sensor_view


def _pv(spark, d):
    return page_views(load(spark, d, "events"))


# -- hot items: sliding 1 h / 5 min counts, top 3 per window ------------------

HOT_ITEMS_SQL = f"""
WITH {BEHAVIOR_CTE},
c AS (
  SELECT window_end, item_id, count(*) AS cnt
  FROM (SELECT item_id, {slide_ends('ts', '60 minutes', '5 minutes')} AS window_end
        FROM behavior WHERE behavior = 'pv')
  GROUP BY window_end, item_id)
SELECT window_end, item_id, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank FROM c)
WHERE rank <= 3
"""


def hot_items_df(spark, d, n=3):
    counts = sliding_count(_pv(spark, d), "ts", "1 hour", "5 minutes", ["item_id"], "cnt")
    return top_n_per_group(counts, ["window_end"], [F.desc("cnt"), F.asc("item_id")], n).select(
        "window_end", "item_id", "cnt", "rank"
    )


@query("hot_items", HOT_ITEMS_SQL)
def hot_items(spark, d):
    return hot_items_df(spark, d, 3)


HOT_ITEMS_SQL5 = f"""
WITH {BEHAVIOR_CTE},
c AS (
  SELECT item_id, count(item_id) AS cnt, window_end
  FROM (SELECT item_id, {slide_ends('ts', '60 minutes', '5 minutes')} AS window_end
        FROM behavior WHERE behavior = 'pv')
  GROUP BY window_end, item_id)
SELECT item_id, cnt, window_end, row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num FROM c)
WHERE row_num <= 5
"""


def top_items_sql(spark, events, n=5):
    """Top ``n`` items per 1 h / 5 min hop window in SQL.  The type filter is on
    the stored column, so the scan takes it; views are counted in 5 minute
    panes before a pane is added to the windows that hold it."""
    return spark.sql(
        """
        WITH panes AS (
          SELECT item_id, pane, count(item_id) AS views
          FROM (SELECT item_id, unix_micros(CAST(ts AS TIMESTAMP)) AS us, us - pmod(us, {slide}) AS pane FROM {views})
          GROUP BY item_id, pane),
        hops AS (
          SELECT item_id, explode(sequence(pane + {slide}, pane + {size}, {slide})) AS hop, views FROM panes),
        counts AS (
          SELECT item_id, CAST(timestamp_micros(hop) AS TIMESTAMP_NTZ) AS window_end, sum(views) AS cnt FROM hops GROUP BY item_id, hop),
        ranked AS (
          SELECT item_id, cnt, window_end, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS place FROM counts)
        SELECT item_id, cnt, window_end, CAST(place AS BIGINT) AS row_num FROM ranked WHERE place <= {n}
        """,
        views=page_views(events).select("item_id", "ts"),
        slide=300_000_000,
        size=3_600_000_000,
        n=n,
    )


@query("hot_items_sql", HOT_ITEMS_SQL5)
def hot_items_sql(spark, d):
    """The SQL job: top 5 items of every hop window."""
    return top_items_sql(spark, load(spark, d, "events"))


@query(
    "hot_urls",
    f"""
WITH c AS (
  SELECT window_end, url, count(*) AS cnt
  FROM (SELECT '/p/' || json_extract_string(props, '$.k') AS url,
               {slide_ends("date_trunc('second', ts)", '60 seconds', '5 seconds')} AS window_end
        FROM events)
  GROUP BY window_end, url)
SELECT window_end, url, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rank FROM c)
WHERE rank <= 5
""",
)
def hot_urls(spark, d):
    """Access log records, 1 min / 5 s windows, top 5 URLs per window.  URL and
    second are projected from the rows; ``parse_access_log`` has the way through
    log lines."""
    url = F.concat(F.lit("/p/"), F.get_json_object("props", "$.k"))
    log = load(spark, d, "events").select(url.alias("url"), F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("ts"))
    counts = sliding_count(log, "ts", "1 minute", "5 seconds", ["url"], "cnt")
    return top_n_per_group(counts, ["window_end"], [F.desc("cnt"), F.asc("url")], 5).select(
        "window_end", "url", "cnt", "rank"
    )


@query(
    "topk_global",
    f"""
WITH {BEHAVIOR_CTE}
SELECT item_id, cnt, row_number() OVER (ORDER BY cnt DESC, item_id) AS rank
FROM (SELECT item_id, count(*) AS cnt FROM behavior WHERE behavior = 'pv' GROUP BY item_id)
ORDER BY cnt DESC, item_id LIMIT 10
""",
)
def topk_global(spark, d):
    counts = _pv(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("cnt"))
    return top_n_global(counts, [F.desc("cnt"), F.asc("item_id")], 10)


# -- page views / unique visitors --------------------------------------------

@query(
    "pv_sliding",
    f"""
WITH {BEHAVIOR_CTE}
SELECT window_end, count(*) AS n
FROM (SELECT {slide_ends('ts', '60 minutes', '5 minutes')} AS window_end FROM behavior WHERE behavior = 'pv')
GROUP BY window_end
""",
)
def pv_sliding(spark, d):
    return sliding_count(_pv(spark, d), "ts", "1 hour", "5 minutes", [], "n")


@query(
    "uv_sliding",
    f"""
WITH {BEHAVIOR_CTE}
SELECT window_end, count(DISTINCT user_id) AS n
FROM (SELECT user_id, {slide_ends('ts', '60 minutes', '5 minutes')} AS window_end FROM behavior WHERE behavior = 'pv')
GROUP BY window_end
""",
)
def uv_sliding(spark, d):
    return sliding_distinct(_pv(spark, d), "ts", "1 hour", "5 minutes", "user_id", [], "n")


@query(
    "uv_approx",
    f"""
WITH {BEHAVIOR_CTE}
SELECT DISTINCT {slide_ends('ts', '60 minutes', '5 minutes')} AS window_end, TRUE AS within_bound FROM behavior WHERE behavior = 'pv'
""",
)
def uv_approx(spark, d):
    """Unique visitors per sliding window by mergeable sketches, each held
    against the exact count: within 8 % (five standard errors)."""
    approx = sliding_approx_distinct(_pv(spark, d), "ts", "1 hour", "5 minutes", "user_id", [], "approx")
    exact = sliding_distinct(_pv(spark, d), "ts", "1 hour", "5 minutes", "user_id", [], "exact")
    within = F.abs(F.col("approx") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.08)
    return approx.join(exact, "window_end", "full_outer").select("window_end", F.coalesce(within, F.lit(False)).alias("within_bound"))


@query(
    "uv_hashed_bitmap",
    f"""
WITH {BEHAVIOR_CTE}
SELECT {tumble_end('ts', '1 hour')} AS window_end,
       count(DISTINCT list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''),
                                                 lambda x: CAST(ascii(x) AS BIGINT)),
                                  lambda a, c: (a * 61 + c) % 65536)) AS n
FROM behavior WHERE behavior = 'pv'
GROUP BY ALL
""",
)
def uv_hashed_bitmap(spark, d):
    """Hashed distinct per 1 h window in a 65536-bit bitmap."""
    return hashed_bitmap_distinct(_pv(spark, d), "ts", "1 hour", F.col("user_id").cast("string"), name="n")


# -- marketing ----------------------------------------------------------------

@query(
    "marketing_by_channel",
    f"""
SELECT window_end, channel, behavior, count(*) AS n
FROM (SELECT CASE WHEN user_id % 2 = 0 THEN 'AppStore' ELSE 'OtherStore' END AS channel,
             event_type AS behavior, {slide_ends('ts', '5 hours', '1 hour')} AS window_end
      FROM events WHERE event_type <> 'error')
GROUP BY window_end, channel, behavior
""",
)
def marketing_by_channel(spark, d):
    m = marketing_view(load(spark, d, "events")).where(F.col("behavior") != "error")
    return sliding_count(m, "ts", "5 hours", "1 hour", ["channel", "behavior"], "n")


@query(
    "marketing_total",
    f"""
SELECT window_end, count(*) AS n
FROM (SELECT {slide_ends('ts', '5 hours', '1 hour')} AS window_end FROM events WHERE event_type <> 'error')
GROUP BY window_end
""",
)
def marketing_total(spark, d):
    """Global count per window: no constant key, so partial aggregation keeps
    the single group from becoming one hot task."""
    m = marketing_view(load(spark, d, "events")).where(F.col("behavior") != "error")
    return sliding_count(m, "ts", "5 hours", "1 hour", [], "n")


# -- per sensor, 1 h tumbling -----------------------------------------------

def _sensor(spark, d):
    return sensor_view(load(spark, d, "events"))


def _tumble_sql(aggs: str) -> str:
    return f"""
SELECT user_id, {tumble_end('ts', '1 hour')} AS window_end, {aggs}
FROM events GROUP BY ALL
"""


#: The mean of doubles; the result alone is rounded, since the last bits depend
#: on the order in which partial sums are merged.
MEAN = "round(avg({v}), 9)"


@query("tumbling_count", _tumble_sql("count(*) AS n"))
def tumbling_count(spark, d):
    return tumbling(_sensor(spark, d), "ts", "1 hour", ["user_id"], n=F.count(F.lit(1)))


@query("min_temp_window", _tumble_sql("min(value) AS min_temp"))
def min_temp_window(spark, d):
    return tumbling(_sensor(spark, d), "ts", "1 hour", ["user_id"], min_temp=F.min("temperature"))


@query("avg_temp_window", _tumble_sql(MEAN.format(v="value") + " AS avg_temp"))
def avg_temp_window(spark, d):
    """Average of the readings that are there."""
    return tumbling(_sensor(spark, d), "ts", "1 hour", ["user_id"], avg_temp=F.round(F.avg("temperature"), 9))


@query("minmax_temp_window", _tumble_sql("min(value) AS min_temp, max(value) AS max_temp"))
def minmax_temp_window(spark, d):
    return tumbling(
        _sensor(spark, d), "ts", "1 hour", ["user_id"], min_temp=F.min("temperature"), max_temp=F.max("temperature")
    )


@query("sum_truncated", _tumble_sql("CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS total"))
def sum_truncated(spark, d):
    """Sum of doubles truncated toward zero (Scala ``toLong``)."""
    return tumbling(_sensor(spark, d), "ts", "1 hour", ["user_id"], total=F.sum(F.col("temperature").cast("bigint")))


@query("window_apply_pandas", _tumble_sql("min(value) AS min_temp, max(value) AS max_temp"))
def window_apply_pandas(spark, d):
    """Full-window function (all rows of a window and key as one pandas
    frame).  Slices of a group are processed apart and their results
    combined, so no group is ever held whole by one Python worker."""
    s = _sensor(spark, d).select("user_id", F.window("ts", "1 hour").end.alias("window_end"), "temperature")

    def min_max(p):
        # a frame of complete groups (slices): one row per group
        keys = [c for c in ("user_id", "window_end", "_salt") if c in p.columns]
        return p.groupby(keys, as_index=False, sort=False).agg(
            min_temp=("temperature", "min"), max_temp=("temperature", "max")
        )

    def combine(p):
        return p.groupby(["user_id", "window_end"], as_index=False, sort=False).agg(
            min_temp=("min_temp", "min"), max_temp=("max_temp", "max")
        )

    schema = "user_id long, window_end timestamp_ntz, min_temp double, max_temp double"
    return window_process(s, ["user_id", "window_end"], min_max, schema, combine=combine, salt_buckets=4)


@query("udaf_pandas", _tumble_sql(MEAN.format(v="value") + " AS avg_temp"))
def udaf_pandas(spark, d):
    """User aggregate function (create/add/merge/result) for the average."""
    s = _sensor(spark, d).select("user_id", F.window("ts", "1 hour").end.alias("window_end"), "temperature")
    mean = average_aggregate(["user_id", "window_end"], "temperature").apply(s, ["user_id", "window_end"], "avg_temp")
    return mean.withColumn("avg_temp", F.round("avg_temp", 9))
