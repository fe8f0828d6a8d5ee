"""Maps, filters, unions, connect/co-map, side outputs, word count, and the
user-function surface."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from eventide.functions.udfs import plus_one, register_sql_functions
from eventide.operators.transforms import connect_comap, rich_map, side_outputs, split_words, tagged_union
from eventide.operators.windows import tumbling
from eventide.plans.registry import query, tumble_end
from eventide.sources.tables import load, spread

# Java String.split("\\s") on a line, in DuckDB terms
_WORDS_SQL = (
    "CASE WHEN regexp_replace({t}, '\\s+$', '') = '' AND {t} <> '' THEN []::VARCHAR[] "
    "ELSE string_split_regex(regexp_replace({t}, '\\s+$', ''), '\\s') END"
)


@query("map_project", "SELECT user_id FROM events")
def map_project(spark, d):
    return load(spark, d, "events").select("user_id")


@query("filter_predicate", "SELECT * FROM events WHERE value > 100 AND event_type <> 'error'")
def filter_predicate(spark, d):
    """Filter pushed into the Parquet scan."""
    ev = load(spark, d, "events")
    return ev.where((F.col("value") > 100) & (F.col("event_type") != "error"))


@query("key_partition", "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")
def key_partition(spark, d):
    """keyBy(user): the hash exchange on the key comes after map-side partial
    counts, so a hot key sends one row per input partition."""
    return load(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))


@query("rich_map_partitions", "SELECT event_id, value + 1 AS v FROM events")
def rich_map_partitions(spark, d):
    """open / map / close around a +1 map, one Arrow batch at a time."""

    def add_one(b: pd.DataFrame, ctx) -> pd.DataFrame:
        return pd.DataFrame({"event_id": b["event_id"], "v": b["value"] + ctx["inc"]})

    ev = load(spark, d, "events").select("event_id", "value")
    return rich_map(ev, add_one, "event_id long, v double", open_fn=lambda: {"inc": 1.0})


@query("pandas_udf_map", "SELECT event_id, value + 1 AS v FROM events")
def pandas_udf_map(spark, d):
    """The +1 map as a vectorised scalar pandas UDF."""
    return load(spark, d, "events").select("event_id", plus_one("value").alias("v"))


@query(
    "word_count",
    f"SELECT word, count(*) AS cnt FROM (SELECT unnest({_WORDS_SQL.format(t='text')}) AS word FROM documents) GROUP BY word",
)
def word_count(spark, d):
    """flatMap(split on whitespace) + count per word over whole documents;
    partial counts per task before the exchange."""
    docs = spread(load(spark, d, "documents").select("text"))
    words = docs.select(F.explode(split_words(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "word_count_window",
    f"""
SELECT window_end, word, count(*) AS cnt
FROM (SELECT {tumble_end('ts', '1 hour')} AS window_end, unnest({_WORDS_SQL.format(t='event_type')}) AS word
      FROM events)
GROUP BY window_end, word
""",
)
def word_count_window(spark, d):
    """Words of event lines counted per 1 h tumbling window."""
    ev = load(spark, d, "events")
    words = ev.select("ts", F.explode(split_words(F.col("event_type"))).alias("word"))
    return tumbling(words, "ts", "1 hour", ["word"], cnt=F.count(F.lit(1)))


@query(
    "union_all",
    "SELECT event_id, event_type FROM events",
)
def union_all(spark, d):
    """Bag union of same-typed streams: three event types and all others."""
    ev = load(spark, d, "events").select("event_id", "event_type")
    own = ("view", "click", "purchase")
    parts = [(t, ev.where(F.col("event_type") == t)) for t in own]
    others = F.col("event_type").isNull() | ~F.col("event_type").isin(*own)
    return tagged_union([*parts, ("others", ev.where(others))], "_src").drop("_src")


@query(
    "connect_comap",
    "SELECT c_name || ' from map1' AS msg FROM customer UNION ALL SELECT s_name || ' from map2' AS msg FROM supplier",
)
def connect_comap_q(spark, d):
    """Two differently typed streams, one map each, one output."""
    c, s = load(spark, d, "customer"), load(spark, d, "supplier")
    return connect_comap(
        c, s, F.concat(F.col("c_name"), F.lit(" from map1")), F.concat(F.col("s_name"), F.lit(" from map2"))
    )


@query(
    "side_output_alarm",
    "SELECT 'main' AS tag, event_id FROM events UNION ALL SELECT 'alarm' AS tag, event_id FROM events WHERE value < 32",
)
def side_output_alarm(spark, d):
    """Every reading to the main output; readings below 32 also to the alarm
    side output."""
    ev = load(spark, d, "events").select("event_id", "value")
    return side_outputs(ev, {"main": None, "alarm": F.col("value") < 32}).select("tag", "event_id")


@query("sql_scalar_udf", "SELECT event_id, event_type || '1' AS c FROM events")
def sql_scalar_udf(spark, d):
    """Scalar function registered for SQL: a(s) = s || '1'."""
    register_sql_functions(spark)
    return spark.sql("SELECT event_id, a(event_type) AS c FROM {events}", events=load(spark, d, "events"))
