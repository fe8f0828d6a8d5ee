"""Text sources and parsers: behaviour CSV, sensor CSV, key/time lines, web
access logs; text file round trips; message-queue option builders.

Parsers are JVM expressions (``split`` + casts + ``to_timestamp_ntz``);
malformed rows are returned with nulls by the ``try_`` casts and can be
split off with ``reject_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sources.tables import item_id_col

# fixed values: access-log time pattern and field positions (0 ip, 2 user,
# 3 time, 5 method, 6 url)
ACCESS_TIME_PATTERN = "dd/MM/yyyy:HH:mm:ss"


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a zone-less time (session zone is UTC)."""
    return F.unix_seconds(ts.cast("timestamp"))


def from_epoch_seconds(s: Column) -> Column:
    return F.timestamp_seconds(s).cast("timestamp_ntz")


def from_epoch_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


# -- line builders (events -> text, the shape of the reference's inputs) -----

def behavior_lines(events: DataFrame) -> DataFrame:
    """``user,item,category,behavior,epoch_seconds``."""
    item = item_id_col()
    beh = F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type"))
    return events.select(
        F.concat_ws(",", F.col("user_id"), item, item % 10, beh, epoch_seconds(F.col("ts"))).alias("value")
    )


def sensor_lines(events: DataFrame) -> DataFrame:
    """``sensor_<user>,epoch_millis,temperature``."""
    return events.select(
        F.concat_ws(
            ",",
            F.concat(F.lit("sensor_"), F.col("user_id")),
            F.unix_millis(F.col("ts").cast("timestamp")),
            F.col("value"),
        ).alias("value")
    )


def key_time_lines(events: DataFrame) -> DataFrame:
    """``key epoch_seconds`` with one space."""
    return events.select(F.concat_ws(" ", F.col("event_type"), epoch_seconds(F.col("ts"))).alias("value"))


def access_log_lines(events: DataFrame) -> DataFrame:
    """``ip - user dd/MM/yyyy:HH:mm:ss +0000 METHOD /p/k``."""
    uid = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), (uid / 65536).cast("bigint") % 256, (uid / 256).cast("bigint") % 256, uid % 256)
    method = F.when(F.col("event_type") == "view", F.lit("GET")).otherwise(F.lit("POST"))
    return events.select(
        F.concat_ws(
            " ",
            ip,
            F.lit("-"),
            uid.cast("string"),
            F.date_format(F.col("ts"), ACCESS_TIME_PATTERN),
            F.lit("+0000"),
            method,
            F.concat(F.lit("/p/"), item_id_col().cast("string")),
        ).alias("value")
    )


# -- parsers -------------------------------------------------------------------

def parse_behavior_csv(lines: DataFrame, col: str = "value") -> DataFrame:
    p = F.split(F.col(col), ",")
    return lines.select(
        F.get(p, 0).try_cast("bigint").alias("user_id"),
        F.get(p, 1).try_cast("bigint").alias("item_id"),
        F.get(p, 2).try_cast("int").alias("category_id"),
        F.get(p, 3).alias("behavior"),
        from_epoch_seconds(F.get(p, 4).try_cast("bigint")).alias("ts"),
    )


def parse_sensor_csv(lines: DataFrame, col: str = "value") -> DataFrame:
    p = F.split(F.col(col), ",")
    return lines.select(
        F.get(p, 0).alias("id"),
        from_epoch_millis(F.get(p, 1).try_cast("bigint")).alias("ts"),
        F.get(p, 2).try_cast("double").alias("temperature"),
    )


def parse_key_time(lines: DataFrame, col: str = "value") -> DataFrame:
    p = F.split(F.col(col), " ")
    return lines.select(F.get(p, 0).alias("key"), from_epoch_seconds(F.get(p, 1).try_cast("bigint")).alias("ts"))


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Fields 0, 2, 3, 5, 6; the zone field (4) is ignored, the time is read
    as written (session zone UTC).  Unparseable times become null."""
    p = F.split(F.col(col), " ")
    return lines.select(
        F.get(p, 0).alias("ip"),
        F.get(p, 2).alias("user_id"),
        F.try_to_timestamp(F.get(p, 3), F.lit(ACCESS_TIME_PATTERN)).cast("timestamp_ntz").alias("ts"),
        F.get(p, 5).alias("method"),
        F.get(p, 6).alias("url"),
    )


def reject_rows(parsed: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rows where any required field failed to parse."""
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    return parsed.where(~bad), parsed.where(bad)


# -- text file round trips -------------------------------------------------------

def write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def round_trip(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    """Write lines as text under the shared checkpoint folder, read them back."""
    path = scratch_path(spark, name)
    write_text(lines, path)
    return read_text(spark, path)


# -- message queue (the connector jar is not on this classpath) -------------------

def kafka_source_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_kafka_lines(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Streaming string lines from a topic (needs the Kafka connector jar)."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_source_options(servers, topic, starting).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def write_kafka_lines(lines: DataFrame, servers: str, topic: str) -> None:
    """Batch write of string lines to a topic (needs the Kafka connector jar)."""
    w = lines.selectExpr("CAST(value AS STRING) AS value").write.format("kafka")
    for k, v in kafka_sink_options(servers, topic).items():
        w = w.option(k, v)
    w.save()
