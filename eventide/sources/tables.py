"""Reading the driver tables and deriving the reference's record types.

Every derived view is a projection over a Parquet scan, so Catalyst prunes
columns and pushes filters into the scan.  Event times stay TIMESTAMP_NTZ
(zone-less), as stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import ensure_utc

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Parallelism floor for CPU-heavy per-row work (text splitting, line
    rendering): when a scan yields fewer partitions than the cluster has
    cores (one small file, one row group), spread the rows round-robin.  On
    a large input the scan already has more splits than cores and nothing is
    added."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def item_id_col(props: str = "props") -> Column:
    """Item id of a behaviour record: the integer ``k`` of the props JSON."""
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def behavior_view(events: DataFrame) -> DataFrame:
    """UserBehavior(user_id, item_id, category_id, behavior, ts) from events;
    ``view`` plays the reference's ``pv``."""
    item = item_id_col()
    return events.select(
        "event_id",
        "user_id",
        item.alias("item_id"),
        (item % 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        "ts",
    )


def page_views(events: DataFrame) -> DataFrame:
    """Behaviour rows of type ``pv``: the filter is on the stored column, so
    it reaches the Parquet scan (a filter on the mapped ``behavior`` column
    would not)."""
    return behavior_view(events.where(F.col("event_type") == "view"))


def sensor_view(events: DataFrame) -> DataFrame:
    """SensorReading(id, ts, temperature): id = user_id, temperature = value."""
    return events.select("event_id", "user_id", "ts", F.col("value").alias("temperature"))


def marketing_view(events: DataFrame) -> DataFrame:
    """MarketingUserBehavior: channel from user parity; ``error`` plays UNINSTALL."""
    return events.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("behavior"),
        F.when(F.col("user_id") % 2 == 0, F.lit("AppStore")).otherwise(F.lit("OtherStore")).alias("channel"),
        "ts",
    )


def login_view(events: DataFrame) -> DataFrame:
    """LoginEvent: ``error`` = fail, ``signup`` = success; ip from the item id."""
    return events.where(F.col("event_type").isin("error", "signup")).select(
        "event_id",
        "user_id",
        F.concat(F.lit("10.0.0."), item_id_col().cast("string")).alias("ip"),
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
        "ts",
    )


def order_events(orders: DataFrame) -> DataFrame:
    """OrderEvent create rows: (order_id, ts)."""
    return orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("ts"))


def pay_events(lineitem: DataFrame) -> DataFrame:
    """Distinct (order_id, ts) shipment instants.  Distinct first: a key that
    holds a third of lineitem collapses to its few distinct dates map-side."""
    return lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("ts")).distinct()


def receipts(lineitem: DataFrame) -> DataFrame:
    """One receipt per order: its first shipment (partial aggregation)."""
    return lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.min("l_shipdate").alias("pay_ts"))
