"""Reading and flattening raw web-analytics events."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.channels import event_param
from tidemark.model import RAW_EVENTS


def in_date_range(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Keep start..end, both included.

    The bounds are literals of the column's own type and the column stays bare, so the
    filter prunes partitions or reaches the Parquet scan.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return df.where(F.col(column).between(f"{start:%Y%m%d}", f"{end:%Y%m%d}"))
    if isinstance(kind, T.DateType):
        return df.where(F.col(column).between(F.lit(start), F.lit(end)))
    after = end + timedelta(days=1)
    return df.where(
        (F.col(column) >= F.lit(f"{start}").cast(kind)) & (F.col(column) < F.lit(f"{after}").cast(kind))
    )


def parse_event_date(text: Column) -> Column:
    """YYYYMMDD -> date"""
    return F.to_date(text, "yyyyMMdd")


def read_events(spark: SparkSession, path: str, start: date, end: date) -> DataFrame:
    """Nested events of a date range from Parquet partitioned by event_date (YYYYMMDD)."""
    events = spark.read.schema(RAW_EVENTS).parquet(path)
    return in_date_range(events, "event_date", start, end)


SHARD = "events_"


@dataclass(frozen=True)
class Shards:
    """The events of a range of days, and the days of the range that have no folder."""

    events: DataFrame
    missing: list[date]


def _shard(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{SHARD}{day:%Y%m%d}"


def read_event_shards(spark: SparkSession, root: str, start: date, end: date) -> Shards:
    """Nested events from one folder a day, ``root/events_YYYYMMDD``, as exports lay them down.

    Only the folders of the range are looked at, one by one: neither other days nor their files are ever
    listed. A day without a folder is reported, not passed over: an export may be late, and a report
    over the range would be too low.
    """
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    there = [day for day in days if files.exists(hadoop.Path(_shard(root, day)))]
    missing = sorted(set(days) - set(there))
    if not there:
        return Shards(spark.createDataFrame([], RAW_EVENTS), missing)
    return Shards(spark.read.schema(RAW_EVENTS).parquet(*[_shard(root, day) for day in there]), missing)


def write_event_shards(raw: DataFrame, root: str) -> None:
    """One folder for each event date of the rows; a folder that is there already is replaced.

    All days are written first, below a temporary folder, and then moved to their names. Rows without an event
    date have no folder and raise.
    """
    spark, rows = raw.sparkSession, raw.withColumn("_day", F.col("event_date"))
    hadoop, temporary = spark._jvm.org.apache.hadoop.fs, f"{root.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    files = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        # A day is dealt to as many tasks as its size asks for.
        rows.hint("rebalance", "_day").write.partitionBy("_day").parquet(temporary)
        written = {s.getPath().getName().partition("=")[2]: s.getPath() for s in files.listStatus(hadoop.Path(temporary)) if s.isDirectory()}
        days = {datetime.strptime(name, "%Y%m%d").date(): path for name, path in written.items()}
        for day, path in sorted(days.items()):
            files.delete(hadoop.Path(_shard(root, day)), True)
            if not files.rename(path, hadoop.Path(_shard(root, day))):
                raise OSError(f"cannot move {path} to {_shard(root, day)}")
    finally:
        files.delete(hadoop.Path(temporary), True)


def flatten_events(raw: DataFrame) -> DataFrame:
    """Nested events -> the flat columns the session operators work on."""
    params = F.col("event_params")
    return raw.select(
        parse_event_date(F.col("event_date")).alias("event_date"),
        "event_timestamp",
        "event_name",
        "user_pseudo_id",
        event_param(params, "ga_session_id", "int_value").alias("ga_session_id"),
        event_param(params, "source", "string_value").alias("source"),
        event_param(params, "medium", "string_value").alias("medium"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
    )
