"""Daily, spend, quarantine and facts tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import null_if_nan
from tidemark.model import DAILY
from tidemark.sources.ranged import RangedTable


class StructureError(ValueError):
    """The shape of a table is wrong, so there is nothing to quarantine row by row."""


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise StructureError(f"missing columns: {missing}")
    return df


def without_nan(df: DataFrame) -> DataFrame:
    """Turn NaN in floating columns into NULL once, at the source."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: null_if_nan(F.col(c)) for c in floats}) if floats else df


def _read(spark: SparkSession, path: str, day: str = "date") -> DataFrame:
    """A table written here, or a plain Parquet folder from elsewhere."""
    ranged = RangedTable(spark, path, day)
    return ranged.read() if ranged.exists() else spark.read.parquet(path)


def _write(df: DataFrame, path: str, order: Iterable[str], start: date | None, end: date | None, day: str = "date") -> None:
    """Without bounds the rows become the whole table."""
    RangedTable(df.sparkSession, path, day).replace(df, start or date.min, end or date.max, tuple(order))


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    df = require_columns(_read(spark, path), DAILY.fieldNames())
    return without_nan(df.withColumn("date", F.to_date("date")))


def write_daily(df: DataFrame, path: str, start: date | None = None, end: date | None = None) -> None:
    """Replace the days from start to end (by default all) and leave the others (see ``RangedTable``).

    Files hold spans of dates. Folders per date would leave one tiny file per day; adaptive execution picks the
    number of files by size instead.
    """
    rows = require_columns(df, DAILY.fieldNames()).select(*DAILY.fieldNames())
    _write(rows, path, ["channel"], start, end)


def read_spend(spark: SparkSession, path: str) -> DataFrame:
    df = require_columns(_read(spark, path), ["date", "channel", "spend"])
    return without_nan(df.withColumn("date", F.to_date("date")))


def write_spend(df: DataFrame, path: str, start: date | None = None, end: date | None = None) -> None:
    _write(df, path, ["channel"], start, end)


def write_quarantine(quarantined: DataFrame, name: str, directory: str) -> str:
    """Always overwrite, also with a header-only file, so that stale rows never linger."""
    path = f"{directory.rstrip('/')}/{name}"
    quarantined.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_facts(documents: DataFrame, directory: str) -> None:
    """One folder per week that holds the week's JSON text (week, facts_json). Weeks of an earlier run
    that this one does not have stay as they are."""
    texts = documents.select("week", "facts_json").write.mode("overwrite")
    texts.option("partitionOverwriteMode", "dynamic").partitionBy("week").text(directory)


def read_facts(spark: SparkSession, directory: str, schema: T.StructType) -> DataFrame:
    """The stored documents of all weeks; members that a document lacks are NULL."""
    return spark.read.schema(schema).json(directory).select(*schema.names)


def write_weekly(weekly: DataFrame, path: str, start: date | None = None, end: date | None = None) -> None:
    """Replace the weeks that begin from start to end (by default all), in week and channel order."""
    _write(weekly, path, ["channel"], start, end, day="week_start")


def read_weekly(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "week_start")
