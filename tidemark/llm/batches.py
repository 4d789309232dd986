"""Running numpy code over Arrow batches of a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of one Arrow batch. Texts average some kilobytes, and some are far longer.
BATCH_ROWS = 1000


def map_batches(df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` with batches small enough for texts of any length."""
    limit_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def limit_batches(spark: SparkSession) -> None:
    """Hold the rows (and, where Spark knows the setting, the bytes) of a batch down."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
