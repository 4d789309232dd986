"""First firings of transaction ids over runs that each read a range of days only.

A run keeps, for its days, the first firing of every id within them: a partial minimum. The partial minima of all
ranges give the global one, so de-duplication stays global although a run reads new events only. The
index is a table by range of days (``RangedTable``): running a range again replaces its own part, and ranges can
be run in any order. It holds a row for each id and range, never events.

The ids of a run meet the index in an equi join; where the index is large and the run is not, Spark
filters the index by a Bloom filter of the run's ids before it is shuffled.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import shared
from tidemark.operators.sessions import SESSION, by_transaction, purchase_events
from tidemark.sources.events import in_date_range
from tidemark.sources.ranged import RangedTable

FIRST = ["first_time", *SESSION, "first_revenue", "first_date"]


def _transactions(events: DataFrame, start: date, end: date) -> DataFrame:
    """Rows per (session, transaction id) of the purchases of a range of event dates."""
    purchases = purchase_events(in_date_range(events, "event_date", start, end))
    return by_transaction(purchases, [F.min_by("event_date", "event_timestamp").alias("first_date")])


def _earliest(rows: DataFrame) -> DataFrame:
    """The first firing of every id; equal times resolve by the content of the row."""
    first = rows.groupBy("transaction_id").agg(F.min(F.struct(*FIRST)).alias("_first"))
    return first.select("transaction_id", "_first.*")


def index_firings(index: RangedTable, events: DataFrame, start: date, end: date) -> None:
    """Put the first firings of start..end into the index, in place of what it has for these days."""
    keyed = _transactions(events, start, end).where(F.col("transaction_id").isNotNull())
    index.replace(_earliest(keyed), start, end, ["transaction_id"])


def first_firings(index: RangedTable) -> DataFrame:
    """The first firing of every id over all ranges that have been run."""
    return _earliest(index.read())


def firings_in_range(index: RangedTable, events: DataFrame, start: date, end: date) -> DataFrame:
    """``sessions.purchase_firings`` for the purchases of a range, with duplicates known over all ranges.

    The range must have been put into the index. Of a session that goes on in another range, each range has the
    firings of its own days.
    """
    groups = shared(_transactions(events, start, end))
    ids = groups.where(F.col("transaction_id").isNotNull()).select("transaction_id").distinct()
    firsts = _earliest(index.read().join(ids, "transaction_id", "left_semi")).select(
        F.col("transaction_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in FIRST]
    )
    same = F.col("transaction_id") == F.col("_id")
    for c in ("first_time", *SESSION):
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    has_id, is_first = F.col("transaction_id").isNotNull(), F.col("_id").isNotNull()
    kept = F.when(~has_id, F.col("with_revenue")).otherwise((is_first & F.col("_first_revenue").isNotNull()).cast("bigint"))
    duplicates = F.when(has_id, F.col("firings") - is_first.cast("bigint")).otherwise(F.lit(0))
    return groups.join(firsts, same, "left").select(
        *SESSION,
        "transaction_id",
        "firings",
        duplicates.cast("bigint").alias("duplicates"),
        "missing_revenue",
        kept.alias("kept"),
        F.when(has_id, F.col("_first_revenue")).otherwise(F.col("revenue")).alias("kept_revenue"),
    )
