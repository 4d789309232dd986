"""Sessions, first-touch attribution, purchase de-duplication and the daily rollup.

Shuffle plan of ``daily_rollup``: the events are read once and go to (user, session, transaction id)
behind a partial hash aggregation; a NULL id stands for everything but purchases with a usable id. Both
the sessions and the first firings of ids are made from those rows, whose shuffle they
share. A placeholder id shared by a third of all rows is one row per map task on its way to its
minimum. The two meet as rows of one grouping by (user, session). Users are counted after that, from a
row for each (user, day, channel) of a task; shuffling by the user alone would spare that step, and would put a
user with a third of all sessions into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.channels import channel_code, channel_name, channel_of
from tidemark.functions.numbers import money_sum, shared

SESSION = ["user_pseudo_id", "ga_session_id"]

# Epoch microseconds are below this until the year 2255; a timestamp times the number of codes,
# plus a code, must be a bigint.
_LAST_MICROSECOND = 9 * 10**15
_CODES = len(fv.CHANNELS)
if _LAST_MICROSECOND * _CODES >= 2**63:
    raise ValueError(f"{_CODES} channels leave no room for a timestamp beside the channel")


def _has_touch() -> Column:
    return F.col("source").isNotNull() | F.col("medium").isNotNull()


def _event_channel() -> Column:
    return channel_of(F.col("source"), F.col("medium"))


def _usable_id() -> Column:
    usable = F.col("transaction_id") != fv.UNUSABLE_TRANSACTION_ID
    return F.coalesce(usable, F.lit(False))


def _session_measures() -> list[Column]:
    """Date, first touch and funnel flags of a group of events.

    The first touch is the smallest ``timestamp * channels + channel code`` over events that carry
    a source or a medium. That is one bigint instead of two strings and an ordering struct:
    the whole aggregation stays a hash aggregate, the shuffle stays narrow, and equal
    timestamps resolve the same way in every run.
    """
    name = F.col("event_name")
    touch = F.col("event_timestamp") * _CODES + channel_code(_event_channel())
    return [
        F.min_by("event_date", "event_timestamp").alias("session_date"),
        F.min(F.when(_has_touch(), touch)).alias("_touch"),
        *[F.bool_or(name == event).alias(f"has_{event}") for event in fv.FUNNEL_EVENTS],
    ]


def _with_channel(sessions: DataFrame) -> DataFrame:
    channel = F.coalesce(channel_name(F.col("_touch") % _CODES), F.lit(fv.UNKNOWN))
    return sessions.withColumn("channel", channel).drop("_touch")


def sessionize(events: DataFrame) -> DataFrame:
    """Sessions with first-day date, channel and four funnel flags."""
    flags = [f"has_{event}" for event in fv.FUNNEL_EVENTS]
    sessions = _with_channel(events.groupBy(*SESSION).agg(*_session_measures()))
    return sessions.select(*SESSION, "session_date", "channel", *flags)


def first_touch(events: DataFrame) -> DataFrame:
    """The (source, medium) pair of each session's first event that has either of them.

    The pair is taken together, so its source may be NULL. Equal timestamps resolve by
    channel first, which agrees with ``sessionize``. The events are reduced to the earliest time of
    each pair by a hash aggregate; only those few rows are compared as structs.
    """
    pairs = events.groupBy(*SESSION, "source", "medium").agg(F.min("event_timestamp").alias("_first"))
    order = F.struct("_first", channel_code(_event_channel()), "source", "medium")
    pair = F.min_by(F.struct("source", "medium"), F.when(_has_touch(), order))
    touched = pairs.groupBy(*SESSION).agg(pair.alias("_pair"))
    out = touched.select(*SESSION, "_pair.source", "_pair.medium")
    return out.withColumn("channel", _event_channel())


def purchase_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_name") == "purchase")


def by_transaction(events: DataFrame, measures: list[Column] | None = None) -> DataFrame:
    """One row per (session, usable transaction id), and one with a NULL id for the rest of a session.

    All buffers have a fixed width, so this is a hash aggregate that combines before the shuffle.
    Firings of an id in one session at the same microsecond resolve by a hash of their revenue.
    """
    is_purchase, revenue, time = F.col("event_name") == "purchase", F.col("purchase_revenue"), F.col("event_timestamp")
    apart = F.lit(str(2**64)).cast("decimal(20,0)")  # further than two hashes can be
    order = time.cast("decimal(18,0)") * apart + F.xxhash64(revenue).cast("decimal(20,0)")
    used = F.when(is_purchase & _usable_id(), F.col("transaction_id"))
    grouped = events.withColumn("transaction_id", used).groupBy(*SESSION, "transaction_id")
    return grouped.agg(
        *(measures or []),
        F.min("event_timestamp").alias("first_time"),
        F.min_by(revenue, order).alias("first_revenue"),
        F.count_if(is_purchase).alias("firings"),
        F.count_if(is_purchase & revenue.isNull()).alias("missing_revenue"),
        F.count(F.when(is_purchase, revenue)).alias("with_revenue"),
        money_sum(F.when(is_purchase, revenue)).alias("revenue"),
    )


def first_firings(transactions: DataFrame) -> DataFrame:
    """The session, time and revenue of the earliest firing of every usable id, over all sessions.

    This is rank 1 of a ranking by time within the id, found by a minimum: a minimum
    combines before the shuffle, a ranking would sort all copies of a hot id in one task.
    Equal timestamps resolve by the content of the row.
    """
    order = F.struct("first_time", *SESSION, "first_revenue")
    keyed = transactions.where(F.col("transaction_id").isNotNull())
    first = keyed.groupBy("transaction_id").agg(F.min(order).alias("_first"))
    return first.select("transaction_id", "_first.*")


def purchase_firings(events: DataFrame) -> DataFrame:
    """Purchase events per (session, transaction id): firings, duplicates and what is kept.

    Events without a usable id share one row per session, and all of them count.
    """
    groups = shared(by_transaction(purchase_events(events)))
    firsts = first_firings(groups).select(
        F.col("transaction_id").alias("_id"),
        *[F.col(c).alias(f"_{c}") for c in SESSION],
        F.col("first_revenue").alias("_first_revenue"),
    )
    # The join key is unique on both sides, whatever the number of firings of an id.
    same = (F.col("transaction_id") == F.col("_id")) & F.col(SESSION[0]).eqNullSafe(
        F.col(f"_{SESSION[0]}")
    )
    same &= F.col(SESSION[1]).eqNullSafe(F.col(f"_{SESSION[1]}"))
    has_id, is_first = F.col("transaction_id").isNotNull(), F.col("_id").isNotNull()
    kept = F.when(~has_id, F.col("with_revenue")).otherwise(
        (is_first & F.col("_first_revenue").isNotNull()).cast("bigint")
    )
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


def session_totals(transactions: DataFrame, measures: list[Column] | None = None) -> DataFrame:
    """Per session the given measures and what its rows of ``by_transaction`` add up to."""
    keyed = F.col("transaction_id").isNotNull()
    return transactions.groupBy(*SESSION).agg(
        *(measures or []),
        F.sum("missing_revenue").alias("missing_revenue"),
        F.coalesce(F.sum(F.when(keyed, F.col("firings"))), F.lit(0)).alias("keyed_firings"),
        F.coalesce(F.sum(F.when(~keyed, F.col("with_revenue"))), F.lit(0)).alias("open_purchases"),
        money_sum(F.when(~keyed, F.col("revenue"))).alias("open_revenue"),
    )


def _with_purchases(transactions: DataFrame, measures: list[Column] | None = None) -> DataFrame:
    """``session_totals`` with purchases, revenue, purchases_missing_revenue and duplicate_purchase_events.

    A first firing is one more row of its session, so one grouping by session does for both and nothing is
    joined. Rows of one kind have NULL where the other kind has its measures.
    """
    revenue = F.col("first_revenue")
    firsts = first_firings(transactions).select(*SESSION, F.lit(1).cast("bigint").alias("_first"), revenue.alias("_first_revenue"))
    both = transactions.unionByName(firsts, allowMissingColumns=True)
    first_measures = [
        F.count("_first").alias("_firsts"),
        F.count("_first_revenue").alias("_first_purchases"),
        money_sum(F.col("_first_revenue")).alias("_first_revenue"),
    ]
    totals = session_totals(both, [*(measures or []), *first_measures])

    def or_zero(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    # NULL + NULL stays NULL: a session without any kept revenue has no revenue.
    kept = F.when(
        F.col("open_revenue").isNotNull() | F.col("_first_revenue").isNotNull(),
        or_zero("open_revenue") + or_zero("_first_revenue"),
    )
    purchase = {
        "purchases": F.col("open_purchases") + F.col("_first_purchases"),
        "revenue": kept,
        "purchases_missing_revenue": F.col("missing_revenue"),
        "duplicate_purchase_events": F.col("keyed_firings") - F.col("_firsts"),
    }
    return totals.withColumns(purchase)


PURCHASE_MEASURES = [
    "purchases",
    "revenue",
    "purchases_missing_revenue",
    "duplicate_purchase_events",
]


def purchases_by_session(events: DataFrame) -> DataFrame:
    """Kept purchases, their revenue and the two data-quality counts of each session."""
    transactions = shared(by_transaction(purchase_events(events)))
    return _with_purchases(transactions).select(*SESSION, *PURCHASE_MEASURES)


def daily_rollup(events: DataFrame) -> DataFrame:
    """Daily channel table: every session measure on the session's first day and channel."""
    transactions = shared(by_transaction(events, _session_measures()))
    measures = [
        F.min_by("session_date", "first_time").alias("session_date"),
        F.min("_touch").alias("_touch"),
        *[F.bool_or(f"has_{event}").alias(f"has_{event}") for event in fv.FUNNEL_EVENTS],
    ]
    sessions = _with_channel(_with_purchases(transactions, measures))
    # A session without a full key has no purchases of its own.
    known = F.col(SESSION[0]).isNotNull() & F.col(SESSION[1]).isNotNull()

    def total(column: str) -> Column:
        add, zero = (money_sum, 0.0) if column == "revenue" else (F.sum, 0)
        return F.coalesce(add(F.when(known, F.col(column))), F.lit(zero)).alias(column)

    funnel = [F.count_if(f"has_{event}").alias(f"{event}_sessions") for event in fv.FUNNEL_EVENTS]
    return sessions.groupBy(F.col("session_date").alias("date"), "channel").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_distinct(SESSION[0]).alias("users"),
        *funnel,
        *[total(measure) for measure in PURCHASE_MEASURES],
    )
