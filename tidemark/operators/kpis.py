"""Daily and ISO-weekly KPIs, shares and week-over-week changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.calendar import iso_week_label, monday_of
from tidemark.functions.numbers import money_sum, ratio_sql

DAYS_IN_WEEK = 7
AMOUNTS = ("revenue", "spend")
# What the two shares are shares of.
TOTALS = ("sessions", "revenue")


def sums(columns: Sequence[str]) -> list[Column]:
    """Sums under the columns' own names; amounts are added exactly."""
    return [(money_sum(F.col(c)) if c in AMOUNTS else F.sum(c)).alias(c) for c in columns]


def with_ratios(df: DataFrame) -> DataFrame:
    """Add the KPI and funnel ratios; a zero or missing denominator gives NULL."""
    missing = "purchases_missing_revenue"
    parts = {
        "conversion_rate": ("purchase_sessions", "sessions"),
        "aov": ("revenue", "purchases"),
        "cost_per_session": ("spend", "sessions"),
        "cpa": ("spend", "purchases"),
        "roas": ("revenue", "spend"),
        "add_to_cart_rate": ("add_to_cart_sessions", "view_item_sessions"),
        "checkout_rate": ("begin_checkout_sessions", "add_to_cart_sessions"),
        "purchase_rate": ("purchase_sessions", "begin_checkout_sessions"),
        "missing_revenue_share": (missing, f"(purchases + {missing})"),
    }
    return df.withColumns({name: F.expr(ratio_sql(*pair)) for name, pair in parts.items()})


def join_spend(daily: DataFrame, spend: DataFrame, paid: Sequence[str]) -> DataFrame:
    """Add spend, is_paid and spend_is_simulated: a paid channel without a row spent 0, others have
    no spend. Whether spend is simulated is unknown (NULL) where no row says so."""
    is_paid = F.col("channel").isin(*paid)
    known = "is_simulated" in spend.columns
    simulated = F.col("is_simulated") if known else F.lit(None).cast("boolean")
    costs = spend.select("date", "channel", "spend", simulated.alias("spend_is_simulated"))
    return daily.join(costs, ["date", "channel"], "left").withColumns(
        {
            "spend": F.when(is_paid, F.coalesce(F.col("spend"), F.lit(0.0))),
            "is_paid": F.coalesce(is_paid, F.lit(False)),
        }
    )


def daily_metrics(daily: DataFrame, spend: DataFrame, paid: Sequence[str]) -> DataFrame:
    return with_ratios(join_spend(daily, spend, paid))


def weekly_sums(daily: DataFrame, paid: Sequence[str]) -> DataFrame:
    """Sums per (week, channel) and per week, out of a daily table with spend.

    One aggregation over both grouping sets, combined before the shuffle. ``is_total`` comes from
    the grouping set, so a channel that is called "total" stays apart from the total row.
    """
    is_total = F.col("_level") == 1
    keyed = daily.withColumn("week_start", monday_of(F.col("date")))
    both = keyed.groupingSets([["week_start", "channel"], ["week_start"]], "week_start", "channel")
    # The days are a bit set of weekdays. Bit sets combine by OR, which needs no distinct count.
    weekday = F.call_function("shiftleft", F.lit(1), F.weekday("date"))
    more = [
        F.bit_count(F.bit_or(weekday)).cast("bigint").alias("days"),
        F.bool_or("spend_is_simulated").alias("spend_is_simulated"),
    ]
    return both.agg(F.grouping("channel").alias("_level"), *sums(fv.WEEKLY_SUMS), *more).select(
        "week_start",
        F.when(is_total, fv.TOTAL).otherwise(F.col("channel")).alias("channel"),
        is_total.alias("is_total"),
        F.coalesce(F.col("channel").isin(*paid) & ~is_total, F.lit(False)).alias("is_paid"),
        *fv.WEEKLY_SUMS,
        "days",
        "spend_is_simulated",
    )


def weekly_metrics(daily: DataFrame, spend: DataFrame, paid: Sequence[str]) -> DataFrame:
    """Weekly KPIs per channel and for each week's total, without the changes.

    The week's total row carries its days, sessions and revenue and hands them to its channels by a
    window over the summed rows, one for each channel of a week: the daily table is read once.
    """
    rows = weekly_sums(join_spend(daily, spend, paid), paid)
    of_total = F.when(F.col("is_total"), F.struct("days", *TOTALS))
    total = F.first(of_total, ignorenulls=True).over(Window.partitionBy("week_start"))
    with_total = rows.withColumn("_total", total).withColumns(
        {"days": F.col("_total.days"), **{f"_{c}": F.col(f"_total.{c}") for c in TOTALS}}
    )
    rated = with_ratios(with_total.drop("_total"))
    is_total = F.col("is_total")
    return rated.withColumns(
        {
            **{c: F.when(F.col("is_paid"), F.col(c)) for c in fv.COST_RATIOS},
            "spend": F.when(~is_total, F.col("spend")),
            "week": iso_week_label(F.col("week_start")),
            "is_complete": F.col("days") == DAYS_IN_WEEK,
            **{
                share: F.when(is_total, 1.0).otherwise(F.expr(ratio_sql(c, f"_{c}")))
                for share, c in zip(fv.SHARES, TOTALS, strict=True)
            },
        }
    ).select(
        "week", "week_start", "channel", "is_total", "is_paid", "days", "is_complete",
        *fv.WEEKLY_SUMS, *fv.RATIOS, *fv.SHARES, "spend_is_simulated",
    )


def with_changes(weekly: DataFrame) -> DataFrame:
    """Add prev_* and wow_* columns and the share changes in percentage points.

    The previous row is the same channel exactly seven days earlier, by a range frame on the
    day number: gaps give NULL, where a lag would reach across them. Both weeks must be
    complete. A window holds the weeks of one channel, so its size is set by the calendar.
    """
    columns = [*fv.CHANGE_COLUMNS, *fv.SHARES]
    week_before = (
        Window.partitionBy("is_total", "channel")
        .orderBy(F.unix_date("week_start"))
        .rangeBetween(-DAYS_IN_WEEK, -DAYS_IN_WEEK)
    )
    complete = F.col("is_complete")
    before = F.first(F.when(complete, F.struct(*columns))).over(week_before)
    paired = weekly.withColumn("_prev", F.when(complete, before))
    changes = [
        *[f"{ratio_sql(f'{c} - _prev.{c}', f'_prev.{c}')} AS wow_{c}" for c in fv.CHANGE_COLUMNS],
        *[f"({c} - _prev.{c}) * 100 AS {c}_change_pp" for c in fv.SHARES],
    ]
    previous = [f"_prev.{c} AS prev_{c}" for c in columns]
    return paired.selectExpr(*weekly.columns, *previous, *changes)


def complete_weeks(weekly: DataFrame) -> DataFrame:
    """Weeks that can be reported: one row per complete week."""
    return weekly.where(F.col("is_total") & F.col("is_complete")).select("week", "week_start")
