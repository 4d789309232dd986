"""ISO weeks, US retail holidays and seasonal notes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv


def monday_of(day: Column) -> Column:
    """Date arithmetic only: no time zone takes part."""
    return F.date_sub(day, F.weekday(day))


def iso_week_label(day: Column) -> Column:
    """2021-01-01 -> 2020-W53"""
    year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def week_start(label: Column) -> Column:
    """Monday of an ISO label; anything that is not a real ISO week raises at run time."""
    return F.when(label.isNull(), F.lit(None).cast("date")).otherwise(
        F.coalesce(
            try_week_start(label),
            F.raise_error(F.concat(F.lit("Not an ISO week label: "), label)).cast("date"),
        )
    )


def try_week_start(label: Column) -> Column:
    """Monday of an ISO label, NULL when the label names no week."""
    pattern = r"^(\d{4})-W(\d{2})$"
    year = F.regexp_extract(label, pattern, 1).try_cast("int")
    week = F.regexp_extract(label, pattern, 2).try_cast("int")
    # 4 January is always in week 1; the round trip refuses W00 and W53 of short years.
    monday = F.date_add(monday_of(F.make_date(year, F.lit(1), F.lit(4))), (week - 1) * 7)
    return F.when(iso_week_label(monday) == label, monday)


def previous_week(label: Column) -> Column:
    return iso_week_label(F.date_sub(week_start(label), 7))


def _on(day: Column, month: int, day_of_month: int) -> Column:
    return F.make_date(F.year(day), F.lit(month), F.lit(day_of_month))


def thanksgiving(year: Column) -> Column:
    """Fourth Thursday of November."""
    return F.date_add(F.next_day(F.make_date(year, F.lit(10), F.lit(31)), "THU"), 21)


def _thanksgiving_weekend(day: Column) -> Column:
    first = thanksgiving(F.year(day))
    return day.between(first, F.date_add(first, 4))


def seasonal_note(day: Column) -> Column:
    return (
        F.when(_thanksgiving_weekend(day), fv.NOTE_THANKSGIVING)
        .when(day.between(_on(day, 12, 25), _on(day, 12, 26)), fv.NOTE_CHRISTMAS)
        .when(day.between(_on(day, 12, 1), _on(day, 12, 24)), fv.NOTE_DECEMBER)
        .when((day == _on(day, 12, 31)) | (day == _on(day, 1, 1)), fv.NOTE_NEW_YEAR)
    )


def seasonality_factor(day: Column) -> Column:
    """Budget multiplier of the US holiday retail season (fixed values)."""
    return (
        F.when(_thanksgiving_weekend(day), 1.8)
        .when(day.between(_on(day, 12, 1), _on(day, 12, 18)), 1.3)
        .when(day.between(_on(day, 12, 19), _on(day, 12, 24)), 1.1)
        .when(day.between(_on(day, 12, 25), _on(day, 12, 26)), 0.6)
        .otherwise(1.0)
    )


def day_context(day: Column, baseline_days: int) -> Column:
    """The day's own note, else a hint when its trailing window holds a noted day."""
    window = F.sequence(F.date_sub(day, baseline_days), F.date_sub(day, 1))
    noted = F.exists(window, lambda d: seasonal_note(d).isNotNull())
    return F.coalesce(seasonal_note(day), F.when(noted, fv.NOTE_BASELINE))


def week_context(monday: Column) -> Column:
    """Distinct notes of the seven days in day order, NULL when there are none."""
    days = F.sequence(monday, F.date_add(monday, 6))
    notes = F.array_distinct(F.array_compact(F.transform(days, seasonal_note)))
    return F.when(F.size(notes) > 0, F.array_join(notes, "; "))


def calendar(df: DataFrame, column: str = "date") -> DataFrame:
    """One row per day from the first to the last date of a table, with calendar columns."""
    bounds = df.agg(F.min(column).cast("date").alias("a"), F.max(column).cast("date").alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("date"))
    return with_calendar_columns(days)


def with_calendar_columns(days: DataFrame) -> DataFrame:
    day = F.col("date")
    return days.withColumns(
        {
            "week": iso_week_label(day),
            "week_start": monday_of(day),
            "thanksgiving": thanksgiving(F.year(day)),
            "seasonal_note": seasonal_note(day),
            "seasonality_factor": seasonality_factor(day),
        }
    )
