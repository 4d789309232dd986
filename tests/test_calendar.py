"""ISO weeks, holidays and seasonal notes, checked by hand."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(expression.alias("x")).first()["x"]


def days(spark, *wanted):
    return spark.createDataFrame([(d,) for d in wanted], "date date")


def test_labels_cross_the_year_boundary(spark):
    rows = days(spark, date(2021, 1, 1), date(2021, 1, 4), date(2024, 12, 30)).select(
        "date", cal.iso_week_label(F.col("date")).alias("week")
    )
    assert {r["date"].isoformat(): r["week"] for r in rows.collect()} == {
        "2021-01-01": "2020-W53",
        "2021-01-04": "2021-W01",
        "2024-12-30": "2025-W01",
    }


def test_labels_agree_with_the_standard_calendar(spark):
    wanted = [date(1995, 1, 1) + timedelta(days=17 * i) for i in range(800)]
    rows = days(spark, *wanted).select("date", cal.iso_week_label(F.col("date")).alias("week"))
    for row in rows.collect():
        year, week, _ = row["date"].isocalendar()
        assert row["week"] == f"{year}-W{week:02d}"


def test_week_start_and_previous_week(spark):
    assert one(spark, cal.week_start(F.col("w")), w="2020-W53") == date(2020, 12, 28)
    assert one(spark, cal.previous_week(F.col("w")), w="2021-W01") == "2020-W53"


@pytest.mark.parametrize("label", ["2020-53", "2021-W53", "W01", "2020-W00"])
def test_labels_that_name_no_week_raise(spark, label):
    with pytest.raises(Exception, match="Not an ISO week label"):
        one(spark, cal.week_start(F.col("w")), w=label)
    assert one(spark, cal.try_week_start(F.col("w")), w=label) is None


def test_thanksgiving(spark):
    rows = days(spark, date(2020, 5, 1), date(2021, 5, 1), date(2018, 5, 1))
    found = rows.select(cal.thanksgiving(F.year("date")).alias("t")).collect()
    assert [r["t"] for r in found] == [date(2020, 11, 26), date(2021, 11, 25), date(2018, 11, 22)]


NOTES = {
    date(2020, 11, 25): None,
    date(2020, 11, 27): "Thanksgiving to Cyber Monday (Black Friday period)",
    date(2020, 12, 10): "holiday shopping season",
    date(2020, 12, 25): "Christmas",
    date(2021, 1, 1): "New Year",
    date(2020, 12, 31): "New Year",
    date(2021, 1, 15): None,
    # Cyber Monday may fall in December: the first matching note wins.
    date(2019, 12, 2): "Thanksgiving to Cyber Monday (Black Friday period)",
}
FACTORS = {
    date(2020, 11, 25): 1.0,
    date(2020, 11, 26): 1.8,
    date(2020, 11, 30): 1.8,
    date(2020, 12, 1): 1.3,
    date(2020, 12, 18): 1.3,
    date(2020, 12, 19): 1.1,
    date(2020, 12, 26): 0.6,
    date(2020, 12, 27): 1.0,
}


def test_notes_and_factors(spark):
    rows = cal.with_calendar_columns(days(spark, *{**NOTES, **FACTORS})).collect()
    got = {r["date"]: r for r in rows}
    assert {d: got[d]["seasonal_note"] for d in NOTES} == NOTES
    assert {d: got[d]["seasonality_factor"] for d in FACTORS} == FACTORS


def test_context_of_a_day(spark):
    rows = days(spark, date(2020, 11, 27), date(2021, 1, 15), date(2021, 3, 1))
    found = rows.select(cal.day_context(F.col("date"), 28).alias("c")).collect()
    assert [r["c"] for r in found] == [
        "Thanksgiving to Cyber Monday (Black Friday period)",
        "baseline window includes holiday-season days",
        None,
    ]


def test_context_of_a_week_keeps_day_order(spark):
    rows = days(spark, date(2020, 12, 21), date(2020, 12, 28), date(2021, 2, 1))
    found = rows.select(cal.week_context(F.col("date")).alias("c")).collect()
    assert [r["c"] for r in found] == ["holiday shopping season; Christmas", "New Year", None]


def test_calendar_is_dense(spark):
    rows = cal.calendar(days(spark, date(2020, 12, 30), date(2021, 1, 2))).orderBy("date").collect()
    assert [r["date"].day for r in rows] == [30, 31, 1, 2]
    assert {r["week"] for r in rows} == {"2020-W53"}
