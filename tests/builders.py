"""Small daily and spend tables shared by the tests."""

from datetime import date, timedelta

from tidemark.model import DAILY, SPEND

PAID = ("paid_search",)


def span(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def day_row(day, channel, **values):
    """A daily row; counts that are not given are 0."""
    row = dict.fromkeys(DAILY.fieldNames(), 0) | {"date": day, "channel": channel, "revenue": 0.0}
    return tuple((row | values).values())


def daily_frame(spark, rows):
    return spark.createDataFrame(rows, DAILY)


def spend_frame(spark, days, amount):
    """``amount`` is a function of the day."""
    return spark.createDataFrame([(d, "paid_search", float(amount(d)), True) for d in days], SPEND)


# Three complete weeks across the year boundary. In the last one a referral order is worth 41 and not 25.
REPORT_START, REPORT_END = date(2020, 12, 21), date(2021, 1, 10)
VISITS = {"paid_search": 60, "referral": 140, "unknown": 80}
ORDERS = {"paid_search": 2, "referral": 3, "unknown": 1}
ORDER_VALUE = {"paid_search": 30.0, "referral": 25.0, "unknown": 45.0}


def shop_day(day, channel):
    visits, orders = VISITS[channel], ORDERS[channel]
    value = 41.0 if channel == "referral" and day.year == 2021 and day.day > 3 else ORDER_VALUE[channel]
    counts = {"users": visits * 9 // 10, "view_item_sessions": visits * 3 // 5, "add_to_cart_sessions": visits // 4}
    return day_row(
        day, channel, **counts, sessions=visits, begin_checkout_sessions=visits // 10,
        purchase_sessions=orders, purchases=orders, revenue=orders * value,
    )


def report_rows():
    return [shop_day(day, channel) for channel in VISITS for day in span(REPORT_START, REPORT_END)]
