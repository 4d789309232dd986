"""Cell texts, report tables and chart series."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.builders import REPORT_END, REPORT_START, daily_frame, report_rows, span, spend_frame
from tidemark.functions import formats as fm
from tidemark.model import Settings
from tidemark.operators import facts as fa
from tidemark.operators import report as rp
from tidemark.plans.pipeline import prepare

CFG = Settings(start_date=REPORT_START, end_date=REPORT_END)

DELTAS = [
    (0.123, True, "▲ 12.3%", "good"),
    (-0.05, True, "▼ 5.0%", "bad"),
    (0.4, False, "▲ 40.0%", "bad"),
    (-0.4, False, "▼ 40.0%", "good"),
    (0.1, None, "▲ 10.0%", "neutral"),
    (0.0, True, "0.0%", "neutral"),
    (float("nan"), True, "–", "none"),
    (None, True, "–", "none"),
]


def test_deltas(spark):
    for value, better, text, tone in DELTAS:
        row = spark.createDataFrame([(value,)], "v double").select(fm.fmt_delta(F.col("v"), better).alias("d"))
        assert tuple(row.first()["d"]) == (text, tone)


def test_cells(spark):
    row = spark.createDataFrame([(1234567.891, 0.1234, None)], "a double, b double, c double")
    got = row.select(
        fm.fmt_int(F.col("a")), fm.fmt_money(F.col("a")), fm.fmt_ratio_pct(F.col("b")), fm.fmt_int(F.col("c")),
        fm.channel_label(F.lit("paid_search")), fm.channel_label(F.lit("paid_social")),
    ).first()
    assert tuple(got) == ("1,234,568", "$1,234,567.89", "12.3%", "–", "Paid search", "Paid social")


@pytest.fixture(scope="module")
def run(spark):
    days = span(REPORT_START, REPORT_END)
    return prepare(daily_frame(spark, report_rows()), spend_frame(spark, days, lambda d: 50), CFG)


def test_channel_table(run):
    rows = rp.channel_table(run.weekly).where("week = '2021-W01'").orderBy("position").collect()
    assert [r["channel"] for r in rows] == ["Referral", "Paid search", "Unknown", "All channels"]
    assert (rows[0]["revenue"], rows[0]["prev_revenue"]) == ("$861.00", "$525.00")
    assert (rows[0]["revenue_delta"], rows[0]["revenue_delta_tone"]) == ("▲ 64.0%", "good")
    assert (rows[3]["sessions"], rows[3]["revenue_share"]) == ("1,960", "100.0%")


def test_paid_table_and_tiles(run):
    paid = rp.paid_table(run.weekly, CFG.paid_channels).where("week = '2021-W01'").first()
    assert (paid["spend"], paid["cpa"], paid["roas"]) == ("$350.00", "$25.00", "1.20")
    assert (paid["spend_delta"], paid["spend_delta_tone"]) == ("0.0%", "neutral")
    tiles = {r["label"]: r for r in rp.kpi_tiles(run.weekly).where("week = '2021-W01'").collect()}
    assert (tiles["Revenue"]["value"], tiles["Revenue"]["delta"]) == ("$1,596.00", "▲ 26.7%")
    assert tiles["Conversion rate"]["value"] == "2.1%"


def test_anomaly_table(spark):
    rows = spark.createDataFrame(
        [("2021-W01", 1, "total", "missing_revenue_share", "2021-W01", "tracking_gap", 30.0, None, "%", "up", "high", None, False),
         ("2021-W01", 2, "paid_search", "cpa", "2021-W01", "cost_increase", 12.5, 5.0, None, "down", "medium", "New Year", True),
         ("2021-W01", 3, "direct", "sessions", "2021-01-05", "robust_z", 1500.0, 99.5, None, "up", "medium", None, False)],
        "week string, place int, channel string, metric string, when string, rule string, value double, baseline double, "
        "unit string, direction string, severity string, seasonal_context string, simulated boolean",
    )
    got = [tuple(r)[3:9] for r in rp.anomaly_table(rows).orderBy("place").collect()]
    assert got == [
        ("All channels", "Purchases without revenue", "Tracking gap", "30.0%", "–", "▲"),
        ("Paid search", "CPA", "Cost increase", "$12.50", "$5.00", "▼"),
        ("Direct", "Sessions", "Unusual day", "1,500", "99.50", "▲"),
    ]


def test_series(run):
    funnel = rp.funnel_series(run.weekly).where("week = '2021-W01'").orderBy("step").collect()
    assert [r["sessions"] for r in funnel] == [1960, 1176, 490, 196, 42]
    mix = rp.channel_mix(run.weekly).where("week = '2021-W01' AND bar = 'Sessions'")
    assert mix.agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    changes = {r["label"]: r["change"] for r in rp.kpi_change_series(run.weekly).where("week = '2020-W52'").collect()}
    assert len(changes) == 5 and set(changes.values()) == {None}
    trend = rp.revenue_trend(run.weekly, run.anomalies).orderBy("week_start").collect()
    assert [r["revenue"] for r in trend] == [1260.0, 1260.0, 1596.0]
    assert trend[0]["week_start"] == date(2020, 12, 21)


def test_facts_tables_agree_with_the_document(run):
    flat = fa.totals_facts(run.weekly).where("week = '2021-W01'").first().asDict()
    document = fa.facts_of_week(run.facts(), "2021-W01").first()["totals"].asDict()
    assert {k: v for k, v in flat.items() if k != "week"} == document
