"""Robust z-scores by hand, planted spikes, and the bounds of every weekly rule."""

import random
from datetime import date, timedelta
from statistics import fmean, median

import pytest

from tests.builders import PAID, daily_frame, day_row, span, spend_frame
from tidemark.model import Settings
from tidemark.operators import anomalies as an
from tidemark.operators import kpis

DAYS = span(date(2020, 11, 1), date(2021, 1, 31))
CFG = Settings()


def z_of(spark, value, baseline):
    row = spark.createDataFrame([(value, baseline)], "value double, baseline_values array<double>")
    return an.robust_z(row).first()["z"]


def test_z_by_hand(spark):
    # Median 3, median deviation 1.
    assert z_of(spark, 10.0, [1.0, 2.0, 3.0, 4.0, 5.0]) == pytest.approx(4.7215)
    # Median deviation 0, mean deviation 0.8.
    assert z_of(spark, 9.0, [5.0, 5.0, 5.0, 5.0, 9.0]) == pytest.approx(3.98942, abs=1e-4)
    assert z_of(spark, 9.0, [5.0] * 20) is None


def level(day, channel):
    """A calm day: a little more on every third day, the same mix of steps for all channels."""
    scale = {"paid_search": 40, "direct": 70}[channel] + day.toordinal() % 3
    return {
        "sessions": 3 * scale, "users": 2 * scale, "view_item_sessions": scale, "add_to_cart_sessions": scale // 2,
        "begin_checkout_sessions": scale // 4, "purchase_sessions": scale // 5, "purchases": scale // 5,
        "revenue": 12.5 * scale,
    }


def calm(spark, *changes):
    """Calm series of two channels; a change is (channel, days, values that replace the calm ones)."""
    table = {(channel, day): level(day, channel) for channel in ("paid_search", "direct") for day in DAYS}
    for channel, days, values in changes:
        for day in days:
            table[channel, day].update(values)
    return daily_frame(spark, [day_row(day, channel, **values) for (channel, day), values in table.items()])


def even_spend(spark, doubled=()):
    return spend_frame(spark, DAYS, lambda d: (20 + d.day % 4) * (2 if d in doubled else 1))


def findings_of(spark, daily, spend):
    weekly = kpis.with_changes(kpis.weekly_metrics(daily, spend, PAID))
    return an.detect_anomalies(kpis.daily_metrics(daily, spend, PAID), weekly, CFG).collect()


def test_calm_series_has_no_findings(spark):
    assert findings_of(spark, calm(spark), even_spend(spark)) == []


def test_planted_week_is_found(spark):
    week = span(date(2021, 1, 11), date(2021, 1, 17))
    found = findings_of(spark, calm(spark), even_spend(spark, week))
    days = {a["date_or_week"] for a in found if a["metric"] == "spend"}
    assert days == {d.isoformat() for d in week}
    assert all(a["direction"] == "up" and a["is_simulated"] for a in found if a["metric"] == "spend")
    assert all(a["week"] == "2021-W02" for a in found if a["metric"] == "spend")
    rules = {(a["rule"], a["metric"]) for a in found if a["date_or_week"] == "2021-W02"}
    assert {("cost_increase", "cpa"), ("cost_increase", "cost_per_session")} <= rules


def test_spike_carries_its_season_and_reaches_the_total(spark):
    friday = date(2020, 11, 27)
    found = findings_of(spark, calm(spark, ("direct", [friday], {"revenue": 9000.0, "purchases": 90})), even_spend(spark))
    hits = [a for a in found if a["date_or_week"] == friday.isoformat()]
    assert {("direct", "revenue"), ("total", "revenue")} <= {(a["channel"], a["metric"]) for a in hits}
    assert all("Black Friday" in a["seasonal_context"] for a in hits)


def test_short_baselines_are_skipped(spark):
    day = DAYS[9]
    daily = kpis.daily_metrics(calm(spark, ("direct", [day], {"sessions": 4000})), even_spend(spark), PAID)
    found = an.daily_anomalies(daily, CFG)
    assert found.where(found.date_or_week == day.isoformat()).count() == 0


def test_low_volume_is_skipped_unless_the_gate_is_open(spark):
    few = [("direct", DAYS[k::3], {"purchases": k}) for k in range(3)]
    daily = calm(spark, *few, ("direct", [date(2020, 12, 15)], {"purchases": 8}))
    daily = kpis.daily_metrics(daily, even_spend(spark), PAID)

    def found(cfg):
        hits = an.daily_anomalies(daily, cfg)
        return hits.where("metric = 'purchases' AND channel = 'direct'").count()

    assert found(CFG) == 0
    assert found(Settings(min_daily_volume=0)) == 1


def test_sparse_series_agree_with_brute_force_over_the_dense_calendar(spark):
    rnd = random.Random(5)
    rows = [
        day_row(day, c, sessions=rnd.randint(0, 9), purchases=rnd.randint(0, 3), revenue=rnd.randint(0, 50) / 4)
        for day in DAYS for c in ("direct", "referral", "other")
        if rnd.random() < 0.7
    ]
    cfg = Settings(metrics=("sessions", "revenue"), min_daily_volume=1, min_baseline_days=8, baseline_days=20)
    daily = kpis.daily_metrics(daily_frame(spark, rows), even_spend(spark), PAID)
    got = {
        (r["channel"], r["metric"], r["date"]): (r["baseline"], r["z"])
        for r in an.scored_days(an.with_daily_total(daily), cfg).collect()
    }
    values = {}
    for row in rows:
        record = dict(zip(daily.columns, row, strict=False))
        for channel in (record["channel"], "total"):
            for metric in ("sessions", "purchases", "revenue"):
                key = channel, metric, record["date"]
                values[key] = values.get(key, 0) + record[metric]
    expected = {}
    basis = {"sessions": "sessions", "revenue": "purchases"}
    for (channel, metric, day), value in values.items():
        if metric not in basis:
            continue
        back = [day - timedelta(days=i) for i in range(1, 21)]
        base = [values[channel, metric, d] for d in back if (channel, metric, d) in values]
        volume = [values[channel, basis[metric], d] for d in back if (channel, basis[metric], d) in values]
        if len(base) < 8 or median(volume) < 1:
            continue
        mid = median(base)
        gaps = [abs(b - mid) for b in base]
        z = None
        if median(gaps) > 0:
            z = 0.6745 * (value - mid) / median(gaps)
        elif fmean(gaps) > 0:
            z = (value - mid) / (1.253314 * fmean(gaps))
        expected[channel, metric, day] = (mid, z)
    assert got.keys() == expected.keys() and len(got) > 300
    for key, (mid, z) in expected.items():
        assert got[key] == (pytest.approx(mid), None if z is None else pytest.approx(z))


def test_densify_fills_the_calendar(spark):
    rows = [day_row(DAYS[0], "a", sessions=1), day_row(DAYS[4], "b", sessions=2)]
    dense = an.densify(daily_frame(spark, rows))
    assert dense.count() == 10
    assert dense.where("sessions IS NOT NULL").count() == 2


# --- weekly rules ----------------------------------------------------------------------------

# One complete week in which no rule fires; every change is zero.
LEVELS = {"purchases": 20, "cpa": 12.0, "cost_per_session": 0.3, "conversion_rate": 0.025, "revenue_share": 0.4}
NORMAL = {"week": "2021-W03", "week_start": date(2021, 1, 18), "channel": "paid_search", "is_total": False, "is_complete": True}
NORMAL |= {"spend": 240.0, "spend_is_simulated": None, "wow_sessions": 0.0, "revenue_share_change_pp": 0.0, "missing_revenue_share": 0.0}
NORMAL |= LEVELS | {f"prev_{k}": v for k, v in LEVELS.items()}
NORMAL |= {f"wow_{k}": 0.0 for k in ("cpa", "cost_per_session", "conversion_rate")}
TOTAL = {"channel": "total", "is_total": True, "spend": None}
COST, DROP, SHIFT, GAP = "cost_increase", "conversion_drop", "revenue_share_shift", "tracking_gap"
RULES = [
    ({}, []),
    ({"purchases": 0}, [("paid_spend_no_purchases", "purchases", "high", "down")]),
    ({"purchases": 0, "spend": 0.0}, []),
    ({"purchases": 0, "channel": "direct", "spend": None}, []),
    ({"wow_cpa": 0.39}, []),
    ({"wow_cpa": 0.4}, []),
    ({"wow_cpa": 0.5}, [(COST, "cpa", "medium", "up")]),
    ({"wow_cpa": 1.5}, [(COST, "cpa", "high", "up")]),
    ({"wow_cost_per_session": 0.45}, [(COST, "cost_per_session", "medium", "up")]),
    ({"wow_conversion_rate": -0.4, "wow_sessions": 0.05}, [(DROP, "conversion_rate", "medium", "down")]),
    ({"wow_conversion_rate": -0.6, "wow_sessions": -0.1}, [(DROP, "conversion_rate", "high", "down")]),
    ({"wow_conversion_rate": -0.4, "wow_sessions": 0.25}, []),
    ({"wow_conversion_rate": -0.4, "wow_sessions": None}, []),
    ({"wow_conversion_rate": -0.2}, []),
    ({**TOTAL, "wow_conversion_rate": -0.4}, [(DROP, "conversion_rate", "medium", "down")]),
    ({"revenue_share_change_pp": 15.0}, []),
    ({"revenue_share_change_pp": 16.0}, [(SHIFT, "revenue_share", "medium", "up")]),
    ({"revenue_share_change_pp": -31.0}, [(SHIFT, "revenue_share", "high", "down")]),
    ({**TOTAL, "revenue_share_change_pp": 40.0}, []),
    ({**TOTAL, "missing_revenue_share": 0.3}, [(GAP, "missing_revenue_share", "high", "up")]),
    ({**TOTAL, "missing_revenue_share": 0.2}, []),
    ({"missing_revenue_share": 0.9}, []),
    ({"is_complete": False, "purchases": 0, "wow_cpa": 3.0}, []),
]


def weekly_row(spark, **changed):
    kinds = {"week": "string", "week_start": "date", "channel": "string", "is_total": "boolean",
             "is_complete": "boolean", "spend_is_simulated": "boolean", "purchases": "long", "prev_purchases": "long"}
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in NORMAL)
    return spark.createDataFrame([tuple((NORMAL | changed).values())], schema)


def test_bounds_of_every_rule(spark):
    for changed, expected in RULES:
        found = an.weekly_rule_anomalies(weekly_row(spark, **changed), CFG).collect()
        got = [(a["rule"], a["metric"], a["severity"], a["direction"]) for a in found]
        assert got == expected, changed


def test_fields_of_a_weekly_finding(spark):
    row = weekly_row(spark, wow_cpa=0.123456789 + 0.5, week="2020-W53", week_start=date(2020, 12, 28))
    a = an.weekly_rule_anomalies(row, CFG).first()
    assert (a["granularity"], a["date_or_week"], a["week"]) == ("week", "2020-W53", "2020-W53")
    assert (a["value"], a["baseline"], a["score"]) == (12.0, 12.0, 0.6235)
    assert (a["seasonal_context"], a["is_simulated"]) == ("New Year", True)


def test_real_spend_is_not_called_simulated(spark):
    for known, expected in ((None, True), (True, True), (False, False)):
        row = weekly_row(spark, wow_cpa=2.0, purchases=0, spend_is_simulated=known)
        found = {a["metric"]: a["is_simulated"] for a in an.weekly_rule_anomalies(row, CFG).collect()}
        assert found == {"cpa": expected, "purchases": False}


def test_quoted_labels_are_labels(spark):
    cfg = Settings(paid_channels=("women's wear", "a\\b"))
    row = weekly_row(spark, channel="women's wear", purchases=0)
    (found,) = an.weekly_rule_anomalies(row, cfg).collect()
    assert found["rule"] == "paid_spend_no_purchases"
    assert an.weekly_rule_anomalies(row, Settings(paid_channels=())).count() == 0


def finding(spark, *rows):
    schema = (
        "channel string, metric string, date_or_week string, granularity string, rule string, "
        "value double, baseline double, score double, direction string, severity string, "
        "seasonal_context string, is_simulated boolean, week string"
    )
    base = {
        "channel": "direct", "metric": "revenue", "date_or_week": "2021-01-05",
        "granularity": "day", "rule": "robust_z", "value": 100.0, "baseline": 50.0, "score": 4.0,
        "direction": "up", "severity": "medium", "seasonal_context": None,
        "is_simulated": False, "week": "2021-W01",
    }
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], schema)


def test_ranking_and_limit(spark):
    rows = [{"score": float(s)} for s in range(4, 20)]
    rows.append({"granularity": "week", "rule": GAP, "score": 0.3, "severity": "high"})
    rows.append({"week": "2020-W53", "score": 99.0})
    top = an.rank_anomalies(finding(spark, *rows), 8).where("week = '2021-W01'").orderBy("place").collect()
    assert [a["score"] for a in top] == [0.3, 19.0, 18.0, 17.0, 16.0, 15.0, 14.0, 13.0]
    counts = {r["week"]: r["anomaly_count"] for r in an.anomaly_counts(finding(spark, *rows)).collect()}
    assert counts == {"2021-W01": 17, "2020-W53": 1}
    assert an.anomalies_of_week(finding(spark, *rows), "2020-W53").count() == 1
    assert an.rank_anomalies(finding(spark, *rows), None).count() == 18
