"""The tables and series behind a weekly report, for all weeks at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.formats import (
    channel_label,
    decimals,
    fmt_delta,
    fmt_int,
    fmt_money,
    fmt_number,
    fmt_ratio_pct,
    lookup,
)
from tidemark.operators.facts import totals_facts


def _delta_columns(name: str, change: str, higher_is_better: bool | None = True) -> list[Column]:
    delta = fmt_delta(F.col(change), higher_is_better)
    return [delta["text"].alias(name), delta["tone"].alias(f"{name}_tone")]


def kpi_deltas(weekly: DataFrame) -> DataFrame:
    """Every weekly change as arrow text and tone, one row per (week, channel, metric)."""
    lower_is_better, neutral = ("cost_per_session", "cpa"), ("spend",)
    entries = []
    for metric in fv.CHANGE_COLUMNS:
        better = None if metric in neutral else metric not in lower_is_better
        delta = fmt_delta(F.col(f"wow_{metric}"), better)
        entries.append(
            F.struct(F.lit(metric).alias("metric"), delta["text"].alias("text"), delta["tone"].alias("tone"))
        )
    return weekly.select("week", "channel", F.inline(F.array(*entries)))


def channel_table(weekly: DataFrame) -> DataFrame:
    """KPI rows: channels in the fixed order, unlisted channels next, the total last."""
    known = F.array(*[F.lit(c) for c in fv.CHANNEL_ORDER])
    position = F.array_position(known, F.col("channel")).cast("int") - 1
    order = (
        F.when(F.col("is_total"), len(fv.CHANNEL_ORDER) + 1)
        .when(position >= 0, position)
        .otherwise(len(fv.CHANNEL_ORDER))
    )
    return weekly.select(
        "week",
        order.alias("position"),
        channel_label(F.col("channel")).alias("channel"),
        "is_total",
        fmt_int(F.col("sessions")).alias("sessions"),
        *_delta_columns("sessions_delta", "wow_sessions"),
        fmt_int(F.col("purchases")).alias("purchases"),
        *_delta_columns("purchases_delta", "wow_purchases"),
        fmt_money(F.col("revenue")).alias("revenue"),
        fmt_money(F.col("prev_revenue")).alias("prev_revenue"),
        *_delta_columns("revenue_delta", "wow_revenue"),
        fmt_ratio_pct(F.col("conversion_rate")).alias("conversion_rate"),
        *_delta_columns("conversion_delta", "wow_conversion_rate"),
        fmt_money(F.col("aov")).alias("aov"),
        fmt_ratio_pct(F.col("revenue_share")).alias("revenue_share"),
    )


def paid_table(weekly: DataFrame, paid: Sequence[str]) -> DataFrame:
    """Cost KPIs of the paid channels; for costs lower is better, spend is not judged."""
    rows = weekly.where(F.col("channel").isin(*paid) & ~F.col("is_total"))
    return rows.select(
        "week",
        channel_label(F.col("channel")).alias("channel"),
        fmt_money(F.col("spend")).alias("spend"),
        *_delta_columns("spend_delta", "wow_spend", None),
        fmt_money(F.col("cost_per_session")).alias("cost_per_session"),
        *_delta_columns("cps_delta", "wow_cost_per_session", False),
        fmt_money(F.col("cpa")).alias("cpa"),
        *_delta_columns("cpa_delta", "wow_cpa", False),
        fmt_number(F.col("roas")).alias("roas"),
        *_delta_columns("roas_delta", "wow_roas"),
    )


def _cell(metric: Column, value: Column, unit: Column) -> Column:
    grouped = F.when(value == F.floor(value), fmt_int(value)).otherwise(F.format_number(value, 2))
    return (
        F.when(value.isNull(), fv.DASH)
        .when(unit == "%", F.concat(decimals(value, 1), F.lit("%")))
        .when(metric.isin(*fv.MONEY_METRICS), fmt_money(value))
        .otherwise(grouped)
    )


def anomaly_table(anomaly_facts: DataFrame) -> DataFrame:
    """Display rows of the ranked findings (input: anomaly facts)."""
    metric, unit = F.col("metric"), F.col("unit")
    return anomaly_facts.select(
        "week",
        "place",
        "when",
        channel_label(F.col("channel")).alias("channel"),
        lookup(metric, fv.METRIC_LABELS, metric).alias("metric"),
        lookup(F.col("rule"), fv.RULE_LABELS, F.col("rule")).alias("rule"),
        _cell(metric, F.col("value"), unit).alias("value"),
        _cell(metric, F.col("baseline"), unit).alias("baseline"),
        F.when(F.col("direction") == "up", fv.ARROW_UP).otherwise(fv.ARROW_DOWN).alias("direction"),
        "severity",
        F.coalesce("seasonal_context", F.lit("")).alias("seasonal_context"),
        "simulated",
    )


def kpi_tiles(weekly: DataFrame) -> DataFrame:
    """The four headline tiles of each complete week."""
    rate = F.concat(decimals(F.col("conversion_rate_pct"), 1), F.lit("%"))
    tiles = [
        ("Sessions", fmt_int(F.col("sessions")), "wow_sessions_pct"),
        ("Purchases", fmt_int(F.col("purchases")), "wow_purchases_pct"),
        ("Revenue", fmt_money(F.col("revenue")), "wow_revenue_pct"),
        ("Conversion rate", rate, "wow_conversion_rate_pct"),
    ]
    entries = []
    for label, value, change in tiles:
        delta = fmt_delta(F.col(change) / 100)
        entries.append(
            F.struct(
                F.lit(label).alias("label"),
                value.alias("value"),
                delta["text"].alias("delta"),
                delta["tone"].alias("tone"),
            )
        )
    return totals_facts(weekly).select("week", F.inline(F.array(*entries)))


# --- series ----------------------------------------------------------------------------------


def revenue_trend(weekly: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Total revenue of the complete weeks, flagged when a week has a high-severity finding."""
    high = anomalies.where(F.col("severity") == "high").select("week").distinct()
    total = weekly.where(F.col("is_total") & F.col("is_complete"))
    return total.join(high.withColumn("_high", F.lit(True)), "week", "left").select(
        "week", "week_start", "revenue", F.col("_high").isNotNull().alias("has_high_anomaly")
    )


def channel_mix(weekly: DataFrame) -> DataFrame:
    """Positive revenue and session shares per channel, in long form."""
    bars = F.array(
        F.struct(F.lit("Revenue").alias("bar"), F.col("revenue_share").alias("share")),
        F.struct(F.lit("Sessions").alias("bar"), F.col("session_share").alias("share")),
    )
    rows = weekly.where(~F.col("is_total")).select("week", "channel", F.inline(bars))
    return rows.where(F.col("share") > 0)


def funnel_series(weekly: DataFrame) -> DataFrame:
    """Sessions that reached each of the five funnel steps, all channels."""
    steps = [
        F.struct(F.lit(i).alias("step"), F.lit(label).alias("label"), F.col(c).alias("sessions"))
        for i, (c, label) in enumerate(fv.FUNNEL_STEPS.items())
    ]
    return weekly.where("is_total").select("week", F.inline(F.array(*steps)))


def kpi_change_series(weekly: DataFrame) -> DataFrame:
    """Week-over-week change of the five headline KPIs, all channels."""
    items = [
        F.struct(F.lit(label).alias("label"), F.col(c).alias("change"))
        for c, label in fv.KPI_CHANGES.items()
    ]
    return weekly.where("is_total").select("week", F.inline(F.array(*items)))
