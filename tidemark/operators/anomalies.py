"""Anomalies: robust z-scores on daily series and five rules on complete weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.calendar import day_context, iso_week_label, week_context
from tidemark.functions.numbers import (
    array_median,
    computed_once,
    round_even,
    round_even_sql,
    safe_divide,
)
from tidemark.model import Settings
from tidemark.operators.kpis import sums, with_ratios

TOTAL_SUMS = tuple(
    c for c in fv.WEEKLY_SUMS if c not in ("spend", "duplicate_purchase_events")
)
COLUMNS = [
    "channel", "metric", "date_or_week", "granularity", "rule", "value", "baseline", "score",
    "direction", "severity", "seasonal_context", "is_simulated", "week",
]


# --- daily series ------------------------------------------------------------------------


def with_daily_total(daily: DataFrame) -> DataFrame:
    """Daily KPI rows plus one total row per date; ``is_total`` tells them apart."""
    totals = daily.groupBy("date").agg(*sums(TOTAL_SUMS)).fillna(0, subset=list(TOTAL_SUMS))
    totals = with_ratios(totals.withColumn("spend", F.lit(None).cast("double")))
    totals = totals.withColumns({"channel": F.lit(fv.TOTAL), "is_total": F.lit(True)})
    return daily.withColumn("is_total", F.lit(False)).unionByName(
        totals, allowMissingColumns=True
    )


def densify(daily: DataFrame, key: str = "channel") -> DataFrame:
    """Every key on every day between the first and the last date; new rows are NULL.

    One aggregation gives the keys with their first and last dates; the overall dates come from it, and
    each key builds its own days, so there is no join between keys and calendar.
    """
    spans = daily.groupBy(key).agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    whole = spans.agg(F.struct(F.min("_first").alias("first"), F.max("_last").alias("last"))).scalar()
    bounds = spans.select(key).withColumn("_whole", whole)
    days = bounds.select(key, F.explode(F.sequence("_whole.first", "_whole.last")).alias("date"))
    return days.join(daily, [key, "date"], "left")


def _simulated() -> Column:
    """Spend counts as simulated unless all of it is known to be real."""
    return F.coalesce("spend_is_simulated", F.lit(True))


def _metric_entries(metrics: Sequence[str], **extra) -> Column:
    """Array with one struct per metric: name, value, the count it rests on, extras."""
    no_basis = F.lit(None).cast("double")
    entries = []
    for metric in metrics:
        basis = fv.VOLUME_BASIS.get(metric)
        entries.append(
            F.struct(
                F.lit(metric).alias("metric"),
                F.col(metric).cast("double").alias("value"),
                (F.col(basis).cast("double") if basis else no_basis).alias("volume"),
                *[make(metric, basis).alias(name) for name, make in extra.items()],
            )
        )
    return F.array(*entries)


def metric_series(daily: DataFrame, settings: Settings) -> DataFrame:
    """Long series (channel, metric, date, value, volume); series without a value are left out."""
    keep = ["channel", "is_total", "date"]
    long = daily.select(*keep, F.inline(_metric_entries(settings.metrics)))
    series = Window.partitionBy("is_total", "channel", "metric")
    return (
        long.withColumn("_n", F.count("value").over(series)).where("_n > 0").drop("_n")
    )


def trailing_baseline(daily: DataFrame, settings: Settings) -> DataFrame:
    """Long rows with the non-null values of the previous ``baseline_days`` calendar days.

    The frame is a range of day numbers over the rows that exist. Days without a row would
    only add NULLs, which the baseline drops, so no calendar has to be filled in first. All
    metrics share one sort by (channel, date); arrays never exceed ``baseline_days``.
    """
    frame = (
        Window.partitionBy("is_total", "channel")
        .orderBy(F.unix_date("date"))
        .rangeBetween(-settings.baseline_days, -1)
    )
    needed = [*settings.metrics, *fv.VOLUME_BASIS.values()]
    needed = [c for c in dict.fromkeys(needed) if c in daily.columns]
    trailing = daily.select(
        "channel",
        "is_total",
        "date",
        _simulated().alias("spend_is_simulated"),
        *needed,
        *[F.collect_list(F.col(c).cast("double")).over(frame).alias(f"_{c}") for c in needed],
    )
    # Several metrics rest on one count, whose median is found once a day.
    bases = [c for c in dict.fromkeys(fv.VOLUME_BASIS.values()) if c in needed]
    trailing = computed_once(trailing, **{f"_volume_{c}": array_median(F.col(f"_{c}")) for c in bases})
    entries = _metric_entries(
        settings.metrics,
        baseline_values=lambda metric, basis: F.col(f"_{metric}"),
        volume_median=lambda metric, basis: F.col(f"_volume_{basis}") if basis else F.lit(None).cast("double"),
    )
    return trailing.select("channel", "is_total", "date", "spend_is_simulated", F.inline(entries))


def enough_volume(rows: DataFrame, settings: Settings) -> DataFrame:
    """Add whether the median volume lets the day be scored; unknown volume does."""
    enough = F.col("volume_median") >= settings.min_daily_volume
    return rows.withColumn("enough_volume", F.coalesce(enough, F.lit(True)))


def _least_radius(count: Column) -> Column:
    """The radius around ``baseline`` that holds `count` of the sorted values: the count-th smallest deviation.

    The nearest values are neighbours in the sorted array, so it is a minimum over runs of that length, and
    the deviations need not be sorted.
    """
    ordered, median = F.col("_sorted"), F.col("baseline")
    starts = F.sequence(F.lit(0), F.size(ordered) - count)

    def radius(i: Column) -> Column:
        return F.greatest(median - F.get(ordered, i), F.get(ordered, i + count - 1) - median)

    return F.array_min(F.transform(starts, radius))


def robust_z(rows: DataFrame) -> DataFrame:
    """Add baseline (the median) and z, the modified z-score of value.

    The scale is the median deviation, or the mean deviation where that is 0; z is NULL for a
    constant baseline. Values are sorted once.
    """
    rows = computed_once(rows, _sorted=F.sort_array("baseline_values"))
    values, n = F.col("_sorted"), F.size("_sorted")
    low, high = F.get(values, F.floor((n - 1) / 2).cast("int")), F.get(values, F.floor(n / 2).cast("int"))
    rows = rows.withColumn("baseline", F.when(n > 0, (low + high) / 2))
    half = F.floor((n + 1) / 2).cast("int")
    even = (_least_radius(half) + _least_radius(half + 1)) / 2
    rows = computed_once(rows, _mad=F.when(n > 0, F.when(n % 2 == 1, _least_radius(half)).otherwise(even)))
    distance = F.col("value") - F.col("baseline")
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + F.abs(v - F.col("baseline")))
    # Only where the median deviation is 0 are all deviations added up.
    z = F.when(F.col("_mad") > 0, safe_divide(F.lit(fv.MAD_TO_SIGMA) * distance, F.col("_mad"))).when(
        F.col("_mad") == 0, safe_divide(distance, F.lit(fv.MEAN_AD_TO_SIGMA) * safe_divide(total, n))
    )
    return rows.withColumn("z", z).drop("_sorted", "_mad")


def scored_days(daily: DataFrame, settings: Settings) -> DataFrame:
    """Every day that can be scored, with median and z; z is NULL for a constant baseline."""
    rows = trailing_baseline(daily, settings).where(
        F.col("value").isNotNull()
        & (F.size("baseline_values") >= settings.min_baseline_days)
    )
    return robust_z(enough_volume(rows, settings).where("enough_volume"))


def daily_anomalies(daily: DataFrame, settings: Settings) -> DataFrame:
    """Days at or above the threshold, out of a daily KPI table."""
    z, limit = F.col("z"), settings.z_threshold
    found = scored_days(with_daily_total(daily), settings).where(F.abs(z) >= limit)
    day = F.col("date")
    return found.select(
        "channel",
        "metric",
        F.date_format(day, "yyyy-MM-dd").alias("date_or_week"),
        F.lit("day").alias("granularity"),
        F.lit("robust_z").alias("rule"),
        "value",
        "baseline",
        round_even("z", 2).alias("score"),
        F.when(z > 0, "up").otherwise("down").alias("direction"),
        F.when(F.abs(z) >= 2 * limit, "high").otherwise("medium").alias("severity"),
        day_context(day, settings.baseline_days).alias("seasonal_context"),
        (F.col("metric").isin(*fv.SPEND_BASED) & F.col("spend_is_simulated")).alias("is_simulated"),
        iso_week_label(day).alias("week"),
    ).select(*COLUMNS)


# --- weekly rules ------------------------------------------------------------------------


def weekly_rule_anomalies(weekly: DataFrame, settings: Settings) -> DataFrame:
    """All rules in one pass over complete weeks: an array of hits per row, exploded."""

    limit = settings

    def hit(rule, metric, condition, value, baseline, score, direction, high) -> str:
        """SQL of one finding as a struct, NULL when the condition does not hold."""
        return f"""IF({condition}, named_struct(
            'metric', '{metric}', 'rule', '{rule}',
            'value', double({value}), 'baseline', double({baseline}),
            'score', {round_even_sql(score, 4)}, 'direction', {direction},
            'severity', IF({high}, 'high', 'medium'),
            'is_simulated', {'_simulated' if metric in fv.SPEND_BASED else 'false'}), NULL)"""

    shift, gap = "revenue_share_change_pp", "missing_revenue_share"
    hits = [
        hit(
            "paid_spend_no_purchases", "purchases",
            "NOT is_total AND _paid AND spend > 0 AND purchases = 0",
            "0", "prev_purchases", "NULL", "'down'", "true",
        ),
        *[
            hit(
                "cost_increase", cost, f"wow_{cost} > {limit.cost_wow_increase}",
                cost, f"prev_{cost}", f"wow_{cost}", "'up'", f"wow_{cost} > 1",
            )
            for cost in ("cpa", "cost_per_session")
        ],
        hit(
            "conversion_drop", "conversion_rate",
            f"wow_conversion_rate < -{limit.conversion_rate_wow_drop} "
            f"AND abs(wow_sessions) <= {limit.sessions_stable_max_change}",
            "conversion_rate", "prev_conversion_rate", "wow_conversion_rate", "'down'",
            "wow_conversion_rate < -0.5",
        ),
        hit(
            "revenue_share_shift", "revenue_share",
            f"NOT is_total AND abs({shift}) > {limit.revenue_share_change_pp}",
            "revenue_share", "prev_revenue_share", shift, f"IF({shift} > 0, 'up', 'down')",
            f"abs({shift}) > {2 * limit.revenue_share_change_pp}",
        ),
        hit(
            "tracking_gap", gap, f"is_total AND {gap} > {limit.tracking_gap_share}",
            gap, "NULL", gap, "'up'", "true",
        ),
    ]
    findings = F.array_compact(F.array(*[F.expr(h) for h in hits]))
    paid = F.col("channel").isin(*limit.paid_channels) if limit.paid_channels else F.lit(False)
    complete = weekly.where("is_complete").withColumns({"_paid": paid, "_simulated": _simulated()})
    found = complete.select(
        "week", "week_start", "channel", F.inline(findings)
    )
    return found.withColumns(
        {
            "date_or_week": F.col("week"),
            "granularity": F.lit("week"),
            "seasonal_context": week_context(F.col("week_start")),
        }
    ).select(*COLUMNS)


def detect_anomalies(daily: DataFrame, weekly: DataFrame, settings: Settings) -> DataFrame:
    """Daily and weekly findings; daily KPIs in, weekly KPIs with changes in."""
    return daily_anomalies(daily, settings).unionByName(weekly_rule_anomalies(weekly, settings))


def anomalies_of_week(anomalies: DataFrame, week: str) -> DataFrame:
    return anomalies.where(F.col("week") == week)


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("week").agg(F.count(F.lit(1)).alias("anomaly_count"))


def severity_order() -> list[Column]:
    """The most severe findings first, weekly ones before days; ties resolve by content."""
    return [
        F.when(F.col("severity") == "high", 0).otherwise(1),
        F.when(F.col("granularity") == "week", 0).otherwise(1),
        -F.abs(F.coalesce(F.col("score"), F.lit(0.0))),
        *[F.col(c) for c in ("date_or_week", "channel", "metric", "rule")],
    ]


def rank_anomalies(anomalies: DataFrame, limit: int | None) -> DataFrame:
    """The ``limit`` most severe findings of each week (None: all of them), numbered from 1.

    The number is filtered right above the ranking, so Spark keeps at most ``limit`` rows per
    week in each map task before the shuffle (WindowGroupLimit).
    """
    place = F.row_number().over(Window.partitionBy("week").orderBy(*severity_order()))
    ranked = anomalies.withColumn("place", place)
    return ranked if limit is None else ranked.where(F.col("place") <= limit)
