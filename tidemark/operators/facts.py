"""Rounded facts per complete week: the numbers that a report may state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as fv
from tidemark.functions.calendar import previous_week
from tidemark.functions.jsontext import array_sql, struct_sql
from tidemark.functions.numbers import percent, round_even, whole
from tidemark.model import Settings
from tidemark.operators.anomalies import severity_order


def fact_value(metric: str, value: str) -> Column:
    """Percent metrics as percentages with one decimal, everything else with two."""
    as_percent = F.col(metric).isin(*fv.PERCENT_METRICS)
    return F.when(as_percent, percent(value)).otherwise(round_even(value, 2))


def _reported(weekly: DataFrame, totals: bool) -> DataFrame:
    of_kind = F.col("is_total") if totals else ~F.col("is_total")
    return weekly.where(F.col("is_complete") & of_kind)


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _headline() -> dict[str, Column]:
    return {
        "sessions": whole("sessions"),
        "purchases": whole("purchases"),
        "revenue": round_even("revenue", 2),
        "conversion_rate_pct": percent("conversion_rate"),
        "aov": round_even("aov", 2),
    }


def _changes() -> dict[str, Column]:
    kpis = ("sessions", "purchases", "revenue", "conversion_rate")
    return {f"wow_{kpi}_pct": percent(f"wow_{kpi}") for kpi in kpis}


def totals_facts(weekly: DataFrame) -> DataFrame:
    return _reported(weekly, totals=True).select("week", *_named({**_headline(), **_changes()}))


def _funnel() -> dict[str, Column]:
    return {
        "view_item_to_add_to_cart": percent("add_to_cart_rate"),
        "add_to_cart_to_checkout": percent("checkout_rate"),
        "checkout_to_purchase": percent("purchase_rate"),
    }


def funnel_facts(weekly: DataFrame) -> DataFrame:
    return _reported(weekly, totals=True).select("week", *_named(_funnel()))


def _spend_struct() -> Column:
    figures = {
        "spend": round_even("spend", 2),
        "cost_per_session": round_even("cost_per_session", 2),
        "cpa": round_even("cpa", 2),
        "roas": round_even("roas", 2),
        "wow_spend_pct": percent("wow_spend"),
        "wow_cpa_pct": percent("wow_cpa"),
        "wow_cost_per_session_pct": percent("wow_cost_per_session"),
    }
    return F.when(F.col("is_paid"), F.struct(*_named(figures)))


def _channel_columns() -> dict[str, Column]:
    return {
        "channel": F.col("channel"),
        "is_paid": F.col("is_paid"),
        **_headline(),
        "session_share_pct": percent("session_share"),
        "revenue_share_pct": percent("revenue_share"),
        **_changes(),
        "revenue_share_change_pp": round_even("revenue_share_change_pp", 1),
        "simulated_spend": _spend_struct(),
    }


def channel_facts(weekly: DataFrame) -> DataFrame:
    """One row per week and channel; the spend struct is NULL for channels without ads."""
    return _reported(weekly, totals=False).select("week", *_named(_channel_columns()))


def _mover_columns() -> dict[str, Column]:
    return {
        "channel": F.col("channel"),
        "metric": F.lit("revenue"),
        "from": round_even("prev_revenue", 2),
        "to": round_even("revenue", 2),
        "change": round_even("revenue - prev_revenue", 2),
        "change_pct": percent("wow_revenue"),
    }


def top_movers(weekly: DataFrame, limit: int | None) -> DataFrame:
    """The channels of each week whose revenue moved most (None: all of them), numbered from 1."""
    change = F.col("revenue") - F.col("prev_revenue")
    order = Window.partitionBy("week").orderBy(F.abs(change).desc(), "channel")
    moved = _reported(weekly, totals=False).where(F.col("prev_revenue").isNotNull())
    ranked = moved.withColumn("place", F.row_number().over(order))
    if limit is not None:
        ranked = ranked.where(F.col("place") <= limit)
    return ranked.select("week", "place", *_named(_mover_columns()))


def _finding_columns() -> dict[str, Column]:
    """Display values of a finding; the change field depends on the rule."""
    rule, metric = F.col("rule"), F.col("metric")
    return {
        "channel": F.col("channel"),
        "metric": metric,
        "when": F.col("date_or_week"),
        "rule": rule,
        "value": fact_value("metric", "value"),
        "baseline": fact_value("metric", "baseline"),
        "unit": F.when(metric.isin(*fv.PERCENT_METRICS), "%"),
        "direction": F.col("direction"),
        "severity": F.col("severity"),
        "seasonal_context": F.col("seasonal_context"),
        "simulated": F.col("is_simulated"),
        "z_score": F.when(rule == "robust_z", round_even("score", 1)),
        "change_pp": F.when(rule == "revenue_share_shift", round_even("score", 1)),
        "change_pct": F.when(rule.isin("cost_increase", "conversion_drop"), percent("score")),
    }


def anomaly_facts(ranked: DataFrame) -> DataFrame:
    """Display values of ranked findings."""
    return ranked.select("week", "place", *_named(_finding_columns()))


def _quality(quarantined_rows: Column) -> dict[str, Column]:
    return {
        "rows_quarantined": quarantined_rows.cast("bigint"),
        "days_covered": F.col("days"),
        "unknown_channel_session_share_pct": F.coalesce(
            percent("_unknown_share"), F.lit(0.0)
        ),
        "purchases_missing_revenue": whole("purchases_missing_revenue"),
        "missing_revenue_share_pct": percent("missing_revenue_share"),
        "duplicate_purchase_events": whole("duplicate_purchase_events"),
    }


def _unknown_share(weekly: DataFrame) -> DataFrame:
    unknown = _reported(weekly, totals=False).where(F.col("channel") == fv.UNKNOWN)
    return unknown.select("week", F.col("session_share").alias("_unknown_share"))


def quarantined_count(*quarantined: DataFrame) -> Column:
    """Rows in all quarantine tables, as a scalar sub-query."""
    counts = [q.agg(F.count(F.lit(1))).scalar() for q in quarantined]
    return sum(counts[1:], counts[0])


def data_quality_facts(weekly: DataFrame, quarantined_rows: Column) -> DataFrame:
    rows = _reported(weekly, totals=True).join(_unknown_share(weekly), "week", "left")
    return rows.select("week", *_named(_quality(quarantined_rows)))


def _entry(order: list[Column], columns: dict[str, Column]) -> Column:
    """A struct that sorts by `order` and has the shown columns in ``body``."""
    return F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], F.struct(*_named(columns)).alias("body"))


def _bodies(entries: str, limit: int | None = None) -> Column:
    """The bodies of the first `limit` entries."""
    ordered = F.sort_array(entries)
    return F.transform(ordered if limit is None else F.slice(ordered, 1, limit), lambda e: e["body"])


def weekly_facts(
    weekly: DataFrame, anomalies: DataFrame, quarantined_rows: Column, settings: Settings
) -> DataFrame:
    """The nested facts document of every complete week, one row each.

    Totals, channels and findings come as rows of one union and meet in one grouping by week; there is no join.
    Lists are sorted and cut inside the row. They are bounded: channels and movers by the
    channel list that validation enforces, findings by channels, metrics and the days of a week.
    """
    is_total, change = F.col("is_total"), F.col("revenue") - F.col("prev_revenue")
    of_channel = F.when(~is_total, _entry([-F.col("revenue"), F.col("channel")], _channel_columns()))
    moved = ~is_total & F.col("prev_revenue").isNotNull()
    of_weeks = weekly.where("is_complete").select(
        "week",
        F.when(is_total, F.struct(*[c for c in weekly.columns if c != "week"])).alias("_total"),
        F.when(~is_total & (F.col("channel") == fv.UNKNOWN), F.col("session_share")).alias("_unknown_share"),
        of_channel.alias("channels"),
        F.when(moved, _entry([-F.abs(change), F.col("channel")], _mover_columns())).alias("top_movers"),
    )
    findings = anomalies.select("week", _entry(severity_order(), _finding_columns()).alias("anomalies"))
    lists = ["channels", "top_movers", "anomalies"]
    one_a_week = of_weeks.unionByName(findings, allowMissingColumns=True).groupBy("week").agg(
        F.any_value("_total", ignoreNulls=F.lit(True)).alias("_total"),
        F.max("_unknown_share").alias("_unknown_share"),
        *[F.collect_list(name).alias(f"_{name}") for name in lists],
    )
    rows = one_a_week.where(F.col("_total").isNotNull()).select("week", "_total.*", *[c for c in one_a_week.columns if c not in ("week", "_total")])
    week, has_previous = F.col("week"), F.col("prev_sessions").isNotNull()
    document = {
        "schema_version": F.lit(fv.FACTS_VERSION),
        "report_week": week,
        "week_start": F.date_format("week_start", "yyyy-MM-dd"),
        "week_end": F.date_format(F.date_add("week_start", 6), "yyyy-MM-dd"),
        "previous_week": F.when(has_previous, previous_week(week)),
        "currency": F.lit(settings.currency),
        "simulated_spend": F.coalesce("spend_is_simulated", F.lit(True)),
        "totals": F.struct(*_named({**_headline(), **_changes()})),
        "funnel_pct": F.struct(
            *_named(_funnel()),
            F.lit(fv.FUNNEL_UNIT).alias("counted_as"),
            F.lit(fv.FUNNEL_NOTE).alias("note"),
        ),
        "data_quality": F.struct(*_named(_quality(quarantined_rows))),
        "channels": _bodies("_channels"),
        "top_movers": _bodies("_top_movers", settings.top_movers),
        "anomalies": _bodies("_anomalies", settings.max_anomalies),
        "anomaly_count": F.size("_anomalies").cast("bigint"),
    }
    return rows.select("week", *_named(document))


def facts_of_week(facts: DataFrame, week: str) -> DataFrame:
    """One week's document; raises when the week is not a complete week of the data."""
    one = facts.where(F.col("week") == week)
    if one.isEmpty():
        raise ValueError(f"{week} has no data or is a partial week; not reported")
    return one


def document_leaves(facts: DataFrame) -> DataFrame:
    """(week, path, number, text): every leaf with a value; numbers as doubles, the rest as text."""

    def leaf(kind: T.DataType, path: Column, value: Column) -> Column:
        numeric = isinstance(kind, T.NumericType)
        number = value.cast("double") if numeric else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if numeric else value.cast("string")
        return F.struct(path.alias("path"), number.alias("number"), text.alias("text"))

    def below(kind: T.StructType, prefix: Column, value: Column) -> Column:
        """Array of the leaves of one struct."""
        flat, nested = [], []
        for field in kind:
            path, child = F.concat(prefix, F.lit(field.name)), value[field.name]
            if isinstance(field.dataType, T.StructType):
                nested.append(below(field.dataType, F.concat(path, F.lit(".")), child))
            elif isinstance(field.dataType, T.ArrayType):
                nested.append(elements(field.dataType.elementType, path, child))
            else:
                flat.append(leaf(field.dataType, path, child))
        return F.concat(F.array(*flat), *nested) if flat else F.concat(*nested)

    def elements(kind: T.DataType, path: Column, items: Column) -> Column:
        def one(item: Column, i: Column) -> Column:
            return below(kind, F.concat(path, F.lit("["), i.cast("string"), F.lit("].")), item)

        return F.flatten(F.transform(items, one))

    names = [c for c in facts.columns if c != "week"]
    leaves = below(facts.select(*names).schema, F.lit(""), F.struct(*names))
    each = facts.select("week", F.explode(leaves).alias("_leaf")).select("week", "_leaf.*")
    return each.where(F.col("number").isNotNull() | F.col("text").isNotNull())


# The member that holds the change of a finding, by rule; other rules have none.
CHANGE_MEMBER = {
    "robust_z": "z_score",
    "revenue_share_shift": "change_pp",
    "cost_increase": "change_pct",
    "conversion_drop": "change_pct",
}


def with_facts_hash(facts: DataFrame) -> DataFrame:
    """Add the document as canonical JSON (``functions.jsontext``) and its SHA-256.

    Only paid channels have ``simulated_spend``, and a finding has the change member of its rule
    only; every other member is there, if need be as null. The same facts give the same bytes in every run
    and in every writer that follows the same rules.
    """
    document = T.StructType([f for f in facts.schema if f.name != "week"])
    channels, findings = document["channels"].dataType, document["anomalies"].dataType
    changes = set(CHANGE_MEMBER.values())

    def channel(item: str) -> str:
        paid, other = (struct_sql(channels.elementType, item, without, depth=1) for without in ((), ("simulated_spend",)))
        return f"CASE WHEN {item}.is_paid THEN {paid} ELSE {other} END"

    def finding(item: str) -> str:
        by_rule = [
            f"WHEN '{rule}' THEN {struct_sql(findings.elementType, item, changes - {member}, depth=1)}"
            for rule, member in CHANGE_MEMBER.items()
        ]
        return f"CASE {item}.rule {' '.join(by_rule)} ELSE {struct_sql(findings.elementType, item, changes, depth=1)} END"

    own = {"channels": array_sql(channels, "_d.channels", channel), "anomalies": array_sql(findings, "_d.anomalies", finding)}
    text = F.expr(struct_sql(document, "_d", own=own))
    whole_document = facts.withColumn("_d", F.struct(*document.names))
    return whole_document.withColumn("facts_json", text).drop("_d").withColumn("facts_hash", F.sha2(F.col("facts_json"), 256))
