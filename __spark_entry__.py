"""Entry points: the flagship query, every registered query, and its SQL counterpart.

Event queries run on ``events`` seen as a web-analytics log. KPI, anomaly, facts and report
queries run on ``orders`` with ``lineitem`` seen as a daily channel table over several years;
from the facts on, the table carries planted faults and passes the quarantine first. Text
queries run on ``documents``. The adapters are in ``tidemark.sources.samples``.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from datetime import date
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import calendar as cal
from tidemark.functions.channels import channel_of
from tidemark.functions.numbers import money_sum
from tidemark.functions.text import sentence_count
from tidemark.model import DAILY, Settings
from tidemark.operators import anomalies as an
from tidemark.operators import facts as fa
from tidemark.operators import firings, kpis, narratives, numberguard, quality, report, sessions
from tidemark.plans.materialize import materialize, shared_folder
from tidemark.plans.pipeline import Report, prepare
from tidemark.sources import events as event_source
from tidemark.sources import samples, tables
from tidemark.sources.ranged import RangedTable

SMOKE = "/root/testdata/sf0.001"
PAID = ("paid_search",)
EVENT_RANGE = (date(2024, 1, 8), date(2024, 1, 21))
HALVES = ((date(2000, 1, 1), date(2024, 1, 14)), (date(2024, 1, 15), date(2099, 12, 31)))
SHARD_RANGE = (date(2024, 1, 24), date(2024, 2, 6))
ALL_EVENTS = (date(2000, 1, 1), date(2099, 12, 31))
# The daily volumes of the sample orders are small, so the volume gate is open by default.
OPEN = Settings(start_date=date(1995, 1, 8), end_date=date(2001, 7, 31), min_daily_volume=0)
GATED = Settings(min_daily_volume=3)
SIMULATED = "spend_is_simulated"  # of the tables, not of the published KPIs
REWRITTEN = (date(1996, 3, 4), date(1996, 3, 17))
FIRST_MONDAY, TEXT_WEEKS = date(1995, 1, 9), 300

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to a few digits: two engines add floats in different orders."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


# --- shared inputs -----------------------------------------------------------------------------


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    """The long daily table. It has several readers downstream, so it is stored once."""
    return materialize(samples.orders_daily(spark, folder))


def _kpis(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return samples.orders_daily(spark, folder), samples.orders_spend(spark, folder)


def _daily_kpis(spark: SparkSession, folder: str) -> DataFrame:
    daily, spend = samples.orders_daily(spark, folder), samples.orders_spend(spark, folder)
    return materialize(kpis.daily_metrics(daily, spend, PAID))


def _weekly(spark: SparkSession, folder: str) -> DataFrame:
    daily, spend = _kpis(spark, folder)
    return kpis.with_changes(kpis.weekly_metrics(daily, spend, PAID))


def _report(spark: SparkSession, folder: str) -> Report:
    daily, spend = samples.orders_daily(spark, folder), samples.orders_spend(spark, folder)
    return prepare(samples.dirty_daily(daily), samples.dirty_spend(spend), OPEN)


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(_report(spark, folder).facts())


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- events, sessions, daily rollup -------------------------------------------------------------


def scan_events_range(spark: SparkSession, folder: str) -> DataFrame:
    log = event_source.in_date_range(samples.table(spark, folder, "events"), "ts", *EVENT_RANGE)
    return log.select("event_id", F.to_date("ts").alias("event_date"), "event_type", "value")


def extract_event_params(spark: SparkSession, folder: str) -> DataFrame:
    return event_source.flatten_events(samples.nested_events(samples.events(spark, folder)))


def channel_mapping(spark: SparkSession, folder: str) -> DataFrame:
    pair = ["source", "medium"]
    channel = channel_of(F.col("source"), F.col("medium")).alias("channel")
    return samples.events(spark, folder).groupBy(*pair, channel).agg(
        F.count(F.lit(1)).alias("events")
    )


def session_list(spark: SparkSession, folder: str) -> DataFrame:
    rows = sessions.sessionize(samples.events(spark, folder))
    return rows.select("user_pseudo_id", "ga_session_id", "session_date", "channel")


def session_funnel_flags(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.sessionize(samples.events(spark, folder)).drop("session_date", "channel")


def first_touch_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.first_touch(samples.events(spark, folder))


def purchase_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sessions.purchase_firings(samples.events(spark, folder)), 4)


def _firing_index(spark: SparkSession, folder: str) -> tuple[DataFrame, RangedTable]:
    """Events, and an index that has been filled by runs over parts of the days, the later part first."""
    events, index = samples.events(spark, folder), RangedTable(spark, _place(spark, "firings"), "first_date")
    for start, end in HALVES[::-1]:
        firings.index_firings(index, events, start, end)
    return events, index


def first_firing_index(spark: SparkSession, folder: str) -> DataFrame:
    index = _firing_index(spark, folder)[1]
    return rounded(firings.first_firings(index).drop("first_date"), 4)


def purchase_dedup_by_range(spark: SparkSession, folder: str) -> DataFrame:
    """Each part of the days de-duplicated against the index; parts of a session are added up."""
    events, index = _firing_index(spark, folder)
    parts = [firings.firings_in_range(index, events, start, end) for start, end in HALVES]
    sums = ["firings", "duplicates", "missing_revenue", "kept", "kept_revenue"]
    both = parts[0].unionByName(parts[1]).groupBy("user_pseudo_id", "ga_session_id", "transaction_id")
    return rounded(both.agg(*[(money_sum(F.col(c)) if c == "kept_revenue" else F.sum(c)).alias(c) for c in sums]), 4)


def purchases_by_session(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sessions.purchases_by_session(samples.events(spark, folder)), 4)


def daily_channel_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sessions.daily_rollup(samples.events(spark, folder)), 4)


def weekly_from_events(spark: SparkSession, folder: str) -> DataFrame:
    daily = materialize(sessions.daily_rollup(samples.events(spark, folder)))
    spend = samples.event_spend(spark, folder)
    return rounded(kpis.with_changes(kpis.weekly_metrics(daily, spend, PAID)).drop(SIMULATED))


def rollup_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """Nested events in folders by date, read, flattened and rolled up: the way in for real exports."""
    path = _place(spark, "events")
    nested = samples.nested_events(samples.events(spark, folder))
    nested.repartition("event_date").write.partitionBy("event_date").parquet(path)
    read = event_source.read_events(spark, path, *ALL_EVENTS)
    return rounded(sessions.daily_rollup(event_source.flatten_events(read)), 4)


def event_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Events in a folder a day, and what reading two weeks of them finds, the days without a folder too."""
    path = _place(spark, "shards")
    event_source.write_event_shards(samples.nested_events(samples.events(spark, folder)), path)
    shards = event_source.read_event_shards(spark, path, *SHARD_RANGE)
    flat = event_source.flatten_events(shards.events)
    counted = flat.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"), F.count("transaction_id").alias("with_id"))
    absent = spark.createDataFrame([(d, None, None) for d in shards.missing], "event_date date, events bigint, with_id bigint")
    return counted.unionByName(absent)


# --- tables, validation, profile ----------------------------------------------------------------


def scan_daily(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark, "daily")
    tables.write_daily(samples.orders_daily(spark, folder), path)
    return tables.read_daily(spark, path)


def sink_order(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every row in the files of the daily table, one file after the other."""
    path = _place(spark, "daily")
    tables.write_daily(samples.orders_daily(spark, folder), path)
    (span,) = RangedTable(spark, path).spans()
    stored = spark.read.parquet(f"{path}/data/{span.folder}")
    rows = stored.select("date", "channel", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    # A row a file: files hold consecutive spans of dates.
    earlier = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.min("date").alias("first"), F.count(F.lit(1)).alias("n"))
    files = files.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return rows.join(files, "file").select("date", "channel", (F.col("before") + F.col("row") + 1).alias("position"))


def scan_spend(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark, "spend")
    tables.write_spend(samples.orders_spend(spark, folder), path)
    return tables.read_spend(spark, path)


def validate_daily(spark: SparkSession, folder: str) -> DataFrame:
    dirty = samples.dirty_daily(_daily(spark, folder))
    return quality.validate_daily(dirty, OPEN)[0]


def structure_faults(spark: SparkSession, folder: str) -> DataFrame:
    """What a table in text columns, one of them missing, has against the daily schema."""
    return quality.structure_faults(samples.written_daily(samples.orders_daily(spark, folder)), DAILY)


def quarantine_daily(spark: SparkSession, folder: str) -> DataFrame:
    dirty = samples.dirty_daily(_daily(spark, folder))
    return quality.validate_daily(dirty, OPEN)[1]


def quarantine_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """All copies of repeated keys, whatever else is wrong with them."""
    found = quarantine_daily(spark, folder).where(F.col("reason").contains("duplicate"))
    return found.groupBy("date", "channel").agg(F.count(F.lit(1)).alias("copies"))


def quarantine_spend(spark: SparkSession, folder: str) -> DataFrame:
    dirty = samples.dirty_spend(materialize(samples.orders_spend(spark, folder)))
    return quality.validate_spend(dirty, OPEN)[1]


def quarantine_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quarantine_summary(quarantine_daily(spark, folder))


def profile_summary(spark: SparkSession, folder: str) -> DataFrame:
    dirty = samples.dirty_daily(samples.orders_daily(spark, folder))
    return rounded(quality.profile(dirty, OPEN.start_date, OPEN.end_date), 2)


def profile_null_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.null_rates(samples.dirty_daily(samples.orders_daily(spark, folder))))


def profile_report(spark: SparkSession, folder: str) -> DataFrame:
    dirty = samples.dirty_daily(samples.orders_daily(spark, folder))
    return rounded(quality.profile_report(dirty, OPEN.start_date, OPEN.end_date), 4)


def profile_channel_shares(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.channel_shares(_daily(spark, folder)), 4)


def sink_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The quarantined rows written as CSV and read back."""
    bad = quarantine_daily(spark, folder)
    path = tables.write_quarantine(bad, "daily.csv", _place(spark, "quarantine"))
    return spark.read.schema(bad.schema).option("header", True).csv(path)


def weekly_spend(spark: SparkSession, folder: str) -> DataFrame:
    planted = F.when(F.unix_date("date") % 10 == 0, 2.0).otherwise(1.0)
    spend = samples.orders_spend(spark, folder).withColumn("planted_multiplier", planted)
    return rounded(quality.weekly_spend(spend), 2)


# --- calendar -------------------------------------------------------------------------------------


def _order_dates(spark: SparkSession, folder: str) -> DataFrame:
    return samples.table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("date")
    ).distinct()


def iso_week(spark: SparkSession, folder: str) -> DataFrame:
    return _order_dates(spark, folder).withColumn("week", cal.iso_week_label(F.col("date")))


def iso_week_start(spark: SparkSession, folder: str) -> DataFrame:
    weeks = _order_dates(spark, folder).select(cal.iso_week_label(F.col("date")).alias("week"))
    return weeks.distinct().withColumns(
        {
            "week_start": cal.week_start(F.col("week")),
            "previous_week": cal.previous_week(F.col("week")),
        }
    )


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    return cal.calendar(samples.table(spark, folder, "orders"), "o_orderdate")


def seasonal_context_day(spark: SparkSession, folder: str) -> DataFrame:
    return _order_dates(spark, folder).withColumn(
        "context", cal.day_context(F.col("date"), OPEN.baseline_days)
    )


def seasonal_context_week(spark: SparkSession, folder: str) -> DataFrame:
    weeks = _order_dates(spark, folder).select(cal.monday_of(F.col("date")).alias("week_start"))
    return weeks.distinct().withColumn("context", cal.week_context(F.col("week_start")))


# --- KPIs -----------------------------------------------------------------------------------------


def daily_with_spend(spark: SparkSession, folder: str) -> DataFrame:
    joined = kpis.join_spend(
        samples.orders_daily(spark, folder), samples.orders_spend(spark, folder), PAID
    )
    return joined.select("date", "channel", "sessions", "spend", "is_paid")


def daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    daily, spend = samples.orders_daily(spark, folder), samples.orders_spend(spark, folder)
    return rounded(kpis.daily_metrics(daily, spend, PAID).drop(SIMULATED))


def weekly_sums(spark: SparkSession, folder: str) -> DataFrame:
    daily, spend = samples.orders_daily(spark, folder), samples.orders_spend(spark, folder)
    joined = kpis.join_spend(daily, spend, PAID)
    return rounded(kpis.weekly_sums(joined, PAID).drop(SIMULATED, "days"), 2)


def weekly_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(kpis.weekly_metrics(*_kpis(spark, folder), PAID).drop(SIMULATED))


def sink_weekly(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark, "weekly")
    tables.write_weekly(weekly_metrics(spark, folder), path)
    return tables.read_weekly(spark, path)


def sink_range(spark: SparkSession, folder: str) -> DataFrame:
    """The daily table written whole, then two weeks of it again with a tenth of the revenue less."""
    path, daily = _place(spark, "daily"), _daily(spark, folder)
    tables.write_daily(daily, path)
    tables.write_daily(daily.withColumn("revenue", F.round(F.col("revenue") * 0.9, 4)), path, *REWRITTEN)
    return rounded(tables.read_daily(spark, path), 4)


def weekly_shares(spark: SparkSession, folder: str) -> DataFrame:
    weekly = kpis.weekly_metrics(*_kpis(spark, folder), PAID)
    return rounded(weekly.select("week", "channel", "session_share", "revenue_share"))


def complete_weeks(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.complete_weeks(kpis.weekly_metrics(*_kpis(spark, folder), PAID))


def weekly_wow(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_weekly(spark, folder).drop(SIMULATED))


# --- anomalies ------------------------------------------------------------------------------------


def daily_total(spark: SparkSession, folder: str) -> DataFrame:
    both = an.with_daily_total(_daily_kpis(spark, folder))
    return rounded(
        both.select("date", "channel", "is_total", *an.TOTAL_SUMS, "spend", "conversion_rate", "aov")
    )


def daily_dense(spark: SparkSession, folder: str) -> DataFrame:
    dense = an.densify(_daily(spark, folder))
    return dense.select("date", "channel", "sessions", "purchases", "revenue")


def metric_series(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(an.metric_series(an.with_daily_total(_daily_kpis(spark, folder)), OPEN))


def baseline_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = an.trailing_baseline(an.with_daily_total(_daily_kpis(spark, folder)), OPEN)
    values = F.col("baseline_values")
    return rounded(
        rows.select(
            "channel",
            "metric",
            "date",
            F.size(values).cast("bigint").alias("baseline_days"),
            an.array_median(values).alias("baseline_median"),
        )
    )


def volume_gate(spark: SparkSession, folder: str) -> DataFrame:
    rows = an.trailing_baseline(an.with_daily_total(_daily_kpis(spark, folder)), GATED)
    gated = an.enough_volume(rows, GATED)
    return gated.select("channel", "metric", "date", "volume_median", "enough_volume")


def robust_z(spark: SparkSession, folder: str) -> DataFrame:
    scored = an.scored_days(an.with_daily_total(_daily_kpis(spark, folder)), OPEN)
    return rounded(scored.select("channel", "metric", "date", "value", "baseline", "z"), 9)


def daily_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(an.daily_anomalies(_daily_kpis(spark, folder), OPEN))


def weekly_rule_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(an.weekly_rule_anomalies(_weekly(spark, folder), OPEN))


def anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_report(spark, folder).anomalies)


def anomalies_by_week(spark: SparkSession, folder: str) -> DataFrame:
    found = _report(spark, folder).anomalies
    return found.groupBy("week", "granularity", "severity").agg(F.count(F.lit(1)).alias("findings"))


def top_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    run = _report(spark, folder)
    return rounded(run.top_anomalies).drop("seasonal_context")


# --- facts ----------------------------------------------------------------------------------------


def facts_totals(spark: SparkSession, folder: str) -> DataFrame:
    return fa.totals_facts(_report(spark, folder).weekly)


def facts_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return fa.funnel_facts(_report(spark, folder).weekly)


def facts_channels(spark: SparkSession, folder: str) -> DataFrame:
    rows = fa.channel_facts(_report(spark, folder).weekly)
    return rows.select(*[c for c in rows.columns if c != "simulated_spend"], "simulated_spend.*")


def top_movers(spark: SparkSession, folder: str) -> DataFrame:
    return fa.top_movers(_report(spark, folder).weekly, OPEN.top_movers)


def facts_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return fa.anomaly_facts(_report(spark, folder).top_anomalies)


def facts_data_quality(spark: SparkSession, folder: str) -> DataFrame:
    run = _report(spark, folder)
    return fa.data_quality_facts(run.weekly, run.quarantined_rows)


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """The leaves of every document."""
    return fa.document_leaves(_report(spark, folder).facts())


def sink_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The leaves of the documents after writing them, the last week twice, and reading them back."""
    documents = _facts(spark, folder)
    texts, path = fa.with_facts_hash(documents), _place(spark, "facts")
    tables.write_facts(texts, path)
    tables.write_facts(texts.orderBy(F.desc("week")).limit(1), path)
    return fa.document_leaves(tables.read_facts(spark, path, documents.schema))


def facts_hash(spark: SparkSession, folder: str) -> DataFrame:
    return fa.with_facts_hash(_report(spark, folder).facts()).select("week", "facts_hash")


# --- texts ----------------------------------------------------------------------------------------


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return samples.texts_by_week(spark, folder, FIRST_MONDAY, TEXT_WEEKS)


def extract_numbers(spark: SparkSession, folder: str) -> DataFrame:
    tokens = numberguard.extract_numbers(_texts(spark, folder))
    return tokens.select("text_id", "position", "token", "value", "tolerance")


def fact_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return numberguard.fact_numbers(_facts(spark, folder))


def number_guard(spark: SparkSession, folder: str) -> DataFrame:
    numbers = materialize(numberguard.fact_numbers(_facts(spark, folder)))
    checked = numberguard.check_numbers(_texts(spark, folder), numbers, ["text_id"])
    return checked.select("text_id", "week", "ok", F.array_join("unmatched", " ").alias("unmatched"))


def sentence_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder).select(
        "text_id", sentence_count(F.col("text")).cast("bigint").alias("sentences")
    )


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return narratives.parse_responses(samples.responses(spark, folder, FIRST_MONDAY, TEXT_WEEKS))


def parse_narratives(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder).select("doc_id", "narrative.summary", "problem")


def validate_narratives(spark: SparkSession, folder: str) -> DataFrame:
    verdict = F.coalesce("problem", F.lit("ok")).alias("verdict")
    return _parsed(spark, folder).groupBy(verdict).agg(F.count(F.lit(1)).alias("responses"))


def template_narrative(spark: SparkSession, folder: str) -> DataFrame:
    rows = narratives.template_narratives(_facts(spark, folder))
    return rows.select(
        "week",
        "narrative.summary",
        F.array_join("narrative.findings", "\n").alias("findings"),
        F.array_join("narrative.checks", "\n").alias("checks"),
    )


def resolve_narrative(spark: SparkSession, folder: str) -> DataFrame:
    answers = samples.responses(spark, folder, FIRST_MONDAY, TEXT_WEEKS)
    rows = narratives.resolve_narratives(_facts(spark, folder), answers, OPEN, ("variant",))
    return rows.select(
        "week", "variant", "source", "fallback_reason", F.array_join("unmatched_numbers", " ").alias("unmatched")
    )


# --- report tables and series -----------------------------------------------------------------------


def kpi_deltas(spark: SparkSession, folder: str) -> DataFrame:
    return report.kpi_deltas(_report(spark, folder).weekly)


def report_channel_table(spark: SparkSession, folder: str) -> DataFrame:
    return report.channel_table(_report(spark, folder).weekly)


def report_paid_table(spark: SparkSession, folder: str) -> DataFrame:
    return report.paid_table(_report(spark, folder).weekly, PAID)


def report_anomaly_table(spark: SparkSession, folder: str) -> DataFrame:
    return report.anomaly_table(facts_anomalies(spark, folder))


def report_kpi_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return report.kpi_tiles(_report(spark, folder).weekly)


def series_revenue_trend(spark: SparkSession, folder: str) -> DataFrame:
    run = _report(spark, folder)
    return rounded(report.revenue_trend(run.weekly, run.anomalies), 2)


def series_channel_mix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(report.channel_mix(_report(spark, folder).weekly))


def series_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return report.funnel_series(_report(spark, folder).weekly)


def series_kpi_changes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(report.kpi_change_series(_report(spark, folder).weekly))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_events_range, extract_event_params, channel_mapping, session_funnel_flags,
        first_touch_attribution, purchase_dedup, first_firing_index, purchase_dedup_by_range, purchases_by_session, daily_channel_rollup,
        weekly_from_events, scan_daily, sink_order, scan_spend, validate_daily, structure_faults, quarantine_daily,
        quarantine_duplicates, quarantine_spend, quarantine_summary, profile_summary,
        profile_null_rates, profile_channel_shares, profile_report, weekly_spend, iso_week, iso_week_start,
        calendar, seasonal_context_day, seasonal_context_week, daily_with_spend, daily_metrics,
        weekly_sums, weekly_metrics, weekly_shares, complete_weeks, weekly_wow, daily_total,
        daily_dense, metric_series, baseline_stats, volume_gate, robust_z, daily_anomalies,
        weekly_rule_anomalies, anomalies, anomalies_by_week, top_anomalies, facts_totals,
        facts_funnel, facts_channels, top_movers, facts_anomalies, facts_data_quality, facts,
        facts_hash, rollup_from_files, event_shards, sink_quarantine, sink_weekly, sink_range, sink_facts, extract_numbers, fact_numbers, number_guard, parse_narratives,
        validate_narratives, template_narrative, resolve_narrative, kpi_deltas,
        report_channel_table, report_paid_table, report_anomaly_table, report_kpi_tiles,
        series_revenue_trend, series_channel_mix, series_funnel, series_kpi_changes,
    )
}
QUERIES["sessions"] = session_list
QUERIES["sentence_count"] = sentence_counts


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: raw events to the daily channel table."""
    return daily_channel_rollup(spark, SMOKE)


def _optional(name: str):
    """A module of the training-data part, or None if that part, or a library that it needs, is not there."""
    try:
        return import_module(name)
    except ImportError as error:
        if not (error.name or "").startswith(("tidemark.llm", "corpus_pipeline")):
            warnings.warn(f"without {name}: {error}", stacklevel=2)
        return None


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    found, statements = {}, {}
    if numbered := _optional("tidemark.llm.queries"):
        found |= numbered.QUERIES
        statements |= numbered.STATEMENTS
    if found and (pipeline := _optional("corpus_pipeline")):
        found["pipeline"] = pipeline.run
        if pipeline.ORACLE_SQL:
            statements["pipeline"] = pipeline.ORACLE_SQL
    return found, statements


def queries() -> dict[str, Query]:
    return QUERIES | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    from oracle.sql import statements

    return statements() | _training_data()[1]
