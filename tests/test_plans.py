"""The shape of the physical plans, and registered queries against SQL."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import compare, connect
from tidemark.operators import anomalies as an
from tidemark.operators import facts as fa
from tidemark.operators import kpis, quality, sessions
from tidemark.sources import samples

FOLDER = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    return samples.events(spark, FOLDER)


@pytest.fixture(scope="module")
def run(spark):
    return entry._report(spark, FOLDER)


def test_sessions_stay_a_hash_aggregate(events):
    text = plan(sessions.sessionize(events))
    assert "SortAggregate" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    # Purchase columns are neither aggregated nor read.
    assert "value" not in re.search(r"ReadSchema: (.*)", text).group(1)


def final_plan(df) -> str:
    """The plan that ran, with what adaptive execution shared."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def below_first_exchange(text: str) -> str:
    """What runs on the raw rows: the lines from the deepest exchange down to the scan."""
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    start = max(i for i in range(scan) if "Exchange" in lines[i])
    return "\n".join(lines[start : scan + 1])


@pytest.mark.parametrize("operator", [sessions.daily_rollup, sessions.purchases_by_session, sessions.purchase_firings, sessions.first_touch])
def test_events_are_read_once_and_hashed(events, operator):
    text = final_plan(operator(events.withColumn("user_pseudo_id", F.col("user_pseudo_id").cast("string"))))
    assert text.count("FileScan") == 1
    raw = below_first_exchange(text)
    assert "HashAggregate" in raw and "SortAggregate" not in raw
    assert "Window" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_rollup_joins_where_the_sessions_already_are(events):
    text = final_plan(sessions.daily_rollup(events))
    assert text.count("ReusedExchange") == 1
    on_session = re.findall(r"Exchange hashpartitioning\(user_pseudo_id#\d+L?, ga_session_id#\d+L?, \d", text)
    # Sessions and first firings; the join itself adds no shuffle.
    assert len(on_session) <= 2


def test_weekly_metrics_read_the_daily_table_once(run):
    text = final_plan(kpis.weekly_metrics(run.flagged_daily, run.flagged_spend, entry.PAID))
    assert text.count("FileScan") == 2  # daily and spend


def test_profiles_and_calendars_read_their_table_once(run):
    for df in (quality.channel_shares(run.flagged_daily), an.densify(run.flagged_daily)):
        assert final_plan(df).count("FileScan") <= 2


def test_event_range_reaches_the_scan(spark):
    text = plan(entry.scan_events_range(spark, FOLDER))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "props" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_top_lists_are_cut_before_the_shuffle(run):
    for df in (an.rank_anomalies(run.anomalies, 8), fa.top_movers(run.weekly, 3)):
        text = plan(df)
        assert "WindowGroupLimit" in text and "Partial" in text


def test_no_plan_leaves_the_engine_or_pairs_everything(run):
    weekly = kpis.with_changes(kpis.weekly_metrics(run.flagged_daily, run.flagged_spend, entry.PAID))
    facts = fa.weekly_facts(run.weekly, run.anomalies, run.quarantined_rows, entry.OPEN)
    for df in (run.daily, weekly, run.anomalies, facts):
        text = plan(df)
        for bad in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text
        for line in re.findall(r"Window \[.*", text):
            partition_keys = re.findall(r"\[([^\[\]]*)\]", line)[1]
            assert not re.search(r" (ASC|DESC)", partition_keys), line


def test_number_check_is_an_equi_join(spark, run):
    from tidemark.operators import numberguard as ng

    numbers = ng.fact_numbers(run.facts())
    text = plan(ng.unmatched_numbers(entry._texts(spark, FOLDER), numbers))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "LeftAnti" in text


# A few quick ones; tests/compare.py checks them all.
CHECKED = ["daily_channel_rollup", "purchase_dedup", "quarantine_daily", "weekly_wow", "facts_channels"]


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, name):
    sql = entry.oracle_sql()[name]
    assert compare(connect(FOLDER), sql, entry.queries()[name](spark, FOLDER)) == ""


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"date", "channel", "sessions", "revenue"} <= set(rows[0].asDict())


@pytest.mark.parametrize(("missing", "warned"), [("zstandard", 1), ("tidemark.llm", 0)])
def test_queries_stay_without_the_training_data_part(monkeypatch, recwarn, missing, warned):
    """A library that it needs is not there, or the part itself has been taken out."""

    def gone(name):
        raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)

    monkeypatch.setattr(entry, "import_module", gone)
    assert set(entry.queries()) == set(entry.QUERIES) and set(entry.oracle_sql()) <= set(entry.QUERIES)
    assert bool([w for w in recwarn if "tidemark.llm" in str(w.message)]) == bool(warned)


def test_facts_read_stored_tables_and_meet_once(run):
    text = plan(run.facts())
    assert "Union" in text and "Join" not in text and "Window" not in text
    assert len(re.findall(r"Exchange hashpartitioning\(week#", text)) == 1


def test_quarantine_reads_its_table_once(spark, tmp_path):
    samples.dirty_daily(samples.orders_daily(spark, FOLDER)).write.parquet(str(tmp_path / "t"))
    valid, bad = quality.validate_daily(spark.read.parquet(str(tmp_path / "t")), entry.OPEN)
    for df in (valid, bad):
        text = final_plan(df)
        assert text.count("FileScan") == 1 and "Window" not in text
