"""Tables by range of days, event shards, and the index of first firings."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.test_plans import final_plan
from tidemark.operators import firings, sessions
from tidemark.sources import events as event_source
from tidemark.sources import samples, tables
from tidemark.sources.ranged import RangedTable, Span, replaced

FOLDER = "/root/testdata/sf0.01"
DAY = date(2024, 1, 1)


def day(n: int) -> date:
    return DAY + timedelta(days=n)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=8))
def test_ranges_hold_the_last_write_of_every_day(writes):
    spans, wanted = [], {}
    for k, (a, b) in enumerate(writes):
        a, b = min(a, b), max(a, b)
        spans = replaced(spans, Span(day(a), day(b), str(k)))
        wanted |= dict.fromkeys(range(a, b + 1), str(k))
    found = {}
    for s in spans:
        for n in range((s.start - DAY).days, (s.end - DAY).days + 1):
            assert n not in found
            found[n] = s.folder
    assert found == wanted
    assert all(x.folder != y.folder or x.end + timedelta(days=1) < y.start for x, y in zip(spans, spans[1:], strict=False))


def rows(spark, days, value):
    return spark.createDataFrame([(day(n), f"c{n % 2}", value + n) for n in days], "date date, channel string, v long")


def content(df):
    return {r["date"]: r["v"] for r in df.collect()}


def test_a_range_is_replaced_and_the_rest_stays(spark, tmp_path):
    table = RangedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.replace(rows(spark, range(10), 100), day(0), day(9))
    before = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet")}
    old = table.read()
    # Rows outside the range are not taken; day 5 has no rows any more.
    table.replace(rows(spark, [3, 4, 6, 9], 200), day(3), day(6))
    want = {day(n): 100 + n for n in (0, 1, 2, 7, 8, 9)} | {day(n): 200 + n for n in (3, 4, 6)}
    assert content(table.read()) == want
    assert content(old) == {day(n): 100 + n for n in range(10)} == content(table.read(1))
    assert {p: p.stat().st_mtime_ns for p in before} == before
    assert [(s.start, s.end) for s in table.spans()] == [(day(0), day(2)), (day(3), day(6)), (day(7), day(9))]
    assert table.versions() == [1, 2] and len(table.vacuum(keep=2)) == 0
    assert table.versions() == [1, 2] and table.vacuum() == [] and table.versions() == [2]
    table.replace(rows(spark, range(4), 300), date.min, date.max)
    assert len(table.vacuum()) == 2 and content(table.read()) == {day(n): 300 + n for n in range(4)}
    with pytest.raises(ValueError):
        table.replace(rows(spark, [1], 0), day(2), day(1))


def test_a_write_that_dies_changes_nothing(spark, tmp_path):
    table = RangedTable(spark, str(tmp_path / "t"))
    table.replace(rows(spark, range(4), 0), day(0), day(3))
    broken = rows(spark, range(4), 0).withColumn("v", F.when(F.col("v") > 2, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        table.replace(broken, day(0), day(3))
    assert table.versions() == [1] and content(table.read()) == {day(n): n for n in range(4)}


def test_of_two_writers_both_ranges_count(spark, tmp_path, monkeypatch):
    table, other = (RangedTable(spark, str(tmp_path / "t")) for _ in range(2))
    table.replace(rows(spark, range(6), 0), day(0), day(5))
    publish = RangedTable._publish

    def late(self, version, spans):
        monkeypatch.setattr(RangedTable, "_publish", publish)
        other.replace(rows(spark, [1], 50), day(1), day(1))  # takes the number first
        return publish(self, version, spans)

    monkeypatch.setattr(RangedTable, "_publish", late)
    table.replace(rows(spark, [4], 70), day(4), day(4))
    assert content(table.read()) == {day(0): 0, day(1): 51, day(2): 2, day(3): 3, day(4): 74, day(5): 5}
    assert table.versions() == [1, 2, 3]


def test_a_day_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "daily")
    daily = samples.orders_daily(spark, FOLDER)
    tables.write_daily(daily, path)
    tables.write_daily(daily, path, date(1996, 1, 1), date(1996, 1, 7))
    text = final_plan(tables.read_daily(spark, path).where(F.col("date") < F.lit(date(1995, 6, 1))))
    # The ranges of a folder and the asked days are filters of its scan (the plan's text is cut after some of them).
    assert "PushedFilters: [IsNotNull(date), Or(And(GreaterThanOrEqual(date" in text
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,1996-01-01), LessThanOrEqual(date,1996-01-07), LessThan" in text
    assert tables.read_daily(spark, path).count() == daily.count()


def test_tables_from_elsewhere_are_read_too(spark, tmp_path):
    path = str(tmp_path / "plain")
    samples.orders_spend(spark, FOLDER).write.parquet(path)
    assert tables.read_spend(spark, path).count() == samples.orders_spend(spark, FOLDER).count()


def test_shards_of_the_range_only_are_read(spark, tmp_path):
    root = str(tmp_path / "shards")
    raw = samples.nested_events(samples.events(spark, FOLDER))
    event_source.write_event_shards(raw, root)
    folders = sorted(p.name for p in Path(root).iterdir())
    assert len(folders) == 30 and folders[0] == "events_20240101"
    found = event_source.read_event_shards(spark, root, date(2024, 1, 8), date(2024, 1, 21))
    assert found.missing == []
    assert {Path(f).parent.name for f in found.events.inputFiles()} == {f"events_202401{d:02d}" for d in range(8, 22)}
    assert found.events.count() == raw.where("event_date BETWEEN '20240108' AND '20240121'").count()
    late = event_source.read_event_shards(spark, root, date(2024, 1, 30), date(2024, 2, 1))
    assert late.missing == [date(2024, 1, 31), date(2024, 2, 1)] and late.events.count() > 0
    none = event_source.read_event_shards(spark, root, date(2023, 1, 1), date(2023, 1, 2))
    assert len(none.missing) == 2 and none.events.collect() == [] and none.events.schema == found.events.schema
    # One day again, with half of its rows.
    event_source.write_event_shards(raw.where("event_date = '20240108'").limit(5), root)
    assert event_source.read_event_shards(spark, root, date(2024, 1, 8), date(2024, 1, 8)).events.count() == 5
    assert sorted(p.name for p in Path(root).iterdir()) == folders


def test_partitioned_events_are_pruned(spark, tmp_path):
    path = str(tmp_path / "events")
    samples.nested_events(samples.events(spark, FOLDER)).write.partitionBy("event_date").parquet(path)
    text = final_plan(event_source.read_events(spark, path, date(2024, 1, 8), date(2024, 1, 21)))
    assert "PartitionFilters: [isnotnull(event_date" in text and "event_date#" in text.split("PartitionFilters")[1].split("]")[0]


EVENT = "event_date date, event_timestamp long, event_name string, user_pseudo_id string, ga_session_id long, source string, medium string, transaction_id string, purchase_revenue double"


def purchases(spark):
    made = [  # (day, time, user, session, id, revenue)
        (0, 10, "u", 1, "A", 5.0), (0, 11, "u", 1, "A", 5.0), (1, 20, "v", 2, "A", 5.0), (1, 21, "v", 2, "B", None), (2, 30, "u", 1, "B", 7.0),
        (2, 31, "w", 3, None, 2.0), (2, 32, "w", 3, "(not set)", None), (3, 40, None, None, "C", 1.0), (3, 41, None, None, "C", 1.0), (4, 50, "u", 1, "A", 9.0),
    ]
    return spark.createDataFrame([(day(d), t, "purchase", u, s, None, None, i, r) for d, t, u, s, i, r in made], EVENT)


@pytest.mark.parametrize("cuts", [[(0, 9)], [(0, 1), (2, 9)], [(2, 9), (0, 1)], [(4, 4), (0, 0), (1, 3)], [(0, 1), (2, 9), (0, 1)]])
def test_runs_over_parts_equal_one_run(spark, tmp_path, cuts):
    events, index = purchases(spark), RangedTable(spark, str(tmp_path / "index"), "first_date")
    for a, b in cuts:
        firings.index_firings(index, events, day(a), day(b))
    whole = sessions.first_firings(sessions.by_transaction(sessions.purchase_events(events)))
    assert sorted(firings.first_firings(index).drop("first_date").collect(), key=str) == sorted(whole.collect(), key=str)
    key, got = ["user_pseudo_id", "ga_session_id", "transaction_id"], {}
    for a, b in set(cuts):
        for r in firings.firings_in_range(index, events, day(a), day(b)).collect():
            own = got.setdefault(tuple(r[k] for k in key), [0, 0, 0, 0, None])
            for i, c in enumerate(("firings", "duplicates", "missing_revenue", "kept")):
                own[i] += r[c]
            if r["kept_revenue"] is not None:
                own[4] = (own[4] or 0) + r["kept_revenue"]
    want = {tuple(r[k] for k in key): [r[c] for c in ("firings", "duplicates", "missing_revenue", "kept", "kept_revenue")] for r in sessions.purchase_firings(events).collect()}
    assert got == want


def test_an_empty_range_empties_its_part(spark, tmp_path):
    events, index = purchases(spark), RangedTable(spark, str(tmp_path / "index"), "first_date")
    firings.index_firings(index, events, day(0), day(9))
    firings.index_firings(index, events.where("false"), day(0), day(1))
    assert {r["transaction_id"]: r["first_date"] for r in firings.first_firings(index).collect()} == {"C": day(3)} | {}


def test_registered_queries_of_ranges(spark):
    for name in ("sink_range", "event_shards", "first_firing_index"):
        assert entry.queries()[name](spark, FOLDER).count() > 0
