"""Every validation rule, breaking one row at a time."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.model import DAILY, Settings
from tidemark.operators import kpis
from tidemark.operators import quality as q
from tidemark.sources import tables

SETTINGS = Settings()
GOOD = (date(2020, 11, 2), "direct", 100, 80, 40, 10, 6, 3, 3, 150.0, 0, 0)
OTHER = (date(2020, 11, 2), "paid_search", 50, 40, 20, 5, 3, 2, 2, 99.5, 1, 0)


def daily(spark, **broken):
    row = dict(zip(DAILY.fieldNames(), OTHER, strict=True)) | broken
    return spark.createDataFrame([GOOD, tuple(row.values())], DAILY)


CASES = [
    *[
        ({c: -1}, f"{c}: negative value")
        for c in DAILY.fieldNames()[2:]
        if c not in ("sessions", "revenue")
    ],
    ({"revenue": -5.0}, "revenue: negative value"),
    ({"purchases": 51}, "purchases > sessions"),
    ({"purchase_sessions": 51}, "purchase_sessions > sessions"),
    ({"view_item_sessions": 51}, "view_item_sessions > sessions"),
    ({"users": 51}, "users > sessions"),
    ({"date": date(2020, 10, 31)}, "date: date outside 2020-11-01..2021-01-31"),
    ({"date": date(2021, 2, 1)}, "date: date outside 2020-11-01..2021-01-31"),
    ({"channel": "tiktok"}, "channel: unknown channel label"),
    ({"revenue": None}, "revenue: missing value"),
    ({"revenue": float("nan")}, "revenue: missing value"),
    ({"revenue": -1.0, "purchases": 99}, "purchases > sessions; revenue: negative value"),
]


def test_clean_rows_pass(spark):
    valid, bad = q.validate_daily(daily(spark), SETTINGS)
    assert (valid.count(), bad.count()) == (2, 0)
    assert valid.columns == DAILY.fieldNames()


def test_each_broken_row_is_quarantined_with_its_reason(spark):
    for broken, reason in CASES:
        valid, bad = q.validate_daily(daily(spark, **broken), SETTINGS)
        assert [r["channel"] for r in valid.collect()] == ["direct"], reason
        assert [r["reason"] for r in bad.collect()] == [reason]


def test_negative_sessions_break_several_rules(spark):
    reason = q.validate_daily(daily(spark, sessions=-1), SETTINGS)[1].first()["reason"]
    assert "sessions: negative value" in reason.split("; ")
    assert reason.split("; ") == sorted(reason.split("; "))


def test_every_copy_of_a_key_is_quarantined(spark):
    rows = daily(spark).union(daily(spark).limit(1))
    valid, bad = q.validate_daily(rows, SETTINGS)
    assert valid.count() == 1
    assert [r["reason"] for r in bad.collect()] == ["duplicate (date, channel)"] * 2


def test_null_keys_are_copies_of_each_other(spark):
    rows = daily(spark, channel=None).where("channel IS NULL")
    reasons = {r["reason"] for r in q.validate_daily(rows.union(rows), SETTINGS)[1].collect()}
    assert reasons == {"channel: missing value; duplicate (date, channel)"}


def test_text_columns_are_coerced(spark):
    text = daily(spark).select(*[F.col(c).cast("string").alias(c) for c in DAILY.fieldNames()])
    valid, _ = q.validate_daily(text, SETTINGS)
    assert [f.dataType for f in valid.schema] == [f.dataType for f in DAILY]
    assert valid.count() == 2


def test_all_faults_of_a_table_are_raised_at_once(spark):
    text = daily(spark).select(*[F.col(c).cast("string").alias(c) for c in DAILY.fieldNames()])
    broken = text.drop("users").withColumns(
        {"sessions": F.lit("many"), "date": F.when(F.col("channel") == "direct", "2020-13-01").otherwise(F.col("date")), "revenue": F.array("revenue")}
    )
    found = {r["column"]: tuple(r)[1:] for r in q.structure_faults(broken, DAILY).collect()}
    assert found == {
        "users": ("missing column", None, None), "revenue": ("array<string> is not a column type", None, None),
        "sessions": ("not a bigint", 2, "many"), "date": ("not a date", 1, "2020-13-01"),
    }
    with pytest.raises(tables.StructureError) as raised:
        q.validate_daily(broken, SETTINGS)
    said = str(raised.value)
    assert said.startswith("daily: date: not a date (1 cells, such as '2020-13-01'); sessions: not a bigint (2 cells, such as 'many')")
    assert "users: missing column" in said and "revenue: array<string> is not a column type" in said


def test_readable_text_has_no_faults(spark):
    text = daily(spark, revenue=None).select(*[F.col(c).cast("string").alias(c) for c in DAILY.fieldNames()])
    assert q.structure_faults(text, DAILY).collect() == []
    assert q.structure_faults(text.limit(0), DAILY).collect() == []
    valid, bad = q.validate_daily(text, SETTINGS)
    assert (valid.count(), [r["reason"] for r in bad.collect()]) == (1, ["revenue: missing value"])


def test_missing_or_nested_columns_raise_at_once(spark):
    with pytest.raises(tables.StructureError, match="revenue"):
        q.validate_daily(daily(spark).drop("revenue"), SETTINGS)
    with pytest.raises(tables.StructureError, match="users"):
        q.validate_daily(daily(spark).withColumn("users", F.array("users")), SETTINGS)


@pytest.mark.parametrize("copies", [1, 2, 500])
def test_rows_are_read_once_and_come_back_as_often_as_they_were(spark, tmp_path, copies):
    """Equal copies, different rows of one key, and null keys, in extra columns too."""
    many = daily(spark).unionByName(daily(spark).where("channel = 'direct'").withColumn("users", F.lit(7).cast("long")))
    for _ in range(2):
        many = many.unionByName(daily(spark).withColumn("date", F.lit(None).cast("date")).where("channel = 'direct'"))
    equal = daily(spark).where("channel = 'direct'").withColumns({"date": F.lit(date(2020, 11, 5)), "_i": F.explode(F.sequence(F.lit(1), F.lit(copies)))})
    many = many.unionByName(equal.drop("_i")).withColumns({"note": F.lit(None).cast("string"), "tags": F.array(F.lit("x"))})
    many.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    flagged = q.flag_rows(q.conform(stored, DAILY), q.daily_rules(SETTINGS))
    rows = flagged.collect()
    assert flagged.columns == [*stored.columns, "reason"] and len(rows) == stored.count()
    assert sorted(str(r[:-1]) for r in rows) == sorted(str(tuple(r)) for r in stored.collect())
    twice = [r for r in rows if r["reason"] and "duplicate" in r["reason"]]
    assert len(twice) == 4 + (copies if copies > 1 else 0)
    text = flagged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan") == 1 and "Window" not in text


def test_profile_report_reads_once_and_agrees(spark, tmp_path):
    daily(spark, revenue=None, channel=None).unionByName(daily(spark)).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    report = q.profile_report(stored, date(2020, 11, 1), date(2020, 11, 3))
    got = {(r["section"], r["name"], r["measure"]): r["value"] for r in report.collect()}
    text = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan") == 1
    summary = q.profile(stored, date(2020, 11, 1), date(2020, 11, 3)).first().asDict()
    for name, value in summary.items():
        number = (value - date(1970, 1, 1)).days if isinstance(value, date) else value
        assert got["summary", name, "value"] == number, name
    for r in q.null_rates(stored).collect():
        assert got["nulls", r["column"], "null_rate"] == r["null_rate"]
    for r in q.channel_shares(stored).collect():
        for c in ("sessions", "revenue", "session_share", "revenue_share"):
            assert got["channels", r["channel"] or "", c.replace("session_", "sessions_")] == r[c]
    empty = {(r["section"], r["name"]): r["value"] for r in q.profile_report(stored.limit(0), date(2020, 11, 1), date(2020, 11, 3)).collect()}
    assert empty["summary", "rows"] == 0 and empty["summary", "expected_days"] == 3 and empty["nulls", "users"] is None


def spend(spark, **broken):
    first = (date(2020, 11, 2), "paid_search", 50.0, True)
    row = {"date": date(2020, 11, 3), "channel": "paid_search", "spend": 48.2, "is_simulated": True}
    schema = "date date, channel string, spend double, is_simulated boolean"
    return spark.createDataFrame([first, tuple((row | broken).values())], schema)


@pytest.mark.parametrize(
    ("broken", "reason"),
    [
        ({"spend": -0.01}, "spend: negative value"),
        ({"is_simulated": False}, "is_simulated: is_simulated is not true"),
        ({"channel": "organic_search"}, "channel: not a paid channel"),
        ({"date": date(2021, 2, 1)}, "date: date outside 2020-11-01..2021-01-31"),
        ({"date": date(2020, 11, 2)}, "duplicate (date, channel)"),
    ],
)
def test_spend_rules(spark, broken, reason):
    bad = q.validate_spend(spend(spark, **broken), SETTINGS)[1]
    assert {r["reason"] for r in bad.collect()} == {reason}


def test_real_spend_is_accepted_when_the_rule_is_off(spark):
    real = Settings(require_simulated_spend=False)
    assert q.validate_spend(spend(spark, is_simulated=False), real)[0].count() == 2
    assert q.validate_spend(spend(spark).drop("is_simulated"), real)[0].count() == 2


def test_summary(spark):
    bad = q.validate_daily(daily(spark, revenue=-1.0), SETTINGS)[1]
    rows = q.quarantine_summary(bad).collect()
    assert [(r["reason"], r["rows"]) for r in rows] == [("revenue: negative value", 1)]


def test_quarantine_file_is_always_written(spark, tmp_path):
    _, bad = q.validate_daily(daily(spark, revenue=-1.0), SETTINGS)
    path = tables.write_quarantine(bad, "daily", str(tmp_path))
    read = spark.read.option("header", True).csv
    assert [r["reason"] for r in read(path).collect()] == ["revenue: negative value"]
    _, none = q.validate_daily(daily(spark), SETTINGS)
    path = tables.write_quarantine(none, "daily", str(tmp_path))
    assert read(path).count() == 0
    assert "reason" in read(path).columns


def test_profile(spark):
    rows = [
        (date(2020, 11, 1), "direct", 30, 1, 50.0, 0, 0),
        (date(2020, 11, 1), "unknown", 10, 0, 0.0, 1, 0),
        (date(2020, 11, 2), "direct", 40, 1, 50.0, 0, 2),
        (date(2020, 11, 2), "direct", 20, 0, 0.0, 0, 0),
    ]
    schema = (
        "date date, channel string, sessions long, purchases long, revenue double, "
        "purchases_missing_revenue long, duplicate_purchase_events long"
    )
    table = spark.createDataFrame(rows, schema)
    p = q.profile(table, date(2020, 11, 1), date(2020, 11, 3)).first()
    assert (p["rows"], p["channels"], p["duplicate_rows"]) == (4, 2, 1)
    assert (p["days"], p["expected_days"], p["sessions"], p["revenue"]) == (2, 3, 100, 100.0)
    assert (p["purchases_missing_revenue"], p["duplicate_purchase_events"]) == (1, 2)
    shares = {r["channel"]: r for r in q.channel_shares(table).collect()}
    assert (shares["direct"]["session_share"], shares["direct"]["revenue_share"]) == (0.9, 1.0)
    assert (shares["unknown"]["session_share"], shares["unknown"]["revenue_share"]) == (0.1, 0.0)


def test_null_rates_count_nan(spark):
    rows = spark.createDataFrame([("a", 1.0), (None, float("nan")), ("b", None), ("c", 2.0)], "k string, v double")
    assert {r["column"]: r["null_rate"] for r in q.null_rates(rows).collect()} == {"k": 0.25, "v": 0.5}


def test_weekly_spend_marks_planted_weeks(spark):
    rows = spark.createDataFrame(
        [(date(2021, 1, 11), "p", 1.5, 2.0), (date(2021, 1, 12), "p", 2.0, 1.0), (date(2021, 1, 4), "p", 1.0, 1.0)],
        "date date, channel string, spend double, planted_multiplier double",
    )
    got = {r["week"]: (r["spend"], r["planted"]) for r in q.weekly_spend(rows).collect()}
    assert got == {"2021-W02": (3.5, 2.0), "2021-W01": (1.0, 1.0)}


def test_daily_and_spend_files_round_trip(spark, tmp_path):
    tables.write_daily(daily(spark), str(tmp_path / "d"))
    assert sorted(tables.read_daily(spark, str(tmp_path / "d")).collect()) == sorted(daily(spark).collect())
    tables.write_spend(spend(spark), str(tmp_path / "s"))
    assert tables.read_spend(spark, str(tmp_path / "s")).count() == 2
    with pytest.raises(tables.StructureError, match="missing columns"):
        tables.write_daily(daily(spark).drop("users"), str(tmp_path / "x"))


def test_without_paid_channels_every_spend_row_is_refused(spark):
    nothing = Settings(paid_channels=())
    bad = q.validate_spend(spend(spark), nothing)[1]
    assert {r["reason"] for r in bad.collect()} == {"channel: not a paid channel"}
    joined = kpis.join_spend(daily(spark), spend(spark), nothing.paid_channels)
    assert joined.where("is_paid OR spend IS NOT NULL").count() == 0
