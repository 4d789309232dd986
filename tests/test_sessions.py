"""Attribution and purchase cleaning on hand-made event logs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.channels import channel_of
from tidemark.operators import sessions as se
from tidemark.sources import events as ev
from tidemark.sources import samples

SCHEMA = (
    "event_date date, event_timestamp long, event_name string, user_pseudo_id string, "
    "ga_session_id long, source string, medium string, transaction_id string, "
    "purchase_revenue double"
)
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def event(
    ts, name="page_view", user="u", session=1, source=None, medium=None, txn=None, rev=None, day=D1
):
    return (day, ts, name, user, session, source, medium, txn, rev)


def buy(ts, txn=None, rev=None, **more):
    return event(ts, "purchase", txn=txn, rev=rev, **more)


def log(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def by_session(spark, *rows):
    out = se.purchases_by_session(log(spark, *rows)).collect()
    return {
        (r["user_pseudo_id"], r["ga_session_id"]): (
            r["purchases"],
            r["revenue"],
            r["purchases_missing_revenue"],
            r["duplicate_purchase_events"],
        )
        for r in out
    }


CHANNELS = [
    ("google", "cpc", "paid_search"),
    ("google", "CPC", "paid_search"),
    ("google", "organic", "organic_search"),
    (None, "organic", "organic_search"),
    ("<Other>", "referral", "referral"),
    ("shop.example", "referral", "referral"),
    ("(direct)", "(none)", "direct"),
    ("x", "(none)", "other"),
    ("Partners", "affiliate", "other"),
    ("Newsletter", "email", "other"),
    (None, None, "unknown"),
    ("<Other>", "<Other>", "unknown"),
    ("<Other>", "<other>", "other"),
    ("(data deleted)", "(data deleted)", "unknown"),
    ("x", "(not set)", "unknown"),
    ("x", "NULL", "unknown"),
    ("x", "", "unknown"),
]


def test_channel_rules(spark):
    rows = spark.createDataFrame(CHANNELS, "source string, medium string, expected string")
    out = rows.withColumn("channel", channel_of(F.col("source"), F.col("medium")))
    assert out.where("channel <> expected").count() == 0


def test_session_takes_first_day_and_first_touch(spark):
    rows = log(
        spark,
        event(30, "view_item", source="google", medium="organic", day=D2),
        event(10, "session_start"),
        event(20, source=None, medium="cpc"),
        event(40, "add_to_cart", source="x", medium="email", day=D2),
    )
    session = se.sessionize(rows).first()
    assert session["session_date"] == D1
    assert session["channel"] == "paid_search"
    assert (session["has_view_item"], session["has_add_to_cart"]) == (True, True)
    assert (session["has_begin_checkout"], session["has_purchase"]) == (False, False)
    pair = se.first_touch(rows).first()
    assert (pair["source"], pair["medium"], pair["channel"]) == (None, "cpc", "paid_search")


def test_session_without_touch_is_unknown(spark):
    assert se.sessionize(log(spark, event(1))).first()["channel"] == "unknown"


def test_equal_timestamps_resolve_alike_in_both_attributions(spark):
    rows = [
        event(5, source="a", medium="email"),
        event(5, source="b", medium="organic"),
        event(5, source="c", medium="referral"),
    ]
    for order in (rows, rows[::-1]):
        frame = log(spark, *order).repartition(3)
        assert se.sessionize(frame).first()["channel"] == "organic_search"
        assert se.first_touch(frame).first()["channel"] == "organic_search"


def test_null_session_ids_form_one_group_per_user(spark):
    rows = log(spark, event(1, session=None), event(2, session=None), event(3, user="v", session=None))
    assert se.sessionize(rows).count() == 2


def test_transaction_counts_once_over_all_sessions(spark):
    got = by_session(
        spark,
        buy(10, "t", 5.0, session=1),
        buy(20, "t", 5.0, session=1),
        buy(30, "t", 7.0, session=2),
    )
    # A duplicate is charged to its own session.
    assert got == {("u", 1): (1, 5.0, 0, 1), ("u", 2): (0, None, 0, 1)}


def test_first_firing_without_revenue_loses_the_revenue(spark):
    got = by_session(spark, buy(10, "t", None), buy(20, "t", 9.0))
    assert got == {("u", 1): (0, None, 1, 1)}


def test_late_firing_without_revenue_is_missing_and_duplicate(spark):
    got = by_session(spark, buy(10, "t", 9.0), buy(20, "t", None))
    assert got == {("u", 1): (1, 9.0, 1, 1)}


def test_unusable_ids_always_count_and_empty_text_is_usable(spark):
    got = by_session(
        spark,
        buy(1, None, 1.0),
        buy(2, None, 2.0),
        buy(3, "(not set)", 4.0),
        buy(4, "(not set)", None),
        buy(5, "", 8.0),
        buy(6, "", 8.0),
    )
    assert got == {("u", 1): (4, 15.0, 1, 1)}


def test_identical_firings_count_once(spark):
    assert by_session(spark, buy(1, "t", 3.0), buy(1, "t", 3.0)) == {("u", 1): (1, 3.0, 0, 1)}


def test_firings_agree_with_session_totals(spark):
    rows = log(
        spark,
        buy(10, "t", 5.0, session=1),
        buy(20, "t", 5.0, session=2),
        buy(30, None, 2.0, session=2),
        buy(40, "s", None, session=None),
        buy(50, "s", 3.0, session=None),
    )
    firings = se.purchase_firings(rows).groupBy("ga_session_id").agg(
        F.sum("kept").alias("purchases"),
        F.sum("kept_revenue").alias("revenue"),
        F.sum("missing_revenue").alias("purchases_missing_revenue"),
        F.sum("duplicates").alias("duplicate_purchase_events"),
    )
    columns = firings.columns
    totals = se.purchases_by_session(rows).select(columns)
    assert sorted(map(str, firings.collect())) == sorted(map(str, totals.collect()))


def test_rollup(spark):
    rows = log(
        spark,
        event(1, "view_item", source="google", medium="organic"),
        buy(2, "t", 10.0, day=D2),
        event(1, "view_item", user="v", session=7, source="google", medium="organic"),
        event(9, "view_item", user="v", session=8, source="google", medium="organic"),
        buy(10, "t", 10.0, user="v", session=8),
        buy(3, None, 4.0, user="w", session=None),
    )
    got = {(r["date"], r["channel"]): r for r in se.daily_rollup(rows).collect()}
    organic = got[D1, "organic_search"]
    assert (organic["sessions"], organic["users"]) == (3, 2)
    assert (organic["view_item_sessions"], organic["purchase_sessions"]) == (3, 2)
    assert (organic["purchases"], organic["revenue"]) == (1, 10.0)
    assert organic["duplicate_purchase_events"] == 1
    # A NULL session id never matches its purchases, but the session itself counts.
    unknown = got[D1, "unknown"]
    assert (unknown["sessions"], unknown["purchases"], unknown["revenue"]) == (1, 0, 0.0)
    assert unknown["purchase_sessions"] == 1
    assert len(got) == 2


def test_rollup_agrees_with_brute_force_under_heavy_skew(spark):
    """One user, one session and one transaction id hold a third of all rows each."""
    n = 3000
    i = F.col("id")
    third = i % 3 == 0
    rows = spark.range(n).select(
        F.lit(D1).alias("event_date"),
        ((i * 7919) % 100003).alias("event_timestamp"),
        F.when(i % 2 == 0, "purchase").otherwise("view_item").alias("event_name"),
        F.when(third, "hot").otherwise(F.concat(F.lit("u"), i % 50)).alias("user_pseudo_id"),
        F.when(third, 1).otherwise(i % 11).cast("long").alias("ga_session_id"),
        F.when(i % 5 == 0, "google").alias("source"),
        F.when(i % 5 == 0, F.when(i % 10 == 0, "cpc").otherwise("organic")).alias("medium"),
        F.when(third, "test").otherwise(F.concat(F.lit("t"), i % 400)).alias("transaction_id"),
        F.when(i % 13 != 0, (i % 17).cast("double")).alias("purchase_revenue"),
    )
    events = [r.asDict() for r in rows.collect()]
    events.sort(key=lambda e: e["event_timestamp"])
    first_seen, sessions = set(), {}
    for e in events:
        key = (e["user_pseudo_id"], e["ga_session_id"])
        s = sessions.setdefault(key, {"channel": None, "n": 0, "rev": 0.0, "miss": 0, "dup": 0})
        if s["channel"] is None and e["medium"]:
            s["channel"] = {"cpc": "paid_search", "organic": "organic_search"}[e["medium"]]
        if e["event_name"] != "purchase":
            continue
        s["miss"] += e["purchase_revenue"] is None
        if e["transaction_id"] in first_seen:
            s["dup"] += 1
        else:
            first_seen.add(e["transaction_id"])
            s["n"] += e["purchase_revenue"] is not None
            s["rev"] += e["purchase_revenue"] or 0.0
    expected = {}
    for (user, _), s in sessions.items():
        e = expected.setdefault(s["channel"] or "unknown", [0, set(), 0, 0.0, 0, 0])
        e[0] += 1
        e[1].add(user)
        for at, field in enumerate(("n", "rev", "miss", "dup"), start=2):
            e[at] += s[field]
    got = {
        r["channel"]: [
            r["sessions"], r["users"], r["purchases"], r["revenue"],
            r["purchases_missing_revenue"], r["duplicate_purchase_events"],
        ]
        for r in se.daily_rollup(rows.repartition(7)).collect()
    }
    assert got == {k: [v[0], len(v[1]), *v[2:]] for k, v in expected.items()}


def test_nested_events_give_the_same_rollup(spark):
    flat = samples.events(spark, "/root/testdata/sf0.001")
    nested = ev.flatten_events(samples.nested_events(flat))
    a = se.daily_rollup(flat).orderBy("date", "channel").collect()
    b = se.daily_rollup(nested).orderBy("date", "channel").collect()
    assert a == b


def test_events_of_a_range_prune_partitions(spark, tmp_path):
    flat = samples.events(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "events")
    samples.nested_events(flat).write.partitionBy("event_date").parquet(path)
    some = ev.read_events(spark, path, date(2024, 1, 3), date(2024, 1, 5))
    assert {r[0] for r in some.select("event_date").distinct().collect()} == {
        "20240103",
        "20240104",
        "20240105",
    }
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_date_range_includes_both_ends(spark, kind):
    stamps = ["2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-03 23:59:59", "2024-01-04 00:00:00"]
    rows = spark.createDataFrame([(s,) for s in stamps], "t string")
    typed = rows.select(F.col("t").cast("timestamp").cast(kind).alias("t"))
    assert ev.in_date_range(typed, "t", date(2024, 1, 2), date(2024, 1, 3)).count() == 2
