"""The sample star schema seen through the reporting data model.

``events`` becomes a raw event log, ``orders`` with ``lineitem`` a long daily table, and
``documents`` the written texts. The rules are plain column expressions so that another
engine can repeat them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import iso_week_label
from tidemark.sources.events import in_date_range

# purchase stands first: a filter on it then folds to one comparison that reaches the scan.
EVENT_NAMES = {
    "purchase": "purchase",
    "view": "view_item",
    "click": "add_to_cart",
    "signup": "begin_checkout",
}
PRIORITY_CHANNELS = {
    "1-URGENT": "paid_search",
    "2-HIGH": "organic_search",
    "3-MEDIUM": "referral",
    "4-NOT SPECIFIED": "direct",
    "5-LOW": "unknown",
}
MONEY = "decimal(18,4)"
ASCII, ARABIC_INDIC, DEVANAGARI = ("".join(chr(zero + i) for i in range(10)) for zero in (0x30, 0x660, 0x966))


def _pick(column: Column, mapping: dict[str, str], otherwise: Column) -> Column:
    out = None
    for key, value in mapping.items():
        out = F.when(column == key, value) if out is None else out.when(column == key, value)
    return out.otherwise(otherwise)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(
    spark: SparkSession, folder: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """``events`` as flat analytics events."""
    log = table(spark, folder, "events")
    if start and end:
        log = in_date_range(log, "ts", start, end)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    log = log.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k, is_purchase = F.col("k"), F.col("event_type") == "purchase"
    source = (
        F.when(k < 10, None)
        .when(k < 15, "<Other>")
        .when(k < 55, "google")
        .when(k < 80, "partner.example")
        .when(k < 92, "(direct)")
        .otherwise("newsletter")
    )
    medium = (
        F.when(k < 10, None)
        .when(k < 15, "<Other>")
        .when(k < 25, F.when(k % 2 == 1, "CPC").otherwise("cpc"))
        .when(k < 55, "organic")
        .when(k < 80, "referral")
        .when(k < 92, "(none)")
        .otherwise("email")
    )
    transaction = (
        F.when(k < 10, None)
        .when(k < 15, "(not set)")
        .otherwise(F.concat_ws("-", F.col("user_id"), F.floor(k / 10)))
    )
    return log.select(
        F.to_date("ts").alias("event_date"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        _pick(F.col("event_type"), EVENT_NAMES, F.lit("page_view")).alias("event_name"),
        F.col("user_id").alias("user_pseudo_id"),
        # Days that start at 18:00, so that sessions cross midnight.
        F.floor((seconds + 21600) / 86400).alias("ga_session_id"),
        source.alias("source"),
        medium.alias("medium"),
        F.when(is_purchase, transaction).alias("transaction_id"),
        F.when(is_purchase & (k % 11 != 0), F.col("value")).alias("purchase_revenue"),
    )


def nested_events(flat: DataFrame) -> DataFrame:
    """Flat events packed the way an analytics export nests them."""

    def param(key: str, text: Column, number: Column) -> Column:
        value = F.struct(text.alias("string_value"), number.alias("int_value"))
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    params = F.array(
        param("ga_session_id", no_text, F.col("ga_session_id")),
        param("source", F.col("source"), no_number),
        param("medium", F.col("medium"), no_number),
    )
    return flat.select(
        F.date_format("event_date", "yyyyMMdd").alias("event_date"),
        "event_timestamp",
        "event_name",
        F.col("user_pseudo_id").cast("string").alias("user_pseudo_id"),
        # A parameter that was not sent is absent, not NULL.
        F.filter(
            params,
            lambda p: p["value"]["string_value"].isNotNull()
            | p["value"]["int_value"].isNotNull(),
        ).alias("event_params"),
        F.struct("transaction_id", "purchase_revenue").alias("ecommerce"),
    )


def event_spend(spark: SparkSession, folder: str) -> DataFrame:
    """Daily paid search spend out of the ``error`` events."""
    log = table(spark, folder, "events").where(F.col("event_type") == "error")
    daily = log.groupBy(F.to_date("ts").alias("date")).agg(
        (F.sum(F.col("value").cast(MONEY)) * F.lit("0.5").cast("decimal(2,1)"))
        .cast("double")
        .alias("spend")
    )
    return _as_spend(daily)


def _as_spend(daily: DataFrame) -> DataFrame:
    return daily.select(
        "date",
        F.lit("paid_search").alias("channel"),
        "spend",
        F.lit(True).alias("is_simulated"),
    )


def orders_daily(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` and ``lineitem`` as a daily channel table over several years."""
    items = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("items")
    )
    sold = table(spark, folder, "orders").join(
        items, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    finished = F.col("o_orderstatus") == "F"
    n = F.coalesce(F.col("items"), F.lit(0))
    channel = _pick(F.col("o_orderpriority"), PRIORITY_CHANNELS, F.lit("other"))
    return sold.groupBy(F.to_date("o_orderdate").alias("date"), channel.alias("channel")).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_distinct("o_custkey").alias("users"),
        F.count_if(n >= 1).alias("view_item_sessions"),
        F.count_if(n >= 2).alias("add_to_cart_sessions"),
        F.count_if(n >= 3).alias("begin_checkout_sessions"),
        F.count_if(finished).alias("purchase_sessions"),
        F.count_if(finished).alias("purchases"),
        F.coalesce(
            F.sum(F.when(finished, F.col("o_totalprice").cast(MONEY))), F.lit(0).cast(MONEY)
        )
        .cast("double")
        .alias("revenue"),
        F.count_if(F.col("o_orderstatus") == "P").alias("purchases_missing_revenue"),
        F.lit(0).cast("bigint").alias("duplicate_purchase_events"),
    )


def orders_spend(spark: SparkSession, folder: str) -> DataFrame:
    """Daily paid search spend: the discounts given on its orders."""
    paid = table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    given = paid.join(
        table(spark, folder, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    discount = F.col("l_extendedprice").cast(MONEY) * F.col("l_discount").cast("decimal(4,2)")
    daily = given.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.round(F.sum(discount), 2).cast("double").alias("spend")
    )
    return _as_spend(daily)


def dirty_daily(daily: DataFrame) -> DataFrame:
    """The daily table with faults planted by day number."""
    n = F.unix_date("date")
    copies = F.when(n % 107 == 0, 2).otherwise(1)
    return daily.withColumns(
        {
            "revenue": F.when(n % 109 != 0, F.when(n % 97 == 0, 0 - F.col("revenue")).otherwise(F.col("revenue"))),
            "channel": F.when(n % 101 == 0, "tiktok").otherwise(F.col("channel")),
            "purchases": F.when(n % 103 == 0, F.col("sessions") + 1).otherwise(F.col("purchases")),
            "_copy": F.explode(F.sequence(F.lit(1), copies)),
        }
    ).drop("_copy")


def written_daily(daily: DataFrame) -> DataFrame:
    """The daily table as text, as a spreadsheet gives it, with cells planted that are no date or number."""
    n = F.unix_date("date")
    unreadable = {
        "date": F.when(n % 211 == 0, F.concat(F.col("date").cast("string"), F.lit("?"))),
        "sessions": F.when(n % 97 == 0, "n/a"),
        "purchases": F.when(n % 103 == 0, F.concat(F.col("purchases").cast("string"), F.lit(" pcs"))),
        "revenue": F.when(n % 109 == 0, F.concat(F.lit("about "), F.unix_date("date"))),
    }
    return daily.select(*[F.coalesce(unreadable.get(c, F.lit(None)), F.col(c).cast("string")).alias(c) for c in daily.columns if c != "users"])


def dirty_spend(spend: DataFrame) -> DataFrame:
    n = F.unix_date("date")
    copies = F.when(n % 107 == 0, 2).otherwise(1)
    return spend.withColumns(
        {
            "spend": F.when(n % 97 == 0, 0 - F.col("spend")).otherwise(F.col("spend")),
            "channel": F.when(n % 101 == 0, "direct").otherwise(F.col("channel")),
            "is_simulated": n % 103 != 0,
            "_copy": F.explode(F.sequence(F.lit(1), copies)),
        }
    ).drop("_copy")


def written(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` with the digits of some texts in other scripts."""
    text, k = F.col("text"), F.col("doc_id") % 50
    other = F.when(k == 7, F.translate(text, ASCII, ARABIC_INDIC)).when(k == 8, F.translate(text, ASCII, DEVANAGARI))
    return table(spark, folder, "documents").withColumn("text", other.otherwise(text))


def texts_by_week(spark: SparkSession, folder: str, first_monday: date, weeks: int) -> DataFrame:
    """Every document as a written text about one of ``weeks`` consecutive weeks."""
    monday = F.date_add(F.lit(first_monday), ((F.col("doc_id") % weeks) * 7).cast("int"))
    return written(spark, folder).select(
        F.col("doc_id").alias("text_id"), iso_week_label(monday).alias("week"), "text"
    )


def responses(spark: SparkSession, folder: str, first_monday: date, weeks: int) -> DataFrame:
    """Every document as an attempt at answering: two attempts for each week and variant.

    By document number modulo 9: a plain answer (0), one that states the document's length (1), the
    bare text without JSON (2), an answer whose summary is the whole text (3), an unknown member
    (4), a missing member (5), a number for the summary (6), too few findings (7), a blank check (8).
    """
    n = F.col("doc_id")
    kind, pair = n % 9, F.floor(n / 2)
    length = F.concat(F.lit("The text has "), F.col("n_chars"), F.lit(" characters."))
    plain = F.lit("Traffic was steady. Revenue held. Paid spend is simulated.")
    findings = F.array(
        F.concat(F.lit("Written in "), F.col("lang"), F.lit(".")),
        F.when(kind == 1, length).otherwise("Referral held its share."),
        F.lit("Direct was flat."),
    )
    checks = F.array(
        F.lit("Check tagging."), F.when(kind == 8, " ").otherwise("Check checkout."), F.lit("Check attribution.")
    )
    # A member that is null is left out of the text.
    members = [
        F.when(kind == 7, F.slice(findings, 1, 2)).otherwise(findings).alias("findings"),
        F.when(kind != 5, checks).alias("checks"),
        F.when(kind == 4, "unasked").alias("note"),
    ]
    summary = F.when(kind == 3, F.col("text")).otherwise(plain)
    worded = F.to_json(F.struct(summary.alias("summary"), *members))
    counted = F.to_json(F.struct(F.col("n_chars").alias("summary"), *members))
    fenced = F.concat(F.lit("```json\n"), F.when(kind == 6, counted).otherwise(worded), F.lit("\n```"))
    monday = F.date_add(F.lit(first_monday), ((pair % weeks) * 7).cast("int"))
    return written(spark, folder).select(
        iso_week_label(monday).alias("week"),
        F.floor(pair / weeks).alias("variant"),
        (n % 2 + 1).alias("attempt"),
        "doc_id",
        F.when(kind == 2, F.col("text")).otherwise(fenced).alias("response"),
    )
