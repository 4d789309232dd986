"""Row validation with quarantine, and the data profile."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as fv
from tidemark.functions.calendar import iso_week_label
from tidemark.functions.numbers import money_sum, null_if_nan, safe_divide, shared
from tidemark.model import DAILY, SPEND, Settings
from tidemark.sources.tables import StructureError

KEY = ("date", "channel")


@dataclass(frozen=True)
class Rule:
    """A row fails when the condition is true; NULL is not a failure."""

    reason: str
    fails: Column


def _date_rule(start: date, end: date) -> Rule:
    outside = ~F.col("date").between(F.lit(start), F.lit(end))
    return Rule(fv.REASON_DATE.format(start=start, end=end), outside)


def _negative(column: str) -> Rule:
    return Rule(fv.REASON_NEGATIVE.format(column=column), F.col(column) < 0)


def _missing(column: str) -> Rule:
    return Rule(fv.REASON_MISSING.format(column=column), F.col(column).isNull())


def _not_among(reason: str, labels: Sequence[str]) -> Rule:
    """A NULL channel is not a failure here."""
    channel = F.col("channel")
    return Rule(reason, ~channel.isin(*labels) if labels else channel.isNotNull())


def daily_rules(settings: Settings) -> list[Rule]:
    measures = ["revenue", *fv.DAILY_COUNTS]
    return [
        _date_rule(settings.start_date, settings.end_date),
        _not_among(fv.REASON_LABEL, settings.channels),
        *[_negative(c) for c in measures],
        *[_missing(c) for c in (*KEY, *measures)],
        *[
            Rule(fv.REASON_ABOVE_SESSIONS.format(column=c), F.col(c) > F.col("sessions"))
            for c in fv.NEVER_ABOVE_SESSIONS
        ],
    ]


def spend_rules(settings: Settings) -> list[Rule]:
    rules = [
        _date_rule(settings.start_date, settings.end_date),
        _not_among(fv.REASON_NOT_PAID, settings.paid_channels),
        _negative("spend"),
        *[_missing(c) for c in (*KEY, "spend")],
    ]
    if settings.require_simulated_spend:
        rules += [Rule(fv.REASON_NOT_SIMULATED, ~F.col("is_simulated")), _missing("is_simulated")]
    return rules


_CASTABLE = (T.NumericType, T.StringType, T.BooleanType, T.DatetimeType)


def _value(df: DataFrame, field: T.StructField) -> tuple[Column, Column]:
    """A column as it is, with NaN as NULL, and in its wanted type, NULL where it cannot be read so."""
    have = df.schema[field.name].dataType
    value = F.col(field.name)
    if isinstance(have, (T.DoubleType, T.FloatType)):
        value = null_if_nan(value)
    return value, value if have == field.dataType else value.try_cast(field.dataType)


def _convertible(df: DataFrame, schema: T.StructType) -> list[T.StructField]:
    """Fields that are there and whose type is a column type."""
    return [f for f in schema if f.name in df.columns and isinstance(df.schema[f.name].dataType, _CASTABLE)]


def structure_faults(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, fault, cells, example): everything that keeps a table from having the schema.

    A row for each missing column, each column of a type that has no cast, and each column with cells that
    cannot be read in its type: how many, and the smallest as text. Cells are looked at in one aggregate over
    all columns, and only where the type differs.
    """
    session = df.sparkSession
    known: list[tuple] = []
    for f in schema:
        if f.name not in df.columns:
            known.append((f.name, "missing column", None, None))
        elif not isinstance(df.schema[f.name].dataType, _CASTABLE):
            known.append((f.name, f"{df.schema[f.name].dataType.simpleString()} is not a column type", None, None))
    faults = session.createDataFrame(known, "column string, fault string, cells bigint, example string")
    read_anew = [f for f in _convertible(df, schema) if df.schema[f.name].dataType != f.dataType]
    if not read_anew:
        return faults
    measures, entries = [], []
    for i, f in enumerate(read_anew):
        value, converted = _value(df, f)
        wrong = value.isNotNull() & converted.isNull()
        measures += [F.count_if(wrong).alias(f"_n{i}"), F.min(F.when(wrong, value.cast("string"))).alias(f"_x{i}")]
        fault = F.lit(f"not a {f.dataType.simpleString()}")
        entries.append(F.struct(F.lit(f.name).alias("column"), fault.alias("fault"), F.col(f"_n{i}").alias("cells"), F.col(f"_x{i}").alias("example")))
    found = df.agg(*measures).select(F.inline(F.array(*entries))).where("cells > 0")
    return faults.unionByName(found)


def conform(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Coerce the schema's columns; extra columns pass through.

    A missing column, a type that has no cast and values that cannot be read as their type mean that the
    extract is broken, not a row: all of them are raised at once. A table that has the types costs no job.
    """
    convertible = _convertible(df, schema)
    if len(convertible) < len(schema) or any(df.schema[f.name].dataType != f.dataType for f in convertible):
        place = {c: i for i, c in enumerate(schema.fieldNames())}
        if faults := sorted(structure_faults(df, schema).collect(), key=lambda r: place[r["column"]]):
            cells = {r["column"]: f" ({r['cells']} cells, such as {r['example']!r})" if r["cells"] else "" for r in faults}
            raise StructureError(f"{name}: " + "; ".join(f"{r['column']}: {r['fault']}{cells[r['column']]}" for r in faults))
    columns = {f.name: _value(df, f)[1] for f in schema if df.schema[f.name].dataType != f.dataType or isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(columns) if columns else df


def flag_rows(df: DataFrame, rules: Sequence[Rule], key: Sequence[str] = KEY) -> DataFrame:
    """Add ``reason``: the failed rules, sorted and joined, or NULL for a clean row.

    The rows are read once. Equal rows become one with their number, which combines before the shuffle,
    and different rows of one key are dealt by their whole content: a key with a third of all rows is spread
    over all tasks, or is few rows. That one shuffle is read twice, to count the rows of each key and to
    give them back their verdict. Only repeated keys come back; where they are too many to
    broadcast, adaptive execution can split a key in the join. Last, a row is put out as often as it was there.
    """
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_equal"))
    counted = rows.groupBy(*key).agg(F.sum("_equal").alias("_copies"))
    repeated = counted.where("_copies > 1").select(*[F.col(c).alias(f"_key_{c}") for c in key], "_copies")
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key]
    )
    joined = rows.join(repeated, same, "left")
    every_rule = [*rules, Rule(fv.REASON_DUPLICATE, F.col("_copies").isNotNull())]
    failed = [F.when(rule.fails, F.lit(rule.reason)) for rule in every_rule]
    reasons = F.sort_array(F.array_distinct(F.array_compact(F.array(*failed))))
    reason = F.when(F.size(reasons) > 0, F.array_join(reasons, "; "))
    flagged = joined.withColumn("reason", reason)
    return flagged.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_equal"))).select(*df.columns, "reason")


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason, quarantined rows with it)"""
    return (
        flagged.where(F.col("reason").isNull()).drop("reason"),
        flagged.where(F.col("reason").isNotNull()),
    )


def validate_daily(daily: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    return split(flag_rows(conform(daily, DAILY, "daily"), daily_rules(settings)))


def spend_schema(settings: Settings) -> T.StructType:
    """The simulated flag is only required while its rule is on."""
    return SPEND if settings.require_simulated_spend else T.StructType(SPEND.fields[:3])


def validate_spend(spend: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    return split(flag_rows(conform(spend, spend_schema(settings), "spend"), spend_rules(settings)))


def quarantine_summary(quarantined: DataFrame) -> DataFrame:
    """Rows per reason."""
    return quarantined.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


# --- profile ---------------------------------------------------------------------------


def _add(column: str) -> Column:
    return money_sum(F.col(column)) if column == "revenue" else F.sum(column)


def profile(daily: DataFrame, start: date, end: date) -> DataFrame:
    """One row: size, duplicate keys, date coverage and totals."""
    sums = ["sessions", "purchases", "revenue", *fv.DAILY_COUNTS[7:]]
    # Shrink to one row per key first, so that the distinct counts expand few rows.
    keys = daily.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_rows"), *[_add(c).alias(c) for c in sums]
    )
    return keys.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.count_distinct("channel").alias("channels"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_distinct("date").alias("days"),
        F.lit((end - start).days + 1).cast("bigint").alias("expected_days"),
        *[_add(c).alias(c) for c in sums],
    )


def null_rates(df: DataFrame) -> DataFrame:
    """Share of missing values per column, in one pass over the rows."""

    rates = df.agg(*[F.avg(_is_missing(df, c).cast("int")).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("null_rate")) for c in df.columns]
    return rates.select(F.inline(F.array(*pairs)))


def channel_shares(daily: DataFrame) -> DataFrame:
    """Sessions, revenue and their shares per channel."""
    by_channel = daily.groupBy("channel").agg(
        *[_add(c).alias(c) for c in ("sessions", "revenue")]
    )
    # The grand totals add up the rows of channels, whose shuffle is reused: the table is read once.
    grand = by_channel.agg(F.struct(_add("sessions").alias("sessions"), _add("revenue").alias("revenue"))).scalar()
    return by_channel.withColumns(
        {
            "session_share": safe_divide(F.col("sessions"), grand["sessions"]),
            "revenue_share": safe_divide(F.col("revenue"), grand["revenue"]),
        }
    )


def _is_missing(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def profile_report(daily: DataFrame, start: date, end: date) -> DataFrame:
    """(section, name, measure, value): the summary, null rates and channel shares of one reading of the table.

    A first aggregate leaves a row for each key, which combines before the shuffle. Grouping sets over those rows give the
    days, the channels and the whole in a second one, whose few rows all sections read from one shuffle.
    Dates are day numbers since 1970-01-01.
    """
    sums = ["sessions", "purchases", "revenue", *fv.DAILY_COUNTS[7:]]
    columns = daily.columns
    missing = [F.count_if(_is_missing(daily, c)).alias(f"_null{i}") for i, c in enumerate(columns)]
    keys = daily.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_rows"), *[_add(c).alias(c) for c in sums], *missing)
    sets = keys.groupingSets([["date"], ["channel"], []], *KEY).agg(
        F.grouping_id().alias("_level"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_rows"),
        *[_add(c).alias(c) for c in sums],
        *[F.sum(f"_null{i}").alias(f"_null{i}") for i in range(len(columns))],
    )
    # Bits of the grouping id: date is grouped away in 2 and 3, the channel in 1 and 3.
    sets = shared(sets)
    of_day, of_channel, of_all = (F.col("_level") == k for k in (1, 2, 3))

    def number(value: Column) -> Column:
        return value.cast("double").alias("value")

    def entry(name: str, measure: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(measure).alias("measure"), number(value)).alias("entry")

    def whole(name: str) -> Column:
        return F.max(F.when(of_all, F.col(name)))

    day = F.when(of_day, F.unix_date("date"))
    figures = {
        "rows": F.coalesce(whole("rows"), F.lit(0)),
        "duplicate_rows": F.coalesce(whole("duplicate_rows"), F.lit(0)),
        "channels": F.count(F.when(of_channel, F.col("channel"))),
        "days": F.count(day),
        "expected_days": F.lit((end - start).days + 1),
        "first_date": F.min(day),
        "last_date": F.max(day),
        **{c: whole(c) for c in sums},
    }
    names = {f"_{i}": name for i, name in enumerate(figures)}
    lost = [f"_null{i}" for i in range(len(columns))]
    one = sets.agg(*[value.alias(alias) for alias, value in zip(names, figures.values(), strict=True)], *[whole(c).alias(c) for c in lost])
    entries = [F.struct(F.lit("summary").alias("section"), entry(name, "value", F.col(alias))) for alias, name in names.items()]
    entries += [F.struct(F.lit("nulls").alias("section"), entry(c, "null_rate", safe_divide(F.col(n), F.col("_0")))) for c, n in zip(columns, lost, strict=True)]
    of_table = one.select(F.explode(F.array(*entries)).alias("_e")).select("_e.section", "_e.entry.*")
    grand = sets.where(of_all).select(F.struct("sessions", "revenue")).scalar()
    by_channel = sets.where(of_channel).withColumn("_all", grand)
    named = F.coalesce("channel", F.lit("")).alias("name")
    shares = [
        F.struct(named, F.lit(measure).alias("measure"), number(value))
        for c in ("sessions", "revenue")
        for measure, value in ((c, F.col(c)), (f"{c}_share", safe_divide(F.col(c), F.col(f"_all.{c}"))))
    ]
    channels = by_channel.select(F.lit("channels").alias("section"), F.inline(F.array(*shares)))
    return of_table.unionByName(channels)


def weekly_spend(spend: DataFrame) -> DataFrame:
    """Spend per channel and ISO week, with the largest planted multiplier if there is one."""
    planted = (
        [F.max("planted_multiplier").alias("planted")]
        if "planted_multiplier" in spend.columns
        else []
    )
    week = iso_week_label(F.col("date")).alias("week")
    return spend.groupBy("channel", week).agg(money_sum(F.col("spend")).alias("spend"), *planted)
