"""Written summaries: parsing, shape checks, the template, and the choice between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.formats import (
    capitalised,
    decimals,
    dollars,
    grouped,
    lookup,
    sentence,
    words,
)
from tidemark.functions.text import is_blank, json_object, sentence_count
from tidemark.model import NARRATIVE, Settings
from tidemark.operators.numberguard import check_numbers, fact_numbers

ITEMS = 3
SENTENCES = (3, 5)

# --- responses -----------------------------------------------------------------------------


def parse_responses(responses: DataFrame, text: str = "response") -> DataFrame:
    """Add the parsed narrative and ``problem``, which is NULL for a well-formed answer.

    The answer may be wrapped in other text or a code fence. Unknown, missing or wrongly typed
    members are problems, as is a summary, finding or check that breaks the shape.
    """
    body = json_object(F.col(text))
    expected = F.array(*[F.lit(n) for n in sorted(NARRATIVE.fieldNames())])
    parsed = F.from_json(F.col("_json"), NARRATIVE, {"mode": "PERMISSIVE"})
    valid = F.try_parse_json(F.col("_json")).isNotNull()
    keys = F.coalesce(F.json_object_keys("_json"), F.array().cast("array<string>"))
    n = sentence_count(F.col("narrative.summary"))

    def items_problem(name: str) -> tuple[Column, str]:
        items = F.col(f"narrative.{name}")
        wrong = items.isNull() | (F.size(items) != ITEMS) | F.exists(items, lambda x: x.isNull())
        return F.coalesce(wrong, F.lit(True)), f"{name} must have {ITEMS} items"

    def blank_problem(name: str) -> tuple[Column, str]:
        return F.exists(f"narrative.{name}", is_blank), f"{name} must be non-empty strings"

    def wrong_type(name: str, *kinds: str) -> Column:
        value = F.try_variant_get(F.try_parse_json(F.col("_json")), f"$.{name}", "variant")
        return ~F.schema_of_variant(value).isin(*kinds)

    # An empty list, or one of nulls, has no element type and fails the item count instead.
    texts = ("ARRAY<STRING>", "ARRAY<VOID>")
    checks = [
        (F.col("_json").isNull(), "no JSON object found in the response"),
        (~valid, "not valid JSON"),
        (F.size(F.array_except(keys, expected)) > 0, "unknown member"),
        (F.size(F.array_except(expected, keys)) > 0, "missing member"),
        (wrong_type("summary", "STRING"), "summary must be a string"),
        (wrong_type("findings", *texts), "findings must be strings"),
        (wrong_type("checks", *texts), "checks must be strings"),
        items_problem("findings"),
        items_problem("checks"),
        blank_problem("findings"),
        blank_problem("checks"),
        (~n.between(*SENTENCES), "summary must have 3 to 5 sentences"),
    ]
    problem = F.lit(None).cast("string")
    for condition, reason in reversed(checks):
        problem = F.when(F.coalesce(condition, F.lit(False)), reason).otherwise(problem)
    out = responses.withColumn("_json", body).withColumn("narrative", parsed)
    out = out.withColumn("problem", problem)
    well_formed = F.when(F.col("problem").isNull(), F.col("narrative"))
    return out.withColumn("narrative", well_formed).drop("_json")


def narrative_texts(narratives: DataFrame, *key: str) -> DataFrame:
    """One row per narrative with its summary, findings and checks as one text to check.

    The pieces are separated by a line break, which no number can span.
    """
    n = "narrative"
    pieces = F.concat(F.array(f"{n}.summary"), F.col(f"{n}.findings"), F.col(f"{n}.checks"))
    return narratives.select(*key, F.array_join(pieces, "\n").alias("text"))


# --- template ------------------------------------------------------------------------------


def _metric_text(metric: Column, value: Column, unit: Column) -> Column:
    plain = F.when(value == F.floor(value), grouped(value, 0)).otherwise(grouped(value, 2))
    return (
        F.when(value.isNull(), "n/a")
        .when(unit == "%", F.concat(decimals(value, 1), F.lit("%")))
        .when(metric.isin(*fv.MONEY_METRICS), dollars(value))
        .otherwise(plain)
    )


def _move(pct: Column) -> Column:
    size = decimals(F.abs(pct), 1)
    return (
        F.when(pct > 0, sentence(fv.MOVE_UP, pct=size))
        .when(pct < 0, sentence(fv.MOVE_DOWN, pct=size))
        .when(pct.isNotNull(), fv.MOVE_NONE)
    )


def _finding(a: Column, simulated: Column) -> Column:
    """One sentence about a finding; `simulated` says whether the document's spend is."""
    channel = words(a["channel"])
    metric = lookup(a["metric"], fv.METRIC_WORDS, words(a["metric"]))
    season = a["seasonal_context"]
    context = (
        F.when(season.startswith("baseline"), fv.FINDING_DAY_BASELINE)
        .when(F.length(season) > 0, sentence(fv.FINDING_DAY_SEASON, season=season))
        .otherwise("")
    )
    parts = {
        "channel": channel,
        "Channel": capitalised(channel),
        "metric": metric,
        "Metric": F.concat(F.upper(F.left(metric, F.lit(1))), F.substr(metric, F.lit(2))),
        "simulated": F.when(a["simulated"], fv.FINDING_DAY_SIMULATED).otherwise(""),
        "when": a["when"],
        "value": decimals(a["value"], 1),
        "change_pct": decimals(F.abs(a["change_pct"]), 1),
        "change_pp": decimals(F.abs(a["change_pp"]), 1),
        "shown_value": _metric_text(a["metric"], a["value"], a["unit"]),
        "shown_baseline": _metric_text(a["metric"], a["baseline"], a["unit"]),
        "context": context,
    }
    rule = a["rule"]
    return (
        F.when(rule == "tracking_gap", sentence(fv.FINDING_GAP, **parts))
        .when((rule == "paid_spend_no_purchases") & simulated, sentence(fv.FINDING_NO_PURCHASES, **parts))
        .when(rule == "paid_spend_no_purchases", sentence(fv.FINDING_NO_PURCHASES_REAL, **parts))
        .when((rule == "cost_increase") & simulated, sentence(fv.FINDING_COST, **parts))
        .when(rule == "cost_increase", sentence(fv.FINDING_COST_REAL, **parts))
        .when(rule == "conversion_drop", sentence(fv.FINDING_CONVERSION, **parts))
        .when(rule == "revenue_share_shift", sentence(fv.FINDING_SHIFT, **parts))
        .otherwise(sentence(fv.FINDING_DAY, **parts))
    )


def _signed(pct: Column) -> Column:
    text = decimals(pct, 1)
    return F.when(text.startswith("-"), text).otherwise(F.concat(F.lit("+"), text))


def template_narratives(facts: DataFrame) -> DataFrame:
    """(week, narrative): a deterministic narrative that states only values of the facts."""
    totals, quality, simulated = F.col("totals"), F.col("data_quality"), F.col("simulated_spend")
    move, sessions_move = totals["wow_revenue_pct"], totals["wow_sessions_pct"]
    missing = quality["missing_revenue_share_pct"]

    opening = sentence(
        fv.SENTENCE_TOTALS,
        week=F.col("report_week"),
        sessions=grouped(totals["sessions"], 0),
        purchases=grouped(totals["purchases"], 0),
        revenue=dollars(totals["revenue"]),
    )
    compared = sentence(
        fv.SENTENCE_MOVE,
        revenue_move=_move(move),
        sessions_move=F.coalesce(
            sentence(fv.SENTENCE_MOVE_SESSIONS, move=_move(sessions_move)), F.lit("")
        ),
        previous_week=F.col("previous_week"),
    )
    has_previous = F.col("previous_week").isNotNull() & move.isNotNull()
    aov = sentence(fv.SENTENCE_AOV, aov=dollars(totals["aov"]))
    conversion = sentence(
        fv.SENTENCE_CONVERSION,
        conversion_rate=decimals(totals["conversion_rate_pct"], 1),
        aov=F.coalesce(aov, F.lit("")),
    )
    gap = sentence(fv.SENTENCE_GAP, missing=grouped(quality["purchases_missing_revenue"], 0))
    summary = F.array_join(
        F.array(
            opening,
            F.when(has_previous, compared).otherwise(fv.SENTENCE_NO_PREVIOUS),
            conversion,
            F.when(simulated, fv.SENTENCE_SIMULATED),
            F.when(missing >= fv.GAP_SENTENCE_FROM_PCT, gap),
        ),
        " ",
    )

    def mover(m: Column) -> Column:
        return sentence(
            fv.FINDING_MOVER,
            Channel=capitalised(words(m["channel"])),
            before=dollars(m["from"]),
            after=dollars(m["to"]),
            change_pct=_signed(m["change_pct"]),
        )

    def contribution(c: Column) -> Column:
        return sentence(
            fv.FINDING_CHANNEL,
            Channel=capitalised(words(c["channel"])),
            revenue_share=decimals(c["revenue_share_pct"], 1),
            session_share=decimals(c["session_share_pct"], 1),
        )

    findings = F.concat(
        F.transform(F.slice("anomalies", 1, 2), lambda a: _finding(a, simulated)),
        F.transform("top_movers", mover),
        F.transform("channels", contribution),
    )
    no_check = F.lit(None).cast("string")
    by_rule = F.transform(
        "anomalies",
        lambda a: F.when(simulated, lookup(a["rule"], fv.CHECK_BY_RULE, no_check)).otherwise(
            lookup(a["rule"], fv.CHECK_BY_RULE_REAL, no_check)
        ),
    )
    in_season = F.exists(
        "anomalies",
        lambda a: F.coalesce(
            (F.length(a["seasonal_context"]) > 0) & ~a["seasonal_context"].startswith("baseline"),
            F.lit(False),
        ),
    )
    unknown = sentence(
        fv.CHECK_UNKNOWN, unknown_share=decimals(quality["unknown_channel_session_share_pct"], 1)
    )
    closing = F.array(
        F.when(in_season, fv.CHECK_SEASON), unknown, F.lit(fv.CHECK_MAPPING), F.lit(fv.CHECK_WAIT)
    )
    checks = F.concat(by_rule, closing)

    def first_distinct(texts: Column) -> Column:
        return F.slice(F.array_distinct(F.array_compact(texts)), 1, ITEMS)

    narrative = F.struct(
        summary.alias("summary"),
        first_distinct(findings).alias("findings"),
        first_distinct(checks).alias("checks"),
    )
    return facts.select("week", narrative.alias("narrative"))


# --- choice --------------------------------------------------------------------------------


def resolve_narratives(
    facts: DataFrame, responses: DataFrame, settings: Settings, variant: tuple[str, ...] = ()
) -> DataFrame:
    """The narrative to publish for each week, where it is from, and why not another.

    ``responses`` has week, attempt (from 1) and response. Several texts for a week are told apart by the
    ``variant`` columns of the responses; each of them is chosen on its own. The first well-formed attempt within
    the retries counts; it must pass the number check, otherwise the template stands in. Attempts
    are reduced by MIN_BY / MAX_BY, so a week with very many rows combines before the shuffle.
    """
    tries = responses.where(F.col("attempt") <= 1 + settings.max_retries)
    parsed = parse_responses(tries)
    well_formed = F.col("problem").isNull()
    order = F.struct("attempt", "response")
    key = ["week", *variant]
    chosen = parsed.groupBy(*key).agg(
        F.min_by("narrative", F.when(well_formed, order)).alias("narrative"),
        F.max_by("problem", order).alias("_last_problem"),
    )
    texts = narrative_texts(chosen.where(F.col("narrative").isNotNull()), *key)
    guard = check_numbers(texts, fact_numbers(facts), key, settings.allowed_years)
    guard = guard.withColumnsRenamed({"ok": "_ok", "unmatched": "_unmatched"})
    template = template_narratives(facts).withColumnRenamed("narrative", "_template")
    rows = template.join(chosen, "week", "left").join(guard, key, "left")
    accepted = F.coalesce(F.col("_ok"), F.lit(False))
    reason = (
        F.when(accepted, None)
        .when(F.col("_ok").isNotNull(), "number guard failed")
        .when(
            F.col("_last_problem").isNotNull(),
            F.concat(F.lit("invalid JSON after retries: "), F.col("_last_problem")),
        )
        .otherwise("no response")
    )
    unmatched = F.when(~accepted, F.col("_unmatched"))
    return rows.select(
        *key,
        F.when(accepted, F.col("narrative")).otherwise(F.col("_template")).alias("narrative"),
        F.when(accepted, "response").otherwise("fallback").alias("source"),
        reason.alias("fallback_reason"),
        F.coalesce(unmatched, F.array().cast("array<string>")).alias("unmatched_numbers"),
        F.when(accepted, fv.DISCLOSURE_MODEL)
        .otherwise(fv.DISCLOSURE_TEMPLATE)
        .alias("disclosure"),
    )
