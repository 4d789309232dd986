"""Checking that every number in a written text is backed by the facts of its week."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.text import (
    number_exponent,
    number_texts,
    number_tolerance,
    number_value,
)
from tidemark.operators.facts import document_leaves
from tidemark.plans.materialize import materialize

# Slack on top of half a written unit (fixed value).
SLACK = 1e-9
# Tokens are matched on a grid of their own written unit. Units below ten times the slack share one
# grid, as the slack is then the larger part of the reach. For a number so large that doubles are
# further apart than the unit, the grid is DIGITS places below its first digit.
FINEST, DIGITS = -8, 14
# The spacing of doubles is below this share of the number; rounding of a bound stays within it.
SPACING = 2.0**-51


def extract_numbers(texts: DataFrame, text: str = "text", keep_empty: bool = False) -> DataFrame:
    """One row per number in a text: position, token, value, tolerance, exponent.

    With ``keep_empty`` a text without numbers is one row of NULLs.
    """
    keep = [c for c in texts.columns if c != text]
    explode = F.posexplode_outer if keep_empty else F.posexplode
    tokens = texts.select(*keep, explode(number_texts(F.col(text))).alias("position", "token"))
    token = F.col("token")
    return tokens.withColumns(
        {
            "value": number_value(token),
            "tolerance": number_tolerance(token),
            "exponent": number_exponent(token),
        }
    )


def fact_numbers(facts: DataFrame) -> DataFrame:
    """(week, path, value): every numeric leaf of the facts documents, as absolute values."""
    numbers = document_leaves(facts).where(F.col("number").isNotNull())
    return numbers.select("week", "path", F.abs("number").alias("value"))


def _grid(value: Column, exponent: Column) -> Column:
    """Exponent of the grid on which a number of this size and written unit is matched."""
    finite = value < float("inf")
    first_digit = F.floor(F.log10(F.when(finite, value))).cast("int")
    return F.when(finite, F.greatest(exponent, F.lit(FINEST), first_digit - DIGITS))


def _cell(value: Column, grid: Column) -> Column:
    return F.floor(value / F.pow(F.lit(10.0), grid))


def fact_grid(numbers: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each fact on every grid cell where one of the tokens could match it.

    Only the units that the tokens are written in get a grid; there are 15 at most. A token
    matches when it lies within half its unit and the slack of a fact. The cells run from that of the lowest
    number in reach to that of the highest one. Division and floor are monotone, so they hold all tokens
    between, and no cell is smaller than about half the reach, so they are four at most.
    """
    units = tokens.agg(F.collect_set(F.greatest("exponent", F.lit(FINEST)))).scalar()
    distinct = numbers.select("week", F.col("value").alias("fact")).distinct()
    on_grid = distinct.withColumn("_units", units).withColumn("exponent", F.explode("_units"))
    fact, exponent = F.col("fact"), F.col("exponent")
    reach = F.pow(F.lit(10.0), exponent) / 2 + SLACK + fact * SPACING
    low, high = F.greatest(fact - reach, F.lit(0.0)), fact + reach
    grids = F.array_distinct(F.array(_grid(low, exponent), _grid(high, exponent)))
    each = on_grid.select("week", "fact", low.alias("_low"), high.alias("_high"), F.explode(grids).alias("grid"))
    cells = F.sequence(_cell(F.col("_low"), F.col("grid")), _cell(F.col("_high"), F.col("grid")))
    return each.select("week", "fact", "grid", F.explode(cells).alias("cell"))


def _unbacked(tokens: DataFrame, numbers: DataFrame, allowed_years: Sequence[int]) -> DataFrame:
    """Distinct (week, value, tolerance) of the tokens that no fact of the same week backs.

    An equi anti join on (week, grid, cell) with the exact distance as residual: no pairing of
    all numbers with all facts of a week. Copies of a token are one row, and the full key spreads
    one busy week over its cells.
    """
    value, tolerance = F.col("value"), F.col("tolerance")
    years = value.isin(*[float(y) for y in allowed_years]) & (tolerance == 0.5)
    distinct = tokens.where(F.col("token").isNotNull() & ~years).select("week", "value", "tolerance", "exponent").distinct()
    distinct = distinct.withColumn("_grid", _grid(value, F.col("exponent")))
    t = distinct.withColumn("_cell", _cell(value, F.col("_grid"))).alias("t")
    facts = fact_grid(numbers, distinct).alias("f")
    backed = (
        (F.col("t.week") == F.col("f.week"))
        & (F.col("t._grid") == F.col("f.grid"))
        & (F.col("t._cell") == F.col("f.cell"))
        & (F.abs(F.col("t.value") - F.col("f.fact")) <= F.col("t.tolerance") + SLACK)
    )
    wrong = t.join(facts, backed, "left_anti").select("week", "value", "tolerance").distinct()
    return wrong.select(*[F.col(c).alias(f"_{c}") for c in wrong.columns])


def _same() -> Column:
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("week", "value", "tolerance")]
    return same[0] & same[1] & same[2]


def unmatched_numbers(
    texts: DataFrame, numbers: DataFrame, allowed_years: Sequence[int] = fv.ALLOWED_YEARS
) -> DataFrame:
    """Tokens that no fact of the same week backs."""
    tokens = extract_numbers(texts)
    return tokens.join(_unbacked(tokens, numbers, allowed_years), _same(), "left_semi")


def check_numbers(
    texts: DataFrame,
    numbers: DataFrame,
    key: Sequence[str],
    allowed_years: Sequence[int] = fv.ALLOWED_YEARS,
) -> DataFrame:
    """Per text (its key and week): ok and the unmatched tokens in writing order.

    The texts are read once; their tokens are stored, checked as distinct numbers, and listed
    again. The list of a text is bounded by the text itself.
    """
    keys = list(dict.fromkeys([*key, "week"]))
    tokens = materialize(extract_numbers(texts.select(*keys, "text"), keep_empty=True))
    wrong = _unbacked(tokens, numbers, allowed_years).withColumn("_wrong", F.lit(True))
    listed = F.collect_list(F.when(F.col("_wrong"), F.struct("position", "token")))
    checked = tokens.join(wrong, _same(), "left").groupBy(*keys).agg(F.sort_array(listed).alias("_listed"))
    unmatched = F.transform("_listed", lambda x: x["token"])
    return checked.select(*keys, unmatched.alias("unmatched"), (F.size("_listed") == 0).alias("ok"))
