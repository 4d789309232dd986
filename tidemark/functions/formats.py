"""Display text for report cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions.numbers import null_if_nan


def decimals(value: Column, digits: int) -> Column:
    """Plain decimal text without thousands separators."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", null_if_nan(value), F.lit(pattern))


def grouped(value: Column, digits: int) -> Column:
    """Decimal text with thousands separators."""
    return F.format_number(null_if_nan(value), digits)


def dollars(value: Column) -> Column:
    return F.concat(F.lit("$"), grouped(value, 2))


def _or_dash(text: Column) -> Column:
    return F.coalesce(text, F.lit(fv.DASH))


def fmt_int(value: Column) -> Column:
    return _or_dash(grouped(value, 0))


def fmt_money(value: Column) -> Column:
    return _or_dash(dollars(value))


def fmt_ratio_pct(ratio: Column) -> Column:
    """0.123 -> 12.3%"""
    return _or_dash(F.concat(decimals(ratio.cast("double") * 100, 1), F.lit("%")))


def fmt_number(value: Column) -> Column:
    return _or_dash(decimals(value, 2))


def fmt_delta(change: Column, higher_is_better: bool | None = True) -> Column:
    """Struct(text, tone): an arrow for the direction, a tone for good or bad."""
    value = null_if_nan(change)
    size = F.concat(decimals(F.abs(value) * 100, 1), F.lit("%"))
    arrow = F.when(value > 0, fv.ARROW_UP).otherwise(fv.ARROW_DOWN)
    if higher_is_better is None:
        verdict = F.lit("neutral")
    else:
        verdict = F.when((value > 0) == F.lit(higher_is_better), "good").otherwise("bad")
    text = (
        F.when(value.isNull(), fv.DASH)
        .when(value == 0, "0.0%")
        .otherwise(F.concat(arrow, F.lit(" "), size))
    )
    tone = F.when(value.isNull(), "none").when(value == 0, "neutral").otherwise(verdict)
    return F.struct(text.alias("text"), tone.alias("tone"))


def lookup(key: Column, labels: dict[str, str], otherwise: Column) -> Column:
    """Label of a key from a small fixed dictionary."""
    picked = F.lit(None).cast("string")
    for name, label in reversed(labels.items()):
        picked = F.when(key == name, label).otherwise(picked)
    return F.coalesce(picked, otherwise)


def capitalised(text: Column) -> Column:
    """First character upper case, the rest lower case."""
    tail = text.substr(F.lit(2), F.length(text))
    return F.concat(F.upper(text.substr(1, 1)), F.lower(tail))


def words(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(" "))


def channel_label(channel: Column) -> Column:
    return lookup(channel, fv.CHANNEL_LABELS, capitalised(words(channel)))


def sentence(template: str, **parts: Column) -> Column:
    """Fill a ``{name}`` template with Columns; NULL when any part is NULL."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if before:
            pieces.append(F.lit(before))
        pieces.append(parts[name])
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)
