"""Traffic source attribution rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fv


def channel_of(source: Column, medium: Column) -> Column:
    """Channel of one (source, medium) pair; the first rule that holds wins."""
    kind = F.lower(medium)
    return (
        F.when(medium.isNull() | medium.isin(*fv.PLACEHOLDER_MEDIA), "unknown")
        .when(kind == "cpc", "paid_search")
        .when(kind == "organic", "organic_search")
        .when(kind == "referral", "referral")
        .when((source == "(direct)") & (medium == "(none)"), "direct")
        .otherwise("other")
    )


def channel_code(channel: Column) -> Column:
    """Position of a channel in the fixed list, as a small integer."""
    return F.array_position(F.array(*[F.lit(c) for c in fv.CHANNELS]), channel) - 1


def channel_name(code: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in fv.CHANNELS]), code.cast("int"))


def event_param(params: Column, key: str, slot: str) -> Column:
    """Value of one key in an array of {key, value{string_value, int_value}}.

    Reads the key and value columns separately, so only the wanted slot is scanned and the
    look-up stays in generated code. An absent key has position 0 and gives NULL.
    """
    position = F.array_position(params["key"], F.lit(key)).cast("int")
    return F.get(params["value"][slot], position - 1)
