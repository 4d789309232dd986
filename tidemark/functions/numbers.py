"""Numeric Column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_if_nan(value: Column) -> Column:
    """NaN and the infinities become NULL, so missing has one spelling."""
    number = value.cast("double")
    # NaN sorts above infinity, so one comparison refuses both.
    return F.when(F.abs(number) < float("inf"), number)


def money_sum(value: Column) -> Column:
    """Sum of amounts that does not depend on the order in which tasks deliver them.

    Floating sums change in the last digit with the partitioning, which would change rounded
    facts and their fingerprint from run to run. Decimal addition is exact.
    """
    return F.sum(value.cast("decimal(28,10)")).cast("double")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio that is NULL for a missing side or a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


# The SQL texts below take a column name or any SQL expression. Wide tables build their many
# columns from them with ``F.expr``: one call per column instead of one per operator.


def ratio_sql(numerator: str, denominator: str) -> str:
    """``safe_divide`` as SQL text."""
    return f"try_divide(double({numerator}), double({denominator}))"


def round_even_sql(value: str, digits: int) -> str:
    """Round the exact binary value, halves to even (6.25 -> 6.2, 2.675 -> 2.67).

    ``round`` works on the shortest decimal text and rounds half up. The decimal formatter works
    on the binary value, so its text read back is the correctly rounded double. NaN and the
    infinities become NULL: both fail the comparison.
    """
    pattern = "0." + "0" * digits if digits else "0"
    number = f"if(abs(double({value})) < double('Infinity'), double({value}), null)"
    return f"double(format_number({number}, '{pattern}'))"


def percent_sql(ratio: str) -> str:
    """0.1234 -> 12.3"""
    return round_even_sql(f"(double({ratio}) * 100)", 1)


def round_even(value: str, digits: int) -> Column:
    return F.expr(round_even_sql(value, digits))


def percent(ratio: str) -> Column:
    return F.expr(percent_sql(ratio))


def whole(value: str) -> Column:
    """Nearest integer, halves to even."""
    return F.expr(f"bigint(rint({value}))")


def array_median(values: Column) -> Column:
    """Median of an array without NULLs; NULL when it is empty."""
    ordered, n = F.sort_array(values), F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that each row computes them exactly once.

    They are added as the output of a generator. A later filter or projection reads that
    output; over a plain projection the optimizer would copy the expression into the filter.
    """
    named = [column.alias(name) for name, column in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*named))))


def shared(df: DataFrame) -> DataFrame:
    """The same rows as the output of a generator, which keeps all columns together: two readers then
    have the same plan below it and share its shuffle, where pruning would give each its own."""
    whole = computed_once(df.select(F.struct(*df.columns).alias("_row")), _kept=F.col("_row"))
    return whole.select("_kept.*")
