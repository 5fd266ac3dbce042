"""Numeric cleaning and comparison columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.settings import NULL_TOKENS, TOLERANCE


def null_tokens(col: Column) -> Column:
    """Text that means "missing" becomes NULL."""
    return F.when(~F.trim(col).isin(*NULL_TOKENS), col)


def to_number(col: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL, and so does NaN.

    The cast also takes Java's type suffixes (``12d``); those are not numbers here. The
    input is referenced once, so that long expressions stay short after optimisation.
    """
    text = F.regexp_replace(col.cast("string"), r"([0-9.])[dDfF]\s*$", "$1 x")
    return no_nan(text.try_cast("double"))


def no_nan(col: Column) -> Column:
    """NaN becomes NULL. In Spark NaN is larger than any number and would pass ``> 0``."""
    return F.nullif(col, F.lit(float("nan")))


def not_a_number(col: Column) -> Column:
    """True for a value that is present but does not parse."""
    return F.coalesce(to_number(col).isNull() & ~F.trim(col).isin(*NULL_TOKENS), F.lit(False))


def safe_float(col: Column, default: float = 0.0) -> Column:
    return F.coalesce(to_number(col), F.lit(float(default)))


def no_infinity(col: Column) -> Column:
    return F.when(~col.isin(float("inf"), float("-inf")), col)


def close_to(left: Column, right: Column, tolerance: float = TOLERANCE) -> Column:
    """Null-safe equality with a strict absolute tolerance; infinities count as missing."""
    a, b = no_infinity(left), no_infinity(right)
    return (
        F.when(a.isNull() & b.isNull(), F.lit(True))
        .when(a.isNull() | b.isNull(), F.lit(False))
        .otherwise(F.abs(a - b) < F.lit(tolerance))
    )


def round_or_zero(col: Column, places: int = 2) -> Column:
    return F.coalesce(F.round(col, places), F.lit(0.0))


def ceil_div(rows: Column, size: int) -> Column:
    """Whole division rounding up: the number of batches that ``rows`` rows make."""
    return F.call_function("div", rows + F.lit(size - 1), F.lit(size))


def saved_percent(after: Column, before: Column) -> Column:
    """How much smaller ``after`` is than ``before``, in percent; NULL when ``before`` is 0."""
    return (F.lit(1.0) - F.try_divide(after.cast("double"), before.cast("double"))) * 100


def partial_sum(col: Column, scale: int | None) -> Column:
    """A sum to be folded further: ``decimal(38, scale)``, so that folding never rounds.

    Without a scale it is a plain double sum, whose last digits depend on partitioning.
    """
    return F.sum(col) if scale is None else F.sum(col.cast(f"decimal(28,{scale})"))


def exact_sum(col: Column, scale: int | None) -> Column:
    """Sum that does not depend on the order of rows when prices have ``scale`` decimals."""
    return partial_sum(col, scale).cast("double")


def folded_sum(col: Column, scale: int | None) -> Column:
    """Total of partial sums, rounded to double only now."""
    return (F.sum(col) if scale is None else F.sum(col.cast(f"decimal(38,{scale})"))).cast("double")


def flag(col: Column) -> Column:
    """Boolean to 0/1."""
    return col.cast("int")
