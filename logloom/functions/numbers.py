"""Rounding and number-to-text rules of the report."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Round the way array libraries do: scale, take the nearest even integer, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def decimals(value: Column, digits: int) -> Column:
    """Fixed number of decimals, no thousands separator, ties decided on the exact binary value."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def signed_decimals(value: Column, digits: int) -> Column:
    """As :func:`decimals`, always with a sign."""
    text = decimals(value, digits)
    return F.when(text.startswith("-"), text).otherwise(F.concat(F.lit("+"), text))


def grouped(value: Column) -> Column:
    """Integer with thousands separators."""
    return F.format_number(value.cast("bigint"), 0)
