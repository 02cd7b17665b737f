"""Scalar expressions of the mart: money, calendar parts, percent text, variance status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Totals of totals get one fixed type: left alone, each sum widens until an expression loses its cents.
TOTAL = "decimal(28,2)"

# The line types that make up net revenue, and those that count when only sales do.
NET_LINE_TYPES = ("SALE", "RETURN", "DISCOUNT", "VOID")
SALE_ONLY = ("SALE",)

# Weekday numbers (ISO, Monday first) and names.
WEEKDAYS = (
    (1, "Monday"), (2, "Tuesday"), (3, "Wednesday"), (4, "Thursday"),
    (5, "Friday"), (6, "Saturday"), (7, "Sunday"),
)


def line_revenue(qty: Column, price: Column) -> Column:
    """``qty * price`` as exact money, so that totals do not depend on the order of addition."""
    return (qty.cast("decimal(10,0)") * price.cast("decimal(12,2)")).cast(MONEY)


def as_double(total: Column) -> Column:
    """Money leaves a plan as double; it is added up as decimal."""
    return total.cast("double")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def weekday_sunday0(day: Column) -> Column:
    """Day of week with Sunday as 0."""
    return F.dayofweek(day) - F.lit(1)


def weekday_iso(day: Column) -> Column:
    """Day of week with Monday as 1."""
    return F.weekday(day) + F.lit(1)


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def month_abbreviation(month: Column) -> Column:
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")


def percent_change(old: Column, new: Column) -> Column:
    return (new - old) / F.nullif(old, F.lit(0)) * F.lit(100.0)


def percent_text(value: Column, decimals: int = 1) -> Column:
    return F.format_string(f"%.{decimals}f%%", value)


def variance_status(variance: Column) -> Column:
    """A variance that cannot be computed (one side missing) is a variance."""
    return F.when(F.abs(variance) < F.lit(0.01), F.lit("EXACT MATCH")).otherwise(F.lit("VARIANCE"))


def hex_to_long(digest: Column, start: int, digits: int) -> Column:
    """Up to 15 hex digits of a digest as a non-negative bigint."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")
