"""Money is held in cents (BIGINT); reports use whole units."""

from __future__ import annotations

from pyspark.sql import Column


def whole_units(cents: Column) -> Column:
    """Cents to whole units, halves away from zero; NULL stays NULL.

    Divides as DECIMAL so that no cent is lost, and keeps 20 digits so that the
    total of one very large key cannot overflow.
    """
    return (cents.cast("decimal(20,0)") / 100).cast("decimal(20,0)")


def parse_cents(text: Column) -> Column:
    """Price text to cents; fractions are cut, anything unreadable is NULL."""
    return text.try_cast("decimal(22,4)").cast("bigint")
