"""Zone-free timestamps. Wall-clock values are TIMESTAMP_NTZ throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(text: Column) -> Column:
    """Parse '2018-05-10T19:30:00.000-05:00' as 2018-05-10 19:30:00.

    The offset is cut, not applied. Text that is no date, the zero date
    included, becomes NULL.
    """
    return F.left(F.translate(text, "T", " "), F.lit(19)).try_cast("timestamp_ntz")


def date_part(moment: Column) -> Column:
    return moment.cast("date")


def to_second(moment: Column) -> Column:
    """Cut fractions of a second (``date_trunc`` would bring in the session zone)."""
    return F.left(moment.cast("string"), F.lit(19)).cast("timestamp_ntz")
