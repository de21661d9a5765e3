"""High-water marks, one row per job."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ticketlens.schemas import MARKS
from ticketlens.semantics import Moment, as_moment
from ticketlens.sources.tables import read_version
from ticketlens.sources.upsert import upsert_table


def read_mark(spark: SparkSession, root: str, job: str, default: Moment) -> datetime:
    """The job's mark, or the default before its first run."""
    row = read_version(spark, root, MARKS).where(F.col("job") == job).first()
    return as_moment(row["mark"]) if row else as_moment(default)


def advance_mark(spark: SparkSession, root: str, job: str, upper: Moment) -> None:
    """Move the job's mark to ``upper``; a mark never moves back."""
    update = spark.createDataFrame([(job, as_moment(upper))], MARKS)
    upsert_table(spark, root, update, ["job"], MARKS, [F.col("mark").desc()])


def run_incremental(
    spark: SparkSession,
    root: str,
    job: str,
    upper: Moment,
    work: Callable[[datetime, datetime], None],
    default: Moment = "1970-01-01",
    advance: bool = True,
) -> tuple[datetime, datetime]:
    """Call ``work(mark, upper)`` and then advance the job's own mark.

    ``upper`` is fixed before anything is read, so rows that arrive meanwhile belong
    to the next run. If ``work`` fails the mark stays and the run can be repeated.
    """
    mark, bound = read_mark(spark, root, job, default), as_moment(upper)
    work(mark, bound)
    if advance:
        advance_mark(spark, root, job, bound)
    return mark, bound
