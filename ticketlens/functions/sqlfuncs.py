"""The engine's scalar function under its SQL name."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_functions(spark: SparkSession) -> None:
    """Make ``only_numbers(text)`` available to ``spark.sql`` as a native SQL function."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION only_numbers(txt STRING) RETURNS STRING "
        "RETURN coalesce(left(regexp_replace(txt, '[^0-9]', ''), 20), '')"
    )
