from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.compare import local_session

    # A few rows per table: planning stage by stage would cost more than running them.
    session = local_session(4, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="2")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Literal rows as a table: ``table("a string, b int", ("x", 1), …)``."""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


@pytest.fixture
def scratch(spark):
    from ticketlens.sources.scratch import scratch_dir

    return lambda name: scratch_dir(spark, f"test-{name}")
