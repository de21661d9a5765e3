"""Registered queries against their DuckDB twins at the smallest scale factor.

A spread of operators by default; TICKETLENS_ALL=1 runs every query.
"""

import os

import pytest

import __spark_entry__ as entry_module
from checks.compare import compare
from checks.queries import queries
from checks.twins import oracle_sql

SMALLEST = "/root/testdata/sf0.001"
SPREAD = [
    "customer_360", "orders_mart", "order_orphans", "order_number_totals", "first_last_next",
    "weekday_attendance_reference", "merge_order_sightings", "flatten_orderlines", "changed_contacts",
    "boundary_contacts", "order_payloads", "contact_payloads", "with_batch_id", "daily_tags", "resolve_optin",
    "upsert_contacts", "run_incremental", "stream_optin_webhooks", "parse_form", "classify_response",
]


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(queries()) if os.environ.get("TICKETLENS_ALL") else SPREAD)
def test_query_equals_its_twin(spark, name):
    outcome = compare(spark, SMALLEST, [name])[name]
    assert outcome.startswith("ok") and "TYPES" not in outcome, outcome


def test_entry(spark):
    df = entry_module.entry(spark)
    assert len(df.columns) == 45 and df.count() > 0
