"""Outcomes of pushes: classification of responses and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Response codes.
OK = 200
CREATED = 201
REJECTED = 422


def classify_response(status: Column, body: Column) -> Column:
    """'success' for 201; 'duplicate' for 422 whose first error says so; else 'other'.

    A body that is no JSON counts as 'other'.
    """
    first_error = F.get_json_object(body, "$.errors[0].code")
    return (
        F.when(status == CREATED, "success")
        .when((status == REJECTED) & (first_error == "duplicate"), "duplicate")
        .otherwise("other")
    )


def classify_contact_response(status: Column, body: Column, action: Column, venue: Column) -> Column:
    """Outcome of pushing a contact.

    'err_list' without a venue. 'success' for a 200 whose ``result_code`` is not 0; a 200
    without a readable code is 'err_other'; all else is 'err_update' or 'err_add' by the action.
    """
    failed = F.when(action == "contact_edit", "err_update").otherwise("err_add")
    code = F.get_json_object(body, "$.result_code")
    return (
        F.when(F.coalesce(venue, F.lit("")).isin("", "None"), "err_list")
        .when((status == OK) & code.isNull(), "err_other")
        .when((status == OK) & (code != "0"), "success")
        .otherwise(failed)
    )


def order_outcome(first: Column, crm_id: Column, second: Column) -> Column:
    """Outcome of an order from the classes of its add and, after a duplicate, of its update.

    A duplicate whose CRM id is not found cannot be updated and counts as a success.
    """
    return (
        F.when(first == "success", "success")
        .when(first != "duplicate", "err-other")
        .when(crm_id.isNull() | (second == "success"), "success")
        .otherwise("err-update")
    )


def push_report(results: DataFrame) -> DataFrame:
    """Number of rows per venue, entity and outcome."""
    return results.groupBy("venue_id", "entity", "outcome").agg(F.count(F.lit(1)).alias("n"))


def push_report_keys(results: DataFrame, ok: str = "success") -> DataFrame:
    """The failing keys, one row each with its venue, entity and outcome."""
    return results.where(F.col("outcome") != ok).select("venue_id", "entity", "outcome", "key")
