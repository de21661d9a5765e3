"""Outbound payloads as JSON text, one row each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions import clean_email, product_name, repair_quotes, strip_space
from ticketlens.operators.lookups import plan_contact_push, with_venue_lookup

ORDER_KEYS = ["venue_id", "email", "orderNumber"]

# Custom fields of a contact payload and the wide columns they carry.
# Four fields start with the account's own prefix, see ``contact_fields``.
_PREFIXED_FIELDS = {
    "NAME": "cust_name",
    "PHONE": "phone",
    "TOTAL_ORDERS": "total_orders",
    "TOTAL_REVENUE": "total_revenue",
}
_FIELDS = {
    "NUMBER_OF_SHOWS_ATTENDED_ON_MONDAYS": "shows_attended_M",
    "NUMBER_OF_SHOWS_ATTENDED_ON_TUESDAYS": "shows_attended_T",
    "NUMBER_OF_SHOWS_ATTENDED_ON_WEDNESDAYS": "shows_attended_W",
    "NUMBER_OF_SHOWS_ATTENDED_ON_THURSDAYS": "shows_attended_R",
    "NUMBER_OF_SHOWS_ATTENDED_ON_FRIDAYS": "shows_attended_F",
    "NUMBER_OF_SHOWS_ATTENDED_ON_SATURDAYS": "shows_attended_S",
    "NUMBER_OF_SHOWS_ATTENDED_ON_SUNDAYS": "shows_attended_U",
    "FIRST_SHOW_ATTENDED_NAME": "first_event_title",
    "LAST_SHOW_ATTENDED_NAME": "last_event_title",
    "NEXT_SHOW_ATTENDING_NAME": "next_event_title",
    "FIRST_SHOW_ATTENDED_DATE": "first_show_attended",
    "LAST_SHOW_ATTENDED_DATE": "last_show_attended",
    "NEXT_SHOW_ATTENDING_DATE": "next_show_attending",
    "LAST_ORDER_DATE": "last_ordered_date",
    "LAST_COMP_SHOW_DATE": "last_comp_show_date",
    "TOTAL_NUMBER_OF_COMP_TICKETS": "total_lifetime_comp_tickets",
    "TOTAL_NUMBER_OF_COMP_ORDERS": "total_lifetime_comp_orders",
    "TOTAL_NUMBER_OF_PAID_TICKETS": "total_lifetime_paid_tickets",
    "TOTAL_NUMBER_OF_PAID_ORDERS": "total_lifetime_paid_orders",
    "TOTAL_COMP_ORDER_COUNT_LAST_360_DAYS": "comp_orders_count_360",
    "TOTAL_PAID_ORDER_COUNT_LAST_360_DAYS": "paid_orders_count_360",
    "TOTAL_REVENUE_LAST_360_DAYS": "paid_orders_revenue_360",
    "TOTAL_COMP_ORDER_COUNT_LAST_90_DAYS": "comp_orders_count_90",
    "TOTAL_PAID_ORDER_COUNT_LAST_90_DAYS": "paid_orders_count_90",
    "TOTAL_REVENUE_LAST_90_DAYS": "paid_orders_revenue_90",
    "COUNT_OF_SPECIAL_EVENTS_ATTENDED": "count_shows_special",
    "COUNT_OF_PRESENTS_SHOWS_ATTENDED": "count_shows_persents",
    "AVERAGE_NUMBER_OF_PAID_TICKETS_PER_ORDER": "avg_tickets_per_paid_order",
    "AVERAGE_NUMBER_OF_TICKETS_PER_COMP_ORDER": "avg_tickets_per_comp_order",
    "AVERAGE_NUMBER_OF_DAYS_BETWEEN_PURCHASE_AND_EVENT_DATES": "avg_purchase_to_show_days",
    "AVERAGE_TICKETS_PER_ORDER": "avg_tickets_per_order",
}
_DATE_COLUMNS = {
    "first_show_attended",
    "last_show_attended",
    "next_show_attending",
    "last_ordered_date",
    "last_comp_show_date",
}


def contact_fields(prefix: str = "TICKETING") -> dict[str, str]:
    """The default field map, with the account's prefix on its four own fields."""
    return {f"{prefix}_{name}": column for name, column in _PREFIXED_FIELDS.items()} | _FIELDS


def home_venue() -> Column:
    """Venue of the next event, else of the last one, else ''."""
    return F.coalesce(F.col("next_event_venue"), F.col("last_event_venue"), F.lit(""))


def group_order_lines(lines: DataFrame) -> DataFrame:
    """Order lines gathered into one row per (venue, email, order number), however many they are.

    The email and order number are separate keys, so no two orders can run together.
    The order's own fields are those of its lowest line. An order is pushed as one
    document, so its lines are one list; header and list come from one aggregate.
    """
    lines = lines.withColumn("email", strip_space(F.col("email")))
    header = ["externalid", "customerid", "orderDate", "shippingMethod", "totalPrice"]
    product = ["unique_id", "orderproduct_category", "event_name", "orderproduct_name", "orderproduct_price"]
    grouped = lines.groupBy(*ORDER_KEYS).agg(
        F.min(F.struct(*product, *header)).alias("first"),
        F.sort_array(F.collect_list(F.struct(*product))).alias("lines"),
    )
    return grouped.select(*ORDER_KEYS, *[F.col("first")[name].alias(name) for name in header], "lines")


def customer_payloads(grouped: DataFrame, connections: DataFrame, distinct: bool = False) -> DataFrame:
    """One customer payload per order; with ``distinct`` one per venue and email.

    Venues without a connection have no payload.
    """
    mapped = with_venue_lookup(grouped, connections, "venue_id", "connection")
    rows = mapped.where("mapped").select(*ORDER_KEYS, "connection", "customerid")
    if distinct:
        rows = rows.groupBy("venue_id", "email", "connection").agg(F.min("customerid").alias("customerid"))
    customer = F.struct(
        F.col("connection").alias("connectionid"),
        F.col("customerid").alias("externalid"),
        F.col("email"),
    )
    return rows.withColumn("payload", _json(F.struct(customer.alias("ecomCustomer"))))


def order_payloads(grouped: DataFrame, numeric: bool = False) -> DataFrame:
    """One order payload per order.

    ``grouped`` is :func:`group_order_lines` with ``connection`` and ``crm_customer_id``
    added. ``numeric`` writes prices and quantities as numbers instead of text.
    """

    def product(row: Column) -> Column:
        price = row["orderproduct_price"]
        return F.struct(
            product_name(row["orderproduct_category"], row["event_name"], row["orderproduct_name"]).alias("name"),
            (price if numeric else price.cast("string")).alias("price"),
            (F.lit(1) if numeric else F.lit("1")).alias("quantity"),
            repair_quotes(row["orderproduct_name"]).alias("category"),
        )

    order = F.struct(
        F.col("externalid"),
        F.lit(0).alias("source"),
        F.col("email"),
        F.col("orderNumber"),
        F.transform("lines", product).alias("orderProducts"),
        F.col("orderDate").cast("string").alias("orderDate"),
        F.col("shippingMethod"),
        F.col("totalPrice").cast("string").alias("totalPrice"),
        F.lit("USD").alias("currency"),
        F.col("connection").try_cast("int").alias("connectionid"),
        F.col("crm_customer_id").try_cast("bigint").alias("customerid"),
    )
    return grouped.withColumn("payload", _json(F.struct(order.alias("ecomOrder"))))


def contact_field_values(field_map: Mapping[str, str] | None = None, null_text: str = "") -> Column:
    """map<field, text>: unknown dates are '', any other NULL is ``null_text``."""
    entries: list[Column] = []
    for name, column in (field_map or contact_fields()).items():
        missing = "" if column in _DATE_COLUMNS else null_text
        entries += [
            F.lit(f"field[%{name}%,0]"),
            F.coalesce(F.col(column).cast("string"), F.lit(missing)),
        ]
    return F.create_map(*entries)


def contact_push_plan(wide: DataFrame, lists: DataFrame, with_list: bool = True) -> DataFrame:
    """Adds ``home_venue``, its ``list_id`` and ``plan``: ready, err_list or err_other.

    A contact without a home venue is err_list. A home venue without a list is
    err_other, unless the run attaches no lists.
    """
    placed = with_venue_lookup(wide.withColumn("home_venue", home_venue()), lists, "home_venue", "list_id")
    unmapped = ~F.col("mapped") if with_list else F.lit(False)
    plan = F.when(F.col("home_venue") == "", "err_list").when(unmapped, "err_other").otherwise("ready")
    return placed.withColumn("plan", plan).drop("mapped")


def contact_payloads(
    wide: DataFrame,
    lists: DataFrame,
    field_map: Mapping[str, str] | None = None,
    null_text: str = "",
    with_list: bool = True,
    crm_ids: DataFrame | None = None,
) -> DataFrame:
    """Payloads of the contacts that are ready to push.

    ``with_list`` also subscribes the contact to the list of its home venue. With
    ``crm_ids`` (email, crm_id) known contacts are edited by their id and others added;
    without, all are edited.
    """
    ready = contact_push_plan(wide, lists, with_list).where(F.col("plan") == "ready")
    if crm_ids is not None:
        ready = plan_contact_push(ready, crm_ids)

    def name(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(null_text))

    head = F.create_map(
        F.lit("api_action"),
        F.lit("contact_edit") if crm_ids is None else F.col("action"),
        F.lit("api_output"),
        F.lit("json"),
        F.lit("email"),
        clean_email(F.col("email_address")),
        F.lit("overwrite"),
        F.lit("0"),
        F.lit("first_name"),
        name("cust_name_first"),
        F.lit("last_name"),
        name("cust_name_last"),
    )
    parts = [head, contact_field_values(field_map, null_text)]
    if with_list:
        parts.append(_list_entry())
    if crm_ids is not None:
        nothing = F.create_map().cast("map<string,string>")
        parts.append(F.when(F.col("crm_id").isNull(), nothing).otherwise(F.create_map(F.lit("id"), F.col("crm_id"))))
    return ready.select(
        "email_address", "home_venue", "list_id", F.to_json(F.map_concat(*parts)).alias("payload")
    )


def _list_entry() -> Column:
    return F.create_map(F.concat(F.lit("p["), F.col("list_id"), F.lit("]")), F.col("list_id"))


def mobile_push_plan(resolved: DataFrame, crm_lists: DataFrame) -> DataFrame:
    """Adds ``crm_id``, ``list_id`` and ``plan``: ready, err_list (no list) or err_other (not in the CRM).

    ``crm_lists`` is (email, crm_id, list_id), as the CRM gives them; of several lists of
    a contact the lowest counts.
    """
    found = plan_contact_push(resolved, crm_lists.select("email", "crm_id")).drop("action")
    lists = crm_lists.where(F.col("list_id").isNotNull()).groupBy("crm_id").agg(F.min("list_id").alias("list_id"))
    plan = F.when(F.col("crm_id").isNull(), "err_other").when(F.col("list_id").isNull(), "err_list").otherwise("ready")
    return found.join(lists, "crm_id", "left").withColumn("plan", plan)


def mobile_payloads(resolved: DataFrame, crm_lists: DataFrame | None = None) -> DataFrame:
    """Payloads that set the mobile number and the resolved opt-in status.

    With ``crm_lists`` only contacts that :func:`mobile_push_plan` finds ready, with their id and list.
    """
    extra = []
    if crm_lists is not None:
        resolved = mobile_push_plan(resolved, crm_lists).where("plan = 'ready'")
        extra = [F.create_map(F.lit("id"), F.col("crm_id")), _list_entry()]
    fields = F.create_map(
        F.lit("api_action"),
        F.lit("contact_edit"),
        F.lit("api_output"),
        F.lit("json"),
        F.lit("email"),
        clean_email(F.col("email_address")),
        F.lit("overwrite"),
        F.lit("0"),
        F.lit("field[%MOBILE_NUMBER%,0]"),
        F.col("mobile_number"),
        F.lit("field[%MOBILE_OPTIN%,0]"),
        F.col("mobile_optin"),
    )
    payload = F.to_json(F.map_concat(fields, *extra))
    return resolved.select("email_address", "mobile_number", "mobile_optin", payload.alias("payload"))


def tag_payloads(assignments: DataFrame, crm_ids: DataFrame) -> DataFrame:
    """One payload per contact and tag for contacts with a CRM id (``email, crm_id``)."""
    link = F.struct(F.col("crm_id").alias("contact"), F.col("tag_id").alias("tag"))
    return assignments.join(crm_ids, "email").withColumn("payload", _json(F.struct(link.alias("contactTag"))))


def _json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})
