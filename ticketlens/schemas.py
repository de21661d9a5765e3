"""Explicit schemas: nested JSON inputs and the base tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_S, _L, _T = StringType(), LongType(), TimestampNTZType()


def _struct(texts: str = "", **others: DataType) -> StructType:
    """Text fields by name, then fields of other types."""
    fields = [StructField(name, _S) for name in texts.split()]
    return StructType(fields + [StructField(name, kind) for name, kind in others.items()])


def _ordered(**fields: DataType) -> StructType:
    return _struct("", **fields)


# Ids, numbers and booleans of the JSON feeds are read as text: the tables store
# most of them as text, and a price that is no number must not blank its row.
_TICKET = _struct("id price printed promo_code_id checked_in")
ORDER_JSON = _struct(
    "id order_number purchase_at booking_type",
    customer=_struct("id email name first_name last_name phone new_customer"),
    payments=ArrayType(_struct("payment_method")),
    addons=ArrayType(_struct("name")),
    tickets=MapType(_S, ArrayType(_TICKET)),
)

# Orders are landed under venue_id=…/show_id=… folders, which become columns.
LANDED_ORDER_JSON = StructType(ORDER_JSON.fields + _struct("venue_id show_id").fields)

_CATALOG_EVENT = _struct("id name image_url", shows=ArrayType(_struct("id start_date_time")))
CATALOG_JSON = _struct("venue_id", data=ArrayType(_CATALOG_EVENT))

SHOW_JSON = _struct(
    "show_id", data=_struct("event_id start_date_time sold_out", event=_struct("cancelled_at"))
)

MESSAGE_JSON = _struct("m k s c b e t")
WEBHOOK_JSON = _struct("path httpMethod body received_at")

CONTACTS = _struct("email_address name name_first name_last", sys_entry_date=_T)
VENUES = _struct("id name city state insider_crm_id")
EVENTS = _struct("id venue_id name logo_url")
SHOWS = _ordered(id=_S, event_id=_S, start_date_time=_T, sold_out=_S, cancelled_at=_T)
ORDERS = _ordered(
    id=_S,
    show_id=_S,
    order_number=_S,
    cust_id=_S,
    email=_S,
    phone=_S,
    purchase_date=_T,
    payment_method=_S,
    booking_type=_S,
    order_total=_L,
    new_customer=_S,
    sys_entry_date=_T,
    addons=_S,
)
ORDERLINES = _ordered(
    id=_S,
    order_number=_S,
    ticket_name=_S,
    ticket_price=_L,
    printed=_S,
    promo_code_id=_S,
    checked_in=_S,
)
MESSAGES = _struct("mobile_number keyword security_code campaign body email", timestamp=_T)
SUBSCRIBERS = _struct("mobile_number mobile_status email_address", join_date=_T, last_message_date=_T)
CRM_CONTACTS = _struct("email mobile_number optin_status", date_last_updated=_T)
TAG_MAP = _struct("campaign tag")
ORDER_LINK = _struct("order_number connection crm_id")
PUSH_RESULTS = _struct("venue_id entity key outcome")
MARKS = _struct("job", mark=_T)
