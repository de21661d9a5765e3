"""Column functions: text cleaning, dates, money and form bodies."""

from ticketlens.functions.dates import date_part, to_second, wall_clock
from ticketlens.functions.forms import form_value, parse_form, webhook_fields
from ticketlens.functions.money import parse_cents, whole_units
from ticketlens.functions.text import (
    capitalise,
    clean_email,
    clean_name,
    clean_ticket_name,
    digits_only,
    flag_text,
    is_valid_email,
    product_name,
    repair_quotes,
    strip_space,
)

__all__ = [
    "capitalise",
    "clean_email",
    "clean_name",
    "clean_ticket_name",
    "date_part",
    "digits_only",
    "flag_text",
    "form_value",
    "is_valid_email",
    "parse_cents",
    "parse_form",
    "product_name",
    "repair_quotes",
    "strip_space",
    "to_second",
    "wall_clock",
    "webhook_fields",
    "whole_units",
]
