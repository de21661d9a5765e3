"""Form-encoded request bodies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The form keys that carry opt-in data.
EMAIL_KEY = "contact[email]"
MOBILE_KEY = "contact[fields][mobile_number]"
OPTIN_KEY_START = "contact[fields][mobile_opt"


def _decode(text: Column) -> Column:
    # try_url_decode turns '+' into a space; here a literal '+' stays a '+'.
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _pairs(body: Column) -> Column:
    """array<struct<key, value>>, split before decoding so that an encoded '&' is data."""

    def pair(part: Column) -> Column:
        return F.struct(
            _decode(F.substring_index(part, "=", 1)).alias("key"),
            _decode(
                F.when(F.contains(part, F.lit("=")), F.substr(part, F.locate("=", part) + 1)).otherwise(F.lit(""))
            ).alias("value"),
        )

    return F.transform(F.split(body, "&"), pair)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it.

    Spark does not share an expression between a lambda and its surroundings.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_form(body: Column) -> Column:
    """Body to map<string,string>; of a repeated key the last value is kept.

    Earlier copies of a key are filtered out here, so the result does not depend
    on the session's map-key policy.
    """

    def to_map(pairs: Column) -> Column:
        def is_last(pair: Column, position: Column) -> Column:
            later = F.slice(pairs, position + 2, F.size(pairs))
            return ~F.exists(later, lambda other: other["key"] == pair["key"])

        return F.map_from_entries(F.filter(F.filter(pairs, is_last), lambda p: p["key"].isNotNull()))

    return _bound(_pairs(body), to_map)


def form_value(form: Column, key_start: str) -> Column:
    """Value under the last key starting with ``key_start``."""
    hits = F.filter(F.map_entries(form), lambda entry: F.startswith(entry["key"], F.lit(key_start)))
    return F.try_element_at(hits, F.lit(-1))["value"]


def webhook_fields(body: Column) -> Column:
    """struct<email, mobile_number, optin_status> of an opt-in webhook body, which is parsed once."""
    return _bound(
        parse_form(body),
        lambda form: F.struct(
            form_value(form, EMAIL_KEY).alias("email"),
            form_value(form, MOBILE_KEY).alias("mobile_number"),
            form_value(form, OPTIN_KEY_START).alias("optin_status"),
        ),
    )
