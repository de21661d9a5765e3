"""Text cleaning as native expressions (no Python UDF anywhere)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: longest phone number kept.
PHONE_DIGITS = 20


_SPACE = " \t\n\x0b\f\r"
# Line ends that ``$`` knows and ``\s`` does not: before one of them at the end, white space goes too.
_OTHER_LINE_ENDS = "\u0085\u2028\u2029"


def strip_space(text: Column) -> Column:
    """Drop leading and trailing white space, tabs and line ends included."""
    by_pattern = F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "")
    # Trimming a set of characters gives the same and is much cheaper than the two patterns.
    plain = F.rtrim(text, F.lit(_OTHER_LINE_ENDS)) == text
    return F.when(plain, F.btrim(text, F.lit(_SPACE))).otherwise(by_pattern)


def clean_ticket_name(text: Column) -> Column:
    """Commas become spaces, apostrophes become backticks, ends are stripped."""
    return strip_space(F.translate(text, ",'", " `"))


def clean_name(text: Column) -> Column:
    """As :func:`clean_ticket_name`, with double quotes dropped."""
    return strip_space(F.translate(text, ",'\"", " `"))


def clean_email(text: Column) -> Column:
    """Lower-cased, stripped, carriage returns removed: the join key form."""
    return F.lower(strip_space(F.replace(text, F.lit("\r"), F.lit(""))))


def is_valid_email(email: Column) -> Column:
    """Neither NULL, nor blank, nor the word "none" left by a missing value."""
    return email.isNotNull() & ~F.lower(email).isin("", "none")


def digits_only(text: Column) -> Column:
    """ASCII digits of the text, at most 20; '' for NULL."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.coalesce(F.left(digits, F.lit(PHONE_DIGITS)), F.lit(""))


def capitalise(text: Column) -> Column:
    """First letter upper, rest lower (single-word status text)."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def flag_text(flag: Column) -> Column:
    """JSON true/false as the stored text True/False; NULL stays NULL."""
    return capitalise(flag.cast("string"))


def repair_quotes(text: Column) -> Column:
    """Typographic apostrophe and its stray control-code form become ASCII."""
    return F.translate(text, "’\u0092", "''")


def product_name(show: Column, event: Column, ticket: Column) -> Column:
    return F.concat_ws(" - ", show, event, ticket)
